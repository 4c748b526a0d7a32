from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from brute import LONG
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martworks.llm import alignment

A = alignment.vocabulary("byte_bpe_50k.json")
B = alignment.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=B)
    letters = alignment._byte_letters()

    def tokens(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        return a, b, bytes_a, bytes_b

    return tokens


def _groups(text, tokens):
    """Groups of a text by all shared ends, token by token."""
    if not text:
        return [], 0, 0
    a, b, bytes_a, bytes_b = tokens(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], 0, 0
    ends_a, ends_b, at = [], [], 0
    for x in bytes_a:
        at += len(x)
        ends_a.append(at)
    at = 0
    for x in bytes_b:
        at += len(x)
        ends_b.append(at)
    shared, out, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for end in shared:
        m, n = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        out.append((a[i:m], b[j:n]))
        i, j = m, n
    return out, len(a), len(b)


def _brute(rows, tokens):
    aligned = [(doc_id, *_groups(text, tokens)) for doc_id, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g, _, _ in aligned]
    held = Counter(p for own in links for p in own)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (doc_id, g, n_a, n_b), own in zip(aligned, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append(
            (
                doc_id, n_a, n_b, len(g), sum(own.values()), sum(n for p, n in own.items() if held[p] == most[p[0]]),
                sum(n * held[p] for p, n in own.items()), hashlib.sha256(text.encode()).hexdigest() if g else "",
            )
        )
    return sorted(out, key=repr)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_all_shared_ends(spark, documents, encoders):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert _rows(alignment.aligned(documents)) == _brute(rows, encoders)


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "\n\ttabs\r\n", "a<|endoftext|>b <s> </s> <unk> <0x41>", "▁mark in the text",
    "ﬁ ½ Ⅷ é é İ ß", "你好世界 没有空格的长句子。", "🙂🙃👩‍👩‍👧 x", "'s 't don't I'll", "\x00\x01 nul", "a b c​d",
    "x" * 3000, " " * 700 + "end", "#" * 900 + " 1234567890" * 50, "same same same same", "same same same same",
]


def test_odd_texts(spark, encoders):
    rows = [*enumerate(ODD_TEXTS), (None, "no id"), (3, "again this id"), (99, LONG[:20_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(alignment.aligned(df)) == _brute(rows, encoders)


def test_odd_rows(spark, odd):
    got = alignment.aligned(odd)
    assert got.count() == odd.count()
    assert alignment.aligned(odd.limit(0)).collect() == []


def test_parts_change_nothing(encoders, monkeypatch):
    text = LONG[:30_000] + "  " + "y" * 2000 + " \n z " + "Écoute ÉTÉ 你好 " * 300
    own = alignment.Aligner(A, B)
    whole = own.texts([text])
    monkeypatch.setattr(alignment.parts, "__defaults__", (500,))
    assert len(alignment.parts(text)) > 30
    split = own.texts([text])
    assert own.group_texts(whole[0].tolist()) == own.group_texts(split[0].tolist())
    assert whole[2].tolist() == split[2].tolist() and whole[3].tolist() == split[3].tolist()


def test_blocks_change_nothing(spark, documents, monkeypatch, encoders):
    own, block = alignment.Aligner(A, B), None
    rows = documents.limit(200).toArrow().combine_chunks().to_batches()[0]
    texts = rows.column("text").to_pylist()
    want = [own.group_texts(own.texts([t])[0].tolist()) for t in texts]
    small = alignment.Aligner(A, B)
    monkeypatch.setattr(alignment, "REMEMBERED", 500)  # forgets all the time
    block = alignment._Block(small)
    got = []
    for i in range(0, len(texts), 7):
        block.add(rows.slice(i, 7))
        if block.full():
            got += block.taken(0).column("groups_sha256").to_pylist()
    if block.rows:
        got += block.taken(0).column("groups_sha256").to_pylist()
    assert got == [hashlib.sha256(w).hexdigest() if w else "" for w in want]


def test_ranks_are_the_file(encoders):
    own = alignment.ByteLevel(A)
    assert own.ranks is not None
    for c in [*range(0, 0xD800, 7), *range(0xE000, 0x11000), 0x1F600, 0x2FA1D, 0xE0001]:
        text = f" a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}\n {chr(c)}"
        assert own.encode(text, runs=False).tolist() == own.slow.encode(text, add_special_tokens=False).ids


def test_groups_give_the_ids(spark, encoders):
    df = spark.createDataFrame([(1, "Hello wörld, again"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in alignment.groups(df).collect()}
    assert got == {1: _groups("Hello wörld, again", encoders)[0], 2: []}


def test_only_texts_without_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert _rows(alignment.aligned(df)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_long_runs_are_found():
    texts = [b" a b" * 300, b" " + b"x" * 398 + b" y", b" " + b"x" * 400, b" a" + b"\n" * 500, b" " + "é".encode() * 200, b" q"]
    assert alignment.has_runs(texts).tolist() == [False, False, True, True, True, False]
    assert alignment.has_runs([b" " + b"x" * 300, b"x" * 300, b" x"]).tolist() == [True, True, False]


def test_alike_windows():
    keys, lengths = np.array([1, 5, 6, 1, 5, 6, 1, 6, 5, 2, 5, 6, 7], np.uint32), np.array([3, 3, 3, 4])
    first, which = alignment._alike(keys, np.cumsum(lengths) - lengths, lengths)
    assert which[0] == which[1] and len({*which.tolist()}) == len(first) == 3
    assert first[which].tolist() == [0, 0, 2, 3]
