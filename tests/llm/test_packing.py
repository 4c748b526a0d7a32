from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from martworks.llm import packing


def _ids(texts):
    t = Tokenizer.from_file(packing.default_tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids + [packing.END] for x in texts]


def _check(rows, got):
    """Every id in exactly one piece, checksums, and sequences without gaps."""
    want = {i: x for (i, _), x in zip(rows, _ids([t for _, t in rows]))}
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append(r)
    assert set(parts) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(parts[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            piece = np.array(ids[at : at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(ids)
    full = defaultdict(list)
    for r in got:
        full[r.sequence_id].append((r.offset, r.length))
    for spans in full.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    return sum(map(len, want.values())), len(full)


def test_round_trip(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    total, sequences = _check(rows, packing.packed(documents).collect())
    assert total / (sequences * packing.LENGTH) > 0.97


def test_ids_of_odd_texts():
    texts = [r[1] for r in brute.ODD if r[1] is None or len(r[1]) < 10_000]
    texts += ["<|endoftext|> a<|ENDOFTEXT|>b", "it's Dogs', THE!! of.&&& a<b> x<|endoftext|> (in) thnd***, it's.'', end. x,. É. ñ, 3. ₂² ǅ ﬁ́ \x1c\x85  İ ß. Ω, Å"]
    ids, places = packing.WordTokenizer(packing.default_tokenizer()).encode(pa.array(texts))
    for i, want in enumerate(_ids(texts)):
        assert ids[places[i] : places[i + 1]].tolist() == want[:-1], texts[i]


def test_first_fit_decreasing():
    rnd = np.random.default_rng(2)
    sizes = rnd.integers(1, 101, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    free = []
    for i in np.argsort(-sizes, kind="stable"):
        fit = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
        if fit == len(free):
            free.append(100)
        assert (bins[i], offsets[i]) == (fit, 100 - free[fit])
        free[fit] -= sizes[i]


def test_odd_rows(odd):
    rows = [r for r in odd.select("doc_id", "text").collect() if r.doc_id != 9]
    got = packing.packed(odd).collect()
    assert sum(r.doc_id == 9 for r in got) == 2
    _check([tuple(r) for r in rows], packing.packed(odd.where("doc_id is null or doc_id <> 9")).collect())
    assert packing.packed(odd.where("false")).count() == 0


def test_sequences_hold_the_ids(documents):
    docs = documents.where("doc_id < 60")
    packed = packing.packed(docs).cache()
    tokens = packing.tokenized(docs).cache()
    made = {r.sequence_id: r.ids for r in packing.sequences(packed, tokens).collect()}
    ids = {r.doc_id: r.ids for r in tokens.collect()}
    for r in packed.collect():
        assert made[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]


def test_segments_stay_apart(documents):
    from pyspark.sql import functions as F

    got = packing.packed(documents, segment=F.col("doc_id") % 3).collect()
    owners = defaultdict(set)
    for r in got:
        owners[r.sequence_id].add(r.doc_id % 3)
    assert all(len(x) == 1 for x in owners.values())
    assert [min(x) for _, x in sorted(owners.items())] == sorted(min(x) for x in owners.values())
