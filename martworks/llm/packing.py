"""Packing of tokenised documents into sequences of one length.

A document longer than a sequence is cut at multiples of the length; the pieces are
packed first-fit decreasing, where a tournament tree over the open bins' free space finds
the first bin that takes a piece in logarithmic time. Documents are dealt by a hash of
their id into groups of bounded expected size, and each group is packed on its own, so
the work spreads over any number of tasks and only piece lengths are shuffled.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

LENGTH = 4096
END = 2
#: Pieces in a group on average: its padding is at most about one sequence in 400.
GROUP_PIECES = 4000
#: Words whose ids a Python worker remembers: those used lately, up to twice as many. A
#: memory bound that changes no result.
REMEMBERED = 60_000
#: Marks that are tokenised apart from the letters before them.
ENDINGS = ".,;:!?#*$%&|<>)"
#: Bytes of text whose distinct words are looked up together.
TOGETHER = 1 << 20

PIECES = (
    "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"
)


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never cross white space: the distinct
    words of a batch are encoded once each, and the texts are put together from them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.letters = {"": ""}

    def _plain(self, word: str) -> bytes | None:
        """Ids of lower-case letters that stand for themselves in every normal form: the
        model gets them as they are, which saves the general path's regular expressions."""
        if word.isascii():
            if not word.isalpha():
                return None
            mapped = word
        else:
            parts = []
            for c in word:
                if not ("a" <= c <= "z" or "ß" <= c <= "ÿ" and c != "÷"):
                    return None
                if c not in self.letters:
                    self.letters[c] = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
                parts.append(self.letters[c])
            mapped = "".join(parts)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a word, A-Z in lower case."""
        ids = self.words.get(word)
        if ids is not None:
            return ids
        ids = self.before.get(word)
        if ids is None:
            ids = self._plain(word)
        if ids is None:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self.words) >= REMEMBERED:
            self.before, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def distinct(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words. Marks at the end of a word that follow a letter or digit
        are a token sequence of their own, so words are encoded without them, once each."""
        special = pc.match_substring(words, "<|")
        lower = pc.if_else(special, words, pc.ascii_lower(words))
        stems = pc.utf8_rtrim(lower, characters=ENDINGS)
        raw, offsets = common.text_bytes(stems)
        last = np.where(np.diff(offsets) > 0, raw[np.maximum(offsets[1:] - 1, 0)] if len(raw) else 0, 0)
        alone = _ALNUM[last] & ~special.to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(alone), stems, lower)
        marks = pc.subtract(pc.binary_length(lower), pc.binary_length(stems)).to_numpy()
        codes = stems.dictionary_encode()
        known = self.words.get
        coded = [known(w) or (self.word(w) if w else b"") for w in _strings(codes.dictionary)]
        out = [coded[i] for i in codes.indices.to_pylist()]
        ends = np.flatnonzero(marks)
        for i, w, n in zip(ends.tolist(), _strings(lower.take(pa.array(ends))), marks[ends].tolist()):
            out[i] += self.word(w[-n:])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together and the place of each text's first (one more entry
        at the end); a null text has none."""
        words = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        codes = words.flatten().dictionary_encode()
        coded = self.distinct(codes.dictionary)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        flat = np.frombuffer(b"".join(coded), np.uint32)
        index = codes.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        begins = (np.cumsum(sizes) - sizes)[index]
        at = np.repeat(begins - (ends - lengths), lengths)
        at += np.arange(len(at))
        places = np.concatenate(([0], ends))[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return flat[at], places


_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _strings(words: pa.Array) -> list[str]:
    """Words without white space as a list; quicker than one by one."""
    if not len(words):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def default_tokenizer() -> str:
    """The path that the public vocabulary files' own module gives."""
    try:
        import public_tokenizers
    except ImportError:
        sys.path.append("/opt/tokenizers")
        import importlib.util

        spec = importlib.util.spec_from_file_location("public_tokenizers", "/opt/tokenizers/__init__.py")
        public_tokenizers = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public_tokenizers)
    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int, the end id last) of every row of ``docs``."""
    path = path or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for chunk in common.chunks(batches, "text", TOGETHER):
            ids, places = own.encode(chunk.column("text"))
            ids = np.insert(ids, places[1:], END).astype(np.int32)
            places = places + np.arange(len(places))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "ids"],
            )

    return _plain_columns(docs).drop("segment").mapInArrow(encode, "doc_id long, ids array<int>")


def _plain_columns(docs: DataFrame, segment: Column | None = None) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.lit(0) if segment is None else F.coalesce(segment, F.lit(0))).cast("long").alias("segment"),
    )


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, segment: Column | None = None) -> DataFrame:
    """The pieces of every document: its ids are cut at multiples of ``length``. ``row``
    tells apart rows that share a doc_id."""
    path = path or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for chunk in common.chunks(batches, "text", TOGETHER):
            ids, places = own.encode(chunk.column("text"))
            row, start, size, crc, total = [], [], [], [], []
            for i, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
                document = np.append(ids[a:b], np.uint32(END)).astype("<u4")
                for at in range(0, len(document), length):
                    piece = document[at : at + length]
                    row.append(i)
                    start.append(at)
                    size.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(document))
            at = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").take(at),
                    chunk.column("row").take(at),
                    chunk.column("segment").take(at),
                    *(pa.array(x, pa.int64()) for x in (start, size, crc, total)),
                ],
                names=["doc_id", "row", "segment", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = _plain_columns(docs, segment).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(
        cut,
        "doc_id long, row long, segment long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the order given. The tree's leaves hold the free
    space of bins, its inner nodes the larger of their children: the way down to the
    leftmost leaf with enough space is the first fit."""
    n = len(sizes)
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = [0] * n, [0] * n
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i] = node - leaves
        offsets[i] = capacity - tree[node]
        tree[node] -= size
        node //= 2
        while node:
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
            node //= 2
    return bins, offsets


def pack(cut: DataFrame, groups: int, length: int = LENGTH, seed: int = 0) -> DataFrame:
    """Sequence and offset of every piece. Groups are randomised by a hash of the
    document's id and row within their segment; sequence ids rise with the segment."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32", "row"], na_position="first")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), length)
        # Groups stay apart by their number; a group has fewer than 2^24 sequences.
        group["sequence_id"] = (group["group"].to_numpy() << 24) + np.array(bins, np.int64)
        group["offset"] = np.array(offsets, np.int64)
        return group[
            ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        ]

    number = F.col("segment") * groups + F.pmod(
        F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(groups)
    )
    return cut.withColumn("group", number).groupBy("group").applyInPandas(
        one, f"{PIECES}, sequence_id long, offset long"
    )


def packed(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, segment: Column | None = None
) -> DataFrame:
    """Pack all rows of ``docs`` (doc_id, text): one row per piece with doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset. Other columns are ignored.

    A null or empty text has its end id only. Rows that repeat a doc_id are packed once
    each. A null doc_id stays null. An empty table gives an empty result. ``segment`` (a
    small integer column) keeps documents of different segments in different sequences,
    in the order of the segments."""
    spark = docs.sparkSession
    cut = common.stored(pieces(docs, path, length, segment), f"{common.folder(spark)}/pieces")
    n, segments = cut.agg(F.count("*"), F.countDistinct("segment")).first()
    groups = max(1, round(n / max(1, segments) / GROUP_PIECES))
    return pack(cut, groups, length).drop("row")


def sequences(packing: DataFrame, tokens: DataFrame) -> DataFrame:
    """The id arrays of packed sequences: sequence_id, n_tokens, ids. ``tokens`` is
    tokenized() of the same documents, whose doc_id is unique here."""
    parts = packing.join(tokens, "doc_id").select(
        "sequence_id",
        F.struct(
            "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")
        ).alias("part"),
    )
    ids = F.flatten(F.transform(F.sort_array(F.collect_list("part")), lambda p: p["ids"]))
    return parts.groupBy("sequence_id").agg(ids.alias("ids")).select(
        "sequence_id", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )
