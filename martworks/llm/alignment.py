"""Alignment of the tokens of two tokenizers on the same texts.

A text is tokenised whole by both, and the tokens' bytes are checked against it. Where a
token of each ends at the same byte and the next tokens of both begin with a space, the
text is cut into windows, mostly words: a window's alignment depends on its token ids
only, so it is worked out once and remembered by them. Inside a window, the ends that both
share cut groups, and each pair of tokens in a group is a link.

How many documents hold a pair linked is counted over the corpus in two steps. A block of
documents, some megabytes of text, lists its distinct pairs and in how many of its
documents each is; these lists are summed by pair, the sums go back to their blocks, and
a block's documents meet them in one cogroup. A pair that every document holds costs one row
for each block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martworks.llm import common

#: Bytes of text that are tokenised together, and that make a block.
SLICE, BLOCK = 1 << 20, 32 << 20
#: Windows that a Python worker remembers before it starts anew, and the bytes of the longest
#: that is worth it: bounds of memory that change no result.
REMEMBERED, LONGEST = 250_000, 1024
#: Characters from which a text is tokenised in parts; a part ends before a space.
PART = 1 << 18
#: A run as long as this, of bytes that are white space or of others, goes to the tokenizer
#: whose time stays near linear.
RUN = 400
#: Between characters that are no white space, a space alone: no token of either spans it.
CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary(name: str) -> str:
    """The path that the public vocabulary files' own module gives."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others are counted up from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


#: Marks where a byte-level vocabulary divides a text before its merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Ids by a byte-level vocabulary file. A vocabulary whose ids rise in the order of its
    merges can be read as ranks, which encode several times as fast; runs without
    any division go to the file's own library, which merges by a queue."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
        self.bytes = [b""] * self.slow.get_vocab_size()
        for token, i in ids.items():
            self.bytes[i] = token
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.ranks = None
        if merged == sorted(merged) and {len(t) for t, i in ids.items() if i < merged[0]} == {1}:
            import tiktoken

            ranks = {t: i for t, i in ids.items() if len(t) == 1 or i >= merged[0]}
            self.ranks = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, runs: bool = True) -> np.ndarray:
        """``runs``: whether the text may have long runs."""
        if self.ranks is None or runs:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text, disallowed_special=())


def has_runs(texts: list[bytes]) -> np.ndarray:
    """Which of the texts touch a run of RUN bytes or more, in all of them in a row, without
    a change between white space and others."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    cuts = np.concatenate(([0], np.flatnonzero(white[1:] != white[:-1]) + 1, [len(data)]))
    found = np.zeros(len(texts), bool)
    for i in np.flatnonzero(np.diff(cuts) >= RUN).tolist():
        first, last = np.searchsorted(ends, (cuts[i], cuts[i + 1] - 1), side="right")
        found[first : last + 1] = True
    return found


class Pieces:
    """Ids by a model of pieces, which puts a space before the text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i]`` to ``starts[i] + sizes[i] - 1`` of all i in a row."""
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return at + np.arange(len(at))


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct numbers in order; ``values`` is sorted in place."""
    values.sort()
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


class _Table:
    """Bytes of all tokens of a vocabulary in one array."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_expanded(self.starts[ids], self.lengths[ids])]


#: Links of a group from which they are counted by distinct ids instead of listed.
MANY_LINKS = 4096


class Windows(dict):
    """Alignments of windows by their ids. A key is the number of the first tokenizer's
    ids, these ids and the other's, four bytes each; its value the place of the alignment:
    its groups as text, each with a semicolon, how many groups and links there are, and
    the pairs linked, each with a number of times."""

    def __init__(self, first: _Table, second: _Table) -> None:
        self.first, self.second, self.base = first, second, len(second.lengths)
        names = [f"{i}," for i in range(max(len(first.lengths), self.base))]
        self.names = _Table([x.encode() for x in names])
        self.start()

    def start(self) -> None:
        self.clear()
        self.texts: list[bytes] = []
        self.groups, self.links, self.ends = array("q"), array("q"), array("q")
        self.codes, self.times = array("q"), array("q")

    def learn(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Add the alignments of windows with the ids ``a`` and ``b``, in their order."""
        ends_a, ends_b = np.cumsum(self.first.lengths[a]), np.cumsum(self.second.lengths[b])
        shared = np.zeros((2, int(ends_a[-1]) + 1), bool)
        shared[0, ends_a] = shared[1, ends_b] = True
        before = np.cumsum(shared[0] & shared[1])
        group_a, group_b = before[ends_a - 1], before[ends_b - 1]
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        last = before[ends_a[np.cumsum(n_a) - 1]]  # groups up to the end of each window
        groups = np.diff(last, prepend=0)
        # The ids as text in the order of the groups; each ends with a comma, the last ones
        # of a group's sides with other marks.
        ids = np.empty(len(a) + len(b), np.int64)
        sides = first_a + first_b
        at_a = np.arange(len(a)) + (sides - first_a)[group_a]
        at_b = np.arange(len(b)) + (sides + in_a - first_b)[group_b]
        ids[at_a], ids[at_b] = a, b
        text = self.names.joined(ids).copy()
        ends = np.cumsum(self.names.lengths[ids])
        text[ends[sides + in_a - 1] - 1] = ord("|")
        text[ends[sides + in_a + in_b - 1] - 1] = ord(";")
        text, cuts = text.tobytes(), [0, *ends[(sides + in_a + in_b)[last - 1] - 1].tolist()]
        self.texts += [text[x:y] for x, y in zip(cuts, cuts[1:])]
        # All links of the groups, the large ones apart.
        links = in_a * in_b
        listed = np.where(links <= MANY_LINKS, links, 0)
        group = np.repeat(np.arange(len(links)), listed)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(listed) - listed, listed)
        codes = a[first_a[group] + nth // in_b[group]] * self.base + b[first_b[group] + nth % in_b[group]]
        times = np.ones(len(codes), np.int64)
        window = np.repeat(np.arange(len(groups)), groups)
        of = window[group]
        large = np.flatnonzero(links > MANY_LINKS)
        if len(large):
            more = [[of], [codes], [times]]
            for g in large.tolist():
                x, p = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
                y, q = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
                more[0].append(np.full(len(x) * len(y), window[g]))
                more[1].append((x[:, None] * self.base + y).ravel())
                more[2].append((p[:, None] * q).ravel())
            of, codes, times = map(np.concatenate, more)
            order = np.argsort(of, kind="stable")
            of, codes, times = of[order], codes[order], times[order]
        self.groups.frombytes(groups.astype(np.int64).tobytes())
        self.links.frombytes(np.diff(np.concatenate(([0], np.cumsum(links)))[last], prepend=0).astype(np.int64).tobytes())
        self.ends.frombytes((len(self.codes) + np.cumsum(np.bincount(of, minlength=len(groups)))).astype(np.int64).tobytes())
        self.codes.frombytes(codes.astype(np.int64).tobytes())
        self.times.frombytes(times.tobytes())


def parts(text: str, size: int = PART) -> list[str]:
    """The text cut at single spaces into parts of ``size`` characters or more; the
    spaces at the cuts are left out, since each part is tokenised with one before it."""
    out, start = [], 0
    while len(text) - start > 2 * size:
        cut = CUT.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start() + 1
    out.append(text[start:])
    return out


_POWER = np.uint64(0x9E3779B97F4A7C15)


def _alike(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the stretches of ``keys``: the first of each that is different, and for each stretch
    which of them it equals. Hashes sort them, and the numbers themselves are compared."""
    at = np.arange(len(keys)) - np.repeat(starts, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _POWER))
    hashes = np.add.reduceat(common.mix(keys.astype(np.uint64)) * powers[at], starts)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    same = first[which]
    if (lengths[same] != lengths).any() or (keys[_expanded(starts[same], lengths)] != keys).any():
        return np.arange(len(starts)), np.arange(len(starts))  # two have the same hash
    return first, which


class Aligner:
    """Both tokenizers and the windows seen so far; one in a Python worker."""

    def __init__(self, first: str, second: str) -> None:
        self.a, self.b = ByteLevel(first), Pieces(second)
        self.first, self.second = _Table(self.a.bytes), _Table(self.b.bytes)
        self.windows = Windows(self.first, self.second)
        self.pairs = len(self.a.bytes) * len(self.b.bytes)

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows of all texts one after another, the place of each text's first (one
        more entry at the end), and how many tokens of each kind a text has. A text that is
        null, empty or not what its tokens' bytes say has none."""
        split = [parts(t) if t else [] for t in texts]
        own = np.repeat(np.arange(len(texts)), [len(p) for p in split])
        flat = list(chain.from_iterable(split))
        raw = [b" " + p.encode() for p in flat]
        ids_a = [self.a.encode(" " + p, r) for p, r in zip(flat, has_runs(raw).tolist())]
        ids_b = self.b.encode(flat)
        n_a = np.array([len(x) for x in ids_a], np.int64)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        sizes = np.array([len(x) for x in raw], np.int64)
        a = np.concatenate(ids_a).astype(np.int64) if ids_a else np.zeros(0, np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        del ids_a, ids_b
        good = np.ones(len(texts), bool)
        for table, ids, n in ((self.first, a, n_a), (self.second, b, n_b)):
            told = np.diff(np.concatenate(([0], np.cumsum(table.lengths[ids])))[np.concatenate(([0], np.cumsum(n)))])
            good[own[told != sizes]] = False
        data = np.frombuffer(b"".join(raw), np.uint8)
        data, a, b, n_a, n_b, sizes, own = self._chosen(good, data, a, b, n_a, n_b, sizes, own)
        wrong = np.flatnonzero((self.first.joined(a) != data) | (self.second.joined(b) != data))
        if len(wrong):
            good[own[np.searchsorted(np.cumsum(sizes), wrong, side="right")]] = False
            data, a, b, n_a, n_b, sizes, own = self._chosen(good, data, a, b, n_a, n_b, sizes, own)
        w, of = self._windows(data, a, b, sizes)
        places = np.searchsorted(own[of], np.arange(len(texts) + 1))
        count = lambda n: np.bincount(own, n, len(texts)).astype(np.int64)
        return w, places, count(n_a), count(n_b)

    @staticmethod
    def _chosen(good, data, a, b, n_a, n_b, sizes, own):
        """All of this for the parts of good texts only."""
        keep = good[own]
        if keep.all():
            return data, a, b, n_a, n_b, sizes, own
        of = lambda x, n: x[np.repeat(keep, n)]
        return of(data, sizes), of(a, n_a), of(b, n_b), n_a[keep], n_b[keep], sizes[keep], own[keep]

    def _windows(self, data, a, b, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows' alignments and the parts they are in."""
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends_a, ends_b = np.cumsum(self.first.lengths[a]), np.cumsum(self.second.lengths[b])
        anchor, shared = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        anchor[:-1] = data == 0x20
        anchor[np.cumsum(sizes)] = True
        for ends in (ends_a, ends_b):
            shared[:] = False
            shared[ends] = True
            anchor &= shared
        last_a, last_b = np.flatnonzero(anchor[ends_a]), np.flatnonzero(anchor[ends_b])
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        lengths = 1 + n_a + n_b
        starts = np.cumsum(lengths) - lengths
        keys = np.empty(int(lengths.sum()), np.uint32)
        keys[starts] = n_a
        keys[np.arange(len(a)) + np.repeat(starts + 1 - (last_a + 1 - n_a), n_a)] = a
        keys[np.arange(len(b)) + np.repeat(starts + 1 + n_a - (last_b + 1 - n_b), n_b)] = b
        first, which = _alike(keys, starts, lengths)
        chosen, ends = starts[first], starts[first] + lengths[first]
        data = keys.tobytes()
        known = self.windows
        get, place, new = known.get, len(known.texts), []
        found = np.empty(len(first), np.int64)
        for i, (x, y) in enumerate(zip((4 * chosen).tolist(), (4 * ends).tolist())):
            key = data[x:y]
            j = get(key, -1)
            if j < 0:
                j = place + len(new)
                new.append(i)
                if y - x <= LONGEST:
                    known[key] = j
            found[i] = j
        if new:
            new = first[new]
            ids_a, ids_b = _expanded((last_a + 1 - n_a)[new], n_a[new]), _expanded((last_b + 1 - n_b)[new], n_b[new])
            known.learn(a[ids_a], b[ids_b], n_a[new], n_b[new])
        return found[which], np.searchsorted(np.cumsum(sizes), ends_a[last_a], side="left")

    def group_texts(self, windows: list[int]) -> bytes:
        """The groups of these windows in a row: ids of both sides, `1,2|3;4|5,6`."""
        known = self.windows.texts
        return b"".join([known[w] for w in windows])[:-1]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    if (first, second) not in _ALIGNERS:
        _ALIGNERS[first, second] = Aligner(first, second)
    return _ALIGNERS[first, second]


_BLOCKS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, nth long, "
    "windows binary, pairs array<long>, held array<long>, w_ends binary, w_pairs binary, w_times binary"
)


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32, first all lowest bytes, then the next: easy to compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents of one task until there are enough for a block."""

    def __init__(self, own: Aligner) -> None:
        self.own, self.rows, self.windows, self.codes, self.counts, self.size = own, [], [], [], [], 0

    def add(self, chunk: pa.RecordBatch) -> None:
        texts = chunk.column("text")
        w, places, n_a, n_b = self.own.texts(texts.to_pylist())
        known = self.own.windows
        groups, links, ends = (np.array(x, np.int64) for x in (known.groups, known.links, known.ends))
        codes, starts = np.array(known.codes, np.int64), np.concatenate(([0], ends))[:-1]
        listed = w.tolist()
        for i, (doc_id, x, y) in enumerate(zip(chunk.column("doc_id").to_pylist(), places.tolist(), places[1:].tolist())):
            sha = hashlib.sha256(self.own.group_texts(listed[x:y])).hexdigest() if y > x else ""
            part = w[x:y]
            self.rows.append((doc_id, int(n_a[i]), int(n_b[i]), int(groups[part].sum()), int(links[part].sum()), sha))
            self.windows.append(part)
        # Each pair once for each of its documents, then the documents of each pair.
        of = np.repeat(np.arange(len(texts)), np.diff(places))
        seen = _distinct(of * len(known.texts) + w)
        of, w = np.divmod(seen, max(1, len(known.texts)))
        sizes = (ends - starts)[w]
        held = _distinct(np.repeat(of, sizes) * self.own.pairs + codes[_expanded(starts[w], sizes)])
        held %= self.own.pairs
        held.sort()
        first = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1]))) if len(held) else held
        self.codes.append(held[first])
        self.counts.append(np.diff(np.append(first, len(held))))
        self.size += texts.nbytes

    def full(self) -> bool:
        return self.size >= BLOCK or len(self.own.windows.texts) >= REMEMBERED

    def taken(self, block: int) -> pa.RecordBatch:
        """The block's rows; the first has its pairs and which windows hold them."""
        known = self.own.windows
        used, at = np.unique(np.concatenate(self.windows), return_inverse=True)
        ends = np.array(known.ends, np.int64)
        starts = np.concatenate(([0], ends))[:-1]
        codes, times = np.array(known.codes, np.int64), np.array(known.times, np.int64)
        sizes = (ends - starts)[used]
        where = _expanded(starts[used], sizes)
        pairs, nth = np.unique(np.concatenate(self.codes), return_inverse=True)
        held = np.bincount(nth, np.concatenate(self.counts), len(pairs)).astype(np.int64)
        cuts = np.cumsum([0, *map(len, self.windows)])
        n = len(self.rows)
        first = lambda x, kind: pa.array([x, *[None] * (n - 1)], kind)
        columns = [pa.array(x, pa.int64()) for x in list(zip(*self.rows))[:5]]
        columns += [
            pa.array([r[5] for r in self.rows], pa.string()),
            pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int64()),
            pa.array([_planes(at[x:y]) for x, y in zip(cuts, cuts[1:])], pa.binary()),
            first(pairs, pa.list_(pa.int64())), first(held, pa.list_(pa.int64())),
            first(_planes(np.cumsum(sizes)), pa.binary()),
            first(_planes(np.searchsorted(pairs, codes[where])), pa.binary()),
            first(times[where].astype("<i8").tobytes(), pa.binary()),
        ]
        if len(known.texts) >= REMEMBERED:
            known.start()
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        self.__init__(self.own)
        return pa.RecordBatch.from_arrays(columns, names=names)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def blocks(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Documents with the windows of their texts, and of each block its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(aligner(first, second)), TaskContext.get().partitionId() << 32
        for chunk in common.chunks(batches, "text", SLICE):
            block.add(chunk)
            if block.full():
                yield block.taken(number)
                number += 1
        if block.rows:
            yield block.taken(number)
        common.release()

    return _plain(docs).mapInArrow(run, _BLOCKS)


def counted(stored: DataFrame, pairs: int) -> DataFrame:
    """Of blocks(): pair, count (documents that hold it linked) and best (no pair with the
    same first id has more). ``pairs`` is the second vocabulary's size. A first id has one
    row for each second id at most."""
    rows = stored.where("nth = 0").select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    sums = rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("count"))
    first = F.floor(F.col("pair") / pairs)
    return sums.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy(first)))


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """What the counts of a block's pairs are to its documents."""
    docs = docs.sort_by("nth")
    at = counts.column("at").to_numpy()
    values = {}
    ends, times = _numbers(docs.column("w_ends")[0].as_py()), np.frombuffer(docs.column("w_times")[0].as_py(), "<i8")
    which = _numbers(docs.column("w_pairs")[0].as_py())
    for name in ("best", "count"):
        of = np.zeros(len(at), np.int64)
        of[at] = counts.column(name).to_numpy().astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(of[which] * times)))
        values[name] = sums[ends] - sums[np.concatenate(([0], ends))[:-1]]
    best, total = [], []
    for data in docs.column("windows").to_pylist():
        w = _numbers(data)
        best.append(int(values["best"][w].sum()))
        total.append(int(values["count"][w].sum()))
    own = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(
        {**own, "n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups_sha256": docs.column("groups_sha256")}
    )


def aligned(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a and n_b (tokens by the byte-level
    vocabulary ``first`` and the pieces of ``second``), n_groups, n_links, n_best (links that
    no other of their first id has more documents than), count_sum (over the links, in
    how many documents of ``docs`` their pair is linked) and groups_sha256.

    A null or empty text, and one whose tokens' bytes are not the text, has no tokens: zeros
    and an empty digest. Texts of any length are tokenised whole, long ones in parts that end
    where no token can span. Rows that repeat an id or a text are documents of their own;
    null ids stay null. Pairs whose counts are equal are all best. Other columns are ignored.
    An empty table gives an empty result."""
    first, second = first or vocabulary("byte_bpe_50k.json"), second or vocabulary("piece_bpe_32k.model")
    stored = common.stored(blocks(docs, first, second), f"{common.folder(docs.sparkSession)}/blocks")
    sums = counted(stored, len(Pieces(second).bytes))
    listed = stored.where("nth = 0").select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    back = listed.join(sums, "pair").select("of", "at", "count", "best")
    return stored.drop("pairs", "held").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_summed, _RESULT)


def groups(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """The alignment itself: doc_id and groups, an array of the ids of both sides in the order
    of the text. A text without tokens has none."""
    first, second = first or vocabulary("byte_bpe_50k.json"), second or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first, second)
        for chunk in common.chunks(batches, "text", SLICE):
            w, places, _, _ = own.texts(chunk.column("text").to_pylist())
            listed, out = w.tolist(), []
            for x, y in zip(places.tolist(), places[1:].tolist()):
                sides = [g.split("|") for g in own.group_texts(listed[x:y]).decode().split(";")] if y > x else []
                out.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in sides])
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(out, kind)], names=["doc_id", "groups"])
            if len(own.windows.texts) >= REMEMBERED:
                own.windows.start()

    return _plain(docs).mapInArrow(run, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")
