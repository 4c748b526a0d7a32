"""Repeated stretches of bytes by enhanced suffix arrays around common marks.

What repeats is a string of ``LENGTH`` bytes that two documents hold. Of its 16-byte grams
the one with the least hash is a mark: it depends on the string only, so the string is
found again around the same mark in every document, inside the mark's context, the bytes
that such strings can reach from it. Three steps follow.

Marks and digests of contexts are dealt by mark. A context that a smaller id holds as well
is covered whole. The first holders of marks with several contexts go on, now with bytes:
the contexts of a mark meet in one task, where the suffixes of all of them are sorted,
and a scan of their common prefixes with a stack finds each interval of suffixes with
a prefix in common. One whose suffixes are preceded by different bytes is a maximal
repeat; all its occurrences are a group, and those outside the group's smallest
document are covered. At last each document's covered stretches are joined.

A mark with very many contexts is not brought together in one task: its strings are
compared one by one with aggregations that combine before they shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

LENGTH = 50
GRAM = 16
#: Marks that a task compares at once, contexts whose suffixes are sorted together, and
#: contexts from which a mark is compared string by string. They change no result.
BUCKET, SORTED, MANY = 1 << 19, 6_000, 20_000

_BYTE = common._constants(256, 61)
_BASE = 0x9E3779B97F4A7C15 | 5
_BACK = pow(_BASE, -1, 1 << 64)


def _slide(values: np.ndarray, least, size: int) -> np.ndarray:
    """``least`` of each ``size`` neighbours, by doubling."""
    done = 1
    while done * 2 <= size:
        values = least(values[:-done], values[done:])
        done *= 2
    return least(values[: len(values) - (size - done)], values[size - done :]) if done < size else values


class Marks:
    """Marks of the texts that ``offsets`` divides ``raw`` into: ``at`` (place in raw), ``of``
    (text), ``mark`` (hash of the gram), ``start`` and ``end`` of the context, and
    ``context``, its digest with the mark's place in it. Grams that share the least hash of a
    string are all marks. Texts shorter than ``length`` have none."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> None:
        span = length - GRAM + 1
        empty = np.zeros(0, np.int64)
        self.at = self.of = self.start = self.end = empty
        self.mark = self.context = empty.view(np.uint64)
        if len(raw) < length:
            return
        raw = np.ascontiguousarray(raw)
        n = len(raw) - GRAM + 1
        low, high = (np.ndarray((n,), "<u8", raw.data, j, (1,)).astype(np.uint64) for j in (0, 8))
        hashes = np.maximum(common.mix(low * np.uint64(_BASE) + common.mix(high)), np.uint64(1))
        least = _slide(hashes, np.minimum, span)
        starts = np.zeros(len(least), bool)  # of strings that lie within a text
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            starts[a : max(a, b - length + 1)] = True
        # A gram is a mark where it has the least hash of some string over it.
        least[~starts] = 0
        edge = np.zeros(span - 1, np.uint64)
        most = _slide(np.concatenate((edge, least, edge)), np.maximum, span)
        at = self.at = np.flatnonzero(hashes == most[:n])
        self.mark = common.mix(hashes[at])  # least hashes are small: mixed, they spread again
        self.of = np.searchsorted(offsets, at, side="right") - 1
        self.start = np.maximum(at - (length - GRAM), offsets[self.of])
        self.end = np.minimum(at + length, offsets[self.of + 1])
        powers = np.multiply.accumulate(np.full(len(raw), np.uint64(_BASE)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * powers, dtype=np.uint64)))
        back = np.multiply.accumulate(np.full(len(raw) + 1, np.uint64(_BACK)))
        size = (self.end - self.start).astype(np.uint64) << np.uint64(32)
        own = (sums[self.end] - sums[self.start]) * back[self.start]
        self.context = common.mix(own + size + (at - self.start).astype(np.uint64))


def _keys(mark: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Mark and context in one number whose two lowest bits are free."""
    return common.mix(mark + common.mix(context)) & ~np.uint64(3)


def joined(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pairs (start, end) of the stretches that the given ones cover; touching ones join."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.concatenate((first[1:], [True]))
    return np.stack((starts[first], ends[last]), axis=1).astype(np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows sorted by ``columns`` begin with a new value."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _planes(values: np.ndarray) -> bytes:
    """All highest bytes, then the next: sorted or small numbers are then easy to compress."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


_DEALT = "bucket long, ids binary, marks binary, contexts binary"


def _deal(batches: Iterator[pa.RecordBatch], bits: int, length: int) -> Iterator[pa.RecordBatch]:
    """Of each slice of texts: for each bucket of marks the first holder of each context.
    The others are covered; their keys go along in a row of a bucket below 0."""
    for batch in common.chunks(batches, "text"):
        m = Marks(*common.text_bytes(batch.column("text")), length)
        ids = batch.column("doc_id").to_numpy()[m.of]
        order = np.lexsort((ids, m.context, m.mark))
        mark, context, ids = m.mark[order], m.context[order], ids[order]
        first = _starts(mark, context)
        least = np.repeat(ids[first], np.diff(np.append(first, len(ids))))
        rows: list[tuple] = []
        covered = ids > least
        if covered.any():
            keys = _keys(mark[covered], context[covered]) | np.uint64(COVERED)
            rows.append((-1 - int(ids[0] & 0xFFFFF), _planes(ids[covered]), _planes(keys), None))
        mark, context, ids = mark[first], context[first], ids[first]
        buckets = (mark >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(mark), np.int64)
        cuts = _starts(buckets).tolist()
        for x, y in zip(cuts, [*cuts[1:], len(mark)]):
            rows.append((int(buckets[x]), _planes(ids[x:y]), _planes(mark[x:y]), _planes(context[x:y])))
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["bucket", "ids", "marks", "contexts"]
        )


#: What is to be done about a context of a document, in the two lowest bits of its key.
COVERED, SCANNED, COMPARED = 0, 1, 2


class _Bucket:
    """Contexts of the marks of one bucket. Marks with more than ``many`` contexts don't stay:
    all theirs are passed on at once, so memory follows the others."""

    def __init__(self, many: int) -> None:
        self.many, self.held, self.size, self.limit = many, [], 0, 4 * BUCKET
        self.hot = np.zeros(0, np.uint64)

    def add(self, ids: bytes, marks: bytes, contexts: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.held.append((_numbers(marks), _numbers(contexts), _numbers(ids).view(np.int64)))
        self.size += len(self.held[-1][0])
        if self.size >= self.limit:
            yield from self._reduced()
            self.limit = max(self.limit, 2 * self.size)

    def _sorted(self):
        mark, context, ids = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, context, mark))
        return mark[order], context[order], ids[order]

    def _reduced(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        mark, context, ids = self._sorted()
        own = _starts(mark, context)
        marks = _starts(mark)
        counts = np.diff(np.append(np.searchsorted(own, marks), len(own)))
        self.hot = np.union1d(self.hot, mark[marks][counts > self.many])
        hot = np.isin(mark, self.hot)
        if hot.any():
            yield ids[hot], _keys(mark[hot], context[hot]) | np.uint64(COMPARED)
        self.held = [(mark[~hot], context[~hot], ids[~hot])]
        self.size = int((~hot).sum())

    def done(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from self._reduced()
        mark, context, ids = self.held[0]
        if not len(mark):
            return
        own = _starts(mark, context)
        sizes = np.diff(np.append(own, len(mark)))
        least = np.repeat(ids[own], sizes)
        marks = _starts(mark)
        many = np.diff(np.append(np.searchsorted(own, marks), len(own))) > 1
        # First holders of a mark's contexts are compared if they are two documents or more.
        several = np.minimum.reduceat(least, marks) < np.maximum.reduceat(least, marks)
        compared = np.repeat(many & several, np.diff(np.append(marks, len(mark))))
        keys, covered = _keys(mark, context), ids > least
        yield ids[covered], keys[covered] | np.uint64(COVERED)
        first = compared & ~covered
        yield ids[first], keys[first] | np.uint64(SCANNED)


def _meet(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    """Keys of what has to be done, by document, from rows sorted by bucket."""

    def batch(ids, keys):
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.view(np.int64))], names=["doc_id", "key"])

    number, bucket = None, None
    for rows in batches:
        columns = [rows.column(c) for c in ("bucket", "ids", "marks", "contexts")]
        for n, ids, marks, contexts in zip(columns[0].to_pylist(), *columns[1:]):
            if n < 0:
                yield batch(_numbers(ids.as_py()).view(np.int64), _numbers(marks.as_py()))
                continue
            if n != number:
                if bucket:
                    yield from (batch(*x) for x in bucket.done() if len(x[0]))
                number, bucket = n, _Bucket(many)
            yield from (batch(*x) for x in bucket.add(ids.as_py(), marks.as_py(), contexts.as_py()))
    if bucket:
        yield from (batch(*x) for x in bucket.done() if len(x[0]))
    common.release()


_CUT = (
    "doc_id long, h long, runs binary, marks array<long>, kinds array<int>, grams array<int>, starts array<array<int>>, "
    "contexts array<binary>"
)


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of documents with the keys found for them: the stretches of covered contexts, and the
    bytes and places of contexts to be compared, each context once."""
    for batch in common.chunks(batches, "text"):
        raw, offsets = common.text_bytes(batch.column("text"))
        m = Marks(raw, offsets, length)
        keys, whole = _keys(m.mark, m.context), raw.tobytes()
        cuts = np.searchsorted(m.of, np.arange(batch.num_rows + 1)).tolist()
        out: list[list] = [[] for _ in range(6)]
        for i in range(batch.num_rows):
            wanted = np.sort(batch.column("keys")[i].values.to_numpy().view(np.uint64))
            own = keys[cuts[i] : cuts[i + 1]]
            at = np.searchsorted(wanted, own)
            found = wanted[np.minimum(at, len(wanted) - 1)]
            hit = (at < len(wanted)) & (found & ~np.uint64(3) == own)
            kind = np.where(hit, (found & np.uint64(3)).astype(np.int64), -1)
            own_start, own_end = m.start[cuts[i] : cuts[i + 1]], m.end[cuts[i] : cuts[i + 1]]
            covered = kind == COVERED
            runs = joined(own_start[covered], own_end[covered]) - offsets[i]
            rest = np.flatnonzero(kind > COVERED)
            rest = rest[np.argsort(own[rest], kind="stable")]
            first = _starts(own[rest]).tolist()
            marks, kinds, grams, starts, contexts = [], [], [], [], []
            for x, y in zip(first, [*first[1:], len(rest)]):
                j = rest[x]
                marks.append(int(m.mark[cuts[i] + j].view(np.int64)))
                kinds.append(int(kind[j]))
                grams.append(int(m.at[cuts[i] + j] - own_start[j]))
                starts.append((own_start[rest[x:y]] - offsets[i]).tolist())
                contexts.append(whole[own_start[j] : own_end[j]])
            for column, value in zip(out, (runs.tobytes(), marks, kinds, grams, starts, contexts)):
                column.append(value)
        small = pa.list_(pa.int32())
        kinds = [pa.binary(), pa.list_(pa.int64()), small, small, pa.list_(small), pa.list_(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("h"), *(pa.array(x, k) for x, k in zip(out, kinds))],
            names=["doc_id", "h", "runs", "marks", "kinds", "grams", "starts", "contexts"],
        )


def _table(contexts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each context, filled up with zeros, and how many there are."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    table = np.zeros((len(contexts), width), np.uint8)
    table[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(contexts), np.uint8)
    return table, sizes


def suffix_array(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of ``length`` bytes or more of all contexts in the order of their bytes: the
    context and the place of each, and how many bytes each has in common with the one
    before it, 0 for less than ``length``. The fourth array is the byte before each,
    -1 where the context begins. A context's end is before every byte."""
    width = max(map(len, contexts))
    table, sizes = _table(contexts, 2 * width)
    rows, of, at = [], [], []
    for p in range(width - length + 1):
        own = np.flatnonzero(sizes - p >= length)
        suffix = np.empty((len(own), width + 1), np.uint8)
        suffix[:, :width] = table[own, p : p + width]
        suffix[:, width] = sizes[own] - p  # equal so far: the shorter first
        rows.append(suffix)
        of.append(own)
        at.append(np.full(len(own), p))
    suffixes, of, at = np.concatenate(rows), np.concatenate(of), np.concatenate(at)
    del rows
    order = np.argsort(suffixes.view(f"S{width + 1}").ravel(), kind="stable")
    suffixes, of, at = suffixes[order], of[order], at[order]
    left = np.where(at > 0, table[of, np.maximum(at - 1, 0)].astype(np.int64), -1)
    common_bytes = np.zeros(len(of), np.int64)
    differ = suffixes[1:, :width] != suffixes[:-1, :width]
    same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rest = sizes[of] - at
    same = np.minimum(same, np.minimum(rest[1:], rest[:-1]))
    common_bytes[1:] = np.where(same >= length, same, 0)
    return of, at, common_bytes, left


def maximal_repeats(prefixes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rows (first, last, depth) of the common-prefix intervals of a suffix array that no
    byte extends to the left: a stack holds the open intervals, deeper ones above; one
    is closed where the common prefix falls below its depth. It is extended where all its
    suffixes have the same byte before them; where a context begins, nothing is known."""
    change = np.ones(len(left), np.int64)
    change[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    diverse = np.cumsum(change).tolist()
    begins = np.cumsum(left < 0).tolist()
    found: list[tuple[int, int, int]] = []
    depths, firsts = [0], [0]
    places = np.flatnonzero(prefixes)
    stops = places[np.diff(places, append=-2) != 1] + 1  # a common prefix ends here
    walk = np.union1d(places, stops[stops < len(prefixes)])
    values = [*prefixes[walk].tolist(), 0]
    for i, depth in zip([*walk.tolist(), len(prefixes)], values):
        first = i - 1
        while depths[-1] > depth:
            first = firsts.pop()
            if diverse[i - 1] > diverse[first] or begins[i - 1] > (begins[first - 1] if first else 0):
                found.append((first, i - 1, depths[-1]))
            depths.pop()
        if depth > depths[-1]:
            depths.append(depth)
            firsts.append(first)
    return np.array(found, np.int64).reshape(-1, 3)


def groups(contexts: list[bytes], length: int = LENGTH) -> list[tuple[bytes, list[tuple[int, int]]]]:
    """The maximal repeats of ``contexts``: each string with all its occurrences, as
    (context, place), in order."""
    if not any(len(c) >= length for c in contexts):
        return []
    of, at, prefixes, left = suffix_array(contexts, length)
    out = []
    for first, last, depth in maximal_repeats(prefixes, left).tolist():
        places = sorted(zip(of[first : last + 1].tolist(), at[first : last + 1].tolist()))
        out.append((contexts[places[0][0]][places[0][1] : places[0][1] + depth], places))
    return out


def covered(contexts: list[bytes], ids: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(context, start, end) of the stretches in maximal repeats that a context with a
    smaller id holds as well."""
    of, at, prefixes, left = suffix_array(contexts, length)
    found = maximal_repeats(prefixes, left)
    if not len(found):
        return []
    first, last, depth = found.T
    sizes = last - first + 1
    places = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    own = ids[of[places]]
    least = np.minimum.reduceat(own, np.cumsum(sizes) - sizes)
    lost = own > np.repeat(least, sizes)
    places, depth = places[lost], np.repeat(depth, sizes)[lost]
    width = max(map(len, contexts))
    steps = np.zeros((len(contexts), width + 1), np.int64)
    np.add.at(steps, (of[places], at[places]), 1)
    np.add.at(steps, (of[places], at[places] + depth), -1)
    inside = np.zeros((len(contexts), width + 2), np.int8)
    inside[:, 1:-1] = np.cumsum(steps, axis=1)[:, :-1] > 0
    edges = np.diff(inside, axis=1)
    c, start = np.nonzero(edges == 1)
    return list(zip(c.tolist(), start.tolist(), np.nonzero(edges == -1)[1].tolist()))


def _near(marks: np.ndarray, contexts: list[bytes], grams: np.ndarray, length: int) -> np.ndarray:
    """Contexts that can share a string of ``length`` bytes around their mark with another
    one: what each has in common with its neighbours to the right of the mark, and to
    the left, is enough."""
    reach = np.arange(length - GRAM)
    table, sizes = _table(contexts, 2 * length)
    right, before = grams[:, None] + GRAM + reach, grams[:, None] - 1 - reach
    sides = []
    for at, inside in ((right, right < sizes[:, None]), (before, before >= 0)):
        rows = np.zeros((len(contexts), 8 + len(reach) + 1), np.uint8)
        rows[:, :8] = marks.astype(">u8").view(np.uint8).reshape(-1, 8)
        rows[:, 8:-1] = np.where(inside, np.take_along_axis(table, np.maximum(at, 0), axis=1), 0)
        rows[:, -1] = 1
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        differ = rows[order[1:], :-1] != rows[order[:-1], :-1]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1] - 1) - 8
        most = np.full(len(contexts), -1)
        np.maximum.at(most, order[1:], same)
        np.maximum.at(most, order[:-1], same)
        sides.append(most)
    return (sides[0] >= 0) & (sides[0] + sides[1] + GRAM >= length)


_RUNS = "doc_id long, h long, runs binary"


def _scan(table: pa.Table, length: int) -> pa.Table:
    """Stretches that contexts of the same marks lose, at their places in the documents."""
    marks = table.column("mark").to_numpy().view(np.uint64)
    contexts = table.column("context").to_pylist()
    grams = table.column("gram").to_numpy()
    near = np.flatnonzero(_near(marks, contexts, grams, length))
    near = near[np.argsort(marks[near], kind="stable")]
    ids, starts = table.column("doc_id").to_numpy(), table.column("starts")
    own: list[tuple[int, int, int]] = []
    cuts = [*_starts(marks[near]).tolist(), len(near)] if len(near) else [0]
    begin = 0
    for end in cuts[1:]:  # marks stay whole, and few enough suffixes are sorted together
        if end - begin >= SORTED or end == len(near):
            part = near[begin:end]
            found = covered([contexts[i] for i in part.tolist()], ids[part], length)
            own += [(int(part[c]), x, y) for c, x, y in found]
            begin = end
    rows = []
    for i, x, y in own:
        at = np.array(starts[i].as_py(), np.int64)
        rows.append((i, joined(at + x, at + y).tobytes()))
    index = pa.array([i for i, _ in rows], pa.int64())
    return pa.table(
        {"doc_id": table.column("doc_id").take(index), "h": table.column("h").take(index), "runs": pa.array([r for _, r in rows], pa.binary())}
    )


def _by_string(rows: DataFrame, length: int) -> DataFrame:
    """The same for marks with very many contexts: every string of theirs, its smallest
    document, and what the others lose."""
    strings = rows.select(
        "doc_id", "h", "starts", F.posexplode(
            F.expr(f"transform(sequence(1, length(context) - {length - 1}), i -> substring(context, i, {length}))")
        ).alias("at", "string")
    )
    least = strings.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    lost = strings.join(least.select("string", "least"), "string").where("doc_id > least")
    return lost.select("doc_id", "h", F.explode("starts").alias("start"), "at").groupBy("doc_id", "h").agg(
        F.collect_set(F.col("start") + F.col("at")).alias("at")
    )


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"


def _ended(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its covered stretches."""
    for batch in common.chunks(batches, "text"):
        raw, offsets = common.text_bytes(batch.column("text"))
        out: list[tuple] = []
        for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
            pieces = batch.column("runs")[i].as_py()
            at = batch.column("at")[i].as_py()
            runs = np.frombuffer(b"".join(pieces or []), np.int64).reshape(-1, 2)
            if at:
                at = np.array(at, np.int64)
                runs = np.concatenate((runs, np.stack((at, at + length), axis=1)))
            runs = joined(runs[:, 0], runs[:, 1])
            text, kept, last = raw[a:b].tobytes(), hashlib.sha256(), 0
            for x, y in runs.tolist():
                kept.update(text[last:x])
                last = y
            kept.update(text[last:])
            out.append((len(text), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), kept.hexdigest(), runs.tolist()))
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeats_removed(docs: DataFrame, length: int = LENGTH, many: int = MANY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed (bytes covered by
    strings of ``length`` bytes, at least 17, that a document with a smaller doc_id holds
    too), n_spans (stretches of removed bytes), kept_sha256 (of the other bytes) and
    spans (start and end of each stretch, in bytes).

    A null text is empty; a text shorter than ``length`` loses nothing. Rows that share an
    id take nothing from each other, whether their texts are the same or not, and lose the
    same to smaller ids. A row without id has no order: it loses nothing, and nothing is
    lost to it. Very long texts are gone through one at a time. Other columns are ignored.
    An empty table gives an empty result."""
    path = common.folder(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    texts = rows.where(f"doc_id is not null and octet_length(text) >= {length}")
    seen = texts.agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if seen.n > seen.ids:
        texts = texts.dropDuplicates(["doc_id", "h"])
    # About two marks in as many bytes as a string has grams.
    marks = 2 * (seen.size or 0) / (length - GRAM + 2)
    bits = math.ceil(math.log2(max(1, marks / BUCKET)))

    dealt = texts.mapInArrow(lambda x: _deal(x, bits, length), _DEALT)
    met = dealt.repartition("bucket").sortWithinPartitions("bucket")
    keys = common.stored(met.mapInArrow(lambda x: _meet(x, many), "doc_id long, key long"), f"{path}/keys")
    del dealt, met
    common.let_go(docs.sparkSession)

    wanted = keys.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    cut = texts.join(wanted, "doc_id").select("doc_id", "h", "text", "keys")
    cut = common.stored(cut.mapInArrow(lambda x: _cut(x, length), _CUT), f"{path}/cut")
    del wanted
    common.let_go(docs.sparkSession)

    parts = ("marks", "kinds", "grams", "starts", "contexts")
    listed = cut.select("doc_id", "h", F.explode(F.arrays_zip(*parts)).alias("c")).select(
        "doc_id", "h", *(F.col(f"c.{c}").alias(c[:-1] if c != "starts" else c) for c in parts)
    )
    n = cut.agg(F.sum(F.size("marks"))).first()[0] or 0
    slot = F.pmod(F.xxhash64("mark"), F.lit(max(1, math.ceil(n / SORTED)))).alias("slot")
    scanned = listed.where(F.col("kind") == SCANNED).groupBy(slot).applyInArrow(lambda x: _scan(x, length), _RUNS)
    compared = _by_string(listed.where(F.col("kind") == COMPARED), length)
    found = cut.select("doc_id", "h", "runs").union(scanned).withColumn("at", F.lit(None).cast("array<int>"))
    found = common.stored(found.unionByName(compared, allowMissingColumns=True), f"{path}/found")
    common.let_go(docs.sparkSession)
    lost = found.groupBy("doc_id", "h").agg(
        F.collect_list("runs").alias("runs"), F.flatten(F.collect_list("at")).alias("at")
    )
    return rows.join(lost, ["doc_id", "h"], "left").mapInArrow(lambda x: _ended(x, length), _RESULT)
