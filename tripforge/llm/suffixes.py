"""Repeated byte strings: every byte that a string of ``LENGTH`` bytes covers which also starts earlier is removed.

"Earlier" is the order of (document id, start). Strings are judged on the input and do not cross documents.

Method. All strings of ``LENGTH`` bytes (windows) with the same content share their anchor, the least hash among
their ``GRAM``-byte strings. So neighbouring windows with one anchor form a segment, and segments, about one in
35 windows, stand for all suffixes:

1. A task takes some megabytes of documents, builds prefix polynomial hashes of their bytes, and sorts the
   suffixes that start at segments with a repeated anchor. It is a mergesort whose comparisons find the common
   extension of two suffixes by binary search on the prefix hashes, then compare one byte. Neighbours that are equal
   over their whole segment are compared byte by byte (collision verification); all but the earliest are removed at once.
2. What remains is shuffled by the anchor's hash. Segments with equal anchor and content (128 bits of hash) have
   all windows in common: all but the earliest are removed. A segment that shares its anchor, and the
   bytes on one side of it, with another one may share some windows: it is passed on.
3. The windows of those are taken from the documents, one by one, and shuffled by their hash (96 bits); all but the
   earliest of equal windows are removed. Equal windows in one task are combined before.
4. The removed stretches of a document are gathered, merged and cut out.

A complete suffix array of all bytes, shuffled, would be a hundred times the input; segments are about as large as the
input. Equality between tasks rests on those hashes, since the other task's bytes are not at hand; within a
task it is verified.

Hot keys. Copies in one task leave one row. Anchors that a sample (``SAMPLE_ROWS`` rows) finds in over ``HOT_SHARE``
of the documents, such as a line in a third of them with other text around, skip step 2: their windows go to
step 3, where they are spread by their whole content.

Defined results: a null text has no bytes and counts as empty. Null ids come last in the order. Rows that repeat an id
with another text are documents of their own, in the order of a hash of the text; rows that repeat both are one document,
and each gets its result. Texts under ``LENGTH`` bytes lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, dropping_shuffles, steps, utf8
from tripforge.llm.hashing import between, byte_hashes, mix, prefix_hashes, seeds
from tripforge.staging import stage

LENGTH, GRAM = 100, 32
SAMPLE_ROWS, HOT_SHARE = 20_000, 0.01
STEP = 1 << 20
#: Bytes of an Arrow batch: several steps, so that few of them are cut short.
BATCH = 8 << 20

_U = np.uint64
_LAST_ID = (1 << 63) - 1
_SPREAD = LENGTH - GRAM + 1  # windows that can share an anchor
_SIDE = (LENGTH - GRAM) // 2  # a shared window shares so many bytes on one side of the anchor
_HIGH = _U(0xFFFFFFFF00000000)
_OTHER_BYTES = seeds(256, 21)

# What a row of step 1 stands for.
_SEGMENT, _REMOVED, _ASKED = 0, 1, 2
_ROWS = "route long, content long, id long, tie long, meta long"
_SPANS = "id long, tie long, first int, last int, asked boolean"


# --- suffixes within one task -----------------------------------------------------------------------------------


class Suffixes:
    """Comparison of suffixes, given by start and length, of one byte string."""

    def __init__(self, data: np.ndarray, sums: np.ndarray):
        self.data, self.sums = data, sums

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common extension, ``limit`` at most, by binary search on the prefix hashes."""
        found = np.zeros(len(a), np.int64)
        bit = 1 << int(limit.max(initial=0)).bit_length()
        while bit:
            tried = found + bit
            fits = tried <= limit
            tried = np.where(fits, tried, found)
            same = between(self.sums, a, a + tried) == between(self.sums, b, b + tried)
            found = np.where(fits & same, tried, found)
            bit >>= 1
        return found

    def less(self, a, a_length, b, b_length, or_equal: bool) -> np.ndarray:
        shorter = np.minimum(a_length, b_length)
        same = self.common(a, b, shorter)
        last = len(self.data) - 1
        by_byte = self.data[np.minimum(a + same, last)] < self.data[np.minimum(b + same, last)]
        by_length = (a_length <= b_length) if or_equal else (a_length < b_length)
        return np.where(same < shorter, by_byte, by_length)

    def order(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Stable mergesort: all runs of one width are merged at once.

        An element's place in a merged run is its place in its own run plus the number of the other
        run's elements before it, which a binary search finds.
        """
        n = len(starts)
        order = np.arange(n)
        width = 1
        while width < n:
            place = np.arange(n)
            run = place // width
            right = run % 2 == 1
            other = np.where(right, run - 1, run + 1) * width
            low, high = np.minimum(other, n), np.minimum(other + width, n)
            begin = low.copy()
            own, own_length = starts[order], lengths[order]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) // 2
                one, two = own[mid], own[open_]
                before = np.empty(len(open_), bool)
                for side in (False, True):
                    # Of equal elements those of the left run come first.
                    at = np.flatnonzero(right[open_] == side)
                    before[at] = self.less(one[at], own_length[mid[at]], two[at], own_length[open_[at]], or_equal=side)
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            merged = (run // 2) * 2 * width + place % width + (low - begin)
            order[merged] = order.copy()
            width *= 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether the bytes themselves agree."""
        same = np.ones(len(a), bool)
        last = len(self.data) - 1
        for i in range(int(lengths.max(initial=0))):
            inside = i < lengths
            same &= ~inside | (self.data[np.minimum(a + i, last)] == self.data[np.minimum(b + i, last)])
        return same


def anchors(sums: np.ndarray, offsets: np.ndarray):
    """Of every segment: document, first window, number of windows, anchor, hash of the anchor."""
    size = int(offsets[-1])
    grams = size - GRAM + 1
    empty = np.zeros(0, np.int64)
    if size < LENGTH:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    at = np.arange(grams)
    hashes = mix(between(sums, at, at + GRAM))
    keys = (hashes & _HIGH) | at.astype(np.uint64)
    # Least key of every _SPREAD neighbours, from running minima of blocks, forwards and backwards.
    blocks = -(-grams // _SPREAD)
    grid = np.full(blocks * _SPREAD, ~_U(0))
    grid[:grams] = keys
    grid = grid.reshape(blocks, _SPREAD)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = size - LENGTH + 1
    least = np.minimum(back[:windows], ahead[_SPREAD - 1 : _SPREAD - 1 + windows])
    anchor = (least & ~_HIGH).astype(np.int64)
    lengths = np.diff(offsets)
    document = np.repeat(np.arange(len(lengths)), lengths)[:windows]
    inside = np.arange(windows) + LENGTH <= offsets[1:][document]
    new = np.ones(windows, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, windows))
    kept = inside[first]
    first, count = first[kept], count[kept]
    anchor = anchor[first]
    return document[first], first, count, anchor, hashes[anchor]


def _repeats_within(suffixes: Suffixes, first, length, hashes) -> np.ndarray:
    """A number for every segment, equal for segments with equal bytes."""
    classes = np.arange(len(first))
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(counts[inverse] > 1)
    if not len(chosen):
        return classes
    chosen = chosen[suffixes.order(first[chosen], length[chosen])]
    a, b = chosen[:-1], chosen[1:]
    near = np.flatnonzero(length[a] == length[b])
    near = near[suffixes.common(first[a[near]], first[b[near]], length[a[near]]) == length[a[near]]]
    near = near[suffixes.verified(first[a[near]], first[b[near]], length[a[near]])]
    joined = np.zeros(len(chosen), bool)
    joined[near + 1] = True
    leaders = chosen[np.flatnonzero(~joined)]
    classes[chosen] = leaders[np.cumsum(~joined) - 1]
    return classes


def _earliest(group: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row order by group and ``order``, and of each row in it the place of its group's first."""
    rows = np.lexsort((*order[::-1], group))
    new = np.ones(len(rows), bool)
    new[1:] = group[rows][1:] != group[rows][:-1]
    return rows, np.flatnonzero(new)[np.cumsum(new) - 1]


def _pack(first, count, off, left, right) -> np.ndarray:
    packed = first.astype(np.int64) << 32
    return packed | count.astype(np.int64) << 25 | off.astype(np.int64) << 18 | left << 9 | right


def _segments_of(ids, ties, texts: pa.Array, hot: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of step 1 for some documents."""
    data, offsets = utf8(texts)
    sums = byte_hashes(data)
    document, first, count, anchor, hashes = anchors(sums, offsets)
    length = count + LENGTH - 1
    rank = np.empty(len(ids), np.int64)
    ranked = np.lexsort((ties, ids))
    same = np.ones(len(ids), bool)
    same[1:] = (ids[ranked][1:] != ids[ranked][:-1]) | (ties[ranked][1:] != ties[ranked][:-1])
    rank[ranked] = np.cumsum(same)
    start = first - offsets[document]

    classes = _repeats_within(Suffixes(data, sums), first, length, hashes)
    rows, leader = _earliest(classes, rank[document], start)
    lead = rows[leader]
    later = (rank[document[rows]] > rank[document[lead]]) | (start[rows] > start[lead])
    removed, kept = rows[later], np.unique(lead)

    off = anchor - first
    left, right = off >= _SIDE, off - count + 1 <= LENGTH - GRAM - _SIDE
    sides = []
    for there, begin in ((left, anchor - _SIDE), (right, anchor + GRAM)):
        begin = np.where(there, begin, 0)
        value = mix(between(sums, begin, np.where(there, begin + _SIDE, 0))) & _U(511)
        sides.append(value.astype(np.int64))
    meta = _pack(start, count, off, *sides)
    content = mix(between(sums, first, first + length) * _U(0xD6E8FEB86659FD93) + length.astype(np.uint64))
    is_hot = np.isin(hashes[kept], hot)
    asked, kept = kept[is_hot], kept[~is_hot]
    picked = np.concatenate([kept, removed, asked])
    kind = np.repeat([_SEGMENT, _REMOVED, _ASKED], [len(kept), len(removed), len(asked)])
    # Rows that are already decided are spread by their own place, and marked by an anchor's place
    # beyond any other: 126 if removed, 127 if asked.
    decided = _pack(start, count, np.full(len(start), 126), *sides)
    own = mix(ties[document[picked]].view(np.uint64) + start[picked].astype(np.uint64))
    return {
        "route": np.where(kind == _SEGMENT, hashes[picked], own).view(np.int64),
        "content": np.where(kind == _SEGMENT, content[picked], kind.astype(np.uint64)).view(np.int64),
        "id": ids[document[picked]],
        "tie": ties[document[picked]],
        "meta": np.where(kind == _SEGMENT, meta[picked], decided[picked] + ((kind == _ASKED).astype(np.int64) << 18)),
    }


def _spans(id_, tie, first, last, asked) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(id_, pa.int64()), pa.array(tie, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(asked, pa.bool_())],
        names=["id", "tie", "first", "last", "asked"],
    )


def _columns(batches: Iterator[pa.RecordBatch], n: int) -> list[np.ndarray]:
    """The whole partition, as arrays."""
    held = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
    return [np.concatenate([h[i] for h in held]) if held else np.zeros(0, np.int64) for i in range(n)]


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 for the anchors of one partition."""
    route, content, id_, tie, meta = _columns(batches, 5)
    first, count = meta >> 32, (meta >> 25) & 127
    off, left, right = (meta >> 18) & 127, (meta >> 9) & 511, meta & 511
    decided = off >= 126
    asked = decided & (off == 127)
    yield _spans(id_[decided], tie[decided], first[decided], (first + count)[decided], asked[decided])

    at = np.flatnonzero(~decided)
    group = np.unique(np.column_stack([route[at], content[at]]), axis=0, return_inverse=True)[1].ravel() if len(at) else at
    rows, leader = _earliest(group, id_[at], tie[at], first[at])
    rows, lead = at[rows], at[rows[leader]]
    later = (id_[rows] != id_[lead]) | (tie[rows] != tie[lead]) | (first[rows] != first[lead])
    yield _spans(id_[rows[later]], tie[rows[later]], first[rows[later]], (first + count)[rows[later]], np.zeros(later.sum(), bool))

    # Of the earliest of each content: those that share a side with another one.
    lead = np.unique(lead)
    wanted = np.zeros(len(lead), bool)
    has_left = off[lead] >= _SIDE
    has_right = off[lead] - count[lead] + 1 <= LENGTH - GRAM - _SIDE
    for there, side in ((has_left, left), (has_right, right)):
        own = np.flatnonzero(there)
        order = own[np.lexsort((side[lead[own]], route[lead[own]]))]
        equal = (route[lead[order]][1:] == route[lead[order]][:-1]) & (side[lead[order]][1:] == side[lead[order]][:-1])
        wanted[order[1:][equal]] = True
        wanted[order[:-1][equal]] = True
    lead = lead[wanted]
    yield _spans(id_[lead], tie[lead], first[lead], (first + count)[lead], np.ones(len(lead), bool))


# --- windows ------------------------------------------------------------------------------------------------------

_WINDOWS = "route long, other int, id long, tie long, first int"


def _windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, first half: the asked windows of documents, equal ones of a task's step combined."""
    for batch in batches:
        for step in steps(batch, 2, STEP):
            data, offsets = utf8(step.column(2))
            lists = step.column("spans")
            spans = lists.flatten()
            document = np.repeat(np.arange(len(step)), np.diff(lists.offsets.to_numpy()))
            first, last = (spans.field(i).to_numpy().astype(np.int64) + offsets[document] for i in (0, 1))
            n = last - first
            row = np.repeat(document, n)
            start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            route = mix(between(byte_hashes(data), start, start + LENGTH))
            other = mix(between(prefix_hashes(_OTHER_BYTES[data]), start, start + LENGTH)).astype(np.uint32)
            id_, tie = (step.column(i).to_numpy()[row] for i in (0, 1))
            place = start - offsets[row]
            order = np.lexsort((place, tie, id_, other, route))
            new = np.ones(len(order), bool)
            new[1:] = (route[order][1:] != route[order][:-1]) | (other[order][1:] != other[order][:-1])
            lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
            later = (id_[order] != id_[lead]) | (tie[order] != tie[lead]) | (place[order] != place[lead])
            picked = np.concatenate([order[new], order[later]])
            done = np.repeat([False, True], [new.sum(), later.sum()])
            # In the order of the documents, so that their ids and places compress.
            straight = np.argsort(picked)
            picked, done = picked[straight], done[straight]
            # A removed window is spread by its place and marked by a start below zero.
            own = mix(tie[picked].view(np.uint64) + place[picked].astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(done, own, route[picked]).view(np.int64)),
                    pa.array(other[picked].view(np.int32)),
                    pa.array(id_[picked]),
                    pa.array(tie[picked]),
                    pa.array(np.where(done, ~place[picked], place[picked]), pa.int32()),
                ],
                names=["route", "other", "id", "tie", "first"],
            )


def _repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, second half: all but the earliest of equal windows, neighbours joined."""
    route, other, id_, tie, first = _columns(batches, 5)
    done = first < 0
    first = np.where(done, ~first, first)
    at = np.flatnonzero(~done)
    order = at[np.lexsort((first[at], tie[at], id_[at], other[at], route[at]))]
    new = np.ones(len(order), bool)
    new[1:] = (route[order][1:] != route[order][:-1]) | (other[order][1:] != other[order][:-1])
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    later = (id_[order] != id_[lead]) | (tie[order] != tie[lead]) | (first[order] != first[lead])
    gone = np.concatenate([np.flatnonzero(done), order[later]])
    yield _spans(id_[gone], tie[gone], first[gone], first[gone] + 1, np.zeros(len(gone), bool))


# --- documents -----------------------------------------------------------------------------------------------------


def merge_spans(firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the windows that start in [first, last)."""
    order = np.argsort(firsts, kind="stable")
    begin, end = firsts[order], np.maximum.accumulate((lasts + LENGTH - 1)[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(begin)) - 1
    return begin[heads], end[tails]


def _whole_characters(raw: bytes, begin: int, end: int) -> tuple[int, int]:
    """The stretch without the characters that it holds only a part of."""
    while begin < end and raw[begin] & 0xC0 == 0x80:
        begin += 1
    while begin < end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end


def _keyed(df: DataFrame, id_column: str, text: str, keep: list[str]) -> DataFrame:
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    carried = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("carried")] if keep else []
    return df.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.shiftrightunsigned(F.xxhash64(own), 33).alias("tie"),
        own.alias("text"),
        *carried,
    )


def _hot_anchors(documents: DataFrame) -> np.ndarray:
    """Anchors' hashes that over ``HOT_SHARE`` of sampled documents hold: a bounded number."""
    total, share = documents.count(), 1_000_000
    sample = documents.where(F.pmod(F.xxhash64("id", "tie", F.lit("s")), F.lit(share)) < min(share, SAMPLE_ROWS * share // max(total, 1)))

    def run(batches):
        for batch in batches:
            for step in steps(batch, 0, STEP):
                data, offsets = utf8(step.column(0))
                document, *_, hashes = anchors(byte_hashes(data), offsets)
                pairs = np.unique(np.column_stack([hashes, document.astype(np.uint64)]), axis=0)
                found, n = np.unique(pairs[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    counts = bound_batches(sample, BATCH).select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    least = max(20, int(min(total, SAMPLE_ROWS) * HOT_SHARE))
    return counts.where(F.col("n") >= least).select("anchor").toPandas()["anchor"].to_numpy(np.int64).view(np.uint64)


def find_repeats(documents: DataFrame) -> DataFrame:
    """(id, tie, first, last): windows that start in [first, last) start earlier elsewhere, too.

    ``documents`` has id, tie and text, as made by ``_keyed``.
    """
    hot = documents.sparkSession.sparkContext.broadcast(_hot_anchors(documents))

    def segments(batches):
        for batch in batches:
            for step in steps(batch, 2, STEP):
                rows = _segments_of(*(step.column(i).to_numpy() for i in (0, 1)), step.column(2), hot.value)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows.values()], names=list(rows))

    rows = bound_batches(documents, BATCH).mapInArrow(segments, _ROWS)
    with dropping_shuffles(documents.sparkSession):
        resolved = stage(rows.repartition("route").mapInArrow(_resolve, _SPANS), "repeats")
    asked = resolved.where("asked").groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    windows = documents.join(asked, ["id", "tie"]).mapInArrow(_windows_of, _WINDOWS)
    more = windows.repartition("route").mapInArrow(_repeated_windows, _SPANS)
    return resolved.where("NOT asked").union(more).drop("asked")


def cut(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    keep: list[str] = (),
    whole_characters: bool = False,
) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row, and the columns of ``keep`` in a struct ``carried``.

    ``spans`` are the maximal [first, last) runs of removed bytes and ``kept`` the other bytes, joined. With
    ``whole_characters`` a run leaves the characters that it would split, so ``kept`` is valid UTF-8.
    """
    documents = _keyed(df, id_column, text, list(keep))
    # A document's runs are at most as many as its bytes.
    gone = find_repeats(documents).groupBy("id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("gone"))

    def run(batches):
        for batch in batches:
            sizes, spans, kept = [], [], []
            for value, lists in zip(batch.column(2), batch.column(3)):
                raw = value.as_py().encode()
                own: list[list[int]] = []
                if lists.is_valid:
                    both = lists.values
                    first, last = merge_spans(*(both.field(i).to_numpy().astype(np.int64) for i in (0, 1)))
                    own = [[int(a), int(b)] for a, b in zip(first, last)]
                    if whole_characters:
                        own = [[a, b] for a, b in (_whole_characters(raw, *s) for s in own) if a < b]
                sizes.append(len(raw))
                spans.append(own)
                ends = [0, *(b for _, b in own)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in own), len(raw)])))
            made = [
                pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[4:]], names=schema.names)

    joined = bound_batches(documents, BATCH).join(gone, ["id", "tie"], "left")
    carried = ["carried"] if keep else []
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept", T.BinaryType()),
            *[joined.schema[c] for c in carried],
        ]
    )
    found = joined.select("id", "tie", "text", "gone", *carried).mapInArrow(run, schema)
    return found.withColumn("id", F.when(F.col("id") != _LAST_ID, F.col("id")))


def drop_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows, with the repeated bytes cut out of their texts at whole characters.

    A text that is all repeats becomes empty; a null text stays null.
    """
    columns = df.columns
    names = [f"c{i}" for i in range(len(columns))]
    place = dict(zip(columns, names))
    plain = df.toDF(*names).withColumn("missing", F.col(place[text]).isNull())
    others = [n for n in names if n != place[text]]
    # The text itself is carried once, as the operator's own column.
    found = cut(plain, place[id_column], place[text], [*others, "missing"], whole_characters=True)
    kept = F.when(~F.col("carried.missing"), F.decode("kept", "UTF-8"))
    return found.select(
        *[kept.alias(n) if n == place[text] else F.col(f"carried.{n}").alias(n) for n in names]
    ).toDF(*columns)
