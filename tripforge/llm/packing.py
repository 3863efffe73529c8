"""Documents as token sequences of one capacity, packed by Karmarkar-Karp multiway differencing.

Method: a document's ids are cut into full sequences and a rest. The rests of a group are divided among so many windows
by differencing: each starts as a partial partition of its own; the two with the largest imbalance are merged, the
fullest windows of one onto the emptiest of the other, until one partition is left, whose windows are nearly equal.
The count of windows starts at the least that could hold the group and rises whenever a window exceeds the
capacity, by a share ``PADDING`` at most: documents may be cut, so what still exceeds it then is cut off and laid into the
windows that have room.

Texts are encoded once, by the numpy batch; pieces are dealt to groups of about ``GROUP_BYTES`` of text by the place of
their row, so copies and hot sources spread, and one shuffle brings a group's ids to one task. A group is a
small fixed number of sequences; nothing is gathered beyond it.

Defined results: a null text counts as empty; an empty text is its end id alone. Repeated rows are packed each.
A null id is returned as null. An empty table gives no rows. Other columns may have any name. A special token's string in
a text becomes that token, as in the tokenizer's own library.
"""

from __future__ import annotations

import base64
import heapq
import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, steps
from tripforge.llm.bpe import byte_characters

CAPACITY = 2048
#: Text of a group, and what a row counts beside its text, so that groups of tiny texts are bounded too.
GROUP_BYTES, ROW_BYTES = 2 << 20, 64
#: Share of the windows that may be added before items are cut.
PADDING = 0.005
#: The id that ends a document.
END = 1
#: Windows of one group are numbered below this.
_WINDOWS = 1 << 32


class Bytes:
    """A byte-level tokenizer file as a tiktoken encoding, which makes the same ids of it faster.

    A token's rank is its id; the file's merges must be in that order, or it is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        known = spec["normalizer"] is None and split["type"] == "ByteLevel" and not split["add_prefix_space"]
        byte_of = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if not known or merged != sorted(merged):
            raise ValueError(f"not a plain byte-level tokenizer: {path}")
        self.ranks = {b"".join(byte_of[c] for c in token): i for token, i in vocab.items()}
        self.special = special

    def encoding(self):
        import tiktoken

        return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens=self.special)


# How the byte-level pre-tokenizer splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encodings: dict[int, object] = {}


def _encoding(shared):
    """One encoding in each worker and tokenizer."""
    key = shared.value[0]
    if key not in _encodings:
        _encodings.clear()
        _encodings[key] = shared.value[1].encoding()
    return _encodings[key]


class _Partitions:
    """Partial partitions of items: sums in falling order less the least of them, and each window's items as a
    linked list from its head to its tail. Windows without an item are not listed."""

    def __init__(self, sizes: np.ndarray, windows: int):
        self.windows = windows
        self.after = np.full(len(sizes), -1)
        self.heap: list[tuple[int, int]] = []
        self.states: list = []

    def push(self, sums: np.ndarray, head: np.ndarray, tail: np.ndarray) -> None:
        if len(sums) == self.windows:
            sums = sums - sums[-1]
        heapq.heappush(self.heap, (-int(sums[0]), len(self.states)))
        self.states.append((sums, head, tail))

    def pop(self):
        _, number = heapq.heappop(self.heap)
        state, self.states[number] = self.states[number], None
        return state

    def merge(self, one, two) -> None:
        """The fullest windows of one go onto the emptiest of the other."""
        (a, a_head, a_tail), (b, b_head, b_tail) = one, two
        both = max(0, len(a) + len(b) - self.windows)
        left, right = len(a) - both, len(b) - both
        met_head, met_tail = b_head[right:][::-1], b_tail[right:][::-1]
        self.after[a_tail[left:]] = met_head
        sums = np.concatenate([a[:left], a[left:] + b[right:][::-1], b[:right]])
        head = np.concatenate([a_head, b_head[:right]])
        tail = np.concatenate([a_tail[:left], met_tail, b_tail[:right]])
        turn = np.argsort(-sums, kind="stable")
        self.push(sums[turn], head[turn], tail[turn])


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by the largest differencing method.

    While a partition of single items has the largest imbalance and an empty window, it takes the next largest items
    one by one; those that are not smaller than any other partition's imbalance are taken at once.
    """
    order = np.argsort(-sizes, kind="stable")
    single, at = sizes[order], 0
    parts = _Partitions(sizes, windows)

    def take(most: int) -> np.ndarray:
        """The next items: ``most``, but none below the largest imbalance of a partition, and one at least."""
        nonlocal at
        least = -parts.heap[0][0] if parts.heap else -1
        stop = int(np.searchsorted(-single, -least, "right"))
        first, at = at, max(at + 1, min(at + most, stop))
        return order[first:at]

    while at < len(order) or len(parts.heap) > 1:
        largest = -parts.heap[0][0] if parts.heap else -1
        if at < len(order) and single[at] > largest:
            items = take(windows)
            parts.push(sizes[items], items, items)
            continue
        one = parts.pop()
        largest = -parts.heap[0][0] if parts.heap else -1
        if at < len(order) and single[at] >= largest:
            items = take(max(1, windows - len(one[0])))
            parts.merge(one, (sizes[items], items, items))
        else:
            parts.merge(one, parts.pop())
    found = np.empty(len(sizes), np.int64)
    for window, item in enumerate(parts.states[-1][1] if parts.states else ()):
        while item >= 0:
            found[item] = window
            item = parts.after[item]
    return found


def fill(sizes: np.ndarray, capacity: int = CAPACITY, padding: float = PADDING) -> tuple[np.ndarray, ...]:
    """Item, start, length and window of the pieces that items of at most ``capacity`` are packed as."""
    windows = least = -(-int(sizes.sum()) // capacity)
    most = math.floor(least * (1 + padding))
    while True:
        window = differencing(sizes, windows)
        fullest = int(np.bincount(window, sizes).max()) if len(sizes) else 0
        if fullest <= capacity or windows >= most:
            break
        # As many as would have held the fullest one, if it came to that.
        windows = min(most, max(windows + 1, -(-windows * fullest // capacity)))
    # The shortest items of a window come first, so that it is a long one that is cut.
    item = np.lexsort((sizes, window))
    length, window = sizes[item].astype(np.int64), window[item]
    end = np.cumsum(length)
    totals = np.bincount(window, length, windows).astype(np.int64)
    offset = end - length - (np.cumsum(totals) - totals)[window]
    kept = np.clip(capacity - offset, 0, length)
    over, room = length - kept, np.maximum(capacity - totals, 0)
    # What is over and the room that is left, each end to end, are cut at the ends of both.
    over_ends, room_ends = np.cumsum(over), np.cumsum(room)
    total = int(over_ends[-1]) if len(over) else 0
    cuts = np.unique(np.concatenate([[0], over_ends, room_ends[room_ends < total]]).astype(np.int64))
    begins, sizes_cut = cuts[:-1], np.diff(cuts)
    of = np.searchsorted(over_ends, begins, "right")
    start = kept[of] + begins - (over_ends - over)[of]
    stays = kept > 0
    return (
        np.concatenate([item[stays], item[of]]),
        np.concatenate([np.zeros(int(stays.sum()), np.int64), start]),
        np.concatenate([kept[stays], sizes_cut]),
        np.concatenate([window[stays], np.searchsorted(room_ends, begins, "right")]),
    )


def pieces(df: DataFrame, path: str, keep: list[str], text: str, capacity: int) -> DataFrame:
    """The ``keep`` columns as k0.. with row, start, doc_tokens and ids of pieces of at most ``capacity`` ids."""
    spark = df.sparkSession
    tokenizer = Bytes(path)
    # Of the size of the tokenizer's file.
    shared = spark.sparkContext.broadcast((base64.b64encode(path.encode()), tokenizer))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = bound_batches(df).select(*kept, F.monotonically_increasing_id().alias("row"), own.alias("text"))
    place = len(keep) + 1
    made = [
        T.StructField("start", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    schema = T.StructType([*source.schema.fields[:place], *made])

    def run(batches):
        encoding = _encoding(shared)
        for batch in batches:
            for step in steps(batch, place):
                rows, starts, sizes, ids = [], [], [], []
                for row, own_text in enumerate(step.column(place).to_pylist()):
                    found = np.append(encoding.encode_to_numpy(own_text, allowed_special="all"), END).astype("<u4")
                    for at in range(0, len(found), capacity):
                        rows.append(row)
                        starts.append(at)
                        sizes.append(len(found))
                        ids.append(found[at : at + capacity].tobytes())
                taken = step.select(range(place)).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def pack(
    df: DataFrame,
    path: str,
    keep: list[str],
    text: str = "text",
    capacity: int = CAPACITY,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Of every piece the ``keep`` columns, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset."""
    weight = F.octet_length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))) + ROW_BYTES
    total = df.agg(F.sum(weight.cast("long")).alias("bytes")).first()["bytes"] or 0
    groups = max(1, round(total / group_bytes))
    cut = pieces(df, path, keep, text, capacity)
    place = len(keep)
    schema = T.StructType(
        [
            *cut.schema.fields[:place],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def place_group(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("row", "ascending"), ("start", "ascending")])
        raw = table.column("ids").to_pylist()
        sizes = np.array([len(r) // 4 for r in raw], np.int64)
        full, rests = np.flatnonzero(sizes == capacity), np.flatnonzero(sizes < capacity)
        item, start, length, window = fill(sizes[rests], capacity)
        # Full pieces are windows of their own, after those of the rests.
        item = np.concatenate([rests[item], full])
        start = np.concatenate([start, np.zeros(len(full), np.int64)])
        length = np.concatenate([length, sizes[full]])
        window = np.concatenate([window, np.arange(len(full)) + (window.max() + 1 if len(window) else 0)])
        order = np.lexsort((start, item, window))
        item, start, length, window = (x[order] for x in (item, start, length, window))
        # Pieces that follow each other in one window are one.
        follows = np.zeros(len(item), bool)
        follows[1:] = (item[1:] == item[:-1]) & (window[1:] == window[:-1]) & (start[1:] == (start + length)[:-1])
        first = np.flatnonzero(~follows)
        length = np.add.reduceat(length, first) if len(first) else length
        item, start, window = item[first], start[first], window[first]
        before = np.cumsum(length) - length
        opens = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])) if len(window) else []
        offset = before - np.repeat(before[opens], np.diff(np.append(opens, len(window)))) if len(window) else before
        taken = table.take(pa.array(item))
        group = table.column("group")[0].as_py()
        ids = [raw[i][4 * a : 4 * (a + n)] for i, a, n in zip(item, start, length)]
        return pa.Table.from_arrays(
            [
                *taken.columns[:place],
                pa.array(taken.column("start").to_numpy() + start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(ids, pa.binary()),
                taken.column("doc_tokens"),
                pa.array(group * _WINDOWS + window, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            names=schema.names,
        )

    # By the row's place and the piece's, not by content: equal rows go to different groups.
    group = F.pmod(F.xxhash64("row", "start"), F.lit(groups)).alias("group")
    grouped = cut.select("*", group).groupBy("group").applyInArrow(place_group, schema)
    return grouped.toDF(*keep, *schema.names[place:])
