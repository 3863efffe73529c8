r"""Benchmark decontamination: broadcast windows of test items, looked up in every document.

Method: the 13-word windows of the benchmark items are hashed and broadcast as a sorted set.
A task reads a document's words as bytes, takes the hash of each of its own windows from prefix
hashes, and looks it up; a hit counts only when the words themselves agree. Every document word
inside an occurring window is hit.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text (or one item), by a check of its size. A
benchmark of one block is broadcast and looked up in one pass over the documents, none of which is shuffled. A larger
one takes a pass over the texts for each block, of which only the hits are written, by the text's digest; a last pass counts
words and joins the hits to their documents. So it costs more passes and never more memory.

Defined results: a null or word-less text has no words, no hit and is not contaminated; an item that
is null or without words has no window; repeated items and equal items each count as an item, repeated
document rows each get their row; a null item_id is left out of the item list, but its windows hit.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, map_texts, utf8
from tripforge.llm.hashing import ALNUM, Words, between, lower_ascii, mix, prefix_hashes
from tripforge.staging import broadcast_if_small, stage

WINDOW_WORDS = 13
#: A document is contaminated if it has a hit and at least one in so many of its words is hit.
HIT_SHARE = 20
BLOCK_BYTES = 4 << 20
_FILTER_BITS = 20


def _words(texts: pa.Array) -> Words:
    data, offsets = utf8(texts)
    return Words(lower_ascii(data), offsets, ALNUM)


@dataclass
class _Windows:
    """The windows of a block of items, by number of words."""

    items: dict[int, dict[bytes, list[int]]] = field(default_factory=lambda: defaultdict(dict))
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    filters: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, item_id, text: str, size: int) -> None:
        words = _words(pa.array([text]))
        n = int(words.counts[0])
        if not n:
            return
        length = min(size, n)
        for start in range(n - length + 1):
            ids = self.items[length].setdefault(words.text(start, start + length), [])
            if item_id is not None and item_id not in ids:
                ids.append(item_id)

    def close(self) -> _Windows:
        for length, windows in self.items.items():
            texts = pa.array([w.decode() for w in windows])
            words = _words(texts)
            found = np.unique(between(prefix_hashes(words.hashes()), words.first[:-1], words.first[1:]))
            self.hashes[length] = found
            self.filters[length] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[length][mix(found) >> np.uint64(64 - _FILTER_BITS)] = True
        self.items = dict(self.items)
        return self

    def scan(self, words: Words, sums: np.ndarray):
        """Row, first word and items of every occurring window; spans in words come with it."""
        row_ends = np.repeat(words.first[1:], words.counts)
        for length, known in self.hashes.items():
            starts = np.flatnonzero(np.arange(len(row_ends)) + length <= row_ends)
            found = between(sums, starts, starts + length)
            maybe = self.filters[length][mix(found) >> np.uint64(64 - _FILTER_BITS)]
            starts, found = starts[maybe], found[maybe]
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            for start in starts[known[place] == found]:
                items = self.items[length].get(words.text(start, start + length))
                if items is not None:
                    yield int(start), length, items


def _blocks(benchmark: DataFrame, item_id: str, text: str, size: int, block_bytes: int):
    """Windows of the items, in blocks of bounded text size; the driver holds one at a time."""
    rows = bound_batches(benchmark).select(F.col(f"`{item_id}`"), F.col(f"`{text}`").cast("string"))
    block, held = _Windows(), 0
    for item, words in rows.where(F.col(f"`{text}`").isNotNull()).toLocalIterator():
        if held and held + len(words) > block_bytes:
            yield block.close()
            block, held = _Windows(), 0
        block.add(item, words, size)
        held += len(words)
    yield block.close()


def find_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window_words: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``keep`` columns of every document with n_words, hit_spans and item_ids.

    ``hit_spans`` are [first, last) word numbers of the windows found, ``item_ids`` the sorted
    items, as strings, that they belong to.
    """
    spark = documents.sparkSession
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("new_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("new_items", T.ArrayType(T.StringType())),
    ]

    def lookup(block: _Windows):
        shared = spark.sparkContext.broadcast(block)

        def compute(texts: pa.Array) -> list[pa.Array]:
            words = _words(texts)
            sums = prefix_hashes(words.hashes())
            spans: list[list] = [[] for _ in range(len(texts))]
            items: list[set] = [set() for _ in range(len(texts))]
            for start, length, found in shared.value.scan(words, sums):
                row = int(np.searchsorted(words.first, start, "right")) - 1
                begin = start - int(words.first[row])
                spans[row].append([begin, begin + length])
                items[row].update(map(str, found))
            return [
                pa.array(words.counts, pa.int64()),
                pa.array([sorted(s) for s in spans], pa.list_(pa.list_(pa.int64()))),
                pa.array([sorted(i) for i in items], pa.list_(pa.string())),
            ]

        return compute

    kept = [f"k{i}" for i in range(len(keep))]
    own = F.col(f"`{text}`").cast("string")
    source = documents.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)], own.alias("text"))
    blocks = _blocks(benchmark, item_id, item_text, window_words, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        found = map_texts(source, kept, "text", fields, lookup(first))
        spans, items = F.col("new_spans"), F.col("new_items")
    else:
        digest = F.unhex(F.md5("text"))
        hits = None
        for block in chain((first, second), blocks):
            some = map_texts(source.withColumn("digest", digest), ["digest"], "text", fields, lookup(block))
            some = some.where(F.size("new_spans") > 0).drop("n_words").dropDuplicates(["digest"])
            hits = stage(some, "hits") if hits is None else hits.union(stage(some, "hits"))
        # A text has one row a block at most.
        both = {c: F.flatten(F.collect_list(c)).alias(c) for c in ("new_spans", "new_items")}
        hits = stage(hits.groupBy("digest").agg(*both.values()), "all-hits")
        counted = map_texts(
            source.withColumn("digest", digest),
            [*kept, "digest"],
            "text",
            fields[:1],
            lambda texts: [pa.array(_words(texts).counts, pa.int64())],
        )
        found = counted.join(broadcast_if_small(hits), "digest", "left")
        spans = F.coalesce("new_spans", F.array().cast(fields[1].dataType))
        items = F.coalesce("new_items", F.array().cast(fields[2].dataType))
    return found.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)],
        "n_words",
        F.array_sort(spans).alias("hit_spans"),
        F.array_sort(F.array_distinct(items)).alias("item_ids"),
    )


def judge(documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """Hits with n_hit, n_items and the verdict contaminated."""
    found = find_hits(documents, benchmark, keep, text, **options)
    # A running end makes each span count only what earlier spans left uncovered.
    covered = F.aggregate(
        "hit_spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s[1] - F.greatest(s[0], a["reach"]))).alias("n"),
            F.greatest(s[1], a["reach"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    return found.withColumn("n_hit", covered).withColumns(
        {
            "n_items": F.size("item_ids").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words")),
        }
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, whole and with all their columns."""
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    judged = judge(documents.toDF(*names), benchmark, names, names[columns.index(text)])
    return judged.where(~F.col("contaminated")).select(*names).toDF(*columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All documents, each without the stretches of its text that occurring windows cover."""
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    place = names[columns.index(text)]
    found = find_hits(documents.toDF(*names), benchmark, names, place)

    def compute(texts: pa.Array, spans: pa.Array) -> pa.Array:
        words, out = _words(texts), []
        _, offsets = utf8(texts)
        for row, (value, cut) in enumerate(zip(texts.to_pylist(), spans.to_pylist())):
            raw, at, pieces = (value or "").encode(), 0, []
            for first, last in cut:
                begin = int(words.starts[words.first[row] + first] - offsets[row])
                end = int(words.ends[words.first[row] + last - 1] - offsets[row])
                pieces.append(raw[at : max(at, begin)])
                at = max(at, end)
            out.append(None if value is None else b"".join([*pieces, raw[at:]]).decode())
        return pa.array(out, pa.string())

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([compute(batch.column(0), batch.column(1)), *batch.columns[2:]], names=order)

    order = [place, *[n for n in names if n != place]]
    rest = found.select(F.col(place).cast("string"), F.col("hit_spans"), *order[1:])
    schema = T.StructType([T.StructField(place, T.StringType()), *[found.schema[n] for n in order[1:]]])
    return rest.mapInArrow(run, schema).select(*names).toDF(*columns)
