"""Fill-in-the-middle documents, cut at lines that a learned rank index finds.

Method: the ends of all lines of the texts at hand, in bytes one text after another, are a sorted list. The index fits it
with straight segments, each as long as one slope keeps every point of it within ``ERROR`` bytes (a cone of slopes
that each point narrows), and stores what the prediction is off by as one small number for each line. The place of
the cut after so many lines is then its segment's prediction plus its residual: exact. Segments are found by
binary search, cuts are looked up all at once, and Spark holds the index for one step of texts at a time.

A document of n lines (``[^\n]*\n|[^\n]+``) is cut after the smaller and the larger of two draws from its id, of 0 to n
lines each, into prefix, middle and suffix. The output joins them by marks, as prefix-suffix-middle or
suffix-prefix-middle; ``restore`` reads the marks back.

Defined results: a null text counts as empty. An empty text, one that holds a mark, and one not drawn for the
transformation stay as they are (form ``plain``, null lengths). A null id draws as an empty one. Repeated rows are
cut each, alike if their ids are. A text is worked on whole, whatever its length. Other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, steps, utf8

#: Bytes that a prediction may be off by, so that a residual takes two bytes.
ERROR = 1024
SEED = "7"
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_NEWLINE = 10


@dataclass
class RankIndex:
    """Sorted whole numbers by rank, as segments of bounded error and their residuals."""

    first: np.ndarray  # rank that each segment starts at
    base: np.ndarray  # number there
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, numbers: np.ndarray, error: int = ERROR) -> RankIndex:
        first, base, slope = [], [], []
        at, ahead = 0, 64
        while at < len(numbers):
            # Slopes that keep every point so far within the error; a longer stretch is tried while all fit.
            while True:
                rise = numbers[at + 1 : at + 1 + ahead] - numbers[at]
                run = np.arange(1, len(rise) + 1)
                low = np.maximum.accumulate((rise - error) / run)
                high = np.minimum.accumulate((rise + error) / run)
                outside = np.flatnonzero(low > high)
                if len(outside) or at + 1 + ahead >= len(numbers):
                    break
                ahead *= 2
            taken = int(outside[0]) if len(outside) else len(rise)
            first.append(at)
            base.append(numbers[at])
            slope.append((low[taken - 1] + high[taken - 1]) / 2 if taken else 0.0)
            at += taken + 1
            ahead = max(64, taken)
        found = cls(np.array(first, np.int64), np.array(base, np.int64), np.array(slope), np.zeros(len(numbers), np.int16))
        residual = numbers - found._predict(np.arange(len(numbers)))
        found.residual = residual.astype(np.min_scalar_type(-1 - int(np.abs(residual).max(initial=0))))
        return found

    def _predict(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.base[segment] + np.rint(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def at(self, ranks: np.ndarray) -> np.ndarray:
        """The numbers of these ranks."""
        return self._predict(ranks) + self.residual[ranks]


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where texts and their lines end, after 0; and of each text the rank of its start, one more at the end.

    ``data`` holds the texts one after another. Every text, empty ones too, has its own start in the list.
    """
    breaks = np.flatnonzero(data == _NEWLINE) + 1
    # A break that ends its text is the text's end; the others lie within one.
    inner = breaks[~np.isin(breaks, offsets[1:])] if len(breaks) else breaks
    within = np.searchsorted(inner, offsets)
    ranks = within + np.arange(len(offsets))
    # An empty text ends where it starts: it has no line, though a rank of its own.
    bounds = np.empty(len(inner) + len(offsets), np.int64)
    bounds[ranks] = offsets
    lines = np.ones(len(bounds), bool)
    lines[ranks] = False
    bounds[lines] = inner
    return bounds, ranks


def draws(id_column: str, seed: str = SEED) -> list[Column]:
    """Four whole numbers below 2**32 from the hash of the seed and the id."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(
    df: DataFrame,
    keep: list[str],
    id_column: str = "doc_id",
    text: str = "text",
    seed: str = SEED,
    rate: int = 100,
    spm_rate: int = 50,
) -> DataFrame:
    """The ``keep`` columns of every row with n, form, prefix_chars, middle_chars and output.

    ``rate`` of a hundred documents are transformed, ``spm_rate`` of those with the suffix first.
    """
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(own, F.lit(mark))
    h1, h2, h3, h4 = draws(id_column, seed)
    plain = (F.octet_length(own) == 0) | marked | (h3 % 100 >= rate)
    source = df.select(*kept, h1, h2, plain.alias("plain"), (h4 % 100 < spm_rate).alias("spm"), own.alias("text"))
    place = len(keep)
    made = T.StructType(
        [
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )
    schema = T.StructType([*source.schema.fields[:place], *made.fields])

    def run(batches):
        for batch in batches:
            for step in steps(batch, place + 4):
                drawn = [c.to_numpy(zero_copy_only=False) for c in step.columns[place : place + 4]]
                yield pa.RecordBatch.from_arrays(
                    [*step.columns[:place], *_cut(step.column(place + 4), *drawn)], names=schema.names
                )

    return bound_batches(source).mapInArrow(run, schema).toDF(*keep, *made.names)


def _cut(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, plain: np.ndarray, spm: np.ndarray) -> list[pa.Array]:
    data, offsets = utf8(texts)
    bounds, ranks = line_bounds(data, offsets)
    # A text's lines end at the ranks after its start up to the next text's start; an empty one has none.
    n = np.where(np.diff(offsets) > 0, np.diff(ranks), 0)
    index = RankIndex.fit(bounds)
    one, two = h1 % (n + 1), h2 % (n + 1)
    first = index.at(ranks[:-1] + np.minimum(one, two))
    second = index.at(ranks[:-1] + np.maximum(one, two))
    starts, ends = offsets[:-1], offsets[1:]
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    prefix_chars = characters[first] - characters[starts]
    middle_chars = characters[second] - characters[first]
    raw, outputs = memoryview(data).cast("B") if len(data) else memoryview(b""), []
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for a, b, c, d, as_is, turned in zip(starts, first, second, ends, plain, spm):
        prefix, middle, suffix = raw[a:b], raw[b:c], raw[c:d]
        if as_is:
            outputs.append(bytes(raw[a:d]))
        elif turned:
            outputs.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle)))
        else:
            outputs.append(b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle)))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return [
        pa.array(n, pa.int64()),
        pa.array(form.tolist(), pa.string()),
        pa.array(prefix_chars, pa.int64(), mask=plain),
        pa.array(middle_chars, pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. No mark shares an end with another, so each is found where it was put."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(one, middle, two)).when(form == "spm", F.concat(two, middle, one)).otherwise(output)
    )
