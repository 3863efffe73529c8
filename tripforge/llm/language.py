"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three lower-cased characters, hashed to ``BUCKETS`` numbers, by
language; the counts are summed by Spark (map side first) and only languages x buckets sums reach the
driver. The smoothed log-probability matrix is broadcast, and a batch of texts is scored from the
buckets that occur in it: their rows of the matrix are gathered and summed by text.

The model is fitted on about ``TRAIN_ROWS`` labelled rows (all, if there are fewer), chosen by a hash
of their id; its size does not depend on the table. Prediction reads whole texts, never shuffles,
and takes long texts in pieces.

Defined results: a text that is null or has no letter gets ``und`` and score 0; so does every text when
there is nothing to learn from. The score is the posterior probability of the language given. Equal
posteriors go to the language that comes first in the order of names. Rows with a null id, text or
language are not learned from. Repeated rows are learned from and scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, map_texts, steps
from tripforge.llm.hashing import mix, seeds

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
TRAIN_ROWS = 20_000
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Texts of so many bytes are rejected by ``keep_identified`` if no language has this posterior.
SURE_BYTES, SURE = 400, 0.5
#: Characters that one numpy step works on.
STRETCH = 1 << 18

_FACTORS = seeds(max(ORDERS) + 1, 7) | np.uint64(1)
_SPACE = np.uint32(32)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """By code point, whether it is a letter; made once in a process."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _stretches(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points, row numbers, and whether an n-gram may begin there, in stretches of the texts.

    All but letters become spaces, and each text ends in one. A stretch of a long text goes on for the
    characters that its last n-grams need; those begin in the next one.
    """
    letters, overlap = _is_letter(), max(ORDERS) - 1
    held, size = [], 0
    for row, text in enumerate(texts):
        text = text.lower()
        for at in range(0, len(text), STRETCH):
            piece = text[at : at + STRETCH + overlap]
            points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
            points = np.where(letters[points], points, _SPACE)
            if len(piece) < STRETCH + overlap:  # it reaches the text's end
                points = np.append(points, _SPACE)
            begins = np.arange(len(points)) < (STRETCH if at + STRETCH < len(text) else len(points))
            held.append((points, np.full(len(points), row), begins))
            size += len(points)
            if size >= STRETCH:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and row numbers of all n-grams that hold a letter."""
    for codes, rows, begins in _stretches(texts):
        points = codes.astype(np.uint64)
        for n in ORDERS:
            size = len(codes) - n + 1
            if size <= 0:
                continue
            total = np.full(size, _FACTORS[-1] * np.uint64(n), np.uint64)
            some = np.zeros(size, bool)
            for i in range(n):
                total += points[i : i + size] * _FACTORS[i]
                some |= codes[i : i + size] != _SPACE
            some &= (rows[:size] == rows[n - 1 : n - 1 + size]) & begins[:size]
            yield (mix(total[some]) & np.uint64(BUCKETS - 1)).astype(np.int64), rows[:size][some]


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    #: One row for each bucket, one column for each language.
    log_probability: np.ndarray

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the log-posterior up to a constant, and whether it has a letter."""
        totals = np.tile(self.log_prior, (len(texts), 1))
        grams = np.zeros(len(texts), np.int64)
        for buckets, rows in ngrams(texts):
            grams += np.bincount(rows, minlength=len(texts))
            taken = self.log_probability[buckets]
            for k in range(len(self.languages)):
                totals[:, k] += np.bincount(rows, taken[:, k], len(texts))
        return totals, grams > 0


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """A model of the labelled rows given, or of about ``train_rows`` of them."""
    known = labelled.select(
        F.col(f"`{language}`").cast("string").alias("language"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.col(f"`{id_column}`").alias("id"),
    ).where("language IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    total = known.count()
    if total > train_rows:
        share = 1_000_000
        known = known.where(F.pmod(F.xxhash64("id", F.lit("train")), F.lit(share)) < train_rows * share // total)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for step in steps(batch, 1):
                names = np.array(step.column(0).to_pylist())
                for buckets, rows in ngrams(step.column(1).to_pylist()):
                    for name in np.unique(names):
                        own = np.bincount(buckets[names[rows] == name], minlength=BUCKETS)
                        sums[name] = sums.get(name, 0) + own
        for name, own in sums.items():
            held = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held)), pa.array(held), pa.array(own[held])],
                names=["language", "bucket", "n"],
            )

    counts = (
        bound_batches(known)
        .select("language", "text")
        .mapInArrow(count, "language string, bucket long, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    priors = {r["language"]: r["n"] for r in known.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(priors)
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    place = {name: k for k, name in enumerate(languages)}
    np.add.at(table, (counts["bucket"].to_numpy(np.int64), counts["language"].map(place).to_numpy(np.int64)), counts["n"])
    rows = np.array([priors[name] for name in languages], float)
    return Model(languages, np.log(rows / rows.sum()), np.log(table / table.sum(axis=0)))


def identify(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        own = shared.value
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if own.languages:
            totals, some = own.score(texts.fill_null("").to_pylist())
            odds = np.exp(totals - totals.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            best = odds.argmax(axis=1)
            names = [own.languages[k] if s else UNDETERMINED for k, s in zip(best, some)]
            scores = np.where(some, odds[np.arange(len(best)), best], 0.0)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_texts(df, keep, text, fields, compute)


def keep_identified(df: DataFrame, model: Model, text: str = "text", language: str = "lang") -> DataFrame:
    """The rows whose text has a language, whole and with all their columns; a null ``language`` is filled in.

    Rejected are texts without letters, and texts of ``SURE_BYTES`` and more in which no learned language reaches the
    posterior ``SURE``: a shorter text may have a low score and be clean. Where the model was fitted on no labels and
    knows no language, every text with a letter stays, and null languages stay null.
    """
    columns = df.columns
    names = [f"c{i}" for i in range(len(columns))]
    plain, own = df.toDF(*names), names[columns.index(text)]
    if model.languages:
        short = F.octet_length(F.col(own).cast("string")) < SURE_BYTES
        found = identify(plain, model, names, own).where((F.col("lang_pred") != UNDETERMINED) & (short | (F.col("score") >= SURE)))
        if language in columns:
            place = names[columns.index(language)]
            found = found.withColumn(place, F.coalesce(place, F.col("lang_pred").cast(plain.schema[place].dataType)))
    else:
        lettered = T.StructField("lettered", T.BooleanType())
        found = map_texts(plain, names, own, [lettered], _lettered).where("lettered")
    return found.select(*names).toDF(*columns)


def _lettered(texts: pa.Array) -> list[pa.Array]:
    """Whether each text has an n-gram, so a letter."""
    some = np.zeros(len(texts), bool)
    for _, rows in ngrams(texts.fill_null("").to_pylist()):
        some[rows] = True
    return [pa.array(some, pa.bool_())]
