"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Method: every word is a token with a hidden state, clean or toxic. The log-potential of the toxic state is
a bias plus the weights of the token's features (the word itself and its first five and four bytes); pairs
of neighbouring states have potentials of their own. Forward-backward gives each token's probability of
being toxic. Tokens of at least ``SPAN_PROBABILITY`` form the offending spans, and a logistic function of
the marginals' sum and maximum and of the text's length is the document's score.

Labelled tokens: only documents carry labels, so a token counts as toxic in training if its document is
labelled toxic and one of its features is far commoner in toxic documents than in clean ones.

The model is fitted on at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of the id: Spark counts the
features of their whole texts and, once the field is fitted, gathers what the score sees of each. The field itself
is fitted by the driver on whole texts of up to ``FIELD_ROWS`` of these rows, as many in the order of the hash as hold
``FIELD_BYTES`` in all. The model's size does not depend on the table. Scoring reads whole texts and shuffles nothing. A text is cut into blocks whose transfer
matrices are multiplied first, so forward-backward over a long text is exact and takes few numpy calls.

Defined results: a null or empty text has no token, no span, and the score that the model gives to no
evidence. Null ids, labels and texts are not learned from; of several labels of one id the highest counts.
With no toxic or no clean row to learn from, every score is 0 or the only label's rate. Repeated rows are
scored each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, map_texts, steps, utf8
from tripforge.llm.hashing import ALNUM, Words, between, byte_hashes, lower_ascii, mix
from tripforge.staging import stage

TRAIN_ROWS = 20_000
FIELD_ROWS = 2_000
FIELD_BYTES = 8 << 20
#: A feature is weighed if so many toxic documents have it, and a sign of toxicity if its odds of
#: being in a toxic document are so many times those of being in a clean one.
LEAST_DOCUMENTS = 5
SIGN_ODDS = 20.0
ROUNDS, RATE, RIDGE = 60, 0.3, 1e-3
#: Tokens that one step of the fit works on, and one longer text.
FIT_TOKENS = 50_000
SPAN_PROBABILITY = 0.5
_BLOCK = 128
_FILTER_BITS = 20
_PREFIXES = (5, 4)


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their features (one column a kind) and the offsets of the texts."""
    data, offsets = utf8(texts)
    words = Words(lower_ascii(data), offsets, ALNUM)
    sums = byte_hashes(words.data)
    features = np.empty((len(words.starts), 1 + len(_PREFIXES)), np.uint64)
    ends = [words.ends, *(np.minimum(words.starts + n, words.ends) for n in _PREFIXES)]
    for kind, end in enumerate(ends):
        features[:, kind] = mix(between(sums, words.starts, end) + (end - words.starts + kind * 1000).astype(np.uint64))
    return words, features, offsets


class Features:
    """Known features: their places in a sorted table, found through a bit filter."""

    def __init__(self, known: np.ndarray):
        self.known = np.unique(known.astype(np.uint64))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``features`` that are known, and which of the known each is."""
        maybe = np.flatnonzero(self.filter[features >> np.uint64(64 - _FILTER_BITS)])
        if not len(self.known) or not len(maybe):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        which = np.minimum(np.searchsorted(self.known, features[maybe]), len(self.known) - 1)
        hit = self.known[which] == features[maybe]
        return maybe[hit], which[hit]


def forward_backward(emission: np.ndarray, counts: np.ndarray, step: np.ndarray, pairs: bool = False):
    """Probability of the toxic state of every token, and the sums of the state pairs' if asked.

    ``emission``: potential of the toxic state of each token (that of the clean one is 1), texts one
    after another with ``counts`` tokens. ``step[i, j]``: potential of j after i. A text starts from clean.
    """
    blocks = -(-counts // _BLOCK)
    first_block = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(emission)) - (np.cumsum(counts) - counts)[text]
    column, row = first_block[text] + within // _BLOCK, within % _BLOCK
    width = int(blocks.sum())
    grid, used = np.ones((_BLOCK, width)), np.zeros((_BLOCK, width), bool)
    grid[row, column] = emission
    used[row, column] = True

    # Transfer matrix of every block, scaled.
    matrix = np.zeros((2, 2, width))
    matrix[0, 0] = matrix[1, 1] = 1
    for t in range(_BLOCK):
        if not used[t].any():
            break
        moved = np.einsum("abw,bc->acw", matrix, step)
        moved[:, 1] *= grid[t]
        moved /= moved.sum(axis=(0, 1))
        matrix = np.where(used[t], moved, matrix)

    # From block to block of each text.
    ahead, behind = np.zeros((2, width)), np.ones((2, width))
    now = np.zeros((2, len(counts)))
    now[0] = 1
    for j in range(int(blocks.max(initial=0))):
        own = np.flatnonzero(blocks > j)
        at = first_block[own] + j
        ahead[:, at] = now[:, own]
        went = np.einsum("aw,abw->bw", now[:, own], matrix[:, :, at])
        now[:, own] = went / went.sum(axis=0)
    now = np.ones((2, len(counts)))
    for j in range(int(blocks.max(initial=0)) - 1, -1, -1):
        own = np.flatnonzero(blocks > j)
        at = first_block[own] + j
        behind[:, at] = now[:, own]
        went = np.einsum("abw,bw->aw", matrix[:, :, at], now[:, own])
        now[:, own] = went / went.sum(axis=0)

    # Within all blocks at once.
    before = np.empty((_BLOCK, 2, width))
    alpha, beta = np.empty((_BLOCK, 2, width)), np.empty((_BLOCK, 2, width))
    for t in range(_BLOCK):
        before[t] = ahead
        went = step.T @ ahead
        went[1] *= grid[t]
        went /= went.sum(axis=0)
        ahead = np.where(used[t], went, ahead)
        alpha[t] = ahead
    for t in range(_BLOCK - 1, -1, -1):
        beta[t] = behind
        held = behind.copy()
        held[1] *= grid[t]
        went = step @ held
        went /= went.sum(axis=0)
        behind = np.where(used[t], went, behind)
    both = alpha * beta
    found = (both[:, 1] / both.sum(axis=1))[row, column]
    if not pairs:
        return found, None
    reach = beta.copy()
    reach[:, 1] *= grid
    joint = before[:, :, None] * step[None, :, :, None] * reach[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return found, np.einsum("tabw,tw->ab", joint, used)


@dataclass
class Model:
    features: Features = field(default_factory=lambda: Features(np.zeros(0, np.uint64)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -8.0
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Weights of the score: constant, log of the marginals' sum, greatest marginal, log of the tokens.
    logistic: np.ndarray = field(default_factory=lambda: np.array([-8.0, 0.0, 0.0, 0.0]))

    def emission(self, features: np.ndarray) -> np.ndarray:
        at, which = self.features.find(features.ravel())
        return self.bias + np.bincount(at // features.shape[1], self.weights[which], len(features))

    def marginals(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return forward_backward(np.exp(np.clip(self.emission(features), -60, 60)), counts, np.exp(self.step))[0]

    def score(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence(found, counts) @ self.logistic, -40, 40)))


def evidence(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What the score sees of each text: constant, log of sum, maximum, log of length."""
    text = np.repeat(np.arange(len(counts)), counts)
    sums = np.bincount(text, found, len(counts))
    greatest = np.zeros(len(counts))
    np.maximum.at(greatest, text, found)
    return np.column_stack([np.ones(len(counts)), np.log(1e-3 + sums), greatest, np.log1p(counts)])


def _chunks(counts: np.ndarray):
    """Texts in runs of about ``FIT_TOKENS`` tokens: slices of texts and of tokens."""
    ends = np.cumsum(counts)
    first = 0
    while first < len(counts):
        begin = ends[first] - counts[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + FIT_TOKENS, "right")))
        yield slice(first, last), slice(begin, ends[last - 1])
        first = last


def _fit_field(model: Model, features: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> None:
    """Weights, bias and step that make the labelled tokens likely, by scaled gradient steps."""
    parts = []
    for texts, tokens in _chunks(counts):
        at, which = model.features.find(features[tokens].ravel())
        parts.append((texts, tokens, at // features.shape[1], which))
    told = toxic.astype(float)
    steps_told = np.zeros((2, 2))
    first = np.cumsum(counts) - counts
    previous = np.concatenate([[0], toxic[:-1]]).astype(int)
    previous[first[counts > 0]] = 0
    np.add.at(steps_told, (previous, toxic.astype(int)), 1)
    mean, spread = [0.0] * 3, [0.0] * 3
    for turn in range(1, ROUNDS + 1):
        slopes = [-RIDGE * len(counts) * model.weights, 0.0, steps_told.copy()]
        for texts, tokens, token, which in parts:
            potential = np.exp(np.clip(model.emission(features[tokens]), -60, 60))
            found, pairs = forward_backward(potential, counts[texts], np.exp(model.step), pairs=True)
            missing = told[tokens] - found
            slopes[0] = slopes[0] + np.bincount(which, missing[token], len(model.weights))
            slopes[1] += missing.sum()
            slopes[2] -= pairs
        for k, slope in enumerate(slopes):
            mean[k] = 0.8 * mean[k] + 0.2 * slope
            spread[k] = 0.95 * spread[k] + 0.05 * slope**2
        moves = [
            RATE * (m / (1 - 0.8**turn)) / (np.sqrt(s / (1 - 0.95**turn)) + 1e-6) for m, s in zip(mean, spread)
        ]
        model.weights = model.weights + moves[0]
        model.bias = float(model.bias + moves[1])
        model.step = model.step + moves[2]
        model.step[0, 0] = 0.0  # only differences matter


def _fit_logistic(seen: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton's method."""
    weights = np.zeros(seen.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(seen @ weights, -40, 40)))
        slope = seen.T @ (labels - chance) - 0.1 * weights
        curve = (seen * (chance * (1 - chance))[:, None]).T @ seen + 0.1 * np.eye(seen.shape[1])
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def _document_counts(sample: DataFrame, label: int, known: np.ndarray | None) -> DataFrame:
    """(feature, n): in how many documents with the label each feature, or each known one, is."""
    shared = None if known is None else sample.sparkSession.sparkContext.broadcast(Features(known))

    def run(batches):
        for batch in batches:
            for step in steps(batch, 0):
                words, features, _ = _tokens(step.column(0))
                text = np.repeat(np.arange(len(step)), words.counts)
                text = np.repeat(text, features.shape[1])
                flat = features.ravel()
                if shared is not None:
                    at, which = shared.value.find(flat)
                    text, flat = text[at], shared.value.known[which]
                order = np.lexsort((text, flat))
                text, flat = text[order], flat[order]
                new = np.ones(len(flat), bool)
                new[1:] = (flat[1:] != flat[:-1]) | (text[1:] != text[:-1])
                found, n = np.unique(flat[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["feature", "n"])

    rows = bound_batches(sample).where(F.col("label") == label).select("text")
    return rows.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    field_rows: int = FIELD_ROWS,
) -> Model:
    """A model of about ``train_rows`` of the labelled rows whose document is given."""
    known = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    share, total = 1_000_000, known.count()
    place = F.pmod(F.xxhash64("id", F.lit("train")), F.lit(share))
    chosen = known.where(place < min(share, train_rows * share // max(total, 1))).withColumn("place", place)
    # About train_rows rows of three numbers, whatever the table: fit for a broadcast.
    sample = stage(
        documents.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "id"),
        "toxicity-sample",
    )
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model()
    if len(sizes) < 2:
        model.logistic[0] = -40.0 if not sizes.get(1) else 40.0
        return model

    toxic = _document_counts(sample, 1, None).where(F.col("n") >= LEAST_DOCUMENTS).toPandas().sort_values("feature")
    features = toxic["feature"].to_numpy(np.int64).view(np.uint64)
    clean = _document_counts(sample, 0, features).toPandas().set_index("feature")["n"]
    n_clean = clean.reindex(toxic["feature"]).fillna(0).to_numpy(float)
    n_toxic = toxic["n"].to_numpy(float)
    odds = ((n_toxic + 0.5) / (sizes[1] - n_toxic + 0.5)) / ((n_clean + 0.5) / (sizes[0] - n_clean + 0.5))
    signs = Features(features[odds >= SIGN_ODDS])
    weighed = odds >= np.sqrt(SIGN_ODDS)
    model.features = Features(features[weighed])
    order = np.argsort(features[weighed])
    model.weights = np.log(odds[weighed])[order] / 2  # where the climb starts

    rows = _field_sample(sample, field_rows)
    # Token by token for some rows at a time: the bytes' hashes are larger than the texts.
    pieces = [_tokens(pa.array(rows["text"][k : k + 100], pa.string())) for k in range(0, len(rows), 100)]
    feats = np.concatenate([p[1] for p in pieces])
    counts, marks = np.concatenate([p[0].counts for p in pieces]), rows["label"].to_numpy()
    del pieces
    at, _ = signs.find(feats.ravel())
    told = np.zeros(len(feats), bool)
    told[at // feats.shape[1]] = True
    told &= np.repeat(marks, counts) == 1
    _fit_field(model, feats, counts, told)
    seen = _seen(sample, model).toPandas()
    model.logistic = _fit_logistic(seen[["c0", "c1", "c2", "c3"]].to_numpy(), seen["label"].to_numpy(float))
    return model


def _field_sample(sample: DataFrame, field_rows: int) -> pd.DataFrame:
    """Label and text of the rows that the field is fitted on; ids and sizes are looked at first."""
    sized = sample.select("place", "id", F.octet_length("text").cast("long").alias("bytes"))
    first = sized.orderBy("place", "id", "bytes").limit(field_rows).toPandas()
    inside = first[first["bytes"].cumsum() <= FIELD_BYTES]
    # The first row is taken whatever its size; later ones end where the budget does.
    last = (inside if len(inside) else first.head(1)).iloc[-1]
    kinds = sized.schema
    limit = [F.lit(getattr(last[c], "item", lambda c=c: last[c])()).cast(kinds[c].dataType).alias(c) for c in kinds.names]
    within = F.struct("place", "id", F.octet_length("text").cast("long").alias("bytes")) <= F.struct(*limit)
    return sample.where(within).select("label", "text").toPandas()


def _seen(sample: DataFrame, model: Model) -> DataFrame:
    """Label and evidence, as c0 to c3, of every row of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        words, features, _ = _tokens(texts)
        return [pa.array(c) for c in evidence(shared.value.marginals(features, words.counts), words.counts).T]

    fields = [T.StructField(f"c{i}", T.DoubleType()) for i in range(4)]
    return map_texts(sample, ["label"], "text", fields, compute)


def score(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row with score and spans.

    ``spans`` are [first, last) byte offsets in the UTF-8 text, of runs of toxic words.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        words, features, offsets = _tokens(texts)
        found = shared.value.marginals(features, words.counts)
        spans: list[list] = [[] for _ in range(len(texts))]
        last = -2
        for token in np.flatnonzero(found >= SPAN_PROBABILITY):
            row = int(np.searchsorted(words.first, token, "right")) - 1
            begin, end = (int(x[token] - offsets[row]) for x in (words.starts, words.ends))
            if token == last + 1 and spans[row]:
                spans[row][-1][1] = end
            else:
                spans[row].append([begin, end])
            last = token
        return [
            pa.array(shared.value.score(found, words.counts), pa.float64()),
            pa.array(spans, pa.list_(pa.list_(pa.int64()))),
        ]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]
    return map_texts(df, keep, text, fields, compute)
