r"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Method: a document's set is its distinct word shingles. The sketch of a set has ``COORDINATES`` bins. In round i
every shingle is hashed to one bin and puts the value (i, hash) there if it is the least; rounds go on until
every bin of the document is filled. From round ``COORDINATES`` on, each shingle goes to the bin that the round
names, so no bin can stay empty. Bins agree with probability about the Jaccard similarity and concentrate as well as
independent minima do, at about one pass over a large set. The first ``BANDS`` * ``ROWS`` bins make the bands, keys
under which documents meet; at similarity 0.8 all of them differ with a chance of about 3e-6.

Documents with equal words in equal order are one class from the start (a cryptographic digest of all words); other
equal sets are linked as any similar ones are. Verification compares whole shingle sets, from the words themselves:

1. in each bucket every class is compared with the bucket's least class: bucket size - 1 pairs, not all;
2. links join classes to components, labelled by their least id. Only a bucket whose classes are still in different components may hide a
   link. There, classes outside the bucket's largest component meet all classes of the bucket, in
   blocks of bounded size; pairs in one component are passed over, the others are estimated from the whole sketches,
   and those that may reach the threshold are compared. A pair is named by the first of its common buckets only.

So no bucket, hot or not, is gathered in one task or expanded into all its pairs, and nothing caps partners.
Sketches, links and components are written tables in the shared folder.

``n_shingles`` counts distinct 64-bit hashes of shingles, made of hashes that mix each word's bytes.

Defined results: a null text, and one without words, has an empty set, is linked with nothing and is kept.
With fewer words than a shingle has, the whole sequence is the one shingle. Repeated rows are in one
class, of which the row with the least id is kept (every row with that id; ``drop_near_duplicates`` keeps one of
rows that are equal in all columns). A null id joins a class, but is never
its least id; a component of null ids alone has a null component_id, and its rows are kept.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches, dropping_shuffles, map_texts, utf8
from tripforge.llm.graph import components
from tripforge.llm.hashing import NOT_SPACE, Words, lower_ascii, mix, seeds
from tripforge.staging import stage

SHINGLE_WORDS = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 32, 5
COORDINATES = 512
#: Deviations of the estimate below the threshold at which a pair is still compared in step 2.
DEVIATIONS = 5
#: Members of a block, and outsiders that one block of them meets.
BLOCK_MEMBERS, BLOCK_OUTSIDERS = 1024, 256

_U = np.uint64
_EMPTY = np.iinfo(np.uint64).max
_ROUND_SEEDS = seeds(2 * COORDINATES, 11)
_BAND_SEEDS = seeds(BANDS, 12)
_FACTOR = _U(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, one text after another, and their numbers."""
    data, offsets = utf8(texts)
    words = Words(lower_ascii(data), offsets, NOT_SPACE)
    hashes = words.mixed_hashes()
    sets = []
    for first, last in zip(words.first[:-1], words.first[1:]):
        own = hashes[first:last]
        n = min(size, len(own))
        if not n:
            sets.append(own)
            continue
        rolled = np.full(len(own) - n + 1, _U(n))
        for i in range(n):
            rolled = rolled * _FACTOR + own[i : len(own) - n + 1 + i]
        sets.append(np.unique(mix(rolled)))
    return np.concatenate(sets), np.array([len(s) for s in sets], np.int64)


def sketches(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of ``COORDINATES`` bins for each set; an empty set's row is unfilled."""
    filled = np.full(len(counts) * COORDINATES, _EMPTY)
    rows = np.repeat(np.arange(len(counts)), counts)
    for turn, seed in enumerate(_ROUND_SEEDS):
        if not len(values):
            break
        drawn = mix(values ^ seed)
        if turn < COORDINATES:
            bins = ((drawn >> _U(32)) * _U(COORDINATES) >> _U(32)).astype(np.int64)
        else:
            bins = np.full(len(values), turn - COORDINATES)
        np.minimum.at(filled, rows * COORDINATES + bins, (_U(turn) << _U(48)) | (drawn & _U((1 << 48) - 1)))
        open_rows = (filled.reshape(-1, COORDINATES) == _EMPTY).any(axis=1)[rows]
        values, rows = values[open_rows], rows[open_rows]
    return filled.reshape(-1, COORDINATES)


def band_keys(filled: np.ndarray) -> np.ndarray:
    """One key for each row and band; keys of different bands differ."""
    keys = np.tile(_BAND_SEEDS, (len(filled), 1))
    bins = filled[:, : BANDS * ROWS].reshape(len(filled), BANDS, ROWS)
    for i in range(ROWS):
        keys = mix(keys * _FACTOR + bins[:, :, i])
    return keys


def sketch(df: DataFrame, keep: list[str], text: str, size: int) -> DataFrame:
    """The ``keep`` columns with n_shingles, class (null for an empty set), bands and short sketch."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        values, counts = shingle_sets(texts, size)
        classes = [word_digest(t) if n else None for t, n in zip(texts.to_pylist(), counts)]
        filled = sketches(values, counts)
        keys = band_keys(filled)
        short = mix(filled).astype(np.uint8)
        return [
            pa.array(counts, pa.int64()),
            pa.array(classes, pa.binary()),
            pa.array([k.tobytes() if n else None for k, n in zip(keys, counts)], pa.binary()),
            pa.array([s.tobytes() if n else None for s, n in zip(short, counts)], pa.binary()),
        ]

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("class", T.BinaryType()),
        T.StructField("bands", T.BinaryType()),
        T.StructField("short", T.BinaryType()),
    ]
    return map_texts(df, keep, text, fields, compute)


def word_digest(text: str) -> bytes:
    """Tells sequences of words apart."""
    # bytes.lower() changes A-Z only; bytes.split() splits at 0x20 and 0x09-0x0D only.
    return hashlib.blake2b(b" ".join(text.encode().lower().split()), digest_size=16).digest()


def similar(a: str, b: str, size: int, threshold: Fraction) -> bool:
    """Whether two texts' whole shingle sets are at least so similar."""
    return _alike(_shingles(a, size), _shingles(b, size), threshold)


def _alike(one: set, two: set, threshold: Fraction) -> bool:
    common = len(one & two)
    return common * threshold.denominator >= (len(one) + len(two) - common) * threshold.numerator


def _shingles(text: str, size: int) -> set:
    # bytes.lower() changes A-Z only; bytes.split() splits at 0x20 and 0x09-0x0D only.
    words = text.encode().lower().split()
    n = min(size, len(words))
    return set(zip(*(words[i:] for i in range(n))))


def _verified(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, threshold: Fraction, name: str
) -> DataFrame:
    """Those of the class pairs (a, b) whose sets, from the texts, are similar; written.

    A class's text is that of the row it names. Texts are shuffled once for both ends (the second join reuses
    the exchange), and only texts of pairs move on. A class in very many pairs is split by the skew-join rule.
    """
    for end in ("a", "b"):
        named = classes.select(F.col("class").alias(end), F.col("row").alias(f"row_{end}"))
        pairs = pairs.join(named, end)
    for end in ("b", "a"):
        pairs = pairs.join(texts.select(F.col("row").alias(f"row_{end}"), F.col("text").alias(f"text_{end}")), f"row_{end}")

    def run(batches):
        for batch in batches:
            told = [
                similar(x, y, size, threshold)
                for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(told, pa.bool_()))

    compared = bound_batches(pairs).select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")
    return stage(compared.distinct(), name)


_GROUP = ["key", "block", "part"]


def _cross_pairs(members: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs of classes in one bucket, in different components, that may be similar.

    ``members``: (key, band, class, component, n_shingles, short, bands) of buckets with several components. Without
    ``bands`` a pair is named in each of its buckets.
    One row for each class of a group that is in a pair, with the classes it is to be compared with.
    """
    by_component = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = by_component.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"),
        F.max("n").alias("in_largest"),
        F.sum("n").alias("n"),
    )
    placed = members.join(buckets, "key").withColumns(
        {
            "outside": F.col("component") != F.col("largest"),
            "blocks": F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int"),
            "parts": F.ceil((F.col("n") - F.col("in_largest")) / BLOCK_OUTSIDERS).cast("int"),
            "hash": F.xxhash64("class"),
        }
    )
    # Every member is in one block and meets every part of the outsiders; every outsider is in one
    # part and meets every block.
    hosts = placed.select(
        *members.columns,
        F.lit(False).alias("guest"),
        F.pmod("hash", "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    guests = placed.where("outside").select(
        *members.columns,
        F.lit(True).alias("guest"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.shiftright("hash", 20), "parts").cast("int").alias("part"),
    )
    share = float(threshold)
    least = share - DEVIATIONS * (share * (1 - share) / COORDINATES) ** 0.5

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        guest, band = group["guest"].to_numpy(bool), int(group["band"].iloc[0])
        classes = group["class"].to_numpy()
        components_ = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
        sizes = group["n_shingles"].to_numpy(float)
        short = np.frombuffer(b"".join(group["short"]), np.uint8).reshape(len(group), -1)
        keys = np.frombuffer(b"".join(group["bands"]), np.uint64).reshape(len(group), -1) if "bands" in group else None
        hosts, found = np.flatnonzero(~guest), {}
        for g in np.flatnonzero(guest):
            other = hosts[components_[hosts] != components_[g]]
            other = other[np.minimum(sizes[other], sizes[g]) >= share * np.maximum(sizes[other], sizes[g])]
            other = other[(short[other] == short[g]).mean(axis=1) >= least]
            if keys is not None:
                # Keys of the bands name the buckets; equal short bins may belong to different ones.
                other = other[(keys[other] == keys[g]).argmax(axis=1) == band]
            partners = [classes[h] for h in other]
            if partners:
                found.setdefault(classes[g], []).extend(partners)
                for partner in partners:
                    found.setdefault(partner, [])
        place = group[_GROUP].iloc[0].tolist() if len(group) else []
        return pd.DataFrame([(*place, c, p) for c, p in found.items()], columns=[*_GROUP, "class", "partners"])

    groups = bound_batches(hosts.union(guests)).groupBy(*_GROUP)
    return groups.applyInPandas(meet, "key long, block int, part int, class binary, partners array<binary>")


def _cross_links(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, threshold: Fraction, name: str
) -> DataFrame:
    """Those of the pairs whose sets, from the texts, are similar; written.

    The texts of a group's classes meet in its task, a block of hosts and one of outsiders at most, so pairs are
    compared there and only links become rows. Whole sets of hashes, eight bytes a shingle, tell which pairs are worth
    building the sets of words for, two at a time.
    """
    named = pairs.join(classes.select("class", "row"), "class").join(texts.select("row", "text"), "row")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        values, counts = shingle_sets(pa.array(group["text"], pa.string()), size)
        hashed = dict(zip(group["class"], np.split(values, np.cumsum(counts)[:-1])))
        words = dict(zip(group["class"], group["text"]))
        links = []
        for a, partners in zip(group["class"], group["partners"]):
            own = None
            for b in partners:
                # Two more than are common: hashes that collide lose no pair.
                common = len(np.intersect1d(hashed[a], hashed[b], assume_unique=True)) + 2
                if common * threshold.denominator < (len(hashed[a]) + len(hashed[b]) - common) * threshold.numerator:
                    continue
                own = own or _shingles(words[a], size)
                if _alike(own, _shingles(words[b], size), threshold):
                    links.append((min(a, b), max(a, b)))
        return pd.DataFrame(links, columns=["a", "b"])

    held = bound_batches(named).select(*_GROUP, "class", "partners", "text").groupBy(*_GROUP)
    return stage(held.applyInPandas(compare, "a binary, b binary").distinct(), name)


def row_digest(id_column: str, text: str) -> Column:
    """Tells a row from others by id and text; a null text counts as empty."""
    own = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws("/", own, F.col(f"`{text}`").cast("string"))))


def _bucket_keys(classes: DataFrame) -> DataFrame:
    """(key, band, class): every class under each of its band keys."""

    def run(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            place = pa.array(np.repeat(np.arange(len(batch)), BANDS))
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(batch))
            made = [pa.array(keys), pa.array(band), batch.column("class").take(place)]
            yield pa.RecordBatch.from_arrays(made, names=["key", "band", "class"])

    return bound_batches(classes).select("bands", "class").mapInArrow(run, "key long, band int, class binary")


def _labels(classes: DataFrame) -> DataFrame:
    """(class, label): labels are in the order of the classes' least ids, null ids last."""
    return classes.select("class", F.struct(F.col("id").isNull().alias("last"), "id", "class").alias("label"))


def _components_of(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(class, component): the least label of each linked class's component, written."""
    named = links
    for end in ("a", "b"):
        named = named.join(labels.toDF(end, f"label_{end}"), end)
    found = components(named.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")), "near-components")
    return stage(found.select(F.col("node")["class"].alias("class"), "component"), "near-nodes")


def _in_components(classes: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``classes`` with the least label of the component, or the class's own."""
    found = classes.join(nodes, "class", "left").join(labels, "class")
    return found.withColumn("component", F.coalesce("component", "label")).drop("label")


def _class_components(
    source: DataFrame, size: int, threshold: Fraction
) -> tuple[DataFrame, DataFrame]:
    """The written rows with their classes, and (class, component_id) of every class."""
    rows = stage(sketch(source, ["id", "row"], "text", size), "sketches")
    of_class = F.min(F.struct("row", "n_shingles", "bands", "short")).alias("one")
    classes = stage(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("id").alias("id"), of_class)
        .select("class", "id", "one.*"),
        "classes",
    )

    # Step 1: every class against the least of each of its buckets.
    shared = (
        _bucket_keys(classes)
        .groupBy("key")
        .agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    members = stage(_bucket_keys(classes).join(stage(shared, "buckets"), "key"), "bucket-members")
    first = stage(
        members.where("class <> least").select(F.col("least").alias("a"), F.col("class").alias("b")).distinct(),
        "first-pairs",
    )
    links = _verified(first, classes, source, size, threshold, "first-links")
    labels = _labels(classes)
    nodes = _components_of(links, labels)

    # Step 2: buckets of three classes and more that are still in several components.
    several = _in_components(members.where("n > 2").select("key", "band", "class"), nodes, labels)
    several = several.withColumn("component", F.col("component")["class"])
    mixed = several.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    members_of_mixed = stage(
        several.join(stage(mixed.select("key"), "mixed-buckets"), "key").join(
            classes.select("class", "n_shingles", "short", "bands"), "class"
        ),
        "mixed-members",
    )
    second = stage(_cross_pairs(members_of_mixed, threshold), "second-pairs")
    more = _cross_links(second, classes, source, size, threshold, "second-links")
    if not more.isEmpty():
        nodes = _components_of(links.union(more), labels)
    linked = _in_components(classes.select("class"), nodes, labels)
    return rows, stage(linked.select("class", F.col("component")["id"].alias("component_id")), "class-components")


def cluster(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """(id, row, n_shingles, component_id, kept) of every row; ``row`` is a digest of id and text."""
    # Row digests tell apart rows that repeat an id with another text.
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    source = source.select("id", row_digest("id", "text").alias("row"), "text")
    with dropping_shuffles(df.sparkSession):
        rows, named = _class_components(source, size, threshold)
    found = rows.select("id", "row", "n_shingles", "class").join(named, "class", "left")
    component_id = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", "row", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group of near-duplicates, whole and with all columns."""
    columns = df.columns
    names = [f"c{i}" for i in range(len(columns))]
    place = dict(zip(columns, names))
    plain = df.toDF(*names)
    found = cluster(plain, place[id_column], place[text], **options)
    dropped = stage(found.where("NOT kept").select("row").distinct(), "dropped")
    named = plain.withColumn("row", row_digest(place[id_column], place[text]))
    kept = named.join(dropped, "row", "left_anti").select(*names)
    # Rows equal in all columns are one document; only digests are shuffled to find them.
    whole = F.unhex(F.md5(F.to_json(F.struct(*names))))
    counts = plain.groupBy(whole.alias("whole")).agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counts.where("n > 1").select("whole"), "repeated-rows")
    if not repeated.isEmpty():
        kept = kept.withColumn("whole", whole)
        once = kept.join(repeated, "whole", "left_semi").dropDuplicates(["whole"])
        kept = kept.join(repeated, "whole", "left_anti").union(once).select(*names)
    return kept.toDF(*columns)
