"""Whitening, fill-in-the-middle and packing."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, spark_rows, sql_rows
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripforge.llm import infill, packing, whitening
from tripforge.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
CLASHING = ["id", "row", "x", "k0", "width", "component", "n", "form", "output", "start", "ids", "group", "offset"]


# --- whitening


def dense(rows, k=4):
    """(vec_id, component) -> (n, deviation, whitened, explained), by numpy's eigendecomposition."""
    usable = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows]
    distinct = sorted({tuple(x) for _, x in usable})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, float) - np.array(sums) / n
    variance, turn = np.linalg.eigh(centred.T @ centred / n)
    variance, turn = variance[::-1], turn[:, ::-1]
    found = defaultdict(list)
    for i, x in usable:
        own = (np.array(x) - np.array(sums) / n) @ turn / np.sqrt(np.abs(variance) + 1e-300)
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for c in range(k):
            if variance[c] > 1e-9 * variance[0]:
                found[i, c + 1].append((n, deviation, own[c], variance[c] / variance.sum()))
    return found


def compare_whitened(got, rows):
    expected = dense(rows)
    seen = defaultdict(list)
    for r in got:
        seen[r["vec_id"], r["component"]].append(r)
    assert {key: len(v) for key, v in seen.items()} == {key: len(v) for key, v in expected.items()}
    signs = {}
    for key, found in seen.items():
        for r, (n, deviation, white, explained) in zip(found, expected[key]):
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["explained"] == pytest.approx(explained, rel=1e-9)
            assert r["identity_error"] < 1e-9
            if abs(white) > 1e-3:
                assert signs.setdefault(key[1], np.sign(white * r["whitened"])) == np.sign(white * r["whitened"])
            assert abs(r["whitened"]) == pytest.approx(abs(white), rel=1e-6, abs=1e-6)


def test_whitening_query_equals_dense_decomposition(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    compare_whitened(QUERIES["op11_whitening"](spark, SMALL).collect(), rows)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    good = [(i, [float(x) for x in rng.standard_normal(5).astype(np.float32)]) for i in range(60)]
    good += [(200 + i, good[7][1]) for i in range(40)]  # copies count once
    good += [(3, good[9][1])]  # a repeated id
    bad = [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0]), (302, [nan] * 5), (303, [inf] * 5), (304, [])]
    schema = "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` string" for c in CLASHING)
    table = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in good + bad], schema)
    found = whitening.whiten(table, ["vec_id"])
    compare_whitened(found.collect(), good)
    # Lengths are spaces of their own, and a null id stays.
    mixed = table.select("vec_id", "embedding").union(spark.createDataFrame([(None, [1.0, 2.0]), (9, [2.0, 2.5])], "vec_id long, embedding array<float>"))
    got = whitening.whiten(mixed, ["vec_id"]).collect()
    assert len(got) == found.count() + 2 and {r["n"] for r in got if r["vec_id"] is None} == {2}


def test_whitening_of_few_vectors_and_of_flat_ones(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema), ["vec_id"]).count() == 0
    one = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)
    assert whitening.whiten(one, ["vec_id"]).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(20)], schema)
    assert {r["component"] for r in whitening.whiten(flat, ["vec_id"]).collect()} == {1}
    # Four equal variances: components are any basis, but white all the same.
    cross = spark.createDataFrame([(i, [float((i // 2 == j) * (1 - 2 * (i % 2))) for j in range(4)]) for i in range(8)], schema)
    got = whitening.whiten(cross, ["vec_id"]).collect()
    assert len(got) == 32 and all(r["identity_error"] < 1e-9 and r["explained"] == pytest.approx(0.25) for r in got)


def test_deviation_beyond_a_long_is_null_and_exact_below():
    matrix = np.array([[3, -5], [1 << 40, 7]], np.int64)
    assert whitening._deviations(matrix, 10, [4, -9]) == [(30 - 4) ** 2 + (-50 + 9) ** 2, None]
    assert whitening._deviations(matrix[:, :1] >> 11, 3, [1 << 29]) == [(1 << 58), (3 * (1 << 29) - (1 << 29)) ** 2]


def test_bidiagonalisation_stays_orthogonal():
    rng = np.random.default_rng(1)
    for a in (rng.standard_normal((400, 20)), rng.standard_normal((300, 3)) @ rng.standard_normal((3, 20)), np.zeros((2, 3))):
        grown = whitening.Bidiagonal(lambda y, a=a: a.T @ (a @ y), a.shape[1], 4)
        while grown.step():
            pass
        assert np.allclose(grown.v.T @ grown.v, np.eye(a.shape[1]), atol=1e-12)
        left = a @ grown.w
        assert np.allclose(left.T @ left, np.eye(left.shape[1]), atol=1e-9)
        assert np.allclose(a @ grown.v, left @ grown.b, atol=1e-9)


# --- fill-in-the-middle


def plain_infill(doc_id, text, spm_rate=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:one]), "".join(lines[one:two]), "".join(lines[two:])
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_query_equals_sql(spark):
    assert spark_rows(QUERIES["op12_infill"](spark, SMALL)) == sql_rows(connect(SMALL), ORACLES["op12_infill"])


def test_infill_of_odd_documents(spark, make_documents, edges):
    rng = random.Random(7)
    odd = ["\n", "\n\n", "a", "a\n", "a\r\nb c\n", "holds <M> itself\nx", "<", "<P", "ends in <\n<S\n", "x\n" * 300_000]
    odd += ["".join(rng.choice(["\n", "ab", "é漢", "\n\n", "<S", "P>", "x" * 3000]) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    rows = edges + [(100 + i, t, None) for i, t in enumerate(odd)]
    made = infill.transform(make_documents(rows), ["doc_id", "text"])
    restored = infill.restore(made["output"], made["form"]).alias("restored")
    got = made.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", restored).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[2:7]) == plain_infill(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert infill.transform(make_documents([]), ["doc_id"]).count() == 0
    assert {r["form"] for r in infill.transform(make_documents(rows), ["doc_id"], rate=0).collect()} == {"plain"}


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=400), st.integers(0, 50))
def test_rank_index_is_exact(numbers, error):
    numbers = np.cumsum(np.array(numbers, np.int64))
    index = infill.RankIndex.fit(numbers, error)
    ranks = np.arange(len(numbers))
    assert (index.at(ranks) == numbers).all()
    assert np.abs(index.residual).max() <= error + 1
    assert (np.diff(index.first) > 0).all()


def test_rank_index_of_even_lines_is_one_segment():
    index = infill.RankIndex.fit(np.arange(0, 80 * 100_000, 80))
    assert len(index.first) == 1 and index.residual.dtype == np.int8


# --- packing


def check_packed(rows, texts, capacity=2048):
    """The law of packing; ``texts``: the texts of each doc_id."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, own in texts.items():
        left = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc_id])
        for text in own:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
            at = 0
            while at < len(ids):
                found = next(p for p in left if p[0] == at and p[3] == len(ids)
                             and p[2] == zlib.crc32(np.array(ids[at : at + p[1]], "<u4").tobytes()))
                left.remove(found)
                at += found[1]
            assert at == len(ids)
        assert not left
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return sequences


def test_packing_query_keeps_every_id_once(spark):
    texts = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        texts[r["doc_id"]].append(r["text"])
    rows = QUERIES["op13_packing"](spark, SMALL).collect()
    sequences = check_packed(rows, texts)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= 1.01 * total / 2048 + 1


def test_packing_of_odd_documents(spark, make_documents, edges):
    rows = edges + [(50, "a <|endoftext|> b", None), (51, " \n  x" * 5000, None), (52, "\x00 　", None)]
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t)
    path = public_tokenizers.path("byte_bpe_50k.json")
    table = make_documents(rows)
    for c in CLASHING:
        table = table.withColumn(c, table["source"])
    for group_bytes in (packing.GROUP_BYTES, 4000):
        packed = packing.pack(table, path, ["doc_id"], group_bytes=group_bytes)
        check_packed(packed.select("*", F.crc32("ids").alias("ids_crc32")).collect(), texts)
    assert packing.pack(make_documents([]), path, ["doc_id"]).count() == 0


def brute_differencing(sizes, windows):
    """Sorted window sums of the largest differencing method, on whole tuples; None where imbalances tie."""
    states = [sorted([s] + [0] * (windows - 1), reverse=True) for s in sizes]
    while len(states) > 1:
        states.sort(key=lambda s: s[0] - s[-1])
        last = [s[0] - s[-1] for s in states[-3:]]
        if len(set(last)) < len(last):
            return None
        one, two = states.pop(), states.pop()
        states.append(sorted((a + b for a, b in zip(one, reversed(two))), reverse=True))
    return states[0]


def test_differencing_equals_whole_tuples_without_ties():
    rng, compared = random.Random(8), 0
    for _ in range(60):
        windows = rng.randint(1, 9)
        sizes = np.array(rng.sample(range(1, 100_000), rng.randint(1, 60)))
        found = packing.differencing(sizes, windows)
        sums = sorted(np.bincount(found, sizes, windows).astype(int).tolist(), reverse=True)
        expected = brute_differencing(sizes.tolist(), windows)
        assert expected is None or sums == expected
        compared += expected is not None
    assert compared > 40


@hypothesis_settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_fill_keeps_all_within_capacity(sizes):
    sizes = np.array(sizes, np.int64)
    item, start, length, window = packing.fill(sizes, 100)
    assert (length > 0).all() if len(length) else not len(sizes)
    covered = defaultdict(list)
    for i, a, n in zip(item, start, length):
        covered[i].append((a, a + n))
    for i, size in enumerate(sizes):
        spans = sorted(covered[i])
        assert spans[0][0] == 0 and spans[-1][1] == size and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    if len(sizes):
        assert np.bincount(window, length).max() <= 100
        assert window.max() + 1 <= -(-int(sizes.sum()) // 100) * 1.005 + 1


def test_fast_ids_are_the_librarys():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoding = Tokenizer.from_file(path), packing.Bytes(path).encoding()
    rng = random.Random(9)
    tokens = [t for t in (b.decode("utf-8", "ignore") for b in packing.Bytes(path).ranks) if t]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 5))) for _ in range(20_000)]
    texts += ["".join(rng.choice("ab \t\n\x1c\x85\xa0 éß漢字1٣²'sS.,ll") for _ in range(12)) for _ in range(5_000)]
    for text, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encoding.encode(text, allowed_special="all") == found.ids


def test_equal_rows_are_dealt_to_many_groups(spark):
    table = spark.createDataFrame([(1, "the same text " * 50)] * 400, "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(table, path, ["doc_id"], group_bytes=20_000).collect()
    groups = defaultdict(int)
    for r in rows:
        groups[r["sequence_id"] >> 32] += 1
    assert len(groups) > 8 and max(groups.values()) < 60
    assert sum(r["length"] for r in rows) == sum({r["doc_tokens"] for r in rows}) * 400
