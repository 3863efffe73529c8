"""Search, addresses, shards, near-duplicates, repeats and the pipeline: operators over whole tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import plain
import pyarrow as pa
import pytest
import xxhash
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

import corpus_pipeline
from tripforge.llm import batches, graph, hashing, minhash, search, sharding, suffixes, urls
from tripforge.llm.queries import ORACLES, QUERIES, RACKS, REGIONS, SHARDS, URL_RULES

SMALL = "/root/testdata/sf0.001"


def documents_of(spark, folder=SMALL):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", ["op2_urls", "op7_search", "op8_minhash", "op9_suffixes"])
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(connect(SMALL), ORACLES[name])


# --- exact search


def brute_force(rows, queries, k):
    found = set()
    for q, own in queries:
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q)
        found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return found


def test_search_with_ties_copies_and_small_blocks(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, -1.0, 0.0]) for i in range(150)]
    queries = [r for r in rows if r[0] % 10 == 0]
    schema = "vec_id long, embedding array<double>, score string, rank int"
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    found = search.top_k(vectors, vectors.where("vec_id % 10 = 0"), 5, shard_rows=70, leaf_rows=8, query_rows=20)
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()} == brute_force(rows, queries, 5)


def test_search_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]),
            (5, [2.0, 0.0]), (6, []), (7, [1.0]), (5, [2.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = search.top_k(vectors, vectors, 5).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == [(0, 1, 5, 2), (0, 2, 5, 2), (5, 1, 0, 2)]
    assert search.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0
    assert search.top_k(vectors, vectors.limit(0), 5).count() == 0


def test_search_of_mixed_lengths_and_of_ids_with_several_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(2 + i % 3)]) for i in range(150)]
    rows += [(50, [1.0, 2.0, 3.0]), (50, [1.0, 2.0, 3.0]), (50, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 25 = 0")
    found = search.top_k(vectors, asked, 4, shard_rows=9, leaf_rows=2, query_rows=3, group_shards=2).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    expected = []
    for q, own in {(i, tuple(v)) for i, v in rows if i % 25 == 0}:
        same = [r for r in rows if len(r[1]) == len(own)]
        expected += brute_force(same, [(q, own)], 4)
    assert got == sorted(expected)


def test_trees_bound_their_points_and_cut_searches_short():
    rng = np.random.default_rng(6)
    points = np.rint(rng.standard_normal((3000, 3)) * 100)
    tree = search.build_tree(np.arange(3000), points, 16)
    rows = np.zeros(3000, int)
    for number, (left, right, first, last) in enumerate(tree.nodes):
        inside = tree.points[first:last]
        assert (inside.min(axis=0) == tree.low[number]).all() and (inside.max(axis=0) == tree.high[number]).all()
        if left < 0:
            rows[tree.ids[first:last]] += 1
        else:
            assert [*tree.nodes[left][2:], *tree.nodes[right][2:]][1:3] == [tree.nodes[left][3]] * 2
    assert (rows == 1).all()

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, slice):
                Counted.read += at.stop - at.start
            return super().__getitem__(at)

    tree.points = tree.points.view(Counted)
    best = [[]]
    search.search_tree(tree, np.array([-1]), points[:1] + 0.0, best, 5)
    assert sorted((s for s, _ in best[0]), reverse=True) == sorted((points @ points[0]).tolist(), reverse=True)[:5]
    assert Counted.read < 600


# --- components and addresses


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1300)]
    edges += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)] + [(5, 5), (None, 3), (160, 7)]
    groups = plain.Groups()
    for a, b in edges:
        if a is not None and a != b:
            groups.join(a, b)
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {x: groups.root(x) for x in groups.up}
    assert len(found) == len(groups.up)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def canonical(href):
    return f"<head><LINK class=x href='{href}' rel=\"canonical\"></head>"


PAGES = [
    (1, "http://a.example.com/x#top", canonical("https://bad.net/p")),  # blocked through its link
    (2, "http://b.example.com/", '<meta http-equiv="refresh" content="0; url=http://a.example.com/x">'),
    (3, "http://c.org/fr/page", canonical("http://b.example.com")),  # an alias with an allow of its own
    (4, "http://d.example.com/1", canonical("/2?a=1&amp;b=2")),
    (5, "HTTP://D.example.com/2?a=1&b=2", None),
    (6, "http://www.example.net/en/a", ""),
    (7, "http://www.example.net/de/a", ""),
    (8, "http://x.net", "no path, so the rule's path does not fit"),
    (9, None, canonical("http://bad.net/")),
    (10, "no address", canonical("http://bad.net/")),
    (11, "http://notexample.net/en/", ""),
    (12, "http://e.example.com/dir/page", canonical("other")),
    (13, "http://e.example.com/dir/other", canonical("//f.example.com/de/z")),
    (2, "http://b.example.com/", '<meta http-equiv="refresh" content="0; url=http://a.example.com/x">'),
    (14, "http://g.example.com/", "<a href='http://bad.net/'>only a link</a>"),
]


@pytest.fixture
def pages(spark):
    schema = "page_id long, url string, html string, host string, verdict string, node string"
    return spark.createDataFrame([(*p, "h", "v", "n") for p in PAGES], schema)


def test_blocks_reach_aliases_and_allows_stay(pages):
    rows = urls.judge(pages, URL_RULES, ["page_id"]).collect()
    assert len(rows) == len(PAGES)
    got = {r["page_id"]: (r["rule"], r["verdict"], r["reason"]) for r in rows}
    assert got == {
        1: (None, "block", "alias"),
        2: (None, "block", "alias"),
        3: ("org/fr/", "allow", "rule"),
        4: (None, "allow", "default"),
        5: (None, "allow", "default"),
        6: ("example.net/en/", "allow", "rule"),
        7: ("net/", "block", "rule"),
        8: (None, "allow", "default"),
        9: (None, "allow", "default"),
        10: (None, "allow", "default"),
        11: ("net/", "block", "rule"),
        12: (None, "block", "alias"),
        13: (None, "block", "alias"),
        14: (None, "allow", "default"),
    }
    assert urls.judge(pages.limit(0), URL_RULES, ["page_id"]).count() == 0


def test_links_are_resolved(pages):
    edges = {(r["a"], r["b"]) for r in urls.links(pages).collect()}
    assert ("http://d.example.com/1", "http://d.example.com/2?a=1&b=2") in edges
    assert ("http://e.example.com/dir/page", "http://e.example.com/dir/other") in edges
    assert ("http://e.example.com/dir/other", "http://f.example.com/de/z") in edges
    assert len(edges) == 6


HOSTILE = [
    "<link rel=x " * 80_000,
    "<link " + "rel=x " * 150_000 + ">",
    "<link rel='" + "canonical" * 1 + " " * 900_000,
    "<meta " + "url= http-equiv " * 60_000 + ">",
    "<link rel " + " " * 900_000 + ">",
]


def test_hostile_markup_takes_time_by_its_length(spark):
    schema = "page_id long, url string, html string"
    found = [(i, f"http://h{i}.example.com/", h) for i, h in enumerate(HOSTILE)]
    found.append((99, "http://z.example.com/", HOSTILE[0] + canonical("http://bad.net/")))
    began = time.monotonic()
    edges = urls.links(spark.createDataFrame(found, schema)).collect()
    assert time.monotonic() - began < 60
    assert {(r["a"], r["b"]) for r in edges} <= {("http://z.example.com/", "http://bad.net/")}


TAGS = [
    """<link rel="alternate canonical" href="/a">""", """<link href=/b rel=canonical>""",
    """<link rel='x' title=canonical href=/c>""", """<link rel = "x" canonical href=/d>""",
    """<LINK data-rel=canonical href='/e'>""", """<link rel=alternate canonical href=/f>""",
    """<link rel="canonical"><a href=/no>""", """<linkrel=canonical href=/no2>""", """<link rel="non-canonical" href="/g">""",
    """<meta http-equiv='Refresh' content='5;URL= "/h"'>""", """<meta http-equiv=refresh content="1; url=/i;x">""",
    """<meta name=x content="http-equiv=refresh url=/j">""", """<link rel=x <b rel=canonical href=/k>""",
    """<link\nrel="a\ncanonical"\nhref="/l">""", """<link rel="" canonical href=/m>""", """<link rel=canonicals href=/n>""",
]


def test_links_of_odd_tags_equal_sql(spark, tmp_path):
    pages = [(i, f"http://p{i}.example.com/x/y?q#f", f"<p>{tag}</p>") for i, tag in enumerate(TAGS)]
    pages += [(100, "http://bad.net/l", ""), (101, "http://q.example.com/", f"{TAGS[0]}{TAGS[9]}{TAGS[1]}")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    table.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    rules = URL_RULES
    connection = connect(SMALL)
    connection.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert spark_rows(urls.judge(table, rules, ["page_id"])) == sql_rows(connection, ORACLES["op2_urls"])
    assert urls.links(table).count() > 8


def test_host_path_and_rule_of_every_page(spark):
    truth = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = QUERIES["op2_urls"](spark, SMALL).collect()
    assert len(rows) == len(truth)
    for r in rows:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", truth[r["page_id"]] or "")
        host, path = found.groups() if found else ("", "")
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        best = None
        for verdict, rule in URL_RULES:
            own_host, _, own_path = rule.partition("/")
            if ("." + host).endswith("." + own_host) and path.startswith("/" + own_path):
                best = max(best or ("", ""), (rule, verdict), key=lambda b: len(b[0]))
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
        assert r["verdict"] == (best[1] if best else "allow")


# --- shards


def plain_shard(key, leaves):
    text, parent, name = "\x00null" if key is None else str(key), "", None
    for level in ("region", "rack", "shard"):
        children = sharding._children(leaves, level)[parent]
        draws = []
        for child, weight in children.items():
            hashed = xxhash.xxh64(f"{text}/{level}/{child}".encode(), seed=42).intdigest()
            draws.append((-math.log(((hashed >> 11) + 1) * 2.0**-53) / weight, child))
        parent = name = min(draws)[1]
    return int(name)


def test_shards_equal_plain_descent(spark):
    texts = documents_of(spark)
    trees = [sharding.even_tree(n, REGIONS, RACKS, SHARDS) for n in (SHARDS, SHARDS + 1)]
    rows = QUERIES["op4_shards"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert [r["shard"], r["grown_shard"]] == [plain_shard(r["doc_id"], t) for t in trees]
        assert r["grown_shard"] in (r["shard"], SHARDS)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_follow_weights_and_movement_stays_in_changed_subtrees(spark):
    keys = spark.range(40_000).select(F.col("id").alias("doc_id"))
    leaves = [sharding.Leaf(f"r{i // 4}", f"k{i // 2}", i, 1.0 + i) for i in range(8)]
    before = {r["doc_id"]: r["shard"] for r in sharding.place(keys, "doc_id", leaves, "shard").collect()}
    for leaf in leaves:
        share = sum(s == leaf.shard for s in before.values()) / len(before)
        assert abs(share - leaf.weight / 36) < 0.01
    # A heavier shard 0 draws rows to its region and rack; nothing else changes places.
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, x.weight + 5 * (x.shard == 0)) for x in leaves]
    after = {r["doc_id"]: r["shard"] for r in sharding.place(keys, "doc_id", heavier, "shard").collect()}
    moved = {(before[i], after[i]) for i in before if before[i] != after[i]}
    assert moved and all(b // 4 == 0 for _, b in moved)
    assert all(b == 0 for a, b in moved if a < 2) and all(b < 2 for a, b in moved if a in (2, 3))


def test_shards_of_odd_rows(make_documents, edges):
    leaves = sharding.even_tree(4, 2, 1, 4)
    found = sharding.shard_documents(make_documents(edges), leaves, leaves)
    rows = found.collect()
    assert len(rows) == len(edges)
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(edges)
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {16}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text
    assert sharding.shard_documents(make_documents([]), leaves, leaves).count() == 0


# --- near-duplicates


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(7)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (1, 2, 50, 5000)]
    base = sets[-1]
    sets.append(np.concatenate([base[:4500], rng.integers(0, 1 << 63, 500, np.uint64)]))
    filled = minhash.sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    assert (filled != minhash._EMPTY).all()
    assert abs((filled[3] == filled[4]).mean() - 4500 / 5500) < 0.1
    alone = minhash.sketches(sets[2], np.array([50]))
    assert (alone[0] == filled[2]).all()


def test_shingle_sets_are_exact():
    texts = ["A b  c a B", "one", "", None, " x\ty\x0bx y ", "É é"]
    _, counts = minhash.shingle_sets(pa.array(texts), 2)
    assert counts.tolist() == [len(plain.shingles(t, 2)) for t in texts]


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_that_cancel_in_polynomial_hashes_stay_apart(make_documents):
    one, two = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    rows = [(1, one, "en"), (2, two, "en"), (3, f"{one} {two}", "en"), (4, f"{two} {one}", "en"), (5, one, "en")]
    got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.cluster(make_documents(rows), size=2).collect()}
    assert got == {1: (1, 1, True), 2: (1, 2, True), 3: (1, 3, True), 4: (1, 4, True), 5: (1, 1, False)}


def test_word_hashes_tell_words_apart():
    words = [f"w{i}" for i in range(50_000)] + ["a" * n for n in range(1, 300)] + [thue_morse(512, x) for x in ("ab", "ba")]
    data, offsets = batches.utf8(pa.array([" ".join(words), " ".join(reversed(words))]))
    found = hashing.Words(data, offsets, hashing.NOT_SPACE).mixed_hashes()
    assert len(found) == 2 * len(words) == 2 * len(set(found.tolist()))
    assert (found[: len(words)] == found[len(words) :][::-1]).all()


def test_equal_sets_in_another_order_are_linked(make_documents):
    words = [f"w{i}" for i in range(30)]
    rows = [(7, " ".join([*words, *words[:5]]), "en"), (9, " ".join([*words[3:], *words[:6]]), "en"), (8, " ".join(words * 2), "en")]
    expected = plain.near_duplicates([(i, t) for i, t, _ in rows], 2)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash.cluster(make_documents(rows), size=2).collect()}
    assert got == expected and {c for _, c in got.values()} == {7}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, size):
    texts = documents_of(spark)
    expected = plain.near_duplicates(texts.items(), size)
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = QUERIES["op8_minhash"](spark, SMALL) if size == 2 else minhash.cluster(df).withColumnRenamed("id", "doc_id")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows.collect()}
    assert got == expected


def test_chains_and_buckets_with_several_components(spark, make_documents):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, words = [], [rng.choice(vocabulary) for _ in range(60)]
    for k in range(25):  # a chain: neighbours are similar, the ends are not
        rows.append((k, " ".join(words), "en"))
        words = [*words[2:], *rng.choices(vocabulary, k=2)]
    shared = [rng.choice(vocabulary) for _ in range(40)]
    for k in range(60):  # half of each text is common to all: many meet in buckets, few are linked
        own = rng.choices(vocabulary, k=12)
        rows.append((100 + 2 * k, " ".join([*shared, *own]), "en"))
        rows.append((101 + 2 * k, " ".join([*shared, *own[:-1], "last"]), "en"))
    expected = plain.near_duplicates([(i, t) for i, t, _ in rows], 2)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in minhash.cluster(make_documents(rows), size=2).collect()}
    assert got == expected
    assert len({c for _, c in expected.values()}) > 3


def test_cross_pairs_are_complete_at_any_block_size(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(minhash, "BLOCK_OUTSIDERS", 2)
    members = [
        (key, band, bytes([i]), bytes([0 if i < 12 else i]), 9, bytes(minhash.COORDINATES))
        for key, band in ((1, 0), (2, 3))
        for i in range(20)
    ]
    schema = "key long, band int, class binary, component binary, n_shingles long, short binary"
    df = spark.createDataFrame(members, schema)
    rows = minhash._cross_pairs(df, minhash.THRESHOLD).collect()
    got = {tuple(sorted((bytes(r["class"]), bytes(p)))) for r in rows for p in r["partners"]}
    places = {(r["key"], r["block"], r["part"], bytes(r["class"])) for r in rows}
    assert len(places) == len(rows)
    assert all((r["key"], r["block"], r["part"], bytes(p)) in places for r in rows for p in r["partners"])
    expected = {(bytes([i]), bytes([j])) for i in range(20) for j in range(i + 1, 20) if j >= 12}
    assert got == expected


def test_cross_pairs_survive_short_sketches_that_collide_in_an_earlier_band(spark):
    # Short bins agree everywhere; the keys of bands 0 to 2 differ, so the pairs meet in bands 3 and 5 only.
    def bands(i):
        keys = np.arange(minhash.BANDS, dtype=np.uint64) + np.uint64(1000 * (i + 1))
        keys[[3, 5]] = 7, 8
        return keys.tobytes()

    members = [
        (key, band, bytes([i]), bytes([i]), 9, bytes(minhash.COORDINATES), bands(i))
        for key, band in ((7, 3), (8, 5))
        for i in range(4)
    ]
    schema = "key long, band int, class binary, component binary, n_shingles long, short binary, bands binary"
    rows = minhash._cross_pairs(spark.createDataFrame(members, schema), minhash.THRESHOLD).collect()
    assert {r["key"] for r in rows} == {7}
    got = {tuple(sorted((bytes(r["class"]), bytes(p)))) for r in rows for p in r["partners"]}
    assert got == {(bytes([i]), bytes([j])) for i in range(4) for j in range(i + 1, 4)}


def test_near_duplicates_of_odd_rows(make_documents, edges):
    documents = make_documents(edges)
    rows = minhash.cluster(documents).collect()
    assert len(rows) == len(edges)
    got = {(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (6, 16, 5, False), (None, 4, None, True)} <= got
    kept = minhash.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "7", "8", "9", "None"]
    assert minhash.cluster(make_documents([])).count() == 0


def test_rows_loaded_twice_pass_once(spark, make_documents, edges):
    once = sorted({*edges}, key=str)
    kept = sorted(str(tuple(r)) for r in minhash.drop_near_duplicates(make_documents(once)).collect())
    documents = make_documents([*once, *once, once[0]])
    twice = minhash.drop_near_duplicates(documents)
    assert twice.columns == documents.columns
    assert sorted(str(tuple(r)) for r in twice.collect()) == kept


# --- repeats


def test_mergesort_orders_suffixes():
    rng = random.Random(13)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(3000)), np.uint8)
    starts = np.array(rng.sample(range(2800), 501))
    lengths = np.array([rng.randint(1, 200) for _ in starts])
    order = suffixes.Suffixes(data, hashing.byte_hashes(data)).order(starts, lengths)
    keys = [data[s : s + n].tobytes() for s, n in zip(starts, lengths)]
    assert order.tolist() == sorted(range(len(keys)), key=lambda k: (keys[k], k))


def test_common_extension_and_verification():
    data = np.frombuffer(b"abcabcabx" + b"z" * 300 + b"abcabcaby" + b"z" * 300, np.uint8)
    own = suffixes.Suffixes(data, hashing.byte_hashes(data))
    a, b = np.array([0, 9, 0]), np.array([309, 318, 3])
    assert own.common(a, b, np.array([100, 250, 100])).tolist() == [8, 250, 5]
    assert own.verified(a, b, np.array([8, 250, 6])).tolist() == [True, True, False]


def test_segments_hold_every_window_once():
    texts = [bytes(random.Random(k).choices(b"abcd ", k=n)).decode() for k, n in enumerate((50, 100, 101, 900))]
    data, offsets = batches.utf8(pa.array(texts))
    document, first, count, anchor, _ = suffixes.anchors(hashing.byte_hashes(data), offsets)
    windows = [w for f, n in zip(first, count) for w in range(f, f + n)]
    assert windows == [int(o) + p for o, t in zip(offsets, texts) for p in range(len(t) - 99)]
    assert ((anchor >= first + count - 1) & (anchor + suffixes.GRAM <= first + suffixes.LENGTH)).all()


def check_repeats(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    flags = plain.repeats([(t or "").encode() for _, t in ordered])
    for (i, text), own in zip(ordered, flags):
        raw, spans = (text or "").encode(), plain.runs(own)
        assert got[i] == (len(raw), [list(s) for s in spans], plain.cut(raw, spans)), i


def repeats_of(df):
    return {r["id"]: (r["n_bytes"], r["spans"], bytes(r["kept"])) for r in suffixes.cut(df).collect()}


def test_repeats_equal_a_dictionary(spark):
    texts = documents_of(spark)
    rows = QUERIES["op9_suffixes"](spark, SMALL).collect()
    flags = plain.repeats([(texts[i] or "").encode() for i in sorted(texts)])
    expected = {}
    for i, own in zip(sorted(texts), flags):
        raw, spans = (texts[i] or "").encode(), plain.runs(own)
        expected[i] = (len(raw), sum(own), len(spans), hashlib.sha256(plain.cut(raw, spans)).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_of_passages_lines_and_runs(spark, make_documents, monkeypatch, hot):
    # The share decides only which way common anchors take.
    monkeypatch.setattr(suffixes, "HOT_SHARE", 0.0 if hot else 1.1)
    rng = random.Random(17)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghé", k=rng.randint(2, 8))) for _ in range(n))

    line, passage = prose(14)[:85], prose(80)
    rows = [(k, f"{prose(30)} {line} {prose(30)}") for k in range(40)]
    rows += [(100 + k, f"{prose(25)} {passage[k : 300 + 2 * k]} {prose(20)}") for k in range(30)]
    rows += [(200, "a" * 1000), (201, "a" * 99), (202, "ab" * 300), (203, passage), (204, passage), (205, None), (206, "")]
    check_repeats(rows, repeats_of(make_documents([(i, t, "en") for i, t in rows])))


def test_repeats_of_odd_rows(make_documents):
    text = "".join(random.Random(19).choices("abcdefg ", k=400))
    rows = [(1, None, "en"), (2, "", "en"), (3, text, "en"), (3, text, "en"), (4, text + "x", "en"),
            (None, text[:200], "en"), (5, "short", "en"), (6, text[200:], "en"), (6, text[:150], "en")]
    found = suffixes.cut(make_documents(rows), keep=["tie", "spans"]).collect()
    assert len(found) == len(rows)
    got = sorted((r["id"] is None, r["id"] or 0, r["n_bytes"], bytes(r["kept"]).decode()) for r in found)
    assert got == sorted([
        (False, 1, 0, ""), (False, 2, 0, ""), (False, 3, 400, text), (False, 3, 400, text), (False, 4, 401, "x"),
        (True, 0, 200, ""), (False, 5, 5, "short"), (False, 6, 200, ""), (False, 6, 150, ""),
    ])
    assert {r["carried"]["tie"] for r in found} == {"x1", "x2", "x3", "x4", "xNone", "x5", "x6"}
    assert suffixes.cut(make_documents([])).count() == 0


def test_cut_texts_keep_whole_characters(make_documents):
    inside = "é" * 80
    rows = [(1, "aaaa" + inside + "bbbb", "en"), (2, "Ã" + inside + "èxyz", "en"), (3, None, "en")]
    documents = make_documents(rows)
    kept = suffixes.drop_repeats(documents)
    assert kept.columns == documents.columns
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    flags = plain.repeats([t.encode() for _, t, _ in rows[:2]])
    for (i, text, _), own in zip(rows, flags):
        raw = text.encode()
        assert got[i] == plain.cut(raw, plain.whole_characters(raw, plain.runs(own))).decode()
    assert got[3] is None


# --- the pipeline


def test_pipeline_equals_plain_stages(spark):
    from test_llm_text import _digests

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    left = {i: t for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    groups = plain.near_duplicates(left.items(), 5)
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    flags = plain.repeats([left[i].encode() for i in sorted(left)])
    for i, own in zip(sorted(left), flags):
        raw = left[i].encode()
        left[i] = plain.cut(raw, plain.whole_characters(raw, plain.runs(own))).decode()
    windows = {tuple(w[k : k + min(13, len(w))]) for _, t in items if (w := plain.words(t)) for k in range(max(1, len(w) - 12))}
    kept = {}
    for i, text in left.items():
        own = plain.words(text)
        hit = set()
        for n in {len(w) for w in windows}:
            for at in range(len(own) - n + 1):
                if tuple(own[at : at + n]) in windows:
                    hit.update(range(at, at + n))
        if not (hit and 20 * len(hit) >= len(own)):
            kept[i] = text
    got = {r["doc_id"]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {i: _digests(t) for i, t in kept.items()}


def test_stages_keep_columns_of_odd_documents(spark, make_documents, edges):
    docs = make_documents(edges, extra=False)
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, docs, SMALL)
        assert kept.schema.names == docs.schema.names
        assert [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        empty = function(spark, docs.limit(0), SMALL)
        assert empty.count() == 0
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeats", "benchmark", "tokens"]
