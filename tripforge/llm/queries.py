"""The registered queries of this package, each next to the SQL it must agree with.

A query fixes the parameters, applies its operator to the whole table and derives the digest
columns from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm import (
    bpe,
    decontaminate,
    infill,
    language,
    minhash,
    packing,
    quotations,
    search,
    sharding,
    suffixes,
    toxicity,
    urls,
    whitening,
)
from tripforge.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(ship(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), items AS (
  SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS k
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY 1
)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(k, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op6_decontaminate", OP6_SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-table encoding; no SQL can state it, so the tests hold it against the library."""
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(documents: DataFrame) -> DataFrame:
    """Number of tokens, and digests of the ids and of the decoded text, of every document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(documents, path, ["doc_id"]).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out(parts: int, part: int) -> Column:
    """Whether a document is kept from learning; those without an id are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(True))


def language_model(documents: DataFrame) -> language.Model:
    return language.fit(documents.where(~held_out(3, 1)))


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: the model is learned. Tests hold it against a plain version and held-out rows."""
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language_model(documents), ["doc_id"])
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


#: Verdict and host/path of the rules that every page is judged by.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


OP2_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw_host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), tags AS (
  SELECT url, regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS ref
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS t FROM p)
  WHERE regexp_matches(t, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
  UNION ALL
  SELECT url, regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)
  FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS t FROM p)
  WHERE regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
), named AS (
  SELECT url, CASE WHEN ref LIKE '%://%' THEN ref
    WHEN ref LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || ref
    WHEN ref LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || ref
    WHEN ref LIKE '?%' THEN regexp_extract(url, '(?s)^(.*?://[^?#]*)', 1) || ref
    WHEN ref <> '' AND ref NOT LIKE '#%'
      THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1) || ref END AS target
  FROM (SELECT url, replace(ref, '&amp;', '&') AS ref FROM tags)
), addresses AS (
  SELECT u, lower(regexp_extract(u, '(?s)^(.*?://[^/?#]*)', 1)) AS start, regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest
  FROM (SELECT url AS u FROM p UNION SELECT target FROM named)
), nodes AS (
  SELECT u, start || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END AS node FROM addresses WHERE start <> ''
), rules (rule, verdict, host, path) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
    ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), edges AS (
  SELECT x.node AS a, y.node AS b FROM named JOIN nodes x ON url = x.u JOIN nodes y ON target = y.u WHERE x.node <> y.node
), ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), judged AS (
  SELECT node, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT node, regexp_extract(node, '://([^/?#]*)', 1) AS h, regexp_extract(node, '://[^/?#]*([^?#]*)', 1) AS q FROM nodes)
    JOIN rules ON (h = host OR ends_with(h, '.' || host)) AND starts_with(q, path)
  GROUP BY node
), reach AS (
  SELECT node FROM judged WHERE verdict = 'block' AND node IN (SELECT a FROM ways)
  UNION
  SELECT b FROM reach JOIN ways ON node = a
), own AS (
  SELECT page_id, url, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p
), best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM own JOIN rules ON (own.host = rules.host OR ends_with(own.host, '.' || rules.host)) AND starts_with(own.path, rules.path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN node IN (SELECT node FROM reach) THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN node IN (SELECT node FROM reach) THEN 'alias' ELSE 'default' END AS reason
FROM own LEFT JOIN best USING (page_id) LEFT JOIN nodes ON url = u
"""


@query("op2_urls", OP2_SQL)
def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, ["page_id"])


@query("op3_quotations")
def op3_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL states the reply order; tests hold it against a plain version on planted quotes."""
    formed = quotations.conversations(table(spark, sf_dir, "conversations"))
    listed = F.transform("messages", lambda m: F.to_json(m))
    count = lambda name: F.aggregate("messages", F.lit(0), lambda n, m: n + F.size(m[name])).cast("long")
    return formed.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_messages"),
        count("quotes").alias("n_quotes"),
        count("orphans").alias("n_orphans"),
        F.array_join(F.col("messages.turn").cast("array<string>"), ",", "-").alias("turns"),
        F.sha2(F.array_join(listed, "\n"), 256).alias("messages_sha256"),
    )


#: Shards of the table, built as so many regions of so many racks.
SHARDS, REGIONS, RACKS = 40, 4, 2


@query("op4_shards")
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRC-32 and the draws' hash are not in the SQL at hand; tests hold it against a plain version."""
    trees = [sharding.even_tree(n, REGIONS, RACKS, SHARDS) for n in (SHARDS, SHARDS + 1)]
    return sharding.shard_documents(table(spark, sf_dir, "documents"), *trees)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: the model is learned. Tests hold it against enumerated states and held-out rows."""
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit(documents, labels.where(~held_out(5, 0)))
    return toxicity.score(documents, model, ["doc_id"]).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.to_json("spans").alias("spans"),
    )


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@query("op7_search", OP7_SQL)
def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    # The operator leaves out what is null or not finite; floor() would make numbers of it.
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = table(spark, sf_dir, "embeddings").where(finite).select("vec_id", whole.alias("embedding"))
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.r = ways.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query("op8_minhash", OP8_SQL)
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.cluster(table(spark, sf_dir, "documents"), size=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM d WHERE n >= 100)
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1
), gone AS (
  SELECT doc_id, p, p + 100 AS q, max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM repeated
), runs AS (
  SELECT doc_id, min(p) AS a, max(q) AS b
  FROM (SELECT *, sum(CASE WHEN reach >= p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone)
  GROUP BY doc_id, run
), listed AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS firsts, list(b ORDER BY a) AS lasts
  FROM runs GROUP BY 1
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(coalesce(n_spans, 0) + 1),
    lambda i: substr(h, 2 * coalesce(lasts[i], 0) + 1, 2 * (coalesce(firsts[i + 1], n) - coalesce(lasts[i], 0)))), ''))) AS kept_sha256
FROM d LEFT JOIN listed USING (doc_id)
"""


@query("op9_suffixes", OP9_SQL)
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.cut(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: components are iterated. Tests hold them against a dense eigendecomposition."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), ["vec_id"])


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || doc_id) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS two,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100
      THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), cut AS (
  SELECT *, array_to_string(u[1 : least(one, two)], '') AS prefix,
    array_to_string(u[least(one, two) + 1 : greatest(one, two)], '') AS middle,
    array_to_string(u[greatest(one, two) + 1 :], '') AS suffix
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


@query("op12_infill", OP12_SQL)
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"), ["doc_id"])
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL encodes texts; tests hold the pieces against the tokenizer's library and the law of packing."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, ["doc_id"]).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
