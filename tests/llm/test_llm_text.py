"""Language, tokens, toxicity and decontamination: operators that read each text by itself."""

from __future__ import annotations

import hashlib
import itertools
import random
import unicodedata
import math

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from compare import connect, spark_rows, sql_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripforge.llm import batches, bpe, decontaminate, hashing, language, toxicity
from tripforge.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = bpe._Pieces(bpe.WordBpe(PATH))


# --- batches and hashes


def test_steps_cover_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 10, "", "cc"])], names=["t"])
    parts = [p.column(0).to_pylist() for p in batches.steps(batch, 0, limit=3)]
    assert list(itertools.chain(*parts)) == ["aa", None, "b" * 10, "", "cc"]
    assert ["b" * 10] in parts or ["b" * 10, ""] in parts


def test_words_do_not_cross_texts():
    data, offsets = batches.utf8(pa.array(["ab c", "d", "", None, "é  f"]))
    found = hashing.Words(data, offsets, hashing.NOT_SPACE)
    assert found.counts.tolist() == [2, 1, 0, 0, 2]
    assert found.text(0, 3) == b"ab c d"
    same = hashing.Words(*batches.utf8(pa.array(["x f"])), hashing.NOT_SPACE)
    assert found.hashes()[4] == same.hashes()[1]


# --- byte pair encoding


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAbBzéÉİΣσ09'sStTmM !?.,\t\n\x1c\x85\xa0<|endoftext|>한😀ﬁ", max_size=40))
def test_tokens_equal_the_librarys(text):
    assert PIECES.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_words_take_the_heap_and_give_the_same():
    rank = PIECES.bpe
    words = ["ab" * 500, "banana" * 30, "x" * 65, "thethethe" * 20, "a", "of", "é" * 33]
    for word, tokens in zip(words, rank.words(words)):
        raw = np.frombuffer(word.encode(), np.uint8)
        parts = np.append(rank.inner[raw[:-1]], rank.last[raw[-1]])
        assert rank.merge_long(parts.tolist()) == rank.merge_short(parts[None])[0] == tokens
        assert tokens == LIBRARY.encode(word, add_special_tokens=False).ids
    assert rank.words([]) == []


def test_every_assigned_code_point_is_split_as_the_library_splits_it():
    points = [c for c in range(1, 0x30000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for at in range(0, len(points), 20_000):
        texts = [f"a{chr(c)}b{chr(c)}1" for c in points[at : at + 20_000]]
        ids, ends = PIECES.encode_all(texts)
        for text, found, a, b in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False), ends, ends[1:]):
            assert found.ids == ids[a:b].tolist(), text


def test_tables_that_are_full_change_nothing(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcde'1é", k=rng.randint(1, 9))) for _ in range(60)) for _ in range(20)]
    expected = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(bpe, "TABLE_SIZE", 50)
    monkeypatch.setattr(bpe, "MERGED_WORDS", 7)
    pieces = bpe._Pieces(PIECES.bpe)
    for _ in range(2):
        ids, ends = pieces.encode_all([*texts, "", "x"])
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [*expected, [], pieces.encode("x").tolist()]
    assert len(pieces) == len(pieces.words) == 50


def test_long_text_is_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 7)
    text = "Some words, and somewhatlongerones too. " * 5
    assert "".join(bpe.stretches(text)) == text
    assert PIECES.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def _digests(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    joined = " ".join(map(str, ids))
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded))


def test_token_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op10_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == _digests(texts[r["doc_id"]])


def test_tokens_of_odd_rows(make_documents, edges):
    found = bpe.decode(bpe.encode(make_documents(edges), PATH, ["doc_id", "score"]), PATH).collect()
    expected = [LIBRARY.encode(t or "", add_special_tokens=False).ids for _, t, _ in edges]
    assert sorted(r["token_ids"] for r in found) == sorted(expected)
    assert found[0].asDict().keys() == {"doc_id", "score", "token_ids", "decoded"}
    assert bpe.encode(make_documents([]), PATH, ["doc_id"]).count() == 0
    both = bpe.round_trip(make_documents(edges), PATH, ["doc_id", "score"]).collect()
    assert sorted(map(tuple, both), key=str) == sorted(map(tuple, found), key=str)


# --- language


def test_scores_equal_plain_naive_bayes(make_documents):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")])]
    model = language.fit(make_documents(rows))
    assert model.languages == ["de", "en", "fr"]

    def grams(text):
        codes = [ord(c) if c.isalpha() else 32 for c in text.lower()] + [32]
        for n in language.ORDERS:
            for at in range(len(codes) - n + 1):
                own = codes[at : at + n]
                if any(c != 32 for c in own):
                    total = np.array([int(language._FACTORS[-1]) * n], object)
                    total = (total + sum(c * int(f) for c, f in zip(own, language._FACTORS))) % (1 << 64)
                    yield int(hashing.mix(total.astype(np.uint64))[0]) % language.BUCKETS

    counts = {lang: np.full(language.BUCKETS, language.SMOOTHING) for lang in model.languages}
    for _, text, lang in rows:
        for bucket in grams(text):
            counts[lang][bucket] += 1
    for text in ("The dog", "die Katze!", "x"):
        expected = [math.log(1 / 3) + sum(math.log(counts[lang][b] / counts[lang].sum()) for b in grams(text)) for lang in model.languages]
        assert np.allclose(model.score([text])[0][0], expected)


def test_long_texts_lose_no_ngram(monkeypatch):
    text = "Ein längerer Satz, mit Wörtern und 12 Zahlen. " * 7

    def buckets():
        return sorted(b for found, _ in language.ngrams([text, "ab"]) for b in found.tolist())

    whole = buckets()
    for size in (3, *range(45, 55), len(text) - 2, len(text) - 1, len(text)):
        monkeypatch.setattr(language, "STRETCH", size)
        assert buckets() == whole


def test_language_of_odd_rows(make_documents, edges):
    documents = make_documents(edges)
    model = language.fit(documents)
    rows = language.identify(documents, model, ["doc_id", "text", "class"]).collect()
    assert len(rows) == len(edges)
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en", "fr") and 0 < r["score"] <= 1
    kept = language.keep_identified(documents, model)
    assert kept.columns == documents.columns and kept.count() == 8
    nothing = language.fit(make_documents([]))
    assert {r["lang_pred"] for r in language.identify(documents, nothing, ["doc_id"]).collect()} == {"und"}


def test_clean_texts_stay_where_nothing_is_labelled(spark, make_documents, edges):
    documents = make_documents([(i, text, None) for i, text, _ in edges])
    model = language.fit(documents)
    assert model.languages == []
    kept = language.keep_identified(documents, model)
    assert kept.columns == documents.columns
    lettered = sorted(text for _, text, _ in edges if any(c.isalpha() for c in text or ""))
    assert sorted(r["text"] for r in kept.collect()) == lettered and len(lettered) == 8


def test_null_languages_are_filled_and_known_ones_stay(make_documents):
    english = "the cat sat on the mat while it was raining over the hills and the old town by the river "
    german = "der hund lag vor der tuer des alten hauses und wartete auf den abend der langsam kam "
    rows = [(i, english[i:] * 4, "en") for i in range(20)] + [(100 + i, german[i:] * 4, "de") for i in range(20)]
    model = language.fit(make_documents(rows))
    asked = make_documents([(1, english * 9, None), (2, german * 9, None), (3, german * 9, "en"), (4, "12", None), (5, "der", None)])
    kept = {r["doc_id"]: r["lang"] for r in language.keep_identified(asked, model).collect()}
    assert kept == {1: "en", 2: "de", 3: "en", 5: kept[5]} and kept[5] in ("de", "en")
    # A long text that the model finds in no language for sure goes; a short one stays.
    unsure = language.Model(["a", "b", "c"], model.log_prior[[0, 0, 0]], model.log_probability[:, [0, 0, 0]])
    assert {r["doc_id"] for r in language.keep_identified(asked, unsure).collect()} == {5}


def test_language_of_held_out_rows(spark):
    found = QUERIES["op1_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


# --- toxicity


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 5, 1])
    emission, step = rng.uniform(0.1, 5, counts.sum()), rng.uniform(0.2, 3, (2, 2))
    found, pairs = toxicity.forward_backward(emission, counts, step, pairs=True)
    expected, expected_pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        weights, hits, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=n):
            weight, previous, moved = 1.0, 0, np.zeros((2, 2))
            for k, s in enumerate(states):
                weight *= step[previous, s] * (emission[at + k] if s else 1)
                moved[previous, s] += 1
                previous = s
            weights += weight
            hits += weight * np.array(states)
            moves += weight * moved
        expected += list(hits / weights) if n else []
        expected_pairs += moves / weights
        at += n
    assert np.allclose(found, expected) and np.allclose(pairs, expected_pairs)


def test_marginals_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    counts = np.array([700, 13, 0, 129])
    emission, step = rng.uniform(0.01, 9, counts.sum()), np.array([[1.0, 0.1], [0.4, 2.0]])
    found, _ = toxicity.forward_backward(emission, counts, step)
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    assert np.allclose(found, toxicity.forward_backward(emission, counts, step)[0])


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op5_toxicity"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    better = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert better >= 0.93 * len(toxic) * len(clean)


def test_toxicity_of_odd_rows(spark, make_documents, edges):
    rows = [(100 + k, f"you are a {'nasty' if k % 4 == 0 else 'kind'} person number {k}", "en") for k in range(80)]
    documents = make_documents([*rows, *edges])
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i, *_ in rows] + [(None, 1), (5, None), (100, 0)], "doc_id long, toxic int"
    )
    model = toxicity.fit(documents, labels)
    found = toxicity.score(documents, model, ["doc_id", "text", "tie"]).collect()
    assert len(found) == len(rows) + len(edges)
    assert all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        if r["text"] and "nasty" in r["text"]:
            assert [r["text"].encode()[a:b] for a, b in r["spans"]] == [b"nasty"] and r["score"] > 0.5
        elif (r["doc_id"] or 0) >= 100:
            assert r["spans"] == [] and r["score"] < 0.5
    for none in (labels.limit(0), labels.where("toxic = 0")):
        scored = toxicity.score(documents, toxicity.fit(documents, none), ["doc_id"]).collect()
        assert len(scored) == len(found) and all(r["score"] < 0.01 for r in scored)


# --- benchmark decontamination


def test_contamination_equals_sql(spark):
    assert spark_rows(QUERIES["op6_decontaminate"](spark, SMALL)) == sql_rows(connect(SMALL), ORACLES["op6_decontaminate"])


ITEMS = [
    (10, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."),
    (9, "Short, ITEM here!"),
    (11, "short item here"),
    (12, None),
    (13, " ... "),
    (None, "nameless item text"),
]
CONTAMINATED = [
    (1, "x one two three four five six seven eight nine ten eleven twelve thirteen fourteen y"),
    (2, "one two three four five six seven eight nine ten eleven twelve and no more"),
    (3, "a short item here, " + "clean words " * 40),
    (4, "nameless item text"),
    (5, None),
    (6, ""),
    (7, "short item short item here here"),
    (7, "short item short item here here"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_hits_equal_plain_search(spark, make_documents, block_bytes):
    documents = make_documents([(i, t, "en") for i, t in CONTAMINATED])
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate.judge(documents, benchmark, ["doc_id", "spans"], block_bytes=block_bytes).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows)
    expected = []
    for i, text in CONTAMINATED:
        n, hit, found = plain.contamination(text, ITEMS)
        expected.append((i, n, hit, [f for f in found if f != "None"], hit > 0 and 20 * hit >= n))
    assert got == sorted(expected)


def test_contaminated_are_dropped_or_cut(spark, make_documents):
    documents = make_documents([(i, t, "en") for i, t in CONTAMINATED])
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.drop_contaminated(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 6]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(documents, benchmark).collect()}
    assert cut[1] == "x  y" and cut[4] == "" and cut[5] is None and cut[7] == "short item  here"
    nothing = decontaminate.judge(documents, benchmark.limit(0), ["doc_id"])
    assert {r["n_hit"] for r in nothing.collect()} == {0}
    assert decontaminate.judge(documents.limit(0), benchmark, ["doc_id"]).count() == 0
