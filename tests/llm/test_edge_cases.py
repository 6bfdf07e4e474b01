"""NULLs, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import (
    decontaminate,
    exact_dedup,
    main_text,
    mixing,
    near_duplicates,
    ppm_language,
    prefix_tokens,
    sharding,
    toxicity,
    url_lists,
)

LONG = "lang und breit " * 20_000
ROWS = [
    (0, "the cat sat on the mat and the dog", "en", "a"),
    (1, "der hund und die katze auf der matte", "de", "b"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", "c"),
    (5, "123 !? 456", "de", "a"),
    (6, LONG, "de", None),
    (7, "the cat sat on the mat and the dog", "en", "b"),
    (7, "the cat sat on the mat and the dog", "en", "b"),
    (None, "the cat sat on the mat and the dog", "en", "a"),
    (None, None, None, None),
    (11, "ß", "de", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = {c: F.lit(1) for c in ("n_chars", "size", "shard", "id", "key", "label", "score", "sequence", "rep", "hash", "copies")}
    return spark.createDataFrame(ROWS, SCHEMA).withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(0, 1, 0), (1, 0, 1), (1, 0, 1), (3, None, None), (None, 1, 1), (6, 1, 0), (11, 0, 7), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_language(docs, empty):
    rows = ppm_language.language_table(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert und == {2, 3, 4, 5, None}  # of the two rows without an identifier one has no text
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 7} <= {"en", "de"}
    assert ppm_language.language_table(empty).count() == 0


def test_language_without_anything_to_learn(docs):
    rows = ppm_language.language_table(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def test_toxicity(docs, empty, labels):
    rows = toxicity.toxicity_table(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert toxicity.toxicity_table(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity_table(docs, labels.limit(0)).collect()} == {0.0}


def test_mix(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert len({r["taken"] for r in rows if r["doc_id"] == 7}) == 1
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    taken = sum(r["copies"] for r in rows)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == taken


def test_exact(docs, empty):
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[0]["group_size"] == 4 and by[0]["kept"] and not by[7]["kept"] and by[7]["keep_id"] == 0
    assert by[4]["kept"] and by[2]["keep_id"] == by[3]["keep_id"] == 4  # the most code points stay
    assert by[2]["text_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_shards(docs, empty):
    rows = sharding.shard(docs, keep=docs.columns).collect()
    assert len(rows) == len(ROWS) and rows[0].__fields__.count("size") == 1
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    none = next(r for r in rows if r["doc_id"] == 2)
    assert (none["size"], none["text_crc32"], none["law"]) == (8, 0, "key")
    assert sharding.shard(empty).count() == 0


def test_near(docs, empty):
    rows = near_duplicates.near_duplicates(docs, words=2).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[7]["component_id"] == 0 and not by[7]["kept"] and by[0]["kept"]
    assert [by[i]["n_shingles"] for i in (2, 3, 4, 11)] == [0, 0, 0, 1]
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_decontaminate(docs, empty, spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat and the dog"), (2, None), (3, ""), (None, "ß")], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (7, 1)}
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_tokens(docs, empty):
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    rows = prefix_tokens.token_counts(docs, path).collect()
    assert len(rows) == len(ROWS)
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 0)}
    assert next(r for r in rows if r["doc_id"] == 6)["over_limit"]
    assert prefix_tokens.token_counts(empty, path).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (None, "v", "<p>a", 1), (3, "w", "<div" + "x" * 100_000, 1)],
                                  "page_id long, url string, html string, n_chars int")
    assert sorted(r["text"] for r in main_text.extract(pages).collect())[:3] == ["", "", ""]
    assert main_text.extract(pages.limit(0)).count() == 0


def test_urls(spark):
    captures = spark.createDataFrame(
        [(1, "http://www.A.example.org:80/x/y?q=1#f", 10), (2, "http://b.example.org/", 10), (3, None, 10), (4, "nonsense", 10),
         (5, "http://a.example.org/x", None), (6, "http://b.example.org", 60), (6, "http://b.example.org", 60)], "page_id long, url string, fetched long")
    entries = spark.createDataFrame(
        [("spam", "host", "example.org", 5, "add"), ("spam", "host", "example.org", 50, "remove"), ("allow", "prefix", "a.example.org/x", 0, "add"),
         ("bad", "url", "b.example.org", 55, "add"), ("bad", "url", "b.example.org", 55, "add"), (None, "host", "org", 0, "add"),
         ("odd", "host", "org", 9, "add"), ("odd", "host", "org", 9, "remove")],
        "list string, kind string, pattern string, at long, action string")
    rows = sorted(tuple(r) for r in url_lists.evaluate(captures, entries).select("page_id", "n_active", "first_list", "allowed", "blocked").collect())
    assert rows == [(1, 2, "allow", True, False), (2, 1, "spam", False, True), (3, 0, None, False, False), (4, 0, None, False, False),
                    (5, 0, None, False, False), (6, 1, "bad", False, True), (6, 1, "bad", False, True)]
    assert url_lists.evaluate(captures.limit(0), entries).count() == 0
    assert {r["blocked"] for r in url_lists.evaluate(captures, entries.limit(0)).collect()} == {False}


def test_stages(docs, empty, spark, tmp_path):
    spark.createDataFrame([(1, "der hund und die katze auf der matte")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(out.columns)
        out.collect()
        assert stage(spark, empty, str(tmp_path)).count() == 0
        if name == "language_id":
            assert {r["doc_id"] for r in out.collect()} & {2, 3, 4, 5} == set()
        if name == "decontamination":
            assert {r["doc_id"] for r in docs.select("doc_id").subtract(out.select("doc_id")).collect()} == {1}
