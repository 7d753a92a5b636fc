import os
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from tallybrook.llm import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_what_sql_gives(spark, sf_dir, duck, name):
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    shown = lambda df: sorted(map(str, df[columns].astype({c: "float64" for c in columns if c.startswith("train_")}).values.tolist()))
    assert shown(got) == shown(want)


def test_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))


def test_stages_match_plain_filters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    extra = [(90_001, "", "en", "s", 0), (90_002, None, None, None, None), (90_003, rows[0]["text"], "en", "s", 1), (90_004, "...", "en", "s", 3)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = kept
    assert not {90_001, 90_002, 90_004} & seen["language_id"]
    assert {r["doc_id"] for r in rows if r["text"] and re.search(r"[^\W\d_]", r["text"])} <= seen["language_id"]
    assert seen["toxicity"] <= seen["language_id"] and seen["near_dedup"] <= seen["exact_dedup"] <= seen["toxicity"]
    texts = {r["doc_id"]: r["text"] for r in rows} | {e[0]: e[1] for e in extra}
    best = {}
    for i in seen["toxicity"]:
        best[texts[i]] = max(i, best.get(texts[i], -1))
    assert seen["exact_dedup"] == set(best.values())
    from tests.llm.test_near_dedup import brute

    assert seen["near_dedup"] == {d for d, _, _, kept in brute([(i, texts[i]) for i in sorted(seen["exact_dedup"])]) if kept}
    assert seen["packing"] == seen["near_dedup"]


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """On 0.1, as the smaller tables have too few toxic rows to learn the rarer terms from."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(90_005, "the idiot moron is a worthless loser and stupid scum", "en", "s", 9), (90_006, "the weather is fine and the river is calm", "en", "s", 9)]
    kept = {r["doc_id"] for r in corpus_pipeline.civil(spark, docs.unionByName(spark.createDataFrame(extra, docs.schema)), sf_dir).select("doc_id").collect()}
    assert 90_005 not in kept and 90_006 in kept
    marks = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    clean, toxic = ([i for i, y in marks if y == k] for k in (0, 1))
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert sum(i not in kept for i in toxic) >= 0.9 * len(toxic)


def test_stages_on_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_no_language_and_no_label_lose_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words here", None), (2, "a b", None), (3, "...", None), (4, None, None)], "doc_id long, text string, lang string")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, "").collect()} == {1, 2}
    assert corpus_pipeline.civil(spark, docs, str(tmp_path)).count() == 4


def test_predicted_language_decides(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.known_language(spark, docs, sf_dir, ["de", "fr"]).where("lang is not null")
    assert kept.where("lang in ('de', 'fr')").count() >= 0.95 * kept.count() > 0


def test_stages_keep_columns_of_any_name_and_one_row_of_each_group(spark, sf_dir):
    names = ["kept_id", "__text", "score", "predicted", "lang_pred", "ambiguous", "row_number", "kept", "node", "row", "class_id", "label", "piece", "item"]
    docs = spark.createDataFrame([(5, "one two three four five six", "en", *names)] * 3 + [(5, "other words", "en", *names), (None, "other words", "en", *names), (7, "One two  three four, five six", "en", *names), (8, "one two three four five six", "en", *names)], "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        assert all(list(r)[3:] == names for r in docs.collect())
        if name == "exact_dedup":
            assert sorted((r["doc_id"], r["text"][:5]) for r in docs.collect()) == [(5, "other"), (7, "One t"), (8, "one t")]
    assert sorted((r["doc_id"], r["text"][:5]) for r in docs.collect()) == [(5, "other"), (7, "One t")]
    assert corpus_pipeline.packed(spark, docs, sf_dir).count() == 2
    repeated = spark.createDataFrame([(3, "a b c d e f g"), (3, "A b c d e f g"), (3, "a b c d e f g"), (4, "a b c d e f g"), (3, "x")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.one_of_similar(spark, repeated, sf_dir).collect()) == [3, 3]


def test_texts_between_two_languages_go_at_the_first_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {}
    for r in docs.where("length(text) > 600").orderBy("doc_id").collect():
        texts.setdefault(r["lang"], r["text"][:600])
    langs = sorted(texts)
    mixed = [(90_100 + k, texts[a] + " " + texts[b], a, "s", 1) for k, (a, b) in enumerate((a, b) for a in langs for b in langs if a < b)]
    pure = [(90_200 + k, texts[a], a, "s", 1) for k, a in enumerate(langs)]
    added = docs.unionByName(spark.createDataFrame(mixed + pure, docs.schema))
    kept = corpus_pipeline.known_language(spark, added, sf_dir)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {i for i, *_ in pure} <= ids and any(i not in ids for i, *_ in mixed)
    assert len(ids) >= 0.99 * docs.count()
    only = {r["doc_id"] for r in corpus_pipeline.known_language(spark, added, sf_dir, languages=langs[:1]).select("doc_id").collect()}
    assert 90_200 in only and not {90_201, 90_202, 90_203} & only
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == str(corpus_pipeline.BATCH_ROWS)
