"""Every operator and stage takes hard rows and empty tables."""

import corpus_pipeline
import pytest
from llm.conftest import EN
from pyspark.sql import functions as F

from swathbook.llm import language, mixing, near_documents, near_lines, phrases, quality, sharding, token_counts, topk, url_filter
from swathbook.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the house of the old man stands by the river and the"), (1, "the house of the old man stands by the river and the"), (None, "hi"), (3, None), (4, ""), (5, "--")], "item_id long, text string")


def test_language(hard, none):
    model = language.fit_languages(hard)
    got = language.identify_languages(hard, model).select("doc_id", "text", "lang_pred", "lang_score", "score").collect()
    assert len(got) == hard.count()
    by_text = {r["text"]: (r["lang_pred"], r["lang_score"]) for r in got}
    assert [by_text[t] for t in (None, "", "!!!")] == [("und", 0.0)] * 3
    assert all(0 <= r["lang_score"] <= 1 and r["score"] in ("x", None) for r in got)
    assert language.fit_languages(none) is None
    assert language.identify_languages(none, None).count() == 0
    assert {r["lang_pred"] for r in language.identify_languages(hard, None).collect()} == {"und"}


def test_token_counts(hard, none):
    got = {(r["doc_id"], r["text"]): r["n_tokens"] for r in token_counts.token_counts(hard, VOCABULARY).collect()}
    assert got[(4, "")] == got[(5, None)] == 0 and all(n > 0 for (_, t), n in got.items() if t)
    assert token_counts.token_counts(none, VOCABULARY).count() == 0


def test_quality(spark, hard, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (3, 0), (8, 1), (9, 0), (None, 1), (77, 1)], "doc_id long, good int")
    model = quality.fit_quality(hard, labels, ["good"])
    got = quality.score_quality(hard, model, ["good"]).collect()
    assert len(got) == hard.count() and all(0 <= r["p_good"] <= 1 for r in got)
    assert quality.fit_quality(none, labels, ["good"]) is None
    assert quality.fit_quality(hard, labels.limit(0), ["good"]) is None
    assert {r["p_good"] for r in quality.score_quality(hard, None, ["good"]).collect()} == {None}
    assert quality.score_quality(none, model, ["good"]).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://A.b.example.org/es/x?q"), (1, "http://A.b.example.org/es/x?q"), (2, None), (3, "nothing"), (4, "x://"), (None, "http://k/"), (5, "https://net?x"), (6, "http://shop.co.uk#f")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (9, 0), (4, None)], "doc_id long, outcome int")
    got = url_filter.judge_urls(pages, labels, [("example.org", "/es/", "block"), ("org", "/", "allow")]).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"]) for r in got) == sorted(
        [(1, "a.b.example.org", "/es/x", "example.org/es/")] * 2 + [(2, "", "", None), (3, "", "", None), (4, "", "", None), (0, "k", "/", None), (5, "net", "", None), (6, "shop.co.uk", "", None)], key=str
    ) or len(got) == 8
    assert url_filter.judge_urls(pages.limit(0), labels, []).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, labels.limit(0), []).collect()} == {"allow"}


def test_lines(hard, none):
    got = near_lines.near_lines(hard).collect()
    lines = hard.select(F.explode(F.split("text", "\n", -1)).alias("l")).count()
    assert len(got) == lines and all(r["kept"] for r in got if r["line"] == "")
    assert {r["id"] if "id" in r else r["doc_id"] for r in got if r["line"].startswith("the house") and r["kept"]} == {None}
    assert near_lines.near_lines(none).count() == 0


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [0.0]), (None, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantise("embedding").alias("v"))
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, df.where("vec_id = 0"), 5).orderBy("rank").collect()]
    assert got == [(1, 1, 327680), (2, 6, 0), (3, 7, 0)]
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_near_documents(hard, none):
    got = near_documents.near_duplicates(hard).collect()
    assert len(got) == hard.count()
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], set()).add((r["class_id"], r["class_rows"]))
    assert of[0] == of[8] == {(0, 5)} and of[6] == of[7] == {(6, 2)} and of[5] == {(5, 1)} and of[4] == {(4, 1)}
    assert of[None] == {(0, 5), (None, 1)}
    assert near_documents.near_duplicates(none).count() == 0


def test_shards(hard, none):
    got = sharding.assign_shards(hard, ["lang", "source", "n_chars"]).collect()
    assert len(got) == hard.count()
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(none, ["lang", "source", "n_chars"]).count() == 0


def test_phrases(hard, none, items):
    got = phrases.phrase_matches(hard, items).withColumn("n_hit", phrases.hit_words()).collect()
    by = {(r["doc_id"], r["text"]): (r["phrase_hits"]["items"], r["n_hit"]) for r in got}
    assert len(got) == hard.count() and by[(0, EN)] == (["1"], 12) and by[(9, "Hi")] == (["null"], 1)
    assert by[(5, None)] == by[(4, "")] == ([], 0)
    assert phrases.phrase_matches(none, items).count() == 0
    assert {r["phrase_hits"]["n_words"] for r in phrases.phrase_matches(hard, items.limit(0)).where("doc_id = 9").collect()} == {1}


def test_mixing(hard, none):
    documents, pieces = mixing.mix(hard)
    assert documents.count() == hard.count() and all(r["taken"] <= 2 * r["size"] for r in documents.collect())
    assert [d.count() for d in mixing.mix(none)] == [0, 0]


def test_stages(spark, hard, none, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (hard, none):
        columns = docs.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, str(tmp_path))
            assert got.columns[: len(columns)] == columns, name
            assert (len(got.columns) == len(columns)) == (k < len(corpus_pipeline.STAGES) - 1), name
            rows = got.count()
            assert rows <= 2 * docs.count()
    kept = corpus_pipeline.drop_near_duplicates(spark, hard, "").collect()
    assert sum(r["text"] == hard.first()["text"] for r in kept) == 1 and sum(r["text"] is None for r in kept) == 2
