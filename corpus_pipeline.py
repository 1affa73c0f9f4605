"""From raw documents to shards of a training mix: each stage works on all rows that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathbook.llm.language import fit_languages, identify_languages
from swathbook.llm.mixing import mix
from swathbook.llm.near_documents import SPREAD, near_duplicates
from swathbook.llm.phrases import phrase_matches
from swathbook.llm.shared import write_table
from swathbook.llm.sharding import assign_shards

#: A prediction below this score rejects a document.
MIN_LANGUAGE_SCORE = 0.35

#: (spark, docs, sf_dir) to the docs that stay
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as the one column doc, so that helper columns cannot clash with its own; ``doc.*`` unpacks it."""
    return docs.select(F.struct(*docs.columns).alias("doc"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no language (null, or without a letter) and those whose language is quite uncertain.

    Without any labelled text there is no model; then nothing but texts without a letter is rejected. Repeated rows
    fare alike, an empty table stays empty, other columns may have any name.
    """
    model = fit_languages(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify_languages(_packed(docs), model, "doc.text")
    return found.where((F.col("lang_pred") != "und") & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class: of its first text, the row with the smallest id (nulls last).

    Of several rows with that id and text, the one of the smallest hash of all columns. Rows with a null text are no
    duplicates of anything and stay; an empty table stays empty, other columns may have any name.
    """
    found = write_table(near_duplicates(docs, spread=SPREAD).select(F.col("doc_id").alias("id"), "text_key", "class_key").where("text_key is not null"), "classes")
    heads = found.where("text_key = class_key").groupBy("text_key").agg(F.min("id").alias("id"))
    heads = heads.withColumn("head", F.lit(True))
    rows = found.groupBy("text_key", "id").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("l.text_key") == F.col("r.text_key")) & F.col("l.id").eqNullSafe(F.col("r.id"))
    judged = rows.alias("l").join(heads.alias("r"), same, "left").select("l.text_key", "l.id", "n", "head")
    keyed = _packed(docs).withColumn("key", F.md5("doc.text"))
    match = lambda other: (F.col("key") == other["text_key"]) & F.col("doc.doc_id").eqNullSafe(other["id"])
    going, repeated = judged.where("head is null"), judged.where("head and n > 1")
    going = going.unionByName(repeated)
    stay = keyed.join(going, match(going), "left_anti")
    once = keyed.join(repeated, match(repeated), "left_semi").groupBy("key").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return stay.select("doc.*").unionByName(once.select("doc.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with an exact occurrence of a benchmark window.

    Null texts have no words and stay; repeated rows fare alike, an empty table on either side drops nothing, other
    columns may have any name.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = phrase_matches(_packed(docs), items, text="doc.text", near=False)
    return found.where(F.size("phrase_hits.spans") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources have their target shares.

    A reading of a document counts as a row if the mix takes half its words or more, so that texts stay whole.
    Documents without a word (a null text among them) are no part of a mix and go; repeated rows are each read, an empty table stays empty,
    other columns may have any name.
    """
    numbered = write_table(_packed(docs).withColumn("number", F.monotonically_increasing_id()), "numbered")
    documents, pieces = mix(numbered, id="number", source="doc.source", text="doc.text")
    read = pieces.groupBy("id", "turn").agg(F.sum(F.col("last") - F.col("first")).alias("words"))
    sizes = documents.select("id", "size")
    copies = read.join(sizes, "id").where("2 * words >= size").groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    held = numbered.join(copies, numbered["number"] == copies["id"])
    return held.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard, slot and curve_index: runs of nearly equal bytes along a Hilbert curve through the metadata.

    Columns of these names are replaced, others may have any name. Every row is placed, those with nulls and
    repeated ones too; an empty table stays empty.
    """
    numbered = write_table(_packed(docs).withColumn("number", F.monotonically_increasing_id()), "numbered")
    placed = assign_shards(numbered, ["doc.lang", "doc.source", "doc.n_chars"], id="number", text="doc.text")
    added = ["shard", "slot", "curve_index"]
    kept = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in added]
    return numbered.join(placed.select("number", *added), "number").select(*kept, *added)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

#: Language models and consistent weighted sampling are beyond SQL; tests/llm/test_stages.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
