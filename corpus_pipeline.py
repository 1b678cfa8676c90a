"""A corpus in five stages: toxicity, near duplicates, repeated passages,
benchmark leaks, mixing.

Each stage takes what the stage before kept, as a Parquet table, and all but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm import decontam, mixing, near, substrings, toxicity
from loadstone.llm._io import stored


def _rest(docs: DataFrame) -> F.Column:
    """All columns but text as one, so that no name of theirs can clash with one of an operator."""
    return F.struct(F.lit(0).alias(""), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")


def _as_before(docs: DataFrame, **new: F.Column) -> list[F.Column]:
    """The columns of docs from text and :func:`_rest`."""
    return [new[c].alias(c) if c in new else F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; learned from the labels of these documents.

    Null and empty texts have the score of a text without known words; rows
    without doc_id are scored and have no label; without labels all have one score.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.fit(docs, labels)
    return toxicity.score_toxicity(docs.select("text", _rest(docs)), machine).where("predicted = 0").select(*_as_before(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the Jaccard join the text with the least doc_id, in one row.

    A document is a doc_id with a text: where a doc_id has several texts, each is
    linked and kept by itself, and of equal ids the one with the least hash of its text.
    Of rows with equal id and text the one that is least as JSON stays.  Null and
    empty texts are groups of their own; rows without doc_id are linked with nothing and stay.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("hash")))
    keyed = docs.select(key.alias("doc_id"), "text", _rest(docs))
    found = near.jaccard_components(keyed.select("doc_id", "text"))
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = keyed.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text"), F.min_by("rest", F.to_json("rest")).alias("rest"))
    return named.select(*_as_before(docs)).union(docs.where(F.col("doc_id").isNull()))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place holds; n_chars follows.

    All rows stay; null and empty texts and rows without doc_id are unchanged.
    """
    out = substrings.dedup_substrings(docs.select("doc_id", "text", _rest(docs)))
    if "n_chars" not in docs.columns:
        return out.select(*_as_before(docs))
    n_chars = F.when(F.col("removed_bytes") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest.n_chars"))
    return out.select(*_as_before(docs, n_chars=n_chars))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage near a benchmark item.

    Rows without doc_id are told apart by their text, so a leak goes with or
    without an id; null and empty texts stay; of rows that repeat a doc_id all go
    if one has a leak.  Without benchmark items all stay.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    keyed = docs.select(key.alias("doc_id"), "text", _rest(docs))
    leaks = decontam.find_leaks(keyed.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return keyed.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*_as_before(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, and when: one row per row of docs.

    Null texts have size 0, a null source is a source, rows without doc_id and
    repeated rows each count; empty documents give an empty frame.
    """
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: Trained and hash-based stages have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
