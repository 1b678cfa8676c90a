"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm._io import new_path, stored


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.near import jaccard_components

    return jaccard_components(_read(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.licenses import scan_licenses

    return scan_licenses(_read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.warc import round_trip

    return round_trip(_read(spark, sf_dir, "pages"), new_path(spark, "warc"), min_bytes=0)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores every text as a progressive JPEG, reads the files back, stores
    their RGB tensors and takes the feature from the tensors read back."""
    from loadstone.llm.media import decode_media, encode_media, tensor_features

    media = stored(encode_media(_read(spark, sf_dir, "documents").select("doc_id", "text")), "media")
    return tensor_features(stored(decode_media(media, feature=False), "tensors"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.decontam import find_leaks

    return find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.toxicity import fit, held_out, score_toxicity

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = fit(docs, _read(spark, sf_dir, "labels"))
    return score_toxicity(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from loadstone.llm.tokens import count_tokens

    return count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose a repeated passage, with what is left of them."""
    from loadstone.llm.substrings import dedup_substrings

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).where("removed_bytes > 0").select("doc_id", "held_by", "removed_spans", "removed_bytes", "text")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.htmltext import extract, fit

    pages = _read(spark, sf_dir, "pages")
    return extract(pages, fit(pages))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.mixing import mix_sources

    mixed = mix_sources(_read(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("positions", lambda p: F.round(p * 1e9).cast("long").cast("string")), ",")
    return mixed.select(
        "doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken", F.round("position", 9).alias("position"),
        F.round("last_position", 9).alias("last_position"), listed.alias("positions"),
    )


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers' tokens aligned; the digest is of the groups, the counts are corpus-wide."""
    import public_tokenizers

    from loadstone.llm.align import align_tokens, vocabulary_sizes, with_link_counts

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = align_tokens(_read(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    table = stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    found = with_link_counts(table, vocabulary_sizes(*paths)[1])
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loadstone.llm.divergence import audit

    return audit(_read(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and its ids decoded."""
    import public_tokenizers

    from loadstone.llm.bpe import decode, encode

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    decoded = decode(encode(_read(spark, sf_dir, "documents"), vocabulary), vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_media, op3_decontamination, op4_toxicity, op5_token_counts, op6_license_scan, op7_warc, op8_substring_dedup, op9_main_text, op10_mixing, op11_align, op12_divergence, op13_bpe)}


def oracle_sql() -> dict[str, str]:
    from loadstone.llm import divergence, mixing, near, warc

    return {"op12_divergence": divergence.ORACLE, "op1_jaccard_join": near.ORACLE, "op7_warc": warc.ORACLE, "op10_mixing": mixing.ORACLE}
