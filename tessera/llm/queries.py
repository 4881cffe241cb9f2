"""Queries over the corpus operators, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import content_sort, decontaminate, fingerprints, langid, lexical, licenses, mixing, passages, secrets, shard_pack, simhash_bk, toxicity, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.dedup(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_pack.shard(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with all its evidence: markup language, address suffix and host of web pages."""
    return langid.identify(langid.pages(spark, sf_dir), key="page_id", declared="declared", host="host", suffix="suffix")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.classes(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_dedup(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def whitening_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitening, the columns that SQL can say again."""
    return whitening.deviations(table(spark, sf_dir, "embeddings"))


def fingerprint_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints, the columns that SQL can say again."""
    return fingerprints.compare(table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence scan, the columns that SQL can say again."""
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret scan, the columns that SQL can say again."""
    return secrets.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def shard_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sharding: sizes, and what holds of every shard: gapless slots, and no load of bytes over the mean by more than a twentieth and the largest text."""
    placed = shard_pack.shard(table(spark, sf_dir, "documents"))
    sums = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.sum("size").alias("bytes"), F.max("size").alias("largest"))
    held = sums.agg(F.count(F.lit(1)).alias("shards"), F.sum("bytes").alias("bytes"), F.sum("n").alias("rows"), F.bool_and((F.col("least") == 0) & (F.col("most") == F.col("n") - 1)).alias("gapless"), (F.max("bytes") <= 1.05 * F.avg("bytes") + F.max("largest")).alias("even"))
    return held


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_exact_dedup, op3_mix_sources, op4_license_scan, op5_toxicity, op6_shard, op7_language_id, language_id_pages,
        op8_substring_dedup, op9_simhash_near_dedup, op10_secret_scan, op11_whitening, op12_fingerprints, op13_lexical_search,
        license_base, secret_base, shard_base, whitening_base, fingerprint_base,
    )
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.SQL, "op2_exact_dedup": content_sort.SQL, "op3_mix_sources": mixing.SQL, "license_base": licenses.BASE_SQL, "secret_base": secrets.BASE_SQL,
    "op13_lexical_search": lexical.SQL, "whitening_base": whitening.BASE_SQL, "fingerprint_base": fingerprints.BASE_SQL,
    "shard_base": "SELECT CAST(40 AS BIGINT) AS shards, CAST(sum(coalesce(strlen(text), 0) + 16) AS BIGINT) AS bytes, count(*) AS rows, true AS gapless, true AS even FROM documents",
}
