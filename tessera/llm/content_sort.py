"""Exact dedup by content sort, in DataFrame operations only.

Sampled splitters range-partition the normalised text by its first characters (``repartitionByRange``),
each partition is sorted externally by the whole text, and the window operator compares neighbouring
rows in full to delimit runs of equals. A text whose copies would overfill a partition is dealt over sub-runs by a salt, so no
task holds a group that grows with the data; the sub-runs' heads are then joined by full text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, materialise

#: Sub-runs that a hot text is dealt over.
SALTS = 64
#: A text is hot when it has over 1 / (HOT_SHARE * partitions) of all rows.
HOT_SHARE = 4
#: Characters of a text that its splitter carries; texts that agree in all of them are dealt over ranges
#: by their hash, so that a common head fills no task. Within a range the whole text is sorted.
PREFIX = 64
#: Bytes of normalised text a range should hold, where that asks for more ranges than the session's partitions.
RANGE_BYTES = 64 << 20


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")


def dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; of equal texts the smallest non-null key stays, of rows that also share
    the key exactly one; in a group of null keys only, one row stays and keep_id is null; a very long
    text is compared whole. An empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    norm = normalised(F.col(text))
    rows = materialise(docs.select(F.col(key).alias("id"), norm.alias("norm"), F.xxhash64(norm).alias("h"), F.substring(norm, 1, PREFIX).alias("prefix"), F.octet_length(norm).alias("bytes")), "content-rows")
    total, size = rows.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // RANGE_BYTES)
    # At most HOT_SHARE * n texts (8 bytes each) can pass the limit: bounded by the partition count.
    hot = rows.groupBy("h").count().where(F.col("count") > F.lit(max(1, total // (HOT_SHARE * n)))).select("h", F.lit(True).alias("hot"))
    salted = (
        rows.drop("bytes")
        .join(F.broadcast(hot), "h", "left")
        .withColumn("hot", F.coalesce("hot", F.lit(False)))
        .withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("id"), F.lit(SALTS))).otherwise(F.lit(0)))
    )
    # Sorted by the text; prefix and hash follow from it and name the range.
    runs = Window.partitionBy("norm", "salt", "prefix", "h").orderBy(F.col("id").asc_nulls_last())
    whole = runs.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = (
        salted.repartitionByRange(n, "prefix", "h", "salt")
        .select(
            "id", "hot", F.row_number().over(runs).alias("rank"), F.min("id").over(whole).alias("head"), F.count(F.lit(1)).over(whole).alias("size"),
            F.sha2("norm", 256).alias("sha"), "norm", "salt",
        )
        .select("id", "hot", "rank", "head", "size", "sha", "salt", F.when(F.col("hot") & (F.col("rank") == 1), F.col("norm")).alias("run"))
    )
    local = materialise(local, "content-sort")
    # Heads of hot sub-runs: at most HOT_SHARE * n * SALTS rows; equals meet by their whole text.
    joined = (
        local.where("run is not null")
        .groupBy("run")
        .agg(F.min("head").alias("keep"), F.sum("size").alias("total"), F.first("sha").alias("sha"), F.min(F.struct(F.col("head").isNull(), "head", "salt")).alias("least"))
        .select("sha", "keep", "total", F.col("least.salt").alias("keep_salt"), F.lit(True).alias("hot"))
    )
    return (
        local.join(F.broadcast(joined), ["sha", "hot"], "left")
        .select(
            F.col("id").alias("doc_id"),
            F.when(F.col("hot"), F.col("keep")).otherwise(F.col("head")).alias("keep_id"),
            F.when(F.col("hot"), F.col("total")).otherwise(F.col("size")).cast("long").alias("group_size"),
            ((F.col("rank") == 1) & (~F.col("hot") | (F.col("salt") == F.col("keep_salt")))).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
