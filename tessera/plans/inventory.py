"""Queries over the smaller derivations: extents, grain tests, summaries, labels, grammars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from .common import LAT, LON, lat, lon, t
from .relational import query

#: Upper Rhine box of the plausibility rule.
BOX = (6.5, 47.5, 7.5, 48.5)
#: Iron age in years; longer spans than SPAN say nothing about it.
IRON, SPAN = (-800, -25), 1200


@query(f"SELECT p_partkey AS site_id FROM part WHERE {LON.format(k='p_partkey')} BETWEEN {BOX[0]} AND {BOX[2]} AND {LAT.format(k='p_partkey')} BETWEEN {BOX[1]} AND {BOX[3]}")
def bbox_containment(spark, sf):
    k = F.col("p_partkey")
    return t(spark, sf, "part").where(lon(k).between(BOX[0], BOX[2]) & lat(k).between(BOX[1], BOX[3])).select(k.alias("site_id"))


@query(f"""WITH p AS (SELECT l_orderkey AS id, l_linenumber AS line, CAST(-1500 + l_orderkey % 2000 AS BIGINT) AS a, CAST(l_orderkey * 37 % 1500 AS BIGINT) AS span FROM lineitem)
SELECT id, line, a, a + span AS b FROM p WHERE a <= {IRON[1]} AND a + span >= {IRON[0]} AND span <= {SPAN}""")
def interval_overlap_filter(spark, sf):
    k = F.col("l_orderkey")
    p = t(spark, sf, "lineitem").select(k.alias("id"), F.col("l_linenumber").alias("line"), (F.lit(-1500) + k % 2000).cast("long").alias("a"), (k * 37 % 1500).cast("long").alias("span"))
    return p.where((F.col("a") <= IRON[1]) & (F.col("a") + F.col("span") >= IRON[0]) & (F.col("span") <= SPAN)).select("id", "line", "a", (F.col("a") + F.col("span")).alias("b"))


@query(f"SELECT n_name AS commune, round(avg({LON.format(k='c_custkey')}), 6) AS lon, round(avg({LAT.format(k='c_custkey')}), 6) AS lat, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def mean_position_by_commune(spark, sf):
    k = F.col("c_custkey")
    by = t(spark, sf, "customer").groupBy("c_nationkey").agg(F.avg(lon(k)).alias("x"), F.avg(lat(k)).alias("y"), F.count(F.lit(1)).alias("n"))
    return by.join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("commune"), F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"), "n")


@query(f"SELECT min({LON.format(k='c_custkey')}) AS west, max({LON.format(k='c_custkey')}) AS east, min({LAT.format(k='c_custkey')}) AS south, max({LAT.format(k='c_custkey')}) AS north, max({LAT.format(k='c_custkey')}) > 200 AS metric FROM customer")
def geographic_extent(spark, sf):
    x, y = lon(F.col("c_custkey")), lat(F.col("c_custkey"))
    return t(spark, sf, "customer").agg(F.min(x).alias("west"), F.max(x).alias("east"), F.min(y).alias("south"), F.max(y).alias("north"), (F.max(y) > 200).alias("metric"))


@query("SELECT count(*) AS ids, round(avg(n), 6) AS mean_rows, max(n) AS most_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def grain_test(spark, sf):
    n = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("ids"), F.round(F.avg("n"), 6).alias("mean_rows"), F.max("n").alias("most_rows"))


@query("SELECT lang, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS characters, round(avg(length(text)), 6) AS mean_length, max(length(text)) AS longest FROM documents GROUP BY 1")
def text_corpus_stats(spark, sf):
    n = F.length("text")
    return t(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), F.sum(n).alias("characters"), F.round(F.avg(n), 6).alias("mean_length"), F.max(n).cast("long").alias("longest"))


_LABELS = ("STEEL", "BRASS", "ANODIZED", "POLISHED", "SMALL")


@query("SELECT label, count(*) AS n FROM part JOIN (VALUES " + ", ".join(f"('{x}')" for x in _LABELS) + ") v(label) ON contains(p_type, label) GROUP BY 1")
def label_counts(spark, sf):
    """A row counts in every label that its text contains; rows meet the fixed list, not each other."""
    held = F.filter(F.array(*[F.lit(x) for x in _LABELS]), lambda x: F.contains(F.col("p_type"), x))
    return t(spark, sf, "part").select(F.explode(held).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag AS label, count(*) FILTER (l_quantity > 25) AS positive, CAST(sum(CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def positive_summaries(spark, sf):
    many = F.col("l_quantity") > 25
    return t(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("label")).agg(F.count_if(many).alias("positive"), F.sum(F.when(many, F.col("l_quantity")).otherwise(0)).cast("long").alias("total"))


@query("SELECT CASE WHEN toxic = 0 THEN quality END AS kind, count(*) AS n FROM labels GROUP BY 1")
def group_null_kept(spark, sf):
    return t(spark, sf, "labels").groupBy(F.when(F.col("toxic") == 0, F.col("quality")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS phase_id, CAST(abs(a) AS VARCHAR) || ' – ' || CAST(abs(b) AS VARCHAR) || ' av. J.-C.' AS label FROM (SELECT o_orderkey, CAST(-800 + o_orderkey % 700 AS BIGINT) AS a, CAST(-800 + o_orderkey % 700 + 50 AS BIGINT) AS b FROM orders)")
def date_labels(spark, sf):
    a = (F.lit(-800) + F.col("o_orderkey") % 700).cast("long")
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("phase_id"), F.concat(F.abs(a).cast("string"), F.lit(" – "), F.abs(a + 50).cast("string"), F.lit(" av. J.-C.")).alias("label"))


@query("SELECT doc_id, CASE WHEN length(text) > 400 THEN substr(text, 1, 399) || '…' ELSE coalesce(text, '') END AS summary FROM documents")
def truncated_summary(spark, sf):
    c = F.col("text")
    return t(spark, sf, "documents").select("doc_id", F.when(F.length(c) > 400, F.concat(F.substring(c, 1, 399), F.lit("…"))).otherwise(F.coalesce(c, F.lit(""))).alias("summary"))


@query("SELECT doc_id, CAST((text IS NOT NULL AND text <> '') AS INT) + CAST((lang IS NOT NULL AND lang <> '') AS INT) + CAST((source IS NOT NULL AND source <> '') AS INT) + CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 0 END AS completeness FROM documents")
def completeness_score(spark, sf):
    filled = [F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in ("text", "lang", "source")]
    return t(spark, sf, "documents").select("doc_id", (filled[0] + filled[1] + filled[2] + F.when(F.col("doc_id") % 4 == 0, 2).otherwise(0)).alias("completeness"))


@query("SELECT c_custkey AS site_id, column_name AS sub, CAST(-800 + 100 * i AS INT) AS start_year FROM (SELECT c_custkey, unnest([{'column_name': 'Ha C', 'i': 0, 'f': c_custkey % 2}, {'column_name': 'Ha D', 'i': 2, 'f': c_custkey % 3}, {'column_name': 'LT A', 'i': 4, 'f': c_custkey % 5}], recursive := true) FROM customer) WHERE f > 0")
def flags_to_phases(spark, sf):
    k = F.col("c_custkey")
    flags = [F.when(text.truthy(k % m), F.struct(F.lit(sub).alias("sub"), F.lit(-800 + 100 * i).alias("start_year"))) for sub, i, m in (("Ha C", 0, 2), ("Ha D", 2, 3), ("LT A", 4, 5))]
    return t(spark, sf, "customer").select(k.alias("site_id"), F.inline(F.array_compact(F.array(*flags))))
