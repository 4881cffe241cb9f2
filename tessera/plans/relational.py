"""Read-side queries: joins, counts, sinks, survivorship."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregate as A
from ..operators import match as M
from .common import FOLD, SITES, sites, t

Q, S = {}, {}


def query(sql: str | None = None):
    def put(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return put


@query("SELECT c_mktsegment AS kind, count(*) AS n FROM customer GROUP BY 1")
def stats_by_type(spark, sf):
    return A.count_by(t(spark, sf, "customer").withColumnRenamed("c_mktsegment", "kind"), "kind")


@query("SELECT count(*) AS n_sites, count(*) FILTER (c_acctbal >= 0) AS n_located, count(*) FILTER (c_acctbal < 0) AS n_unlocated, count(DISTINCT c_nationkey) AS n_communes FROM customer")
def export_stats_one_pass(spark, sf):
    return t(spark, sf, "customer").agg(F.count(F.lit(1)).alias("n_sites"), F.count_if(F.col("c_acctbal") >= 0).alias("n_located"), F.count_if(F.col("c_acctbal") < 0).alias("n_unlocated"), F.count_distinct("c_nationkey").alias("n_communes"))


@query(f"WITH {SITES} SELECT site_id, name, commune, kind, o_orderkey AS phase_id, CAST(-800 + o_orderkey % 700 AS BIGINT) AS start_year FROM sites LEFT JOIN orders ON o_custkey = site_id")
def sites_with_phases(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("phase_id"), (F.lit(-800) + F.col("o_orderkey") % 700).cast("long").alias("start_year"))
    return sites(spark, sf).join(o, F.col("site_id") == F.col("o_custkey"), "left").select("site_id", "name", "commune", "kind", "phase_id", "start_year")


@query("SELECT c_custkey AS site_id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_sources FROM customer")
def sites_sources_count(spark, sf):
    n = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t(spark, sf, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("site_id"), F.coalesce("n", F.lit(0)).alias("n_sources"))


@query("SELECT c_custkey AS site_id, c_name AS name, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY o_orderkey), '') AS phases, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_custkey = 7 GROUP BY 1, 2")
def site_detail_nested(spark, sf):
    c = t(spark, sf, "customer").where("c_custkey = 7")
    o = t(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("p"))
    p = F.coalesce("p", F.expr("cast(array() as array<bigint>)"))
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("site_id"), F.col("c_name").alias("name"), F.array_join(p.cast("array<string>"), ";").alias("phases"), F.size(p).cast("long").alias("n"))


@query(f"""WITH {SITES}, src AS (SELECT o_custkey, count(*) AS n, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS refs FROM orders GROUP BY 1)
SELECT site_id, name, commune, coalesce(CAST(o_orderkey AS VARCHAR), '') AS phase, coalesce(n, 0) AS sources_count, coalesce(refs, '') AS refs FROM sites LEFT JOIN orders o ON o.o_custkey = site_id LEFT JOIN src ON src.o_custkey = site_id""")
def csv_denormalised(spark, sf):
    o = t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("phases"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ";").alias("refs"))
    return sites(spark, sf).join(o, F.col("site_id") == F.col("o_custkey"), "left").select("site_id", "name", "commune", F.explode_outer("phases").alias("p"), F.coalesce("n", F.lit(0)).alias("sources_count"), F.coalesce("refs", F.lit("")).alias("refs")).select(
        "site_id", "name", "commune", F.coalesce(F.col("p").cast("string"), F.lit("")).alias("phase"), "sources_count", "refs"
    )


@query("SELECT p_partkey AS id, try_cast(replace(trim(replace(CAST(p_size AS VARCHAR) || '.5', '.', ',')), ',', '.') AS DOUBLE) AS value, nullif(trim(CASE WHEN p_partkey % 5 = 0 THEN '  ' ELSE p_name END), '') AS name, try_cast(p_brand AS DOUBLE) AS bad FROM part")
def sanitize_cells(spark, sf):
    raw = F.regexp_replace(F.concat(F.col("p_size").cast("string"), F.lit(".5")), "[.]", ",")
    return t(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.decimal(raw).alias("value"), text.clean(F.when(F.col("p_partkey") % 5 == 0, "  ").otherwise(F.col("p_name"))).alias("name"), text.decimal(F.col("p_brand")).alias("bad"))


@query("SELECT doc_id, 'SITE-' || substr(md5(source || '|' || CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE CAST(doc_id % 3 AS VARCHAR) END || '|' || substr(text, 1, 500)), 1, 16) AS site_id FROM documents")
def site_id_md5(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.md5_key("SITE-", F.col("source"), F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 3), F.substring("text", 1, 500)).alias("site_id"))


@query("SELECT doc_id, substr(sha256(source || '|' || text), 1, 16) AS key16, substr(sha256(source), 1, 8) AS key8 FROM documents")
def source_fingerprint_sha(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.sha_key(F.concat_ws("|", "source", "text")).alias("key16"), text.sha_key(F.col("source"), 8).alias("key8"))


@query("SELECT l_partkey AS k, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM lineitem GROUP BY 1")
def first_last_wins(spark, sf):
    line = t(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    return line.groupBy(F.col("l_partkey").alias("k")).agg(F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"))


@query("SELECT o_custkey AS k, o_orderkey AS best FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def completeness_ranked(spark, sf):
    return M.first_wins(t(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")]).select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("best"))


@query("SELECT n_duplicated, count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS n_duplicated FROM lineitem) GROUP BY 1")
def duplicated_keys(spark, sf):
    rows = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return M.duplicated(rows, ["l_orderkey", "l_linenumber"], "n_duplicated").groupBy("n_duplicated").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_regionkey AS region, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS survivor, max(c_acctbal) AS surface, string_agg(DISTINCT c_mktsegment, '; ' ORDER BY c_mktsegment) AS kinds, count(*) AS merged FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def survivor_max_surface(spark, sf):
    n = F.broadcast(t(spark, sf, "nation"))
    return t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("region")).agg(
        F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("survivor"), F.max("c_acctbal").alias("surface"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "; ").alias("kinds"), F.count(F.lit(1)).alias("merged")
    )


@query("SELECT k, string_agg(v, ' | ' ORDER BY o, v) AS texts FROM (SELECT o_custkey AS k, o_orderpriority AS v, min(o_orderkey) AS o FROM orders GROUP BY 1, 2) GROUP BY 1")
def ordered_distinct_concat(spark, sf):
    firsts = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v")).agg(F.min("o_orderkey").alias("o"))
    return firsts.groupBy("k").agg(F.array_join(A.ordered_distinct("o", "v"), " | ").alias("texts"))


@query(f"""WITH p AS (SELECT p_size AS k, p_partkey AS o, unnest(string_split(p_name || '; ' || upper(p_name), ';')) AS v FROM part), f AS (
SELECT k, {FOLD.format(c='trim(v)')} AS f, min(o) AS o, upper(arg_min(trim(v), o)) AS v FROM p GROUP BY 1, 2) SELECT CAST(k AS BIGINT) AS k, string_agg(v, '; ' ORDER BY o, v) AS texts FROM f GROUP BY 1""")
def merge_unique_texts(spark, sf):
    rows = t(spark, sf, "part").select(F.col("p_size").cast("long").alias("k"), "p_partkey", F.concat("p_name", F.lit("; "), F.upper("p_name")).alias("v"))
    lists = rows.groupBy("k").agg(A.ordered_distinct("p_partkey", "v").alias("vs"))
    return lists.select("k", F.upper(text.merge_unique(F.col("vs"))).alias("texts"))


@query("""WITH m AS (SELECT l_suppkey AS k, CAST(l_quantity AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2), b AS (SELECT k, arg_max(v, (n, -v)) AS mode FROM m GROUP BY 1)
SELECT k, mode, median, mean, n FROM b JOIN (SELECT l_suppkey AS k, median(l_quantity) AS median, round(avg(l_extendedprice), 3) AS mean, count(*) AS n FROM lineitem GROUP BY 1) USING (k)""")
def mode_median_cluster(spark, sf):
    line = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").cast("long").alias("v"), "l_quantity", "l_extendedprice")
    return A.mode_smallest(line, ["k"], "v").join(line.groupBy("k").agg(F.median("l_quantity").alias("median"), F.round(F.avg("l_extendedprice"), 3).alias("mean"), F.count(F.lit(1)).alias("n")), "k").select("k", "mode", "median", "mean", "n")


_PROFILE = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, count(*) AS n_rows, round(count({c}) / count(*)::DOUBLE, 6) AS fill_rate FROM customer" for c in _PROFILE))
def column_profile(spark, sf):
    return A.profile(t(spark, sf, "customer").select(*_PROFILE))


_SKETCHED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, true AS distinct_within, true AS median_within, {f'arg_max({c}, n)' if 'status' in c or 'priority' in c else 'NULL'} AS most_frequent FROM orders {f'JOIN (SELECT {c}, count(*) AS n FROM orders GROUP BY 1) USING ({c})' if 'status' in c or 'priority' in c else ''}" for c in _SKETCHED))
def column_sketches(spark, sf):
    """Profile from sketches merged over parts: distinct counts within 6 %, medians within 4 % of rank, the most frequent value of the columns with few."""
    o = t(spark, sf, "orders").select(*_SKETCHED)
    told = A.estimates(A.merged_sketches(A.sketches(o.withColumn("part", F.pmod("o_orderkey", F.lit(7))), ["part"])), 1)
    numbers = [c for c, kind in o.dtypes if kind != "string"]
    ranks = told.where(F.col("median").isNotNull()).select(F.col("column_name").alias("c"), "median")
    values = o.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in numbers])).alias("v")).select("v.*")
    shares = values.join(F.broadcast(ranks), "c").groupBy("c").agg(F.avg((F.col("x") <= F.col("median")).cast("double")).alias("upto"), F.avg((F.col("x") < F.col("median")).cast("double")).alias("below"))
    exact = A.profile(o).select("column_name", F.col("n_distinct").alias("exact"))
    few = F.col("column_name").isin("o_orderstatus", "o_orderpriority")
    held = told.join(exact, "column_name").join(shares, F.col("column_name") == F.col("c"), "left")
    return held.select(
        "column_name", "n_rows", "n_null", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_within"),
        F.coalesce((F.col("upto") >= 0.46) & (F.col("below") <= 0.54), F.lit(True)).alias("median_within"), F.when(few, F.get("top", F.lit(0))["value"]).alias("most_frequent"),
    )


@query("WITH f AS (SELECT count(turn) / count(*)::DOUBLE AS r FROM conversations UNION ALL SELECT count(nullif(text, '')) / count(*)::DOUBLE FROM conversations) SELECT round(avg(round(r, 6)), 6) AS mean_fill, CASE WHEN avg(r) >= 0.8 THEN 'HIGH' WHEN avg(r) >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS grade FROM f")
def fill_rate(spark, sf):
    return A.quality(A.profile(t(spark, sf, "conversations").select("turn", F.nullif("text", F.lit("")).alias("text"))))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE regexp_matches(p_type, 'STEEL|BRASS|A') AND p_size IN (1, 5, 10, 20)")
def multi_select_filter(spark, sf):
    return t(spark, sf, "part").where(F.col("p_type").rlike("STEEL|BRASS|A") & F.col("p_size").isin(1, 5, 10, 20)).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query("SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) AS decade, count(*) AS n FROM orders GROUP BY 1")
def decade_histogram(spark, sf):
    return t(spark, sf, "orders").groupBy((F.floor(F.year("o_orderdate") / 10) * 10).cast("long").alias("decade")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH old AS (SELECT doc_id, source, 'old' AS version FROM documents), new AS (SELECT doc_id + 1000000 AS doc_id, source, 'new' AS version FROM documents WHERE source IN ('src1', 'src2'))
SELECT * FROM old WHERE source NOT IN (SELECT source FROM new) UNION ALL SELECT * FROM new""")
def upsert_by_source(spark, sf):
    d = t(spark, sf, "documents")
    new = d.where(F.col("source").isin("src1", "src2")).select((F.col("doc_id") + 1000000).alias("doc_id"), "source", F.lit("new").alias("version"))
    return M.upsert_by_source(d.select("doc_id", "source", F.lit("old").alias("version")), new, "source").select("doc_id", "source", "version")


@query("""SELECT source, count(*) AS total, count(*) FILTER (c AND g) AS retained, count(*) FILTER (NOT c) AS excluded_chrono, count(*) FILTER (c AND NOT g) AS excluded_geo
FROM (SELECT source, n_chars > 500 AS c, lang IN ('fr', 'de') AS g FROM documents) GROUP BY 1""")
def filter_funnel(spark, sf):
    return A.funnel(t(spark, sf, "documents"), "source", F.col("n_chars") > 500, F.col("lang").isin("fr", "de"))


@query("SELECT o_orderkey AS k FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def anti_probe(spark, sf):
    line = t(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return t(spark, sf, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.col("o_orderkey").alias("k"))


@query("SELECT a.o_orderstatus AS p1, b.o_orderstatus AS p2, count(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) a JOIN (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) b ON a.o_custkey = b.o_custkey AND a.o_orderstatus < b.o_orderstatus GROUP BY 1, 2")
def period_cooccurrence(spark, sf):
    d = t(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()
    return d.select("o_custkey", F.col("o_orderstatus").alias("p1")).join(d.select("o_custkey", F.col("o_orderstatus").alias("p2")), "o_custkey").where("p1 < p2").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT p_partkey AS id, unnest([p_size % 30, (p_size + 7) % 30]) AS code, unnest([1, 2]) AS o FROM part)
SELECT id, coalesce(string_agg(n_name, ';' ORDER BY o), '') AS names, count(*) FILTER (n_name IS NULL) AS unresolved FROM c LEFT JOIN nation ON n_nationkey = code GROUP BY 1""")
def code_array_lookup(spark, sf):
    codes = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.posexplode(F.array(F.col("p_size") % 30, (F.col("p_size") + 7) % 30)).alias("o", "code"))
    found = codes.join(F.broadcast(t(spark, sf, "nation")), F.col("n_nationkey") == F.col("code"), "left")
    names = F.filter(F.transform(F.array_sort(F.collect_list(F.struct("o", "n_name"))), lambda s: s["n_name"]), lambda n: n.isNotNull())
    return found.groupBy("id").agg(F.array_join(names, ";").alias("names"), F.count_if(F.col("n_name").isNull()).alias("unresolved"))


@query(f"""WITH r AS (SELECT {FOLD.format(c='p_brand')} || '|' || {FOLD.format(c='p_type')} AS s0, p_partkey FROM part), s AS (SELECT trim(regexp_replace(s0, '[^a-z0-9]+', '-', 'g'), '-') AS slug, p_partkey FROM r)
SELECT l.p_partkey AS id, m.match_id, m.n_ids, m.n_ids > 1 AS ambiguous FROM s l JOIN (SELECT slug, min(p_partkey) AS match_id, count(DISTINCT p_partkey) AS n_ids FROM s GROUP BY 1) m USING (slug)""")
def slug_match_ambiguity(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return M.slug_match(p, p, ["p_brand", "p_type"], "p_partkey").select(F.col("p_partkey").alias("id"), "match_id", "n_ids", "ambiguous")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_events(spark, sf):
    from ..streaming.events import tumbling

    return tumbling(t(spark, sf, "events")).withColumn("total", F.round("total", 4))


@query("""WITH g AS (SELECT c_nationkey AS k, avg(c_acctbal) AS v FROM customer WHERE c_custkey % 2 = 0 AND c_nationkey < 8 GROUP BY 1), s AS (SELECT c_nationkey AS k, avg(c_acctbal) AS v FROM customer WHERE c_nationkey < 20 GROUP BY 1)
SELECT s_suppkey AS id, CASE WHEN g.v IS NOT NULL THEN 'golden' WHEN s.v IS NOT NULL THEN 'sites' ELSE 'none' END AS strategy, round(coalesce(g.v, s.v), 3) AS x FROM supplier LEFT JOIN g ON g.k = s_nationkey LEFT JOIN s ON s.k = s_nationkey""")
def cascade_geocode(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey", "c_acctbal")
    mean = lambda df: df.groupBy("k").agg(F.avg("c_acctbal").alias("x"))
    left = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("k"))
    out = M.cascade(left, "k", [("golden", mean(c.where("c_custkey % 2 = 0 and k < 8"))), ("sites", mean(c.where("k < 20")))], ["x"])
    return out.select("id", "strategy", F.round("x", 3).alias("x"))
