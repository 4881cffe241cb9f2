"""Summaries: counts, profiles, survivorship aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_by(df: DataFrame, key: str, *, nulls: bool = True) -> DataFrame:
    """Rows per value, most first, ties by value."""
    rows = df if nulls else df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(key))


def funnel(df: DataFrame, source: str, chrono_ok: Column, geo_ok: Column) -> DataFrame:
    """Per source: total, retained, and those excluded by date and by place, in that order."""
    flagged = df.withColumn("__c", chrono_ok).withColumn("__g", geo_ok)
    return flagged.groupBy(source).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("__c") & F.col("__g")).alias("retained"), F.count_if(~F.col("__c")).alias("excluded_chrono"), F.count_if(F.col("__c") & ~F.col("__g")).alias("excluded_geo")
    )


def profile(df: DataFrame) -> DataFrame:
    """One row a column, exact: nulls, distinct values, rows, fill rate.

    Each column is grouped by its values on its own, so a columnar table is read once in all and no row
    is copied per column; a hot value is counted before the shuffle. ``sketches`` needs one aggregate and no shuffle of values.
    """
    parts = []
    for c in df.columns:
        held = df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        total = lambda n: F.coalesce(F.sum(n), F.lit(0))
        parts.append(held.agg(total("n").alias("n_rows"), total(F.when(F.col("v").isNull(), F.col("n"))).alias("n_null"), F.count("v").alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_null", "n_distinct", "n_rows"))
    return reduce(DataFrame.union, parts).withColumn("fill_rate", F.when(F.col("n_rows") > 0, F.round(1 - F.col("n_null") / F.col("n_rows"), 6)))


#: Size of the sketches: distinct counts to 2**12 registers (standard error 1.6 %), quantiles to 1.7 % of rank, and
#: the values that a frequency sketch tracks.
REGISTERS, QUANTILES, TRACKED = 12, 200, 1000


def sketches(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mergeable profile: by, column_name, n_rows, n_null and the sketches ``values``, ``quantiles``, ``frequent``.

    One aggregate over all columns, of a bounded size per group and column; nothing is copied per column. Quantiles
    are null for columns that are no numbers.
    """
    by = by or []
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    names = [c for c in df.columns if c not in by]
    aggs = []
    for i, c in enumerate(names):
        text = F.col(f"`{c}`").cast("string")
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}"), F.hll_sketch_agg(text, REGISTERS).alias(f"v{i}")]
        aggs.append((F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), QUANTILES) if c in numeric else F.first(F.lit(None).cast("binary"))).alias(f"q{i}"))
        aggs.append(F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"f{i}"))
    held = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null"), F.col(f"v{i}").alias("values"), F.col(f"q{i}").alias("quantiles"), F.col(f"f{i}").alias("frequent")) for i, c in enumerate(names)]
    return held.select(*by, "n_rows", F.explode(F.array(*parts)).alias("s")).select(*by, "n_rows", "s.*")


def merged_sketches(held: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of the parts' union, per column and ``by``."""
    keys = [*(by or []), "column_name"]
    return held.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    )


def estimates(held: DataFrame, k: int = 3) -> DataFrame:
    """What sketches say: n_rows, n_null, n_distinct, median (null for columns that are no numbers) and the k most frequent values with their counts."""
    ranked = F.filter(F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(k + 1)), lambda x: x["item"].isNotNull())  # null is an item there
    top = F.transform(F.slice(ranked, 1, k), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("n")))
    median = F.when(F.col("quantiles").isNotNull() & (F.kll_sketch_get_n_double("quantiles") > 0), F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5)))
    return held.select(*[c for c in held.columns if c not in ("values", "quantiles", "frequent")], F.hll_sketch_estimate("values").alias("n_distinct"), median.alias("median"), top.alias("top"))


def quality(profile_rows: DataFrame) -> DataFrame:
    """Mean fill rate and its grade."""
    mean = F.avg("fill_rate")
    return profile_rows.agg(F.round(mean, 6).alias("mean_fill"), F.when(mean >= 0.8, "HIGH").when(mean >= 0.5, "MEDIUM").otherwise("LOW").alias("grade"))


def mode_smallest(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value of each group, the smallest of equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col(value))).alias("mode"))


def ordered_distinct(order: str, value: str) -> Column:
    """Aggregate: distinct values in the order of their first row."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
