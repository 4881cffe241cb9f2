"""Reports and reading helpers: quality, profiles, statistics, option lists, column inference."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .. import vocab
from ..functions import rules
from .aggregate import count_by, profile


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row a table: name and rows."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.union(one)
    return out


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order, nulls left out: what a drop-down offers."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def top(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """The k most frequent values (a top-k report)."""
    return count_by(df.where(F.col(key).isNotNull()), key).limit(k)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 12) -> DataFrame:
    """Page ``number`` (from 0) of a sorted table."""
    return df.orderBy(*order).offset(number * size).limit(size)


def samples(df: DataFrame, order: Sequence[Column], k: int = 20) -> DataFrame:
    """The first k rows in a stated order (a sample sink)."""
    return df.orderBy(*order).limit(k)


def column_report(df: DataFrame, k: int = 3) -> DataFrame:
    """Profile with the type of each column, its share of nulls in percent and its k least values as text."""
    kinds = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    least = [df.select(F.lit(c).alias("column_name"), F.substring(F.col(f"`{c}`").cast("string"), 1, 100).alias("v")).where("v is not null").distinct().orderBy("v").limit(k) for c in df.columns]
    held = reduce(DataFrame.union, least).groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("v")), "; ").alias("sample_values"))
    return profile(df).join(held, "column_name", "left").withColumn("sample_values", F.coalesce("sample_values", F.lit(""))).withColumn("dtype", F.try_element_at(kinds, F.col("column_name"))).withColumn("null_pct", F.when(F.col("n_rows") > 0, F.round(100 * F.col("n_null") / F.col("n_rows"), 1)))


def lowest_filled(profile_rows: DataFrame, k: int = 5) -> DataFrame:
    """The k least filled columns, ties by name."""
    return profile_rows.orderBy("fill_rate", "column_name").limit(k).select("column_name", "fill_rate")


def quality_report(df: DataFrame, samples_of: Sequence[str], distributions: Sequence[str], k: int = 3) -> DataFrame:
    """One JSON text: rows, least values of some columns, counts by value of others."""
    counts = [F.map_from_entries(F.array_sort(F.collect_list(F.struct("v", "n")))).alias("m")]
    parts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.slice(F.array_sort(F.collect_set(c)), 1, k).alias(f"sample_{c}") for c in samples_of])
    for c in distributions:
        dist = df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")).agg(F.count(F.lit(1)).alias("n")).agg(*counts).withColumnRenamed("m", f"by_{c}")
        parts = parts.crossJoin(dist)
    return parts.select(F.to_json(F.struct("*")).alias("report"))


def bibliography(df: DataFrame, author: str, year: str) -> tuple[DataFrame, DataFrame]:
    """(authors, first and last year; works by decade)."""
    facts = df.agg(F.count_distinct(author).alias("n_authors"), F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count(F.lit(1)).alias("n"))
    decades = df.where(F.col(year).isNotNull()).groupBy((F.floor(F.col(year) / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("n"))
    return facts, decades


def relevance_reason(periods: Column, types: Column, commune_iron: Column) -> Column:
    """Why an index entry matters: period, strong type, both, its commune alone, or nothing; arrays and a flag."""
    strong = F.exists(types, lambda t: t.isin(*vocab.STRONG_TYPES))
    p = F.size(periods) > 0
    return F.when(~p & ~strong & commune_iron, "commune_notice_uniquement").when(p & strong, "periode_et_type").when(p, "periode_ou_cross").when(strong, "type_site_fort").otherwise("autre")


def relevant(periods: Column, types: Column, commune_iron: Column) -> Column:
    return (F.size(periods) > 0) | commune_iron | F.exists(types, lambda t: t.isin(*vocab.STRONG_TYPES))


def quality_probes(df: DataFrame) -> DataFrame:
    """One row: doubled quotes, zero coordinates, unnamed columns, empty columns."""
    lat, lon, _ = geo_columns(df.columns)
    quotes = sum((F.count_if(F.contains(F.col(f"`{c}`").cast("string"), F.lit('""'))) for c in df.columns), F.lit(0))
    number = lambda c: F.col(f"`{c}`").cast("string").try_cast("double")
    zero = F.count_if((number(lat) == 0) | (number(lon) == 0)) if lat and lon else F.lit(0)
    empty = sum((F.when(F.count(F.col(f"`{c}`")) == 0, 1).otherwise(0) for c in df.columns), F.lit(0))
    return df.agg(quotes.alias("doubled_quotes"), zero.cast("long").alias("zero_coordinates"), F.lit(sum(c.startswith("Unnamed") for c in df.columns)).cast("long").alias("unnamed_columns"), empty.cast("long").alias("empty_columns"))


def geo_columns(columns: Sequence[str]) -> tuple[str | None, str | None, str | None]:
    """(latitude, longitude, projection) columns by their candidate names, whatever their case."""
    low = {c.lower(): c for c in columns}
    return tuple(next((low[k] for k in vocab.GEO_COLUMNS[kind] if k in low), None) for kind in ("lat", "lon", "epsg"))


def id_column(columns: Collection[str]) -> str | None:
    return next((c for c in vocab.ID_COLUMNS if c in columns), None)


def source_context(path: Column, database: Column) -> Column:
    """struct(export_date, platform, database) from a file's name and its database cell."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    day = F.regexp_extract(name, r"^(\d{4})(\d{2})(\d{2})", 0)
    platform = F.lit("Inconnu")
    for mark, title in reversed(vocab.PLATFORMS):
        platform = F.when(F.contains(name, F.lit(mark)), title).otherwise(platform)
    date = F.when(day != "", F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))
    return F.struct(date.alias("export_date"), F.when(database.isNotNull(), "ArkeoGIS").otherwise(platform).alias("platform"), database.alias("database"))


def enum_columns(df: DataFrame, k: int = 30) -> list[str]:
    """Columns whose first k values (by content) are oui, non, probable or indeterminate.

    A window's limit keeps k values a column before the shuffle and after it: no more reach the driver.
    """
    known = {"oui", "non", "probable", "indéterminé", "indetermine", "*", ""}
    open_ = [c for c, t in df.dtypes if t == "string" and not any(s in c.lower() for s in vocab.NOT_ENUMS)]
    if not open_:
        return []
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lower(F.trim(F.col(f"`{c}`"))).alias("v")) for c in open_])).alias("x")).select("x.*")
    first = cells.where("v is not null").distinct().withColumn("at", F.row_number().over(Window.partitionBy("c").orderBy("v"))).where(F.col("at") <= k)
    held: dict[str, set[str]] = {}
    for c, v in first.select("c", "v").collect():
        held.setdefault(c, set()).add(v)
    return [c for c in open_ if (h := held.get(c)) and (h <= known or (len(h) <= 6 and h & {"oui", "non", "probable", "indéterminé"}))]


def normalise_enums(df: DataFrame) -> DataFrame:
    return df.withColumns({c: rules.enum_cell(F.col(f"`{c}`")) for c in enum_columns(df)})


def display(df: DataFrame) -> DataFrame:
    """Arrays joined by '; ', maps and structs as JSON: cells for display."""
    def show(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.array_join(c, "; ").alias(f.name)
        return F.to_json(c).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c

    return df.select(*[show(f) for f in df.schema.fields])


def flat_sites(sites: DataFrame) -> DataFrame:
    """Sites for a table view: distinct periods in order, envelope of the datings, references joined."""
    field = lambda f: F.array_sort(F.array_distinct(F.filter(F.transform("phases", lambda p: p[f]), lambda x: x.isNotNull() & (x != ""))))
    periods = F.array_join(field("periode"), ", ")
    return sites.withColumns({
        "periodes": F.when(periods == "", vocab.UNKNOWN).otherwise(periods), "sous_periodes": F.array_join(field("sous_periode"), ", "),
        "datation_debut": F.array_min(F.transform("phases", lambda p: p["datation_debut"])), "datation_fin": F.array_max(F.transform("phases", lambda p: p["datation_fin"])),
        "references": F.array_join(F.transform("sources", lambda s: s["reference"]), "; "),
    }).drop("phases", "sources")


class SchemaError(ValueError):
    """A loaded table is not what was expected."""


def expect(df: DataFrame, *, columns: Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """``df`` if it has exactly these columns, in order, and so many rows."""
    if columns is not None and df.columns != list(columns):
        raise SchemaError(f"columns are {df.columns}, expected {list(columns)}")
    if rows is not None and (n := df.count()) != rows:
        raise SchemaError(f"{n} rows, expected {rows}")
    return df
