"""Row-level operators: filters, validation with quarantine, normalisation of raw records into sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import chrono, geo, text
from .machine import running_count, states


def area_ok(country: Column, department: Column, departments: Sequence[int] | None = (67, 68), countries: Sequence[str] | None = ("FR", "DE", "CH")) -> Column:
    """A missing country or department passes; None as a list lets all pass."""
    c = F.upper(F.trim(country))
    named = F.coalesce((c == "") | c.isin(*countries), F.lit(True)) if countries else F.lit(True)
    return named & (F.coalesce(department.isin(*departments), F.lit(True)) if departments else F.lit(True))


def split_rejects(df: DataFrame, rejects: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined with the array ``rejects``)."""
    judged = df.withColumn("rejects", F.filter(rejects, lambda r: r.isNotNull()))
    return judged.where(F.size("rejects") == 0).drop("rejects"), judged.where(F.size("rejects") > 0)


def site_rejects(x: Column, y: Column, period: Column, sub: Column, name: Column) -> Column:
    """Broken constraints of a site: name, bounds, sub-period of its period."""
    admitted = F.lit(True)
    for label, subs in vocab.ADMITTED.items():
        admitted = F.when(period == label, sub.isin(*subs)).otherwise(admitted)
    return F.array(
        F.when(F.coalesce(name, F.lit("")) == "", "name_missing"),
        F.when(~x.between(0, 1_300_000), "x_out_of_bounds"), F.when(~y.between(6_000_000, 7_200_000), "y_out_of_bounds"), F.when(sub.isNotNull() & ~admitted, "sub_period_mismatch"),
    )


def geo_warnings(x: Column, y: Column) -> Column:
    x0, x1, y0, y1 = vocab.UPPER_RHINE
    return F.filter(F.array(F.when(~x.between(x0, x1), "x outside the Upper Rhine"), F.when(~y.between(y0, y1), "y outside the Upper Rhine")), lambda w: w.isNotNull())


def normalise(raw: DataFrame) -> DataFrame:
    """Raw records (scalar fields and map ``extra``) to sites, in one projection without Python."""
    e = lambda k: F.try_element_at("extra", F.lit(k))
    given = e("x_l93").isNotNull() & e("y_l93").isNotNull()
    px, py = geo.to_lambert93(F.col("longitude_raw"), F.col("latitude_raw"))
    x, y = F.when(given, text.decimal(e("x_l93"))).otherwise(px), F.when(given, text.decimal(e("y_l93"))).otherwise(py)
    stated, period = e("precision_localisation"), chrono.period(F.coalesce(F.nullif("periode_mention", F.lit("")), "raw_text"))
    place = text.toponym(F.coalesce("commune", F.lit("")))
    sid = text.md5_key("SITE-", F.col("source_path"), F.col("page_number"), F.substring("raw_text", 1, 500))
    ids = F.map_filter(F.create_map(*[F.lit(x) if isinstance(x, str) else x for pair in (("patriarche_ea", e("patriarche_ea")), ("patriarche_code_national", e("patriarche_code_national")), ("arkeogis_id", e("SITE_AKG_ID")), ("alsace_basel_id", e("id_site"))) for x in pair]), lambda k, v: v.isNotNull() & (v != ""))
    country = F.upper(e("pays"))
    return raw.withColumn("__id", sid).withColumn("__p", period).withColumn("__t", place).select(
        F.col("__id").alias("site_id"), F.coalesce(F.nullif("commune", F.lit("")), F.lit("Inconnu")).alias("nom_site"), F.col("__t.variants").alias("variantes_nom"),
        F.when(country.isin("DE", "CH"), country).otherwise("FR").alias("pays"), F.lit("Alsace").alias("region_admin"), F.col("__t.name").alias("commune"), x.alias("x_l93"), y.alias("y_l93"),
        F.when((stated == "exact") | (x.isNotNull() & F.coalesce(stated != "centroïde", F.lit(True))), "exact").when(stated == "approx", "approx").otherwise("centroïde").alias("precision_localisation"),
        F.when(F.coalesce("type_mention", F.lit("")) != "", text.site_type(F.col("type_mention"))).otherwise(vocab.UNKNOWN).alias("type_site"), ids.alias("identifiants_externes"),
        F.array(F.struct(F.concat("__id", F.lit("-PH1")).alias("phase_id"), F.col("__id").alias("site_id"), F.col("__p.period").alias("periode"), F.col("__p.sub").alias("sous_periode"), F.lit(None).cast("int").alias("datation_debut"), F.lit(None).cast("int").alias("datation_fin"))).alias("phases"),
        F.array(F.struct(F.concat("__id", F.lit("-SRC1")).alias("source_id"), F.col("__id").alias("site_id"), F.col("source_path").alias("reference"), F.when(F.col("extraction_method") == "gallica_ocr", "gallica_cag").when(F.col("extraction_method") == "pdf", "publication").otherwise("tableur").alias("type_source"))).alias("sources"),
    )


def sections(lines: DataFrame, doc: str, order: str, line: str, header: str) -> DataFrame:
    """Lines grouped into sections: from a header match to the next (lines before the first are section 0)."""
    marked = running_count(lines, doc, order, F.col(line).rlike(header), "section")
    return marked.groupBy(doc, "section").agg(F.array_sort(F.collect_list(F.struct(order, line))).alias("l")).select(doc, "section", F.array_join(F.transform("l", lambda s: s[line]), "\n").alias("body"), F.size("l").alias("n_lines"))


def blank_cutoff(pages: DataFrame, doc: str, page: str, blank: Column, run: int = 3) -> DataFrame:
    """Pages up to the end of the first run of ``run`` blank ones: a machine that counts them and stops there."""
    table = [[0, i + 1] for i in range(run)] + [[run, run]]
    return states(pages, doc, page, F.coalesce(blank, F.lit(False)).cast("int"), table).where(F.col("before") < run).drop("before", "after")
