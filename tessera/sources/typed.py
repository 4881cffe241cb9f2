"""Typed readers of the known sources: a table of text cells in, raw records out.

Each takes the cells as read (``sources.readers`` reads the files) and returns the columns of a raw
record: raw_text, commune, type_mention, periode_mention, latitude_raw, longitude_raw,
extraction_method and the text map ``extra``. Missing columns count as empty cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import grammar, rules, text
from ..operators.fuzzy import nested
from ..operators.match import first_wins


def _cell(df: DataFrame, *names: str) -> Column:
    """Trimmed text of the first of these columns that holds any; empty without."""
    held = [F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*held, F.lit("")) if held else F.lit("")


def _extra(**cells: Column) -> Column:
    """Text map of the cells that hold something."""
    pairs = F.create_map(*[x for k, c in cells.items() for x in (F.lit(k), c.cast("string"))])
    return F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != ""))


def _record(df: DataFrame, method: str, *, raw: Column, commune: Column, kind: Column, period: Column | None = None, lat: Column | None = None, lon: Column | None = None, extra: Column, keep: Sequence[str] = ()) -> DataFrame:
    none = lambda t: F.lit(None).cast(t)
    empty = lambda c: none("string") if c is None else F.nullif(c, F.lit(""))
    return df.select(
        *keep, raw.alias("raw_text"), empty(commune).alias("commune"), empty(kind).alias("type_mention"), empty(period).alias("periode_mention"), (lat if lat is not None else none("double")).alias("latitude_raw"),
        (lon if lon is not None else none("double")).alias("longitude_raw"), F.lit(method).alias("extraction_method"), extra.alias("extra"),
    )


def _area(department: Column, departments: Sequence[int] | None, *, keep_text: bool) -> Column:
    """Whether a department cell is wanted; a cell that is no number is kept or not."""
    number = department.try_cast("int")
    return F.lit(True) if not departments else F.coalesce(number.isin(*departments), F.lit(keep_text))


def undated(first: Column, last: Column) -> Column:
    """Rows to leave out: no stated period, or one that ends after the Roman age."""
    a, b = F.lower(first), F.lower(last)
    none = ((a == "indéterminé") & b.isin("", "indéterminé")) | ((a == "") & (b == "indéterminé"))
    late = lambda c: F.coalesce(F.regexp_extract(c, vocab.DATE_PAIR_PATTERN, 2).try_cast("int") > vocab.LAST_ROMAN_YEAR, F.lit(False))
    return none | late(first) | late(last)


def exchange_rows(df: DataFrame, *, filtered: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Exchange format of a site platform: date pairs, character, centroid flag, tagged comments."""
    c = lambda n: _cell(df, n)
    first, last, note = c("STARTING_PERIOD"), c("ENDING_PERIOD"), c("COMMENTS")
    year = lambda col, g: F.regexp_extract(col, vocab.DATE_PAIR_PATTERN, g).try_cast("int")
    tags = F.map_filter(text.tags(note), lambda k, v: k.isin(*vocab.COMMENT_KEYS) & (v != "") & (v != "--"))
    german = F.lit(False)
    for mark in vocab.GERMAN_DATABASES:
        german = german | F.contains(F.lower(c("DATABASE_NAME")), F.lit(mark))
    own = _extra(
        SITE_AKG_ID=c("SITE_AKG_ID"), SITE_SOURCE_ID=c("SITE_SOURCE_ID"), DATABASE_NAME=c("DATABASE_NAME"), OCCUPATION=c("OCCUPATION"), CARAC_LVL1=c("CARAC_LVL1"),
        precision_localisation=rules.precision(c("CITY_CENTROID"), note), datation_debut=year(first, 1), datation_fin=F.coalesce(year(last, 2), year(first, 2)), pays=F.when(german, "DE"),
    )
    said = F.when((first != "") | (last != ""), F.concat_ws(" / ", first, last))
    rows = df.where(~undated(first, last)) if filtered else df
    return _record(rows, "arkeogis", raw=text.pairs_text([x for x in df.columns if x not in keep]), commune=F.coalesce(F.nullif(c("MAIN_CITY_NAME"), F.lit("")), c("SITE_NAME")), kind=rules.character_type(c("CARAC_LVL1")), period=said, lat=text.decimal(c("LATITUDE")), lon=text.decimal(c("LONGITUDE")), extra=F.map_concat(own, tags), keep=keep)


def flagged_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a protohistoric base with a period flag; the flags that are set go along."""
    c = lambda n: _cell(df, n)
    flags = F.filter(F.array(*[F.when(~c(k).isin("", "0", "0.0"), k) for k in vocab.FLAG_COLUMNS]), lambda x: x.isNotNull())
    extra = _extra(phases_bool=F.array_join(flags, ","), EA=c("EA"), type_precision=c("type_precision"), lieu_dit=c("lieu_dit"))
    kind = F.coalesce(F.nullif(c("type_site"), F.lit("")), F.lit(vocab.UNKNOWN))
    return _record(df.where(F.size(flags) > 0), "bdd_proto_alsace", raw=F.concat_ws(" ", c("commune"), c("lieu_dit"), c("type_site")), commune=c("commune"), kind=kind, period=c("datation_1"), extra=extra, keep=keep)


def necropolis_rows(df: DataFrame, departments: Sequence[int] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Necropoles; with ``departments`` a department that is no number is left out."""
    c = lambda n: _cell(df, n)
    number = lambda n: F.nullif(c(n).try_cast("double"), F.lit(0.0))
    x, y = number("Coordonnées x (Lambert 93)"), number("Coordonnées y (Lambert 93)")
    both = x.isNotNull() & y.isNotNull()
    extra = _extra(lieu_dit=c("Nom"), x_l93=F.when(both, x), y_l93=F.when(both, y), epsg_source=F.when(both, "2154"))
    rows = df.where(_area(c("Dept"), departments, keep_text=False))
    return _record(rows, "necropoles", raw=F.concat_ws(" ", c("Commune"), c("Nom"), c("Datation")), commune=c("Commune"), kind=F.lit("nécropole"), period=c("Datation"), extra=extra, keep=keep)


def rich_rows(df: DataFrame, departments: Sequence[int] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Settlements and rich graves; totals and blank departments go, one that is no number stays."""
    c = lambda n: _cell(df, n)
    land = c("Dept/Land")
    rows = df.where(~land.rlike(vocab.PARASITIC_DEPARTMENT) & _area(land, departments, keep_text=True))
    country = rules.country(c("Pays"))
    return _record(rows, "habitats_tombes_riches", raw=F.concat_ws(" ", country, c("Commune"), c("Lieudit"), F.lower(c("type"))), commune=c("Commune"), kind=rules.rich_type(c("type")), extra=_extra(pays=country, dept_land=land, lieu_dit=c("Lieudit")), keep=keep)


def silo_rows(df: DataFrame, order: str, departments: Sequence[int] | None = None) -> DataFrame:
    """Individuals to sites: number, first position, last department, envelope of the radiocarbon ranges.

    Groups are commune and place; sums and minima are partly aggregated before the shuffle.
    """
    land = _cell(df, "Département")
    number = lambda *n: F.nullif(F.regexp_replace(F.replace(_cell(df, *n), F.lit(","), F.lit(".")), " ", "").try_cast("double"), F.lit(0.0))
    x, y, c14 = number("X(L93)", "X_L93"), number("Y(L93)", "Y_L93"), _cell(df, "14C (2 sigma)", "C14")
    year = lambda g: -F.regexp_extract(c14, "(?i)" + vocab.RADIOCARBON_PATTERN, g).try_cast("int")
    rows = df.where(~land.rlike(vocab.PARASITIC) & _area(land, departments, keep_text=True)).select(
        F.col(order).alias("o"), _cell(df, "Site", "Commune").alias("commune"), _cell(df, "Lieu dit", "Lieu-dit").alias("place"), land.alias("dept"), F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y"))).alias("p"), year(1).alias("c_from"), year(2).alias("c_to")
    )
    sites = rows.groupBy("commune", "place").agg(F.count(F.lit(1)).alias("n"), F.min_by("p", F.when(F.col("p").isNotNull(), F.col("o"))).alias("p"), F.max_by("dept", "o").alias("dept"), F.min("c_from").alias("c_from"), F.max("c_to").alias("c_to"))
    extra = _extra(individus_count=F.col("n"), lieu_dit=F.col("place"), x_l93=F.col("p.x"), y_l93=F.col("p.y"), epsg_source=F.when(F.col("p").isNotNull(), "2154"), datation_14c_debut=F.col("c_from"), datation_14c_fin=F.col("c_to"))
    return _record(sites, "inhumations_silos", raw=F.concat(F.col("commune"), F.lit(" "), F.col("place"), F.lit(" ("), F.col("n").cast("string"), F.lit(" individus)")), commune=F.col("commune"), kind=F.lit("nécropole"), extra=extra)


def funerary_rows(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows under a flattened two-row header 'group.sub': site text split into commune and place, datings joined, all cells kept."""
    bare = lambda n: F.when(~F.trim(F.col(f"`{n}`").cast("string")).isin("", "*"), F.trim(F.col(f"`{n}`").cast("string")))
    site, land = _cell(df, "info SITE.SITE"), _cell(df, "info SITE.DPT")
    split = rules.commune_place(site)
    cells = [n for n in df.columns if n not in keep]
    dated = F.concat_ws(" / ", *[bare(n) for n in cells if "DATATION" in n.upper()])
    held = F.map_filter(F.create_map(*[x for n in cells for x in (F.lit(n), bare(n))]), lambda _, v: v.isNotNull())
    extra = F.map_concat(_extra(departement=land, lieu_dit=split["place"]), held)
    return _record(df.where(site != ""), "afeaf", raw=F.concat_ws(" ", land, site), commune=split["commune"], kind=F.lit("nécropole"), period=dated, extra=extra, keep=keep)


def side_table(df: DataFrame, order: str) -> DataFrame:
    """Positions and periods by code of an attribute file: code, x, y, chrono; the last row of a code counts."""
    c = lambda n: _cell(df, n)
    said = F.coalesce(*[F.nullif(c(n), F.lit("")) for n in ("CHRONO", "EUR_PERIODE", "PERIODE")])
    decoded = rules.mapped(F.lower(said), {k.lower(): v for k, v in vocab.PERIOD_CODES.items()}, said)
    number = lambda n: F.nullif(c(n).try_cast("double"), F.lit(0.0))
    both = number("X_DEGRE").isNotNull() & number("Y_DEGRE").isNotNull()
    rows = df.select(F.col(order).alias("o"), c("EA_NATCODE").alias("code"), F.when(both, F.struct(number("X_DEGRE").alias("x"), number("Y_DEGRE").alias("y"))).alias("p"), F.when(said.isNotNull(), decoded).alias("chrono")).where("code <> ''")
    last = lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), F.col("o")))
    return rows.groupBy("code").agg(last("p").alias("p"), last("chrono").alias("chrono"))


def register_rows(df: DataFrame, side: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A site register: the ' / ' identifier parsed, position and period from ``side_table`` by national code, else by number."""
    c = lambda n: _cell(df, n)
    rows = df.withColumn("__code", c("Code_national_de_l_EA")).withColumn("__num", c("Numero_de_l_EA")).withColumn("__id", text.identifier(c("Identification_de_l_EA")))
    none = F.lit(None)
    if side is None:
        rows = rows.withColumn("__p", none.cast("struct<x:double,y:double>")).withColumn("__chrono", none.cast("string"))
    else:
        for key in ("code", "num"):
            rows = rows.join(side.select(F.col("code").alias(f"__k_{key}"), F.col("p").alias(f"__p_{key}"), F.col("chrono").alias(f"__c_{key}")), F.col(f"__{key}") == F.col(f"__k_{key}"), "left")
        rows = rows.withColumn("__p", F.coalesce("__p_code", "__p_num")).withColumn("__chrono", F.coalesce("__c_code", "__c_num"))
    extra = _extra(patriarche_ea=F.col("__num"), patriarche_code_national=F.col("__code"), lieu_dit=F.col("__id.place"), chrono_dbf=F.col("__chrono"))
    commune = F.coalesce("__id.commune", c("Nom_de_la_commune"))
    return _record(rows, "patriarche", raw=c("Identification_de_l_EA"), commune=commune, kind=F.col("__id.type"), period=F.coalesce("__id.period", "__chrono"), lat=F.col("__p.y"), lon=F.col("__p.x"), extra=extra, keep=keep)


def workbook_rows(sites: DataFrame, occupations: DataFrame, furniture: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Linked sheets: sites with their occupations, these with their furniture; type and datings of the occupations."""
    text_of = lambda df, cols: df.select(*[_cell(df, a).alias(b) for a, b in cols.items()])
    occ = text_of(occupations, {"id_occupation": "id", "fk_site": "fk", "type": "type", "datation": "datation", "commentaire_occupation": "commentaire"})
    mob = text_of(furniture, {"fk_occupation": "fk", "type_mobilier": "type_mobilier", "NR_mobilier": "nr", "NMI_mobilier": "nmi"})
    occ = nested(occ, "id", mob, "fk", ["type_mobilier", "nr", "nmi"], "mobilier", ["type_mobilier", "nr", "nmi"])
    rows = nested(sites.withColumn("__id", _cell(sites, "id_site")), "__id", occ, "fk", ["type", "datation", "commentaire", "mobilier"], "occupations", ["id"])
    c = lambda n: _cell(sites, n)
    x, y, epsg = c("x").try_cast("double"), c("y").try_cast("double"), F.coalesce(c("epsg_coord").try_cast("double").cast("int"), F.lit(4326))
    flat = epsg == 2154
    extra = _extra(id_site=F.col("__id"), pays=c("pays"), admin1=c("admin1"), lieu_dit=c("lieu_dit"), x_l93=F.when(flat, x), y_l93=F.when(flat, y), epsg_source=F.when(epsg != 4326, epsg), occupations=F.to_json("occupations"))
    dated = F.array_join(F.filter(F.transform("occupations", lambda o: o["datation"]), lambda d: d != ""), " / ")
    raw = F.concat(F.lit("site "), F.col("__id"), F.lit(": "), c("commune"), F.lit(" - "), c("lieu_dit"))
    at = lambda v: F.when(epsg == 4326, v)
    return _record(rows, "alsace_basel", raw=raw, commune=c("commune"), kind=rules.occupation_type(F.transform("occupations", lambda o: o["type"])), period=dated, lat=at(y), lon=at(x), extra=extra, keep=keep)


def notice_rows(docs: DataFrame, doc: str, body: str, label: str) -> DataFrame:
    """Commune notices of a text, by coded parts, where they name a dating or remains."""
    parts = grammar.notice_records(grammar.sub_notices(grammar.notices(docs, doc, body)))
    extra = _extra(cag_commune_id=F.col("number"), source_label=F.lit(label), lieu_dit=F.col("code"), bibliographie=F.array_join("citations", "; "), datation_mentions=F.array_join("datings", ";"), vestiges_mentions=F.array_join("remains", ";"))
    return _record(parts, f"cag_notice_{label}", raw=F.substring("part", 1, 500), commune=F.col("commune"), kind=F.col("type_mention"), period=F.col("periode_mention"), extra=extra, keep=(doc,))


def catalogue_rows(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One record a document and commune of a library catalogue: its stated communes, else those of its scope.

    docs: ark, title, geographic_scope, communes_mentioned, mentions_found, categories, relevance, year.
    """
    none = F.expr("cast(array() as array<string>)")
    stated, scope = F.coalesce("communes_mentioned", none), F.coalesce("geographic_scope", F.lit(""))
    rows = docs.withColumn("__commune", F.explode(F.when(F.size(stated) > 0, stated).otherwise(rules.scope_places(scope))))
    kind = rules.mention_type(F.coalesce("mentions_found", none), F.coalesce("categories", none), F.col("__commune"))
    extra = _extra(ark=F.col("ark"), year=F.col("year"), relevance=F.col("relevance"))
    return _record(rows, "gallica_metadata", raw=F.concat(F.coalesce("title", F.lit("")), F.lit(" — "), scope), commune=F.col("__commune"), kind=kind, extra=extra, keep=keep)


def is_page(body: Column) -> Column:
    """Whether a fetched text is text: not an HTML page (a refusal or a captcha)."""
    return ~F.coalesce(F.contains(F.lower(F.substring(body, 1, 200)), F.lit("<html")), F.lit(True))


def ark_path(ark: Column) -> Column:
    """An ark identifier without its address or prefix, safe as a file name."""
    return F.regexp_replace(F.regexp_replace(ark, r"^(?:https?://[^/]+/)?(?:ark:/)?", ""), r"[^A-Za-z0-9]+", "_")


def first_known(spark, candidates: Sequence[str]):
    """The first path that Spark can read (a loader's chain of fallbacks), read by its suffix."""
    from .readers import read_source

    failed = []
    for path in candidates:
        try:
            return read_source(spark, path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            failed.append(path)
    raise FileNotFoundError(f"none of {failed} exists")


def last_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key (insert or replace)."""
    return first_wins(df, [key], [F.col(order).desc()])
