"""Queries over the typed sources and the normaliser, on cells made of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rows as R
from ..sources import typed
from .common import t
from .relational import query


def _s(c):
    return c.cast("string")


def _at(key):
    return F.coalesce(F.try_element_at("extra", F.lit(key)), F.lit(""))


@query("""WITH d AS (SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN '-800:-620' WHEN 1 THEN 'Indéterminé' WHEN 2 THEN '' WHEN 3 THEN '-50:700' ELSE '-450:-380' END AS a, CASE s_suppkey % 7 WHEN 0 THEN 'indéterminé' WHEN 1 THEN '-260:-200' ELSE '' END AS b, s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN n_name ELSE '' END AS city, CASE WHEN s_suppkey % 2 = 0 THEN 'Oui' ELSE 'Non' END AS cen, CASE WHEN s_suppkey % 4 = 0 THEN 'ADAB 2011' ELSE 'Alsace' END AS db, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT id, coalesce(nullif(city, ''), name) AS commune, CASE WHEN a <> '' OR b <> '' THEN a || ' / ' || b ELSE '' END AS period, CASE WHEN contains(a, ':') THEN split_part(a, ':', 1) ELSE '' END AS start_year, CASE WHEN contains(b, ':') THEN split_part(b, ':', 2) WHEN contains(a, ':') THEN split_part(a, ':', 2) ELSE '' END AS end_year, CASE WHEN cen = 'Oui' THEN 'centroïde' ELSE 'approx' END AS precision, CASE WHEN db = 'ADAB 2011' THEN 'DE' ELSE '' END AS pays, CAST(id AS DOUBLE) + 0.5 AS lon
FROM d WHERE NOT (lower(a) = 'indéterminé' AND b IN ('', 'indéterminé')) AND NOT (a = '' AND b = 'indéterminé') AND NOT coalesce(try_cast(split_part(a, ':', 2) AS INT) > 500, false)""")
def exchange_records(spark, sf):
    """The exchange format: filter of undated and late rows, dates, precision, country."""
    k = F.col("s_suppkey")
    d = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        k.alias("id"), _s(k).alias("SITE_AKG_ID"), F.when(k % 4 == 0, "ADAB 2011").otherwise("Alsace").alias("DATABASE_NAME"), F.col("s_name").alias("SITE_NAME"), F.when(k % 3 == 0, F.col("n_name")).otherwise("").alias("MAIN_CITY_NAME"),
        F.concat(_s(k), F.lit(",5")).alias("LONGITUDE"), F.when(k % 2 == 0, "Oui").otherwise("Non").alias("CITY_CENTROID"),
        F.when(k % 5 == 0, "-800:-620").when(k % 5 == 1, "Indéterminé").when(k % 5 == 2, "").when(k % 5 == 3, "-50:700").otherwise("-450:-380").alias("STARTING_PERIOD"), F.when(k % 7 == 0, "indéterminé").when(k % 7 == 1, "-260:-200").otherwise("").alias("ENDING_PERIOD"),
    )
    r = typed.exchange_rows(d, filtered=True, keep=["id"])
    said = F.coalesce("periode_mention", F.lit(""))
    return r.select("id", "commune", said.alias("period"), _at("datation_debut").alias("start_year"), _at("datation_fin").alias("end_year"), _at("precision_localisation").alias("precision"), _at("pays").alias("pays"), F.col("longitude_raw").alias("lon"))


@query("""WITH d AS (SELECT o_orderkey AS id, o_custkey % 40 AS site, o_custkey % 3 AS place, CASE o_orderkey % 9 WHEN 0 THEN 'TOTAL 3' WHEN 1 THEN '' WHEN 2 THEN '57' WHEN 3 THEN 'BW' ELSE '67' END AS dept, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey + 0.5 END AS x, CASE WHEN o_orderkey % 5 = 0 THEN 700 + o_orderkey % 90 END AS c1, CASE WHEN o_orderkey % 5 = 0 THEN 500 + o_orderkey % 50 END AS c2 FROM orders)
SELECT 'S' || site AS commune, 'L' || place AS place, CAST(count(*) AS VARCHAR) AS n, coalesce(CAST(arg_min(x, id) FILTER (x IS NOT NULL) AS VARCHAR), '') AS x, coalesce(CAST(-max(c1) AS VARCHAR), '') AS c_from, coalesce(CAST(-min(c2) AS VARCHAR), '') AS c_to FROM d WHERE dept IN ('67', 'BW') GROUP BY site, place""")
def silo_records(spark, sf):
    """Individuals to sites: counts, first position, radiocarbon envelope; totals and other departments go."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    d = t(spark, sf, "orders").select(
        k.alias("ord"), F.when(k % 9 == 0, "TOTAL 3").when(k % 9 == 1, "").when(k % 9 == 2, "57").when(k % 9 == 3, "BW").otherwise("67").alias("Département"), F.concat(F.lit("S"), _s(c % 40)).alias("Site"), F.concat(F.lit("L"), _s(c % 3)).alias("Lieu dit"),
        F.when(k % 4 == 0, F.concat(_s(k), F.lit(",5"))).alias("X(L93)"), F.when(k % 4 == 0, "6 800 000").alias("Y(L93)"), F.when(k % 5 == 0, F.concat(_s(700 + k % 90), F.lit(" - "), _s(500 + k % 50), F.lit(" av. J.-C."))).alias("14C (2 sigma)"),
    )
    r = typed.silo_rows(d, "ord", [67])
    return r.select("commune", _at("lieu_dit").alias("place"), _at("individus_count").alias("n"), _at("x_l93").alias("x"), _at("datation_14c_debut").alias("c_from"), _at("datation_14c_fin").alias("c_to"))


@query("""WITH d AS (SELECT c_custkey AS id, c_custkey % 2 = 0 AS hc, c_custkey % 3 = 0 AS hd, c_custkey % 5 = 0 AS lt, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT id, n_name AS commune, array_to_string(list_filter([CASE WHEN hc THEN 'BF3_HaC' END, CASE WHEN hd THEN 'HaD' END, CASE WHEN lt THEN 'LTCD' END], lambda x: x IS NOT NULL), ',') AS flags, CASE WHEN id % 7 = 0 THEN 'habitat' ELSE 'indéterminé' END AS kind FROM d WHERE hc OR hd OR lt""")
def flagged_records(spark, sf):
    """Rows with a period flag."""
    k = F.col("c_custkey")
    flag = lambda n: F.when(k % n == 0, "1").otherwise("0.0")
    d = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(k.alias("id"), F.col("n_name").alias("commune"), flag(2).alias("BF3_HaC"), flag(3).alias("HaD"), F.lit("").alias("LTAB"), flag(5).alias("LTCD"), F.when(k % 7 == 0, "habitat").alias("type_site"))
    return typed.flagged_rows(d, keep=["id"]).select("id", "commune", _at("phases_bool").alias("flags"), F.col("type_mention").alias("kind"))


@query("""WITH d AS (SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'Total' WHEN 1 THEN '67' WHEN 2 THEN '57' WHEN 3 THEN 'BW' WHEN 4 THEN '68' ELSE ' ' END AS land FROM customer)
SELECT id, 'rich' AS origin, land, CASE WHEN id % 2 = 0 THEN 'FR' ELSE 'DE' END AS pays, CASE WHEN id % 4 = 0 THEN 'oppidum' ELSE 'nécropole' END AS kind FROM d WHERE land IN ('67', '68', 'BW') UNION ALL SELECT id, 'necropolis', land, '', 'nécropole' FROM d WHERE land IN ('67', '68')""")
def regional_records(spark, sf):
    """Two sources under a department filter: one keeps departments that are no number, the other does not."""
    k = F.col("c_custkey")
    land = F.when(k % 6 == 0, "Total").when(k % 6 == 1, "67").when(k % 6 == 2, "57").when(k % 6 == 3, "BW").when(k % 6 == 4, "68").otherwise(" ")
    d = t(spark, sf, "customer").select(k.alias("id"), land.alias("land"), land.alias("Dept/Land"), land.alias("Dept"), F.when(k % 2 == 0, "F").otherwise("d").alias("Pays"), F.when(k % 4 == 0, "Site fortifié").otherwise("tombe").alias("type"), F.lit("x").alias("Commune"))
    rich = typed.rich_rows(d, [67, 68], keep=["id", "land"]).select("id", F.lit("rich").alias("origin"), "land", _at("pays").alias("pays"), F.col("type_mention").alias("kind"))
    necro = typed.necropolis_rows(d, [67, 68], keep=["id", "land"]).select("id", F.lit("necropolis").alias("origin"), "land", F.lit("").alias("pays"), F.col("type_mention").alias("kind"))
    return rich.union(necro)


@query("""WITH side AS (SELECT 'N' || p_partkey % 50 AS code, arg_max(p_partkey, p_partkey) FILTER (p_size > 5) AS x, arg_max(CASE WHEN p_size % 2 = 0 THEN 'Âge du Fer' ELSE 'libre' END, p_partkey) FILTER (p_size % 3 > 0) AS chrono FROM part GROUP BY 1),
d AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'N' || s_suppkey % 70 ELSE 'Z' END AS code, 'N' || s_suppkey % 60 AS num, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT id, CASE WHEN id % 3 = 0 THEN n_name ELSE 'COLMAR' END AS commune, CAST(coalesce(a.x, b.x) AS DOUBLE) AS lon, CASE WHEN id % 3 <> 0 THEN 'Age du fer' ELSE coalesce(a.chrono, b.chrono) END AS period FROM d LEFT JOIN side a ON a.code = d.code LEFT JOIN side b ON b.code = num""")
def register_records(spark, sf):
    """A register with a side table by national code, else by number; of a code's rows the last counts."""
    k, p = F.col("s_suppkey"), F.col("p_partkey")
    side = typed.side_table(t(spark, sf, "part").select(p.alias("o"), F.concat(F.lit("N"), _s(p % 50)).alias("EA_NATCODE"), F.when(F.col("p_size") > 5, _s(p)).alias("X_DEGRE"), F.lit("48.5").alias("Y_DEGRE"), F.when(F.col("p_size") % 3 > 0, F.when(F.col("p_size") % 2 == 0, "EURFER").otherwise("libre")).alias("CHRONO")), "o")
    ident = F.when(k % 3 == 0, F.concat(F.lit("1 / x"))).otherwise("1 / 68 001 / COLMAR /  / Lieu / habitat / Age du fer")
    d = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(k.alias("id"), ident.alias("Identification_de_l_EA"), F.concat(F.lit("N"), _s(k % 60)).alias("Numero_de_l_EA"), F.when(k % 2 == 0, F.concat(F.lit("N"), _s(k % 70))).otherwise("Z").alias("Code_national_de_l_EA"), F.col("n_name").alias("Nom_de_la_commune"))
    return typed.register_rows(d, side, keep=["id"]).select("id", "commune", F.col("longitude_raw").alias("lon"), F.col("periode_mention").alias("period"))


@query("""WITH o AS (SELECT o_custkey AS fk, o_orderkey AS k, list_extract(['inconnu', 'grande enceinte', 'tombe', 'hab_ouv'], CAST(o_orderkey % 4 + 1 AS BIGINT)) AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'D' || o_orderkey ELSE '' END AS d FROM orders)
SELECT c_custkey AS id, coalesce(arg_min(CASE kind WHEN 'grande enceinte' THEN 'oppidum' WHEN 'tombe' THEN 'nécropole' WHEN 'hab_ouv' THEN 'habitat' END, lpad(CAST(k AS VARCHAR), 12, '0')) FILTER (kind <> 'inconnu'), 'indéterminé') AS kind, coalesce(string_agg(d, ' / ' ORDER BY lpad(CAST(k AS VARCHAR), 12, '0')) FILTER (d <> ''), '') AS period, count(k) AS n FROM customer LEFT JOIN o ON fk = c_custkey GROUP BY 1""")
def linked_records(spark, sf):
    """Linked sheets: the first resolvable type of a site's occupations and all their datings."""
    k = F.col("o_orderkey")
    pad = lambda c: F.lpad(_s(c), 12, "0")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("inconnu", "grande enceinte", "tombe", "hab_ouv")]), (k % 4 + 1).cast("int"))
    occ = t(spark, sf, "orders").select(pad(k).alias("id_occupation"), _s(F.col("o_custkey")).alias("fk_site"), kinds.alias("type"), F.when(k % 2 == 0, F.concat(F.lit("D"), _s(k))).alias("datation"))
    mob = t(spark, sf, "lineitem").select(pad(F.col("l_orderkey")).alias("fk_occupation"), F.col("l_returnflag").alias("type_mobilier"), _s(F.col("l_linenumber")).alias("NR_mobilier"))
    sites = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), _s(F.col("c_custkey")).alias("id_site"))
    r = typed.workbook_rows(sites, occ, mob, keep=["id"])
    return r.select("id", F.col("type_mention").alias("kind"), F.coalesce("periode_mention", F.lit("")).alias("period"), F.coalesce(F.size(F.from_json(_at("occupations"), "array<struct<type:string>>")), F.lit(0)).cast("long").alias("n"))


@query("""WITH d AS (SELECT c_custkey AS k, 'src/' || c_nationkey AS path, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 4 END AS page, 'texte ' || c_custkey AS raw, CASE c_custkey % 5 WHEN 0 THEN 'kolmar' WHEN 1 THEN ' Basel ' WHEN 2 THEN '' WHEN 3 THEN 'Thann' END AS commune, CASE WHEN c_custkey % 2 = 0 THEN CAST(1000000 + c_custkey AS VARCHAR) END AS x, CASE c_custkey % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'centroïde' ELSE 'approx' END AS p, list_extract(['gallica_ocr', 'pdf', 'csv'], CAST(c_custkey % 3 + 1 AS BIGINT)) AS m FROM customer)
SELECT 'SITE-' || substr(md5(path || '|' || coalesce(CAST(page AS VARCHAR), 'None') || '|' || raw), 1, 16) AS site_id, coalesce(nullif(commune, ''), 'Inconnu') AS nom_site, CASE k % 5 WHEN 0 THEN 'Colmar' WHEN 1 THEN 'Basel' WHEN 3 THEN 'Thann' ELSE '' END AS commune, CASE WHEN k % 5 = 0 THEN 'kolmar' ELSE '' END AS variants, CASE k % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'CH' ELSE 'FR' END AS pays, CAST(x AS DOUBLE) AS x_l93,
CASE WHEN p = 'exact' OR (x IS NOT NULL AND p <> 'centroïde') THEN 'exact' WHEN p = 'approx' THEN 'approx' ELSE 'centroïde' END AS precision, CASE WHEN k % 2 = 0 THEN 'tumulus' ELSE 'indéterminé' END AS kind, CASE WHEN k % 7 = 0 THEN 'La Tène' ELSE 'indéterminé' END AS period, CASE WHEN k % 6 = 0 THEN 'arkeogis_id=' || k ELSE '' END AS ids, CASE m WHEN 'gallica_ocr' THEN 'gallica_cag' WHEN 'pdf' THEN 'publication' ELSE 'tableur' END AS source FROM d""")
def normalised_sites(spark, sf):
    """Raw records to sites: keys, names, country, position, precision, type, period, external ids, provenance."""
    k = F.col("c_custkey")
    extra = F.map_filter(
        F.create_map(*[x for key, c in {
            "x_l93": F.when(k % 2 == 0, _s(1_000_000 + k)), "y_l93": F.when(k % 2 == 0, "6800000"), "precision_localisation": F.when(k % 3 == 0, "exact").when(k % 3 == 1, "centroïde").otherwise("approx"),
            "pays": F.when(k % 4 == 0, "de").when(k % 4 == 1, "CH").when(k % 4 == 2, "xx"), "SITE_AKG_ID": F.when(k % 6 == 0, _s(k)),
        }.items() for x in (F.lit(key), c)]), lambda _, v: v.isNotNull(),
    )
    raw = t(spark, sf, "customer").select(
        F.concat(F.lit("src/"), _s(F.col("c_nationkey"))).alias("source_path"), F.when(k % 9 != 0, (k % 4).cast("int")).alias("page_number"), F.concat(F.lit("texte "), _s(k)).alias("raw_text"),
        F.when(k % 5 == 0, "kolmar").when(k % 5 == 1, " Basel ").when(k % 5 == 2, "").when(k % 5 == 3, "Thann").alias("commune"), F.when(k % 2 == 0, "Tertre").alias("type_mention"), F.when(k % 7 == 0, "site laténien").otherwise("").alias("periode_mention"),
        F.lit(None).cast("double").alias("latitude_raw"), F.lit(None).cast("double").alias("longitude_raw"), F.element_at(F.array(F.lit("gallica_ocr"), F.lit("pdf"), F.lit("csv")), (k % 3 + 1).cast("int")).alias("extraction_method"), extra.alias("extra"),
    )
    s = R.normalise(raw)
    ids = F.array_join(F.transform(F.map_entries("identifiants_externes"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return s.select(
        "site_id", "nom_site", "commune", F.array_join("variantes_nom", ",").alias("variants"), "pays", "x_l93", F.col("precision_localisation").alias("precision"), F.col("type_site").alias("kind"),
        F.get("phases", F.lit(0))["periode"].alias("period"), ids.alias("ids"), F.get("sources", F.lit(0))["type_source"].alias("source"),
    )


@query("""WITH d AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'texte' ELSE NULL END AS raw, CASE WHEN c_custkey % 3 = 0 THEN 'Colmar' END AS commune FROM customer) SELECT id, trim(coalesce(raw, '')) <> '' OR coalesce(commune, '') <> '' AS kept FROM d""")
def extract_gate(spark, sf):
    """Records without text and commune are set apart with a reason."""
    k = F.col("c_custkey")
    d = t(spark, sf, "customer").select(k.alias("id"), F.when(k % 4 == 0, " ").when(k % 4 == 1, "texte").alias("raw"), F.when(k % 3 == 0, "Colmar").alias("commune"))
    blank = F.array(F.when((F.trim(F.coalesce("raw", F.lit(""))) == "") & (F.coalesce("commune", F.lit("")) == ""), "empty"))
    kept, apart = R.split_rejects(d, blank)
    return kept.select("id", F.lit(True).alias("kept")).union(apart.where(F.col("rejects")[0] == "empty").select("id", F.lit(False)))


@query("""WITH d AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'Colmar' ELSE 'Bad Krozingen rue ' || c_custkey END AS site FROM customer) SELECT id, CASE WHEN site = 'Colmar' THEN site ELSE 'Bad Krozingen' END AS commune, CASE WHEN site = 'Colmar' THEN '' ELSE 'rue ' || id END AS place, CASE WHEN id % 4 = 0 THEN 'Ha D' WHEN id % 4 = 1 THEN 'Ha C / Ha D' ELSE '' END AS period, CASE WHEN id % 5 = 0 THEN 'oui' ELSE '' END AS rite FROM d""")
def funerary_records(spark, sf):
    """Rows under a flattened two-row header: site text split, datings joined, starred cells left out."""
    k = F.col("c_custkey")
    d = t(spark, sf, "customer").select(
        k.alias("id"), F.lit("67").alias("info SITE.DPT"), F.when(k % 3 == 0, "Colmar").otherwise(F.concat(F.lit("Bad Krozingen rue "), _s(k))).alias("info SITE.SITE"), F.when(k % 4 == 1, "Ha C").otherwise("*").alias("a.DATATION"),
        F.when(k % 4 < 2, "Ha D").alias("b.datation relative"), F.when(k % 5 == 0, "oui").otherwise(" * ").alias("rite"),
    )
    r = typed.funerary_rows(d, keep=["id"])
    return r.select("id", "commune", _at("lieu_dit").alias("place"), F.coalesce("periode_mention", F.lit("")).alias("period"), _at("rite").alias("rite"))


@query("""WITH d AS (SELECT s_suppkey AS id, n_name, n_nationkey AS n, CASE s_suppkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'DE' ELSE 'CH' END AS pays, CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS DOUBLE) END AS x FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT id, CAST(coalesce(x, CASE WHEN pays = 'FR' AND n % 2 = 0 THEN 100 + n WHEN pays = 'DE' AND n % 3 = 0 THEN 200 + n WHEN n % 5 = 0 THEN 300 + n END) AS DOUBLE) AS x, CASE WHEN x IS NOT NULL THEN 'exact' WHEN (pays = 'FR' AND n % 2 = 0) OR (pays = 'DE' AND n % 3 = 0) OR n % 5 = 0 THEN 'centroïde' ELSE 'approx' END AS precision FROM d""")
def geocoded_sites(spark, sf):
    """Sites without a position by lookup tables of their country, then by one for all."""
    from ..pipeline import geocode

    k, n = F.col("s_suppkey"), t(spark, sf, "nation")
    at = F.when(k % 4 == 0, k.cast("double"))
    s = t(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(k.alias("id"), F.col("n_name").alias("commune"), F.when(k % 3 == 0, "FR").when(k % 3 == 1, "DE").otherwise("CH").alias("pays"), at.alias("x_l93"), at.alias("y_l93"), F.when(k % 4 == 0, "exact").otherwise("approx").alias("precision_localisation"))
    table = lambda by, base: n.where(F.col("n_nationkey") % by == 0).select(F.lower("n_name").alias("commune"), (F.lit(base) + F.col("n_nationkey")).cast("double").alias("x"), F.lit(1.0).alias("y"))
    found = geocode(s, [("FR", table(2, 100)), ("DE", table(3, 200)), (None, table(5, 300))])
    return found.select("id", F.col("x_l93").alias("x"), F.col("precision_localisation").alias("precision"))


@query("""WITH d AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'Hallstatt' WHEN 1 THEN 'Age du Bronze' WHEN 2 THEN 'romain' ELSE NULL END AS p, CASE WHEN o_orderkey % 3 = 0 THEN 'necropoles' ELSE 'csv' END AS m, o_orderkey % 5 = 0 AS flag, CASE WHEN o_orderkey % 7 = 0 THEN -900 + o_orderkey % 300 END AS a, CASE WHEN o_orderkey % 7 = 0 THEN -850 + o_orderkey % 300 END AS b, CASE o_orderkey % 11 WHEN 0 THEN '57' WHEN 1 THEN '67' WHEN 2 THEN 'BW' END AS dep, CASE WHEN o_orderkey % 13 = 0 THEN 'LU' END AS pays FROM orders)
SELECT id FROM d WHERE CASE WHEN p = 'Hallstatt' THEN true WHEN flag THEN true WHEN a IS NOT NULL THEN b > -800 AND a <= -25 WHEN p = 'Age du Bronze' THEN false ELSE m = 'necropoles' END AND coalesce(dep <> '57', true) AND pays IS NULL""")
def retained_records(spark, sf):
    """Chronological and geographic filters on raw records, from their text map."""
    from ..pipeline import Config, retained

    k = F.col("o_orderkey")
    cells = {
        "phases_bool": F.when(k % 5 == 0, "HaD"), "datation_debut": F.when(k % 7 == 0, (F.lit(-900) + k % 300).cast("string")), "datation_fin": F.when(k % 7 == 0, (F.lit(-850) + k % 300).cast("string")),
        "departement": F.when(k % 11 == 0, "57").when(k % 11 == 1, "67").when(k % 11 == 2, "BW"), "pays": F.when(k % 13 == 0, "LU"),
    }
    extra = F.map_filter(F.create_map(*[x for c, v in cells.items() for x in (F.lit(c), v)]), lambda _, v: v.isNotNull())
    raw = t(spark, sf, "orders").select(k.alias("id"), F.when(k % 4 == 0, "Hallstatt").when(k % 4 == 1, "Age du Bronze").when(k % 4 == 2, "romain").alias("periode_mention"), F.when(k % 3 == 0, "necropoles").otherwise("csv").alias("extraction_method"), extra.alias("extra"))
    return retained(raw, Config([], "")).select("id")
