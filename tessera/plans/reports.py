"""Queries over the reports and the grammars of notices and indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import grammar
from ..operators import aggregate as A
from ..operators import reports as P
from ..operators.shared import checkpointed
from .common import t
from .domain import _pick, _sql_pick
from .relational import query

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in TABLES))
def table_sizes(spark, sf):
    return P.table_sizes({n: t(spark, sf, n) for n in TABLES})


@query("SELECT DISTINCT p_type AS option FROM part")
def option_list(spark, sf):
    """Distinct values in order, for a drop-down."""
    return P.options(t(spark, sf, "part").withColumnRenamed("p_type", "option"), "option")


@query("SELECT term, n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS term FROM part) JOIN (SELECT unnest(string_split(lower(p_name), ' ')) AS t2, count(*) AS n FROM part GROUP BY 1) ON term = t2 GROUP BY 1, 2 ORDER BY n DESC, term LIMIT 20")
def top_terms(spark, sf):
    """The 20 most frequent words (a top-k report), ties by word."""
    return P.top(t(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("term")), "term")


@query("SELECT c_custkey AS id, c_name AS name FROM customer ORDER BY c_name, c_custkey LIMIT 12 OFFSET 24")
def table_page(spark, sf):
    """The third page of twelve rows (a paging operator)."""
    return P.page(t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), [F.col("name"), F.col("id")], 2)


@query("SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sample_rows(spark, sf):
    """The first twenty rows in a stated order (a sample sink)."""
    return P.samples(t(spark, sf, "orders"), [F.desc("o_totalprice"), F.col("o_orderkey")]).select(F.col("o_orderkey").alias("id"))


@query("SELECT c_custkey AS id, CAST(row_number() OVER (ORDER BY c_name NULLS LAST, c_custkey) AS INT) AS place FROM customer")
def ordered_by_name(spark, sf):
    """Names in order, with their places: ranges are sorted apart, written once and numbered by the rows before each."""
    named = checkpointed(t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name").orderBy(F.asc_nulls_last("c_name"), "id").withColumn("p", F.spark_partition_id()))
    sizes = named.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.alias("a").join(F.broadcast(sizes.alias("b")), F.col("b.p") < F.col("a.p"), "left").groupBy("a.p").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    from pyspark.sql.window import Window

    own = F.row_number().over(Window.partitionBy("p").orderBy(F.asc_nulls_last("c_name"), "id"))
    return named.withColumn("own", own).join(F.broadcast(before), "p").select("id", (F.col("own") + F.col("before")).cast("int").alias("place"))


_CUT = "list_sort(list(DISTINCT CAST({c} AS VARCHAR)))[1:3]"


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{k}' AS dtype, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, round(100.0 * (count(*) - count({c})) / count(*), 1)::DOUBLE AS null_pct, array_to_string({_CUT.format(c=c)}, '; ') AS sample_values FROM nation" for c, k in (("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int"))) + ")")
def column_report(spark, sf):
    """Profile with types and sample values."""
    return P.column_report(t(spark, sf, "nation")).select("column_name", "dtype", "n_null", "n_distinct", "null_pct", "sample_values")


@query("""WITH f AS (SELECT 'a' AS column_name, count(CASE WHEN c_custkey % 2 = 0 THEN 1 END) / count(*)::DOUBLE AS r FROM customer UNION ALL SELECT 'b', count(CASE WHEN c_custkey % 3 = 0 THEN 1 END) / count(*)::DOUBLE FROM customer UNION ALL SELECT 'c', 1.0 UNION ALL SELECT 'd', count(CASE WHEN c_custkey % 7 = 0 THEN 1 END) / count(*)::DOUBLE FROM customer UNION ALL SELECT 'e', 1.0 UNION ALL SELECT 'f', 0.0) SELECT column_name, round(r, 6) AS fill_rate FROM f ORDER BY r, column_name LIMIT 5""".replace("/ count(*)::DOUBLE", "/ CAST(count(*) AS DOUBLE)"))
def lowest_filled(spark, sf):
    """The five least filled columns."""
    k = F.col("c_custkey")
    part = lambda n: F.when(k % n == 0, k)
    df = t(spark, sf, "customer").select(part(2).alias("a"), part(3).alias("b"), k.alias("c"), part(7).alias("d"), k.alias("e"), F.lit(None).cast("int").alias("f"))
    return P.lowest_filled(A.profile(df))


@query("""SELECT count(*) AS n_rows, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT c_name AS v FROM customer ORDER BY 1 LIMIT 3)) AS names, (SELECT string_agg(c_mktsegment || '=' || n, ',' ORDER BY c_mktsegment) FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)) AS segments FROM customer""")
def quality_report(spark, sf):
    """One JSON report: rows, samples, distributions; read back here."""
    r = P.quality_report(t(spark, sf, "customer"), ["c_name"], ["c_mktsegment"])
    p = r.select(F.from_json("report", "rows long, sample_c_name array<string>, by_c_mktsegment map<string,long>").alias("p"))
    pairs = F.transform(F.array_sort(F.map_entries("p.by_c_mktsegment")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return p.select(F.col("p.rows").alias("n_rows"), F.array_join("p.sample_c_name", ",").alias("names"), F.array_join(pairs, ",").alias("segments"))


@query("SELECT count(DISTINCT o_custkey) AS n_authors, min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year, count(*) AS n FROM orders")
def bibliography_facts(spark, sf):
    return P.bibliography(t(spark, sf, "orders").withColumn("y", F.year("o_orderdate")), "o_custkey", "y")[0]


@query("""WITH d AS (SELECT o_orderkey AS id, o_orderkey % 2 = 0 AS p, o_orderkey % 3 = 0 AS s, o_orderkey % 5 = 0 AS c FROM orders), r AS (SELECT id, p OR s OR c AS pertinent, CASE WHEN NOT p AND NOT s AND c THEN 'commune_notice_uniquement' WHEN p AND s THEN 'periode_et_type' WHEN p THEN 'periode_ou_cross' WHEN s THEN 'type_site_fort' ELSE 'autre' END AS reason FROM d) SELECT reason, count(*) AS n, count(*) FILTER (pertinent) AS n_relevant FROM r GROUP BY 1""")
def relevance_reasons(spark, sf):
    """Index entries by the reason of their relevance."""
    k = F.col("o_orderkey")
    none = F.expr("cast(array() as array<string>)")
    periods, types = F.when(k % 2 == 0, F.array(F.lit("Ha C"))).otherwise(none), F.when(k % 3 == 0, F.array(F.lit("voie"), F.lit("tumulus"))).otherwise(F.array(F.lit("habitat")))
    rows = t(spark, sf, "orders").select(P.relevance_reason(periods, types, k % 5 == 0).alias("reason"), P.relevant(periods, types, k % 5 == 0).alias("ok"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_relevant"))


@query("""SELECT CAST(count(*) FILTER (s_suppkey % 4 = 0) AS BIGINT) AS doubled_quotes, count(*) FILTER (s_suppkey % 5 = 0 OR s_suppkey % 7 = 0) AS zero_coordinates, CAST(1 AS BIGINT) AS unnamed_columns, CAST(1 AS BIGINT) AS empty_columns FROM supplier""")
def quality_probes(spark, sf):
    k = F.col("s_suppkey")
    df = t(spark, sf, "supplier").select(F.when(k % 4 == 0, 'a""b').otherwise("ab").alias("note"), F.when(k % 5 == 0, "0").otherwise("48.1").alias("Latitude"), F.when(k % 7 == 0, "0.0").otherwise("7.5").alias("LONGITUDE"), F.lit(None).cast("string").alias("Unnamed: 4"))
    return P.quality_probes(df)


FILES = ("/d/20250806_ADAB2011_ArkeoGis.csv", "/d/20250806_Patriarche_ageFer.xlsx", "/d/BDD-fun_AFEAF24.xlsx", "cag_68_index.doc", "/x/ea_fr.dbf", "/x/other.csv")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(FILES)} AS f, CASE WHEN doc_id % 6 = 0 THEN 'ADAB' END AS db FROM documents), n AS (SELECT *, split_part(f, '/', -1) AS b FROM d)
SELECT doc_id, CASE WHEN regexp_matches(b, '^[0-9]{{8}}') THEN substr(b, 1, 4) || '-' || substr(b, 5, 2) || '-' || substr(b, 7, 2) END AS export_date, CASE WHEN db IS NOT NULL THEN 'ArkeoGIS' WHEN contains(b, 'Patriarche') THEN 'Patriarche (base nationale EA)' WHEN contains(b, 'AFEAF') THEN 'AFEAF (Association Française pour l''Étude de l''Âge du Fer)' WHEN contains(b, 'cag_68') THEN 'Carte Archéologique de la Gaule — Haut-Rhin (68)' WHEN contains(b, 'ea_fr') THEN 'Entités Archéologiques (base nationale France)' ELSE 'Inconnu' END AS platform FROM n""")
def source_context(spark, sf):
    """Export date and platform from a file's name."""
    c = P.source_context(_pick(FILES), F.when(F.col("doc_id") % 6 == 0, "ADAB"))
    return t(spark, sf, "documents").select("doc_id", c.alias("c")).select("doc_id", "c.export_date", "c.platform")


@query(f"""WITH p AS (SELECT o_custkey AS id, o_orderstatus AS period, year(o_orderdate) AS y, CAST(o_orderkey AS VARCHAR) AS ref, o_orderkey AS k FROM orders)
SELECT 'C' || id AS site_id, string_agg(DISTINCT period, ', ' ORDER BY period) AS periodes, min(y)::INT AS datation_debut, max(y)::INT AS datation_fin, string_agg(ref, '; ' ORDER BY k) AS refs, '{vocab.UNKNOWN}' AS other FROM p GROUP BY id""")
def flat_sites(spark, sf):
    """Sites for a table view."""
    y = F.year("o_orderdate")
    phase = F.struct(F.col("o_orderstatus").alias("periode"), F.lit(None).cast("string").alias("sous_periode"), y.alias("datation_debut"), y.alias("datation_fin"))
    sites = t(spark, sf, "orders").groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("site_id")).agg(F.collect_list(phase).alias("phases"), F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.struct(k.cast("string").alias("reference"))).alias("sources"))
    bare = P.flat_sites(sites.withColumn("phases", F.slice("phases", 1, 0)).select("site_id", "phases", "sources")).select("site_id", F.col("periodes").alias("other"))
    return P.flat_sites(sites).drop("sous_periodes").withColumnRenamed("references", "refs").join(bare, "site_id")


@query("SELECT s_suppkey AS id, CAST(s_suppkey % 3 AS VARCHAR) || '; x' AS names, '{\"k\":\"' || s_suppkey || '\"}' AS facts FROM supplier")
def display_cells(spark, sf):
    """Arrays and maps as cells of text."""
    k = F.col("s_suppkey")
    df = t(spark, sf, "supplier").select(k.alias("id"), F.array((k % 3).cast("string"), F.lit("x")).alias("names"), F.create_map(F.lit("k"), k.cast("string")).alias("facts"))
    return P.display(df)


NOTICES = (
    "avant\n001 - ALTKIRCH\nUn tumulus.\n(004 AH) fouille du Hallstatt D, Dupont, 1998\n002 — Colmar\n(123 AP) (124 AE) mur\n(123 AP) encore",
    "rien du tout",
    "067 - BENFELD\nvilla gallo-romaine (001 AF)\n068 - Thann \n  habitat\n",
)


def _notice_docs(spark, sf):
    return t(spark, sf, "documents").select("doc_id", _pick(NOTICES).alias("body"))


_LINES = f"l AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS n FROM (SELECT doc_id, {_sql_pick(NOTICES)} AS body FROM documents)), i AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[0-9]{{3}}\\s*[-–—]\\s*.') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM l)"


@query(f"""WITH {_LINES}, s AS (SELECT doc_id, g, arg_min(line, n) AS head, trim(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT regexp_matches(line, '^[0-9]{{3}}\\s*[-–—]\\s*.')), ''), chr(10) || ' ') AS body FROM i WHERE g > 0 GROUP BY 1, 2)
SELECT doc_id, substr(head, 1, 3) AS number, trim(regexp_replace(head, '^[0-9]{{3}}\\s*[-–—]\\s*', '')) AS commune, body, coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(body, '\\([0-9]{{3}}\\s+(AH|AP|AE|AF)\\)'), lambda x: replace(replace(x, '(', ''), ')', '')))), ','), '') AS refs FROM s""")
def commune_notices(spark, sf):
    """Notices of communes with the references in them."""
    n = grammar.notices(_notice_docs(spark, sf), "doc_id", "body")
    return n.withColumn("refs", F.array_join(F.array_sort(grammar.site_references(F.col("body"))), ","))


@query(f"""WITH {_LINES}, s AS (SELECT doc_id, g, arg_min(line, n) AS head, list(trim(line) ORDER BY n) FILTER (n > 0) AS ls FROM i WHERE g > 0 GROUP BY 1, 2), p AS (SELECT doc_id, substr(head, 1, 3) AS number, unnest(list_slice(ls, 2, len(ls))) AS x FROM s),
e AS (SELECT doc_id, number, x, regexp_extract(x, '^\\(([0-9]{{3}}\\s*[A-Z]{{2}})\\)', 1) AS code FROM p WHERE x <> '') SELECT doc_id, number, code, count(*) AS n_lines FROM e GROUP BY 1, 2, 3""")
def coded_parts(spark, sf):
    """Parts of a notice by their codes, with their lines (a code that returns is counted once more)."""
    parts = grammar.sub_notices(grammar.notices(_notice_docs(spark, sf), "doc_id", "body"))
    lines = F.size(F.filter(F.split("part", "\n"), lambda x: F.trim(x) != ""))
    return parts.groupBy("doc_id", "number", "code").agg(F.sum(lines).alias("n_lines"))


INDEXES = ("Index alphabétique\n- A -\nAmphore : 001 (2), 066\n 067, 001\ncf. aussi vase, urne\nBague : 123\n", "rien", "Épée (à antennes) : 005\n68 Haut-Rhin\nFibule : 009, 010 cf. surtout agrafe\n")


@query(f"""WITH l AS (SELECT doc_id, trim(unnest(string_split(body, chr(10)))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS n FROM (SELECT doc_id, {_sql_pick(INDEXES)} AS body FROM documents)), k AS (SELECT * FROM l WHERE line <> '' AND NOT regexp_matches(line, '^- [A-Z] -$|^Index|^68 Haut')),
i AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[^0-9:]+ : [0-9]{{3}}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM k), s AS (SELECT doc_id, g, string_agg(line, ' ' ORDER BY n) AS e FROM i WHERE g > 0 GROUP BY 1, 2)
SELECT doc_id, split_part(e, ' : ', 1) AS term, array_to_string(list_sort(list_distinct(regexp_extract_all(substr(e, strpos(e, ' : ')), '[0-9]{{3}}'))), ',') AS refs, CASE WHEN contains(e, 'cf. aussi') THEN trim(split_part(e, 'cf. aussi ', 2)) WHEN contains(e, 'cf. surtout') THEN trim(split_part(e, 'cf. surtout ', 2)) ELSE '' END AS crossed FROM s""")
def index_entries(spark, sf):
    """Terms of an index with their references and cross-references."""
    e = grammar.index_entries(t(spark, sf, "documents").select("doc_id", _pick(INDEXES).alias("body")), "doc_id", "body")
    return e.select("doc_id", "term", F.array_join("refs", ",").alias("refs"), F.array_join("cross", ";").alias("crossed"))


BLOCKS = ("Un mur; long texte sur le site et ses abords.\n\nDupont 1998, p. 12", "Court; p. 3", "Sans rien de cela", "Un paragraphe bien long pour le début; suite.\n\nfin sans rien")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(BLOCKS)} AS b FROM documents) SELECT doc_id, CASE WHEN contains(b, chr(10) || chr(10)) AND regexp_matches(split_part(b, chr(10) || chr(10), 2), '[0-9]{{4}}') THEN split_part(b, chr(10) || chr(10), 1) ELSE b END AS body, CASE WHEN regexp_matches(split_part(b, chr(10) || chr(10), 2), '[0-9]{{4}}') THEN split_part(b, chr(10) || chr(10), 2) ELSE '' END AS bibliography,
coalesce(array_to_string(list_transform(regexp_extract_all(b, '[A-Z][a-z]+, [0-9]{{4}}'), lambda x: replace(x, ', ', ':')), ','), '') AS cited FROM d""")
def notice_bibliography(spark, sf):
    """A notice's last paragraph where it cites years or pages, and the citations 'Author, year'."""
    b = grammar.split_bibliography(_pick(BLOCKS))
    cited = F.array_join(F.transform(grammar.citation_facts(_pick(BLOCKS)), lambda x: F.concat(x["author"], F.lit(":"), x["year"].cast("string"))), ",")
    return t(spark, sf, "documents").select("doc_id", b.alias("s"), cited.alias("cited")).select("doc_id", F.col("s.text").alias("body"), "s.bibliography", "cited")


MENTIONED = ("À Colmar, un habitat gaulois. Colmar: HABITAT.", "nécropole de Strasbourg-Koenigshoffen", "fouilles anciennes à Benfeld", "rien")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(MENTIONED)} AS b FROM documents) SELECT doc_id, 'Strasbourg' AS commune FROM d WHERE contains(b, 'Strasbourg') UNION ALL SELECT doc_id, 'Benfeld' FROM d WHERE contains(b, 'Benfeld') UNION ALL SELECT doc_id, 'Colmar' FROM d WHERE contains(b, 'Colmar')""")
def running_mentions(spark, sf):
    """Communes that a running text names with a kind of site or a find."""
    m = grammar.site_mentions(t(spark, sf, "documents").select("doc_id", _pick(MENTIONED).alias("b")), "doc_id", "b")
    named = F.regexp_extract("commune", "(Strasbourg|Benfeld|Colmar)", 1)
    return m.select("doc_id", named.alias("commune")).where("commune <> ''").distinct()
