"""Queries over the sources' rules: cells dealt over the documents by id, judged again in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import chrono, rules, similarity, text
from ..operators import rows as R
from .common import t
from .domain import _pick, _sql_pick
from .relational import query

CELLS = ("oui", " Non ", "O", "plutôt probable", "Indéterminé", "indetermine ?", "*", "", "tumulus", "NAN", "localisation inconnue", "Colmar (centre) nord", " x (a) ")
COUNTRIES = ("F", "fr", " D ", "CH", "s", "lux", "")
CHARACTERS = ("Enceinte", "funéraire", "Céramique", "route/voie", "dépôt", "autre", "")
RICH = ("Tombe princière ?", "habitat de hauteur", "site fortifié", "OPPIDUM", "?", "tombe à char")
COMMENTS = ("GENAUIGK_T : mit 20 m Toleranz #", "GENAUIGK_T : Ungenauigkeit 300 m #", "sans", "", "GENAUIGK_T : ca. 10m # DAT_FEIN : Ha D #")
TERMS = ("Fibule à ressort", "tombe à fibule", "mur de pierre", "bronze final", "fer", "voie romaine", "pont", "Hallstatt", "autre chose", "amphore", "sol")
NAMED = ("un oppidum et une nécropole", "Tumulus, habitat ouvert", "rien", "Viereckschanze bei der Siedlung", "tombe à char dans un tertre", "atelier de potier; voie", "des fosses")
OPERATIONS = ("fouille programmée", "fouille après diagnostic", "diagnostic", "Découverte fortuite", "decouverte", "archives", "")
DATINGS = ("Bronze ancien", "Ha D", "bronze final IIIb", "LT B-C", "Bronze moyen", "Bze C-D", "gallo-romain", "âge du Fer", "charnière", "", "ha d3 / lt a")
RECORDS = (("Funéraire", "tumulus arasé", ""), ("habitat", "enceinte double", ""), ("Habitat / funéraire", "inhumation", ""), ("mobilier", "hache", "trouvaille isolée"), ("mobilier", "hache", ""), ("autre", "temple", ""), ("-", "", ""), ("dépôt", "", ""), ("habitat", "fosse", ""))
REFS = ("(001, 002 AH)", "(001 AH, 003 AP)", "(123 AE)", "((004  ,  005,006  af))", "sans", "(12 AH)")
PLACES = ("Colmar rue des Aunes", "Colmar", "Sainte-Croix en plaine 3", "Bad Krozingen am Bach", "x")
SPELLINGS = ("LTB", "Ha D 3", "lta / ltb", "HA C", "LT  D1", "Ha\u00a0D1", "ha  d2-d 3")
PAIRS = ("-800:-450", "-25 : -450", "x", "", "-620:-540", "-150:200", "-500:-400", "-2000:-100")
TEXTS = ("tumulus du Hallstatt C fouillé", "tombe La Tène Ib", "charnière Ha D3/LT A", "Ha D2 et LT A", "site protohistorique", "Bronze final", "villa gallo-romaine", "époque mérovingienne", "sans date", "nécropole, second âge du Fer", "Hallstatt D", "le moyen âge")
CODES = ("EURFER------", "EURBRO", "eurgal--", "EURNEO", "", "EUR")
SCOPES = ("Colmar, Mulhouse et environs", "Carte de la Gaule (Strasbourg)", "Haut-Rhin; Bas / Ensisheim", "12 rue, Le", "", "Basel-Gasfabrik/Musée")


def _q(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _docs(spark, sf):
    return t(spark, sf, "documents").select("doc_id")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(CELLS)} AS c FROM documents), e AS (SELECT *, lower(trim(c)) AS l, trim(regexp_replace(c, '\\s*\\([^)]*\\)\\s*', ' ', 'g')) AS r FROM d)
SELECT doc_id, CASE WHEN l IN ('', '*') THEN NULL WHEN l IN ('oui', 'o', 'yes') THEN 'oui' WHEN l IN ('non', 'n', 'no') THEN 'non' WHEN contains(l, 'probable') THEN 'probable' WHEN contains(l, 'indétermin') OR contains(l, 'indetermin') THEN 'indéterminé' ELSE l END AS enum,
CASE WHEN l NOT IN ('', '*', 'nan', 'none', 'localisation inconnue') THEN trim(c) END AS cell, CASE WHEN lower(r) NOT IN ('', '*', 'nan', 'none', 'localisation inconnue') THEN r END AS bare FROM e""")
def cell_values(spark, sf):
    c = _pick(CELLS)
    return _docs(spark, sf).select("doc_id", rules.enum_cell(c).alias("enum"), rules.cell(c).alias("cell"), rules.cell(c, remarks=True).alias("bare"))


_COUNTRY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.COUNTRY_CODES.items())
_CHARACTER = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.CHARACTER_TYPES.items())
_RICH = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.RICH_TYPES.items())


@query(f"""SELECT doc_id, CASE lower(trim({_sql_pick(COUNTRIES)})) {_COUNTRY} ELSE upper(trim({_sql_pick(COUNTRIES)})) END AS country, CASE lower({_sql_pick(CHARACTERS)}) {_CHARACTER} ELSE '{vocab.UNKNOWN}' END AS character, CASE lower({_sql_pick(RICH)}) {_RICH} ELSE '{vocab.UNKNOWN}' END AS rich FROM documents""")
def value_maps(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.country(_pick(COUNTRIES)).alias("country"), rules.character_type(_pick(CHARACTERS)).alias("character"), rules.rich_type(_pick(RICH)).alias("rich"))


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN ' Oui' ELSE 'Non' END AS f, {_sql_pick(COMMENTS)} AS c FROM documents)
SELECT doc_id, CASE WHEN lower(trim(f)) = 'oui' THEN 'centroïde' WHEN contains(c, 'GENAUIGK_T') AND regexp_matches(c, 'mit 20 m Toleranz|ca\\. 10m') THEN 'exact' ELSE 'approx' END AS precision FROM d""")
def comment_precision(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.precision(F.when(F.col("doc_id") % 4 == 0, " Oui").otherwise("Non"), _pick(COMMENTS)).alias("precision"))


@query(f"""SELECT doc_id, coalesce(trim(nullif(regexp_extract({_sql_pick(COMMENTS)}, 'GENAUIGK_T\\s*:\\s*([^#]+?)(\\s*#|$)', 1), '')), '') AS accuracy, coalesce(nullif(regexp_extract({_sql_pick(COMMENTS)}, 'DAT_FEIN\\s*:\\s*([^#]+?)(\\s*#|$)', 1), ''), '') AS dating FROM documents""")
def comment_tags(spark, sf):
    """Tagged comments as a map."""
    m = text.tags(_pick(COMMENTS))
    return _docs(spark, sf).select("doc_id", F.coalesce(F.try_element_at(m, F.lit("GENAUIGK_T")), F.lit("")).alias("accuracy"), F.coalesce(F.try_element_at(m, F.lit("DAT_FEIN")), F.lit("")).alias("dating"))


_CATEGORY = " ".join(f"WHEN list_has_any([x for x in {_q(ws)} if contains(c, x)], {_q(ws)}) THEN '{n}'" for n, ws in vocab.TERM_CATEGORIES)


@query(f"WITH d AS (SELECT doc_id, lower({_sql_pick(TERMS)}) AS c FROM documents) SELECT doc_id, CASE {_CATEGORY} ELSE 'autre' END AS category FROM d")
def category_priority(spark, sf):
    """Category of an index term, funerary keywords first."""
    return _docs(spark, sf).select("doc_id", rules.term_category(_pick(TERMS)).alias("category"))


_ALIAS_ROWS = ", ".join(f"('{a.lower().replace(chr(39), chr(39) * 2)}', '{k}', {i})" for i, (a, k) in enumerate(sorted(((a.lower(), k) for k, names in vocab.TYPE_ALIASES.items() for a in names if len(a) > 2), key=lambda x: -len(x[0]))))


@query(f"""WITH al(a, k, o) AS (VALUES {_ALIAS_ROWS}), d AS (SELECT doc_id, lower({_sql_pick(NAMED)}) AS c FROM documents),
h AS (SELECT doc_id, k, min(o) AS o FROM d, al WHERE CASE WHEN regexp_matches(a, '[ ''-]') THEN contains(c, a) ELSE list_contains(regexp_split_to_array(c, '[^0-9a-zà-ÿœ_]+'), a) END GROUP BY 1, 2)
SELECT d.doc_id, coalesce(string_agg(k, ';' ORDER BY o), '') AS types, arg_min(k, list_position({_q(vocab.TYPE_RANK)}, k)) AS strongest FROM d LEFT JOIN h ON h.doc_id = d.doc_id GROUP BY 1""")
def alias_types(spark, sf):
    """All types that a text names, longest alias first, and the most specific of them."""
    a = rules.alias_types(_pick(NAMED))
    return _docs(spark, sf).select("doc_id", F.array_join(a, ";").alias("types"), rules.strongest_type(a).alias("strongest"))


@query(f"""WITH d AS (SELECT doc_id, lower({_sql_pick(OPERATIONS)}) AS c FROM documents) SELECT doc_id, CASE WHEN contains(c, 'fouille') AND NOT contains(c, 'diagnostic') THEN 'fouille' WHEN contains(c, 'diagnostic') THEN 'prospection' WHEN regexp_matches(c, 'd[ée]couverte') THEN 'signalement' ELSE '' END AS status FROM d""")
def excavation_status(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.excavation_status(_pick(OPERATIONS)).alias("status"))


@query(f"""WITH d AS (SELECT doc_id, lower({_sql_pick(DATINGS)}) AS c, doc_id % 7 = 0 AS f FROM documents), e AS (SELECT *, regexp_matches(c, '\\bha\\s*[abcd]|\\blt\\s*[abcd]|bze\\s*d|bze\\s*c\\s*[-/]\\s*d|hallstatt|lat[eè]ne|charni[eè]re|âge\\s+du\\s+fer|age\\s+du\\s+fer') AS iron, regexp_matches(c, 'bronze\\s+(ancien|moyen)') AND NOT regexp_matches(c, 'bronze final|hallstatt|lat[eè]ne|\\bha\\s*[abcd]|\\blt\\s*[abcd]|[âa]ge du fer') AS older FROM d)
SELECT doc_id, iron AS says_iron, older AS only_older, f OR (iron AND NOT older) AS kept FROM e""")
def inclusion_policy(spark, sf):
    """Flags or wording of the iron age; early and middle bronze age alone are left out."""
    c, flag = _pick(DATINGS), F.when(F.col("doc_id") % 7 == 0, "1.0").otherwise("0")
    return _docs(spark, sf).select("doc_id", rules.says_iron(c).alias("says_iron"), rules.only_older_bronze(c).alias("only_older"), rules.iron_record([flag, F.lit("x")], c).alias("kept"))


_TYPE_OF = {"Funéraire": "tumulus", "Habitat / funéraire": "nécropole", "autre": "sanctuaire", "-": vocab.UNKNOWN}


@query(f"""WITH d AS (SELECT doc_id, lower({_sql_pick([r[0] for r in RECORDS])}) AS k, {_sql_pick([r[1] for r in RECORDS])} AS s, {_sql_pick([r[2] for r in RECORDS])} AS o FROM documents)
SELECT doc_id, CASE WHEN contains(k, 'habitat') AND contains(k, 'funéraire') THEN CASE WHEN contains(s, 'inhumation') THEN 'nécropole' ELSE 'habitat' END WHEN contains(k, 'funéraire') THEN CASE WHEN contains(s, 'tumulus') THEN 'tumulus' ELSE 'nécropole' END
WHEN k = 'habitat' THEN CASE WHEN contains(s, 'enceinte') THEN 'oppidum' ELSE 'habitat' END WHEN k = 'mobilier' THEN CASE WHEN contains(o, 'isolée') OR contains(s, 'dépôt') THEN 'dépôt' ELSE 'habitat' END WHEN k = 'dépôt' THEN 'dépôt' WHEN k = 'autre' AND contains(s, 'temple') THEN 'sanctuaire' ELSE '{vocab.UNKNOWN}' END AS kind FROM d""")
def record_type(spark, sf):
    """Type by the record's kind, refined by its structures and operation."""
    kind, structures, operation = (_pick([r[i] for r in RECORDS]) for i in range(3))
    return _docs(spark, sf).select("doc_id", rules.record_type(kind, structures, operation).alias("kind"))


@query(f"""WITH d AS (SELECT doc_id, upper(regexp_replace({_sql_pick(REFS)}, '[()]', '', 'g')) AS c FROM documents), e AS (SELECT doc_id, c, regexp_extract(c, '(AH|AP|AE|AF)\\s*$', 1) AS code, regexp_matches(trim(c), '^[0-9]{{3}}(\\s*,\\s*[0-9]{{3}})+\\s+(AH|AP|AE|AF)$') AS shared FROM d)
SELECT doc_id, CASE WHEN shared THEN array_to_string(list_transform(regexp_extract_all(c, '[0-9]{{3}}'), lambda n: n || ' ' || code), '; ') ELSE array_to_string(list_transform(regexp_extract_all(c, '[0-9]{{3}}\\s+(AH|AP|AE|AF)'), lambda n: regexp_replace(n, '\\s+', ' ')), '; ') END AS refs FROM e""")
def reference_codes(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.references(_pick(REFS)).alias("refs"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'HIGH' WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS facts, CASE WHEN o_custkey % 25 = 0 THEN 'MEDIUM' WHEN o_orderkey % 6 = 0 THEN 'HIGH' WHEN o_orderkey % 6 <= greatest(1, (o_custkey % 25) // 10) THEN 'MEDIUM' ELSE 'LOW' END AS resolved,
CASE WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_custkey * 1000 BETWEEN 0 AND 1300000 THEN 'ok' ELSE 'suspect' END AS place, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN trim(' L ') END, CASE WHEN o_orderkey % 3 = 0 THEN 'C' END, 'Site ' || o_orderkey) AS name FROM orders""")
def grades_and_names(spark, sf):
    """Confidence by facts and by resolved references, plausibility of a position, names with fallbacks."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    fact = lambda n: F.when(k % n == 0, "x").otherwise("")
    return t(spark, sf, "orders").select(
        k.alias("id"), rules.grade_facts(fact(3), fact(2)).alias("facts"), rules.grade_resolved(c % 25, k % 6).alias("resolved"), rules.plausible(F.when(k % 11 != 0, c * 1000), F.lit(6_800_000)).alias("place"),
        rules.site_name(F.when(k % 2 == 0, " L ").otherwise("  "), F.when(k % 3 == 0, "C"), k).alias("name"),
    )


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(PLACES)} AS c FROM documents), e AS (SELECT *, string_split(c, ' ') AS w FROM d) SELECT doc_id, CASE WHEN len(w) = 1 THEN c WHEN len(w) > 2 AND NOT regexp_matches(w[2], '[0-9]') THEN w[1] || ' ' || w[2] ELSE w[1] END AS commune, CASE WHEN len(w) > 2 AND NOT regexp_matches(w[2], '[0-9]') THEN array_to_string(w[3:], ' ') WHEN len(w) > 1 THEN array_to_string(w[2:], ' ') END AS place FROM e""")
def commune_place_split(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.commune_place(_pick(PLACES)).alias("s")).select("doc_id", "s.commune", "s.place")


@query(f"""WITH a AS (SELECT doc_id, trim(regexp_replace(replace({_sql_pick(SPELLINGS)}, chr(160), ' '), '\\s+', ' ', 'g')) AS c FROM documents), b AS (SELECT doc_id, regexp_replace(c, '\\blt([abcd])\\b', 'LT \\1', 'gi') AS c FROM a), e AS (SELECT doc_id, regexp_replace(regexp_replace(c, 'ha\\s*d\\s*([123])', 'Ha D\\1', 'gi'), 'ha\\s*c', 'Ha C', 'gi') AS c FROM b)
SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(c, 'LT a', 'LT A'), 'LT b', 'LT B'), 'LT c', 'LT C'), 'LT d', 'LT D'), 'lt\\s*', 'LT ', 'gi')) AS spelling FROM e""")
def sub_period_spelling(spark, sf):
    return _docs(spark, sf).select("doc_id", rules.sub_period_spelling(_pick(SPELLINGS)).alias("spelling"))


_LOHI = f"WITH d AS (SELECT doc_id, [{_sql_pick(PAIRS)}, list_extract({_q(PAIRS)}, CAST((doc_id // 8) % 8 + 1 AS BIGINT))] AS ps FROM documents), n AS (SELECT doc_id, CAST(unnest(list_filter(flatten(list_transform(ps, lambda p: [try_cast(trim(split_part(p, ':', 1)) AS INT), try_cast(trim(split_part(p, ':', 2)) AS INT)])), lambda x: x IS NOT NULL)) AS INT) AS y FROM d), s AS (SELECT doc_id, min(y) AS lo, max(y) AS hi FROM n GROUP BY 1)"


def _spans(spark, sf):
    other = F.element_at(F.array(*[F.lit(v) for v in PAIRS]), (F.floor(F.col("doc_id") / 8) % 8 + 1).cast("int"))
    return _docs(spark, sf).select("doc_id", rules.span(_pick(PAIRS), other).alias("s")).select("doc_id", "s.*")


@query(f"{_LOHI} SELECT documents.doc_id, lo AS low, hi AS high FROM documents LEFT JOIN s USING (doc_id)")
def date_pair_span(spark, sf):
    """Envelope of two 'a : b' cells, each in order."""
    return _spans(spark, sf)


_SUBS = ", ".join(f"('{s}', {a}, {b}, '{rules._period_of(s)}', {i})" for i, (s, a, b) in enumerate(vocab.SUB_PERIODS))


@query(f"""{_LOHI}, p AS (SELECT *, greatest(0, least(hi, -450) - greatest(lo, -800) + 1) AS h, greatest(0, least(hi, -25) - greatest(lo, -450) + 1) AS l, greatest(0, least(hi, -400) - greatest(lo, -500) + 1) AS t FROM s), q AS (SELECT *, CASE WHEN greatest(h, l, t) = 0 THEN 'Hallstatt' WHEN t = greatest(h, l, t) THEN 'Hallstatt/La Tène' WHEN h >= l THEN 'Hallstatt' ELSE 'La Tène' END AS period FROM p),
sb(n, a, b, per, i) AS (VALUES {_SUBS}), r AS (SELECT doc_id, arg_max(n, (least(hi, b) - greatest(lo, a) + 1, -i)) AS sub, max(least(hi, b) - greatest(lo, a) + 1) AS y FROM q JOIN sb ON per = period AND least(hi, b) >= greatest(lo, a) GROUP BY 1)
SELECT q.doc_id, period, CASE WHEN greatest(h, l, t) > 0 AND y / (hi - lo + 1)::DOUBLE > 0.5 THEN sub END AS sub, CASE WHEN hi - lo > 1200 THEN NULL WHEN least(hi, -450) > greatest(lo, -800) AND least(hi, -450) - greatest(lo, -800) >= greatest(0, least(hi, -25) - greatest(lo, -450)) THEN 'Hallstatt' WHEN least(hi, -25) > greatest(lo, -450) THEN 'La Tène' WHEN least(hi, -400) > greatest(lo, -500) THEN 'Hallstatt/La Tène' END AS by_span FROM q LEFT JOIN r USING (doc_id)""")
def period_by_overlap(spark, sf):
    """Both overlap scorings: inclusive with the half rule for sub-periods, and exclusive with a limit of the span."""
    s = _spans(spark, sf).where("low is not null")
    return s.select("doc_id", rules.period_by_overlap(F.col("low"), F.col("high")).alias("p"), rules.period_by_span(F.col("low"), F.col("high")).alias("by_span")).select("doc_id", "p.period", "p.sub", "by_span")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(TEXTS)} AS c FROM documents), e AS (SELECT *, regexp_matches(c, 'Hallstatt|premier âge du Fer|\\bHa\\s*[CD]', 'i') AS ha, regexp_matches(c, 'La Tène|laténien|second âge du Fer|\\bLT [ABCD]', 'i') AS lt, regexp_matches(c, 'transition Hallstatt|Ha D3/LT|charnière Ha', 'i') AS tr, regexp_matches(c, '[Pp]rotohist') AS pr FROM d)
SELECT doc_id, CASE WHEN tr THEN 'TRANSITION' WHEN ha AND lt THEN 'HALLSTATT_LA_TENE' WHEN ha THEN 'HALLSTATT' WHEN lt THEN 'LA_TENE' WHEN pr THEN 'PROTOHISTOIRE' WHEN contains(c, 'Bronze final') THEN 'BRONZE_FINAL' WHEN contains(c, 'gallo-romain') THEN 'GALLO_ROMAIN' WHEN contains(c, 'mérovingi') THEN 'MEROVINGIEN' WHEN contains(c, 'moyen âge') THEN 'MEDIEVAL' ELSE '' END AS period,
CASE WHEN regexp_matches(c, 'La Tène I') THEN 'LT A' WHEN regexp_matches(c, 'Hallstatt C') THEN 'Ha C' WHEN regexp_matches(c, 'Hallstatt D') THEN 'Ha D' ELSE replace(regexp_extract(c, '(Ha [CD][0-9]?|LT [ABCD][0-9]?)', 1), ' ', '') END AS sub, ha OR lt OR tr OR pr AS iron FROM e""")
def text_period(spark, sf):
    """Period of a running text by precedence, with the wording of its sub-period."""
    return _docs(spark, sf).select("doc_id", rules.detected(_pick(TEXTS)).alias("p")).select("doc_id", "p.*")


@query("""WITH d AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS hc, o_orderkey % 3 = 0 AS hd, o_orderkey % 5 = 0 AS hg, list_extract(['Ha D1', 'LT B2', ''], CAST(o_orderkey % 3 + 1 AS BIGINT)) AS tx FROM orders),
e AS (SELECT k, list_concat(CASE WHEN hc THEN ['Ha C'] ELSE [] END, CASE WHEN hd THEN ['Ha D1', 'Ha D2', 'Ha D3'] ELSE [] END, CASE WHEN hg THEN ['Ha D'] ELSE [] END) AS f, tx FROM d), g AS (SELECT k, CASE WHEN tx <> '' AND NOT list_contains(f, tx) THEN list_append(f, tx) ELSE f END AS h FROM e)
SELECT k AS id, CASE WHEN len(h) = 0 THEN 'indéterminé' ELSE array_to_string(list_filter(h, lambda x: x <> 'Ha D' OR NOT list_has_any(h, ['Ha D1', 'Ha D2', 'Ha D3'])), ',') END AS phases FROM g""")
def phase_reconciliation(spark, sf):
    """Flag phases first, those of the text added; a general phase gives way to its parts."""
    k = F.col("o_orderkey")
    kind = "array<struct<period:string,sub:string,start:int,end:int>>"
    one = lambda s: F.array(F.struct(F.lit("La Tène" if s.startswith("LT") else "Hallstatt").alias("period"), F.lit(s).alias("sub"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end")))
    none = F.expr(f"cast(array() as {kind})")
    when = lambda test, *subs: F.when(test, F.concat(*[one(s) for s in subs])).otherwise(none)
    flags = F.concat(when(k % 2 == 0, "Ha C"), when(k % 3 == 0, "Ha D1", "Ha D2", "Ha D3"), when(k % 5 == 0, "Ha D"))
    texts = F.when(k % 3 == 0, one("Ha D1")).when(k % 3 == 1, one("LT B2")).otherwise(none)
    found = rules.reconciled(flags.cast(kind), texts.cast(kind))
    return t(spark, sf, "orders").select(k.alias("id"), F.array_join(F.transform(found, lambda p: F.coalesce(p["sub"], p["period"])), ",").alias("phases"))


_PAIR_ROWS = ", ".join(f"('{a}', '{b}', '{p}', '{s}', {lo}, {hi})" for (a, b), (p, s, lo, hi) in vocab.CODE_PAIRS.items())


@query(f"""WITH c(a, b, period, sub, s, e) AS (VALUES {_PAIR_ROWS}), d AS (SELECT doc_id, upper(substr({_sql_pick(CODES)}, 1, 6)) AS x, upper(substr(list_extract({_q(CODES)}, CAST((doc_id // 6) % 6 + 1 AS BIGINT)), 1, 6)) AS y FROM documents)
SELECT doc_id, period, sub, CAST(s AS INT) AS start_year, CAST(e AS INT) AS end_year FROM d LEFT JOIN c ON a = x AND b = y""")
def code_pair_interval(spark, sf):
    other = F.element_at(F.array(*[F.lit(v) for v in CODES]), (F.floor(F.col("doc_id") / 6) % 6 + 1).cast("int"))
    return _docs(spark, sf).select("doc_id", rules.code_interval(_pick(CODES), other).alias("c")).select("doc_id", "c.period", "c.sub", F.col("c.start").alias("start_year"), F.col("c.end").alias("end_year"))


@query(f"""WITH d AS (SELECT doc_id, list_transform(regexp_split_to_array({_sql_pick(SCOPES)}, '[,;/()]'), lambda p: regexp_extract(trim(p), '^[A-ZÀ-Ý][a-zà-ÿA-Z''-]+', 0)) AS ps, {_sql_pick(SCOPES)} AS s FROM documents) SELECT doc_id, array_to_string(list_filter(ps, lambda p: length(p) > 2 AND NOT list_contains({_q(vocab.SCOPE_STOPWORDS)}, p)), ';') AS places,
CASE WHEN contains(s, 'Colmar') THEN 'oppidum' WHEN doc_id % 2 = 0 THEN 'dépôt' END AS kind FROM d""")
def scope_places(spark, sf):
    """Place names of a geographic scope, and the type that the mentions give its first commune."""
    mentions = F.array(F.lit("rien sur Mulhouse"), F.lit("un habitat à Colmar, oppidum"), F.lit("nécropole de Metz"))
    categories = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("Bronzes"))).otherwise(F.array(F.lit("plans")))
    commune = F.coalesce(F.when(F.contains(_pick(SCOPES), F.lit("Colmar")), "Colmar"), F.lit("Nulle part"))
    return _docs(spark, sf).select("doc_id", F.array_join(rules.scope_places(_pick(SCOPES)), ";").alias("places"), rules.mention_type(mentions, categories, commune).alias("kind"))


NAMES = ("strassburg", "SELESTAT", "Sainte Croix en Plaine", "illkirch-graffenstaden", "Bale", "Mulhausen", "Nowhere ", "wissembourg")


@query(f"""WITH p(v, n) AS (VALUES ('strassburg', 'Strasbourg'), ('selestat', 'Sélestat'), ('illkirch-graffenstaden', 'Illkirch-Graffenstaden'), ('bale', 'Basel'), ('mulhausen', 'Mulhouse'), ('wissembourg', 'Wissembourg')), d AS (SELECT doc_id, {_sql_pick(NAMES)} AS m FROM documents)
SELECT doc_id, coalesce(n, trim(m)) AS by_fold, CASE WHEN lower(m) = 'sainte croix en plaine' THEN 'Sainte-Croix-en-Plaine' ELSE coalesce(n, trim(m)) END AS by_letters FROM d LEFT JOIN p ON v = lower(trim(m))""")
def toponym_variants(spark, sf):
    """Place names by folded keys and by letters alone."""
    return _docs(spark, sf).select("doc_id", rules.place_name(_pick(NAMES)).alias("by_fold"), rules.place_name(_pick(NAMES), "alnum").alias("by_letters"))


@query("""WITH p AS (SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'Hallstatt' WHEN 1 THEN 'La Tène' ELSE 'indéterminé' END AS a, CASE WHEN s_suppkey % 2 = 0 THEN 'Ha D1' ELSE 'LT B2' END AS b FROM supplier) SELECT id, CASE a WHEN 'indéterminé' THEN 'indéterminé' ELSE a END AS period, CASE WHEN b = 'Ha D1' THEN 'Ha D1' ELSE 'LT B2' END AS sub FROM p WHERE a <> 'indéterminé' UNION ALL SELECT id, CASE WHEN b = 'Ha D1' THEN 'Hallstatt' ELSE 'La Tène' END, b FROM p WHERE a = 'indéterminé'""")
def period_of_mention(spark, sf):
    """Period by its wording, else by the sub-period's prefix."""
    k = F.col("s_suppkey")
    said = F.concat(F.when(k % 3 == 0, "premier âge du fer ").when(k % 3 == 1, "laténien ").otherwise("site "), F.when(k % 2 == 0, "Ha D1").otherwise("LT B2"))
    # Only the wording before the sub-period decides where both could.
    worded = F.when(k % 3 == 2, said).otherwise(F.concat(F.when(k % 3 == 0, "Hallstatt ").otherwise("Latène "), F.when(k % 2 == 0, "Ha D1").otherwise("LT B2")))
    both = F.when(k % 3 == 1, F.concat(F.lit("Latène "), F.when(k % 2 == 0, "Ha").otherwise("LT"), F.lit("  "), F.when(k % 2 == 0, "D1").otherwise("B2"))).otherwise(worded)
    return t(spark, sf, "supplier").select(k.alias("id"), chrono.period(both).alias("p")).select("id", "p.period", F.regexp_replace("p.sub", r"\s+", " ").alias("sub"))


@query("""WITH d AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'FR' WHEN 1 THEN 'lu' WHEN 2 THEN '' END AS pays, CASE WHEN c_custkey % 5 <> 0 THEN 60 + c_custkey % 9 END AS dep FROM customer) SELECT id FROM d WHERE coalesce(pays IN ('FR', 'DE', 'CH') OR pays = '', true) AND coalesce(dep IN (67, 68), true)""")
def geographic_filter(spark, sf):
    """What states no country or department passes."""
    k = F.col("c_custkey")
    c = t(spark, sf, "customer").select(k.alias("id"), F.when(k % 4 == 0, "FR").when(k % 4 == 1, "lu").when(k % 4 == 2, "").alias("pays"), F.when(k % 5 != 0, (F.lit(60) + k % 9).cast("int")).alias("dep"))
    return c.where(R.area_ok(F.col("pays"), F.col("dep"))).select("id")


@query("""WITH d AS (SELECT s_suppkey AS id, 900000 + s_suppkey * 7919 % 300000 AS x, 6600000 + s_suppkey * 104729 % 600000 AS y FROM supplier) SELECT id, 'x outside the Upper Rhine' AS warning FROM d WHERE x NOT BETWEEN 930000 AND 1060000 UNION ALL SELECT id, 'y outside the Upper Rhine' FROM d WHERE y NOT BETWEEN 6710000 AND 6990000""")
def position_warnings(spark, sf):
    k = F.col("s_suppkey")
    x, y = (F.lit(900_000) + k * 7919 % 300_000).cast("double"), (F.lit(6_600_000) + k * 104_729 % 600_000).cast("double")
    return t(spark, sf, "supplier").select(k.alias("id"), F.explode(R.geo_warnings(x, y)).alias("warning"))


@query("""SELECT s_suppkey AS id, CAST(CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN s_suppkey + 0.5 ELSE 1234.25 END AS DOUBLE) AS comma, CAST(CASE WHEN s_suppkey % 4 = 1 THEN s_suppkey + 0.5 WHEN s_suppkey % 4 = 2 THEN 1234.25 WHEN s_suppkey % 4 = 3 THEN 1234.25 END AS DOUBLE) AS spaced,
'a=' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN ' | b=x' ELSE '' END AS pairs, CASE WHEN s_suppkey % 2 = 0 THEN 'Saint-Louis-Nord' ELSE 'Thann' END AS titled FROM supplier""")
def cell_numbers(spark, sf):
    """Decimal commas, thousands with no-break blanks, 'k=v' texts, capitals by hyphen."""
    k = F.col("s_suppkey")
    raw = F.when(k % 4 == 0, "n/a").when(k % 4 == 1, F.concat(k.cast("string"), F.lit(",5"))).when(k % 4 == 2, "1234.25").otherwise("1234,25")
    spaced = F.when(k % 4 == 0, "nan").when(k % 4 == 1, F.concat(k.cast("string"), F.lit(",5"))).otherwise("1\u00a0234,25")
    base = t(spark, sf, "supplier").select(k.alias("id"), raw.alias("raw"), spaced.alias("sp"), k.cast("string").alias("a"), F.when(k % 2 == 0, "x").otherwise("").alias("b"))
    return base.select("id", text.decimal(F.col("raw")).alias("comma"), text.decimal(F.col("sp"), nbsp=True).alias("spaced"), text.pairs_text(["a", "b"]).alias("pairs"), text.title_parts(F.when(F.col("id") % 2 == 0, "SAINT-louis-nord").otherwise("thann")).alias("titled"))


@query("SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'forêt' WHEN 1 THEN 'œuvre' ELSE 'plain' END AS fixed FROM supplier")
def mojibake_repair(spark, sf):
    """UTF-8 read as Latin-1 is read again; text beyond Latin-1 and clean text stay."""
    k = F.col("s_suppkey")
    return t(spark, sf, "supplier").select(k.alias("id"), text.repair_mojibake(F.when(k % 3 == 0, "for\u00c3\u00aat").when(k % 3 == 1, "œuvre").otherwise("plain")).alias("fixed"))


@query(r"SELECT doc_id, length(text) AS n, CASE WHEN regexp_matches(text, '[\x{80}-\x{FF}]') OR NOT regexp_matches(text, '[^\x00-\x7F]') THEN md5(text) END AS repaired FROM documents")
def mojibake_texts(spark, sf):
    """Whole texts of the table, their UTF-8 read as Latin-1 and repaired: those with a letter of Latin-1, or plain ones, are as they were."""
    d = t(spark, sf, "documents")
    repaired = text.repair_mojibake(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))
    known = F.col("text").rlike(r"[\x{80}-\x{FF}]") | ~F.col("text").rlike(r"[^\x00-\x7F]")
    return d.select("doc_id", F.length("text").cast("long").alias("n"), F.when(known, F.md5(repaired)).alias("repaired"))


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN '800 – 450 av. J.-C.' ELSE '620 – 540 av. J.-C.' END AS label, CASE WHEN s_suppkey % 2 = 0 THEN 'indéterminé' ELSE 'Hallstatt' END AS period, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'Ha D1' END AS sub FROM supplier""")
def date_pair_phases(spark, sf):
    """A range that starts in one 'a:b' cell and ends in the other, its label and its phase."""
    k = F.col("s_suppkey")
    low, high = F.when(k % 2 == 0, -800).otherwise(-620), F.when(k % 2 == 0, -450).otherwise(-540)
    wide = F.when(k % 2 == 0, "-2000:-1900").otherwise("-620:-600")
    phases = chrono.parse_pair(wide, F.when(k % 2 == 0, "-1850:-1800").otherwise("-560:-540"))
    return t(spark, sf, "supplier").select(k.alias("id"), chrono.label(low, high).alias("label"), F.get(phases, F.lit(0)).alias("p")).select("id", "label", "p.period", "p.sub")


@query("""WITH d AS (SELECT s_suppkey AS id, list_extract(['EURFER------', 'EURGAL------', 'Age du fer', 'Age du Bronze - age du Fer', 'EURXXX', 'Ha D'], CAST(s_suppkey % 6 + 1 AS BIGINT)) AS c FROM supplier), p(c, ps) AS (VALUES ('EURFER------', 'indéterminé::-800:-25'), ('EURGAL------', 'La Tène::-450:-25'), ('Age du fer', 'indéterminé::-800:-25'), ('Age du Bronze - age du Fer', 'Hallstatt::-800:-450'), ('EURXXX', 'indéterminé:::'), ('Ha D', 'Hallstatt:Ha D1:-620:-540|Hallstatt:Ha D2:-540:-500|Hallstatt:Ha D3:-500:-450'))
SELECT id, ps AS phases FROM d JOIN p USING (c)""")
def dating_codes(spark, sf):
    """Period codes, textual ages and coarse sub-periods."""
    k = F.col("s_suppkey")
    values = ("EURFER------", "EURGAL------", "Age du fer", "Age du Bronze - age du Fer", "EURXXX", "Ha D")
    said = F.element_at(F.array(*[F.lit(v) for v in values]), (k % 6 + 1).cast("int"))
    show = lambda p: F.concat(p["period"], F.lit(":"), F.coalesce(p["sub"], F.lit("")), F.lit(":"), F.coalesce(p["start"].cast("string"), F.lit("")), F.lit(":"), F.coalesce(p["end"].cast("string"), F.lit("")))
    return t(spark, sf, "supplier").select(k.alias("id"), F.array_join(F.transform(chrono.parse(said), show), "|").alias("phases"))


@query("""WITH n AS (SELECT DISTINCT p_name FROM part), w AS (SELECT p_name AS a, split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS b FROM n) SELECT a, 1.0::DOUBLE AS sorted_ratio, 1.0::DOUBLE AS set_ratio, round(2.0::DOUBLE * length(split_part(a, ' ', 1)) / (length(a) + length(split_part(a, ' ', 1))), 6) AS part_ratio FROM w""")
def ratio_kinds(spark, sf):
    """Of a name and its turned words: ratios by sorted and common tokens; of a name and its first word: the plain one."""
    n = t(spark, sf, "part").select("p_name").distinct()
    a, first, second = F.col("p_name"), F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    turned = F.concat(second, F.lit(" "), first)
    return n.select(a.alias("a"), similarity.token_sort_ratio(a, turned).alias("sorted_ratio"), similarity.token_set_ratio(a, turned).alias("set_ratio"), F.round(similarity.indel(a, first), 6).alias("part_ratio"))
