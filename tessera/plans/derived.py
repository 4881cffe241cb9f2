"""Queries over further derivations: dialects, dates, page flows, caches, keys."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import vocab
from ..functions import rules
from ..operators import match as M
from ..operators import rows as R
from ..operators import search as S
from ..operators.shared import shared_dir
from ..sources import typed
from ..sources.keyed import KeyedTable
from .common import t
from .domain import _pick, _sql_pick
from .relational import query

#: Datings of a dialect and what the fixed rules make of them.
DATINGS = {
    "Ha D3 / LTA": ("Hallstatt/La Tène", "Ha D3 / LT A", -500, -400), "HaC-D1": ("Hallstatt", "Ha C", -800, -540), "Ha D 1 - D2": ("Hallstatt", "Ha D1", -620, -500), "LTB": ("La Tène", "LT B", -380, -260), "lt b - c1": ("La Tène", "LT B1", -380, -200),
    "Hallstatt": ("Hallstatt", None, -800, -450), "Bronze final IIIb": (vocab.UNKNOWN, None, None, None), "": (vocab.UNKNOWN, None, None, None), "fosse Ha D2": ("Hallstatt", "Ha D2", -540, -500), "LT D1 et LT D2": ("La Tène", "LT D1", -150, -25),
    "Ha D2, puis LT C1": ("Hallstatt/La Tène", "Ha D3 / LT A", -500, -400), "rien": (vocab.UNKNOWN, None, None, None), "Ha D": ("Hallstatt", "Ha D", -620, -450), "LT A-B": ("La Tène", "LT A", -450, -380),
}
_lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
_DATED = ", ".join(f"({_lit(k)}, {', '.join(map(_lit, v))})" for k, v in DATINGS.items())


@query(f"WITH p(c, period, sub, a, b) AS (VALUES {_DATED}), d AS (SELECT doc_id, {_sql_pick(tuple(DATINGS))} AS c FROM documents) SELECT doc_id, period, sub, CAST(a AS INT) AS start_year, CAST(b AS INT) AS end_year FROM d JOIN p USING (c)")
def dating_dialect(spark, sf):
    """Datings of one source's dialect by an ordered table of rules."""
    p = rules.dialect(_pick(tuple(DATINGS)))
    return t(spark, sf, "documents").select("doc_id", p.alias("p")).select("doc_id", "p.period", "p.sub", F.col("p.start").alias("start_year"), F.col("p.end").alias("end_year"))


WORDED = ("Hallstattzeit et Latènezeit", "laténien", "Ha D3/LT A", "transition Hallstatt-La Tène", "LT B", "rien")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(WORDED)} AS c FROM documents) SELECT doc_id, CASE WHEN regexp_matches(c, 'Hallstatt|Ha D') THEN 'Hallstatt' WHEN regexp_matches(c, 'Latène|laténien|La Tène|LT [AB]') THEN 'La Tène' END AS by_first,
CASE WHEN c = 'Hallstattzeit et Latènezeit' THEN 'Hallstatt' WHEN regexp_matches(c, 'transition|Ha D3/LT A') THEN 'Hallstatt/La Tène' WHEN regexp_matches(c, 'laténien|LT B') THEN 'La Tène' END AS by_longest,
CASE WHEN regexp_matches(c, 'transition|Ha D3/LT A') THEN 'Hallstatt/La Tène' WHEN regexp_matches(c, 'Hallstatt|Ha D') THEN 'Hallstatt' WHEN regexp_matches(c, 'Latène|laténien|LT [AB]') THEN 'La Tène' END AS by_transition, CASE WHEN regexp_matches(c, 'Hallstatt') THEN 'Hallstatt' WHEN regexp_matches(c, 'laténien|Latène') THEN 'La Tène' WHEN contains(c, 'Ha D3/LT A') THEN 'Hallstatt/La Tène' END AS by_long_patterns FROM d""")
def worded_periods(spark, sf):
    """Period by text patterns under four policies."""
    c = _pick(WORDED)
    return t(spark, sf, "documents").select(
        "doc_id", rules.worded_period(c).alias("by_first"), rules.worded_period(c, order="longest").alias("by_longest"), rules.worded_period(c, order="transition").alias("by_transition"), rules.worded_period(c, least=5).alias("by_long_patterns")
    )


@query("SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders) WHERE d IS NOT NULL GROUP BY 1")
def latest_dated(spark, sf):
    """The latest dated record of a group; texts that are no date have none."""
    k = F.col("o_orderkey")
    said = F.when(k % 4 == 0, "sans date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = t(spark, sf, "orders").select(F.col("o_custkey").alias("id"), k.alias("k"), F.try_to_timestamp(said).alias("d")).where("d is not null")
    return rows.groupBy("id").agg(F.max_by("k", F.struct("d", "k")).alias("latest"))


@query("SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, min(l_orderkey) AS first_seen FROM lineitem GROUP BY 1, 2")
def pair_dedupe(spark, sf):
    """Unordered pairs once each, with the first place that has them."""
    pairs = t(spark, sf, "lineitem").select(F.least("l_partkey", "l_suppkey").alias("a"), F.greatest("l_partkey", "l_suppkey").alias("b"), "l_orderkey")
    return M.first_wins(pairs, ["a", "b"], [F.col("l_orderkey")]).withColumnRenamed("l_orderkey", "first_seen")


ODD = ("  Déjà\u00a0 vu ", "\ufb01bule", "10 m\u00b2", "A\u2026B", "plain")


@query(f"WITH d AS (SELECT doc_id, {_sql_pick(ODD)} AS c FROM documents) SELECT doc_id, trim(regexp_replace(lower(replace(replace(replace(replace(c, chr(160), ' '), chr(64257), 'fi'), chr(178), '2'), chr(8230), '...')), ' +', ' ', 'g')) AS plain, replace(coalesce(c, ''), ' ', '') <> '' AS filled FROM d")
def compatibility_text(spark, sf):
    """Lower-case text with compatibility forms resolved."""
    c = _pick(ODD)
    return t(spark, sf, "documents").select("doc_id", rules.plain(c).alias("plain"), (rules.compact(c) != "").alias("filled"))


RAW = ("Oppidum — fouille 1998", "Tombe", "Ferme — A — B")
SAID = ("La Tène LT D1", "Hallstatt Ha C", "gallo-romain", "indéterminé")


@query(f"""WITH d AS (SELECT doc_id, {_sql_pick(RAW)} AS r, {_sql_pick(SAID)} AS s FROM documents) SELECT doc_id, split_part(r, ' — ', 1) AS name, coalesce(nullif(regexp_extract(s, '(Hallstatt|La Tène|indéterminé)', 1), ''), 'indéterminé') AS period, nullif(regexp_extract(s, '((?:Ha|LT)\\s*\\w+)', 1), '') AS sub FROM d""")
def golden_columns(spark, sf):
    """Name, period and sub-period cut out of a golden set's text columns (a word that begins like a sub-period counts as one)."""
    r, s = _pick(RAW), _pick(SAID)
    sub = F.nullif(F.regexp_extract(s, r"((?:Ha|LT)\s*\w+)", 1), F.lit(""))
    return t(spark, sf, "documents").select("doc_id", F.substring_index(r, " — ", 1).alias("name"), F.coalesce(F.nullif(F.regexp_extract(s, "(Hallstatt|La Tène|indéterminé)", 1), F.lit("")), F.lit(vocab.UNKNOWN)).alias("period"), sub.alias("sub"))


IDS = ("12 / 67 001 / X /  / Y", "12 / xx / X", "a / b", "9 / 68 123 0001 / Z")


@query(f"WITH d AS (SELECT doc_id, string_split({_sql_pick(IDS)}, ' / ') AS p FROM documents) SELECT doc_id, len(p) >= 3 AND regexp_matches(p[2], '^[0-9][0-9] ') AS ok, replace(p[1] || p[2], ' ', '') AS compact FROM d")
def identifier_check(spark, sf):
    """Whether an identifier parses, and its head without blanks."""
    c = _pick(IDS)
    p = F.split(c, " / ")
    return t(spark, sf, "documents").select("doc_id", rules.parsed_ok(c).alias("ok"), rules.compact(F.concat(F.get(p, F.lit(0)), F.get(p, F.lit(1)))).alias("compact"))


KEYS = ("R.A.E.", "B. A.", "Bull. Soc.", "Gallia Préhistoire", "C.A.A.A.H.", "Ann. E.N.")


@query(f"WITH d AS (SELECT doc_id, {_sql_pick(KEYS)} AS c FROM documents) SELECT doc_id, CASE WHEN regexp_matches(replace(c, ' ', ''), '^([A-Z]\\.){{2,}}$') THEN 'sigle' WHEN regexp_matches(c, '[A-Z]\\.') THEN 'abbreviation' ELSE 'title' END AS kind FROM d")
def abbreviation_kinds(spark, sf):
    return t(spark, sf, "documents").select("doc_id", rules.abbreviation_kind(_pick(KEYS)).alias("kind"))


@query("""WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 5 IN (2, 3, 4) AND conv_id % 3 = 0 THEN '' ELSE text END AS x FROM conversations), b AS (SELECT *, CASE WHEN trim(x) = '' THEN 1 ELSE 0 END AS blank, lag(CASE WHEN trim(x) = '' THEN 1 ELSE 0 END, 1) OVER w AS b1, lag(CASE WHEN trim(x) = '' THEN 1 ELSE 0 END, 2) OVER w AS b2 FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, coalesce(sum(CASE WHEN blank = 1 AND b1 = 1 AND b2 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM b) SELECT conv_id, count(*) AS read_pages, count(*) FILTER (blank = 0 AND regexp_matches(x, '[A-Za-z]')) AS kept_pages FROM s WHERE stopped = 0 GROUP BY 1""")
def page_flow(spark, sf):
    """Pages of a document up to three blank ones in a row; of these, the ones with readable text."""
    pages = t(spark, sf, "conversations").select("conv_id", "turn", F.when((F.col("turn") % 5 >= 2) & (F.col("conv_id") % 3 == 0), "").otherwise(F.col("text")).alias("x"))
    read = R.blank_cutoff(pages, "conv_id", "turn", F.trim("x") == "")
    good = typed.is_page(F.col("x")) & F.col("x").rlike("[A-Za-z]")
    return read.groupBy("conv_id").agg(F.count(F.lit(1)).alias("read_pages"), F.count_if(good).alias("kept_pages"))


@query("SELECT c_custkey AS id, CASE WHEN c_nationkey % 3 = 0 THEN 'hit' WHEN c_nationkey % 3 = 1 THEN 'known_miss' ELSE 'ask' END AS state FROM customer")
def lookup_cache(spark, sf):
    """A cache of looked-up places: found, known to be missing (an empty answer), or still to be asked."""
    n = t(spark, sf, "nation").where("n_nationkey % 3 <> 2").select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, F.array("n_name")).otherwise(F.expr("cast(array() as array<string>)")).alias("answer"))
    c = t(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select(F.col("c_custkey").alias("id"), F.when(F.col("answer").isNull(), "ask").when(F.size("answer") == 0, "known_miss").otherwise("hit").alias("state"))


@query("SELECT o_custkey AS id, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def insert_or_replace(spark, sf):
    """Of rows with one key the last inserted stays."""
    rows = t(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return typed.last_of(rows, "id", "k").select("id", "status")


@query("""WITH w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{7,}'))) AS term FROM documents), i AS (SELECT term, count(*) AS n_docs, min(doc_id) AS first_doc FROM w GROUP BY 1) SELECT term, n_docs, first_doc FROM i""")
def term_index(spark, sf):
    """Index of long words: documents that hold each, and the first of them."""
    d = t(spark, sf, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{7,}"), 0))).alias("term"))
    return d.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


_WORDS = "list_distinct(regexp_extract_all(lower(text), '[a-z]{7,}'))"


@query(f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), q AS (SELECT item_id, list_sort({_WORDS})[1:3] AS ts FROM benchmark)
SELECT item_id AS query, doc_id AS doc FROM q JOIN d ON len(ts) > 0 AND list_has_all(w, ts)""")
def search_all_words(spark, sf):
    """Documents that hold the first three long words, in order, of each benchmark item."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(S.WORD), 0)))
    asked = t(spark, sf, "benchmark").select(F.col("item_id").alias("query"), F.slice(words, 1, 3).alias("terms"))
    return S.all_of(S.postings(t(spark, sf, "documents"), "doc_id", "text"), asked)


@query("""SELECT id, CASE WHEN id % 3 = 0 THEN 'late' ELSE 'early' END AS state, total FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS total FROM orders) WHERE id % 2 = 0 OR id % 3 = 0""")
def keyed_upserts(spark, sf):
    """A keyed table after two writes, read back: every second order, then every third in a later state."""
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit("early").alias("state"), F.col("o_totalprice").alias("total"))
    table = KeyedTable(spark, f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}")
    table.replace(o.where("id % 2 = 0"), ["id"])
    table.replace(o.where("id % 3 = 0").withColumns({"state": F.lit("late"), "total": F.col("total") * 2}), ["id"])
    return table.read()


@query("""SELECT c_mktsegment AS source, CAST(c_custkey AS VARCHAR) AS ref FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT 'BUILDING', 's' || s_suppkey FROM supplier""")
def keyed_by_source(spark, sf):
    """A keyed table whose rows of one source were written again, read back."""
    c = t(spark, sf, "customer").select(F.col("c_mktsegment").alias("source"), F.col("c_custkey").cast("string").alias("ref"))
    table = KeyedTable(spark, f"{shared_dir(spark)}/keyed-{uuid.uuid4().hex}")
    table.replace(c, ["source"])
    table.replace(t(spark, sf, "supplier").select(F.lit("BUILDING").alias("source"), F.concat(F.lit("s"), "s_suppkey").alias("ref")), ["source"])
    return table.read()


#: Worded datings with what the open and the strict policy make of them.
_NONE = (vocab.UNKNOWN, None, None, None)
_TRANSITION = ("Hallstatt", "Ha D3 / LT A", -500, -400)
POLICIES = {
    "Ha D1": (("Hallstatt", "Ha D1", -620, -540),) * 2, "premier âge du Fer": (("Hallstatt", None, -800, -450),) * 2, "LT C1 tardif": (("La Tène", "LT C1", -260, -200),) * 2, "Ha C et LT B1": (_TRANSITION, ("Hallstatt", "LT B1", -800, -450)), "Ha D3 - LT A": (_TRANSITION,) * 2,
    "Hallstatt D2": (("Hallstatt", None, -800, -450), ("Hallstatt", "Ha D2", -540, -500)), "LTB": (("La Tène", "LT B", -450, -25), ("La Tène", "LT B1", -380, -320)), "laténien": (("La Tène", None, -450, -25),) * 2, "bronze final": (_NONE, ("Bronze final", None, None, None)), "-": (_NONE,) * 2, "sans rien": (_NONE,) * 2,
    "Ha D1 puis Ha D3": (("Hallstatt", "Ha D3", -500, -450),) * 2,
}
_POLICY = ", ".join(f"({_lit(k)}, {', '.join(map(_lit, (*a, *b)))})" for k, (a, b) in POLICIES.items())


@query(f"WITH p(c, p1, s1, a1, b1, p2, s2, a2, b2) AS (VALUES {_POLICY}), d AS (SELECT doc_id, {_sql_pick(tuple(POLICIES))} AS c FROM documents) SELECT doc_id, p1 AS period, s1 AS sub, CAST(a1 AS INT) AS start_year, CAST(b1 AS INT) AS end_year, p2 AS strict_period, s2 AS strict_sub, CAST(a2 AS INT) AS strict_start, CAST(b2 AS INT) AS strict_end FROM d JOIN p USING (c)")
def worded_dating(spark, sf):
    """Two more dialects of dating: by wording with the last sub-period, openly and strictly."""
    c = _pick(tuple(POLICIES))
    d = t(spark, sf, "documents").select("doc_id", rules.worded_dating(c).alias("o"), rules.worded_dating(c, strict=True, bronze=True).alias("s"))
    return d.select("doc_id", "o.period", "o.sub", F.col("o.start").alias("start_year"), F.col("o.end").alias("end_year"), F.col("s.period").alias("strict_period"), F.col("s.sub").alias("strict_sub"), F.col("s.start").alias("strict_start"), F.col("s.end").alias("strict_end"))
