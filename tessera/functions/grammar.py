"""Grammars of notices and indexes: a document in, one row a notice, entry or mention out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..operators.machine import running_count
from .text import mentions, site_type


def islands(lines: DataFrame, doc: str, order: str, line: str, start: Column) -> DataFrame:
    """lines with ``island``: the number of start lines up to each (0 before the first)."""
    return running_count(lines, doc, order, start, "island")


def lines_of(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(doc, F.posexplode(F.split(text, "\n", -1)).alias("n", "line"))


def notices(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row a commune notice: doc, number, commune, body; a line 'NNN - NAME' opens one."""
    marked = islands(lines_of(docs, doc, text), doc, "n", "line", F.col("line").rlike(vocab.NOTICE_HEADER)).where("island > 0")
    held = marked.groupBy(doc, "island").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("ls"))
    head = F.get("ls", F.lit(0))["line"]
    body = F.array_join(F.transform(F.slice("ls", F.lit(2), F.greatest(F.size("ls") - 1, F.lit(0))), lambda x: x["line"]), "\n")
    part = lambda g: F.regexp_extract(head, vocab.NOTICE_HEADER, g)
    return held.select(doc, part(1).alias("number"), F.trim(part(2)).alias("commune"), F.regexp_replace(body, r"^\s+|\s+$", "").alias("body"))


def sub_notices(found: DataFrame) -> DataFrame:
    """found (number, commune, body, ...) by coded parts: code ('' for what stands before the first), part."""
    # A mark before each coded line keeps the code with its part.
    marked = F.regexp_replace(F.concat(F.lit("\n"), F.col("body")), f"(?={vocab.SUB_NOTICE})", "\u0001")
    parts = F.split(marked, "\u0001")
    exploded = found.select(*found.columns, F.posexplode(parts).alias("part_no", "part")).where(F.trim(F.regexp_replace("part", r"\s+", " ")) != "")
    return exploded.withColumn("code", F.regexp_extract("part", "^" + vocab.SUB_NOTICE, 1)).withColumn("part", F.trim(F.regexp_replace("part", r"^\s+|\s+$", "")))


def notice_records(parts: DataFrame) -> DataFrame:
    """parts of ``sub_notices`` that name a dating or remains, with these, their type and citations."""
    told = parts.withColumns({"datings": mentions(F.col("part"), vocab.NOTICE_DATING), "remains": mentions(F.col("part"), vocab.NOTICE_REMAINS), "citations": F.regexp_extract_all("part", F.lit(vocab.CITATION), 1)})
    kept = told.where((F.size("datings") > 0) | (F.size("remains") > 0))
    return kept.withColumn("type_mention", F.when(F.size("remains") > 0, site_type(F.array_join("remains", " "))).otherwise(vocab.UNKNOWN)).withColumn("periode_mention", F.nullif(F.array_join("datings", " / "), F.lit("")))


def site_references(body: Column) -> Column:
    """Distinct '(NNN CC)' references of a notice, as 'NNN CC', in order of their first place."""
    p = r"\((\d{3})\s+(AH|AP|AE|AF)\)"
    return F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(p), 0), lambda x: F.concat_ws(" ", F.regexp_extract(x, p, 1), F.regexp_extract(x, p, 2))))


def index_entries(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row an index term: term, refs (sorted distinct three-digit numbers), cross (its 'cf.' terms).

    An entry opens with 'term : NNN'; other lines go on with it, headings and blanks are skipped.
    """
    raw = lines_of(docs, doc, text).withColumn("line", F.trim("line")).where(~F.col("line").rlike(vocab.INDEX_SKIP))
    marked = islands(raw, doc, "n", "line", F.col("line").rlike(vocab.INDEX_ENTRY)).where("island > 0")
    held = marked.groupBy(doc, "island").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), " ").alias("entry"))
    whole = "(?s)" + vocab.INDEX_ENTRY
    refs = F.regexp_extract("entry", whole, 2)
    cross = F.transform(F.regexp_extract_all(refs, F.lit(vocab.INDEX_CROSS), 1), lambda x: F.regexp_replace(F.trim(x), ",+$", ""))
    out = held.select(doc, F.trim(F.regexp_extract("entry", whole, 1)).alias("term"), F.array_sort(F.array_distinct(F.regexp_extract_all(refs, F.lit(r"\b(\d{3})\b"), 1))).alias("refs"), cross.alias("cross"))
    return out.where(F.size("refs") > 0)


def citation_facts(body: Column) -> Column:
    """Citations 'Author, year' as an array of struct(author, year)."""
    one = lambda x: F.struct(F.regexp_extract(x, r"^(.*), ", 1).alias("author"), F.regexp_extract(x, r"(\d{4})", 1).cast("int").alias("year"))
    return F.transform(F.regexp_extract_all(body, F.lit(vocab.CITATION), 1), one)


def split_bibliography(block: Column) -> Column:
    """struct(text, bibliography): the last paragraph where it stands in the second half and cites years or pages."""
    at = F.length(block) - F.instr(F.reverse(block), "\n\n") - 1
    has = F.contains(block, F.lit("\n\n")) & (F.contains(block, F.lit(";")) | F.contains(F.lower(block), F.lit("p.")))
    tail = F.trim(F.regexp_replace(F.substring(block, at + 1, F.length(block)), r"^\s+|\s+$", ""))
    cites = tail.rlike(r"(?i)\d{4}|p\.\s*\d")
    good = F.coalesce(has & (at > F.floor(F.length(block) / 2)) & cites, F.lit(False))
    return F.struct(F.when(good, F.regexp_replace(F.substring(block, F.lit(1), at), r"^\s+|\s+$", "")).otherwise(block).alias("text"), F.when(good, tail).otherwise("").alias("bibliography"))


#: (grammar, pattern, group of the place, group of the kind): place then kind, kind then place, a finding verb before a place.
MENTION_PATTERNS = (
    ("place_first", rf"(?is){vocab.PLACE_NAME}.{{0,160}}?\b({vocab.SITE_WORDS})\b", 1, 2),
    ("type_first", rf"(?is)\b({vocab.SITE_WORDS})\b{vocab.BEFORE_PLACE}.{{0,80}}?{vocab.PLACE_NAME}", 2, 1),
    ("found", rf"(?is){vocab.FINDING}{vocab.PLACE_NAME}", 1, 0),
)


def site_mentions(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """Mentions of a commune with a kind of site: doc, commune, kind, each pair once a text, without case.

    Three grammars in turn: place then kind, kind then place, and a finding verb before a place.
    """
    found = []
    for i, (_, p, place, kind) in enumerate(MENTION_PATTERNS):
        part = lambda x, g: F.regexp_extract(x, p, g)  # noqa: B023, E731
        found.append(F.transform(F.regexp_extract_all(text, F.lit(p), 0), lambda x, j: F.struct(F.lit(i).alias("g"), j.alias("j"), F.trim(part(x, place)).alias("commune"), (part(x, kind) if kind else F.lit("site archéologique")).alias("kind"))))  # noqa: B023
    rows = docs.select(doc, F.explode(F.concat(*found)).alias("m")).select(doc, "m.*").where("commune <> ''")
    low = F.when(F.col("g") == 2, "fouille").otherwise(F.lower("kind"))
    first = F.min(F.struct("g", "j", "commune", "kind")).alias("m")
    return rows.groupBy(doc, F.lower("commune").alias("k1"), low.alias("k2")).agg(first).select(doc, "m.commune", "m.kind")
