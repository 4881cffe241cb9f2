"""Full-text search for all of several words: posting lists, intersected from the shortest on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[a-z]{7,}"


def postings(docs: DataFrame, key: str, text: str, pattern: str = WORD) -> DataFrame:
    """(term, doc): every distinct lower-case match of the pattern in each text. A caller may keep it as a table partitioned by term."""
    return docs.select(F.col(key).alias("doc"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), 0))).alias("term"))


def all_of(index: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, doc) of the documents that hold every term of a query. index: term, doc; queries: query, terms.

    Only lists of terms asked for are read on. Of each query the shortest list gives the candidates, and
    these alone are probed for the other terms, by an equi-join on (term, doc), so what is shuffled grows with the
    shortest lists and not with the longest. A query without terms, or with one that no document holds, finds nothing;
    null documents are never found.
    """
    asked = queries.select("query", F.explode(F.array_distinct("terms")).alias("term")).where("term is not null")
    held = index.where("doc is not null").join(asked.select("term").distinct(), "term", "left_semi").distinct()
    sizes = held.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    plan = asked.join(sizes, "term", "left").groupBy("query").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("ts"))
    plan = plan.where(F.col("ts")[0]["n"] > 0).select("query", F.col("ts")[0]["term"].alias("term"), F.expr("transform(slice(ts, 2, size(ts)), x -> x.term)").alias("others"))
    found = plan.join(held, "term").select("query", "doc", "others")
    probes = found.where(F.size("others") > 0).select("query", "doc", F.size("others").alias("m"), F.explode("others").alias("term"))
    kept = probes.join(held, ["term", "doc"]).groupBy("query", "doc", "m").agg(F.count(F.lit(1)).alias("n")).where("n = m").select("query", "doc")
    return found.where(F.size("others") == 0).select("query", "doc").unionByName(kept)
