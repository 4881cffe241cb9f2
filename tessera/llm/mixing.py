"""Mixing sources to target weights by hash-threshold histograms; no sort of the documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NONSPACE_WORD, materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
#: Hash: the first 15 hex digits of the id's MD5, read in digits of DIGIT bits.
BITS, DIGIT = 60, 10
#: Threshold rows (one a source) that may be broadcast; beyond it they are joined by shuffle.
BROADCAST_SOURCES = 100_000


def size_of(text):
    return F.coalesce(F.regexp_count(text, F.lit(NONSPACE_WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> list[tuple[str | None, int, float]]:
    """(source, size, target): share of all sizes dealt by weight, capped at ``repeats`` times a source's size.

    Sources by code point, null last. The capped ones are those whose cap per weight lies under the
    common level; one pass over the sorted ratios finds that level.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    rows = [(s, n, weights[i % len(weights)]) for i, (s, n) in enumerate(order)]
    total = share * sum(n for _, n, _ in rows)
    left_w, capped = sum(w for *_, w in rows), 0
    for _, n, w in sorted(rows, key=lambda x: repeats * x[1] / x[2]):
        if left_w and (total - capped) * w / left_w >= repeats * n:
            capped += repeats * n
            left_w -= w
        else:
            break
    return [(s, n, min(float(repeats * n), (total - capped) * w / left_w) if left_w else float(repeats * n)) for s, n, w in rows]


def hashed(key):
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")


def thresholds(sized: DataFrame, budgets: list[tuple[str | None, int]]) -> dict[str | None, int]:
    """Per source the hash below which documents take one extra copy, so that those sizes come nearest the budget.

    Level by level: sums by source and hash digit, a running sum over the digits, and only the bucket
    in which the budget ends goes on to the next digit; the first level's table has at most
    sources * 2^DIGIT rows, later ones cover one bucket a source. The document in which the budget ends
    is taken where that misses the budget by less than leaving it out.
    """
    spark = sized.sparkSession
    found: dict[str | None, int] = {}
    state = [(s, b, 0) for s, b in budgets if b > 0]
    found.update({s: 0 for s, b in budgets if b <= 0})
    schema = "source string, budget long, prefix long"
    for used in range(0, BITS, DIGIT):
        if not state:
            break
        at = spark.createDataFrame(state, schema)
        at = F.broadcast(at) if len(state) <= BROADCAST_SOURCES else at
        inside = sized.join(at, sized["source"].eqNullSafe(at["source"]) & (F.shiftright(sized["hash"], BITS - used) == at["prefix"])).select(
            sized["source"], "budget", "prefix", F.shiftright("hash", BITS - used - DIGIT).alias("bucket"), "size"
        )
        sums = inside.groupBy("source", "budget", "prefix", "bucket").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        running = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("bucket")))
        over = running.where(F.col("upto") > F.col("budget")).groupBy("source").agg(F.min(F.struct("bucket", "upto", "size", "n", "budget")).alias("b")).select("source", "b.*")
        crossed = {r["source"]: r for r in over.collect()}
        after = []
        for s, _, prefix in state:
            r = crossed.get(s)
            if r is None:  # all of this bucket fits
                found[s] = (prefix + 1) << (BITS - used)
            elif r["n"] == 1 or used + DIGIT == BITS:  # one document (or one hash) in which the budget ends
                nearer = 2 * r["upto"] - r["size"] < 2 * r["budget"]
                found[s] = (r["bucket"] + nearer) << (BITS - used - DIGIT)
            else:
                after.append((s, r["budget"] - (r["upto"] - r["size"]), r["bucket"]))
        state = after
    return found


def plan(docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source", weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS):
    """(sized rows, plan): per source its size, target, whole copies and extra-copy hash threshold.

    The driver holds one row a source. The plan is a DataFrame to be joined by ``with_copies``.
    """
    spark = docs.sparkSession
    sized = materialise(docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"), F.coalesce(hashed(F.col(key)), F.lit(0)).alias("hash")), "mix-sizes")
    sizes = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    goal = targets(sizes, weights, share, repeats)
    base = {s: min(repeats, int(t // n)) if n else 0 for s, n, t in goal}
    limit = thresholds(sized, [(s, int(t - base[s] * n)) for s, n, t in goal])
    rows = [(s, n, t, base[s], limit[s] if base[s] < repeats else 0) for s, n, t in goal]
    made = spark.createDataFrame(rows, "__source string, source_size long, target double, __base int, __below long")
    return sized, F.broadcast(made) if len(rows) <= BROADCAST_SOURCES else made


def copies(hash_col):
    """Copies of a document under its source's plan."""
    return F.col("__base") + (hash_col < F.col("__below")).cast("int")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null text has size 0; the null source is a source of its own; null or repeated ids share one hash
    and so one decision; a very long text counts whole and is taken or left whole; an empty table gives
    an empty result; further columns are ignored.
    """
    sized, made = plan(docs, **options)
    return sized.join(made, sized["source"].eqNullSafe(made["__source"]), "left").select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("hash"))).cast("long").alias("taken"))


def sample(docs: DataFrame, *, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """``docs`` with each document repeated as often as the mix takes it (0, 1 or more times).

    Cases as in ``mix``; columns of any name but those that begin with two underscores pass unchanged.
    The texts stay where they are while the plan has at most BROADCAST_SOURCES sources; beyond it they
    are joined by source, where adaptive execution splits a hot one.
    """
    _, made = plan(docs, key=key, source=source, **options)
    made = made.select("__source", "__base", "__below")
    n = copies(F.coalesce(hashed(F.col(key)), F.lit(0)))
    joined = docs.join(made, F.col(source).cast("string").eqNullSafe(F.col("__source")), "left").withColumn("__n", n)
    return joined.where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*[docs[c] for c in docs.columns])


SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS hash FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, CASE (i - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 1.5::DOUBLE * sum(n) OVER () AS total FROM s),
r AS (
  SELECT *, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS left_w, coalesce(sum(2 * n) OVER o, 0) AS capped, row_number() OVER (ORDER BY 2.0::DOUBLE * n / w, i) AS k
  FROM w WINDOW o AS (ORDER BY 2.0::DOUBLE * n / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT left_w, capped FROM r WHERE (total - capped) * w / left_w < 2 * n ORDER BY k LIMIT 1),
t AS (SELECT w.source, n, least(2.0::DOUBLE * n, (total - capped) * w / left_w) AS target FROM w LEFT JOIN e ON true),
g AS (SELECT source, n, coalesce(target, 2.0::DOUBLE * n) AS target, CASE WHEN n > 0 THEN least(2, CAST(floor(coalesce(target, 2.0::DOUBLE * n) / n) AS BIGINT)) ELSE 0 END AS base FROM t),
c AS (
  SELECT d.*, g.n AS source_size, g.target, g.base, CAST(floor(g.target - g.base * g.n) AS BIGINT) AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto, sum(size) OVER (PARTITION BY d.source, hash) AS mass
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(size * (base + CASE WHEN base < 2 AND (upto <= budget OR 2 * upto - mass < 2 * budget) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
