"""Secret scans in DataFrame operations only: fixed patterns plus a Markov likelihood ratio.

Two first-order character Markov models, of random strings and of ordinary identifiers, are trained
from labelled samples: drawn random strings and tokens within the fixed patterns' finds on one side,
built identifiers and the other tokens of a bounded sample of documents on the other. A token whose
log-likelihood ratio, summed over its transitions, reaches LEAST_NATS is a span of its own kind, so a
shorter token needs a clearer case. Everything is local to a row: no shuffle, no Python on the executors.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
_KEYWORD = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Greedy runs: a run that is too short fails whole, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
TOKEN = "[A-Za-z0-9+/_=-]{12,}"
ASSIGN_LEAST = 12
#: Nats of a token's likelihood ratio from which it counts as random.
LEAST_NATS = 20.0
#: Bound of the sample of documents whose tokens the models are trained on.
SAMPLE_ROWS = 2_000
#: Matches whose positions are summed at once; longer lists are summed in such pieces.
PIECE = 256

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Labelled samples: so many drawn strings of each kind.
SAMPLES = 20_000
_PARTS = (
    "get set make find load save read write open close send parse build check count list item name value index user order table column row "
    "file path text line word page node tree graph query plan join filter group window batch stream task stage cache store key map field "
    "token secret password config server client request response handler manager factory service model view event error message buffer "
    "thing other which their about would there could these first after where right think three small large place again found still learn"
).split()


def samples(n: int = SAMPLES, seed: int = 7) -> tuple[list[str], list[str]]:
    """(random strings, ordinary identifiers), reproducible."""
    rng = random.Random(seed)
    sets = (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], "0123456789abcdef")
    noise = ["".join(rng.choices(rng.choice(sets), k=rng.randint(12, 48))) for _ in range(n)]
    plain = []
    for _ in range(n):
        words = rng.choices(_PARTS, k=rng.randint(2, 6))
        style = rng.randrange(6)
        if style == 0:
            x = "_".join(words)
        elif style == 1:
            x = words[0] + "".join(w.title() for w in words[1:])
        elif style == 2:
            x = "_".join(words).upper()
        elif style == 3:
            x = "-".join(words)
        elif style == 4:
            x = "/".join(words)
        else:
            x = "".join(words)
        plain.append(x + str(rng.randrange(1000)) * (rng.random() < 0.15) + "=" * rng.randint(0, 30) * (rng.random() < 0.05) + "-" * rng.randint(0, 30) * (rng.random() < 0.05))
    return noise, plain


Counts = list[list[float]]


def transitions(tokens: Iterable[str]) -> Counts:
    """Number of each transition, a row for each first character of ALPHABET."""
    k, at = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    counts = [[0.0] * k for _ in range(k)]
    for t in tokens:
        for a, b in zip(t, t[1:]):
            counts[at[a]][at[b]] += 1
    return counts


def train(noise: Counts, plain: Counts, smooth: float = 1.0) -> list[float]:
    """Log-likelihood ratio of each transition, row by row over ALPHABET."""
    logs = [[math.log((x + smooth) / (sum(row) + smooth * len(row))) for row in counts for x in row] for counts in (noise, plain)]
    return [round(a - b, 6) for a, b in zip(*logs)]


def _codes(token: Column) -> Column:
    """A token's characters as places in ALPHABET."""
    codes = F.lit([ALPHABET.find(chr(c)) for c in range(128)])
    return F.transform(F.split(token, ""), lambda c: F.get(codes, F.ascii(c)))


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token, summed over its transitions."""
    k, llr = len(ALPHABET), F.lit(table)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _codes(token), start,
        lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when((acc["last"] < 0) | (c < 0), 0.0).otherwise(F.get(llr, acc["last"] * k + c))).alias("sum")),
        lambda acc: acc["sum"],
    )


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Array of (start, end, kind, match): the pieces between matches give the positions in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string,match:string>>)")
    pairs = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), F.length(g).alias("g")))

    def placed(piece: Column) -> Column:
        """struct(at, out): length of a piece, and its matches by place within it."""
        begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
        one = lambda at, x: F.struct((at + x["g"]).alias("start"), (at + x["g"] + F.length(x["h"])).alias("end"), F.lit(kind).alias("kind"), x["h"].alias("match"))
        return F.aggregate(piece, begin, lambda acc, x: F.struct((acc["at"] + x["g"] + F.length(x["h"])).alias("at"), F.concat(acc["out"], F.array(one(acc["at"], x))).alias("out")))

    # Appending within pieces, then among them, keeps the copies few for texts with very many matches.
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / PIECE).cast("int")), lambda i: placed(F.slice(pairs, i * PIECE + 1, PIECE)))
    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    offsets = F.aggregate(cut, begin, lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    moved = lambda p, d: F.transform(p["out"], lambda m: F.struct((m["start"] + d).alias("start"), (m["end"] + d).alias("end"), m["kind"].alias("kind"), m["match"].alias("match")))
    several = F.flatten(F.zip_with(cut, offsets, moved))
    return F.when(text.rlike(pattern), F.when(F.size(hits) > PIECE, several).otherwise(placed(pairs)["out"])).otherwise(none)


def _found(docs: DataFrame, text: str, *carried: str) -> DataFrame:
    """carried, base (array of spans of the fixed patterns) and its parts a, k, h, and tokens r."""
    rows = docs.select(*carried, F.coalesce(F.col(text), F.lit("")).alias("t"))
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2))
    return rows.select(
        *carried,
        F.filter(matches(F.col("t"), ASSIGN, "assign"), lambda x: value(x["match"]) >= ASSIGN_LEAST).alias("a"),
        matches(F.col("t"), ACCESS, "access").alias("k"),
        matches(F.col("t"), HEX, "hex").alias("h"),
        matches(F.col("t"), TOKEN, "random").alias("r"),
    ).withColumn("base", F.concat("a", "k", "h"))


def _meets(x: Column, base: str) -> Column:
    return F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))


def fit(docs: DataFrame, *, text: str = "text", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> list[float]:
    """Ratio table from drawn and built strings and the distinct tokens of at most ``rows`` documents, drawn by the hash of their id.

    Tokens within a find of the fixed patterns are labelled random, the others ordinary; their
    transitions are counted by grouped aggregation, at most 2 * 67 * 67 counts.
    """
    drawn = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("__id")).distinct().orderBy(F.xxhash64("__id"), "__id").limit(rows)
    found = _found(docs.join(F.broadcast(drawn), F.col(key) == F.col("__id"), "left_semi"), text)
    labelled = found.select(F.explode(F.transform("r", lambda x: F.struct(x["match"].alias("token"), _meets(x, "base").alias("random")))).alias("t"))
    tokens = labelled.select("t.token", "t.random").distinct()
    codes = _codes(F.col("token"))
    pairs = tokens.select("random", F.explode(F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    noise, plain = map(transitions, samples())
    for r in pairs.groupBy("random", "p").count().collect():
        (noise if r["random"] else plain)[r["p"]["a"]][r["p"]["b"]] += r["count"]
    return train(noise, plain)


def scan(docs: DataFrame, *, text: str = "text", least: float = LEAST_NATS, table: list[float] | None = None) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, found (array of spans).

    Base spans always stay; a token of the likelihood test counts where it overlaps none of them. The
    table is fitted on a sample of ``docs`` where none is given. Positions are code points, end exclusive;
    spans that start together come by kind. Null or empty text has no spans (digest of the empty string);
    a very long text is scanned whole; an empty table gives an empty result; further columns are ignored;
    rows are independent, so repeated rows repeat.
    """
    table = table or fit(docs, text=text)
    rank = lambda s: F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1).when(s["kind"] == "hex", 2).otherwise(3)
    ordered = lambda c: F.array_sort(F.transform(c, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = _found(docs, text, "doc_id").withColumn("r", F.filter("r", lambda x: (ratio(x["match"], table) >= least) & ~_meets(x, "base")))
    told = lambda c: F.array_join(F.transform(ordered(c), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select(
        "doc_id",
        *[F.size(c).cast("long").alias(n) for c, n in (("a", "n_assign"), ("k", "n_access"), ("h", "n_hex"))],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.concat("base", "r")).alias("spans"),
        F.transform(ordered(F.concat("base", "r")), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found"),
    )


def _sql(kind: str, pattern: str, keep: str) -> str:
    """Places of one kind in SQL: lengths of matches and of what lies between them."""
    p = pattern.replace("'", "''")
    return f"""{kind}0 AS (SELECT r, regexp_extract_all(t, '{p}') AS h, list_transform(regexp_split_to_array(t, '{p}'), lambda x: length(x)) AS g FROM d WHERE regexp_matches(t, '{p}')),
{kind}1 AS (SELECT r, h, g, unnest(range(1, len(h) + 1)) AS i FROM {kind}0),
{kind} AS (SELECT r, '{kind}' AS kind, CAST(list_sum(g[1:i]) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(h[i]) AS n, h[i] AS m FROM {kind}1 WHERE {keep.format(m="h[i]")})"""


#: The base columns alone.
BASE_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
{_sql("assign", ASSIGN, "length(regexp_extract({m}, '" + ASSIGN.replace("'", "''") + "', 2)) >= 12")},
{_sql("access", "AKIA[A-Z0-9]+", "length({m}) >= 18")},
{_sql("hex", "[0-9a-f]+", "length({m}) >= 16")},
u AS (SELECT *, 0 AS k FROM assign UNION ALL SELECT *, 1 FROM access UNION ALL SELECT *, 2 FROM hex),
s AS (SELECT r, string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS told, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex FROM u GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(told, '')) AS base_sha256 FROM d LEFT JOIN s ON s.r = d.r
"""
