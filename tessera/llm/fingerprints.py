"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ascending list of the k least distinct hashes of a text's shingles. The sketch of a union is
the k least of the parts' sketches, so texts are sketched in pieces and groups in parts; two sketches
estimate resemblance and containment, one the number of distinct shingles. With fewer than k hashes a
sketch is the whole set and the figures are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alnum_bytes, binary, pieces
from .passages import _hash_piece, _mix

SHINGLE = 5
SIZE = 128
#: Bytes of a text that are hashed at once.
PIECE_BYTES = 1_000_000
#: Rows whose fingerprints are made at once.
STEP_ROWS = 512
#: Sampled keys per range of the order of documents, which set the ranges' bounds.
SAMPLED = 64
_LAST = 2**63 - 1


def shingle_hashes(words: np.ndarray, shingle: int) -> np.ndarray:
    """Non-negative 63-bit hash of each run of ``shingle`` words; of fewer words, but not none, that of all."""
    size = min(shingle, len(words))
    if not size:
        return np.zeros(0, dtype=np.int64)
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * np.uint64(0x100000001B3) + words[i : len(words) - size + 1 + i]
    return (_mix(out) >> np.uint64(1)).view(np.int64)


def sketch(text: bytes | None, size: int = SIZE, shingle: int = SHINGLE) -> np.ndarray:
    """The ``size`` least distinct shingle hashes of a text, merged over its pieces; words as in ``alnum_words``."""
    held, carried, several = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), False
    for piece in pieces(alnum_bytes(text), PIECE_BYTES) if text else ():
        words = np.concatenate((carried, _hash_piece(piece)[0]))
        if len(words) < shingle:  # more may follow
            carried = words
            continue
        held = merge(held, shingle_hashes(words, shingle), size)
        carried, several = words[len(words) - shingle + 1 :], True
    return held if several else shingle_hashes(carried, shingle)


def merge(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> np.ndarray:
    return np.unique(np.concatenate((a, b)))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> tuple[float, float]:
    """(resemblance, containment of the first in the second): shares of the least of the union that are common; nothing is like nothing, and in anything."""
    both = np.sort(np.concatenate((a, b)))
    if not len(both):
        return 1.0, 1.0
    twice = both[1:] == both[:-1]
    least = both[np.concatenate(([True], ~twice))][:size]
    common = int(np.count_nonzero(both[1:][twice] <= least[-1]))
    mine = int(np.count_nonzero(a <= least[-1]))
    return common / len(least), common / mine if mine else 1.0


def distinct(held: np.ndarray, size: int = SIZE) -> float:
    """Estimated number of distinct shingles."""
    return float(len(held)) if len(held) < size else (size - 1) * 2.0**63 / (float(held[size - 1]) + 1)


def encoded(held: np.ndarray) -> str:
    """16 lowercase hex digits a hash, ascending."""
    return held.astype(">i8").tobytes().hex()


# The same as columns, over sketches held as ascending array<bigint>.


def _least(a: Column, b: Column, size: int) -> Column:
    return F.slice(F.array_sort(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    least = _least(a, b, size)
    return F.when(F.size(least) == 0, 1.0).otherwise(F.size(F.array_intersect(least, F.array_intersect(a, b))) / F.size(least))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the first's shingles that the second holds."""
    mine = F.array_intersect(_least(a, b, size), a)
    return F.when(F.size(mine) == 0, 1.0).otherwise(F.size(F.array_intersect(mine, b)) / F.size(mine))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise(F.lit((size - 1) * 2.0**63) / (F.get(a, F.lit(size - 1)).cast("double") + 1))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def sketches(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """key and sketch of each row, narrow. Null and wordless texts have an empty sketch."""

    def run(batches):
        for batch in batches:
            made = [sketch(t, size, shingle) for t in binary(batch, "text")]
            ends = np.concatenate(([0], np.cumsum([len(m) for m in made], dtype=np.int64))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *made])))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, sketch array<bigint>")


def merged(held: DataFrame, by: list[str], *, sketch: str = "sketch", size: int = SIZE) -> DataFrame:
    """The sketch of each group's union: by, sketch.

    The window's limit is applied before the shuffle too, so of a group, however large, a task sends
    no more than its ``size`` least hashes, once for each row that holds them. A group of empty sketches has an empty one.
    """
    keys = [F.col(c) for c in by]
    rows = held.select(*keys, F.explode_outer(sketch).alias("__h"))
    ranked = rows.withColumn("__at", F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col("__h").asc_nulls_last()))).where(F.col("__at") <= size)
    return ranked.groupBy(*keys).agg(F.array_sort(F.collect_set("__h")).alias(sketch))


def _place(bounds: list[tuple[int, int]]) -> Callable:
    """Number of the range that a key (down, h) lies in: how many bounds are not above it."""
    first, second = (np.array(x, dtype=np.int64) for x in (zip(*bounds) if bounds else ((), ())))

    def run(down: pa.Array, h: pa.Array) -> pa.Array:
        a, b = down.to_numpy(), h.to_numpy()
        low, high = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
        out = low.copy()
        for x, y in {(int(x), int(y)) for x, y in zip(low[low < high], high[low < high])}:
            tied = (low == x) & (high == y)
            out[tied] = x + np.searchsorted(second[x:y], b[tied], "right")
        return pa.array(out.astype(np.int32))

    return F.arrow_udf(run, "int")


def in_order(docs: DataFrame, *, text: str = "text", key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Rows by descending key, each range of the order in one sorted partition and followed by the row that comes after it.

    Columns: part, peek (true for that further row), doc_id, text (null is empty). Null keys come last, equal keys by their
    texts' hash and text; after the last row comes the first. Bounds come from a sample of keys; the
    texts are shuffled once. Equal rows share a range.
    """
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    down = F.coalesce(F.bitwise_not(F.col(key).cast("long")), F.lit(_LAST))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"), down.alias("down"), F.xxhash64(body).alias("h"))
    keys = rows.select("down", "h")
    total = docs.count()
    drawn = sorted(map(tuple, (keys if total <= SAMPLED * n else keys.sample(SAMPLED * n / total, 12)).collect()))  # about SAMPLED * n keys
    bounds = sorted({drawn[len(drawn) * i // n] for i in range(1, n)}) if drawn else []
    place = _place(bounds)
    heads = sorted((r.part, r.least.down, r.least.h) for r in keys.withColumn("part", place("down", "h")).groupBy("part").agg(F.min(F.struct("down", "h")).alias("least")).collect())  # a row a range
    after = [(part, *heads[(i + 1) % len(heads)][1:]) for i, (part, *_) in enumerate(heads)]
    named = spark.createDataFrame(after, "part int, down long, h long")
    peeks = rows.join(F.broadcast(named), ["down", "h"]).groupBy("part", "down", "h").agg(F.min("text").alias("text"))
    own = rows.select(place("down", "h").alias("part"), F.lit(False).alias("peek"), "doc_id", "text", "down", "h")
    both = own.unionByName(peeks.select("part", F.lit(True).alias("peek"), F.lit(None).cast("long").alias("doc_id"), "text", "down", "h"))
    return both.repartitionById(n, F.col("part")).sortWithinPartitions("part", "peek", "down", "h", "text").select("part", "peek", "doc_id", "text")


def _compare(size: int, shingle: int) -> Callable:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained", "n_shingles"]

    def pairs(batches) -> Iterator[list]:
        """(id, text, sketch, next text, next sketch) of some rows and the one before."""
        before = None
        for batch in (whole.slice(at, STEP_ROWS) for whole in batches for at in range(0, whole.num_rows, STEP_ROWS)):
            out = []
            for part, peek, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                same = before is not None and before[2] == text
                at = (part, doc, text, before[3] if same else sketch(text.encode(), size, shingle))
                if before is not None and before[0] == part:
                    out.append((*before[1:], at[2], at[3]))
                before = None if peek else at
            yield out

    def run(batches):
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
        for rows in pairs(batches):
            out = []
            for doc, text, mine, after, theirs in rows:
                half = len(text) // 2
                changed = (text[: len(text) - half] + after[:half]).encode()
                made = sketch(changed, size, shingle)
                near, contained = likeness(mine, made, size)
                out.append((doc, len(text), hashlib.sha256(changed).hexdigest(), encoded(mine), encoded(made), near, likeness(mine, theirs, size)[0], contained, distinct(mine, size)))
            cols = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names)

    return run


def compare(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = SIZE, shingle: int = SHINGLE, ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``, with the fingerprints of its text and of its edited text.

    Edited: the last floor(n_chars / 2) code points give way to the first as many of the next document by descending key.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    (estimated resemblance), contained (share of the own shingles in the edited text), n_shingles.
    Null text counts as empty; texts without words have an empty fingerprint, all alike; null keys come
    last, equal keys are ordered by text; repeated rows follow each other; a single row is its own next; a very long text is
    sketched in pieces; an empty table gives an empty result; other columns are ignored.
    """
    shape = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained double, n_shingles double"
    return in_order(docs, text=text, key=key, ranges=ranges).mapInArrow(_compare(size, shingle), shape)


BASE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
o AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS x FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(substring(t, 1, n - n // 2) || substring(x, 1, n // 2)) AS edited_sha256 FROM o
"""
