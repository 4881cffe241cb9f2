"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group. Large groups are items of their own, a group over a whole shard is dealt over
as few items as that takes by its ids' hash, and the small groups are pooled by hash into a fixed number
of bundles, so what the driver packs has a bound that no input exceeds. Each item goes to the shard
where the dot product of its vector with the residual capacity is highest. Slots are numbered in pieces
of an item, so that no task has to sort a whole shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise
from .mixing import size_of

SHARDS = 40
#: Bundles of small groups per shard; also the share of a shard from which a group is packed alone.
BUNDLES = 64
#: Weights of bytes, tokens and rows in the dot product.
WEIGHTS = (4.0, 1.0, 1.0)
OVERHEAD = 16
#: Rows that one task numbers, about.
ROWS_PER_PIECE = 200_000


def pack(items: Sequence[tuple[int, int, int, int]], shards: int = SHARDS, weights: Sequence[float] = WEIGHTS) -> dict[int, tuple[int, int]]:
    """item -> (shard, first slot), for items (id, bytes, tokens, rows).

    Largest items first (ties by id). Capacities are the even shares; a residual may go below zero,
    which then counts against the shard.
    """
    if not items:
        return {}
    load = np.array([x[1:] for x in items], dtype=float)
    share = np.maximum(load.sum(axis=0) / shards, 1e-9)
    unit = load / share
    residual, rows = np.ones((shards, 3)), [0] * shards
    w = np.asarray(weights)
    out = {}
    for i in sorted(range(len(items)), key=lambda i: (-float((unit[i] * w).sum()), items[i][0])):
        k = int(np.argmax(residual @ (unit[i] * w)))
        out[items[i][0]] = (k, rows[k])
        residual[k] -= unit[i]
        rows[k] += items[i][3]
    return out


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"__g": F.xxhash64(t), "__size": (F.octet_length(t) + OVERHEAD).cast("long"), "__tokens": size_of(F.col(text)), "__crc": F.crc32(t.cast("binary"))})


class Placement:
    """Where each row goes: by its group or bundle, then by the piece of it that the id's hash names.

    All tables are bounded: large groups by 3 * shards * bundles, pieces by the rows over ROWS_PER_PIECE.
    """

    def __init__(self, rows: DataFrame, key: str, shards: int, bundles: int):
        """rows: narrow, with the columns of ``_keyed`` and the key."""
        spark, n = rows.sparkSession, shards * bundles
        self.key, self.n = key, n
        total = rows.agg(F.sum("__size"), F.sum("__tokens"), F.count(F.lit(1))).first()
        part = [max(1, int(x or 0) // n) for x in total]
        share = [max(1.0, (x or 0) / shards) for x in total]
        self.pieces = -(-(total[2] or 0) // (n * ROWS_PER_PIECE)) or 1
        sums = rows.groupBy("__g").agg(F.sum("__size").alias("b"), F.sum("__tokens").alias("t"), F.count(F.lit(1)).alias("r"))
        # At most n groups can exceed one n-th of each measure: 3 n groups with, in all, 6 n lots.
        most = lambda parts: F.greatest(*[F.col(c) / p for c, p in zip("btr", parts)])
        large = sums.where(most(part) > 1).select("__g", *[F.least("r", F.ceil(most(p))).cast("int").alias(c) for c, p in (("parts", part), ("lots", share))])
        firsts, lot_of, at = [], {}, n
        for g, parts, lots in large.orderBy("__g").collect():
            firsts.append((g, parts, at))
            lot_of.update((at + i, at + i % lots) for i in range(parts))
            at += parts
        self.large = F.broadcast(spark.createDataFrame(firsts, "__g long, __parts int, __first long"))
        counted = materialise(self.itemed(rows).groupBy("__item", "__piece").agg(F.sum("__size").alias("b"), F.sum("__tokens").alias("t"), F.count(F.lit(1)).alias("r")), "shard-pieces")
        loads = sorted(counted.groupBy("__item").agg(F.sum("b"), F.sum("t"), F.sum("r")).collect())
        items: dict[int, list[int]] = {}
        for i, *load in loads:
            lot = items.setdefault(lot_of.get(i, i), [0, 0, 0])
            lot[:] = [x + y for x, y in zip(lot, load)]
        placed = pack([(i, *load) for i, load in items.items()], shards)
        slots, out = {i: at for i, (_, at) in placed.items()}, []
        for i, *_, r in loads:
            lot = lot_of.get(i, i)
            out.append((i, placed[lot][0], slots[lot]))
            slots[lot] += r
        begun = F.sum("r").over(Window.partitionBy("__item").orderBy("__piece")) - F.col("r")
        shard_of = spark.createDataFrame(out, "__item long, shard int, __slot long")
        self.table = counted.select("__item", "__piece", begun.alias("__begun")).join(F.broadcast(shard_of), "__item").select("__item", "__piece", "shard", (F.col("__slot") + F.col("__begun")).alias("__from"))

    def itemed(self, rows: DataFrame) -> DataFrame:
        joined = rows.join(self.large, "__g", "left")
        h = F.xxhash64(self.key)
        item = F.when(F.col("__first").isNotNull(), F.col("__first") + F.pmod(h, F.col("__parts"))).otherwise(F.pmod("__g", F.lit(self.n)))
        return joined.withColumn("__item", item).withColumn("__piece", F.pmod(F.shiftright(h, 32), F.lit(self.pieces)).cast("int")).drop("__parts", "__first")

    def numbered(self, rows: DataFrame, *ties) -> DataFrame:
        """rows with shard and slot; each piece numbers its own rows, so this is one shuffle of what they hold."""
        nth = F.row_number().over(Window.partitionBy("__item", "__piece").orderBy(F.col(self.key).asc_nulls_last(), "__crc", "__size", *ties)) - 1
        return self.itemed(rows).join(F.broadcast(self.table), ["__item", "__piece"]).withColumn("slot", (F.col("__from") + nth).cast("long"))


def _place(docs: DataFrame, shards: int, bundles: int, text: str, key: str) -> tuple[DataFrame, Placement]:
    rows = materialise(_keyed(docs.select(key, text), text).drop(text), "shard-rows")
    return rows, Placement(rows, key, shards, bundles)


def shard(docs: DataFrame, *, shards: int = SHARDS, bundles: int = BUNDLES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Slots number a shard's rows from 0 without gaps: each piece owns a range and numbers only its own
    rows. Equal texts share a shard unless together they exceed an even shard's bytes, tokens or rows.
    Null text counts as empty (16 bytes); null ids share a piece; repeated rows get slots of their own; a
    very long text is one row like any other; an empty table gives an empty result; further columns are
    ignored.
    """
    rows, at = _place(docs, shards, bundles, text, key)
    return at.numbered(rows).select(
        F.col(key).alias("doc_id"), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def attach(docs: DataFrame, *, shards: int = SHARDS, bundles: int = BUNDLES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, which replace columns of these names; other columns but those with two leading underscores pass.

    Cases as in ``shard``. The texts are shuffled once, to where their slots are counted.
    """
    _, at = _place(docs, shards, bundles, text, key)
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    ties = [F.xxhash64(*[f"`{c}`" for c, kind in docs.dtypes if c in kept and "map<" not in kind])]
    return at.numbered(_keyed(docs.select(*[f"`{c}`" for c in kept]), text), *ties).select(*[f"`{c}`" for c in kept], "shard", "slot")
