"""SimHash near-dedup: fingerprints linked within a Hamming radius by BK-trees over shards.

Shards come from the pigeonhole principle: of BLOCKS blocks of bits, two fingerprints within the
radius agree on at least BLOCKS - radius; each choice of so many blocks deals the distinct
fingerprints by their bits there. Every pair within the radius meets in a shard, none is lost, and a
shard's BK-tree (children keyed by the integer distance to the parent, only edges within the radius
followed) is built where its rows are, since a broadcast tree of the corpus would have no size bound.
A shard of over TREE_NODES fingerprints is not searched in one task: its fingerprints are dealt over trees
of about that size, and all of them are streamed through each tree.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import binary, materialise, space_words
from .components import components

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCKS = 6
BITS = 64
#: Fingerprints that one tree holds, about.
TREE_NODES = 8_192


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    import xxhash

    words = space_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=n)
    ones = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(n, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int, text_col: str, carried: tuple[str, ...]):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = np.array([fingerprint(t, shingle) for t in binary(batch, text_col)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(out)], [*carried, "fp"])

    return run


class BKTree:
    """Node: value, its id, children by distance."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def add(self, value: int, node: int) -> None:
        if self.root is None:
            self.root = (value, node, {})
            return
        at = self.root
        while True:
            d = (value ^ at[0]).bit_count()
            down = at[2].get(d)
            if down is None:
                at[2][d] = (value, node, {})
                return
            at = down

    def within(self, value: int, radius: int) -> list[int]:
        found, stack = [], [self.root] if self.root else []
        while stack:
            v, node, children = stack.pop()
            d = (value ^ v).bit_count()
            if d <= radius:
                found.append(node)
            for k in range(max(1, d - radius), d + radius + 1):
                child = children.get(k)
                if child:
                    stack.append(child)
        return found


class Forest:
    """A BK-tree with the components of its nodes."""

    def __init__(self):
        self.tree, self.fps, self.root = BKTree(), [], []

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def near(self, value: int, radius: int) -> dict[int, int]:
        """component -> one node of it within the radius."""
        return {self.find(j): j for j in self.tree.within(value, radius)}

    def add(self, value: int, radius: int) -> list[tuple[int, int]]:
        """Add a node; the links that join components, at most one a component."""
        i, edges = len(self.fps), []
        self.fps.append(value)
        self.root.append(i)
        for r, j in self.near(value, radius).items():
            self.root[r] = i
            edges.append((value, self.fps[j]))
        self.tree.add(value, i)
        return edges


def shard_edges(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one shard: at most one edge a fingerprint."""
    if len(fps) == 2:
        return [(fps[0], fps[1])] if (fps[0] ^ fps[1]).bit_count() <= radius else []
    forest, edges = Forest(), []
    for v in fps:
        edges += forest.add(v, radius)
    return edges


def _batch(edges: list[tuple[int, int]], deferred: list[tuple[int, int]] = ()):
    """Edges (a, b), and fingerprints a of shards that were put off."""
    import pyarrow as pa

    ends = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    late = np.array([v for v, _ in deferred], dtype=np.uint64).view(np.int64)
    cols = [
        pa.array(np.concatenate((ends[:, 0], late))), pa.concat_arrays([pa.array(ends[:, 1]), pa.nulls(len(late), pa.int64())]),
        pa.concat_arrays([pa.nulls(len(ends), pa.int64()), pa.array([k for _, k in deferred], type=pa.int64())]),
    ]
    return pa.RecordBatch.from_arrays(cols, ["a", "b", "shard"])


def _shards(radius: int, most: int):
    """Over rows sorted by shard key: the links of each shard, held one shard at a time; larger ones are put off."""

    def run(batches):
        key, fps, put_off = None, [], False
        for batch in batches:
            edges, late = [], []
            keys = batch.column("shard").to_numpy(zero_copy_only=False)
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    if len(fps) > 1 and not put_off:
                        edges += shard_edges(fps, radius)
                    key, fps, put_off = keys[a], [], False
                fps += values[a:b].view(np.uint64).tolist()
                if put_off or len(fps) > most:
                    late += [(v, key) for v in fps]
                    fps, put_off = [], True
            yield _batch(edges, late)
        if len(fps) > 1 and not put_off:
            yield _batch(shard_edges(fps, radius))

    return run


def _trees(radius: int):
    """Over rows sorted by tree, its nodes before the rest: the links of all with the tree's nodes, one a component."""

    def run(batches):
        key, forest = None, None
        for batch in batches:
            edges = []
            names = ("shard", "part", "node", "fp")
            for shard, part, node, fp in zip(*(batch.column(c).to_pylist() for c in names)):
                if (shard, part) != key:
                    key, forest = (shard, part), Forest()
                v = fp & (1 << BITS) - 1
                edges += forest.add(v, radius) if node else [(v, forest.fps[j]) for j in forest.near(v, radius).values()]
            yield _batch(edges)

    return run


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, most: int = TREE_NODES) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of ``fps`` (column fp) that connect what lies within the radius."""
    width = [BITS // blocks + (i < BITS % blocks) for i in range(blocks)]
    at = [sum(width[:i]) for i in range(blocks)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << width[i]) - 1) << at[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    kind = "a long, b long, shard long"
    dealt = fps.select("fp", F.explode(keys).alias("shard"))
    found = materialise(dealt.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(_shards(radius, most), kind), "fp-links")
    edges, late = found.where("b is not null").select("a", "b"), found.where("b is null").select(F.col("a").alias("fp"), "shard")
    if late.isEmpty():
        return edges
    parts = late.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    sized = late.join(parts, "shard").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = sized.select("shard", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("shard", "part", (F.col("own") == F.col("part")).alias("node"), "fp")
    more = rows.repartition("shard", "part").sortWithinPartitions("shard", "part", F.desc("node"), "fp").mapInArrow(_trees(radius), kind)
    return edges.union(more.select("a", "b"))


def _rooted(rows: DataFrame, carried: dict[str, str], radius: int, shingle: int, blocks: int) -> DataFrame:
    """``rows`` (doc_id, text and the other columns ``carried``) without the text, with fp and component_id."""
    shape = ", ".join([*(f"{c} {kind}" for c, kind in carried.items()), "fp long"])
    fps = materialise(rows.mapInArrow(_fingerprints(shingle, "text", tuple(carried)), shape), "fingerprints")
    held = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fp-reps")
    found = components(links(held, radius, blocks))
    rooted = held.join(found, held["fp"] == found["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp")


def near_dedup(docs: DataFrame, *, radius: int = RADIUS, shingle: int = SHINGLE, blocks: int = BLOCKS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    The nodes are fingerprints, so rows without an id link others like any row. Null, empty or blank
    text has fingerprint zero and links like any other; component_id is the least non-null id reachable
    (null only where no id is); equal fingerprints and repeated rows share a component; a very long text
    is hashed as a whole; an empty table gives an empty result; further columns are ignored.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return _rooted(rows, {"doc_id": "long"}, radius, shingle, blocks).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, radius: int = RADIUS, shingle: int = SHINGLE, blocks: int = BLOCKS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the one with the least id, once.

    Rows are told apart by id and text, so texts that share an id but no component both stay; of texts
    that share the least id of their component the one with the least hash stays, of rows that share id and text the
    one with the least hash of all columns. Rows without an id have no place in the order and stay.
    """
    h = F.xxhash64(text)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), h.alias("h"))
    found = materialise(_rooted(rows, {"doc_id": "long", "h": "long"}, radius, shingle, blocks).where("doc_id is not null"), "near-dedup")
    first = found.where("doc_id = component_id")
    tied = first.groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least < most").select("doc_id", "least")
    dropped = found.where("doc_id != component_id").select("doc_id", "h").unionByName(first.join(tied, "doc_id").where("h != least").select("doc_id", "h"))
    dropped = dropped.distinct().select(F.col("doc_id").alias("__id"), F.col("h").alias("__of"))
    kept = docs.withColumn("__h", h).join(dropped, (F.col(key) == F.col("__id")) & (F.col("__h") == F.col("__of")), "left_anti")
    repeated = found.groupBy("doc_id", "h").count().where("count > 1").select(F.col("doc_id").alias("__id"), F.col("h").alias("__of"))
    if repeated.isEmpty():
        return kept.drop("__h")
    same = (F.col(key) == F.col("__id")) & (F.col("__h") == F.col("__of"))
    place = F.row_number().over(Window.partitionBy(key, "__h").orderBy(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))))
    one = kept.join(repeated, same, "left_semi").withColumn("__at", place).where("__at = 1").drop("__at")
    return kept.join(repeated, same, "left_anti").unionByName(one).drop("__h")
