"""Ranked lexical search as a blocked sparse matrix product.

Items times terms holds the multiplicities, terms times documents the int64 impacts. Documents become
sparse rows over the terms of the items (written once, narrow); blocks of them are turned into columns by
term, an item's row of the product is the merge of its terms' columns (Gustavson), and each task keeps the best
so many of every item over its blocks. What the tasks keep meets in a window with a limit per group.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alnum_bytes, alnum_words, binary, materialise, pieces

BEST = 50
#: Distinct terms of the items that are searched at once: with their multiplicities, what is broadcast.
#: More take further passes over the documents; an item alone may have more.
BLOCK_TERMS = 250_000
BLOCK_ENTRIES = 1_000_000
#: Documents and postings of a block of the product.
BLOCK_DOCS = 16_384
BLOCK_POSTINGS = 4_000_000
PIECE_BYTES = 1_000_000
MILLE, UNIT, HALF = 1000, 1_000_000_000, 50


@dataclass
class Items:
    """Rows of the item matrix: ids, and per item the numbers of its terms and how often it has them."""

    vocab: dict[bytes, int]
    ids: list[int | None]
    terms: list[np.ndarray]
    times: list[np.ndarray]


def blocks(items: DataFrame, most_terms: int = BLOCK_TERMS, most_entries: int = BLOCK_ENTRIES, key: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The items in blocks, by id; rows that share an id (null is one) are one item. The driver holds one block."""
    held, entries = Items({}, [], [], []), 0

    def grouped() -> Iterator[tuple[int | None, Counter]]:
        at, found = None, None
        for item, t in items.select(F.col(key).alias("k"), F.col(text).alias("t")).orderBy("k").toLocalIterator():
            if found is None or item != at:
                if found:
                    yield at, found
                at, found = item, Counter()
            found.update(alnum_words(t.encode() if t else None))
        if found:
            yield at, found

    for item, found in grouped():
        new = sum(w not in held.vocab for w in found)
        if held.ids and (len(held.vocab) + new > most_terms or entries + len(found) > most_entries):
            yield held
            held, entries = Items({}, [], [], []), 0
        numbers = [held.vocab.setdefault(w, len(held.vocab)) for w in sorted(found)]
        held.ids.append(item)
        held.terms.append(np.array(numbers, dtype=np.int32))
        held.times.append(np.array([found[w] for w in sorted(found)], dtype=np.int64))
        entries += len(numbers)
    if held.ids:
        yield held


def _rows(vocab) -> Callable:
    """doc_id, n and the sparse row of each document with a term."""

    def run(batches):
        import pyarrow as pa

        number = vocab.value
        for batch in batches:
            kept, sizes, terms, times, ends = [], [], [], [], [0]
            for i, text in enumerate(binary(batch, "text")):
                n, parts = 0, []
                for piece in pieces(alnum_bytes(text), PIECE_BYTES) if text else ():
                    words = piece.split()
                    n += len(words)
                    ids = np.fromiter(map(number.get, words, repeat(-1)), dtype=np.int32, count=len(words))
                    parts.append(ids[ids >= 0])
                if not n:
                    continue
                held, count = np.unique(np.concatenate(parts), return_counts=True)
                kept.append(i)
                sizes.append(n)
                terms.append(held)
                times.append(count)
                ends.append(ends[-1] + len(held))
            joined = [np.concatenate(x) if x else np.zeros(0) for x in (terms, times)]
            lists = [pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(x.astype(np.int32))) for x in joined]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, type=pa.int64())), pa.array(sizes, type=pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return run


def impacts(n: np.ndarray, doc: np.ndarray, times: np.ndarray, weight: np.ndarray, docs: int, length: int) -> np.ndarray:
    """weight * saturated frequency of each posting, in 64-bit integers."""
    damp = np.array([100 - HALF + HALF * x * docs // length for x in n.tolist()], dtype=np.int64)
    return weight * (UNIT * times // (MILLE * times + 20 * damp[doc]))


class Best:
    """The best documents of one item so far: highest score, then least id, null ids last."""

    def __init__(self, most: int):
        self.most, self.least = most, 1
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def offer(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``score`` over the block's documents, zero where the item has no term."""
        found = np.flatnonzero(score >= self.least)
        if not len(found):
            return
        if len(found) > self.most:  # ties at the limit stay for the sort
            found = found[score[found] >= np.partition(score[found], -self.most)[-self.most]]
        s, i, z = (np.concatenate(x) for x in ((self.score, score[found]), (self.id, ids[found]), (self.null, null[found])))
        order = np.lexsort((i, z, -s))[: self.most]
        self.score, self.id, self.null = s[order], i[order], z[order]
        if len(order) == self.most:
            self.least = max(1, int(self.score[-1]))


def _product(shared, weight: np.ndarray, docs: int, length: int, best: int, counted: bool) -> Callable:
    def run(batches):
        import pyarrow as pa

        items = shared.value
        top = [Best(best) for _ in items.ids]

        def multiply(parts):
            ids, null, n, terms, times, size = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(terms, kind="stable")
            doc = np.repeat(np.arange(len(n)), size)
            values = impacts(n, doc, times, weight[terms], docs, length)[order]
            doc, first = doc[order], np.searchsorted(terms[order], np.arange(len(items.vocab) + 1)).tolist()
            for numbers, often, kept in zip(items.terms, items.times, top):
                row = np.zeros(len(n), dtype=np.int64)
                for t, m in zip(numbers.tolist(), often.tolist()):
                    a, b = first[t], first[t + 1]
                    if a < b:  # a document stands once in a term's column
                        row[doc[a:b]] += values[a:b] * m if counted else values[a:b]
                kept.offer(row, ids, null)

        parts, rows, postings = [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(at, BLOCK_DOCS)
                size = batch.column(2).value_lengths().to_numpy()
                flat = [batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3)]
                parts.append((batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), *flat, size))
                rows, postings = rows + batch.num_rows, postings + len(flat[0])
                if rows >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    multiply(parts)
                    parts, rows, postings = [], 0, 0
        if parts:
            multiply(parts)
        for i, (item, kept) in enumerate(zip(items.ids, top)):
            m = len(kept.score)
            if m:
                yield pa.RecordBatch.from_arrays([pa.array([i] * m, type=pa.int32()), pa.array([item] * m, type=pa.int64()), pa.array(kept.id, mask=kept.null), pa.array(kept.score)], ["item", "item_id", "doc_id", "score"])

    return run


def search(
    docs: DataFrame, items: DataFrame, *, best: int = BEST, counted: bool = False, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
    most_terms: int = BLOCK_TERMS, most_entries: int = BLOCK_ENTRIES,
) -> DataFrame:
    """The ``best`` documents of each item: item_id, rank, doc_id, score; with ``counted`` a term counts as often as the item has it.

    Null or termless texts count for nothing on either side; items that share an id are one, null is an
    id; documents without an id come last among equals; repeated documents are ranked one by one; equal
    scores go by id; a very long text is read in pieces; an empty table on either side gives an empty
    result; other columns are ignored. The texts are read once per block of items.
    """
    spark = docs.sparkSession
    kind = "item int, item_id long, doc_id long, score long"
    found = []
    for block in blocks(items, most_terms, most_entries, item_key, item_text):
        vocab = spark.sparkContext.broadcast(block.vocab)
        held = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_rows(vocab), "doc_id long, n long, terms array<int>, times array<int>")
        matrix = materialise(held, "term-rows")
        vocab.destroy()
        count, length = matrix.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not count:
            continue
        weight = np.zeros(len(block.vocab), dtype=np.int64)
        for term, df in matrix.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # one row a term of the block
            weight[term] = math.floor(MILLE * math.log((2 * count + 2) / (2 * df + 1)))
        shared = spark.sparkContext.broadcast(block)
        scored = matrix.mapInArrow(_product(shared, weight, count, length, best, counted), kind)
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)
        found.append(ranked.select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


SQL = """
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
d AS (SELECT doc_id, r, ws, len(ws) AS n FROM w WHERE len(ws) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
k AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt FROM t, c GROUP BY term, n_docs),
p AS (SELECT t.r, t.term, wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS v FROM t JOIN d ON d.r = t.r JOIN k ON k.term = t.term, c),
s AS (SELECT item_id, r, CAST(sum(v) AS BIGINT) AS score FROM q JOIN p ON p.term = q.term GROUP BY item_id, r HAVING sum(v) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s JOIN d ON d.r = s.r
QUALIFY rank <= 50
"""
