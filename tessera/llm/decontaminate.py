"""Benchmark decontamination: stream documents through a suffix automaton of the test items."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import alnum_words, binary, materialise, runs

WINDOW = 13
#: n_hit * COVERAGE >= n_words marks a document.
COVERAGE = 20
#: Benchmark words per automaton, the bound of what is broadcast; a larger benchmark takes further passes
#: over the rows, which are written in between.
BLOCK_WORDS = 500_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[SuffixAutomaton]:
    """Automata over blocks of at most ``block_words`` words; a longer item comes in pieces that share its windows.

    Items without an id mark words like others under the key None.
    """
    block, size = [], 0
    most = max(block_words, 2 * window)
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        words = alnum_words(text.encode() if text else None)
        pieces = [words] if len(words) <= most else [words[i : i + most] for i in range(0, len(words) - window + 1, most - window + 1)]
        for piece in pieces:
            if block and size + len(piece) > most:
                yield SuffixAutomaton.build(block, window)
                block, size = [], 0
            block.append((item, piece))
            size += len(piece)
    yield SuffixAutomaton.build(block, window)


def match(auto: SuffixAutomaton, words: list[bytes], covered: np.ndarray, items: set) -> int:
    """Mark covered words and matched items; the longest match length."""
    ids = auto.encode(words)
    longest = 0
    for a, b in auto.stretches(ids):
        for i, (s, n) in enumerate(auto.stream(ids[a:b].tolist()), a + 1):
            longest = max(longest, n)
            if n >= auto.window:
                if held := auto.window_of(s):
                    covered[i - auto.window : i] = True
                    items.update(held)
            for size, key in auto.shorts(s, n):
                covered[i - size : i] = True
                items.add(key)
    items.discard(None)
    return longest


def without(text: bytes, covered: np.ndarray) -> bytes:
    """The text with each covered span of words (and what lies between them) cut out."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for a, b in zip(*runs(covered)):
        out.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, text[done:]])


def _pass(auto, first: bool, cleaned: bool, text_col: str, carried: list[str]):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = binary(batch, text_col)
            before = None if first else batch.column("__hits").to_pylist()
            out = []
            for k, text in enumerate(texts):
                words = alnum_words(text)
                covered, items, longest = np.zeros(len(words), dtype=bool), set(), 0
                if before:
                    items.update(before[k]["items"])
                    longest = before[k]["longest_match"]
                    for x in before[k]["spans"]:
                        covered[x["first"] : x["last"] + 1] = True
                longest = max(longest, match(auto.value, words, covered, items))
                hit = int(covered.sum())
                spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(*runs(covered))] if hit else []
                row = {"n_words": len(words), "n_hit": hit, "longest_match": longest, "items": sorted(items), "spans": spans}
                if cleaned:
                    row["clean_text"] = None if text is None else (without(text, covered) if hit else text).decode("utf-8", "replace")
                out.append(row)
            kind = pa.struct(
                [("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest_match", pa.int64()), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]
                + ([("clean_text", pa.string())] if cleaned else [])
            )
            made = pa.array(out, type=kind)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), made], [*carried, "__hits"])

    return run


def annotate(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text: str = "text", carry: list[str] | None = None, cleaned: bool = False, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` (its columns ``carry``, all if None) with a struct column ``__hits``.

    Narrow: one map per benchmark block, no shuffle; between blocks the rows are written to the shared
    folder and the block's broadcast is dropped, so one automaton is held at a time. ``__hits``: n_words,
    n_hit, longest_match, items, spans (word positions, inclusive), and with ``cleaned`` the text without
    the covered spans. Null or wordless text has no words and no hits; a wordless item has no window, one
    without an id marks words but is not among the items; repeated rows are judged one by one, a very long
    text is streamed whole; columns of any name but ``__hits`` pass.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    carry = docs.columns if carry is None else carry
    out, blocks, first = docs, automata(benchmark, window, block_words), True
    auto = next(blocks)
    while auto is not None:
        after = next(blocks, None)
        last = after is None
        carried = carry if last else list(dict.fromkeys([*carry, text]))
        hits = "struct<n_words:bigint,n_hit:bigint,longest_match:bigint,items:array<bigint>,spans:array<struct<first:bigint,last:bigint>>" + (",clean_text:string>" if cleaned and last else ">")
        shape = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), f"`__hits` {hits}"])
        shared = docs.sparkSession.sparkContext.broadcast(auto)
        out = out.mapInArrow(_pass(shared, first, cleaned and last, text, carried), shape)
        if not last:
            out = materialise(out, "decontaminate-block")
            shared.destroy()
        first, auto = False, after
    return out


def contaminated(hits: str = "__hits", coverage: int = COVERAGE):
    n = F.col(f"{hits}.n_hit")
    return (n > 0) & (coverage * n >= F.col(f"{hits}.n_words"))


def items_digest(col):
    """Hex SHA-256 of the item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.transform(col, lambda x: x.cast("string"))), ","), 256)


def report(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document with its contamination figures, spans and items.

    Handles: null text (no words), empty tables (empty result / no hits), null ids (kept as null),
    extra columns (ignored), very long texts (streamed), repeated rows (one result each), equal items
    (all are named).
    """
    hits = annotate(docs.select("doc_id", "text"), benchmark, window=window, carry=["doc_id"], block_words=block_words)
    return hits.select(
        "doc_id", "__hits.n_words", "__hits.n_hit", F.size("__hits.items").cast("long").alias("n_items"), items_digest(F.col("__hits.items")).alias("items_sha256"),
        contaminated(coverage=coverage).alias("contaminated"), "__hits.longest_match", "__hits.items", "__hits.spans",
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every span of ``window`` matched words or more cut out of the text; cases as in ``annotate``, null text stays null."""
    hits = annotate(docs, benchmark, window=window, cleaned=True, block_words=block_words)
    return hits.withColumn("text", F.col("__hits.clean_text")).drop("__hits")


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without those over the coverage limit; the rest unchanged. Cases as in ``annotate``; a text without words stays."""
    return annotate(docs, benchmark, window=window, block_words=block_words).where(~contaminated(coverage=coverage)).drop("__hits")


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


SQL = """
WITH w AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM win),
hit AS (
  SELECT p.id, p.i, p.n, win.item_id FROM (
    SELECT id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS g
    FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lens WHERE len(ws) >= n)) p
  JOIN win ON win.n = p.n AND win.g = p.g),
cov AS (SELECT id, count(DISTINCT j) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY id),
its AS (SELECT id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS s FROM hit GROUP BY id)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(s), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(s, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN cov ON cov.id = w.id LEFT JOIN its ON its.id = w.id
"""
