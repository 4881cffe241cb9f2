"""The pipeline against brute-force versions of its decisions."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontaminate, queries
from tessera.llm.queries import table
from tests.llm.test_operators import brute_fingerprint, words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = {}
    for x in filter(None, items):
        n = min(13, len(x))
        grams.setdefault(n, set()).update(tuple(x[j : j + n]) for j in range(len(x) - n + 1))
    fp = {i: brute_fingerprint(t) for i, t in rows.items()}
    root = dict.fromkeys(rows)
    for i in sorted(rows):
        if root[i] is None:
            todo = [i]
            while todo:
                a = todo.pop()
                root[a] = i
                todo += [b for b in rows if root[b] is None and b not in todo and (fp[a] ^ fp[b]).bit_count() <= 4]
    kept = set()
    for i in {r for r in root.values()}:
        w, hit = words(rows[i]), set()
        for n, known in grams.items():
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in known:
                    hit.update(range(j, j + n))
        if not hit or decontaminate.COVERAGE * len(hit) < len(w):
            kept.add(i)
    at = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        at = stage(spark, at, SF)
        assert at.columns == docs.columns
    assert {r.doc_id for r in at.select("doc_id").collect()} == kept
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= kept and all(rows[r.doc_id] == r.text for r in out)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
    want = sorted(tuple(map(str, r)) for r in db.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall())
    assert got and got == want


def test_stages_on_odd_tables(spark):
    """Each stage, and all: empty tables, null cells, repeated rows, very long texts, columns of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, base int, n string, root long, fp long, size long"
    rows = [(1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1, 1, "n", 2, 3, 4)] * 2 + [(None, None, None, None, None, None, None, None, None, None), (2, "", "en", None, 0, 1, "", 0, 0, 0), (3, "mot " * 20_000, "fr", "b", 9, 9, "x", 1, 1, 1), (4, "x" * 2_000_000, None, "b", 9, 9, "x", 1, 1, 1)]
    odd, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, SF)
            assert out.columns[: len(docs.columns)] == docs.columns
            out.write.format("noop").mode("overwrite").save()
        assert stage(spark, none, SF).count() == 0
    at = odd
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    assert at.where(F.col("text").isNull()).count() == 0 and at.where("doc_id = 1").count() >= 1
