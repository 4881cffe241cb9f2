"""Keyed tables: what stays, what goes, what a write touches, and what a dead or late one leaves."""

import pytest
from pyspark.sql import functions as F

from tessera.sources import keyed


def rows(t, version=None):
    return sorted((tuple(r) for r in t.read(version).collect()), key=str)


def test_insert_or_replace(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t")
    first = spark.createDataFrame([(i, f"v{i}") for i in range(300)] + [(None, "none")], "id long, v string")
    assert t.version() == 0 and t.replace(first, ["id"]) == 1 and rows(t) == sorted(map(tuple, first.collect()), key=str)
    before = t.manifest()["buckets"]
    assert t.replace(spark.createDataFrame([(7, "new"), (None, "other"), (1000, "more")], "id long, v string"), ["id"]) == 2
    want = {(i, f"v{i}") for i in range(300)} - {(7, "v7")} | {(7, "new"), (None, "other"), (1000, "more")}
    assert rows(t) == sorted(want, key=str) and rows(t, 1) == sorted(map(tuple, first.collect()), key=str)
    after = t.manifest()["buckets"]
    assert 1 <= sum(after.get(b) != before.get(b) for b in after.keys() | before.keys()) <= 3  # the other buckets are not rewritten
    assert t.replace(first.limit(0), ["id"]) == 2
    with pytest.raises(ValueError):
        t.replace(first, ["v"])
    t.replace(spark.createDataFrame([(7, 1.5)], "id long, w double"), ["id"])
    held = {r.id: r for r in t.read().collect()}
    assert held[7].v is None and held[7].w == 1.5 and held[8].w is None and held[8].v == "v8"
    t.vacuum(1)
    assert len(rows(t)) == len(want) and t.version() == 3
    with pytest.raises(Exception, match="manifest"):
        t.read(1)


def test_replace_by_source(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t")
    t.replace(spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "source string, n long"), ["source"])
    t.replace(spark.createDataFrame([("a", 900), ("c", 3)], "source string, n long"), ["source"])
    assert rows(t) == [("a", 900), ("b", 1), ("c", 3)]
    nested = keyed.KeyedTable(spark, f"file://{tmp_path}/n")
    nested.replace(spark.createDataFrame([("a", {"k": 1}, [1, 2])], "source string, m map<string,long>, l array<long>"), ["source"])
    assert nested.read().first().m == {"k": 1}


def test_a_dead_write_and_a_late_one(spark, tmp_path, monkeypatch):
    t = keyed.KeyedTable(spark, f"file://{tmp_path}/t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    t.replace(df, ["id"])

    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(t, "_publish", die)
        with pytest.raises(OSError):
            t.replace(df.withColumn("v", F.lit("x")), ["id"])
    assert t.version() == 1 and rows(t) == [(1, "a"), (2, "b")]
    late = keyed.KeyedTable(spark, f"file://{tmp_path}/t")
    monkeypatch.setattr(late, "version", lambda: 1)
    t.replace(df.withColumn("v", F.lit("y")), ["id"])
    with pytest.raises(keyed.WriteConflict):
        late.replace(df.withColumn("v", F.lit("z")), ["id"])
    assert rows(t) == [(1, "y"), (2, "y")]
