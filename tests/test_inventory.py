"""Every registered query of the engine against its SQL."""

import duckdb
import pytest

from tessera import catalog
SF = "/root/testdata/sf0.001"
NAMES = list(catalog.ORACLES)
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = db.execute(catalog.ORACLES[name])
    assert sorted(c[0] for c in want.description) == cols
    got_rows = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
    want_rows = sorted(tuple(map(str, r)) for r in db.execute(f"SELECT {', '.join(cols)} FROM ({catalog.ORACLES[name]})").fetchall())
    assert got_rows and got_rows == want_rows
