"""Every registered query on the smallest tables, beside its SQL twin."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from check_queries import TABLES, rows_of  # noqa: E402

from lacuna.plans import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.SQL:
        assert got
        return
    cur = con.execute(catalog.SQL[name])
    left, names = rows_of(df.columns, got)
    right, wanted = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert names == wanted
    assert left == right
