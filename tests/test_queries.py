"""Every query of the core against its SQL on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from millrace import plans

ROOT = "/root/testdata/sf0.001"
QUERIES, SQL = plans.load()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in os.listdir(ROOT):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{ROOT}/{f}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in SQL:
        result = duck.execute(SQL[name])
        names = [d[0] for d in result.description]
        want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
        assert sorted(names) == columns and got == want


def test_entry_lists_all():
    known, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(QUERIES) <= set(known) and set(sql) <= set(known)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["snapshot_id", "snapshot_recipe_id", "change_kind"]
