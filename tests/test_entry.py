import os

import duckdb
import pytest

import __spark_entry__ as E
from clickpath.plans.catalog import BATCH_QUERIES
from clickpath.plans.catalog import queries as library_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _norm(v):
    return "∅" if v is None else repr(round(v, 9)) if isinstance(v, float) else str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "nation", "region", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]
    assert 0 < df.count() <= 10


def test_every_query_has_an_oracle():
    assert set(library_queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_batch_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    want = _digest([c[0] for c in cur.description], cur.fetchall())
    assert _digest(sdf.columns, [tuple(r) for r in sdf.collect()]) == want
