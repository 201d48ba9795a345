"""Every registered query equals its DuckDB statement on the sf0.001 tables."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sample_tables import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    canon = sorted(repr(tuple((r[i] is None, str(_norm(r[i]))) for i in order)) for r in rows)
    return sorted(cols), hashlib.md5("\n".join(canon).encode()).hexdigest(), len(rows)


OWN = sorted({**entry.QUERIES, **entry.PROFILE_QUERIES})


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF0001)
    spark_side = _digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    duck_side = _digest([d[0] for d in res.description], res.fetchall())
    assert spark_side == duck_side


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "worst_rank" in df.columns
