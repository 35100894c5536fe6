"""Every query that has SQL gives the same rows as the SQL."""

import math
from pathlib import Path

import duckdb
import pytest

from graincraft.plans.queries import ORACLE_SQL, QUERIES


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con(data_dir):
    con = duckdb.connect()
    for p in Path(data_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data_dir, con, name):
    df = QUERIES[name](spark, data_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert got
        return
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def test_entry(spark, data_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
