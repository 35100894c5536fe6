"""The queries run over the test tables and hold what they promise."""

import pytest

from graincraft.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    assert df.count() > 0
    if name in ORACLE_SQL:
        import duckdb

        con = duckdb.connect()
        for t in ("documents", "conversation", "corpus", "dialogue_line"):
            con.execute(f"CREATE VIEW {t} AS FROM '{data_dir}/{t}.parquet'")
        want = con.execute(ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr) and sorted(names) == sorted(df.columns)


COLUMNS = {
    "p1_found": ["row_id"], "p2_found": ["tbl", "id_a", "id_b"], "p3_found": ["row_id", "defect"], "p4_found": ["tbl", "first_id", "copy_id"],
    "p5_found": ["row_id", "kind"], "p7_found": ["row_id", "lang"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, data_dir, name):
    assert QUERIES[name](spark, data_dir).columns == COLUMNS[name]
