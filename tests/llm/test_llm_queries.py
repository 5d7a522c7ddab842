"""Every query of the subpackage on the smallest test tables, against its SQL where it has one."""

from pathlib import Path

import duckdb
import pytest

from labelmill.llm import queries

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, str(DATA))
    rows = sorted(tuple(str(v) for v in r) for r in df.collect())
    if name in queries.ORACLE:
        con = duckdb.connect()
        for p in DATA.glob("*.parquet"):
            con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        assert rows == sorted(tuple(str(v) for v in r) for r in con.sql(queries.ORACLE[name]).fetchall())
    else:
        assert rows
