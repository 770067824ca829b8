import duckdb
import pytest

from colophon.plans import catalogue as C

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    return con


@pytest.mark.parametrize("name", C.ORACLE)
def test_against_sql(spark, con, name):
    want = con.sql(C.ORACLE[name])
    got = C.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    found = sorted(str(tuple(r[c] for c in want.columns)) for r in got.collect())
    assert found == sorted(map(str, want.fetchall())) and found
