"""The queries of the subpackage on the smallest tables."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")

from leafmill.llm import queries as Q  # noqa: E402


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_runs(spark, name):
    df = Q.QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    if name in Q.SQL:
        import duckdb

        con = duckdb.connect()
        for f in os.listdir(DATA):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
        assert sorted(rows) == sorted(con.execute(Q.SQL[name]).fetchall())


def test_p5_found_cuts_the_whole_table(spark, monkeypatch):
    given = []
    real = Q.pieces.pieces
    monkeypatch.setattr(Q.pieces, "pieces", lambda df, *a: given.append(df.count()) or real(df, *a))
    Q.p5_found(spark, DATA)
    assert given == [Q.table(spark, DATA, "wrap_oss_page").count()]
