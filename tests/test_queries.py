"""All core queries against their SQL on the smallest tables."""

import math
import os
from collections import Counter
from decimal import Decimal

import pytest

from leafmill import plans

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.all_queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = plans.all_queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    result = duck.execute(plans.all_sql()[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == cols
    assert got == Counter(tuple(plain(r[named.index(c)]) for c in cols) for r in result.fetchall())


def test_entry_point():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {"p3_found", "k_summary"} <= set(e.queries())


def test_compacted_pieces_are_the_bodies(spark, duck):
    pieces = {}
    for r in plans.all_queries()["p3_compacted"](spark, DATA).where("piece_no is not null").collect():
        pieces.setdefault(r["page_id"], {})[r["piece_no"]] = r["payload"]
    bodies = dict(duck.execute("SELECT page_id, body FROM wrap_oss_page").fetchall())
    assert pieces and all("".join(p for _, p in sorted(own.items())) == bodies[i] for i, own in pieces.items())
