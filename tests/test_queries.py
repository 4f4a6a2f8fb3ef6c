"""Every query against its SQL, and against itself where there is none."""

import math

import duckdb
import pytest

from facetforge.plans import load

QUERIES, ORACLES = load()
SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(x):
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, (int, float)):
        x = float(x)
        return str(x) if math.isnan(x) else f"{x:.9g}"
    return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    data = [tuple(r) for r in frame.collect()]
    assert data, "no rows"
    if name in ORACLES:
        got = duck.execute(ORACLES[name])
        want = rows([d[0] for d in got.description], got.fetchall())
        found = rows(frame.columns, data)
        assert found[0] == want[0]
        assert len(found[1]) == len(want[1])
        assert [x for x in zip(found[1], want[1]) if x[0] != x[1]][:3] == []
