"""Every query with SQL gives the rows of its SQL, to the last digit."""

import duckdb
import pytest

from siltwave.plans import registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "embeddings", "part", "orders", "lineitem", "customer", "supplier", "nation"):
        con.execute(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, name):
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall()), key=str)
    df = registry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=str)
    assert got == want and want
