"""Every library query with DuckDB text gives the same rows at the smallest scale."""

import datetime
import decimal

import duckdb
import pytest

from panelforge.plans import acceptances, batches, catalog, chains, evidence, features, handoffs, ingestion, loads, observations, payloads, record_handoffs, round_trips, vendors

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
LIBRARY = catalog.Catalog()
for module in (features, ingestion, handoffs, batches, vendors, acceptances, round_trips, observations, loads, evidence, payloads, chains, record_handoffs):
    module.register(LIBRARY)


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else float(f"{float(v):.9g}")
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(LIBRARY.sql))
def test_same_rows(spark, duck, name):
    df = LIBRARY.queries[name](spark, SF)
    answer = duck.execute(LIBRARY.sql[name])
    names = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in answer.fetchall()), key=repr)
    assert got == want
