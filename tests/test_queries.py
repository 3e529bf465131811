"""Every registered query against its reference SQL, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    return round(float(value), 8) if isinstance(value, float) else value


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = [tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()]
    key = lambda row: tuple((x is None, str(x)) for x in row)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_release_is_not_capped():
    from refpanel.workload import pipelines

    assert not any("max_negative" in f or "max_positive" in f for f in pipelines._RELEASE_FAMILIES)


def test_release_run(spark):
    card = QUERIES["release_scorecard"](spark, DATA)
    assert {r.family for r in card.collect()} == {"en", "de", "fr", "es"}
