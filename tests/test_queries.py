"""Every registered query with an oracle against DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from siftwell.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf}/{n}.parquet')")
    return c


def rows_of(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    tidy = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(tidy(r[i]) for i in at) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows_as_duckdb(name, spark, sf, duck):
    df = registry.QUERIES[name](spark, sf)
    got = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(got.fetchall(), columns)


@pytest.mark.parametrize("name", ["text_score", "optical_score", "human_units", "scale_functions", "frame_quantile_score", "motion_score", "frame_rates"])
def test_scores_and_formats_on_more_rows(name, spark):
    """Ties of rounding are rare, so these run on ten times the rows."""
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{d}/{n}.parquet')")
    df, got = registry.QUERIES[name](spark, d), c.execute(registry.ORACLE[name])
    columns = [x[0] for x in got.description]
    exact = lambda rows, names: sorted((tuple(r[names.index(n)] for n in sorted(names)) for r in rows), key=str)
    assert exact([tuple(r) for r in df.collect()], df.columns) == exact(got.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs_alike_twice(name, spark, sf):
    a = registry.QUERIES[name](spark, sf).collect()
    assert a and sorted(map(str, a)) == sorted(map(str, registry.QUERIES[name](spark, sf).collect()))


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "select_pass", "select_reject_reason"] and df.count() > 0
