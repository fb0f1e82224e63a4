"""Every query with SQL gives the same rows as DuckDB does on the same tables."""

import math
import os

import duckdb
import pytest

from habitra.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf)
    cur = duck.execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in got.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", ["candidate_ngroup", "adaptive_grid_assign", "split_train_test", "segment_ids", "subsample_dedup"])
def test_partitions_do_not_matter(spark, sf, name):
    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(str, catalog.QUERIES[name](spark, sf).collect()))

    try:
        assert rows("3") == rows("13")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
