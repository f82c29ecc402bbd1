"""Every registered query against its DuckDB oracle on the smallest driver
scale (the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

from widegrain.plans import registry

registry.load_all()
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(registry.ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = _rows(cur.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    assert df.count() >= 1
