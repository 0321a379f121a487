"""Every query with SQL, next to DuckDB over the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tabfidelity.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}/*.parquet'" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    rel = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    types = dict(zip(rel.columns, map(str, rel.types), strict=True))
    assert {c: TYPES.get(t, types[c]) for c, t in df.dtypes} == types
    at = [rel.columns.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
    assert ours == theirs


def test_every_query_has_rows_or_sql():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE_SQL)
    assert missing <= {"best_distribution", "shapiro_wilk", "pca", "dp_corr", "iman_conover", "synthesised", "three_modes", "fidelity", "four_regimes", "calibrated", "perm_importance", "shift_robustness", "cross_validation", "extended_report"}


def test_entry(spark):
    assert entry.entry(spark).columns == ["column", "kind", "psi", "n_bins", "status"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
