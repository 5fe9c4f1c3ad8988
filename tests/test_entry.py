"""The driver's contract, and Spark against DuckDB for the engine's own queries."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = db.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    want = sorted(repr([norm(dict(zip(names, r))[c]) for c in order]) for r in cur.fetchall())
    assert sorted(repr([norm(r[c]) for c in order]) for r in df.collect()) == want


def test_least_cohort_does_not_depend_on_the_folder(spark):
    assert all(r["n"] >= 20 for r in QUERIES["worst_cohorts"](spark, "/root/testdata/sf0.001").collect())
