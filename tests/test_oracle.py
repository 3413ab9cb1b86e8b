"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

from conftest import SF_SMALL

TRAINING_DATA = {n for n in E.queries() if n == "pipeline" or re.match(r"op\d+_", n)}  # tested in their own folder
SKIP = {"train_models"}  # MLlib training: rows-only, covered by test_models


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SKIP - TRAINING_DATA))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_oracle_or_is_listed():
    assert set(E.queries()) - set(E.oracle_sql()) - TRAINING_DATA == SKIP


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id" and "churn_value" in df.columns
