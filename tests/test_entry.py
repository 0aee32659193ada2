from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare, connect

# Fast queries of every module: the script checks all of them on the larger table.
SAMPLE = [
    "clean_chain",
    "hourly_rollup",
    "describe_percentiles",
    "clip_outliers",
    "contiguous_folds",
    "regression_metrics",
    "drift_summary",
    "psi",
    "what_if_totals",
]


def test_every_oracle_belongs_to_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    # The corpus queries, where they are there, are tested on their own.
    queries = {name for module in entry.MODULES if module.__name__.startswith("catalog.") for name in module.QUERIES}
    assert queries <= set(sql)


def test_oracle_sql_parses(folder):
    con = connect(folder)
    for name, text in entry.oracle_sql().items():
        try:
            con.execute(f"EXPLAIN {text}")
        except duckdb.Error as error:
            pytest.fail(f"{name}: {error}")


def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row["number_of_columns"] == 6


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_oracle(spark, folder, name):
    ours = entry.queries()[name](spark, folder).toPandas()
    theirs = connect(folder).execute(entry.oracle_sql()[name]).df()
    assert compare(ours, theirs).startswith("ok")
