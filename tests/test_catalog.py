"""Every query against its SQL counterpart in another engine, over whole tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from textquarry.plans.catalog import QUERIES
from textquarry.plans.oracle import ORACLE_SQL
from verify import digest

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, str(FOLDER))
    got = [tuple(r) for r in frame.collect()]
    answer = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got
    assert digest(frame.columns, got) == digest(columns, answer.fetchall())


def test_page_fallback_filters_columns_that_are_computed_already(spark):
    plan = QUERIES["s4_page_fallback"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("% 240" in line for line in filters)


@pytest.mark.parametrize("name", ["p13_joints", "p15_page_texts", "p16_documents"])
def test_word_places_are_not_written_out_in_filters(spark, name):
    plan = QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any(" % " in line for line in filters)
