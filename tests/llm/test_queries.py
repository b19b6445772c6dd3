"""The registered queries over whole small tables."""

from pathlib import Path

import duckdb
import pytest

from textquarry.llm.queries import QUERIES
from textquarry.llm.sql import ORACLE_SQL
from verify import digest

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, str(FOLDER))
    got = [tuple(r) for r in frame.collect()]
    assert got
    if name in ORACLE_SQL:
        db = duckdb.connect()
        for file in FOLDER.glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        answer = db.execute(ORACLE_SQL[name])
        columns = [c[0] for c in answer.description]
        assert digest(frame.columns, got) == digest(columns, answer.fetchall())
    elif name not in ("op5_decontamination", "op7_token_counts", "op12_hard_negatives", "op13_lexical_search"):
        assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
