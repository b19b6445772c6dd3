"""The chunk table in a database with vectors, through Spark's JDBC source.

Rows are written in parallel to a staging table; one transaction then replaces the
documents, so readers see the old or the new version and a failure leaves the old one.
Needs a JDBC driver on the cluster and a DB-API module on the driver.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.providers import VECTOR_DIMENSION
from ..functions.vectors import format_vector, parse_vector
from .chunk_table import TableError, checked, integrity, mismatches, to_vector_rows
from .staging import written_once

_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")


def settings(config: str | None, env: Mapping[str, str] = os.environ) -> tuple[str, str, int]:
    """Address, table and dimension: environment first, then a JSON file."""
    stored = json.loads(Path(config).read_text(encoding="utf-8")) if config and Path(config).exists() else {}
    address = env.get("POSTGRES_DSN") or stored.get("dsn")
    table = env.get("POSTGRES_TABLE") or stored.get("table")
    dimension = env.get("POSTGRES_VECTOR_DIMENSION") or stored.get("vector_dimension") or VECTOR_DIMENSION
    if not address or not table:
        raise TableError("database address or table not configured")
    try:
        return address, table, int(dimension)
    except (TypeError, ValueError) as exc:
        raise TableError("vector dimension must be an integer") from exc


def swap_in(connection, table: str, staging: str) -> None:  # noqa: ANN001 - any DB-API connection
    """Replace the staged documents in `table`, all or nothing."""
    try:
        with connection.cursor() as cursor:
            cursor.execute(f"DELETE FROM {table} WHERE document_id IN (SELECT document_id FROM {staging})")
            cursor.execute(
                f"INSERT INTO {table} (chunk_id, document_id, content, embedding, metadata) "
                f"SELECT chunk_id, document_id, content, embedding::vector, metadata::jsonb FROM {staging}"
            )
            cursor.execute(f"DROP TABLE {staging}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


@dataclass
class DatabaseTable:
    spark: SparkSession
    url: str
    table: str
    connect: Callable[[], object]
    dimension: int = VECTOR_DIMENSION
    parts: int = 32

    def __post_init__(self) -> None:
        if not _NAME.fullmatch(self.table):
            raise TableError(f"not a table name: {self.table}")

    def upsert(self, embedded: DataFrame) -> DataFrame:
        incoming = checked(written_once(to_vector_rows(embedded), "incoming"), self.dimension)
        staging = f"{self.table}_incoming_{uuid.uuid4().hex[:12]}"
        rows = incoming.drop("last_modified").withColumn("embedding", format_vector(F.col("embedding")))
        rows.write.jdbc(self.url, staging, mode="overwrite")
        swap_in(self.connect(), self.table, staging)
        return incoming

    def read(self) -> DataFrame:
        """Rows in `parts` parallel queries, split by a hash of the chunk id."""
        source = (
            "(SELECT chunk_id, document_id, content, embedding::text AS embedding, "
            f"metadata::text AS metadata, mod(abs(hashtext(chunk_id)::bigint), {self.parts}) AS part FROM {self.table}) t"
        )
        rows = self.spark.read.jdbc(self.url, source, predicates=[f"part = {i}" for i in range(self.parts)])
        return rows.drop("part").withColumn("embedding", parse_vector(F.col("embedding")).cast("array<float>"))

    def sanity_check(self, incoming: DataFrame) -> None:
        stored = self.read().join(incoming.select("document_id").distinct(), "document_id", "left_semi")
        mismatches(incoming, integrity(stored, self.dimension, "document_id"))
