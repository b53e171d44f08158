"""Other lakes in the session's catalog, by qualified names and for reading only."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def attach(spark: SparkSession, name: str, tables: dict[str, str]) -> None:
    """The parquet datasets `tables` (table name to path) as `name`.<table> in SQL, beside whatever the session has.

    They are views, so nothing can be written to them; attaching again under the same name
    replaces them.  Columns and predicates of a query reach the scans.
    """
    for part in (name, *tables):
        if not re.fullmatch(r"\w+", part):
            raise ValueError(f"not a plain name: {part!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    for table, path in tables.items():
        quoted = path.replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {name}.{table} AS SELECT * FROM parquet.`{quoted}`")


def detach(spark: SparkSession, name: str) -> None:
    """Forget `name`; the data stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
