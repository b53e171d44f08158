"""Loads of several tables in the order of their dependencies."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.scans import table_counts
from tallyforge.sources.shared import written


class Step(NamedTuple):
    """A table, how it is built from those before it, and whether the load stops if it fails."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    blocking: bool


class LoadResult(NamedTuple):
    name: str
    status: str  # loaded, kept, failed or skipped
    error: str | None


def run_steps(steps: list[Step], kept: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], list[LoadResult]]:
    """The tables that could be loaded, each written to the shared folder, and a result per step.

    A step that fails leaves its table out.  If it is blocking, all later steps are skipped.
    Tables in `kept` are taken as they are.
    """
    tables, results, stopped = {}, [], False
    for step in steps:
        if kept and step.name in kept:
            tables[step.name] = kept[step.name]
            results.append(LoadResult(step.name, "kept", None))
            continue
        if stopped:
            results.append(LoadResult(step.name, "skipped", None))
            continue
        try:
            tables[step.name] = written(step.build(tables), step.name)
            results.append(LoadResult(step.name, "loaded", None))
        except Exception as e:  # any failure of a step is its result
            results.append(LoadResult(step.name, "failed", f"{type(e).__name__}: {e}".splitlines()[0]))
            stopped = step.blocking
    return tables, results


def load_summary(spark: SparkSession, tables: dict[str, DataFrame], results: list[LoadResult]) -> DataFrame:
    """Name, status and rows of every step; rows are null where nothing was loaded."""
    status = spark.createDataFrame([(r.name, r.status) for r in results], "name string, status string")
    return status.join(table_counts(tables), "name", "left") if tables else status.withColumn("rows", F.lit(None).cast("long"))
