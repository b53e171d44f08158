"""Reading the lake: partitioned scans, schema union, inventories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` holds anything, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """A parquet file or Hive-partitioned directory; a missing path with a schema gives no rows.

    Columns and predicates reach the scan, and predicates on partition columns prune directories.
    """
    if schema is not None and not exists(spark, path):
        out = spark.createDataFrame([], schema)
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        out = reader.option("mergeSchema", "true").parquet(path) if schema is None else reader.parquet(path)
    if where is not None:
        out = out.where(where)
    return out.select(*columns) if columns else out


def scan_query(spark: SparkSession, path: str, sql: str, schema: T.StructType | None = None) -> DataFrame:
    """`sql` over the dataset at `path`, which it names `{data}`."""
    return spark.sql(sql, data=scan(spark, path, schema))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_keys(frame: DataFrame, key: str) -> DataFrame:
    return frame.select(key).where(F.col(key).isNotNull()).distinct()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table: one aggregate each, in one job."""
    return union_by_name(*[t.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, t in tables.items()])


def layer_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and first and last value of a time column of each table."""
    return union_by_name(*[
        t.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.min(at).alias("first"), F.max(at).alias("last")) for name, (t, at) in tables.items()
    ])


def partition_inventory(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows, files and newest partition of each dataset; no data column is read."""
    out = []
    for name, d in datasets.items():
        files = d.select("dt", F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.max("dt").alias("dt"))
        out.append(files.agg(F.lit(name).alias("name"), F.sum("n").alias("rows"), F.count("*").alias("files"), F.max("dt").alias("latest")))
    return union_by_name(*out)


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, type, rows and nulls of every column, in one pass over each table."""
    out = []
    for name, t in tables.items():
        counts = t.agg(F.count("*").alias("rows"), *[F.count(F.when(F.col(f.name).isNull(), 1)).alias(f"n{i}") for i, f in enumerate(t.schema.fields)])
        columns = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"n{i}").alias("nulls"))
            for i, f in enumerate(t.schema.fields)
        ])
        out.append(counts.select(F.lit(name).alias("table_name"), "rows", F.inline(columns)))
    return union_by_name(*out)
