"""Writing the lake: typed partitioned appends, replaced partitions, upserts, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources.schemas import BRONZE


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, cast; missing ones are null, others are dropped."""
    return frame.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in frame.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
    ])


def append_partitioned(frame: DataFrame, path: str, schema: T.StructType, partition: str = "dt") -> None:
    """Append under `path`/`partition`=...; rows of one partition are written by few tasks."""
    conform(frame, schema).repartition(partition).write.mode("append").partitionBy(partition).option("compression", "snappy").parquet(path)


def append_dataset(frame: DataFrame, root: str, name: str, day: Column) -> str:
    """Append to the bronze dataset `name` under `root` with dt = `day`, in its schema (`schemas.BRONZE`); returns its path.

    Fields that the schema lacks are dropped, missing ones and those that don't fit are null.
    """
    schema = T.StructType.fromDDL(BRONZE[name])
    conform(frame, schema).withColumn("dt", day.cast("date")).write.mode("append").partitionBy("dt").option("compression", "snappy").parquet(f"{root}/{name}")
    return f"{root}/{name}"


def replace_partitions(frame: DataFrame, path: str, partition: str = "dt") -> None:
    """Replace only the partitions that occur in `frame`, so a rerun of a day leaves one copy of it."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def latest_by_key(rows: DataFrame, keys: list[str], newest: list[str | Column]) -> DataFrame:
    """Of each key the row that is newest by `newest`, descending; the rest of the columns break ties."""
    rest = [c for c in rows.columns if c not in keys and c not in newest]
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in newest] + [F.col(c).desc_nulls_last() for c in rest]
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """`old` with `new` put over it by key; the row with the greatest `newest` wins."""
    return latest_by_key(old.unionByName(new, allowMissingColumns=True), keys, [newest])


def retained(staging: DataFrame, gold: DataFrame, keys: list[str], at: str, before: Column) -> DataFrame:
    """Staging rows that stay: newer than `before`, or not in gold yet."""
    gone = staging.where(F.col(at) < before).select(*keys).join(gold.select(*keys).distinct(), keys, "left_semi").distinct()
    old = F.col(at) < before
    return staging.where(~old | F.col(at).isNull()).unionByName(staging.where(old).join(gone, keys, "left_anti"))


def export(frame: DataFrame, path: str, partition: str | None = None) -> None:
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def snapshot(tables: dict[str, DataFrame], root: str, label: str) -> tuple[str, DataFrame]:
    """Write all tables under `root`/`label`; that path, and rows, files and bytes of each table as written."""
    from tallyforge.sources.scans import union_by_name

    sizes = []
    for name, frame in tables.items():
        export(frame, f"{root}/{label}/{name}")
        files = frame.sparkSession.read.schema(frame.schema).parquet(f"{root}/{label}/{name}").select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
        per_file = files.groupBy("f").agg(F.count("*").alias("rows"), F.max("b").alias("b"))
        sizes.append(per_file.agg(F.lit(name).alias("name"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("files"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")))
    return f"{root}/{label}", union_by_name(*sizes)


def stamp(metadata: DataFrame, key: str, value: str, now: Column) -> DataFrame:
    """The key-value `metadata` (key, value, updated_at) with one key set."""
    row = metadata.sparkSession.range(1).select(F.lit(key).alias("key"), F.lit(value).alias("value"), now.alias("updated_at"))
    return upsert(metadata, row, ["key"], "updated_at")


def restore(spark: SparkSession, path: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The tables of a snapshot; one that is missing comes back empty."""
    from tallyforge.sources.scans import scan

    return {name: scan(spark, f"{path}/{name}", schema) for name, schema in schemas.items()}
