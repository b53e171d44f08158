"""Shared-folder tables, bitmaps of bounded size and connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows of a bitmap_construct_agg bitmap: 32768 bits, 4096 bytes.
BITMAP_BITS = 32768


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, else (tests) a local one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"/tmp/checkpoints/{sc.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one call writes to the shared folder, by name; `drop` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.written = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.tables: dict[str, list[str]] = {}

    def _place(self, name: str) -> str:
        self.written += 1
        path = f"{self.path}/{name}-{self.written}"
        self.tables.setdefault(name, []).append(path)
        return path

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """`df`, written once and read back."""
        path = self._place(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_signed(self, df: DataFrame, name: str, *columns: str) -> tuple[DataFrame, tuple]:
        """`save`, and (number of rows, XOR of their hashes over `columns`) taken while writing."""
        seen = Observation()
        hashed = F.bit_xor(F.xxhash64(*columns)) if columns else F.lit(0).cast("long")
        out = self.save(df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(hashed, F.lit(0)).alias("x")), name)
        return out, (seen.get["n"], seen.get["x"])

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.tables.pop(name, []):
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def let(value, body):
    """`body(value)` with `value` evaluated once a row.

    The optimizer would copy the expression to each use, also into the per-element functions
    of arrays, where it would be evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: The most bits of a filter that is broadcast: 32 MB.
MOST_BITS = 1 << 28


def bitmap_bits(rows: int, per_row: int = 16) -> int:
    """A power of two of at least `per_row` bits a row.  Callers hold it against their bound before a broadcast."""
    bits = BITMAP_BITS
    while bits < per_row * rows:
        bits *= 2
    return bits


def bitmap_table(positions: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): at most `bits / 32768` rows of 4 KB for positions 0 .. bits-1."""
    pos = F.col(column)
    return positions.groupBy((pos / F.lit(BITMAP_BITS)).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg((pos % F.lit(BITMAP_BITS)).cast("long")).alias("bits")
    )


def bit_is_set(bits, position):
    """Whether the bit `position % 32768` of a 4096-byte bitmap is set (null bitmap: false)."""
    at = (position % F.lit(BITMAP_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, (at / F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, at % F.lit(8)) == 1, F.lit(False))


def marked_rows(rows: DataFrame, key: str, wanted: DataFrame, n_wanted: int, most_bits: int = MOST_BITS) -> DataFrame:
    """The `rows` whose long `key` is among the `n_wanted` of `wanted`, and perhaps a few others.

    Up to `most_bits` / 8 bytes a bitmap is broadcast and no row shuffles; beyond, it is a join.
    """
    bits = bitmap_bits(n_wanted, per_row=32)
    if bits > most_bits:
        return rows.join(wanted.select(F.col(key)).distinct(), key, "left_semi")
    spot = F.pmod(F.col(key), F.lit(bits))
    table = bitmap_table(wanted.select(spot.alias("p")).distinct(), "p").withColumnsRenamed({"bucket": "__bucket", "bits": "__bits"})
    hit = rows.withColumn("__p", spot).join(F.broadcast(table), (F.col("__p") / F.lit(BITMAP_BITS)).cast("int") == F.col("__bucket"))
    return hit.where(bit_is_set(F.col("__bits"), F.col("__p"))).drop("__p", "__bucket", "__bits")


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame, n_wanted: int, most_bits: int = MOST_BITS) -> DataFrame:
    """`rows` and whether (__maybe) their long `key` may be among the `n_wanted` ones of `wanted`.

    Up to `most_bits` / 8 bytes a bitmap is broadcast and no row shuffles; beyond, it is a join.
    """
    bits = bitmap_bits(n_wanted)
    keys = wanted.select(F.col(key).alias("__found")).distinct()
    if bits > most_bits:
        return rows.join(keys, F.col(key) == F.col("__found"), "left").withColumn("__maybe", F.col("__found").isNotNull()).drop("__found")
    spot = lambda c: F.pmod(F.col(c), F.lit(bits))
    table = F.broadcast(bitmap_table(keys.select(spot("__found").alias("p")).distinct(), "p").withColumnsRenamed({"bucket": "__bucket", "bits": "__bits"}))
    hit = rows.withColumn("__p", spot(key)).join(table, (F.col("__p") / F.lit(BITMAP_BITS)).cast("int") == F.col("__bucket"), "left")
    return hit.withColumn("__maybe", bit_is_set(F.col("__bits"), F.col("__p"))).drop("__p", "__bucket", "__bits")


def bitmap_array(positions: DataFrame, column: str, bits: int) -> np.ndarray:
    """The bitmap as bytes on the driver, for tasks that test membership: `bits / 8` bytes, which callers bound."""
    out = np.zeros(bits // 8, np.uint8)
    for bucket, chunk in bitmap_table(positions, column).collect():
        at = bucket * BITMAP_BITS // 8
        out[at : at + BITMAP_BITS // 8] = np.frombuffer(bytes(chunk), np.uint8)
    return out


def components(scratch: Scratch, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (a long, b long) as (id, component = smallest id reached).

    Alternating large-star and small-star steps; the number of edges never grows, hubs are
    only ever minimised over (map-side combine) or joined to, and every round is written out.
    Ids without an edge are not returned.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if large:
            # Written first, so that the join has two plain exchanges and a hub's rows can be split.
            low = scratch.save(low, "low")
        out = both.join(low, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    # a > b throughout, so the smaller neighbours of an id are those of its edges as `a`.
    now, before = scratch.save_signed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", "a", "b"
    )
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        now, after = scratch.save_signed(star(star(now, True), False).distinct(), "edges", "a", "b")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def refine(scratch: Scratch, found: DataFrame, edges: DataFrame) -> DataFrame:
    """Components (id, component) after more `edges`: only what joins different components is searched again."""
    label = lambda side: found.select(F.col("id").alias(side), F.col("component").alias(f"{side}_c"))
    between = (
        edges.select("a", "b").join(label("a"), "a", "left").join(label("b"), "b", "left")
        .select("a", "b", F.coalesce("a_c", "a").alias("x"), F.coalesce("b_c", "b").alias("y"))
    )
    joined = components(scratch, between.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    joined = scratch.save(joined.select(F.col("id").alias("component"), F.col("component").alias("into")), "joined")
    old = found.join(joined, "component", "left").select("id", F.coalesce("into", "component").alias("component"))
    # Ids that had no edge so far stand for themselves in `joined`.
    new = joined.join(found.select(F.col("id").alias("component")), "component", "left_anti")
    return old.unionByName(new.select(F.col("component").alias("id"), F.col("into").alias("component")))
