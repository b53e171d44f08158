"""Structured Streaming jobs: append, keyed upsert, hourly facts, de-duplication, consensus, switches, windows.

Each job reads a directory as a stream, runs until it has taken in all that is there
(`availableNow`), and keeps its progress in a checkpoint: a later run takes in new files only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import money_sum, volume_tier
from tallyforge.sources.sinks import latest_by_key
from tallyforge.streaming.tables import KeyedTable


def source(spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.parquet", files: int = 1000) -> DataFrame:
    """The parquet files of `directory` as a stream, `files` to a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(directory)


def _finish(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def append(stream: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> None:
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    _finish(w.partitionBy(partition) if partition else w)


def upsert_stream(
    stream: DataFrame, table: KeyedTable, checkpoint: str, combine: Callable[[DataFrame, DataFrame], DataFrame], mode: str = "append", keep: int = 2,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Every micro-batch, after `prepare`, is combined with the table as it stood before that batch; its number is the table's version.

    The query's log takes note of a batch after its version is committed.  A run that is cut off
    in between, or earlier, does the same version again, from the same version before it; so
    no row counts twice or is lost.  All but `keep` versions are given up.
    """

    def step(batch: DataFrame, n: int) -> None:
        table.merge(prepare(batch), n, combine)
        table.vacuum(max(keep, 2))

    _finish(stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(step))


def newest_by(keys: list[str], order: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda old, new: latest_by_key(old.unionByName(new), keys, order)


def first_of_hour(old: DataFrame, new: DataFrame) -> DataFrame:
    """Hourly facts: the earliest point of each token and hour."""
    both = old.unionByName(new)
    return both.groupBy("token_id", "hour").agg(F.min("first").alias("first"))


def hourly(rows: DataFrame) -> DataFrame:
    """The earliest point of each token and hour of one micro-batch; `first_of_hour` carries it on, so no row is too late."""
    return rows.groupBy("token_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.min(F.struct("ts", "event_id", "price")).alias("first"))


def dedupe(keys: list[str], order: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of each key the first row by `order`, whatever batch it comes in; the other columns break ties."""

    def first(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new)
        rest = [c for c in both.columns if c not in keys and c not in order]
        # Nulls of `order` come last.
        ranked = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))], *rest)
        # Texts make this a sort aggregate: dealt first, rows are sorted once and not before and after the shuffle.
        return both.repartition(*keys).groupBy(*keys).agg(F.min(ranked).alias("first")).select(*keys, *[f"first.{c}" for c in (*order, *rest)])

    return first


def vote_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy("tag_id", "market_id").agg(F.count_if("vote").alias("yes"), F.count_if(~F.col("vote")).alias("no"))


def sliding_volume(rows: DataFrame, amount: Column, length: str = "1 day", step: str = "6 hours") -> DataFrame:
    return rows.groupBy(F.window("ts", length, step)).agg(money_sum(amount).alias("volume"), F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), "volume", "n"
    )


def sessions(rows: DataFrame, key: str, gap: str = "2 hours") -> DataFrame:
    return rows.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def session_stream(stream: DataFrame, key: str, out: str, checkpoint: str, gap: str = "2 hours", delay: str = "1 hour") -> list[dict]:
    """Append the sessions of each `key` that are over to `out`; returns the progress of the batches.

    Rows of one key no more than `gap` apart are one session.  A session is over, and leaves the
    state, once the watermark - the latest `ts` of all earlier batches less `delay` - reaches
    its end (the last row's `ts` and `gap`).  Rows whose own session would end by then are too
    late and left out; `late_rows` collects them.
    """
    windows = sessions(stream.withWatermark("ts", delay), key, gap)
    q = windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]


MARK = T.StructType([T.StructField("batch", T.LongType()), T.StructField("latest", T.TimestampType())])


def late_rows(stream: DataFrame, out: str, marks: KeyedTable, checkpoint: str, gap: str = "2 hours", delay: str = "1 hour") -> None:
    """Write the rows that `session_stream` leaves out of the same batches to `out`, one folder a batch.

    The latest `ts` of each batch is kept in `marks` (MARK, by batch).  A batch that is done
    again writes the same folder from the same marks.
    """

    def step(batch: DataFrame, n: int) -> None:
        seen = marks.read(below=n).agg(F.max("latest").alias("latest"))
        # Watermarks count in whole milliseconds.
        mark = F.date_trunc("MILLISECOND", F.col("latest")) - F.expr(f"INTERVAL {delay}")
        late = batch.join(F.broadcast(seen), F.col("ts") + F.expr(f"INTERVAL {gap}") <= mark).drop("latest")
        late.write.mode("overwrite").parquet(f"{out}/batch={n}")
        marks.merge(batch.agg(F.lit(n).cast("long").alias("batch"), F.max("ts").alias("latest")), n, lambda old, new: old.unionByName(new))

    _finish(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step))


SWITCH = T.StructType([T.StructField("market_id", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("minute", T.BooleanType())])


def adaptive_switch(stream: DataFrame, limit: float = 5.0) -> DataFrame:
    """Per market (market_id, volume, price), whether it is fetched by the minute.

    Markets of the middle tier are, for good, once the range of all prices so far has reached
    `limit` per cent of the lowest; the others never are.
    """

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        lo, hi, n, hit = state.get if state.exists else (float("inf"), float("-inf"), 0, False)
        mid = False
        for f in frames:
            lo, hi, n = min(lo, float(f.price.min())), max(hi, float(f.price.max())), n + len(f)
            mid = mid or bool((f.tier == "mid").any())
        hit = hit or (mid and lo > 0 and (hi - lo) / lo * 100 >= limit)
        state.update((lo, hi, n, hit))
        yield pd.DataFrame({"market_id": [key[0]], "rows": [n], "minute": [hit]})

    rows = stream.select("market_id", "price", volume_tier("volume").alias("tier"))
    return rows.groupBy("market_id").applyInPandasWithState(step, SWITCH, "lo double, hi double, n long, hit boolean", "update", "NoTimeout")


