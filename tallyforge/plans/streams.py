"""Streaming queries: each runs its job over the table's files and returns what it left."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import parse_vote
from tallyforge.registry import exact_sum, query
from tallyforge.sources.shared import new_dir
from tallyforge.streaming import jobs as j
from tallyforge.streaming.tables import KeyedTable


def events(v, files=1000):
    """The events table as a stream of prices, with UTC timestamps."""
    path = f"{v.sf_dir}/events.parquet"
    schema = v.events.schema
    # A single file is read from its directory; a directory of parts is read whole.
    single = path_is_file(v.spark, path)
    raw = j.source(v.spark, v.sf_dir, schema, "events.parquet", files) if single else j.source(v.spark, path, schema, files=files)
    return raw.select(F.col("user_id").alias("token_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 500).alias("price"), "event_id")


def path_is_file(spark, path) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def ntz(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@query("stream_bronze_append", "SELECT token_id, ts, price, event_id, CAST(ts AS DATE) AS dt FROM prices")
def stream_bronze_append(v):
    out, check = new_dir(v.spark, "stream"), new_dir(v.spark, "progress")
    s = events(v).withColumn("dt", F.col("ts").cast("date"))
    j.append(s, out, check, "dt")
    return ntz(v.spark.read.schema(s.schema).parquet(out))


@query("stream_resume", "SELECT token_id, ts, price, event_id FROM prices")
def stream_resume(v):
    """Two runs over a growing directory; the second takes in the new files only."""
    landing, out, check = (new_dir(v.spark, n) for n in ("landing", "stream", "progress"))
    for rest in (0, 1):
        v.prices.where(f"event_id % 2 = {rest}").write.mode("append").parquet(landing)
        j.append(j.source(v.spark, landing, v.prices.schema), out, check)
    return v.spark.read.schema(v.prices.schema).parquet(out)


@query("stream_upsert", "SELECT token_id, ts, price, event_id FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY ts DESC, event_id DESC) AS r FROM prices) x WHERE r = 1")
def stream_upsert(v):
    s = events(v, files=2)
    table = KeyedTable(v.spark, new_dir(v.spark, "upsert"), s.schema, ["token_id"], buckets=8)
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), j.newest_by(["token_id"], ["ts", "event_id"]))
    return ntz(table.read())


@query("stream_chain", "SELECT token_id, ts, price, event_id FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY ts DESC, event_id DESC) AS r FROM prices) x WHERE r = 1")
def stream_chain(v):
    """Appended to staging by one job, and put from there into the keyed table by the next, each with progress of its own."""
    s = events(v)
    staging, table = new_dir(v.spark, "staging"), KeyedTable(v.spark, new_dir(v.spark, "silver"), s.schema, ["token_id"], buckets=8)
    j.append(s, staging, new_dir(v.spark, "progress"))
    j.upsert_stream(j.source(v.spark, staging, s.schema), table, new_dir(v.spark, "progress"), j.newest_by(["token_id"], ["ts", "event_id"]))
    return ntz(table.read())


@query("stream_hourly_prices", "SELECT token_id, date_trunc('hour', ts)::TIMESTAMP AS hour, arg_min(price, (ts, event_id)) AS price FROM prices GROUP BY 1, 2")
def stream_hourly_prices(v):
    s = events(v)
    table = KeyedTable(v.spark, new_dir(v.spark, "hourly"), j.hourly(s).schema, ["token_id", "hour"], buckets=8)
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), j.first_of_hour, prepare=j.hourly)
    return ntz(table.read().select("token_id", "hour", F.col("first.price").alias("price")))


@query("stream_dedupe", "SELECT token_id, ts, price, event_id FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY ts, event_id, price) AS r FROM prices) x WHERE r = 1")
def stream_dedupe(v):
    s = events(v)
    table = KeyedTable(v.spark, new_dir(v.spark, "dedupe"), s.schema, ["token_id"], buckets=8)
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), j.dedupe(["token_id"], ["ts", "event_id"]))
    return ntz(table.read())


@query(
    "stream_dedupe_trades",
    """SELECT wallet, token_id, ts, side, price, size, CAST(ts AS DATE) AS day FROM (
 SELECT *, row_number() OVER (PARTITION BY wallet, token_id, ts, side ORDER BY price, size) AS r FROM trades) x WHERE r = 1""",
)
def stream_dedupe_trades(v):
    """Trades of two periods, then a third of both again: one row of each wallet, token, second and side stays, however late the repeat.

    The table is cut by day, so a batch rewrites the days that it has rows of and no others.
    """
    landing, check = new_dir(v.spark, "landing"), new_dir(v.spark, "progress")
    rows = v.trades.select("wallet", "token_id", "ts", "side", "price", "size", F.col("ts").cast("date").alias("day"), "taker_id")
    schema = rows.drop("taker_id").schema
    table = KeyedTable(v.spark, new_dir(v.spark, "fills"), schema, ["day"], buckets=16)
    for part in ("ts < TIMESTAMP '1995-06-01'", "ts >= TIMESTAMP '1995-06-01'", "taker_id % 3 = 0"):
        rows.where(part).drop("taker_id").write.mode("append").parquet(landing)
        j.upsert_stream(j.source(v.spark, landing, schema), table, check, j.dedupe(["day", "wallet", "token_id", "ts", "side"], ["price", "size"]))
    return table.read()


@query("stream_consensus", "SELECT tag_id, market_id, count(CASE WHEN v THEN 1 END) AS yes, count(CASE WHEN NOT v THEN 1 END) AS no FROM (SELECT tag_id, market_id, CASE WHEN upper(trim(response)) LIKE '%YES%' THEN TRUE WHEN upper(trim(response)) LIKE '%NO%' THEN FALSE END AS v FROM judge_responses) x GROUP BY 1, 2")
def stream_consensus(v):
    landing = new_dir(v.spark, "votes")
    votes = v.judge_responses.select("tag_id", "market_id", parse_vote("response").alias("vote"))
    votes.write.parquet(landing)
    s = j.vote_counts(j.source(v.spark, landing, votes.schema))
    table = KeyedTable(v.spark, new_dir(v.spark, "consensus"), s.schema, ["tag_id", "market_id"], buckets=8)
    latest = lambda old, new: new.unionByName(old.join(new, ["tag_id", "market_id"], "left_anti"))
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), latest, mode="update")
    return table.read()


@query(
    "stream_adaptive_resolution",
    """SELECT token_id AS market_id, count(*) AS rows, token_id * 2000 BETWEEN 10000 AND 100000 AND min(price) > 0 AND coalesce((max(price) - min(price)) / nullif(min(price), 0) * 100 >= 5, FALSE) AS minute
 FROM prices GROUP BY token_id""",
)
def stream_adaptive_resolution(v):
    s = j.adaptive_switch(events(v).select(F.col("token_id").alias("market_id"), (F.col("token_id") * 2000).alias("volume"), "price"))
    table = KeyedTable(v.spark, new_dir(v.spark, "switch"), s.schema, ["market_id"], buckets=8)
    latest = lambda old, new: new.unionByName(old.join(new, "market_id", "left_anti"))
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), latest, mode="update")
    return table.read()


@query(
    "sliding_volume",
    f"""SELECT start, {exact_sum("price")} AS volume, count(*) AS n FROM (
 SELECT price, time_bucket(INTERVAL '6' HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL '6' HOUR AS start FROM prices, (SELECT unnest([0, 1, 2, 3]) AS k) z) x GROUP BY start""",
)
def sliding_volume(v):
    s = j.sliding_volume(events(v), F.col("price"))
    table = KeyedTable(v.spark, new_dir(v.spark, "sliding"), s.schema, ["start"], buckets=8)
    j.upsert_stream(s, table, new_dir(v.spark, "progress"), lambda old, new: new, mode="complete")
    return ntz(table.read())


@query(
    "trader_sessions",
    """WITH o AS (SELECT token_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL '2' HOUR THEN 1 ELSE 0 END AS opens FROM prices WINDOW w AS (PARTITION BY token_id ORDER BY ts)),
 n AS (SELECT *, sum(opens) OVER (PARTITION BY token_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS s FROM o)
 SELECT token_id, min(ts) AS start, max(ts) + INTERVAL '2' HOUR AS "end", count(*) AS n FROM n GROUP BY token_id, s""",
)
def trader_sessions(v):
    return ntz(j.sessions(v.prices.withColumn("ts", F.col("ts").cast("timestamp")), "token_id"))


# Three batches of prices by the hour of their arrival; every seventh row of the first half month arrives with the last.
BATCH = "CASE WHEN ts < TIMESTAMP '2024-01-16' AND event_id % 7 = 0 THEN 2 WHEN ts < TIMESTAMP '2024-01-16' THEN 0 WHEN ts < TIMESTAMP '2024-01-24' THEN 1 ELSE 2 END"
SPAN, WAIT = "INTERVAL '2' HOUR", "INTERVAL '1' HOUR"


def _session_sql(result: str) -> str:
    """Three batches in SQL: what is late by the watermark of the batches before, and the sessions that each watermark closes."""
    parts = [f"p AS (SELECT token_id, ts, event_id, price, {BATCH} AS batch FROM prices)", "open_0 AS (SELECT token_id, ts AS start, ts AS \"end\", 0 AS n FROM p WHERE FALSE)"]
    for k in range(3):
        before = f"(SELECT date_trunc('millisecond', max(ts)) - {WAIT} FROM p WHERE batch < {k})"
        after = f"(SELECT date_trunc('millisecond', max(ts)) - {WAIT} FROM p WHERE batch <= {k})"
        parts += [
            f"late_{k} AS (SELECT token_id, ts, price, event_id FROM p WHERE batch = {k} AND ts + {SPAN} <= {before})",
            f"""rows_{k} AS (SELECT token_id, ts AS start, ts + {SPAN} AS "end", 1 AS n FROM p WHERE batch = {k} AND event_id NOT IN (SELECT event_id FROM late_{k}) UNION ALL SELECT * FROM open_{k})""",
            f"""edge_{k} AS (SELECT *, max("end") OVER (PARTITION BY token_id ORDER BY start, "end", n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, row_number() OVER (PARTITION BY token_id ORDER BY start, "end", n) AS r FROM rows_{k})""",
            f"num_{k} AS (SELECT *, sum(CASE WHEN reach IS NULL OR start >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY token_id ORDER BY r) AS s FROM edge_{k})",
            f"""all_{k} AS (SELECT token_id, min(start) AS start, max("end") AS "end", sum(n)::BIGINT AS n FROM num_{k} GROUP BY token_id, s)""",
            f"""over_{k} AS (SELECT * FROM all_{k} WHERE "end" <= {after})""",
            f"""open_{k + 1} AS (SELECT * FROM all_{k} WHERE "end" > {after})""",
        ]
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(f"SELECT * FROM {result}_{k}" for k in range(3))


def _sessions(v):
    """(sessions that ended, late rows) of the three batches; both jobs read each batch as one, as it arrives alone."""
    landing, out, late, mark, *checks = (new_dir(v.spark, n) for n in ("landing", "sessions", "late", "marks", "progress", "progress"))
    rows = v.prices.withColumns({"ts": F.col("ts").cast("timestamp"), "batch": F.expr(BATCH.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))})
    schema = rows.drop("batch").schema
    marks = KeyedTable(v.spark, mark, j.MARK, ["batch"], buckets=8)
    for k in range(3):
        rows.where(F.col("batch") == k).drop("batch").write.mode("append").parquet(landing)
        stream = lambda: j.source(v.spark, landing, schema, files=1 << 30)
        j.session_stream(stream(), "token_id", out, checks[0])
        j.late_rows(stream(), late, marks, checks[1])
    ended = v.spark.read.schema("token_id long, start timestamp, end timestamp, n long").parquet(out)
    return ended, v.spark.read.schema(schema).parquet(f"{late}/batch=*")


@query("stream_sessions", _session_sql("over"))
def stream_sessions(v):
    return ntz(_sessions(v)[0])


@query("stream_late_rows", _session_sql("late"))
def stream_late_rows(v):
    return ntz(_sessions(v)[1])
