"""Bronze: landed payloads to typed rows, and the choice of what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import json_strings, parse_datetime, volume_tier
from tallyforge.operators.selection import upper_median
from tallyforge.sources.shared import dealt, join_dealt

TOKEN = "array<struct<token_id:string,outcome:string,price:double,winner:boolean>>"
EVENT = (
    "array<struct<id:string,ticker:string,slug:string,title:string,description:string,category:string,subcategory:string,liquidity:double,"
    "volume:double,active:boolean,closed:boolean>>"
)
CATEGORY = "array<struct<id:string,label:string,parentCategory:string,slug:string>>"
MARKET = (
    "struct<id:string,condition_id:string,question:string,slug:string,category:string,description:string,closed:boolean,active:boolean,volume:string,"
    "volumeNum:string,liquidityNum:string,marketGroup:string,end_date_iso:string,game_start_time:string,outcomes:string,outcomePrices:string,"
    f"clobTokenIds:string,tokens:{TOKEN},events:{EVENT},categories:{CATEGORY}>"
)
POINT = "struct<t:long,timestamp:long,ts:long,p:double,price:double>"


def parse_markets(payloads: DataFrame, json_col: str = "raw_json") -> DataFrame:
    """Market payloads parsed once; a payload that is no JSON object gives nulls."""
    return payloads.select("*", F.from_json(json_col, MARKET).alias("m"))


def explode_tokens(parsed: DataFrame, skip_closed: bool = False) -> DataFrame:
    """One row per token with an id; price and winner default to 0 and false, the question is cut at 200 characters."""
    rows = parsed.where(~F.coalesce("m.closed", F.lit(False))) if skip_closed else parsed
    t = rows.select(F.col("m.condition_id"), F.left("m.question", F.lit(200)).alias("question"), F.coalesce("m.closed", F.lit(False)).alias("closed"), F.explode("m.tokens").alias("t"))
    return t.where("t.token_id is not null and t.token_id <> ''").select(
        "condition_id", "t.token_id", F.coalesce("t.outcome", F.lit("")).alias("outcome"), F.coalesce("t.price", F.lit(0.0)).alias("price"),
        F.coalesce("t.winner", F.lit(False)).alias("winner"), "question", "closed",
    )


def time_bounds(parsed: DataFrame) -> DataFrame:
    """When a market was active: from game start, else 30 days before the end date; if closed, to a day after game start, else the end date."""
    game, end = parse_datetime("m.game_start_time"), parse_datetime("m.end_date_iso")
    stop = F.coalesce(game + F.expr("INTERVAL '24' HOUR"), end)
    return parsed.select(
        F.col("m.condition_id"), F.coalesce(game, end - F.expr("INTERVAL '30' DAY")).alias("start_ts"), F.when(F.coalesce("m.closed", F.lit(False)), stop).alias("end_ts")
    )


def market_record(parsed: DataFrame) -> DataFrame:
    """Flat market records with '' , false and 0 for what is missing."""
    text = lambda c: F.coalesce(f"m.{c}", F.lit("")).alias(c)
    return parsed.select(
        text("id"), text("condition_id"), text("question"), text("slug"), text("category"), text("outcomes"), text("outcomePrices"), text("clobTokenIds"),
        F.coalesce("m.active", F.lit(False)).alias("active"), F.coalesce("m.closed", F.lit(False)).alias("closed"),
        F.coalesce(F.col("m.volumeNum").try_cast("double"), F.lit(0.0)).alias("volume_num"),
        F.coalesce(F.col("m.liquidityNum").try_cast("double"), F.lit(0.0)).alias("liquidity_num"),
        F.coalesce(F.col("m.marketGroup").try_cast("long"), F.lit(0)).alias("market_group"),
    )


def events(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.col("m.id").alias("market_id"), F.explode("m.events").alias("e")).select("market_id", F.col("e.id").alias("event_id"), "e.ticker", "e.slug", "e.title", "e.category", "e.volume", "e.active", "e.closed")


def categories(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.col("m.id").alias("market_id"), F.explode("m.categories").alias("c")).select("market_id", F.col("c.id").alias("category_id"), "c.label", F.col("c.parentCategory").alias("parent_category"), "c.slug")


def fanout_counts(parsed: DataFrame) -> DataFrame:
    """Markets, events and categories in the payloads, counted in one pass."""
    n = lambda c: F.coalesce(F.sum(F.greatest(F.size(c), F.lit(0))), F.lit(0)).cast("long")
    return parsed.agg(F.count("m.id").alias("markets"), n("m.events").alias("events"), n("m.categories").alias("categories"))


def price_points(payloads: DataFrame, key: str = "token_id", json_col: str = "raw_json") -> DataFrame:
    """(token_id, timestamp, price) of every shape of price history.

    The payload is an array of points or an object that holds one as history, prices or
    sample_prices; a point is an object (t, timestamp or ts; p or price) or [time, price].
    A value that is 0 or missing gives way to the next name, and at last to 0.
    """
    body = F.coalesce(*[F.get_json_object(json_col, f"$.{n}") for n in ("history", "prices", "sample_prices")], F.col(json_col))
    rows = payloads.select(key, F.explode(F.from_json(body, "array<string>")).alias("x"))
    o, pair = F.from_json("x", POINT), F.from_json("x", "array<double>")
    first = lambda *names: F.coalesce(*[F.nullif(o[n], F.lit(0)) for n in names])
    is_pair = F.col("x").startswith("[")
    return rows.select(
        key,
        F.coalesce(F.when(is_pair, F.get(pair, F.lit(0)).cast("long")).otherwise(first("t", "timestamp", "ts")), F.lit(0)).alias("timestamp"),
        F.coalesce(F.when(is_pair, F.get(pair, F.lit(1))).otherwise(first("p", "price")), F.lit(0.0)).alias("price"),
    )


def dedupe_pages(rows: DataFrame, position: list[str]) -> DataFrame:
    """The first row of each condition id (condition_id, else conditionId) by page position."""
    key = F.coalesce(F.nullif("condition_id", F.lit("")), "conditionId")
    w = Window.partitionBy("key").orderBy(*position)
    return rows.withColumn("key", key).where("key is not null").withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def clean_token_ids(x: str) -> Column:
    """Token ids from a JSON array or a bare list in a string: bad characters go, then ids below 3 characters."""
    parts = F.coalesce(json_strings(x), F.when(~F.col(x).startswith("{"), F.split(F.regexp_replace(x, r"[\[\]\"' ]", ""), ",")), F.array().cast("array<string>"))
    return F.filter(F.transform(parts, lambda t: F.regexp_replace(t, r"[^A-Za-z0-9\-,_]", "")), lambda t: F.length(t) >= 3)


def coverage_gaps(present: DataFrame, categories: DataFrame, periods: list[str]) -> DataFrame:
    """Pairs of a category of `categories` and one of the fixed `periods` that `present` lacks."""
    wanted = categories.select("category").distinct().select("category", F.explode(F.array(*map(F.lit, periods))).alias("time_period"))
    return wanted.join(present.select("category", "time_period").distinct(), ["category", "time_period"], "left_anti")


def wrap_raw(rows: DataFrame, key: str, fetched_at: Column) -> DataFrame:
    """(key, raw_json, fetched_at): each row as one JSON document."""
    return rows.select(F.col(key), F.to_json(F.struct(*rows.columns)).alias("raw_json"), fetched_at.alias("fetched_at"))


def median_floor(trades: DataFrame) -> DataFrame:
    """Trades above the upper median size of their market."""
    floor = upper_median(trades, ["market_id"], F.col("size")).select("market_id", F.col("nth").alias("floor"))
    return trades.join(floor, "market_id").where("size > floor")


def growing_floor(trades: DataFrame, n: int = 0) -> DataFrame:
    """Trades (market_id, page from 0, size) above the floor of their page, with that `floor`.

    The third page of a market and every second one after it raise the floor of all later
    pages by the whole part of their upper median size.  `n` tasks number and join pages, if
    it is not 0: they are so narrow that their bytes tell little of their number.
    """
    raises = (F.col("page") >= 2) & (F.col("page") % 2 == 0)
    medians = upper_median(trades.where(raises), ["market_id", "page"], F.col("size"))
    all_pages = dealt(n, trades.select("market_id", "page"), "market_id", "page").distinct()
    per_page = all_pages.join(dealt(n, medians, "market_id", "page"), ["market_id", "page"], "left").select("market_id", "page", F.coalesce(F.floor("nth"), F.lit(0)).cast("double").alias("up"))
    earlier = Window.partitionBy("market_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    floors = dealt(n, per_page, "market_id").select("market_id", "page", F.coalesce(F.sum("up").over(earlier), F.lit(0.0)).alias("floor"))
    return join_dealt(n, trades, floors, ["market_id", "page"]).where("floor = 0 or size > floor")


def adaptive_resolution(chunks: DataFrame, volume: Column, limit: float = 5.0) -> DataFrame:
    """Whether each time chunk is fetched by the minute: mid-tier markets do so for good once the
    range of all earlier chunks reaches `limit` per cent of the minimum.

    `chunks` has market_id, chunk, lo, hi.
    """
    w = Window.partitionBy("market_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    c = chunks.withColumn("tier", volume_tier(volume)).withColumns({"run_lo": F.min("lo").over(w), "run_hi": F.max("hi").over(w)})
    delta = F.coalesce((F.col("run_hi") - F.col("run_lo")) / F.nullif("run_lo", F.lit(0.0)) * 100, F.lit(0.0))
    c = c.withColumn("hit", (F.col("tier") == "mid") & (delta >= limit))
    before = Window.partitionBy("market_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return c.withColumn("minute", F.coalesce(F.bool_or("hit").over(before), F.lit(False))).select("market_id", "chunk", "tier", "minute")


def chunk_calendar(spans: DataFrame, hours: int) -> DataFrame:
    """[start_ts, end_ts) of each row in steps of `hours`, the last one clipped."""
    step = f"INTERVAL '{hours}' HOUR"
    starts = spans.where("start_ts < end_ts").withColumn("chunk_start", F.explode(F.expr(f"sequence(start_ts, end_ts, {step})"))).where("chunk_start < end_ts")
    return starts.withColumn("chunk_end", F.least(F.expr(f"chunk_start + {step}"), "end_ts"))


def earliest_price(prices: DataFrame) -> DataFrame:
    return prices.groupBy("token_id").agg(
        F.min("ts").alias("first_ts"), F.min_by("price", F.struct("ts", "event_id")).alias("first_price"), F.date_trunc("month", F.min("ts")).cast("date").alias("month")
    )


def active_markets(markets: DataFrame, since: Column, fallback: int = 500) -> DataFrame:
    """Active markets that had not ended at `since`; if there is none, the newest `fallback` by start."""
    hits = markets.where(F.col("active") & (F.col("end_ts").isNull() | (F.col("end_ts") >= since)))
    none = hits.agg(F.count("*").alias("n"))
    newest = markets.orderBy(F.desc("start_ts"), "market_id").limit(fallback).join(F.broadcast(none.where("n = 0")), how="left_semi", on=F.lit(True))
    return hits.unionByName(newest)


def inactive_markets(markets: DataFrame, n: int = 100) -> DataFrame:
    return markets.where(~F.col("active") & (F.col("volume") != 0)).orderBy(F.desc("end_ts"), "market_id").limit(n)


def not_in(rows: DataFrame, keys: list[str], *known: DataFrame) -> DataFrame:
    """`rows` whose keys none of the `known` frames holds, each key once."""
    out = rows
    for k in known:
        out = out.join(k.select(*keys), keys, "left_anti")
    return out.dropDuplicates(keys)
