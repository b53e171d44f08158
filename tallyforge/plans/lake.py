"""Bronze, silver, gold, source and sink queries over documents derived from the views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.columns import parse_datetime, safe_float, volume_tier
from tallyforge.operators import bronze as b
from tallyforge.operators import gold as g
from tallyforge.operators import intervals
from tallyforge.operators import silver as s
from tallyforge.operators.load import Step, load_summary, run_steps
from tallyforge.registry import query
from tallyforge.sources import scans, sinks
from tallyforge.sources.schemas import BRONZE
from tallyforge.sources.shared import dealt, new_dir, slices, spread, written

NOW = "TIMESTAMP '2024-02-01 00:00:00'"


def now():
    return F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")


def payloads(v):
    """Market payloads as JSON documents: every fourth market without tokens, some with events."""
    m, i = spread(v.markets), F.col("market_id")
    token = lambda k, o: F.struct(
        F.when(i % 10 == 9, F.lit("")).otherwise(F.concat(F.lit("0x"), (i * 2 + k).cast("string"))).alias("token_id"), F.lit(o).alias("outcome"),
        F.when(i % 3 != 0, F.lit(0.25)).alias("price"), F.when(F.col("closed"), F.lit(k == 0)).alias("winner"),
    )
    doc = F.struct(
        i.cast("string").alias("id"), "condition_id", "question", F.concat(F.lit("slug-"), i.cast("string")).alias("slug"), "closed", "active", "category",
        F.col("volume").cast("string").alias("volumeNum"), F.when(i % 2 == 0, (i % 7).cast("string")).alias("marketGroup"),
        F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("end_date_iso"), F.when(i % 5 == 0, F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss")).alias("game_start_time"),
        "outcomes", F.col("outcome_prices").alias("outcomePrices"), F.concat(F.lit('["'), i.cast("string"), F.lit('-yes","'), i.cast("string"), F.lit('-no"]')).alias("clobTokenIds"),
        F.when(i % 4 != 3, F.array(token(0, "Yes"), token(1, "No"))).alias("tokens"),
        F.when(i % 2 == 0, F.array(F.struct((i * 10).cast("string").alias("id"), F.lit("T").alias("ticker"), F.lit("s").alias("slug"), F.col("question").alias("title"), F.col("volume").alias("volume"), F.lit(True).alias("active"), F.lit(False).alias("closed")))).alias("events"),
        F.array(F.struct((i % 6).cast("string").alias("id"), F.col("category").alias("label"), F.lit("root").alias("parentCategory"), F.lower("category").alias("slug"))).alias("categories"),
        F.struct(F.concat(F.lit("event-"), (i % 40).cast("string")).alias("slug"), F.when(i % 3 != 0, F.col("category")).alias("category")).alias("event"),
        F.when(i % 4 != 1, F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("startDate"), F.date_format("end_ts", "yyyy-MM-dd").alias("endDate"),
    )
    return m.select("condition_id", "market_id", F.to_json(doc).alias("raw_json"), now().alias("fetched_at"))


def parsed(v):
    return b.parse_markets(payloads(v))


TOK = """SELECT condition_id, '0x' || (market_id * 2 + k) AS token_id, o AS outcome, CASE WHEN market_id % 3 <> 0 THEN 0.25::DOUBLE ELSE 0::DOUBLE END AS price, closed AND k = 0 AS winner, left(question, 200) AS question, closed
 FROM markets, (SELECT 0 AS k, 'Yes' AS o UNION ALL SELECT 1, 'No') z WHERE market_id % 10 <> 9 AND market_id % 4 <> 3"""
query("explode_tokens", TOK)(lambda v: b.explode_tokens(parsed(v)))
query("explode_tokens_open", TOK + " AND NOT closed")(lambda v: b.explode_tokens(parsed(v), skip_closed=True))
query(
    "market_time_bounds",
    """SELECT condition_id, CASE WHEN market_id % 5 = 0 THEN start_ts ELSE end_ts - INTERVAL '30' DAY END AS start_ts,
 CASE WHEN closed THEN CASE WHEN market_id % 5 = 0 THEN start_ts + INTERVAL '24' HOUR ELSE end_ts END END AS end_ts FROM markets""",
)(lambda v: b.time_bounds(parsed(v)))
query(
    "gamma_market_record",
    """SELECT CAST(market_id AS VARCHAR) AS id, condition_id, question, 'slug-' || market_id AS slug, category, outcomes, outcome_prices AS outcomePrices, '["' || market_id || '-yes","' || market_id || '-no"]' AS clobTokenIds,
 active, closed, volume AS volume_num, 0::DOUBLE AS liquidity_num, CASE WHEN market_id % 2 = 0 THEN market_id % 7 ELSE 0 END AS market_group FROM markets""",
)(lambda v: b.market_record(parsed(v)))
query(
    "gamma_events",
    """SELECT CAST(market_id AS VARCHAR) AS market_id, CAST(market_id * 10 AS VARCHAR) AS event_id, 'T' AS ticker, 's' AS slug, question AS title, NULL AS category, volume, TRUE AS active, FALSE AS closed
 FROM markets WHERE market_id % 2 = 0""",
)(lambda v: b.events(parsed(v)))
query(
    "gamma_categories",
    """SELECT CAST(market_id AS VARCHAR) AS market_id, CAST(market_id % 6 AS VARCHAR) AS category_id, category AS label, 'root' AS parent_category, lower(category) AS slug
 FROM markets""",
)(lambda v: b.categories(parsed(v)))
query(
    "gamma_fanout_counts",
    "SELECT count(*) AS markets, count(CASE WHEN market_id % 2 = 0 THEN 1 END) AS events, count(*) AS categories FROM markets",
)(lambda v: b.fanout_counts(parsed(v)))


def histories(v):
    """A price history per token, in one of four payload shapes."""
    secs = F.unix_timestamp(F.col("ts").cast("timestamp"))
    rows = v.prices.groupBy("token_id").agg(F.collect_list(F.struct(secs.alias("t"), F.col("price").alias("p"))).alias("x"))
    objects, pairs = F.to_json("x"), F.to_json(F.transform("x", lambda p: F.array(p["t"].cast("double"), p["p"])))
    renamed = F.to_json(F.transform("x", lambda p: F.struct(p["t"].alias("timestamp"), p["p"].alias("price"))))
    k = F.col("token_id") % 4
    raw = F.when(k == 0, F.concat(F.lit('{"history":'), objects, F.lit("}"))).when(k == 1, F.concat(F.lit('{"prices":'), renamed, F.lit("}"))).when(k == 2, pairs).otherwise(renamed)
    return rows.select("token_id", raw.alias("raw_json"))


query("normalize_prices", "SELECT token_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, price FROM prices")(lambda v: b.price_points(histories(v)))
query(
    "dedupe_pages",
    "SELECT condition_id AS key, min(market_id * 2) AS pos FROM markets GROUP BY condition_id",
)(
    lambda v: b.dedupe_pages(
        v.markets.selectExpr("CASE WHEN market_id % 2 = 0 THEN condition_id ELSE '' END AS condition_id", "condition_id AS conditionId", "explode(array(market_id * 2, market_id * 2 + 1)) AS pos"), ["pos"]
    ).select("key", "pos")
)
query(
    "clean_token_ids",
    """SELECT market_id, list_filter(CASE market_id % 3 WHEN 0 THEN ['tok' || market_id, 'n' || market_id] WHEN 1 THEN ['a' || market_id] ELSE [] END, lambda x: length(x) >= 3) AS ids FROM markets""",
)(
    lambda v: v.markets.select("market_id", raw_ids(F.col("market_id")).alias("raw")).select("market_id", b.clean_token_ids("raw").alias("ids"))
)


def raw_ids(i):
    """A JSON array, a bare list or a broken document in a string; some ids are too short."""
    text = i.cast("string")
    array = F.concat(F.lit('["tok'), text, F.lit('!","n'), text, F.lit('","x"]'))
    return F.when(i % 3 == 0, array).when(i % 3 == 1, F.concat(F.lit("[a"), text, F.lit(",'y']"))).otherwise(F.lit('{"bad":'))


query(
    "leaderboard_coverage",
    """SELECT category, time_period FROM (SELECT DISTINCT category
 FROM markets) c, (SELECT unnest(['DAY', 'WEEK', 'MONTH', 'ALL']) AS time_period) p WHERE NOT (category = 'PROMO' AND time_period = 'DAY')""",
)(lambda v: _coverage(v))


def _coverage(v):
    present = v.markets.where("category = 'PROMO'").select("category", F.lit("DAY").alias("time_period"))
    return b.coverage_gaps(present, v.markets.select("category"), ["DAY", "WEEK", "MONTH", "ALL"])


query(
    "wrap_raw_trades",
    "SELECT wallet, side, price, size, count(*) AS n FROM trades GROUP BY ALL",
)(
    lambda v: b.wrap_raw(v.trades.select("wallet", "side", "price", "size"), "wallet", now())
    .select("wallet", F.from_json("raw_json", "side string, price double, size double").alias("j")).groupBy("wallet", "j.side", "j.price", "j.size").agg(F.count("*").alias("n"))
)
query(
    "median_size_floor",
    """WITH f AS (SELECT market_id, list_sort(list(size))[(count(*) // 2 + 1)::BIGINT] AS floor FROM trades GROUP BY market_id)
 SELECT t.market_id, f.floor, count(*) AS trades FROM trades t JOIN f ON t.market_id = f.market_id WHERE size > floor GROUP BY 1, 2""",
)(lambda v: b.median_floor(v.trades).groupBy("market_id", "floor").agg(F.count("*").alias("trades")))
PAGED = "SELECT *, (row_number() OVER (PARTITION BY market_id ORDER BY ts, wallet, price, size, taker_id, side, token_id) - 1) // 5 AS page FROM trades"
query(
    "growing_size_floor",
    f"""WITH p AS ({PAGED}), m AS (SELECT market_id, page, CASE WHEN page >= 2 AND page % 2 = 0 THEN floor(list_sort(list(size))[(count(*) // 2 + 1)::BIGINT]) ELSE 0 END AS up FROM p GROUP BY market_id, page),
 f AS (SELECT market_id, page, coalesce(sum(up) OVER (PARTITION BY market_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS floor FROM m)
 SELECT p.market_id, p.page::INTEGER AS page, f.floor, count(*) AS trades FROM p JOIN f ON p.market_id = f.market_id AND p.page = f.page WHERE f.floor = 0 OR size > f.floor GROUP BY ALL""",
)(lambda v: b.growing_floor(pages(v), slices(v.trades)).groupBy("market_id", "page", "floor").agg(F.count("*").alias("trades")))


def pages(v):
    """The trades' (market_id, size, page) in pages of five a market; numbered and written once, as the floors read them several times."""
    order = Window.partitionBy("market_id").orderBy("ts", "wallet", "price", "size", "taker_id", "side", "token_id")
    placed = dealt(slices(v.trades), v.trades, "market_id")
    return written(placed.select("market_id", "size", F.floor((F.row_number().over(order) - 1) / 5).cast("int").alias("page")), "pages")


query(
    "volume_tier",
    "SELECT market_id, CASE WHEN volume * 50 < 10000 THEN 'low' WHEN volume * 50 > 100000 THEN 'high' ELSE 'mid' END AS tier FROM markets",
)(lambda v: v.markets.select("market_id", volume_tier(F.col("volume") * 50).alias("tier")))
CHUNK = "SELECT token_id AS market_id, date_trunc('day', ts)::TIMESTAMP AS chunk, min(price) AS lo, max(price) AS hi FROM prices GROUP BY 1, 2"


def chunks(v):
    return v.prices.groupBy(F.col("token_id").alias("market_id"), F.date_trunc("day", "ts").alias("chunk")).agg(F.min("price").alias("lo"), F.max("price").alias("hi"))


query(
    "adaptive_resolution",
    f"""WITH c AS ({CHUNK}), r AS (SELECT *, CASE WHEN market_id * 2000 < 10000 THEN 'low' WHEN market_id * 2000 > 100000 THEN 'high' ELSE 'mid' END AS tier, min(lo) OVER w AS a, max(hi) OVER w AS z FROM c WINDOW w AS (PARTITION BY market_id ORDER BY chunk ROWS UNBOUNDED PRECEDING)),
 h AS (SELECT *, tier = 'mid' AND coalesce((z - a) / nullif(a, 0) * 100, 0) >= 5 AS hit FROM r)
 SELECT market_id, chunk, tier, coalesce(bool_or(hit) OVER (PARTITION BY market_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS minute FROM h""",
)(lambda v: b.adaptive_resolution(chunks(v), F.col("market_id") * 2000))
query(
    "chunk_calendar",
    """SELECT market_id, chunk_start, least(chunk_start + INTERVAL '240' HOUR, end_ts) AS chunk_end
 FROM (SELECT market_id, end_ts, unnest(generate_series(start_ts, end_ts, INTERVAL '240' HOUR)) AS chunk_start FROM markets) x
 WHERE chunk_start < end_ts""",
)(lambda v: b.chunk_calendar(v.markets, 240).select("market_id", "chunk_start", "chunk_end"))
query(
    "earliest_price",
    """SELECT token_id, min(ts) AS first_ts, arg_min(price, (ts, event_id)) AS first_price, CAST(date_trunc('month', min(ts)) AS DATE) AS month
 FROM prices GROUP BY token_id""",
)(lambda v: b.earliest_price(v.prices))
query(
    "active_markets",
    "SELECT market_id, end_ts FROM markets WHERE active AND end_ts >= TIMESTAMP '1997-01-20'",
)(lambda v: b.active_markets(v.markets, F.expr("TIMESTAMP_NTZ '1997-01-20 00:00:00'")).select("market_id", "end_ts"))
query(
    "inactive_markets",
    "SELECT market_id, end_ts FROM markets WHERE NOT active AND volume <> 0 ORDER BY end_ts DESC, market_id LIMIT 100",
)(lambda v: b.inactive_markets(v.markets).select("market_id", "end_ts"))
query(
    "token_prefix_lookup",
    "SELECT wallet, name FROM traders WHERE starts_with(wallet, 'w12')",
)(lambda v: v.traders.where(F.col("wallet").startswith("w12")).select("wallet", "name"))
query(
    "top_volume_markets",
    "SELECT market_id, round(volume * 1000) AS v FROM markets ORDER BY v DESC, market_id LIMIT 20",
)(
    lambda v: v.markets.select("market_id", F.format_number(F.col("volume") * 1000, 0).alias("text")).select("market_id", F.regexp_replace("text", ",", "").try_cast("double").alias("v")).orderBy(F.desc("v"), "market_id").limit(20)
)

# What is still to be fetched.
query("new_markets", "SELECT condition_id FROM markets WHERE market_id % 3 <> 0 AND market_id % 5 <> 0")(
    lambda v: b.not_in(v.markets.select("condition_id"), ["condition_id"], v.markets.where("market_id % 3 = 0"), v.markets.where("market_id % 5 = 0"))
)
query(
    "markets_without_prices",
    "SELECT market_id FROM markets WHERE market_id NOT IN (SELECT token_id FROM prices)",
)(lambda v: b.not_in(v.markets.select("market_id"), ["market_id"], v.prices.select(F.col("token_id").alias("market_id"))))
query(
    "new_trades",
    """SELECT DISTINCT market_id, ts FROM trades t WHERE NOT EXISTS (SELECT 1 FROM trades o
 WHERE o.market_id = t.market_id AND o.ts = t.ts AND o.side = 'SELL')""",
)(lambda v: b.not_in(v.trades.select("market_id", "ts"), ["market_id", "ts"], v.trades.where("side = 'SELL'")))
# Staged price documents of even events span a run of two days' prices and six hours on; gold has the hours of odd events.
SPANS = """spans AS (SELECT token_id, min(ts) AS start_ts, max(ts) + INTERVAL '6' HOUR AS end_ts FROM prices WHERE event_id % 2 = 0
 GROUP BY token_id, CAST(floor(epoch(ts) / 172800) AS BIGINT)), hours AS (SELECT token_id, date_trunc('hour', ts)::TIMESTAMP AS ts FROM prices WHERE event_id % 2 = 1)"""
FREE = """NOT EXISTS (SELECT 1 FROM spans s WHERE s.token_id = w.token_id AND s.start_ts <= w.end_ts AND s.end_ts >= w.start_ts)
 AND NOT EXISTS (SELECT 1 FROM hours h WHERE h.token_id = w.token_id AND h.ts BETWEEN w.start_ts AND w.end_ts)"""


def spans(v):
    runs = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 172800)
    return v.prices.where("event_id % 2 = 0").groupBy("token_id", runs.alias("run")).agg(
        F.min("ts").alias("start_ts"), (F.max("ts") + F.expr("INTERVAL '6' HOUR")).alias("end_ts")
    ).drop("run")


def gold_hours(v):
    return v.prices.where("event_id % 2 = 1").select("token_id", F.date_trunc("hour", "ts").alias("ts"))


def wanted(v, days):
    """Every token with prices for each of `days` days from the 8th of January 2024, to the last second of the day."""
    day = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("d")
    start = F.expr("TIMESTAMP_NTZ '2024-01-08 00:00:00' + make_dt_interval(d)")
    days_of = v.prices.select("token_id").distinct().select("token_id", day)
    return days_of.select("token_id", start.alias("start_ts"), (start + F.expr("INTERVAL '1' DAY - INTERVAL '1' SECOND")).alias("end_ts"))


WANTED = """wanted AS (SELECT token_id, TIMESTAMP '2024-01-08 00:00:00' + d * INTERVAL '1' DAY AS start_ts, TIMESTAMP '2024-01-08 23:59:59' + d * INTERVAL '1' DAY AS end_ts
 FROM (SELECT DISTINCT token_id FROM prices) t, (SELECT unnest(range({n})) AS d) r)"""
query("tokens_missing_day", f"WITH {SPANS}, {WANTED.format(n=1)} SELECT token_id FROM wanted w WHERE {FREE}")(
    lambda v: intervals.uncovered(wanted(v, 1), spans(v), gold_hours(v)).select("token_id")
)
query("token_days_missing", f"WITH {SPANS}, {WANTED.format(n=21)} SELECT * FROM wanted w WHERE {FREE}")(
    lambda v: intervals.uncovered(wanted(v, 21), spans(v), gold_hours(v))
)
query(
    "span_overlaps",
    f"WITH {SPANS} SELECT a.token_id, a.start_ts, a.end_ts, b.start_ts AS other_start, b.end_ts AS other_end FROM spans a JOIN spans b ON a.token_id = b.token_id AND a.start_ts <= b.end_ts AND a.end_ts >= b.start_ts",
)(
    lambda v: intervals.overlapping(
        spans(v), spans(v).withColumnsRenamed({"start_ts": "other_start", "end_ts": "other_end"}), ["token_id"], ("start_ts", "end_ts"), ("other_start", "other_end"), cell_seconds=43_200
    )
)

# Silver.
A = "SELECT condition_id, question, description, end_ts, volume, active, closed, CASE WHEN market_id % 2 = 0 THEN category ELSE '' END AS category, CASE WHEN market_id % 7 <> 0 THEN start_ts END AS start_ts FROM markets WHERE market_id % 5 <> 0"
B = "SELECT condition_id, upper(question) AS question, description, end_ts, volume + 1 AS volume, active, closed, category, start_ts FROM markets WHERE market_id % 4 <> 0"


def src(v, sql):
    return v.spark.sql(sql.replace("FROM markets", "FROM {markets}"), markets=v.markets)


def versions(v):
    return v.markets.selectExpr("condition_id", "question", "volume", "explode(sequence(0, cast(market_id % 3 as int))) AS dt", "concat('f', market_id) AS file").withColumn("volume", F.col("volume") + F.col("dt"))


LATEST = "SELECT condition_id, question, volume + market_id % 3 AS volume, CAST(market_id % 3 AS INT) AS dt, 'f' || market_id AS file FROM markets"
query("latest_clob", LATEST)(lambda v: s.latest_market(versions(v), "condition_id"))
query(
    "latest_gamma",
    LATEST.replace("condition_id,", 'condition_id AS "conditionId",'),
)(lambda v: s.latest_market(versions(v).withColumnRenamed("condition_id", "conditionId"), "conditionId"))
MERGED = f"""a AS ({A}), b AS ({B}), merged AS (SELECT coalesce(a.condition_id, b.condition_id) AS condition_id,
 """ + ", ".join(f"CASE WHEN a.condition_id IS NOT NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in ("question", "description", "end_ts", "volume", "active", "closed")) + """,
 coalesce(nullif(a.category, ''), b.category) AS category, coalesce(a.start_ts, b.start_ts) AS start_ts,
 CASE WHEN a.condition_id IS NOT NULL AND b.condition_id IS NOT NULL THEN 'both' WHEN a.condition_id IS NOT NULL THEN 'a' ELSE 'b' END AS origin FROM a FULL JOIN b ON a.condition_id = b.condition_id)"""


def merged(v):
    return s.merge_markets(src(v, A), src(v, B))


query("merge_markets", f"WITH {MERGED} SELECT * FROM merged")(merged)
OLD = "SELECT market_id + 1 AS dim_id, condition_id, lower(question) AS question, volume, active, TIMESTAMP '2023-01-01 00:00:00' AS updated_at FROM markets WHERE market_id % 3 = 0"


def upserted(v):
    old = src(v, OLD.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    new = merged(v).select("condition_id", F.when(F.col("origin") != "b", F.col("question")).alias("question"), "volume", F.when(F.col("origin") == "both", F.col("active")).alias("active"))
    return s.upsert_dim(old, new, "condition_id", "dim_id", ["active"], now())


UP = f"""{MERGED}, o AS ({OLD}), n AS (SELECT condition_id, CASE WHEN origin <> 'b' THEN question END AS question, volume, CASE WHEN origin = 'both' THEN active END AS active FROM merged),
 f AS (SELECT condition_id, row_number() OVER (ORDER BY condition_id) AS k FROM n WHERE condition_id NOT IN (SELECT condition_id FROM o)),
 up AS (SELECT coalesce(o.dim_id, (SELECT max(dim_id) FROM o) + f.k) AS dim_id, coalesce(o.condition_id, n.condition_id) AS condition_id, coalesce(n.question, o.question) AS question, coalesce(n.volume, o.volume) AS volume,
  CASE WHEN n.condition_id IS NOT NULL THEN n.active ELSE o.active END AS active, CASE WHEN n.condition_id IS NOT NULL THEN {NOW} ELSE o.updated_at END AS updated_at,
  CASE WHEN o.condition_id IS NULL THEN 'inserted' WHEN n.condition_id IS NULL THEN 'kept' ELSE 'updated' END AS status
  FROM o FULL JOIN n ON o.condition_id = n.condition_id LEFT JOIN f ON n.condition_id = f.condition_id)"""
query("upsert_market_dim", f"WITH {UP} SELECT * FROM up")(upserted)
query(
    "load_stats",
    f"""WITH {UP}
 SELECT count(CASE WHEN status <> 'kept' THEN 1 END) AS processed, count(CASE WHEN status = 'inserted' THEN 1 END) AS inserted, count(CASE WHEN status = 'updated' THEN 1 END) AS updated, count(CASE WHEN status = 'kept' THEN 1 END) AS kept
 FROM up""",
)(lambda v: s.load_stats(upserted(v)))
query(
    "load_token_dim",
    """WITH t AS (SELECT k.token_id, 'h' || k.token_id AS token_hash, m.condition_id, k.market_id, k.outcome, k.price FROM market_tokens k JOIN markets m ON k.market_id = m.market_id),
 o AS (SELECT token_id + 1 AS token_id, token_hash, market_id, outcome, price FROM t WHERE token_id % 4 = 0)
 SELECT * FROM o UNION ALL SELECT (SELECT max(token_id) FROM o) + row_number() OVER (ORDER BY token_hash), token_hash, market_id, outcome, price FROM t WHERE token_id % 4 <> 0 AND market_id % 9 <> 0""",
)(lambda v: _tokens(v))


def _tokens(v):
    t = v.market_tokens.join(v.markets.select("market_id", "condition_id"), "market_id").withColumn("token_hash", F.concat(F.lit("h"), F.col("token_id").cast("string")))
    old = t.where("token_id % 4 = 0").select((F.col("token_id") + 1).alias("token_id"), "token_hash", "market_id", "outcome", "price")
    return s.load_tokens(old, t.select("token_hash", "condition_id", "outcome", "price"), v.markets.where("market_id % 9 <> 0"))


OLDT = "o AS (SELECT trader_id, wallet FROM traders WHERE trader_id % 2 = 0)"


def old_traders(v):
    return v.traders.where("trader_id % 2 = 0").select("trader_id", "wallet")


query(
    "load_trader_dim",
    f"""WITH {OLDT}, w AS (SELECT DISTINCT wallet FROM (SELECT wallet FROM trades UNION ALL SELECT wallet FROM leaderboard) x
 WHERE wallet NOT IN (SELECT wallet FROM o)) SELECT * FROM o UNION ALL SELECT (SELECT max(trader_id)
 FROM o) + row_number() OVER (ORDER BY wallet), wallet FROM w""",
)(lambda v: s.load_traders(old_traders(v), v.trades, v.leaderboard))
query(
    "resolve_ids",
    f"""WITH {OLDT}, f AS (SELECT wallet, (SELECT max(trader_id) FROM o) + row_number() OVER (ORDER BY wallet) AS trader_id
 FROM (SELECT DISTINCT wallet FROM trades WHERE wallet NOT IN (SELECT wallet FROM o)) x), d AS (SELECT wallet, trader_id FROM o UNION ALL
 SELECT * FROM f) SELECT d.trader_id, t.side, count(*) AS trades FROM trades t JOIN d ON t.wallet = d.wallet GROUP BY 1, 2""",
)(
    lambda v: s.resolve_ids(v.trades.select("wallet", "side"), old_traders(v), "wallet", "trader_id").groupBy("trader_id", "side").agg(F.count("*").alias("trades"))
)
query(
    "load_trade_fact",
    """SELECT sha256(wallet || '|' || token_key || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || side || '|' || n) AS trade_id, token_key, ts, price, size, side, maker_id, taker_id FROM (
 SELECT t.*, k.token_id AS token_key, d.trader_id AS maker_id, row_number() OVER (PARTITION BY t.wallet, k.token_id, t.ts, t.side ORDER BY t.price, t.size, t.taker_id) AS n
 FROM trades t JOIN market_tokens k ON t.market_id = k.market_id AND t.outcome = k.outcome JOIN traders d ON t.wallet = d.wallet) x""",
)(lambda v: s.trade_fact(v.trades, v.market_tokens, v.traders))
query(
    "load_price_fact",
    "SELECT token_id, ts, price FROM prices WHERE token_id IN (SELECT token_id FROM market_tokens)",
)(lambda v: s.price_fact(v.prices, v.market_tokens))
query(
    "load_leaderboard_fact",
    "SELECT d.trader_id, l.month, l.rank, l.pnl FROM leaderboard l JOIN traders d ON l.wallet = d.wallet",
)(lambda v: s.leaderboard_fact(v.leaderboard, v.traders))
query(
    "parse_datetime",
    """SELECT market_id, CASE WHEN market_id % 6 = 5 THEN NULL WHEN market_id % 6 = 4 THEN date_trunc('day', end_ts)::TIMESTAMP ELSE end_ts END AS ts
 FROM markets""",
)(
    lambda v: v.markets.select(
        "market_id",
        F.when(F.col("market_id") % 6 == 0, F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("market_id") % 6 == 1, F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(F.col("market_id") % 6 == 2, F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss")).when(F.col("market_id") % 6 == 3, F.date_format("end_ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("market_id") % 6 == 4, F.date_format("end_ts", "yyyy-MM-dd")).otherwise("soon").alias("x"),
    ).select("market_id", parse_datetime("x").alias("ts"))
)
query(
    "safe_float",
    "SELECT market_id, CASE market_id % 4 WHEN 0 THEN volume WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 12.5 END AS x FROM markets",
)(
    lambda v: v.markets.selectExpr("market_id", "CASE market_id % 4 WHEN 0 THEN cast(volume as string) WHEN 1 THEN 'NaN' WHEN 2 THEN 'n/a' ELSE ' 12.5 ' END AS t").select("market_id", safe_float("t").alias("x"))
)
query(
    "dq_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)(lambda v: s.duplicates(v.lineitem, ["l_orderkey", "l_linenumber"]))
query(
    "dq_orphans",
    "SELECT token_id, count(*) AS n FROM prices WHERE token_id NOT IN (SELECT token_id FROM market_tokens WHERE winner) GROUP BY token_id",
)(lambda v: s.orphans(v.prices, "token_id", v.market_tokens.where("winner"), "token_id"))
query(
    "dq_nulls",
    """SELECT 'consensus' AS column_name, count(*) - count(consensus) AS nulls FROM history UNION ALL
 SELECT 'human_decision', count(*) - count(human_decision) FROM history UNION ALL SELECT 'market_id', count(*) - count(market_id)
 FROM history""",
)(lambda v: s.nulls(v.history, ["consensus", "human_decision", "market_id"]))

# Gold.
CATS = "cats AS (SELECT category_name, row_number() OVER (ORDER BY category_name) AS category_id FROM (SELECT DISTINCT category AS category_name FROM markets) x)"
query("gold_categories", f"WITH {CATS} SELECT * FROM cats")(lambda v: g.categories(payloads(v)))
query(
    "gold_events",
    f"""WITH {CATS}, e AS (SELECT 'event-' || market_id % 40 AS slug, min((question, category)) AS x FROM markets GROUP BY 1)
 SELECT row_number() OVER (ORDER BY slug) AS event_id, slug, x[1] AS title, c.category_id FROM e JOIN cats c ON c.category_name = x[2]""",
)(lambda v: gold_events(v))
DATES = "CASE WHEN market_id % 4 <> 1 THEN start_ts END AS start_date_iso, date_trunc('day', end_ts)::TIMESTAMP AS end_date_iso, volume AS volume_num"
query("gold_markets", f"SELECT condition_id AS external_id, question, active, {DATES} FROM markets")(lambda v: g.markets(payloads(v)))
query(
    "gold_tokens",
    """SELECT condition_id AS external_id, market_id || '-' || lower(o) AS token_address, o AS outcome, o = 'Yes' AS is_yes
 FROM markets, (SELECT 'Yes' AS o UNION ALL SELECT 'No') z""",
)(lambda v: g.tokens(payloads(v)))
query(
    "gold_hourly_prices",
    "SELECT token_id, date_trunc('hour', ts)::TIMESTAMP AS snapshot_ts, arg_min(price, (ts, event_id)) AS price FROM prices GROUP BY 1, 2",
)(lambda v: g.hourly_prices(v.prices))
query(
    "gold_traders",
    """SELECT DISTINCT left(sha256(w), 40) AS hex FROM (SELECT wallet AS w FROM trades UNION ALL SELECT 't' || taker_id FROM trades) x
 WHERE w NOT IN (SELECT wallet FROM traders WHERE trader_id % 2 = 0)""",
)(lambda v: _gold_traders(v))


def _gold_traders(v):
    address = lambda c: F.concat(F.lit("0x"), F.left(F.sha2(c, 256), F.lit(40)))
    t = v.trades.select(address(F.col("wallet")).alias("maker"), address(F.concat(F.lit("t"), F.col("taker_id").cast("string"))).alias("taker"))
    have = old_traders(v).select(F.unhex(F.substring(address(F.col("wallet")), 3, 40)).alias("wallet_address"))
    return g.traders(t, have).select(F.lower(F.hex("wallet_address")).alias("hex"))


query(
    "gold_trades",
    "SELECT wallet, market_id || '-' || lower(outcome) AS token_address, side, price, size, outcome = 'Yes' AS is_yes FROM trades",
)(
    lambda v: g.trade_facts(v.trades.withColumn("condition_id", F.concat(F.lit("c"), F.col("market_id").cast("string"))), g.tokens(payloads(v))).select("wallet", "token_address", "side", "price", "size", "is_yes")
)


# The gold star schema: every dimension and fact is built on what is there already.
def staged_prices(v):
    """The history of each token as one JSON document, under its address."""
    secs = F.unix_timestamp(F.col("ts").cast("timestamp"))
    i = F.col("token_id")
    address = F.concat(F.floor(i / 2).cast("string"), F.when(i % 2 == 0, "-yes").otherwise("-no"))
    rows = v.prices.groupBy(address.alias("token_id")).agg(F.to_json(F.collect_list(F.struct(secs.alias("t"), F.col("price").alias("p")))).alias("raw_json"))
    return rows.withColumn("fetched_at", now())


def address_of(c):
    return F.concat(F.lit("0x"), F.left(F.sha2(c, 256), F.lit(40)))


def staged_trades(v):
    """One JSON document a trade; some have another outcome, a taker without a valid wallet, or no price."""
    i = F.col("taker_id")
    doc = F.struct(
        address_of(F.col("wallet")).alias("maker"), F.when(i % 5 != 0, address_of(F.concat(F.lit("t"), i.cast("string")))).otherwise("0x12").alias("taker"),
        F.when(i % 7 != 0, F.col("price")).alias("price"), "size", F.when(i % 3 != 0, F.lower("side")).alias("side"),
        F.when(i % 11 == 0, "other").otherwise(F.col("outcome")).alias("outcome"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    return v.trades.select(F.concat(F.lit("c"), F.col("market_id").cast("string")).alias("condition_id"), F.to_json(doc).alias("raw_json"), now().alias("fetched_at"))


def market_rows(v):
    """The staged markets, parsed and written once a query."""
    if "market_rows" not in vars(v):
        v.market_rows = written(g.market_rows(payloads(v)), "market_rows")
    return v.market_rows


def gold_events(v):
    return g.events(market_rows(v), g.categories(market_rows(v)))


def gold_market_dim(v):
    old = v.markets.where("market_id % 3 = 0").selectExpr(
        "market_id + 1 AS market_id", "condition_id AS external_id", "cast(null as bigint) AS event_id", "question", "active",
        "cast(null as timestamp_ntz) AS start_date_iso", "cast(null as timestamp_ntz) AS end_date_iso", "volume AS volume_num",
    )
    return g.market_dim(market_rows(v), gold_events(v), old)


def gold_token_dim(v, market_dim=None):
    return g.token_dim(market_rows(v), gold_market_dim(v) if market_dim is None else market_dim, v.spark.createDataFrame([], g.TOKEN_DIM))


def gold_trader_dim(v, trades=None):
    old = v.traders.where("trader_id % 2 = 0").select((F.col("trader_id") + 1).alias("trader_id"), F.unhex(F.substring(address_of(F.col("wallet")), 3, 40)).alias("wallet_address"))
    return g.trader_dim(staged_trades(v) if trades is None else trades, old)


def gold_price_fact(v):
    tokens = written(gold_token_dim(v), "tokens")
    points = v.prices.where("event_id % 5 = 0").select(F.floor(F.col("token_id") / 2).alias("m"), F.when(F.col("token_id") % 2 == 0, "-yes").otherwise("-no").alias("o"), "ts")
    old = points.select(F.concat(F.col("m").cast("string"), "o").alias("token_address"), F.date_trunc("hour", "ts").alias("snapshot_ts")).distinct()
    old = old.join(tokens, "token_address").select("token_id", "snapshot_ts", F.lit(-1).cast("float").alias("price"))
    return g.hourly_price_fact(staged_prices(v), tokens, old)


def gold_trade_fact(v):
    markets = written(gold_market_dim(v), "markets")
    trades = written(g.trade_rows(staged_trades(v)), "trade_rows")
    return g.trade_fact(trades, markets, gold_token_dim(v, markets), gold_trader_dim(v, trades))


GEV = "ev AS (SELECT slug, row_number() OVER (ORDER BY slug) AS event_id FROM (SELECT DISTINCT 'event-' || market_id % 40 AS slug FROM markets) x)"
GMD = f"""{GEV},
gmd AS (SELECT market_id + 1 AS market_id, condition_id AS external_id, NULL::BIGINT AS event_id, question, active, NULL::TIMESTAMP AS start_date_iso, NULL::TIMESTAMP AS end_date_iso, volume AS volume_num
 FROM markets WHERE market_id % 3 = 0 UNION ALL
 SELECT (SELECT max(market_id) + 1 FROM markets WHERE market_id % 3 = 0) + row_number() OVER (ORDER BY condition_id), condition_id, event_id, question, active, {DATES}
 FROM markets m LEFT JOIN ev ON slug = 'event-' || market_id % 40 WHERE market_id % 3 <> 0)"""
GTD = f"""{GMD},
gtd AS (SELECT row_number() OVER (ORDER BY token_address) AS token_id, token_address, market_id, is_yes FROM (
 SELECT substr(external_id, 2) || k.o AS token_address, market_id, k.o = '-yes' AS is_yes FROM gmd, (SELECT '-yes' AS o UNION ALL SELECT '-no') k) x)"""
GPF = f"""{GTD},
pts AS (SELECT g.token_id, date_trunc('hour', ts)::TIMESTAMP AS snapshot_ts, floor(epoch(ts)) AS t, price, event_id FROM prices p JOIN gtd g ON g.token_address = p.token_id // 2 || CASE WHEN p.token_id % 2 = 0 THEN '-yes' ELSE '-no' END),
gpf AS (SELECT DISTINCT token_id, snapshot_ts, -1::FLOAT AS price FROM pts WHERE event_id % 5 = 0 UNION ALL
 SELECT token_id, snapshot_ts, arg_min(price, (t, price))::FLOAT FROM pts GROUP BY 1, 2 HAVING count(CASE WHEN event_id % 5 = 0 THEN 1 END) = 0)"""
GWD = """gw AS (SELECT trader_id + 1 AS trader_id, left(sha256(wallet), 40) AS wallet FROM traders WHERE trader_id % 2 = 0),
gwd AS (SELECT trader_id, wallet FROM gw UNION ALL SELECT (SELECT max(trader_id) FROM gw) + row_number() OVER (ORDER BY wallet), wallet FROM (
 SELECT DISTINCT wallet FROM (SELECT left(sha256(wallet), 40) AS wallet FROM trades UNION ALL SELECT left(sha256('t' || taker_id), 40) FROM trades WHERE taker_id % 5 <> 0) x WHERE wallet NOT IN (SELECT wallet FROM gw)) y)"""
GTF = f"""{GTD}, {GWD},
gtf AS (SELECT k.token_id, t.ts AS trade_ts, t.price::FLOAT AS price, t.size::FLOAT AS size, t.taker_id % 3 <> 0 AND side = 'BUY' AS is_buy, a.trader_id AS maker_id, b.trader_id AS taker_id
 FROM trades t JOIN gmd m ON m.external_id = 'c' || t.market_id JOIN gtd k ON k.market_id = m.market_id AND (t.taker_id % 11 = 0 OR k.is_yes = (t.outcome = 'Yes'))
 LEFT JOIN gwd a ON a.wallet = left(sha256(t.wallet), 40) LEFT JOIN gwd b ON t.taker_id % 5 <> 0 AND b.wallet = left(sha256('t' || t.taker_id), 40) WHERE t.taker_id % 7 <> 0)"""
query("gold_market_dim", f"WITH {GMD} SELECT * FROM gmd")(gold_market_dim)
query("gold_token_dim", f"WITH {GTD} SELECT * FROM gtd")(gold_token_dim)
query("gold_price_fact", f"WITH {GPF} SELECT * FROM gpf")(gold_price_fact)
query(
    "gold_trader_dim",
    f"WITH {GWD} SELECT trader_id, wallet AS hex FROM gwd",
)(lambda v: gold_trader_dim(v).select("trader_id", F.lower(F.hex("wallet_address")).alias("hex")))
query("gold_trade_fact", f"WITH {GTF} SELECT * FROM gtf")(gold_trade_fact)


def full_run(v):
    tables, results = g.full_run({"markets": payloads(v), "prices": staged_prices(v), "trades": staged_trades(v)}, {})
    return load_summary(v.spark, tables, results)


query(
    "gold_full_run",
    f"""WITH {GTF} SELECT name, 'loaded' AS status, rows FROM (SELECT 'categories' AS name, count(DISTINCT category) AS rows FROM markets UNION ALL SELECT 'events', count(*) FROM ev UNION ALL SELECT 'markets', count(*) FROM gmd
 UNION ALL SELECT 'tokens', count(*) FROM gtd UNION ALL SELECT 'prices', count(*) FROM (SELECT DISTINCT token_id, date_trunc('hour', ts) FROM prices WHERE token_id // 2 IN (SELECT market_id FROM markets)) x
 UNION ALL SELECT 'traders', count(*) FROM (SELECT wallet FROM trades UNION SELECT 't' || taker_id FROM trades WHERE taker_id % 5 <> 0) y UNION ALL SELECT 'trades', count(*) FROM gtf) z""",
)(full_run)


def rebuilt(v):
    """Gold of all markets, then its market dimension built again after every fifth market left staging."""
    staged = {"markets": market_rows(v), "prices": staged_prices(v), "trades": g.StagedTrades(staged_trades(v))}
    before, _ = g.full_run(staged, {})
    left = staged | {"markets": staged["markets"].where("market_id % 5 <> 0")}
    return load_summary(v.spark, *g.rebuild(left, before, "markets"))


FEWER = GTF.replace("FROM markets", "FROM (SELECT * FROM markets WHERE market_id % 5 <> 0)")
query(
    "gold_rebuild",
    f"""WITH {FEWER} SELECT name, CASE WHEN name IN ('categories', 'events', 'traders') THEN 'kept' ELSE 'loaded' END AS status, rows FROM (
 SELECT 'categories' AS name, count(DISTINCT category) AS rows FROM markets UNION ALL SELECT 'events', (SELECT count(DISTINCT market_id % 40) FROM markets)
 UNION ALL SELECT 'markets', count(*) FROM gmd UNION ALL SELECT 'tokens', count(*) FROM gtd
 UNION ALL SELECT 'prices', count(*) FROM (SELECT DISTINCT token_id, date_trunc('hour', ts) FROM prices WHERE token_id // 2 IN (SELECT market_id FROM markets WHERE market_id % 5 <> 0)) x
 UNION ALL SELECT 'traders', count(*) FROM (SELECT wallet FROM trades UNION SELECT 't' || taker_id FROM trades WHERE taker_id % 5 <> 0) y UNION ALL SELECT 'trades', count(*) FROM gtf) z""",
)(rebuilt)


def silver_load(v, markets):
    """Markets first, then what hangs on them; `markets` makes the first table."""
    return run_steps([
        Step("markets", lambda t: markets(v), True),
        Step("tokens", lambda t: _tokens(v), False),
        Step("traders", lambda t: s.load_traders(old_traders(v), v.trades, v.leaderboard), False),
        Step("trades", lambda t: s.trade_fact(v.trades, v.market_tokens, t["traders"]), False),
    ])


def broken(v):
    return v.markets.select(F.when(F.col("market_id") >= 0, F.raise_error(F.lit("bad source"))).cast("long").alias("market_id"))


query(
    "ordered_load",
    """SELECT 'markets' AS name, 'loaded' AS status, count(*) AS rows FROM markets UNION ALL SELECT 'tokens', 'loaded', (SELECT count(*)
 FROM market_tokens WHERE token_id % 4 = 0 OR market_id % 9 <> 0) UNION ALL SELECT 'traders', 'loaded', (SELECT count(DISTINCT wallet)
 FROM (SELECT wallet FROM trades UNION ALL SELECT wallet FROM leaderboard UNION ALL SELECT wallet FROM traders WHERE trader_id % 2 = 0) x)
 UNION ALL SELECT 'trades', 'loaded', (SELECT count(*) FROM trades t
 JOIN market_tokens k ON t.market_id = k.market_id AND t.outcome = k.outcome)""",
)(lambda v: load_summary(v.spark, *silver_load(v, lambda v: v.markets)))
query(
    "ordered_load_aborted",
    "SELECT unnest(['markets', 'tokens', 'traders', 'trades']) AS name, unnest(['failed', 'skipped', 'skipped', 'skipped']) AS status, NULL::BIGINT AS rows",
)(lambda v: load_summary(v.spark, *silver_load(v, broken)))


# Sources and sinks: each writes under the shared folder and reads back.
def path(v, name):
    return new_dir(v.spark, name)


def daily(v):
    return v.prices.withColumn("dt", F.col("ts").cast("date"))


def bronze_dir(v):
    p = path(v, "bronze")
    sinks.append_partitioned(daily(v), p, daily(v).schema)
    return p


DAY = "SELECT token_id, ts, price, event_id, CAST(ts AS DATE) AS dt FROM prices"
query(
    "scan_partitioned",
    f"SELECT dt, count(*) AS n, sum(event_id)::BIGINT AS ids FROM ({DAY}) x WHERE dt >= DATE '2024-01-20' GROUP BY dt",
)(
    lambda v: scans.scan(v.spark, bronze_dir(v), daily(v).schema, where=F.col("dt") >= F.lit("2024-01-20").cast("date")).groupBy("dt").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
)
query(
    "scan_columns",
    "SELECT token_id, price FROM prices",
)(lambda v: scans.scan(v.spark, bronze_dir(v), daily(v).schema, columns=["token_id", "price"]))
query(
    "scan_query",
    "SELECT token_id, max(price) AS top FROM prices GROUP BY token_id",
)(lambda v: scans.scan_query(v.spark, bronze_dir(v), "SELECT token_id, max(price) AS top FROM {data} GROUP BY token_id", daily(v).schema))
query(
    "union_by_name",
    """SELECT market_id, question, NULL::DOUBLE AS volume FROM markets WHERE closed UNION ALL SELECT market_id, NULL, volume FROM markets
 WHERE NOT closed""",
)(
    lambda v: scans.union_by_name(v.markets.where("closed").select("market_id", "question"), v.markets.where("not closed").select("volume", "market_id"))
)
query(
    "distinct_market_ids",
    "SELECT DISTINCT market_id FROM trades WHERE market_id IS NOT NULL",
)(lambda v: scans.distinct_keys(v.trades, "market_id"))
query(
    "partition_inventory",
    "SELECT 'prices' AS name, count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS files, max(CAST(ts AS DATE)) AS latest FROM prices",
)(lambda v: scans.partition_inventory({"prices": v.spark.read.parquet(bronze_dir(v))}))
query(
    "rows_per_partition",
    f"SELECT dt, count(*) AS count FROM ({DAY}) x GROUP BY dt",
)(lambda v: v.spark.read.parquet(bronze_dir(v)).groupBy("dt").count())
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
DESCRIBED = ("lineitem", "orders", "part", "customer", "events", "documents")


def described(v):
    """Every column of six tables, with its type by its name in SQL."""
    names = F.create_map(*[F.lit(x) for pair in SQL_TYPES.items() for x in pair])
    out = scans.describe_tables({t: getattr(v, t) for t in DESCRIBED})
    return out.withColumn("data_type", F.coalesce(names[F.col("data_type")], "data_type")).withColumn("nulls", F.col("nulls").cast("long"))


query(
    "describe_tables",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, column_name, (row_number() OVER () - 1)::INTEGER AS position, column_type AS data_type, count AS rows,
 round(count * null_percentage::DOUBLE / 100)::BIGINT AS nulls FROM (SUMMARIZE {t})"""
        for t in DESCRIBED
    ),
)(described)
query(
    "table_counts",
    """SELECT 'trades' AS name, count(*) AS rows FROM trades UNION ALL SELECT 'markets', count(*) FROM markets UNION ALL SELECT 'prices', count(*)
 FROM prices""",
)(lambda v: scans.table_counts({"trades": v.trades, "markets": v.markets, "prices": v.prices}))
query(
    "layer_summary",
    """SELECT 'trades' AS name, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM trades UNION ALL
 SELECT 'prices', count(*), min(ts), max(ts) FROM prices""",
)(lambda v: scans.layer_summary({"trades": (v.trades, "ts"), "prices": (v.prices, "ts")}))
query("bronze_roundtrip", DAY)(lambda v: scans.scan(v.spark, bronze_dir(v), daily(v).schema))


def overwritten(v):
    p = bronze_dir(v)
    again = daily(v).where("dt = DATE '2024-01-15'").withColumn("price", F.col("price") + 1)
    sinks.replace_partitions(again, p)
    sinks.replace_partitions(again, p)
    return scans.scan(v.spark, p, daily(v).schema)


query(
    "overwrite_day",
    """SELECT token_id, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN price + 1 ELSE price END AS price, event_id, CAST(ts AS DATE) AS dt
 FROM prices""",
)(overwritten)


def exported(v):
    p = path(v, "export")
    sinks.export(v.markets, p, "category")
    return v.spark.read.schema(v.markets.schema).parquet(p).groupBy("category").count()


query("export_partitioned", "SELECT category, count(*) AS count FROM markets GROUP BY category")(exported)


def restored(v):
    tables = {"markets": v.markets, "traders": v.traders}
    p, _ = sinks.snapshot(tables, path(v, "gold"), "2024-01")
    back = sinks.restore(v.spark, p, {"markets": v.markets.schema, "traders": v.traders.schema, "events": v.tags.schema})
    return scans.table_counts(back)


query(
    "snapshot_restore",
    "SELECT 'markets' AS name, count(*) AS rows FROM markets UNION ALL SELECT 'traders', count(*) FROM traders UNION ALL SELECT 'events', 0",
)(restored)
def snapshot_sizes(v):
    """Rows of each table of a snapshot; files and bytes are there or not, as they depend on the writer."""
    _, sizes = sinks.snapshot({"markets": v.markets, "traders": v.traders}, path(v, "gold"), "2024-01")
    return sizes.select("name", "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


query(
    "snapshot_sizes",
    """SELECT 'markets' AS name, count(*) AS rows, TRUE AS has_files, TRUE AS has_bytes FROM markets UNION ALL
 SELECT 'traders', count(*), TRUE, TRUE FROM traders""",
)(snapshot_sizes)
query(
    "metadata_stamp",
    f"""SELECT 'user' || token_id AS key, CAST(max(event_id) AS VARCHAR) AS value, max(ts) AS updated_at FROM prices WHERE token_id <> 7
 GROUP BY token_id UNION ALL SELECT 'user7', '2024-01', {NOW}""",
)(
    lambda v: sinks.stamp(
        v.prices.groupBy(F.concat(F.lit("user"), F.col("token_id").cast("string")).alias("key")).agg(F.max("event_id").cast("string").alias("value"), F.max("ts").alias("updated_at")), "user7", "2024-01", now()
    )
)


# The eight bronze datasets: payload rows with other types and extra fields, appended twice on two days.
def bronze_rows(v, name):
    m, i = v.markets, F.col("market_id")
    text = lambda c: F.col(c).cast("string")
    if name == "trades":
        return v.trades.select(F.col("wallet").alias("proxyWallet"), "side", text("price").alias("price"), "size", F.concat(F.lit("c"), text("market_id")).alias("conditionId"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"), "outcome", F.lit("x").alias("extra"))
    if name == "markets":
        return m.select("condition_id", "description", "question", "closed", "active", text("volume").alias("volume"), F.when(i % 2 == 0, "n/a").alias("liquidity"), F.date_format("end_ts", "yyyy-MM-dd").alias("end_date_iso"))
    if name == "gamma_markets":
        return m.select(i.alias("id"), F.col("condition_id").alias("conditionId"), "question", "category", "outcomes", F.col("outcome_prices").alias("outcomePrices"), "active", "closed", F.col("volume").alias("volumeNum"), text("market_id").alias("marketGroup"))
    if name == "gamma_events":
        return m.select(text("market_id").alias("marketId"), (i * 10).alias("eventId"), F.col("question").alias("title"), "category", "volume", "active")
    if name == "gamma_categories":
        return m.select(text("market_id").alias("marketId"), (i % 6).alias("categoryId"), F.col("category").alias("label"), F.lower("category").alias("slug"))
    if name == "market_tokens":
        return v.market_tokens.select(F.concat(F.lit("c"), text("market_id")).alias("condition_id"), "price", "token_id", "winner", "outcome")
    if name == "prices":
        return v.prices.select(F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"), "token_id", "price")
    return v.leaderboard.select("rank", F.col("wallet").alias("proxyWallet"), F.lit("yes").alias("verifiedBadge"), F.col("n_orders").alias("vol"), "pnl")


def bronze_dataset(name):
    def run(v):
        # Both days land the same rows, which are made once.
        root, rows = path(v, "bronze"), written(bronze_rows(v, name), "landed")
        for day in ("2024-01-01", "2024-01-02"):
            p = sinks.append_dataset(rows, root, name, F.lit(day))
        schema = T.StructType.fromDDL(BRONZE[name] + ", dt date")
        return scans.scan(v.spark, p, schema).groupBy(*[f.name for f in schema.fields]).agg(F.count("*").alias("n"))

    return run


BRONZE_SQL = {
    "trades": "wallet AS \"proxyWallet\", side, price, size, 'c' || market_id AS \"conditionId\", CAST(epoch(ts) AS BIGINT) AS timestamp, NULL::VARCHAR AS \"transactionHash\", outcome, NULL::VARCHAR AS name FROM trades",
    "markets": "condition_id, strftime(end_ts, '%Y-%m-%d') AS end_date_iso, NULL::VARCHAR AS game_start_time, description, question, NULL::DOUBLE AS maker_base_fee, NULL::VARCHAR AS fpmm, closed, active, volume, NULL::DOUBLE AS liquidity FROM markets",
    "gamma_markets": "CAST(market_id AS VARCHAR) AS id, condition_id AS \"conditionId\", question, NULL::VARCHAR AS slug, category, NULL::VARCHAR AS description, NULL::VARCHAR AS liquidity, NULL::VARCHAR AS volume, active, closed, NULL::VARCHAR AS \"startDate\", NULL::VARCHAR AS \"endDate\", outcomes, outcome_prices AS \"outcomePrices\", NULL::VARCHAR AS \"clobTokenIds\", volume AS \"volumeNum\", NULL::DOUBLE AS \"liquidityNum\", market_id AS \"marketGroup\" FROM markets",
    "gamma_events": "CAST(market_id AS VARCHAR) AS \"marketId\", CAST(market_id * 10 AS VARCHAR) AS \"eventId\", NULL::VARCHAR AS ticker, NULL::VARCHAR AS slug, question AS title, NULL::VARCHAR AS description, category, NULL::VARCHAR AS subcategory, NULL::DOUBLE AS liquidity, volume, active, NULL::BOOLEAN AS closed FROM markets",
    "gamma_categories": "CAST(market_id AS VARCHAR) AS \"marketId\", CAST(market_id % 6 AS VARCHAR) AS \"categoryId\", category AS label, NULL::VARCHAR AS \"parentCategory\", lower(category) AS slug FROM markets",
    "market_tokens": "'c' || market_id AS condition_id, price, CAST(token_id AS VARCHAR) AS token_id, winner, outcome FROM market_tokens",
    "prices": "CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, CAST(token_id AS VARCHAR) AS token_id, price FROM prices",
    "leaderboard": "CAST(rank AS VARCHAR) AS rank, wallet AS \"proxyWallet\", NULL::VARCHAR AS \"userName\", NULL::VARCHAR AS \"xUsername\", TRUE AS \"verifiedBadge\", n_orders::DOUBLE AS vol, pnl, NULL::VARCHAR AS \"profileImage\" FROM leaderboard",
}
for dataset, columns in BRONZE_SQL.items():
    query(f"bronze_{dataset}", f"SELECT *, count(*) AS n FROM (SELECT *, unnest([DATE '2024-01-01', DATE '2024-01-02']) AS dt FROM (SELECT {columns}) x) y GROUP BY ALL")(bronze_dataset(dataset))
query(
    "staging_upsert",
    """SELECT token_id, price, event_id FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY event_id DESC) AS r FROM prices) x
 WHERE r = 1""",
)(
    lambda v: sinks.upsert(v.prices.where("event_id % 2 = 0").select("token_id", "price", "event_id"), v.prices.where("event_id % 2 = 1").select("token_id", "price", "event_id"), ["token_id"], "event_id")
)
query(
    "retention_keep",
    "SELECT event_id FROM prices WHERE NOT (ts < TIMESTAMP '2024-01-15' AND token_id % 3 = 0)",
)(
    lambda v: sinks.retained(v.prices, v.prices.where("token_id % 3 = 0"), ["token_id"], "ts", F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).select("event_id")
)
query(
    "kv_latest",
    "SELECT 'user' || token_id AS key, arg_max(price, event_id) AS value FROM prices GROUP BY token_id",
)(
    lambda v: sinks.latest_by_key(v.prices.select(F.concat(F.lit("user"), F.col("token_id").cast("string")).alias("key"), F.col("price").alias("value"), "event_id"), ["key"], ["event_id"]).drop("event_id")
)
