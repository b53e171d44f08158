"""Scalar function suites, each over a whole view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import decode_cursor, encode_cursor, parse_vote, short_wallet
from tallyforge.operators import distinct
from tallyforge.registry import query


@query(
    "string_suite",
    """SELECT market_id, upper(question) AS upper, trim('  ' || question || ' ') AS trimmed, length(question) AS chars, substr(condition_id, 2) AS tail, left(question, 8) AS head, right(question, 4) AS ending,
 coalesce(nullif(category, 'PROMO'), 'none') || '/' || condition_id AS label, replace(question, ' ', '_') AS joined, regexp_replace(question, '[^A-Za-z0-9]', '', 'g') AS kept, left(description, 200) AS cut,
 question ILIKE '%AL%' AS has_al, question LIKE '%al%' AS has_lower_al, replace(question, '''', '''''') AS quoted, concat_ws(', ', category, condition_id) AS listed FROM markets""",
)
def string_suite(v):
    c = F.col
    return v.markets.select(
        "market_id", F.upper("question").alias("upper"), F.trim(F.concat(F.lit("  "), "question", F.lit(" "))).alias("trimmed"), F.length("question").alias("chars"),
        F.substring("condition_id", 2, 1000).alias("tail"), F.left("question", F.lit(8)).alias("head"), F.right("question", F.lit(4)).alias("ending"),
        F.concat(F.coalesce(F.nullif("category", F.lit("PROMO")), F.lit("none")), F.lit("/"), "condition_id").alias("label"),
        F.replace("question", F.lit(" "), F.lit("_")).alias("joined"), F.regexp_replace("question", "[^A-Za-z0-9]", "").alias("kept"), F.left("description", F.lit(200)).alias("cut"),
        c("question").ilike("%AL%").alias("has_al"), c("question").like("%al%").alias("has_lower_al"), F.replace("question", F.lit("'"), F.lit("''")).alias("quoted"),
        F.concat_ws(", ", "category", "condition_id").alias("listed"),
    )


@query(
    "string_format",
    "SELECT wallet, left(wallet, 8) || '...' || right(wallet, 6) AS short, format('{:,.2f}', n_orders * 1234.5) AS money FROM leaderboard",
)
def string_format(v):
    return v.leaderboard.select("wallet", short_wallet("wallet").alias("short"), F.format_number(F.col("n_orders") * 1234.5, 2).alias("money"))


@query(
    "date_suite",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS from_epoch, date_trunc('hour', ts)::TIMESTAMP AS hour, date_trunc('day', ts)::TIMESTAMP AS day,
 CAST(date_trunc('month', ts) AS DATE) AS month, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days, ts - INTERVAL '30' DAY AS before, ts + INTERVAL '24' HOUR AS after, strftime(ts, '%b %Y') AS label,
 date_trunc('day', ts)::TIMESTAMP + INTERVAL '1' DAY - INTERVAL '1' SECOND AS day_end, strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS iso FROM prices""",
)
def date_suite(v):
    c = F.col
    secs = F.unix_timestamp(c("ts").cast("timestamp"))
    ntz = lambda x: x.cast("timestamp_ntz")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return v.prices.select(
        "event_id", secs.alias("epoch"), ntz(F.timestamp_seconds(secs)).alias("from_epoch"), F.date_trunc("hour", "ts").alias("hour"), F.date_trunc("day", "ts").alias("day"),
        F.date_trunc("month", "ts").cast("date").alias("month"), F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("days"), F.expr("ts - INTERVAL '30' DAY").alias("before"),
        F.expr("ts + INTERVAL '24' HOUR").alias("after"), F.date_format("ts", "MMM yyyy").alias("label"),
        F.expr("date_trunc('day', ts) + INTERVAL '1' DAY - INTERVAL '1' SECOND").alias("day_end"), ntz(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("iso"),
    )


@query(
    "math_suite",
    """SELECT trader_id, market_id, price, size, round(price * size, 2) AS value, abs(price - 0.5) AS distance, price / nullif(size - 10, 0) AS ratio, size / greatest(price, 0.1::DOUBLE) AS floored, price * 100 AS percent,
 CAST(floor(size * price) AS BIGINT) AS whole, least(greatest(price, 0.2::DOUBLE), 0.8::DOUBLE) AS clipped FROM trades""",
)
def math_suite(v):
    c = F.col
    return v.trades.select(
        "trader_id", "market_id", "price", "size", F.round(c("price") * c("size"), 2).alias("value"), F.abs(c("price") - 0.5).alias("distance"), F.try_divide("price", c("size") - 10).alias("ratio"),
        (c("size") / F.greatest("price", F.lit(0.1))).alias("floored"), (c("price") * 100).alias("percent"), F.floor(c("size") * c("price")).cast("long").alias("whole"),
        F.least(F.greatest("price", F.lit(0.2)), F.lit(0.8)).alias("clipped"),
    )


@query(
    "null_suite",
    """SELECT tag_id, market_id, coalesce(human_decision, consensus, FALSE) AS decided, nullif(yes, 0) AS some_yes, coalesce(nullif(no, 0), 7) AS no_or_7, CASE WHEN human_decision IS NULL THEN 'open' WHEN human_decision THEN 'yes' ELSE 'no' END AS label,
 TRY_CAST(CASE WHEN market_id % 2 = 0 THEN CAST(market_id AS VARCHAR) ELSE 'n/a' END AS INTEGER) AS parsed, consensus IS NOT DISTINCT FROM human_decision AS same FROM history""",
)
def null_suite(v):
    c = F.col
    text = F.when(c("market_id") % 2 == 0, c("market_id").cast("string")).otherwise("n/a")
    return v.history.select(
        "tag_id", "market_id", F.coalesce("human_decision", "consensus", F.lit(False)).alias("decided"), F.nullif("yes", F.lit(0)).alias("some_yes"), F.coalesce(F.nullif("no", F.lit(0)), F.lit(7)).alias("no_or_7"),
        F.when(c("human_decision").isNull(), "open").when(c("human_decision"), "yes").otherwise("no").alias("label"), text.try_cast("int").alias("parsed"), c("consensus").eqNullSafe(c("human_decision")).alias("same"),
    )


@query(
    "json_suite",
    """SELECT market_id, outcome_prices[3:-1] AS unused, json_extract_string(outcome_prices, '$[0]') AS first, CAST(json_extract_string(outcome_prices, '$[1]') AS DOUBLE) AS second, json_array_length(outcomes)::INTEGER AS n,
 json_extract_string('{"a":{"id":"' || market_id || '"}}', '$.a.id') AS nested, from_json(outcomes, '["VARCHAR"]') AS names, '{"id":' || market_id || ',"closed":' || CASE WHEN closed THEN 'true' ELSE 'false' END || '}' AS written FROM markets""".replace("outcome_prices[3:-1] AS unused, ", ""),
)
def json_suite(v):
    nested = F.to_json(F.struct(F.struct(F.col("market_id").cast("string").alias("id")).alias("a")))
    return v.markets.select(
        "market_id", F.get_json_object("outcome_prices", "$[0]").alias("first"), F.get_json_object("outcome_prices", "$[1]").cast("double").alias("second"), F.json_array_length("outcomes").alias("n"),
        F.get_json_object(nested, "$.a.id").alias("nested"), F.from_json("outcomes", "array<string>").alias("names"), F.to_json(F.struct(F.col("market_id").alias("id"), "closed")).alias("written"),
    )


@query("json_each", "SELECT market_id, pos, value FROM (SELECT market_id, unnest([0, 1]) AS pos, unnest(from_json(outcome_prices, '[\"VARCHAR\"]')) AS value FROM markets) x")
def json_each(v):
    return v.markets.select("market_id", F.posexplode(F.from_json("outcome_prices", "array<string>")).alias("pos", "value"))


@query(
    "array_map_suite",
    """WITH a AS (SELECT tag_id, list(market_id ORDER BY market_id) AS ids, count(CASE WHEN vote IS NOT NULL THEN 1 END) AS votes, count(CASE WHEN vote THEN 1 END) AS yes FROM (SELECT tag_id, market_id, CASE WHEN upper(trim(response)) LIKE '%YES%' THEN TRUE WHEN upper(trim(response)) LIKE '%NO%' THEN FALSE END AS vote FROM judge_responses) x GROUP BY tag_id)
 SELECT tag_id, len(list_distinct(ids))::INTEGER AS markets, list_sort(list_distinct(list_filter(ids, lambda x: x % 50 = 0))) AS round, list_aggregate(list_distinct(ids), 'sum')::BIGINT AS total, votes, yes FROM a""",
)
def array_map_suite(v):
    vote = F.struct(F.concat_ws("/", F.col("market_id").cast("string"), "model").alias("who"), parse_vote("response").alias("vote"))
    rows = v.judge_responses.groupBy("tag_id").agg(F.array_sort(F.collect_set("market_id")).alias("ids"), F.map_from_entries(F.collect_list(vote)).alias("votes"))
    given = F.filter(F.map_values("votes"), lambda x: x.isNotNull())
    return rows.select(
        "tag_id", F.size("ids").alias("markets"), F.filter("ids", lambda x: x % 50 == 0).alias("round"), F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        F.size(given).cast("long").alias("votes"), F.size(F.filter(given, lambda x: x)).cast("long").alias("yes"),
    )


@query(
    "binary_suite",
    """SELECT trader_id, left(sha256(wallet), 40) AS hex, octet_length(unhex(left(sha256(wallet), 40)))::INTEGER AS bytes, replace(replace(to_base64(encode(CAST(trader_id * 1000 AS VARCHAR))), '+', '-'), '/', '_') AS cursor, trader_id * 1000 AS decoded FROM traders""",
)
def binary_suite(v):
    address = F.unhex(F.left(F.sha2("wallet", 256), F.lit(40)))
    cursor = encode_cursor(F.col("trader_id") * 1000)
    return v.traders.select("trader_id", F.lower(F.hex(address)).alias("hex"), F.octet_length(address).alias("bytes"), cursor.alias("cursor"), decode_cursor(cursor).alias("decoded"))


@query("approx_traders", "SELECT market_id, count(DISTINCT trader_id) AS exact, TRUE AS near FROM trades GROUP BY market_id")
def approx_traders(v):
    """Approximate distinct counts, held against the exact ones: within a tenth, or one."""
    per = distinct.sketched(v.trades, ["market_id"], "trader_id")
    return per.select("market_id", "exact", (F.abs(F.col("about") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.1)).alias("near"))
