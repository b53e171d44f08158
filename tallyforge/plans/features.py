"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import money_sum
from tallyforge.operators import features as f
from tallyforge.operators.analysis import value
from tallyforge.registry import exact_sum, query

V = exact_sum("price * size")
P = exact_sum("pnl")
STAKE = exact_sum("CASE WHEN side = 'BUY' THEN price * size ELSE size * (1 - price) END")
DONE = """
won AS (SELECT token_id, winner FROM market_tokens WHERE market_id IN (SELECT market_id FROM market_tokens WHERE winner)),
done AS (SELECT t.*, CASE WHEN side = 'BUY' AND winner THEN size * (1 - price) WHEN side = 'BUY' THEN -size * price WHEN winner THEN -size * (1 - price) ELSE size * price END AS pnl
         FROM trades t JOIN won w ON t.token_id = w.token_id)"""
ROLES = DONE + """,
roles AS (SELECT *, concat('m', trader_id) AS person FROM done UNION ALL SELECT *, concat('t', taker_id) AS person FROM done)"""
MARKET = """
mf AS (SELECT m.market_id, m.condition_id, m.question, m.category, m.volume, m.liquidity, m.active, m.closed, coalesce(k.token_count, 0) AS token_count, k.winning_outcome,
 coalesce(k.is_resolved, FALSE) AS is_resolved, coalesce(n.trade_count, 0) AS trade_count, coalesce(n.unique_traders, 0) AS unique_traders,
 date_diff('day', m.start_ts, m.end_ts) AS duration_days
 FROM markets m LEFT JOIN (SELECT market_id, count(*) AS token_count, max(CASE WHEN winner THEN outcome END) AS winning_outcome, bool_or(winner) AS is_resolved FROM market_tokens GROUP BY market_id) k ON m.market_id = k.market_id
 LEFT JOIN (SELECT market_id, count(DISTINCT who) AS unique_traders, count(CASE WHEN q THEN 1 END) AS trade_count FROM (
   SELECT market_id, concat('m', trader_id) AS who, TRUE AS q FROM trades UNION ALL SELECT market_id, concat('t', taker_id) AS who, FALSE AS q FROM trades) r GROUP BY market_id) n ON m.market_id = n.market_id)"""


def mf(v, **kw):
    return f.market_features(v.markets, v.market_tokens, v.trades, **kw)


def done(v):
    return f.resolved_trades(v.trades, v.market_tokens)


query("market_features", f"WITH {MARKET} SELECT * FROM mf")(mf)
query(
    "market_features_closed",
    f"WITH {MARKET} SELECT * FROM mf WHERE closed AND is_resolved AND category = 'PROMO'",
)(lambda v: mf(v, category="PROMO", closed_only=True, resolved_only=True))
query(
    "market_features_by_tag",
    f"""WITH {MARKET} SELECT * FROM mf WHERE market_id IN (SELECT market_id FROM market_tags g JOIN tags t ON g.tag_id = t.tag_id
 WHERE t.name = (SELECT min(n_name) FROM nation WHERE n_nationkey = 3))""",
)(lambda v: f.by_tag(mf(v), v.market_tags, v.tags.where("tag_id = 3").select("tag_id", F.lit("x").alias("name")), "x"))
TOP = "SELECT * FROM (SELECT market_id, wallet, {m} AS {n}, row_number() OVER (PARTITION BY market_id ORDER BY {m} DESC, wallet) AS rank FROM {t} GROUP BY market_id, wallet) x WHERE rank <= 10"
query("top_traders_volume", TOP.format(m=V, n="volume", t="trades"))(lambda v: f.top_per_market(v.trades, money_sum(value()), "volume"))
query("top_traders_count", TOP.format(m="count(*)", n="trades", t="trades"))(lambda v: f.top_per_market(v.trades, F.count("*"), "trades"))
query(
    "top_traders_pnl",
    f"WITH {DONE} " + TOP.format(m=P, n="total_pnl", t="done"),
)(lambda v: f.top_per_market(done(v), money_sum("pnl"), "total_pnl"))
query(
    "market_features_top_list",
    f"WITH {MARKET}, r AS (" + TOP.format(m=V, n="volume", t="trades") + ") SELECT mf.*, coalesce(l.top_traders, []) AS top_traders FROM mf LEFT JOIN (SELECT market_id, list(wallet ORDER BY rank) AS top_traders FROM r GROUP BY market_id) l ON mf.market_id = l.market_id",
)(lambda v: f.with_top_list(mf(v), f.top_per_market(v.trades, money_sum(value()), "volume")))
query(
    "trader_features",
    f"""SELECT x.*, t.trader_id FROM (SELECT wallet, count(*) AS trade_count, {V} AS volume, {V} / count(*)::DOUBLE AS avg_value, count(DISTINCT market_id) AS markets,
 count(CASE WHEN side = 'BUY' THEN 1 END) AS buys, count(CASE WHEN side = 'SELL' THEN 1 END) AS sells, count(CASE WHEN side = 'BUY' THEN 1 END)::DOUBLE / count(*)::DOUBLE AS buy_ratio,
 min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT CAST(ts AS DATE)) AS trading_days FROM trades GROUP BY wallet HAVING count(*) >= 5) x JOIN traders t ON x.wallet = t.wallet""",
)(lambda v: f.trader_features(v.traders, v.trades, 5))
query(
    "trader_performance",
    f"""WITH {DONE}
 SELECT wallet, count(*) AS resolved_trades, {P} AS total_pnl, count(CASE WHEN pnl > 0 THEN 1 END)::DOUBLE / count(*)::DOUBLE AS win_rate
 FROM done GROUP BY wallet HAVING count(*) >= 5""",
)(lambda v: f.trader_performance(done(v)))
query(
    "best_trades",
    f"""WITH {ROLES} SELECT person, rank, market_id, token_id, side, price, size, ts, pnl FROM (SELECT *, row_number() OVER (PARTITION BY person
 ORDER BY pnl DESC, ts, market_id, token_id, side, price, size) AS rank FROM roles) x WHERE rank <= 5""",
)(lambda v: f.best_trades(done(v)))
query(
    "largest_return",
    f"WITH {ROLES} SELECT person, max(pnl) AS pnl, arg_max(market_id, (pnl, market_id)) AS market_id FROM roles GROUP BY person",
)(lambda v: f.largest_return(done(v)))
GROUPS = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY total_pnl DESC, {g}) AS rank FROM (SELECT person, {g}, count(*) AS trades, {v} AS volume, {p} AS total_pnl, count(CASE WHEN pnl > 0 THEN 1 END)::DOUBLE / count(*)::DOUBLE AS win_rate FROM ({src}) s GROUP BY person, {g}) x) y WHERE rank <= 3"
query(
    "trader_top_categories",
    f"WITH {ROLES} " + GROUPS.format(g="category", v=V, p=P, src="SELECT r.*, m.category FROM roles r JOIN markets m ON r.market_id = m.market_id"),
)(lambda v: f.top_groups(done(v), v.markets.select("market_id", "category"), "category"))
query(
    "trader_top_tags",
    f"WITH {ROLES} " + GROUPS.format(g="tag", v=V, p=P, src="SELECT r.*, t.name AS tag FROM roles r JOIN market_tags g ON r.market_id = g.market_id JOIN tags t ON g.tag_id = t.tag_id WHERE t.is_active"),
)(
    lambda v: f.top_groups(done(v), v.market_tags.join(F.broadcast(v.tags.where("is_active").select("tag_id", F.col("name").alias("tag"))), "tag_id").select("market_id", "tag"), "tag")
)


def profile(v):
    """Profiles with the nested lists taken apart: names and profits in order of rank."""
    p = f.trader_profile(v.traders, v.trades, v.market_tokens, v.markets, v.tags, v.market_tags)
    lists = {f"{g}_{c}": F.col(f"top_{g}.{c}") for g, c in (("category", "category"), ("category", "total_pnl"), ("tag", "tag"), ("tag", "win_rate"))}
    return p.withColumns(lists).drop("top_category", "top_tag")


def top_lists(group, src, second):
    return f"(SELECT person, list({group} ORDER BY rank) AS names, list({second} ORDER BY rank) AS numbers FROM (" + GROUPS.format(g=group, v=V, p=P, src=src) + ") q GROUP BY person)"


query(
    "trader_profile",
    f"""WITH {ROLES} SELECT t.trader_id, t.wallet, a.* EXCLUDE (wallet), d.* EXCLUDE (wallet), l.pnl AS largest_pnl, l.market_id AS largest_market, a.trade_count IS NOT NULL AS found,
 c.names AS category_category, c.numbers AS category_total_pnl, g.names AS tag_tag, g.numbers AS tag_win_rate
 FROM traders t LEFT JOIN (SELECT wallet, count(*) AS trade_count, {V} AS volume, {V} / count(*)::DOUBLE AS avg_value, count(DISTINCT market_id) AS markets, count(CASE WHEN side = 'BUY' THEN 1 END) AS buys,
  count(CASE WHEN side = 'SELL' THEN 1 END) AS sells, count(CASE WHEN side = 'BUY' THEN 1 END)::DOUBLE / count(*)::DOUBLE AS buy_ratio, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT CAST(ts AS DATE)) AS trading_days FROM trades GROUP BY wallet) a ON t.wallet = a.wallet
 LEFT JOIN (SELECT wallet, count(*) AS resolved_trades, {P} AS total_pnl, count(CASE WHEN pnl > 0 THEN 1 END)::DOUBLE / count(*)::DOUBLE AS win_rate FROM done GROUP BY wallet) d ON t.wallet = d.wallet
 LEFT JOIN (SELECT person, max(pnl) AS pnl, arg_max(market_id, (pnl, market_id)) AS market_id FROM roles GROUP BY person) l ON l.person = 'm' || t.trader_id
 LEFT JOIN {top_lists("category", "SELECT r.*, m.category FROM roles r JOIN markets m ON r.market_id = m.market_id", "total_pnl")} c ON c.person = 'm' || t.trader_id
 LEFT JOIN {top_lists("tag", "SELECT r.*, t.name AS tag FROM roles r JOIN market_tags g ON r.market_id = g.market_id JOIN tags t ON g.tag_id = t.tag_id WHERE t.is_active", "win_rate")} g ON g.person = 'm' || t.trader_id""",
)(profile)
query(
    "trader_roi",
    f"""WITH {DONE} SELECT a.*, d.pnl, d.stake, d.pnl / nullif(d.stake, 0) AS roi FROM (SELECT wallet, count(*)::DOUBLE / count(DISTINCT CAST(ts AS DATE))::DOUBLE AS trades_per_day FROM trades GROUP BY wallet) a
 LEFT JOIN (SELECT wallet, {P} AS pnl, {STAKE} AS stake FROM done GROUP BY wallet) d ON a.wallet = d.wallet""",
)(lambda v: f.trader_roi(done(v), v.trades))

query(
    "price_features",
    f"""SELECT t.token_id, coalesce(lo, t.price, 0) AS min_price, coalesce(hi, t.price, 0) AS max_price, coalesce(hi - lo, 0) AS price_range, round(coalesce(stddev, 0), 9) AS stddev,
 coalesce(fp, t.price, 0) AS first_price, coalesce(lp, t.price, 0) AS final_price, coalesce((lp - fp) / nullif(fp, 0), 0) AS price_return, coalesce(samples, 0) AS samples
 FROM market_tokens t LEFT JOIN (SELECT token_id, min(price) AS lo, max(price) AS hi, stddev_samp(price) AS stddev, arg_min(price, (ts, event_id)) AS fp, arg_max(price, (ts, event_id)) AS lp, count(*) AS samples FROM prices GROUP BY token_id) p ON t.token_id = p.token_id""",
)(lambda v: f.price_features(v.prices, v.market_tokens).withColumn("stddev", F.round("stddev", 9)))
query("price_timeseries", "SELECT token_id, ts, price, row_number() OVER (PARTITION BY token_id ORDER BY ts, event_id) AS n FROM prices")(
    lambda v: v.prices.selectExpr("token_id", "ts", "price", "row_number() OVER (PARTITION BY token_id ORDER BY ts, event_id) AS n")
)
BIN = "(SELECT token_id, date_trunc('{u}', ts)::TIMESTAMP AS bin, arg_max(price, (ts, event_id)) AS price FROM prices GROUP BY 1, 2)"
for unit in ("hour", "day"):
    query(f"price_resample_{unit}", f"SELECT * FROM {BIN.format(u=unit)} x")(lambda v, unit=unit: f.resample(v.prices, unit))
INFL = f"""
hourly AS (SELECT *, lag(price) OVER w AS before, lead(price) OVER w AS after FROM {BIN.format(u='hour')} x WINDOW w AS (PARTITION BY token_id ORDER BY bin)),
infl AS (SELECT * FROM (SELECT token_id, bin, price, abs(after - before) / greatest(before, 0.001::DOUBLE) AS magnitude, CASE WHEN price - before > 0 THEN 'peak' ELSE 'trough' END AS kind
 FROM hourly WHERE (price - before) * (after - price) < 0) y WHERE magnitude >= 0.05)"""
query("inflection_points", f"WITH {INFL} SELECT * FROM infl")(lambda v: f.inflections(v.prices))
query(
    "inflection_spaced",
    f"""WITH RECURSIVE {INFL}, nxt AS (SELECT a.token_id, a.bin, min(b.bin) AS following FROM infl a LEFT JOIN infl b ON a.token_id = b.token_id AND b.bin >= a.bin + INTERVAL '6' HOUR GROUP BY a.token_id, a.bin),
 s AS (SELECT token_id, min(bin) AS bin FROM infl GROUP BY token_id UNION ALL SELECT n.token_id, n.following FROM s JOIN nxt n ON s.token_id = n.token_id AND s.bin = n.bin WHERE n.following IS NOT NULL)
 SELECT i.* FROM infl i JOIN s ON i.token_id = s.token_id AND i.bin = s.bin""",
)(lambda v: f.spaced(f.inflections(v.prices)))
query(
    "inflection_features",
    f"""WITH {INFL} SELECT t.token_id, coalesce(points, 0) AS points, coalesce(peaks, 0) AS peaks, coalesce(troughs, 0) AS troughs, coalesce(avg_magnitude, 0) AS avg_magnitude, coalesce(max_magnitude, 0) AS max_magnitude
 FROM market_tokens t LEFT JOIN (SELECT token_id, count(*) AS points, count(CASE WHEN kind = 'peak' THEN 1 END) AS peaks, count(CASE WHEN kind = 'trough' THEN 1 END) AS troughs,
 {exact_sum("magnitude")} / count(*)::DOUBLE AS avg_magnitude, max(magnitude) AS max_magnitude FROM infl GROUP BY token_id) i ON t.token_id = i.token_id""",
)(lambda v: f.inflection_features(f.inflections(v.prices), v.market_tokens))
query(
    "major_moves",
    f"""SELECT * FROM (SELECT token_id, bin, price, before, price - before AS change, (price - before) / nullif(before, 0) AS change_pct,
 row_number() OVER (PARTITION BY token_id ORDER BY abs((price - before) / nullif(before, 0)) DESC NULLS LAST, bin) AS rank
 FROM (SELECT *, lag(price) OVER (PARTITION BY token_id ORDER BY bin) AS before FROM {BIN.format(u='hour')} x) y WHERE before IS NOT NULL) z WHERE rank <= 5""",
)(lambda v: f.major_moves(v.prices))
query(
    "price_twap",
    f"""SELECT token_id, {exact_sum("price * seconds")} / nullif(CAST(sum(seconds) AS DOUBLE), 0) AS twap, CAST(sum(seconds) AS BIGINT) AS seconds FROM (
 SELECT token_id, price, CAST(floor(epoch(lead(ts) OVER w)) - floor(epoch(ts)) AS BIGINT) AS seconds FROM prices WINDOW w AS (PARTITION BY token_id ORDER BY ts, event_id)) x GROUP BY token_id""",
)(lambda v: f.twap(v.prices))
MA = "SELECT token_id, bin, " + exact_sum("{x}", " OVER w") + " / count(*) OVER w AS {n} FROM {src} x WINDOW w AS (PARTITION BY token_id ORDER BY bin ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
query("price_moving_avg", MA.format(x="price", n="moving_avg", src=BIN.format(u="hour"), k=23))(lambda v: f.moving_average(v.prices))
query(
    "price_atr",
    MA.format(x="hi - lo", n="atr", src="(SELECT token_id, date_trunc('hour', ts)::TIMESTAMP AS bin, max(price) AS hi, min(price) AS lo FROM prices GROUP BY 1, 2)", k=13),
)(lambda v: f.average_true_range(v.prices))
query(
    "price_asof",
    """WITH u AS (SELECT token_id, event_id AS trade_id, ts FROM prices WHERE event_id % 3 = 0), p AS (SELECT * FROM prices WHERE event_id % 3 <> 0)
 SELECT u.token_id, u.trade_id, u.ts, arg_max(p.price, (p.ts, p.event_id)) AS asof_price FROM u LEFT JOIN p ON u.token_id = p.token_id AND p.ts <= u.ts GROUP BY 1, 2, 3""",
)(
    lambda v: f.price_asof(v.prices.where("event_id % 3 = 0").select("token_id", F.col("event_id").alias("trade_id"), "ts"), v.prices.where("event_id % 3 <> 0"))
)
query(
    "tag_statistics",
    """SELECT t.tag_id, t.name, coalesce(k.n, 0) AS markets, coalesce(k.n, 0)::DOUBLE / (SELECT count(*)
 FROM markets)::DOUBLE * 100 AS coverage_pct FROM tags t LEFT JOIN (SELECT tag_id, count(DISTINCT market_id) AS n FROM market_tags
 GROUP BY tag_id) k ON t.tag_id = k.tag_id WHERE t.is_active""",
)(lambda v: f.tag_statistics(v.markets, v.market_tags, v.tags))
TAG_IDS = [0, 3, 7, 11, 19]
query("available_tags", "SELECT name FROM tags WHERE is_active")(lambda v: f.available_tags(v.tags))
query(
    "price_ends",
    """SELECT token_id, event_id, price, first_value(price) OVER w AS first_price,
 last_value(price) OVER (PARTITION BY token_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_price
 FROM prices WINDOW w AS (PARTITION BY token_id ORDER BY ts, event_id)""",
)(lambda v: f.price_ends(v.prices))
query(
    "interval_stats",
    """WITH s AS (SELECT token_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs, ts, event_id FROM prices),
 g AS (SELECT token_id, secs - lag(secs) OVER (PARTITION BY token_id ORDER BY ts, event_id) AS gap FROM s)
 SELECT token_id, count(*) AS count, sum(gap)::DOUBLE / count(*)::DOUBLE AS average, median(gap)::DOUBLE AS median, min(gap) AS fastest, max(gap) AS slowest FROM g WHERE gap IS NOT NULL GROUP BY token_id""",
)(lambda v: f.interval_stats(v.prices))
query(
    "tag_one_hot",
    "SELECT m.market_id, " + ", ".join(f"CAST(coalesce(max(CASE WHEN t.tag_id = {i} THEN 1 END), 0) AS BIGINT) AS tag_t{i}" for i in TAG_IDS) + ", count(DISTINCT t.tag_id) AS tag_count FROM markets m LEFT JOIN market_tags g ON m.market_id = g.market_id LEFT JOIN tags t ON g.tag_id = t.tag_id AND t.is_active GROUP BY m.market_id",
)(
    lambda v: f.tag_one_hot(v.markets, v.market_tags, v.tags.select("tag_id", F.concat(F.lit("t"), "tag_id").alias("name"), "is_active"), [f"t{i}" for i in TAG_IDS])
)
query(
    "tag_confidence",
    """SELECT m.market_id, g.market_id IS NOT NULL AS has_tag, h.consensus, h.human_decision, h.decided_by FROM markets m LEFT
 JOIN (SELECT DISTINCT market_id FROM market_tags WHERE tag_id = 3) g ON m.market_id = g.market_id LEFT JOIN (SELECT * FROM history
 WHERE tag_id = 3) h ON m.market_id = h.market_id""",
)(lambda v: f.tag_confidence(v.markets, v.market_tags, v.history, 3))
