"""Backtest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import money_sum
from tallyforge.operators import backtest as b
from tallyforge.registry import exact_sum, query

USERS = """
users AS (SELECT wallet, trader_id, rank, pnl, month FROM (
  SELECT *, row_number() OVER (PARTITION BY wallet ORDER BY month DESC, rank, pnl DESC) AS r FROM leaderboard WHERE rank <= 500) x
  WHERE r = 1 ORDER BY pnl DESC, wallet LIMIT 500)"""
COPIED = USERS + """,
copied AS (SELECT t.*, u.rank AS user_rank, u.pnl AS user_pnl FROM trades t JOIN users u ON t.wallet = u.wallet)"""
RESOLVED = """
resolved AS (SELECT *, closed AND coalesce(final_price_0 IN (0, 1) OR final_price_1 IN (0, 1), FALSE) AS is_resolved FROM (
  SELECT market_id, question, category, closed, outcomes->>0 AS outcome_0, outcomes->>1 AS outcome_1,
         TRY_CAST(outcome_prices->>0 AS DOUBLE) AS final_price_0, TRY_CAST(outcome_prices->>1 AS DOUBLE) AS final_price_1 FROM markets) x)"""
BT = f"WITH {COPIED}, {RESOLVED}," + """
bt AS (SELECT *, price * size AS trade_value, CASE WHEN side = 'BUY' THEN final_price - price ELSE price - final_price END AS pnl_per_share,
              CASE WHEN side = 'BUY' THEN final_price - price ELSE price - final_price END * size AS pnl
  FROM (SELECT c.wallet, c.trader_id, c.market_id, c.token_id, c.side, c.outcome, c.price, c.size, c.ts, r.category,
               coalesce(r.is_resolved, FALSE) AS is_resolved,
               CASE WHEN r.is_resolved THEN CASE WHEN c.outcome = r.outcome_0 THEN r.final_price_0 WHEN c.outcome = r.outcome_1 THEN r.final_price_1 END END AS final_price
        FROM copied c LEFT JOIN resolved r ON c.market_id = r.market_id) x)
"""
SUM_PNL = exact_sum("pnl")
SUM_VALUE = exact_sum("trade_value")
SUMMARY = f"""count(*) AS total_trades, count(pnl) AS resolved_trades, count(CASE WHEN pnl > 0 THEN 1 END) AS winning_trades,
 count(CASE WHEN pnl < 0 THEN 1 END) AS losing_trades, {SUM_PNL} AS total_pnl, {SUM_PNL} / nullif(count(pnl), 0)::DOUBLE AS avg_pnl,
 {SUM_VALUE} AS total_volume, count(CASE WHEN pnl > 0 THEN 1 END)::DOUBLE / nullif(count(pnl), 0)::DOUBLE * 100 AS win_rate_pct"""
MONTHS = f"""
months AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS period, count(*) AS trades, count(CASE WHEN pnl > 0 THEN 1 END) AS wins,
  {SUM_PNL} AS pnl, {SUM_VALUE} AS volume FROM bt WHERE pnl IS NOT NULL GROUP BY 1)"""
FIXED = """
fixed AS (SELECT wallet, market_id, side, outcome, price, ts, is_resolved, final_price, 100.0::DOUBLE / price AS shares,
  pnl_per_share * (100.0::DOUBLE / price) AS fixed_pnl FROM bt WHERE price > 0)"""
BEST = f"""
best AS (SELECT * FROM (SELECT wallet, resolved_trades, winning_trades, total_pnl, win_rate_pct,
  row_number() OVER (ORDER BY total_pnl DESC, wallet) AS pnl_rank,
  CASE WHEN resolved_trades >= 10 THEN row_number() OVER (ORDER BY CASE WHEN resolved_trades >= 10 THEN 0 ELSE 1 END, win_rate_pct DESC, wallet) END AS win_rate_rank
  FROM (SELECT wallet, {SUMMARY} FROM bt GROUP BY wallet) s WHERE resolved_trades >= 5) x WHERE pnl_rank <= 100)"""


def bt(v):
    return b.backtest_trades(b.user_trades(v.trades, b.top_users(v.leaderboard)), b.resolution(v.markets))


@query("bt_sources", f"SELECT market_id, side, count(*) AS trades, {exact_sum('price * size')} AS trade_value_usd FROM trades GROUP BY market_id, side")
def bt_sources(v):
    return v.trades.groupBy("market_id", "side").agg(F.count("*").alias("trades"), money_sum(F.col("price") * F.col("size")).alias("trade_value_usd"))


query("bt_top_users", f"WITH {USERS} SELECT * FROM users")(lambda v: b.top_users(v.leaderboard))
query(
    "bt_user_trades",
    f"WITH {COPIED} SELECT wallet, market_id, side, price, size, ts, user_rank, user_pnl FROM copied",
)(
    lambda v: b.user_trades(v.trades, b.top_users(v.leaderboard)).select("wallet", "market_id", "side", "price", "size", "ts", "user_rank", "user_pnl")
)
query("bt_resolution", f"WITH {RESOLVED} SELECT * FROM resolved")(lambda v: b.resolution(v.markets))
query("bt_trades", BT + "SELECT * FROM bt")(bt)
query("bt_user_summary", BT + f"SELECT wallet, {SUMMARY} FROM bt GROUP BY wallet")(lambda v: b.summary(bt(v), "wallet"))
query(
    "bt_category",
    BT + f"SELECT category, {SUMMARY} FROM bt WHERE category IS NOT NULL GROUP BY category",
)(lambda v: b.summary(bt(v).where("category is not null"), "category"))
query(
    "bt_overall",
    BT + f"""SELECT count(DISTINCT wallet) AS users, count(*) AS total_trades, count(pnl) AS resolved_trades, count(CASE WHEN pnl > 0 THEN 1 END) AS winning_trades,
 {SUM_PNL} AS total_pnl, {SUM_PNL} / count(pnl)::DOUBLE AS avg_pnl, round(stddev_samp(pnl), 9) AS pnl_stddev, round({SUM_PNL} / count(pnl)::DOUBLE / stddev_samp(pnl), 9) AS sharpe FROM bt""",
)(lambda v: b.overall(bt(v)).withColumns({c: F.round(c, 9) for c in ("pnl_stddev", "sharpe")}))
query(
    "bt_daily",
    BT + f"SELECT CAST(date_trunc('day', ts) AS DATE) AS period, count(*) AS trades, count(CASE WHEN pnl > 0 THEN 1 END) AS wins, {SUM_PNL} AS pnl, {SUM_VALUE} AS volume FROM bt WHERE pnl IS NOT NULL GROUP BY 1",
)(lambda v: b.returns(bt(v), "day"))
query(
    "bt_monthly",
    BT + f", {MONTHS} SELECT period, trades, wins, pnl, volume, {exact_sum("pnl", " OVER (ORDER BY period)")} AS cumulative_pnl, wins::DOUBLE / trades AS win_rate, pnl / volume AS roi, strftime(period, '%b %Y') AS label FROM months",
)(lambda v: b.monthly(bt(v)))
query("bt_fixed_trades", BT + f", {FIXED} SELECT * FROM fixed")(lambda v: b.fixed_size(bt(v)))
SUM_FIXED = exact_sum("fixed_pnl")
query(
    "bt_fixed_summary",
    BT + f", {FIXED} SELECT count(*) AS total_trades, count(fixed_pnl) AS resolved_trades, count(CASE WHEN fixed_pnl > 0 THEN 1 END) AS winning_trades, {SUM_FIXED} AS total_pnl, count(fixed_pnl)::DOUBLE * 100 AS invested, {SUM_FIXED} / (count(fixed_pnl)::DOUBLE * 100) * 100 AS roi_pct FROM fixed",
)(lambda v: b.fixed_summary(b.fixed_size(bt(v))))
query("bt_best_users", BT + f", {BEST} SELECT * FROM best")(lambda v: b.best_users(bt(v)))
query(
    "bt_best_users_display",
    BT + f", {BEST} SELECT pnl_rank, coalesce(nullif(t.name, ''), left(best.wallet, 12) || '...') AS shown, total_pnl, win_rate_pct FROM best LEFT JOIN traders t ON best.wallet = t.wallet WHERE pnl_rank <= 20",
)(lambda v: b.best_users_display(b.best_users(bt(v)), v.traders))
query(
    "bt_trades_summary",
    BT + f"SELECT count(*) AS trades, count(DISTINCT wallet) AS wallets, count(DISTINCT market_id) AS markets, {SUM_VALUE} AS volume, min(ts) AS first_ts, max(ts) AS last_ts FROM bt",
)(
    lambda v: bt(v).agg(
        F.count("*").alias("trades"), F.count_distinct("wallet").alias("wallets"), F.count_distinct("market_id").alias("markets"),
        money_sum("trade_value").alias("volume"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )
)
query(
    "bt_headline",
    BT + f""", {MONTHS}, m AS (SELECT count(*) AS months, count(CASE WHEN pnl > 0 THEN 1 END) AS profitable_months, {SUM_PNL} AS pnl, {exact_sum("volume")} AS volume FROM months)
 SELECT s.total_trades, s.resolved_trades, s.winning_trades, s.losing_trades, m.*, m.pnl / m.volume AS roi, m.profitable_months::DOUBLE / m.months AS profitable_share FROM (SELECT {SUMMARY} FROM bt) s, m""",
)(lambda v: b.headline(bt(v)))
query(
    "bt_month_extremes",
    BT + f""", {MONTHS} SELECT (SELECT period FROM months ORDER BY pnl DESC, period DESC LIMIT 1) AS best_month, max(pnl) AS best_pnl, (SELECT period FROM months ORDER BY pnl, period LIMIT 1) AS worst_month, min(pnl) AS worst_pnl FROM months""",
)(lambda v: b.month_extremes(bt(v)))
