"""Copy-trading backtest: follow the best users' trades to the markets' resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import MONEY, copy_pnl_per_share, json_strings, money_avg, money_sum, share, stddev


def top_users(leaderboard: DataFrame, max_rank: int = 500, n: int = 500) -> DataFrame:
    """The latest snapshot of each wallet ranked within `max_rank`, the `n` best by profit."""
    latest = Window.partitionBy("wallet").orderBy(F.desc("month"), "rank", F.desc("pnl"))
    return (
        leaderboard.where(F.col("rank") <= max_rank)
        .withColumn("r", F.row_number().over(latest)).where("r = 1")
        .select("wallet", "trader_id", "rank", "pnl", "month")
        .orderBy(F.desc("pnl"), "wallet").limit(n)
    )


def user_trades(trades: DataFrame, users: DataFrame) -> DataFrame:
    """Trades of the followed users (one row a wallet)."""
    return trades.join(users.select("wallet", F.col("rank").alias("user_rank"), F.col("pnl").alias("user_pnl")), "wallet")


def resolution(markets: DataFrame) -> DataFrame:
    """Final prices by outcome; resolved if closed and one of them is 0 or 1."""
    prices, names = json_strings("outcome_prices"), json_strings("outcomes")
    parsed = markets.select(
        "market_id", "question", "category", "closed",
        F.get(names, F.lit(0)).alias("outcome_0"), F.get(names, F.lit(1)).alias("outcome_1"),
        F.get(prices, F.lit(0)).try_cast("double").alias("final_price_0"), F.get(prices, F.lit(1)).try_cast("double").alias("final_price_1"),
    )
    final = F.col("final_price_0").isin(0.0, 1.0) | F.col("final_price_1").isin(0.0, 1.0)
    return parsed.withColumn("is_resolved", F.col("closed") & F.coalesce(final, F.lit(False)))


def backtest_trades(copied: DataFrame, resolved: DataFrame) -> DataFrame:
    """Copied trades with final price and profit; both null while the market is open."""
    out = copied.join(resolved.drop("closed"), "market_id", "left")
    final = F.when(F.col("outcome") == F.col("outcome_0"), F.col("final_price_0")).when(F.col("outcome") == F.col("outcome_1"), F.col("final_price_1"))
    out = out.withColumn("is_resolved", F.coalesce("is_resolved", F.lit(False))).withColumn("final_price", F.when(F.col("is_resolved"), final))
    per_share = copy_pnl_per_share("side", "price", "final_price")
    return out.withColumns({"trade_value": F.col("price") * F.col("size"), "pnl_per_share": per_share, "pnl": per_share * F.col("size")}).select(
        "wallet", "trader_id", "market_id", "token_id", "side", "outcome", "price", "size", "ts", "category", "is_resolved",
        "final_price", "trade_value", "pnl_per_share", "pnl",
    )


def summary(bt: DataFrame, *keys: str) -> DataFrame:
    """Counts, wins, profit and volume of backtest trades, overall or by `keys`."""
    resolved = F.col("pnl").isNotNull()
    win = F.col("pnl") > 0
    out = bt.groupBy(*keys).agg(
        F.count("*").alias("total_trades"),
        F.count_if(resolved).alias("resolved_trades"),
        F.count_if(win).alias("winning_trades"),
        F.count_if(F.col("pnl") < 0).alias("losing_trades"),
        money_sum("pnl").alias("total_pnl"),
        money_avg("pnl").alias("avg_pnl"),
        money_sum("trade_value").alias("total_volume"),
        (share(F.count_if(win), F.count_if(resolved)) * 100).alias("win_rate_pct"),
    )
    return out


def overall(bt: DataFrame) -> DataFrame:
    """One row: the summary plus users, deviation of profit, and mean over deviation."""
    sd = stddev("pnl")
    return bt.agg(
        F.count_distinct("wallet").alias("users"),
        F.count("*").alias("total_trades"),
        F.count("pnl").alias("resolved_trades"),
        F.count_if(F.col("pnl") > 0).alias("winning_trades"),
        money_sum("pnl").alias("total_pnl"),
        money_avg("pnl").alias("avg_pnl"),
        sd.alias("pnl_stddev"),
        F.try_divide(money_avg("pnl"), sd).alias("sharpe"),
    )


def returns(bt: DataFrame, unit: str) -> DataFrame:
    """Trades, profit and volume per day or month of resolved trades."""
    return bt.where("pnl is not null").groupBy(F.date_trunc(unit, "ts").cast("date").alias("period")).agg(
        F.count("*").alias("trades"), F.count_if(F.col("pnl") > 0).alias("wins"),
        money_sum("pnl").alias("pnl"), money_sum("trade_value").alias("volume"),
    )


def monthly(bt: DataFrame) -> DataFrame:
    """Monthly returns with win rate, return on volume, label, and the running profit."""
    # The global window runs over months only.
    run = Window.orderBy("period")
    return returns(bt, "month").select(
        "period", "trades", "wins", "pnl", "volume",
        F.sum(F.col("pnl").cast(MONEY)).over(run).cast("double").alias("cumulative_pnl"),
        share(F.col("wins"), F.col("trades")).alias("win_rate"), share(F.col("pnl"), F.col("volume")).alias("roi"),
        F.date_format("period", "MMM yyyy").alias("label"),
    )


def fixed_size(bt: DataFrame, stake: float = 100.0) -> DataFrame:
    """The same trades with `stake` put on each: shares = stake / price, where the price is above 0."""
    shares = F.lit(stake) / F.col("price")
    return bt.where("price > 0").withColumns({"shares": shares, "fixed_pnl": F.col("pnl_per_share") * shares}).select(
        "wallet", "market_id", "side", "outcome", "price", "ts", "is_resolved", "final_price", "shares", "fixed_pnl"
    )


def fixed_summary(fixed: DataFrame, stake: float = 100.0) -> DataFrame:
    done = F.col("fixed_pnl").isNotNull()
    invested = F.count_if(done).cast("double") * stake
    return fixed.agg(
        F.count("*").alias("total_trades"), F.count_if(done).alias("resolved_trades"), F.count_if(F.col("fixed_pnl") > 0).alias("winning_trades"),
        money_sum("fixed_pnl").alias("total_pnl"), invested.alias("invested"),
        (F.try_divide(money_sum("fixed_pnl"), invested) * 100).alias("roi_pct"),
    )


def best_users(bt: DataFrame, least: int = 5, least_ranked: int = 10, n: int = 100) -> DataFrame:
    """Users with `least` resolved trades, ranked by profit, and by win rate from `least_ranked` on."""
    users = summary(bt, "wallet").where(F.col("resolved_trades") >= least)
    enough = F.col("resolved_trades") >= least_ranked
    by_pnl = Window.orderBy(F.desc("total_pnl"), "wallet")
    by_rate = Window.orderBy(F.when(enough, 0).otherwise(1), F.desc("win_rate_pct"), "wallet")
    return (
        users.withColumn("pnl_rank", F.row_number().over(by_pnl))
        .withColumn("win_rate_rank", F.when(enough, F.row_number().over(by_rate)))
        .where(F.col("pnl_rank") <= n)
        .select("wallet", "resolved_trades", "winning_trades", "total_pnl", "win_rate_pct", "pnl_rank", "win_rate_rank")
    )


def best_users_display(best: DataFrame, traders: DataFrame, n: int = 20) -> DataFrame:
    """The first `n` with a name, or a shortened wallet where there is none."""
    shown = F.coalesce(F.nullif("name", F.lit("")), F.concat(F.left("wallet", F.lit(12)), F.lit("...")))
    return best.where(F.col("pnl_rank") <= n).join(traders.select("wallet", "name"), "wallet", "left").select("pnl_rank", shown.alias("shown"), "total_pnl", "win_rate_pct")


def headline(bt: DataFrame) -> DataFrame:
    """One row: totals, return on volume, and the share of profitable months."""
    months = returns(bt, "month").agg(
        F.count("*").alias("months"), F.count_if(F.col("pnl") > 0).alias("profitable_months"), money_sum("pnl").alias("pnl"), money_sum("volume").alias("volume")
    )
    totals = summary(bt).select("total_trades", "resolved_trades", "winning_trades", "losing_trades")
    return totals.join(F.broadcast(months)).withColumns({"roi": share(F.col("pnl"), F.col("volume")), "profitable_share": share(F.col("profitable_months"), F.col("months"))})


def month_extremes(bt: DataFrame) -> DataFrame:
    months = returns(bt, "month")
    return months.agg(
        F.max_by("period", F.struct("pnl", "period")).alias("best_month"), F.max("pnl").alias("best_pnl"),
        F.min_by("period", F.struct("pnl", "period")).alias("worst_month"), F.min("pnl").alias("worst_pnl"),
    )
