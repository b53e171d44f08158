"""Exploratory trade analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import MONEY, money_avg, money_sum, share
from tallyforge.sources.shared import dealt, join_dealt, slices


def value() -> Column:
    return F.col("price") * F.col("size")


def trade_stats(trades: DataFrame) -> DataFrame:
    return trades.agg(
        F.count("*").alias("trades"), F.count_distinct("wallet").alias("traders"), F.count_distinct("market_id").alias("markets"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), money_sum(value()).alias("volume"),
    )


def top_traders(trades: DataFrame, n: int = 50) -> DataFrame:
    out = trades.groupBy("wallet").agg(
        F.count("*").alias("trades"), money_sum(value()).alias("volume"), money_avg(value()).alias("avg_value"), F.count_distinct("market_id").alias("markets"),
    )
    return out.orderBy(F.desc("volume"), "wallet").limit(n)


def top_traders_in(trades: DataFrame, start=None, end=None, n: int = 25) -> DataFrame:
    """Top traders within [start, end), with the volumes they bought and sold."""
    if start is not None:
        trades = trades.where(F.col("ts") >= start)
    if end is not None:
        trades = trades.where(F.col("ts") < end)
    out = trades.groupBy("wallet").agg(
        F.count("*").alias("trades"), money_sum(value()).alias("volume"),
        F.coalesce(money_sum(F.when(F.col("side") == "BUY", value())), F.lit(0.0)).alias("bought"),
        F.coalesce(money_sum(F.when(F.col("side") == "SELL", value())), F.lit(0.0)).alias("sold"),
    )
    return out.orderBy(F.desc("volume"), "wallet").limit(n)


def before_after(trades: DataFrame, split: Column, least: int = 10, n: int = 30) -> DataFrame:
    """Volumes before and after `split`, in one pass; the change in per cent is null without a before."""
    early = F.col("ts") < split
    out = trades.groupBy("wallet").agg(
        F.count_if(early).alias("trades_before"), F.count_if(~early).alias("trades_after"),
        F.coalesce(money_sum(F.when(early, value())), F.lit(0.0)).alias("volume_before"),
        F.coalesce(money_sum(F.when(~early, value())), F.lit(0.0)).alias("volume_after"),
    )
    out = out.where(F.col("trades_before") + F.col("trades_after") > least)
    out = out.withColumn("change", F.col("volume_after") - F.col("volume_before"))
    out = out.withColumn("change_pct", F.try_divide("change", "volume_before") * 100)
    return out.orderBy(F.desc(F.col("volume_before") + F.col("volume_after")), "wallet").limit(n)


def category_counts(markets: DataFrame) -> DataFrame:
    return markets.where("category is not null and category <> ''").groupBy("category").agg(F.count("*").alias("markets"))


def with_category(trades: DataFrame, markets: DataFrame) -> DataFrame:
    return trades.join(markets.select("market_id", "category"), "market_id")


def category_stats(trades: DataFrame, markets: DataFrame, least: int = 10) -> DataFrame:
    """Trades, different traders and markets, and volume of each category.

    One trade of each market is marked, and trades are summed by category and wallet in slices; so no
    row is multiplied to count traders and markets apart.
    """
    n = slices(trades)
    rows = join_dealt(n, trades.select("market_id", "wallet", value().alias("value")), markets.select("market_id", "category"), ["market_id"])
    of_market = Window.partitionBy("market_id", "category").orderBy("market_id")
    marked = rows.select("category", "wallet", "value", (F.row_number().over(of_market) == 1).alias("first"))
    per_wallet = dealt(n, marked, "category", "wallet").groupBy("category", "wallet").agg(
        F.count("*").alias("n"), F.count_if("first").alias("firsts"), F.count("value").alias("valued"), F.sum(F.col("value").cast(MONEY)).alias("v")
    )
    volume = F.sum("v").cast("double")
    return per_wallet.groupBy("category").agg(
        F.sum("n").alias("trades"), F.count("wallet").alias("traders"), F.sum("firsts").alias("markets"), volume.alias("volume"),
        F.try_divide(volume, F.sum("valued").cast("double")).alias("avg_value"),
    ).where(F.col("trades") >= least)


def by_category(trades: DataFrame, markets: DataFrame) -> DataFrame:
    """Trades and volume of each trader in each category."""
    return with_category(trades, markets).groupBy("category", "wallet").agg(F.count("*").alias("trades"), money_sum(value()).alias("volume"))


def top_per_category(trades: DataFrame, markets: DataFrame, n: int = 5) -> DataFrame:
    order = Window.partitionBy("category").orderBy(F.desc("volume"), "wallet")
    return by_category(trades, markets).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def category_period(trades: DataFrame, markets: DataFrame, split: Column) -> DataFrame:
    period = F.when(F.col("ts") < split, "before").otherwise("after")
    return with_category(trades, markets).groupBy("category", period.alias("period")).agg(
        F.count("*").alias("trades"), F.count_distinct("wallet").alias("traders"), money_sum(value()).alias("volume")
    )


def category_pivot(periods: DataFrame) -> DataFrame:
    """A row per category, three measures for each period, 0 where there is none."""
    out = periods.groupBy("category").pivot("period", ["before", "after"]).agg(
        F.first("trades").alias("trades"), F.first("traders").alias("traders"), F.first("volume").alias("volume")
    )
    return out.fillna(0)


def specialists(trades: DataFrame, markets: DataFrame, least_share: float = 0.5, least_volume: float = 1000.0, n: int = 30) -> DataFrame:
    """The `n` traders of most volume in a category that holds over `least_share` of all their volume, which is above `least_volume`."""
    per = by_category(trades, markets)
    whole = F.sum(F.col("volume").cast(MONEY)).over(Window.partitionBy("wallet")).cast("double")
    per = per.withColumn("total_volume", whole).withColumn("share", share(F.col("volume"), F.col("total_volume")))
    return per.where((F.col("share") > least_share) & (F.col("total_volume") > least_volume)).orderBy(F.desc("volume"), "wallet", "category").limit(n)


def period_totals(trades: DataFrame, split: Column) -> DataFrame:
    early = F.col("ts") < split
    return trades.agg(F.count_if(early).alias("before"), F.count_if(~early).alias("after"))


def distinct_trade_value(trades: DataFrame) -> DataFrame:
    """Value of the distinct (wallet, market, time, price, size) trades."""
    once = trades.select("wallet", "market_id", "ts", "price", "size").distinct()
    return once.agg(F.count("*").alias("trades"), money_sum(value()).alias("value"))


def market_sample(trades: DataFrame, markets: DataFrame, n: int = 100) -> DataFrame:
    """The first `n` trades of active markets, by time and then by every shown column."""
    m = markets.where("active").select("market_id", "question", "category")
    shown = ["ts", "wallet", "market_id", "side", "price", "size", "outcome", "question", "category"]
    return trades.where("outcome is not null").join(m, "market_id").select(shown).orderBy(*shown).limit(n)


def daily_market_summary(trades: DataFrame) -> DataFrame:
    """Per market and day: trades, volume, traders, and the day's open, high, low and close price.

    At the day's first instant the lowest price opens, at the last one the highest closes.
    Summing by instant first leaves buffers of plain numbers, so every step is a hash
    aggregation; wallets are counted on rows of their own.
    """
    day = F.date_trunc("day", "ts").cast("date").alias("day")
    instants = trades.groupBy("market_id", day, "ts").agg(
        F.count("*").alias("n"), F.sum(value().cast(MONEY)).alias("v"), F.min("price").alias("lo"), F.max("price").alias("hi")
    )
    prices = instants.groupBy("market_id", "day").agg(
        F.sum("n").alias("trades"), F.sum("v").cast("double").alias("volume"),
        F.min_by("lo", "ts").alias("open"), F.max("hi").alias("high"), F.min("lo").alias("low"), F.max_by("hi", "ts").alias("close"),
    )
    people = trades.select("market_id", day, "wallet").distinct().groupBy("market_id", "day").agg(F.count("wallet").alias("traders"))
    return prices.join(people, ["market_id", "day"])


def both_periods(trades: DataFrame, split: Column) -> DataFrame:
    """Wallets that traded before and after `split`."""
    return trades.where(F.col("ts") < split).select("wallet").intersect(trades.where(F.col("ts") >= split).select("wallet"))


def category_rollup(trades: DataFrame, markets: DataFrame) -> DataFrame:
    """Trades and volume by category and month, by category, and overall."""
    month = F.date_trunc("month", "ts").cast("date")
    return with_category(trades, markets).withColumn("month", month).rollup("category", "month").agg(
        F.grouping_id().alias("level"), F.count("*").alias("trades"), money_sum(value()).alias("volume")
    )
