"""Market, trader, price and tag features; every operator handles all markets, traders or tokens at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import MONEY, money_avg, money_sum, pnl, share, stddev
from tallyforge.operators.analysis import value
from tallyforge.operators.selection import median
from tallyforge.sources.shared import dealt, drop_written, slices, written

MARKET_COLUMNS = [
    "market_id", "condition_id", "question", "category", "volume", "liquidity", "active", "closed", "token_count", "winning_outcome",
    "is_resolved", "trade_count", "unique_traders", "duration_days",
]
TRADER_COLUMNS = [
    "wallet", "trade_count", "volume", "avg_value", "markets", "buys", "sells", "buy_ratio", "first_ts", "last_ts", "trading_days", "trader_id",
]


def market_features(
    markets: DataFrame, tokens: DataFrame, trades: DataFrame, *, category: str | None = None, closed_only: bool = False, resolved_only: bool = False
) -> DataFrame:
    """One row per market (MARKET_COLUMNS).  Traders are counted in both roles; a market without trades has 0."""
    per_token = tokens.groupBy("market_id").agg(
        F.count("*").alias("token_count"), F.max(F.when(F.col("winner"), F.col("outcome"))).alias("winning_outcome"), F.bool_or("winner").alias("is_resolved")
    )
    # Each trade has two roles, so one pass counts trades and people: those of a market once each, then the market.
    both = F.array(*[F.struct(F.lit(maker).alias("maker"), F.col(who).alias("who")) for maker, who in ((True, "trader_id"), (False, "taker_id"))])
    roles = dealt(slices(trades), trades.select("market_id", F.inline(both)), "market_id", "maker", "who")
    once = roles.groupBy("market_id", "maker", "who").agg(F.count("*").alias("n"))
    people = once.groupBy("market_id").agg(F.count("who").alias("unique_traders"), F.sum(F.when(F.col("maker"), F.col("n")).otherwise(0)).alias("trade_count"))
    if category is not None:
        markets = markets.where(F.col("category") == category)
    if closed_only:
        markets = markets.where("closed")
    out = (
        markets.join(per_token, "market_id", "left").join(people, "market_id", "left")
        .withColumn("duration_days", F.datediff("end_ts", "start_ts"))
        .fillna(0, ["token_count", "trade_count", "unique_traders"]).withColumn("is_resolved", F.coalesce("is_resolved", F.lit(False)))
    )
    return (out.where("is_resolved") if resolved_only else out).select(MARKET_COLUMNS)


def by_tag(features: DataFrame, market_tags: DataFrame, tags: DataFrame, name: str) -> DataFrame:
    carrying = market_tags.join(F.broadcast(tags.where(F.col("name") == name).select("tag_id")), "tag_id", "left_semi")
    return features.join(carrying, "market_id", "left_semi")


def resolved_trades(trades: DataFrame, tokens: DataFrame, strict: bool = True) -> DataFrame:
    """Trades with `won` and `pnl`.  A market counts as resolved if one of its tokens won; unless `strict`, always."""
    won = tokens.select("token_id", "market_id", F.col("winner").alias("won"))
    if strict:
        won = won.join(tokens.where("winner").select("market_id").distinct(), "market_id", "left_semi")
    out = trades.join(won.select("token_id", "won"), "token_id")
    return out.withColumn("pnl", pnl("side", "won", "price", "size"))


def top_per_market(trades: DataFrame, measure: Column, name: str, n: int = 10) -> DataFrame:
    """The `n` traders of each market with the highest `measure`."""
    order = Window.partitionBy("market_id").orderBy(F.desc(name), "wallet")
    return (
        trades.groupBy("market_id", "wallet").agg(measure.alias(name)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    )


def with_top_list(features: DataFrame, ranked: DataFrame) -> DataFrame:
    """`features` plus top_traders: the ranked wallets of each market in order, [] if none."""
    lists = ranked.groupBy("market_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "wallet"))), lambda x: x["wallet"]).alias("top_traders"))
    return features.join(lists, "market_id", "left").withColumn("top_traders", F.coalesce("top_traders", F.array().cast("array<string>")))


def trader_features(traders: DataFrame, trades: DataFrame, min_trades: int = 1) -> DataFrame:
    """One row per trader with at least `min_trades` (TRADER_COLUMNS).

    Trades are summed by trader and market first, so no row is multiplied to count markets and
    days apart.
    """
    per_market = trades.groupBy("trader_id", "market_id").agg(
        F.count("*").alias("n"), F.count(value()).alias("valued"), F.sum(value().cast(MONEY)).alias("v"),
        F.count_if(F.col("side") == "BUY").alias("b"), F.count_if(F.col("side") == "SELL").alias("s"), F.min("ts").alias("lo"), F.max("ts").alias("hi"),
    )
    days = trades.select("trader_id", F.col("ts").cast("date").alias("day")).distinct().groupBy("trader_id").agg(F.count("day").alias("trading_days"))
    volume = F.sum("v").cast("double")
    agg = per_market.groupBy("trader_id").agg(
        F.sum("n").alias("trade_count"), volume.alias("volume"), F.try_divide(volume, F.sum("valued").cast("double")).alias("avg_value"), F.count("market_id").alias("markets"),
        F.sum("b").alias("buys"), F.sum("s").alias("sells"), share(F.sum("b"), F.sum("n")).alias("buy_ratio"), F.min("lo").alias("first_ts"), F.max("hi").alias("last_ts"),
    ).join(days, "trader_id")
    return traders.select("trader_id", "wallet").join(agg.where(F.col("trade_count") >= min_trades), "trader_id").select(TRADER_COLUMNS)


def trader_performance(resolved: DataFrame, min_resolved: int = 5) -> DataFrame:
    win = F.col("pnl") > 0
    return resolved.groupBy("wallet").agg(
        F.count("*").alias("resolved_trades"), money_sum("pnl").alias("total_pnl"), share(F.count_if(win), F.count("*")).alias("win_rate")
    ).where(F.col("resolved_trades") >= min_resolved)


def both_roles(trades: DataFrame) -> DataFrame:
    """Each trade once for each person in it: as maker, and as taker if that is someone else."""
    people = F.array_distinct(F.array(F.concat(F.lit("m"), "trader_id"), F.concat(F.lit("t"), "taker_id")))
    return trades.withColumn("person", F.explode(people))


def best_trades(resolved: DataFrame, n: int = 5) -> DataFrame:
    shown = ["market_id", "token_id", "side", "price", "size", "ts", "pnl"]
    order = Window.partitionBy("person").orderBy(F.desc("pnl"), "ts", "market_id", "token_id", "side", "price", "size")
    return both_roles(resolved).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("person", "rank", *shown)


def largest_return(resolved: DataFrame) -> DataFrame:
    return both_roles(resolved).groupBy("person").agg(F.max("pnl").alias("pnl"), F.max_by("market_id", F.struct("pnl", "market_id")).alias("market_id"))


def top_groups(resolved: DataFrame, groups: DataFrame, group: str, n: int = 3) -> DataFrame:
    """Per person the `n` groups (category or tag) of the highest profit, with trades, volume and win rate; see `top_groups_of`."""
    return top_groups_of(both_roles(resolved.select("trader_id", "taker_id", "market_id", "price", "size", "pnl")), groups, group, n)


def top_groups_of(people: DataFrame, groups: DataFrame, group: str, n: int = 3) -> DataFrame:
    """`top_groups` of trades that have their `person`.

    `groups` has market_id and `group`.  A trade carries all groups of its market as one list,
    and is summed by person and list; only these sums go to one place a person and are
    multiplied by the groups there.
    """
    lists = groups.groupBy("market_id").agg(F.array_sort(F.collect_list(F.struct(group))).alias("__groups"))
    sums = people.join(lists, "market_id").groupBy("person", "__groups").agg(
        F.count("*").alias("trades"), F.sum(value().cast(MONEY)).alias("volume"), F.sum(F.col("pnl").cast(MONEY)).alias("total_pnl"), F.count_if(F.col("pnl") > 0).alias("wins")
    )
    order = Window.partitionBy("person").orderBy(F.desc("total_pnl"), group)
    total = lambda c: F.sum(c).cast("double").alias(c)
    return (
        sums.repartition("person").withColumn("__g", F.explode("__groups")).groupBy("person", F.col(f"__g.{group}").alias(group))
        .agg(F.sum("trades").alias("trades"), total("volume"), total("total_pnl"), share(F.sum("wins"), F.sum("trades")).alias("win_rate"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    )


def trader_profile(traders: DataFrame, trades: DataFrame, tokens: DataFrame, markets: DataFrame, tags: DataFrame, market_tags: DataFrame) -> DataFrame:
    """One nested record per trader: features, performance, largest return, top 3 categories and tags, and `found`.

    Traders are makers, so trades count for nobody else here; they and their results are written once.
    """
    trades = written(trades.select("trader_id", "wallet", "market_id", "token_id", "side", "price", "size", "ts"), "trades")
    done = resolved_trades(trades.drop("ts"), tokens).select("trader_id", "wallet", "market_id", "price", "size", "pnl")
    done = written(done.withColumn("person", F.concat(F.lit("m"), "trader_id")).drop("trader_id"), "resolved")
    cats = top_groups_of(done, markets.select("market_id", "category"), "category")
    active = market_tags.join(F.broadcast(tags.where("is_active").select("tag_id", F.col("name").alias("tag"))), "tag_id").select("market_id", "tag")
    tagged = top_groups_of(done, active, "tag")
    largest = done.groupBy("person").agg(F.max("pnl").alias("largest_pnl"), F.max_by("market_id", F.struct("pnl", "market_id")).alias("largest_market"))
    lists = lambda d, g: d.groupBy("person").agg(F.array_sort(F.collect_list(F.struct("rank", g, "trades", "total_pnl", "win_rate"))).alias(f"top_{g}"))
    return (
        traders.select("trader_id", "wallet", F.concat(F.lit("m"), "trader_id").alias("person"))
        .join(trader_features(traders, trades).drop("wallet"), "trader_id", "left").join(trader_performance(done, 1), "wallet", "left")
        .join(largest, "person", "left")
        .join(lists(cats, "category"), "person", "left").join(lists(tagged, "tag"), "person", "left")
        .withColumn("found", F.col("trade_count").isNotNull()).drop("person")
    )


def trader_roi(resolved: DataFrame, all_trades: DataFrame) -> DataFrame:
    """Profit over stake (buys stake size * price, sells size * (1 - price)), and trades per trading day."""
    stake = F.when(F.col("side") == "BUY", value()).otherwise(F.col("size") * (1 - F.col("price")))
    r = resolved.groupBy("wallet").agg(money_sum("pnl").alias("pnl"), money_sum(stake).alias("stake"))
    f = all_trades.groupBy("wallet").agg(share(F.count("*"), F.count_distinct(F.col("ts").cast("date"))).alias("trades_per_day"))
    return f.join(r, "wallet", "left").withColumn("roi", F.try_divide("pnl", "stake"))


def price_features(prices: DataFrame, tokens: DataFrame, min_samples: int = 1) -> DataFrame:
    """Range, deviation, first and final price, return; tokens without prices show their current one (0 if unknown)."""
    p = prices.groupBy("token_id").agg(
        F.min("price").alias("lo"), F.max("price").alias("hi"), stddev("price").alias("stddev"),
        F.min_by("price", F.struct("ts", "event_id")).alias("first_price"), F.max_by("price", F.struct("ts", "event_id")).alias("final_price"), F.count("*").alias("samples"),
    ).where(F.col("samples") >= min_samples)
    now = F.coalesce("price", F.lit(0.0))
    out = tokens.select("token_id", "price").join(p, "token_id", "left")
    return out.select(
        "token_id", F.coalesce("lo", now).alias("min_price"), F.coalesce("hi", now).alias("max_price"), F.coalesce(F.col("hi") - F.col("lo"), F.lit(0.0)).alias("price_range"),
        F.coalesce("stddev", F.lit(0.0)).alias("stddev"), F.coalesce("first_price", now).alias("first_price"), F.coalesce("final_price", now).alias("final_price"),
        F.coalesce((F.col("final_price") - F.col("first_price")) / F.nullif("first_price", F.lit(0.0)), F.lit(0.0)).alias("price_return"), F.coalesce("samples", F.lit(0)).alias("samples"),
    )


PRICE_COLUMNS = ["token_id", "min_price", "max_price", "price_range", "stddev", "first_price", "final_price", "price_return", "samples"]


def price_ends(prices: DataFrame) -> DataFrame:
    """Each price beside the first and last of its token: the first by the default frame, the last over the whole partition."""
    w = Window.partitionBy("token_id").orderBy("ts", "event_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return prices.select("token_id", "event_id", "price", F.first("price").over(w).alias("first_price"), F.last("price").over(whole).alias("last_price"))


def interval_stats(prices: DataFrame) -> DataFrame:
    """Per token, the seconds between successive prices: count, average, median, fastest and slowest."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    gaps = prices.select("token_id", (at - F.lag(at).over(Window.partitionBy("token_id").orderBy("ts", "event_id"))).alias("gap")).where("gap is not null")
    sums = gaps.groupBy("token_id").agg(
        F.count("*").alias("count"), F.try_divide(F.sum("gap").cast("double"), F.count("*").cast("double")).alias("average"),
        F.min("gap").alias("fastest"), F.max("gap").alias("slowest"),
    )
    middle = median(gaps, ["token_id"], F.col("gap")).select("token_id", "median")
    return sums.join(middle, "token_id").select("token_id", "count", "average", "median", "fastest", "slowest")


def available_tags(tags: DataFrame) -> DataFrame:
    """Names of the active tags, in order."""
    return tags.where("is_active").select("name").orderBy("name")


def resample(prices: DataFrame, unit: str) -> DataFrame:
    """The last price of each bin; empty bins are dropped."""
    return prices.groupBy("token_id", F.date_trunc(unit, "ts").alias("bin")).agg(F.max_by("price", F.struct("ts", "event_id")).alias("price"))


def inflections(prices: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Turns of the hourly series whose swing over both neighbours reaches `threshold`."""
    w = Window.partitionBy("token_id").orderBy("bin")
    p = resample(prices, "hour").withColumns({"before": F.lag("price").over(w), "after": F.lead("price").over(w)})
    up, down = F.col("price") - F.col("before"), F.col("after") - F.col("price")
    size = F.abs(F.col("after") - F.col("before")) / F.greatest("before", F.lit(0.001))
    return p.where(up * down < 0).select("token_id", "bin", "price", size.alias("magnitude"), F.when(up > 0, "peak").otherwise("trough").alias("kind")).where(F.col("magnitude") >= threshold)


def spaced(points: DataFrame, hours: int = 6) -> DataFrame:
    """Greedy spacing: a point stays if it lies at least `hours` after the last one that stayed.

    A running window over points and the moments from which each lets others follow gives
    every point its next one; bins of a token are distinct.  From the first point of a
    token on, marks spread along these jumps, whose length doubles each round: a mark at a
    point marks the point one jump on, and jumps are joined to themselves.  So there are as
    many rounds as the binary logarithm of the points that stay, and no token is gathered.
    Points, jumps and marks are joined where they lie: broadcasts would send them through the
    driver in every round.
    """
    at = F.unix_timestamp(F.col("bin").cast("timestamp"))
    rows = written(points.withColumn("at", at), "points")
    moments = rows.select("token_id", "at", (F.col("at") + hours * 3600).alias("key"), F.lit(None).cast("long").alias("point"))
    both = moments.unionByName(rows.select("token_id", F.lit(None).cast("long").alias("at"), F.col("at").alias("key"), F.col("at").alias("point")))
    back = Window.partitionBy("token_id").orderBy(F.desc("key"), F.col("point").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    jumps = both.withColumn("onto", F.last("point", ignorenulls=True).over(back)).where("at is not null").select("token_id", "at", "onto")
    first = rows.groupBy("token_id").agg(F.min("at").alias("first"))
    nodes = written(jumps.join(first.hint("merge"), "token_id").select("token_id", "at", "onto", (F.col("at") == F.col("first")).alias("kept")), "jumps")
    while True:
        onward = nodes.select("token_id", F.col("at").alias("onto"), F.col("onto").alias("beyond"))
        reached = nodes.where("kept and onto is not null").select("token_id", F.col("onto").alias("at"), F.lit(True).alias("hit"))
        step = nodes.join(onward.hint("merge"), ["token_id", "onto"], "left").join(reached.hint("merge"), ["token_id", "at"], "left")
        step = written(step.select("token_id", "at", F.col("beyond").alias("onto"), (F.col("kept") | F.coalesce("hit", F.lit(False))).alias("kept")), "jumps")
        done = step.where("kept and onto is not null").isEmpty()
        drop_written(nodes)
        nodes = step
        if done:
            break
    return rows.join(nodes.where("kept").select("token_id", "at").hint("merge"), ["token_id", "at"]).drop("at")


def inflection_features(points: DataFrame, tokens: DataFrame) -> DataFrame:
    agg = points.groupBy("token_id").agg(
        F.count("*").alias("points"), F.count_if(F.col("kind") == "peak").alias("peaks"), F.count_if(F.col("kind") == "trough").alias("troughs"),
        money_avg("magnitude").alias("avg_magnitude"), F.max("magnitude").alias("max_magnitude"),
    )
    return tokens.select("token_id").join(agg, "token_id", "left").fillna(0)


def major_moves(prices: DataFrame, n: int = 5) -> DataFrame:
    w = Window.partitionBy("token_id").orderBy("bin")
    p = resample(prices, "hour").withColumn("before", F.lag("price").over(w)).where("before is not null")
    p = p.withColumn("change", F.col("price") - F.col("before")).withColumn("change_pct", F.col("change") / F.nullif("before", F.lit(0.0)))
    rank = F.row_number().over(Window.partitionBy("token_id").orderBy(F.abs("change_pct").desc_nulls_last(), "bin"))
    return p.withColumn("rank", rank).where(F.col("rank") <= n)


def twap(prices: DataFrame) -> DataFrame:
    """Price weighted by the seconds it stood; tokens whose prices share one instant have none."""
    w = Window.partitionBy("token_id").orderBy("ts", "event_id")
    seconds = F.unix_timestamp(F.lead("ts").over(w).cast("timestamp")) - F.unix_timestamp(F.col("ts").cast("timestamp"))
    p = prices.withColumn("seconds", seconds)
    num = money_sum(F.col("price") * F.col("seconds"))
    return p.groupBy("token_id").agg(F.try_divide(num, F.sum("seconds").cast("double")).alias("twap"), F.sum("seconds").alias("seconds"))


def moving_average(prices: DataFrame, bins: int = 24) -> DataFrame:
    w = Window.partitionBy("token_id").orderBy("bin").rowsBetween(1 - bins, 0)
    x = F.col("price").cast(MONEY)
    return resample(prices, "hour").select("token_id", "bin", (F.sum(x).over(w).cast("double") / F.count(x).over(w).cast("double")).alias("moving_avg"))


def average_true_range(prices: DataFrame, bins: int = 14) -> DataFrame:
    hourly = prices.groupBy("token_id", F.date_trunc("hour", "ts").alias("bin")).agg(F.max("price").alias("hi"), F.min("price").alias("lo"))
    w = Window.partitionBy("token_id").orderBy("bin").rowsBetween(1 - bins, 0)
    x = (F.col("hi") - F.col("lo")).cast(MONEY)
    return hourly.select("token_id", "bin", (F.sum(x).over(w).cast("double") / F.count(x).over(w).cast("double")).alias("atr"))


def price_asof(trades: DataFrame, prices: DataFrame) -> DataFrame:
    """Each trade with the last price of its token at or before it: one union and one window, no range join.

    A token's rows are cut into days; a day's trades before its first price take the last price of an earlier day.
    """
    t = trades.withColumn("q", F.lit(1))
    p = prices.select("token_id", "ts", F.struct("ts", "event_id", "price").alias("p"), F.lit(0).alias("q"))
    both = t.unionByName(p, allowMissingColumns=True).withColumn("day", F.col("ts").cast("date"))
    within = Window.partitionBy("token_id", "day").orderBy("ts", "q").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("near", F.max("p").over(within))
    # One row per token and day carries the last known price over to later days.
    days = both.groupBy("token_id", "day").agg(F.max("p").alias("last"))
    earlier = Window.partitionBy("token_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("carried", F.max("last").over(earlier)).select("token_id", "day", "carried")
    out = both.where("q = 1").join(days, ["token_id", "day"])
    return out.withColumn("asof_price", F.coalesce("near", "carried")["price"]).drop("q", "p", "near", "carried", "day")


def tag_one_hot(markets: DataFrame, market_tags: DataFrame, tags: DataFrame, names: list[str]) -> DataFrame:
    """One 0/1 column tag_<name> per active tag in `names`, and tag_count."""
    active = F.broadcast(tags.where("is_active").select("tag_id", "name"))
    pairs = market_tags.join(active, "tag_id").select("market_id", "name").distinct()
    wide = pairs.groupBy("market_id").pivot("name", names).agg(F.count(F.lit(1)))
    wide = wide.select("market_id", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(f"tag_{n}") for n in names])
    count = pairs.groupBy("market_id").agg(F.count("*").alias("tag_count"))
    return markets.select("market_id").join(wide, "market_id", "left").join(count, "market_id", "left").fillna(0)


def tag_confidence(markets: DataFrame, market_tags: DataFrame, history: DataFrame, tag_id: int) -> DataFrame:
    """Every market for one tag: whether it has it, and what judges and people said."""
    has = market_tags.where(F.col("tag_id") == tag_id).select("market_id", F.lit(True).alias("has_tag")).distinct()
    said = history.where(F.col("tag_id") == tag_id).select("market_id", "consensus", "human_decision", "decided_by")
    return markets.select("market_id").join(has, "market_id", "left").join(said, "market_id", "left").withColumn("has_tag", F.coalesce("has_tag", F.lit(False)))


def tag_statistics(markets: DataFrame, market_tags: DataFrame, tags: DataFrame) -> DataFrame:
    """Markets per active tag and the share of all markets in per cent."""
    total = markets.agg(F.count("*").alias("total"))
    per = market_tags.groupBy("tag_id").agg(F.count_distinct("market_id").alias("markets"))
    out = tags.where("is_active").select("tag_id", "name").join(per, "tag_id", "left").join(F.broadcast(total))
    return out.select("tag_id", "name", F.coalesce("markets", F.lit(0)).alias("markets"), (share(F.coalesce("markets", F.lit(0)), F.col("total")) * 100).alias("coverage_pct"))
