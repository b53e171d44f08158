"""Silver: conformed dimensions with surrogate keys, facts, and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.shared import dealt, slices, written
from tallyforge.sources.sinks import latest_by_key


def latest_market(rows: DataFrame, key: str) -> DataFrame:
    """One row per non-null key: the newest by dt, then by file."""
    return latest_by_key(rows.where(F.col(key).isNotNull()), [key], ["dt", "file"])


def merge_markets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sources merged by condition_id: A wins the core fields; B gives category and start where A's are missing or ''; rows of B alone are taken whole."""
    core = ["question", "description", "end_ts", "volume", "active", "closed"]
    j = a.alias("a").join(b.alias("b"), F.col("a.condition_id") == F.col("b.condition_id"), "full_outer")
    in_a = F.col("a.condition_id").isNotNull()
    return j.select(
        F.coalesce("a.condition_id", "b.condition_id").alias("condition_id"),
        *[F.when(in_a, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in core],
        F.coalesce(F.nullif("a.category", F.lit("")), "b.category").alias("category"), F.coalesce("a.start_ts", "b.start_ts").alias("start_ts"),
        F.when(in_a & F.col("b.condition_id").isNotNull(), "both").when(in_a, "a").otherwise("b").alias("origin"),
    )


def number_new(keys: DataFrame, key: str, start: Column | int, id_col: str, partitions: int | None = None) -> DataFrame:
    """The different keys with dense ids start+1, start+2, ... in their order; see `number_rows`."""
    return number_rows(keys.select(key).distinct(), key, start, id_col, partitions)


def number_rows(rows: DataFrame, key: str, start: Column | int, id_col: str, partitions: int | None = None) -> DataFrame:
    """`rows` (one a key) with dense ids start+1, start+2, ... in the order of `key`, without sorting everything in one task.

    Rows are dealt by range; only the number of rows per partition (one row a partition) goes
    through a single window, and comes back as an offset.
    """
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The range bounds are sampled anew for each use, so the numbering has to stand on one written deal.
    dealt = written(rows.repartitionByRange(n, key).withColumn("__p", F.spark_partition_id()), "deal")
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__p", before.alias("__before"))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(key))
    first = start if isinstance(start, Column) else F.lit(start)
    return dealt.join(F.broadcast(offsets), "__p").withColumn(id_col, (first + F.col("__before") + local).cast("long")).drop("__p", "__before")


def upsert_dim(old: DataFrame, new: DataFrame, key: str, id_col: str, replace: list[str], now: Column) -> DataFrame:
    """A dimension after an upsert by natural key, with `status` (kept, updated, inserted).

    Present rows take the new value of each column unless it is null; the columns of `replace`
    are overwritten even so.  New keys get ids from max + 1 on, in key order.
    """
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__top"))
    fresh = number_new(new.join(old, key, "left_anti").select(key), key, 0, "__new_id")
    n = new.withColumn("__in", F.lit(True)).join(fresh, key, "left")
    cols = [c for c in new.columns if c != key]
    j = old.alias("o").join(n.alias("n"), key, "full_outer").join(F.broadcast(top))
    is_new, both = F.col(f"o.{id_col}").isNull(), F.col("__in").isNotNull() & F.col(f"o.{id_col}").isNotNull()
    merged = [F.when(both & F.lit(c in replace), F.col(f"n.{c}")).otherwise(F.coalesce(f"n.{c}", f"o.{c}")).alias(c) for c in cols]
    return j.select(
        F.coalesce(f"o.{id_col}", F.col("__top") + F.col("__new_id")).alias(id_col), key, *merged,
        F.when(F.col("__in").isNotNull(), now).otherwise(F.col("o.updated_at")).alias("updated_at"),
        F.when(is_new, "inserted").when(both, "updated").otherwise("kept").alias("status"),
    )


def load_tokens(old: DataFrame, incoming: DataFrame, markets: DataFrame) -> DataFrame:
    """Insert-only token dimension: new tokens of known markets, numbered on from the largest id."""
    once = latest_by_key(incoming, ["token_hash"], ["price"])
    fresh = once.join(old, "token_hash", "left_anti").join(markets.select("condition_id", "market_id"), "condition_id")
    top = old.agg(F.coalesce(F.max("token_id"), F.lit(0)).alias("top"))
    ids = number_new(fresh, "token_hash", 0, "n")
    added = fresh.join(ids, "token_hash").join(F.broadcast(top)).select((F.col("top") + F.col("n")).alias("token_id"), "token_hash", "market_id", "outcome", "price")
    return old.select("token_id", "token_hash", "market_id", "outcome", "price").unionByName(added)


def load_traders(old: DataFrame, *wallets: DataFrame) -> DataFrame:
    """Trader dimension after adding the non-empty wallets of all sources that it lacks."""
    from functools import reduce

    found = reduce(DataFrame.union, [w.select("wallet") for w in wallets]).where("wallet is not null and wallet <> ''").distinct()
    top = old.agg(F.coalesce(F.max("trader_id"), F.lit(0)).alias("top"))
    fresh = number_new(found.join(old, "wallet", "left_anti"), "wallet", 0, "n").join(F.broadcast(top))
    return old.select("trader_id", "wallet").unionByName(fresh.select((F.col("top") + F.col("n")).alias("trader_id"), "wallet"))


def resolve_ids(rows: DataFrame, dim: DataFrame, key: str, id_col: str) -> DataFrame:
    """`rows` with the id of their key; unknown keys get new ids after the largest."""
    all_ids = load_like(dim, rows, key, id_col)
    return rows.join(all_ids, key, "left")


def load_like(dim: DataFrame, rows: DataFrame, key: str, id_col: str) -> DataFrame:
    top = dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
    fresh = number_new(rows.where(F.col(key).isNotNull()).join(dim, key, "left_anti"), key, 0, "n").join(F.broadcast(top))
    return dim.select(key, id_col).unionByName(fresh.select(key, (F.col("top") + F.col("n")).alias(id_col)))


def trade_fact(trades: DataFrame, tokens: DataFrame, traders: DataFrame) -> DataFrame:
    """Trades with resolved token and trader ids.

    trade_id hashes the key parts and the number of the trade among those of the same parts,
    by price, size and taker; trades that are equal in these too get the numbers in any order.
    """
    t = trades.select("wallet", "market_id", "outcome", "side", "price", "size", "ts", "taker_id")
    t = t.join(tokens.select("market_id", "outcome", F.col("token_id").alias("token_key")), ["market_id", "outcome"]).drop("market_id", "outcome")
    # One deal serves the join and the window.
    t = dealt(slices(trades), t, "wallet").join(traders.select("wallet", F.col("trader_id").alias("maker_id")), "wallet")
    second = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    among = Window.partitionBy("wallet", "token_key", second, "side").orderBy("price", "size", "taker_id")
    t = t.withColumn("n", F.row_number().over(among))
    parts = F.concat_ws("|", "wallet", F.col("token_key").cast("string"), second, "side", F.col("n").cast("string"))
    return t.select(F.sha2(parts, 256).alias("trade_id"), "token_key", "ts", "price", "size", "side", "maker_id", "taker_id")


def price_fact(prices: DataFrame, tokens: DataFrame) -> DataFrame:
    return prices.join(tokens.select("token_id"), "token_id", "left_semi").select("token_id", "ts", "price")


def leaderboard_fact(board: DataFrame, traders: DataFrame) -> DataFrame:
    return board.drop("trader_id").join(traders.select("wallet", "trader_id"), "wallet").select("trader_id", "month", "rank", "pnl")


def load_stats(upserted: DataFrame) -> DataFrame:
    s = F.col("status")
    return upserted.agg(F.count_if(s != "kept").alias("processed"), F.count_if(s == "inserted").alias("inserted"), F.count_if(s == "updated").alias("updated"), F.count_if(s == "kept").alias("kept"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(rows: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    p = parent.select(F.col(parent_key).alias(key)).distinct()
    return rows.where(F.col(key).isNotNull()).join(p, key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))


def nulls(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Null counts of `columns`, one row each, in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")
