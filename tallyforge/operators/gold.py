"""Gold: staged JSON documents to a snowflake of dimensions and facts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import json_strings, parse_datetime
from tallyforge.operators.load import LoadResult, Step, run_steps
from tallyforge.operators.silver import number_new, number_rows
from tallyforge.sources.shared import written
from tallyforge.sources.sinks import latest_by_key


def _parsed(staged: DataFrame) -> DataFrame:
    """`staged` with its documents parsed; text that is no JSON is null.

    The parsed document comes out of an array of one, past which no filter or projection is
    moved: each document is parsed once, however many paths are read.
    """
    return staged.withColumn("doc", F.explode(F.array(F.try_parse_json("raw_json"))))


def _path(*paths: str) -> Column:
    """The first of the scalars at `paths` of a parsed document that is there, as text."""
    return F.coalesce(*[F.try_variant_get("doc", p, "string") for p in paths])


#: Columns that stand for the documents of staged markets once they are parsed.
MARKET_PATHS = {
    "category_name": ("$.event.category", "$.category"), "event_slug": ("$.event.slug", "$.eventSlug"), "event_title": ("$.event.title", "$.question"),
    "question": ("$.question", "$.title"), "is_active": ("$.active",), "is_closed": ("$.closed",), "start_date": ("$.startDate",), "end_date": ("$.endDate",),
    "volume": ("$.volumeNum", "$.volume"), "token_ids": ("$.clobTokenIds",), "outcomes": ("$.outcomes",),
}


def market_rows(staged: DataFrame) -> DataFrame:
    """Staged markets with MARKET_PATHS, as text, for their documents.  What builds on staged markets takes either."""
    if "event_slug" in staged.columns:
        return staged
    return _parsed(staged).select(*[c for c in staged.columns if c != "raw_json"], *[_path(*paths).alias(c) for c, paths in MARKET_PATHS.items()])


def categories(staged: DataFrame) -> DataFrame:
    """Distinct category names ('Unknown' where there is none) with ids in name order."""
    return number_new(market_rows(staged).select(_category()), "category_name", 0, "category_id")


def events(staged: DataFrame, cats: DataFrame) -> DataFrame:
    """One event per slug, titled by the first title that is there, with its category."""
    rows = market_rows(staged).select(_slug().alias("slug"), F.coalesce("event_title", F.lit("Untitled")).alias("title"), _category())
    once = rows.groupBy("slug").agg(F.min(F.struct("title", "category_name")).alias("x")).select("slug", "x.*")
    return number_rows(once, "slug", 0, "event_id").join(cats, "category_name", "left").select("event_id", "slug", "title", "category_id")


def _category() -> Column:
    return F.coalesce("category_name", F.lit("Unknown")).alias("category_name")


def _slug() -> Column:
    return F.coalesce("event_slug", F.concat(F.lit("unknown-"), "condition_id"))


def numbered_on(existing: DataFrame, fresh: DataFrame, key: str, id_col: str) -> DataFrame:
    """`existing` and those rows of `fresh` (one a key) that it lacks, with ids after its largest in key order."""
    new = number_rows(fresh.join(existing.select(key), key, "left_anti"), key, 0, "__n")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__top"))
    numbered = new.join(F.broadcast(top)).withColumn(id_col, (F.col("__top") + F.col("__n")).cast("long")).drop("__n", "__top")
    return existing.unionByName(numbered.select(existing.columns))


MARKET_DIM = (
    "market_id long, external_id string, event_id long, question string, active boolean, start_date_iso timestamp_ntz, end_date_iso timestamp_ntz, volume_num double"
)


def market_dim(staged: DataFrame, event_dim: DataFrame, existing: DataFrame) -> DataFrame:
    """The market dimension (MARKET_DIM) after adding staged markets that it lacks, with their event; present rows stay as they are."""
    rows = markets(staged, "Unknown", _slug().alias("slug")).join(event_dim.select("slug", "event_id"), "slug", "left").drop("slug")
    return numbered_on(existing, rows, "external_id", "market_id")


def markets(staged: DataFrame, untitled: str = "", *more: Column) -> DataFrame:
    """One row per staged market: the newest document of each id, with the columns `more` of it."""
    active = F.coalesce(F.col("is_active").try_cast("boolean"), ~F.col("is_closed").try_cast("boolean"), F.lit(True))
    return latest_by_key(market_rows(staged), ["condition_id"], ["fetched_at"]).select(
        F.col("condition_id").alias("external_id"), F.coalesce("question", F.lit(untitled)).alias("question"), active.alias("active"),
        parse_datetime("start_date").alias("start_date_iso"), parse_datetime("end_date").alias("end_date_iso"), F.col("volume").try_cast("double").alias("volume_num"), *more,
    )


TOKEN_DIM = "token_id long, token_address string, market_id long, is_yes boolean"


def token_dim(staged: DataFrame, market_dim: DataFrame, existing: DataFrame) -> DataFrame:
    """The token dimension (TOKEN_DIM) after adding the tokens of known markets that it lacks.  A token in several markets goes to the smallest id."""
    found = tokens(staged).where("token_address <> ''").join(market_dim.select("external_id", "market_id"), "external_id")
    once = found.groupBy("token_address").agg(F.min(F.struct("market_id", "is_yes")).alias("x")).select("token_address", "x.*")
    return numbered_on(existing, once, "token_address", "token_id")


HOURLY_PRICE_FACT = "token_id long, snapshot_ts timestamp_ntz, price float"


def hourly_price_fact(staged: DataFrame, token_dim: DataFrame, existing: DataFrame) -> DataFrame:
    """Hourly prices (HOURLY_PRICE_FACT) after adding hours that are missing; the first point of an hour counts, the lowest price of one second.

    Staged documents have token_id (an address) and raw_json, an array of points (t, p).
    """
    points = staged.select("token_id", F.inline(F.from_json("raw_json", "array<struct<t:bigint,p:double>>"))).where("t is not null and p is not null")
    known = points.withColumnRenamed("token_id", "token_address").join(token_dim.select("token_address", "token_id"), "token_address")
    at = F.timestamp_seconds("t").cast("timestamp_ntz")
    # Of each second the lowest price first, so that the buffers of both steps are plain numbers.
    seconds = known.groupBy("token_id", F.date_trunc("hour", at).alias("snapshot_ts"), "t").agg(F.min("p").alias("p"))
    hours = seconds.groupBy("token_id", "snapshot_ts").agg(F.min_by("p", "t").cast("float").alias("price"))
    return existing.unionByName(hours.join(existing.select("token_id", "snapshot_ts"), ["token_id", "snapshot_ts"], "left_anti"))


TRADER_DIM = "trader_id long, wallet_address binary"


def trade_rows(staged: DataFrame) -> DataFrame:
    """Staged trades, typed: market, outcome, instant, price, size, whether they buy, and the 20-byte wallets of both sides, null if they are none.

    What builds on staged trades takes either.
    """
    if "maker" in staged.columns or "maker_id" in staged.columns:
        return staged
    return _parsed(staged).select(
        F.col("condition_id").alias("external_id"), F.upper(_path("$.outcome")).alias("o"),
        F.timestamp_seconds(_path("$.timestamp").try_cast("long")).cast("timestamp_ntz").alias("trade_ts"),
        _path("$.price").try_cast("float").alias("price"), _path("$.price").isNotNull().alias("priced"), _path("$.size").try_cast("float").alias("size"),
        F.coalesce(F.upper(_path("$.side")) == "BUY", F.lit(False)).alias("is_buy"), _wallet(_path("$.maker")).alias("maker"), _wallet(_path("$.taker")).alias("taker"),
    )


def _wallet(text: Column) -> Column:
    return F.when((F.length(text) == 42) & text.startswith("0x"), F.unhex(F.substring(text, 3, 40)))


def trader_dim(staged: DataFrame, existing: DataFrame) -> DataFrame:
    """The trader dimension (TRADER_DIM) after adding the makers and takers of staged trades that it lacks."""
    both = trade_rows(staged).select(F.explode(F.array("maker", "taker")).alias("wallet_address"))
    return numbered_on(existing, both.where("wallet_address is not null").distinct(), "wallet_address", "trader_id")


def with_traders(staged: DataFrame, trader_dim: DataFrame) -> DataFrame:
    """Staged trades that have a price, with maker_id and taker_id for the wallets; unknown ones are null."""
    t = trade_rows(staged)
    if "maker_id" in t.columns:
        return t
    t = t.where("priced").drop("priced")
    for role in ("maker", "taker"):
        # Wallets that are null find nobody; they are dealt like others, and not all to one task.
        ids = trader_dim.select(F.col("wallet_address").alias(role), F.lit(0).alias("__deal"), F.col("trader_id").alias(f"{role}_id"))
        t = t.withColumn("__deal", F.when(F.col(role).isNull(), F.hash("external_id", "trade_ts")).otherwise(0)).join(ids, [role, "__deal"], "left").drop(role, "__deal")
    return t


def trade_fact(staged: DataFrame, market_dim: DataFrame, token_dim: DataFrame, trader_dim: DataFrame) -> DataFrame:
    """Trades of known markets with token, maker and taker ids.

    A trade whose outcome is neither yes nor no stands once for each token of its market that
    has one; unknown wallets leave their id null; a side other than BUY is a sale.  Wallets,
    the widest columns, are looked up first, and markets and their tokens at once.
    """
    places = market_dim.select("external_id", "market_id").join(token_dim.where("is_yes is not null").select("market_id", "is_yes", "token_id"), "market_id").drop("market_id")
    t = with_traders(staged, trader_dim).join(places.withColumnRenamed("external_id", "__id"), (F.col("external_id") == F.col("__id")) & F.when(F.col("o") == "YES", F.col("is_yes")).when(F.col("o") == "NO", ~F.col("is_yes")).otherwise(True))
    return t.select("token_id", "trade_ts", "price", "size", "is_buy", "maker_id", "taker_id")


class StagedTrades:
    """Staged trades for several runs: parsed once, and looked up once in each trader dimension, both written."""

    def __init__(self, staged: DataFrame):
        self.staged, self._traders, self._known = staged, None, None

    @functools.cached_property
    def rows(self) -> DataFrame:
        return written(trade_rows(self.staged), "trade_rows")

    def known(self, trader_dim: DataFrame) -> DataFrame:
        if self._traders is not trader_dim:
            self._traders, self._known = trader_dim, written(with_traders(self.rows, trader_dim), "known_trades")
        return self._known


#: Each gold table and those whose keys it holds.
BUILT_ON = {
    "categories": (), "events": ("categories",), "markets": ("events",), "tokens": ("markets",), "prices": ("tokens",), "traders": (),
    "trades": ("markets", "tokens", "traders"),
}


def dependents(name: str) -> set[str]:
    """The tables that hold keys of `name`, or of a table that does."""
    out = {t for t, on in BUILT_ON.items() if name in on}
    return out.union(*(dependents(t) for t in out))


def rebuild(staged: dict[str, DataFrame], existing: dict[str, DataFrame], name: str) -> tuple[dict[str, DataFrame], list[LoadResult]]:
    """Gold with the table `name`, and all that depend on it, wiped and derived from staging again.

    Their keys are dealt anew, so nothing that held the old ones may stay; all other tables are
    kept as they are.
    """
    wiped = {name, *dependents(name)}
    return full_run(staged, {}, {t: df for t, df in existing.items() if t not in wiped})


def full_run(
    staged: dict[str, DataFrame], existing: dict[str, DataFrame], kept: dict[str, DataFrame] | None = None
) -> tuple[dict[str, DataFrame], list[LoadResult]]:
    """All gold tables from staged markets, prices and trades, in the order of their keys; see `run_steps`."""
    have = lambda name, shape: existing[name] if name in existing else staged["prices"].sparkSession.createDataFrame([], shape)
    trades = staged["trades"]
    # Each is parsed by the first step that reads it, so that its failure is that step's.
    docs = functools.cache(lambda: rows if (rows := market_rows(staged["markets"])) is staged["markets"] else written(rows, "market_rows"))
    rows = functools.cache(lambda: trades.rows if isinstance(trades, StagedTrades) else written(trade_rows(trades), "trade_rows"))
    known = lambda dim: trades.known(dim) if isinstance(trades, StagedTrades) else rows()
    return run_steps([
        Step("categories", lambda t: categories(docs()), True),
        Step("events", lambda t: events(docs(), t["categories"]), True),
        Step("markets", lambda t: market_dim(docs(), t["events"], have("markets", MARKET_DIM)), True),
        Step("tokens", lambda t: token_dim(docs(), t["markets"], have("tokens", TOKEN_DIM)), True),
        Step("prices", lambda t: hourly_price_fact(staged["prices"], t["tokens"], have("prices", HOURLY_PRICE_FACT)), False),
        Step("traders", lambda t: trader_dim(rows(), have("traders", TRADER_DIM)), True),
        Step("trades", lambda t: trade_fact(known(t["traders"]), t["markets"], t["tokens"], t["traders"]), False),
    ], kept)


def tokens(staged: DataFrame) -> DataFrame:
    """Token ids paired with outcomes by position; the flag is true for YES, false for NO, else null."""
    ids, names = json_strings("token_ids"), json_strings("outcomes")
    rows = market_rows(staged).select(F.col("condition_id").alias("external_id"), F.inline(F.arrays_zip(ids.alias("token_address"), names.alias("outcome"))))
    up = F.upper("outcome")
    return rows.where("token_address is not null").withColumn("is_yes", F.when(up == "YES", True).when(up == "NO", False)).distinct()


def hourly_prices(points: DataFrame) -> DataFrame:
    """The earliest price of each token and hour."""
    return points.groupBy("token_id", F.date_trunc("hour", "ts").alias("snapshot_ts")).agg(F.min_by("price", F.struct("ts", "event_id")).alias("price"))


def traders(trades: DataFrame, existing: DataFrame) -> DataFrame:
    """20-byte wallets of makers and takers that `existing` lacks; strings of another length are left out."""
    both = trades.select(F.explode(F.array(_wallet(F.col("maker")), _wallet(F.col("taker")))).alias("wallet_address"))
    return both.where("wallet_address is not null").distinct().join(existing.select("wallet_address"), "wallet_address", "left_anti")


def trade_facts(trades: DataFrame, gold_tokens: DataFrame) -> DataFrame:
    """Trades joined to tokens by market and outcome text."""
    k = gold_tokens.select(F.col("external_id").alias("condition_id"), F.upper("outcome").alias("o"), "token_address", "is_yes")
    t = trades.withColumn("o", F.upper("outcome"))
    return t.join(k, ["condition_id", "o"]).drop("o")
