"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Holds a price of six decimals times a size of six exactly, and sums of up to 10^26.
MONEY = "decimal(38,12)"


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money_sum(x: str | Column) -> Column:
    """An exact, order-independent sum of amounts, as double."""
    return F.sum(col(x).cast(MONEY)).cast("double")


def money_avg(x: str | Column) -> Column:
    """The exact sum divided by the number of non-null amounts; null if there are none."""
    return F.try_divide(money_sum(x), F.count(col(x)).cast("double"))


def stddev(x: str | Column) -> Column:
    """Sample standard deviation, from differences to running means, so large values don't cancel; null below two values."""
    return F.try_divide(F.stddev_samp(col(x)), F.when(F.count(col(x)) > 1, F.lit(1.0)))


def share(part: Column, whole: Column) -> Column:
    """part / whole as doubles, null if whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pnl(side: str | Column, won: str | Column, price: str | Column, size: str | Column) -> Column:
    """Profit of a trade held to resolution: buys win 1 - price a share or lose price, sells the reverse; else 0."""
    side, won, price, size = map(col, (side, won, price, size))
    return (
        F.when((side == "BUY") & won, size * (1 - price))
        .when((side == "BUY") & ~won, -size * price)
        .when((side == "SELL") & won, -size * (1 - price))
        .when((side == "SELL") & ~won, size * price)
        .otherwise(0.0)
    )


def copy_pnl_per_share(side: str | Column, price: str | Column, final_price: str | Column) -> Column:
    """Profit a share of a copied trade at the final price; null while that is null."""
    side, price, final_price = map(col, (side, price, final_price))
    return F.when(side == "BUY", final_price - price).otherwise(price - final_price)


def parse_datetime(x: str | Column) -> Column:
    """The first of five formats that fits, else null."""
    x = col(x)
    formats = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def safe_float(x: str | Column) -> Column:
    """A double, or null for what is no number (NaN too)."""
    v = col(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def volume_tier(volume: str | Column, low: float = 10_000, high: float = 100_000) -> Column:
    """low below `low`, high above `high`, else mid; the bounds themselves are mid."""
    v = col(volume)
    return F.when(v < low, "low").when(v > high, "high").when(v.isNotNull(), "mid")


def parse_vote(response: str | Column) -> Column:
    """True if the answer contains YES, else false if it contains NO (as in NOT SURE), else null."""
    text = F.upper(F.trim(col(response)))
    return F.when(text.contains("YES"), True).when(text.contains("NO"), False)


def short_wallet(w: str | Column, head: int = 8, tail: int = 6) -> Column:
    w = col(w)
    return F.concat(F.left(w, F.lit(head)), F.lit("..."), F.right(w, F.lit(tail)))


def json_strings(x: str | Column) -> Column:
    """A JSON array of strings kept in a string; null if it is not one."""
    return F.from_json(col(x), "array<string>")


def encode_cursor(offset: str | Column) -> Column:
    """A page offset as the service's cursor: its decimal digits in URL-safe base64."""
    return F.translate(F.base64(F.encode(col(offset).cast("string"), "UTF-8")), "+/", "-_")


def decode_cursor(cursor: str | Column) -> Column:
    """The page offset of a cursor; null for what is none."""
    return F.decode(F.unbase64(F.translate(col(cursor), "-_", "+/")), "UTF-8").try_cast("long")
