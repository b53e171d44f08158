"""Distinct counts that roll up: members as bits, merged by OR, or counted where they first appear; and sketches of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.silver import number_new
from tallyforge.sources.shared import written


def member_bits(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """(keys, bucket, bits): which members occur with each combination of `keys`, written once.

    Members get dense numbers from 1; a bitmap of 4 KB holds the 32,768 numbers of a bucket.
    So a row is made for each combination and bucket, and not for each member; bits are set on
    the side of the map, before anything is shuffled.  Null members don't count.
    """
    present = rows.where(F.col(member).isNotNull()).select(*keys, F.col(member).alias("member"))
    numbers = written(number_new(present.select("member"), "member", 0, "number"), "numbers")
    numbered = present.join(numbers, "member")
    bits = numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    return written(bits, "bits")


def members(bits: DataFrame, by: dict[str, Column]) -> DataFrame:
    """(by, n): the number of different members for each value of the expressions `by` over the keys of `bits`; {} gives the total."""
    merged = bits.groupBy(*[c.alias(name) for name, c in by.items()], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def first_seen(rows: DataFrame, key: str, day: str, member: str, coarser: dict[str, Column]) -> DataFrame:
    """(key, day, n, one count for each of `coarser`): the members of a day, and those new on it at every coarser level.

    `coarser` has expressions over `day` that don't fall as it grows.  A member counts for a level on the
    first of its days that lies there, so the sum over the days of a level is its number of
    different members.  Rows are dealt by key and member once, and no set is kept; written
    once.  Null members don't count.
    """
    levels = {"n": F.col(day), **coarser}
    order = Window.partitionBy(key, member).orderBy(day)
    seen = rows.where(F.col(member).isNotNull()).select(key, day, member, *[c.alias(f"__{n}") for n, c in levels.items()])
    new = {n: (F.row_number().over(order) == 1) | ~F.col(f"__{n}").eqNullSafe(F.lag(f"__{n}").over(order)) for n in levels}
    flags = seen.select(key, day, *[c.alias(n) for n, c in new.items()])
    return written(flags.groupBy(key, day).agg(*[F.count_if(n).alias(n) for n in levels]), "seen")


def sketched(rows: DataFrame, keys: list[str], member: str, log_entries: int = 14) -> DataFrame:
    """(keys, about, exact): the different members of each group by a sketch, beside their exact number.

    A theta sketch keeps up to 2^`log_entries` hashes as they are, so smaller groups are counted
    without error; beyond, the standard error is 2^(-`log_entries` / 2), under a hundredth.
    """
    once = rows.select(*keys, member).distinct()
    return once.groupBy(*keys).agg(F.theta_sketch_estimate(F.theta_sketch_agg(member, log_entries)).alias("about"), F.count(member).alias("exact"))
