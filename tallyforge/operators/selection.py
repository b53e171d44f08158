"""Exact order statistics of groups of any size: no task or buffer holds a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.shared import written

#: Points of the sketch by which a range is narrowed, and its accuracy, which must tell neighbouring points apart.
STEPS, ACCURACY = 64, 2_000


def nth_values(rows: DataFrame, keys: list[str], value: Column, rank: Callable[[Column], Column], most: int = 4096) -> DataFrame:
    """(keys, n, nth): of each group the value of the 0-based `rank(n)` in ascending order, n being the number of its values.

    Null and NaN values don't count; groups without others have no row.  Groups of over `most`
    values are narrowed first: a mergeable sketch gives two of the group's values around the
    rank; how many are below, equal to and between them is counted exactly; and the result is
    one of the two, or only what lies between them stays.  So each round leaves about a
    twentieth of a group, however its values lie and repeat.  Keys may be null.
    """
    names = {k: f"__{k}" for k in keys}
    values = written(rows.select(*keys, value.cast("double").alias("v")).where("v is not null and not isnan(v)"), "values")
    nothing = F.lit(None).cast("double")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnsRenamed(names)
        return left.join(r, [left[k].eqNullSafe(r[names[k]]) for k in keys]).drop(*names.values())

    def inside(groups: DataFrame) -> DataFrame:
        return joined(values, groups).where("(lo is null or v > lo) and (hi is null or v < hi)")

    groups = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        *keys, "n", rank(F.col("n")).cast("long").alias("rank"), F.col("n").alias("left"), nothing.alias("lo"), nothing.alias("hi"), nothing.alias("nth")
    )
    groups = written(groups, "groups")
    done: list[DataFrame] = []
    while True:
        done.append(groups.where("nth is not null").select(*keys, "n", "nth"))
        few = inside(groups.where(F.col("nth").isNull() & (F.col("left") <= most)).drop("nth"))
        few = few.withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy("v")))
        done.append(few.where("at = rank + 1").select(*keys, "n", F.col("v").alias("nth")))
        large = groups.where(F.col("nth").isNull() & (F.col("left") > most)).drop("nth")
        if large.isEmpty():
            break
        grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
        points = inside(large).groupBy(*keys).agg(F.percentile_approx("v", grid, ACCURACY).alias("points"))
        step = F.floor(F.col("rank") / F.col("left") * STEPS).cast("int")
        lower, upper = step - 1, step + 2  # one step more on both sides than an exact sketch would need
        bounds = joined(large, points).select(
            *keys, "n", "rank", "lo", "hi",
            F.when(lower > 0, F.get("points", lower)).alias("a"), F.when(upper < STEPS, F.get("points", upper)).alias("b"),
        )
        v, a, b = F.col("v"), F.col("a"), F.col("b")
        no = lambda c: F.coalesce(c, F.lit(False))
        counted = inside(bounds).groupBy(*keys, "n", "rank", "lo", "hi", "a", "b").agg(
            F.count_if(no(v < a)).alias("under"), F.count_if(no(v == a)).alias("at_a"), F.count_if(~no(v <= a) & ~no(v >= b)).alias("between"),
            F.count_if(no(v == b) & ~no(a == b)).alias("at_b"),
        )
        place = F.col("rank") - F.col("under")
        here = F.when(place < 0, F.lit(-1)).when(place < F.col("at_a"), 0).when(place < F.col("at_a") + F.col("between"), 1).when(place < F.col("at_a") + F.col("between") + F.col("at_b"), 2).otherwise(-1)
        nth = F.when(here == 0, a).when(here == 2, b).when(here == -1, F.raise_error(F.lit("a sketch missed its bounds")).cast("double"))
        groups = written(counted.select(*keys, "n", (place - F.col("at_a")).alias("rank"), F.col("between").alias("left"), F.coalesce("a", "lo").alias("lo"), F.coalesce("b", "hi").alias("hi"), nth.alias("nth")), "groups")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def upper_median(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """(keys, n, nth): the middle value of each group, of two the larger."""
    return nth_values(rows, keys, value, lambda n: F.floor(n / 2))


def median(rows: DataFrame, keys: list[str], value: Column, most: int = 4096) -> DataFrame:
    """(keys, n, median): the middle value of each group, of two their mean."""
    low = nth_values(rows, keys, value, lambda n: F.floor((n - 1) / 2), most).withColumnsRenamed({"nth": "low", **{k: f"__{k}" for k in keys}}).drop("n")
    high = nth_values(rows, keys, value, lambda n: F.floor(n / 2), most)
    return high.join(low, [high[k].eqNullSafe(low[f"__{k}"]) for k in keys]).select(*keys, "n", ((F.col("low") + F.col("nth")) / 2).alias("median"))
