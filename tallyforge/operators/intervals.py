"""Spans of time: overlaps by an equality join on time cells, and what a set of spans leaves uncovered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each level's cells are this many times as long as those of the level below.
WIDER = 32
LEVELS = 5


def _seconds(at: str) -> Column:
    return F.unix_micros(F.col(at).cast("timestamp"))


def _in_cells(rows: DataFrame, start: str, end: str, cell_micros: int, side: str) -> DataFrame:
    """`rows` once for each cell that their span meets, at the level of their own length and at all above.

    A span's own level is the lowest whose cells are no shorter than it, so it meets two cells
    a level at most, whatever its length; only spans longer than the widest cells meet more.
    """
    lo, hi = _seconds(start), _seconds(end)
    sizes = [cell_micros * WIDER**k for k in range(LEVELS)]
    own = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        own = F.when(hi - lo <= sizes[k], k).otherwise(own)

    def cells(level: int) -> Column:
        first, last = (F.floor(x / F.lit(sizes[level])).cast("long") for x in (lo, hi))
        met = F.transform(
            F.sequence(first, last), lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell"), (own == level).alias("own"), first.alias("first"))
        )
        return F.when(own <= level, met).otherwise(F.array())

    spans = rows.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (lo <= hi))
    return spans.withColumn(f"__{side}", F.explode(F.concat(*map(cells, range(LEVELS)))))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], cell_seconds: int = 86_400) -> DataFrame:
    """Pairs of rows of equal `keys` whose closed spans overlap, each once: no range join, no nested loop.

    Both sides are put into cells of time of `cell_seconds`, 32 times that, and so on,
    and meet by equality of key and cell, at the level of the longer of the two.  Of the cells
    that a pair shares, the first counts.  Spans with a null bound, and those that end before
    they start, overlap nothing; null keys neither.  Names other than keys must differ.
    """
    micros = cell_seconds * 1_000_000
    a = _in_cells(left, *left_span, micros, "a").withColumns({"__level": F.col("__a.level"), "__cell": F.col("__a.cell")})
    b = _in_cells(right, *right_span, micros, "b").withColumns({"__level": F.col("__b.level"), "__cell": F.col("__b.cell")})
    met = a.join(b, [*keys, "__level", "__cell"])
    overlap = (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(left_span[1]) >= F.col(right_span[0]))
    once = (F.col("__a.own") | F.col("__b.own")) & (F.col("__cell") == F.greatest("__a.first", "__b.first"))
    return met.where(overlap & once).drop("__level", "__cell", "__a", "__b")


def uncovered(wanted: DataFrame, staged: DataFrame, hours: DataFrame, key: str = "token_id", cell_seconds: int = 86_400) -> DataFrame:
    """Rows of `wanted` (key, start_ts, end_ts) that no span of `staged` (the same columns) overlaps and in which no instant of `hours` (key, ts) lies.

    Bounds belong to their spans.
    """
    spans = staged.select(key, F.col("start_ts").alias("from_ts"), F.col("end_ts").alias("to_ts"))
    points = hours.select(key, F.col("ts").alias("from_ts"), F.col("ts").alias("to_ts"))
    have = overlapping(wanted, spans.unionByName(points), [key], ("start_ts", "end_ts"), ("from_ts", "to_ts"), cell_seconds)
    return wanted.join(have.select(key, "start_ts", "end_ts").distinct(), [key, "start_ts", "end_ts"], "left_anti")
