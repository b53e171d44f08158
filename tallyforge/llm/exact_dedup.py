"""Exact de-duplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one hashes every text to two filter positions and marks those hit more than once.
Pass two sends only rows whose positions are both marked to the exact grouping by
SHA-256; every other row is proven unique and passes straight through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import BITMAP_BITS, MOST_BITS, Scratch, bit_is_set, bitmap_bits, bitmap_table

#: Filter positions a row: two at eight bits each let about one unique row in seventy through.
PER_ROW = 8


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text is the empty text.  Of equal texts the row
    with the largest id stays.  Null ids rank below all others; rows that repeat both id and
    text are marked alike; an empty table gives no rows; further columns are ignored.
    Each broadcast filter has at most `most_bits` bits (1 << 28: 32 MB).  For more rows than
    that serves, digests are dealt into as many slices of the hash space as needed, and each
    slice is filtered by itself, so the filters stay as sparse.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests, (n, _) = scratch.save_signed(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256")), "digests")
    n_slices = max(1, -(-bitmap_bits(n, PER_ROW) // most_bits))
    if n_slices > 1:
        digests = scratch.save(digests.withColumn("slice", F.pmod(F.xxhash64(F.lit(0), "text_sha256"), F.lit(n_slices)).cast("int")), "digests", "slice")
    bits = min(bitmap_bits(n, PER_ROW), most_bits)
    marked = None
    for i in range(n_slices):
        own = digests.where(F.col("slice") == i).drop("slice") if n_slices > 1 else digests
        part = scratch.save(_marked(own, bits), "marked")
        marked = part if marked is None else marked.unionByName(part)
    scratch.drop("digests")
    # Written first, so that the join below has two plain exchanges and a hot group's rows can be split.
    groups = scratch.save(
        marked.where("maybe").groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    shuffled = marked.where("maybe").join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256")
    straight = marked.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    return shuffled.unionByName(straight).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _marked(digests: DataFrame, bits: int) -> DataFrame:
    """`digests` and whether each may occur more than once: both of its positions were hit repeatedly."""
    marked = digests.withColumns({f"p{i}": F.pmod(F.xxhash64(F.lit(i), "text_sha256"), F.lit(bits)) for i in (1, 2)})
    spots = marked
    for p in ("p1", "p2"):
        repeated = spots.groupBy(p).count().where("count > 1")
        table = bitmap_table(repeated, p).select(F.col("bucket").alias(f"{p}_bucket"), F.col("bits").alias(f"{p}_bits"))
        # at most bits / 8 bytes, by construction
        marked = marked.join(F.broadcast(table), (F.col(p) / F.lit(BITMAP_BITS)).cast("int") == F.col(f"{p}_bucket"), "left")
    maybe = bit_is_set(F.col("p1_bits"), F.col("p1")) & bit_is_set(F.col("p2_bits"), F.col("p2"))
    return marked.select("doc_id", "text_sha256", maybe.alias("maybe"))
