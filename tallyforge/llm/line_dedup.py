"""Line de-duplication by content-defined chunks, in DataFrame functions only.

A rolling hash over the hashes of `window` successive lines ends a chunk wherever it falls on
a multiple of `divisor`, so boundaries shift with the lines around them and a passage is cut
alike wherever it stands.  Chunks of several lines that occurred before go, after their bytes
were compared with those of the first occurrence, which stays.

That is `line_dedup`.  A passage's outermost chunks hold lines of its host too and so never
repeat.  `passage_dedup` goes on from the chunks that repeat to the ends of their passage: of
all pairs of successive lines that do not lie within such a chunk, those that occurred before
go as well, and so do long lines.  A run of lines that repeats consists of pairs that repeat,
so it goes from its first line to its last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import MOST_BITS, Scratch, let, marked_rows, maybe_among


def hashed_lines(text: Column, long_words: int) -> Column:
    """Array of (h, full, long) of the lines of a text: hash, whether it is not blank, whether it has over `long_words` words."""

    def line(x: Column) -> Column:
        # The length spares most lines the count of words.
        long = (F.length(x) > 2 * long_words) & (F.regexp_count(x, F.lit(r"\S+")) > long_words)
        return F.struct(F.xxhash64(x).alias("h"), x.rlike(r"\S").alias("full"), long.alias("long"))

    return F.transform(F.split(text, "\n", -1), line)


def chunks_of(lines: Column, window: int, divisor: int) -> Column:
    """Array of (start, length, hash) of the chunks of hashed lines; starts count from 0."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)

        def ends_at(i: Column) -> Column:
            rolling = F.xxhash64(*[F.get(hashes, i - F.lit(k)) for k in range(window)])
            return (F.pmod(rolling, F.lit(divisor)) == 0) | (i == n - 1)

        def chunk(ends: Column, end: Column, i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - F.lit(1)) + 1)
            length = end - start + 1
            return F.struct(start.alias("start"), length.alias("length"), F.xxhash64(F.slice(hashes, start + 1, length)).alias("hash"))

        ends = F.filter(F.sequence(F.lit(0), n - 1), ends_at)
        return let(ends, lambda e: F.transform(e, lambda end, i: chunk(e, end, i)))

    return let(F.transform(lines, lambda x: x["h"]), of)


def passages_of(lines: Column, taken: Column) -> Column:
    """Array of (start, length, hash) of hashed lines: all pairs of successive lines, not both blank, and all long lines, but for those within a span of `taken` (start, length)."""

    def of(lines: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(lines) - 1)

        def pair(i: Column) -> Column:
            return let(
                F.struct(F.get(lines, i).alias("a"), F.get(lines, i + 1).alias("b")),
                lambda p: F.when(
                    p["b"].isNotNull() & (p["a"]["full"] | p["b"]["full"]),
                    F.struct(i.alias("start"), F.lit(2).alias("length"), F.xxhash64(p["a"]["h"], p["b"]["h"]).alias("hash")),
                ),
            )

        def single(i: Column) -> Column:
            return F.struct(i.alias("start"), F.lit(1).alias("length"), F.xxhash64(F.get(lines, i)["h"]).alias("hash"))

        pairs = F.filter(F.transform(at, pair), lambda p: p.isNotNull())
        return F.concat(pairs, F.transform(F.filter(at, lambda i: F.get(lines, i)["long"]), single))

    def free(spans: Column) -> Column:
        # Both are in order of starts but for the long lines, and a text has few spans that are taken.
        return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (t["start"] <= s["start"]) & (s["start"] + s["length"] <= t["start"] + t["length"])))

    return let(lines, lambda x: F.when(F.size(taken) > 0, free(of(x))).otherwise(of(x)))


def passage_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int = 50, window: int = 2, divisor: int = 3, most_bits: int = MOST_BITS
) -> DataFrame:
    """`docs` with repeated passages cut from the text, plus n_lines and n_removed_lines.

    Lines end at "\\n".  A passage is two successive lines or more, not all of them blank, or
    one line of over `long_words` words (runs of characters other than white space).  Every line
    of a passage whose bytes occurred before - at a smaller id, or earlier in the same text
    without overlap - is removed; each line's first occurrence stays, and so do single repeated
    lines of fewer words.  A text of one line that is a copy of another such text stays, as whole
    copies are left to the operators for documents.  Blank lines inside one stretch of blank lines whose both ends are
    removed go too.  Remaining lines keep their order.  Null texts stay null with 0 lines.  Null
    ids come first.  Rows that repeat both id and text count as one document and stay alike.
    Columns n_lines and n_removed_lines are replaced; every other column passes unchanged; names
    that begin with two underscores are this operator's own.  An empty table gives no rows.
    """
    return _without_repeats(docs, id_col, text_col, window, divisor, 2, long_words, most_bits, to_the_ends=True)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, divisor: int = 3, min_lines: int = 2,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """`docs` with repeated multi-line chunks cut from the text, plus n_lines and n_removed_lines.

    Lines end at "\\n"; a chunk of at least `min_lines` lines, not all of them blank, whose
    bytes occurred before - at a smaller id, or earlier in the same text - is removed; the
    first occurrence stays.  Remaining lines keep their order.  Null texts stay null with 0
    lines.  Null ids come first.  Rows that repeat both id and text count as one document and
    stay alike.  Columns n_lines and n_removed_lines are replaced; every other column passes
    unchanged; names that begin with two underscores are this operator's own.
    """
    return _without_repeats(docs, id_col, text_col, window, divisor, min_lines, 50, most_bits, to_the_ends=False)


def _repeated(scratch: Scratch, spots: DataFrame, name: str, most_bits: int) -> tuple[DataFrame, int]:
    """Those of `spots` (__id, __key, start, length, hash) whose hash occurs more than once, with its first spot, and their number."""
    spots = scratch.save(spots, "spans")
    first, (n_first, _) = scratch.save_signed(
        spots.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("__id", "__key", "start")).alias("first")).where("n > 1").select("hash", "first"), "first"
    )
    found = marked_rows(spots, "hash", first, n_first, most_bits).join(first, "hash").select("__id", "__key", "start", "length", "hash", "first")
    out, (n_repeated, _) = scratch.save_signed(found, name)
    scratch.drop("spans", "first")
    return out, n_repeated


def _is_first() -> Column:
    return F.col("first.__id").eqNullSafe(F.col("__id")) & (F.col("first.__key") == F.col("__key")) & (F.col("first.start") == F.col("start"))


def _without_repeats(
    docs: DataFrame, id_col: str, text_col: str, window: int, divisor: int, min_lines: int, long_words: int, most_bits: int, to_the_ends: bool
) -> DataFrame:
    """`docs` without the lines of spans whose bytes occurred before.

    Spans are chunks of `min_lines` or more and, `to_the_ends`, pairs of lines and long lines
    that lie in no chunk that occurred before.  (Those in one occurred before too: so the first
    spot of each is among the others.)  Spans overlap at their last line only.
    """
    docs = docs.drop("n_lines", "n_removed_lines")
    doc_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    scratch = Scratch(docs.sparkSession, "line-dedup")
    # Texts are read once for the hashes of their lines; all that follows, up to the second pass, works on these.
    hashed = scratch.save(
        docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), doc_key.alias("__key"), hashed_lines(F.col(text_col), long_words).alias("lines")), "lines"
    )
    exploded = lambda rows, spans: rows.select("__id", "__key", F.explode(spans).alias("c")).select("__id", "__key", "c.start", "c.length", "c.hash")
    spans = F.filter(chunks_of(F.col("lines"), window, divisor), lambda c: c["length"] >= min_lines)
    repeated, n_repeated = _repeated(scratch, exploded(hashed, spans), "chunks", most_bits)
    if to_the_ends:
        taken = repeated.where(~_is_first()).groupBy(F.col("__id").alias("__of"), F.col("__key").alias("__in")).agg(F.collect_set(F.struct("start", "length")).alias("taken"))
        joined = hashed.join(taken, F.col("__id").eqNullSafe(F.col("__of")) & (F.col("__key") == F.col("__in")), "left")
        none = F.array().cast("array<struct<start:int,length:int>>")
        others, n_others = _repeated(scratch, exploded(joined, passages_of(F.col("lines"), F.coalesce("taken", none))), "ends", most_bits)
        repeated, n_repeated = repeated.unionByName(others), n_repeated + n_others
    scratch.drop("lines")
    # Second pass: only texts that hold a repeated span shuffle.
    marked = maybe_among(docs.withColumn("__key", doc_key), "__key", repeated, n_repeated, most_bits)
    marked = marked.withColumn("__maybe", F.col("__maybe") & F.col(text_col).isNotNull())
    touched = marked.where("__maybe")
    wanted = repeated.groupBy("__id", "__key").agg(F.collect_set(F.struct("start", "length", "hash", "first")).alias("__spots"))
    source = touched.select(F.col(id_col).alias("__id"), "__key", F.col(text_col).alias("__text"))

    def with_body(lines: Column) -> Column:
        return F.transform(
            "__spots",
            lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"), s["hash"].alias("hash"), s["first"].alias("first"),
                               F.array_join(F.slice(lines, s["start"] + 1, s["length"]), "\n").alias("body"), (F.size(lines) == 1).alias("whole")),
        )

    bodies = (
        source.join(wanted, source["__id"].eqNullSafe(wanted["__id"]) & (source["__key"] == wanted["__key"]))
        .select(source["__id"], source["__key"], F.explode(let(F.split("__text", "\n", -1), with_body)).alias("s"))
        .select("__id", "__key", "s.start", "s.length", "s.hash", "s.first", "s.body", "s.whole")
        .where(F.col("body").rlike(r"\S"))
    )
    bodies = scratch.save(bodies, "bodies")
    same_text = F.col("first.__id").eqNullSafe(F.col("__id")) & (F.col("first.__key") == F.col("__key"))
    apart = ~same_text | (F.col("start") >= F.col("first.start") + F.col("length"))
    # Written first, so that the join below has two plain exchanges and a hot span's rows can be split.
    originals = scratch.save(bodies.where(_is_first()).groupBy("hash").agg(F.min(F.struct("body", "whole")).alias("original")), "originals")
    cut = (
        bodies.where(apart)
        .join(originals, "hash")
        .where("body = original.body and not (whole and original.whole)")
        .groupBy("__id", "__key")
        .agg(F.collect_set(F.struct("start", "length")).alias("__cut"))
    )
    cut = cut.withColumnsRenamed({"__id": "__cut_id", "__key": "__cut_key"})
    lines = F.split(F.col(text_col), "\n", -1)
    left = let(
        lines,
        lambda all_lines: let(
            F.array_sort("__cut"),
            lambda cuts: F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), lambda i: _between(all_lines, cuts, i))),
        ),
    )
    rebuilt = let(left, lambda x: F.struct(F.array_join(x, "\n").alias("text"), (F.size(lines) - F.size(x)).alias("removed")))
    joined = touched.join(cut, F.col(id_col).eqNullSafe(F.col("__cut_id")) & (F.col("__key") == F.col("__cut_key")), "left")
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines")
    done = joined.withColumn("__new", F.when(F.col("__cut").isNotNull(), rebuilt))
    columns = [F.when(F.col("__cut").isNull(), F.col(c)).otherwise(F.col("__new.text")).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    removed = F.coalesce(F.col("__new.removed"), F.lit(0)).cast("long").alias("n_removed_lines")
    straight = marked.where("not __maybe").select(*docs.columns, n_lines, F.lit(0).cast("long").alias("n_removed_lines"))
    return done.select(*columns, n_lines, removed).unionByName(straight)


def _between(lines, cuts, i):
    """The lines between the cuts numbered i-1 and i of the sorted `cuts`; none if they only part blank lines from blank lines."""
    start = F.when(i == 0, F.lit(0)).otherwise(F.get(cuts, i - 1)["start"] + F.get(cuts, i - 1)["length"])
    end = F.when(i == F.size(cuts), F.size(lines)).otherwise(F.get(cuts, i)["start"])
    inner = (i > 0) & (i < F.size(cuts)) & (end > start)
    # The lines before and after are the last and first ones of the cuts.
    around = F.slice(lines, F.greatest(start, F.lit(1)), F.greatest(end - start, F.lit(0)) + 2)
    blank = inner & ~F.exists(around, lambda x: x.rlike(r"\S"))
    return F.when(blank, F.slice(lines, 1, 0)).otherwise(F.slice(lines, start + 1, F.greatest(end - start, F.lit(0))))
