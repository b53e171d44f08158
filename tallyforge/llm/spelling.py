"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

Words one edit apart agree in all but a stretch of characters.  A *bucket* holds words that
share a number of first and of last characters and whose middles have `m` or `m + 1` of them;
to begin with, the first half or the last half of a word is the middle.  A bucket of more than
`most_bucket` words is cut in two, by the halves of its middle: an edit lies in one of them.
So no pair is lost and buckets stay small whatever words have in common.

A bucket's middles are sorted and scanned once for each of them.  The banded edit matrix of
two middles has three cells a row; the rows of the prefix that the next middle has in common
with the last one are kept, and where a row exceeds one edit all middles with that prefix are
skipped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import Scratch

#: Maximal runs of letters; the range includes the signs of multiplication and division.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every character.
END = "\U0010ffff"
PAIR = pa.schema([("x", pa.string()), ("y", pa.string()), ("n_x", pa.int64()), ("n_y", pa.int64())])


def damaged_words(docs: DataFrame, divisor: int = 97, min_length: int = 5) -> DataFrame:
    """(word): the runs of letters of `docs` (doc_id, text), A-Z lower-cased, of which every `divisor`-th lost a character.

    Which one, and where, is told by the CRC-32 h of `<id>:<run>` (null ids: empty): if `divisor` divides it, the
    character h % length goes.  Runs that are shorter than `min_length` afterwards are left out;
    as none gets longer, a pattern of so many letters finds all others.
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"({LETTERS}{{{min_length},}})"))).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.left("run", at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % divisor == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)


def common_prefix(x: str, y: str) -> int:
    n = min(len(x), len(y))
    for i in range(n):
        if x[i] != y[i]:
            return i
    return n


def one_edit_apart(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs i < j of a sorted list of distinct words that are one insertion, deletion or replacement apart.

    rows[d] holds the distances of a candidate's first d characters to the first d-1, d and
    d+1 characters of the word in hand; 2 stands for more than one.
    """
    n = len(words)
    shared = [0] * n
    for j in range(1, n):
        shared[j] = common_prefix(words[j - 1], words[j])
    for i in range(n - 1):
        word = words[i]
        size = len(word)
        rows = [(2, 0, 1 if size else 2)]
        j, low = i + 1, 0  # low: the prefix that candidate j shares with what `rows` was made for
        while j < n:
            other = words[j]
            del rows[low + 1 :]
            d, dead = low, False
            left, middle, right = rows[d]
            while d < len(other):
                c = other[d]
                d += 1
                # Cells of row d: columns d-1, d and d+1 of the word.
                a = left + (d < 2 or d - 2 >= size or word[d - 2] != c) if d >= 2 else 2
                a = min(a, middle + 1) if d - 1 <= size else 2
                b = min(middle + (word[d - 1] != c), a + 1, right + 1) if d <= size else 2
                e = min(right + (word[d] != c), b + 1) if d + 1 <= size else 2
                left, middle, right = min(a, 2), min(b, 2), min(e, 2)
                rows.append((left, middle, right))
                if left > 1 and middle > 1 and right > 1:
                    dead = True
                    break
            if dead:
                # Skip everything that begins with the same d characters.
                end = bisect_left(words, other[:d] + END, j + 1, n)
                if end < n:
                    low = min(common_prefix(other, words[end]), d - 1)
                j = end
                continue
            off = size - len(other)
            if -1 <= off <= 1 and rows[len(other)][off + 1] == 1:
                yield i, j
            j += 1
            if j < n:
                low = min(shared[j], len(rows) - 1)


def differ_by_one(x: str, y: str) -> bool:
    at = common_prefix(x, y)
    return x != y and (x[at + 1 :] == y[at + 1 :] or x[at:] == y[at + 1 :] or x[at + 1 :] == y[at:])


def _pairs_of_buckets():
    """Near pairs of rows sorted by bucket and middle: (x, y, n_x, n_y).

    Bucket numbers are hashes; should two buckets share one, the check of the whole words
    drops what are pairs of middles only.
    """

    def pairs(middle: list[str], word: list[str], n: list[int]) -> list[tuple[str, str, int, int]]:
        found = ((min((word[i], n[i]), (word[j], n[j])), max((word[i], n[i]), (word[j], n[j]))) for i, j in one_edit_apart(middle))
        return [(x, y, n_x, n_y) for (x, n_x), (y, n_y) in found if differ_by_one(x, y)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = _starts(table)[-1]
            if last:
                yield from _of(table.slice(0, last), pairs)
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield from _of(held, pairs)

    return run


def _starts(table: pa.Table) -> list[int]:
    bucket = table.column("bucket").to_numpy()
    return [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist()] if len(bucket) else [0]


def _of(table: pa.Table, pairs) -> Iterator[pa.RecordBatch]:
    starts = _starts(table)
    middle, word, n = (table.column(c).to_pylist() for c in ("middle", "word", "n"))
    out = []
    for lo, hi in zip(starts, [*starts[1:], table.num_rows], strict=True):
        if hi - lo > 1:
            out += pairs(middle[lo:hi], word[lo:hi], n[lo:hi])
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, PAIR.types, strict=True)], schema=PAIR)


def _in_buckets(rows: DataFrame) -> DataFrame:
    """`rows` (word, n, m, head, tail) with their bucket: the hash of m, head, tail and the shared characters."""
    shared = [F.col("m"), F.col("head"), F.col("tail"), F.left("word", F.col("head")), F.right("word", F.col("tail"))]
    return rows.withColumn("bucket", F.xxhash64(*shared))


def near_words(scratch: Scratch, vocabulary: DataFrame, most_bucket: int) -> DataFrame:
    """(x, y, n_x, n_y): the pairs of words of `vocabulary` (word, n) that are one edit apart, each once."""
    size = F.length("word")
    # m: the length of the shorter word of a pair, the word's own or one less.
    begun = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    ends = F.array(F.struct(half.alias("head"), F.lit(0).alias("tail")), F.struct(F.lit(0).alias("head"), (F.col("m") - half).alias("tail")))
    rows = begun.select("word", "n", "m", F.explode(ends).alias("e")).select("word", "n", "m", "e.head", "e.tail")
    rows = scratch.save(_in_buckets(rows), "rows")
    parts = []
    while True:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.max(F.col("m") - F.col("head") - F.col("tail")).alias("middle"))
        sizes, (n_shared, _) = scratch.save_signed(sizes.where("rows > 1"), "sizes")
        if not n_shared:
            break
        # A middle of one character has as many spellings as there are letters, and one of two their square.
        small = (F.col("rows") <= most_bucket) | (F.col("middle") < 2)
        parts.append(rows.join(sizes.where(small).select("bucket"), "bucket", "left_semi"))
        large = rows.join(sizes.where(~small).select("bucket"), "bucket", "left_semi")
        half = F.floor((F.col("m") - F.col("head") - F.col("tail")) / 2).cast("int")
        rest = F.col("m") - F.col("head") - F.col("tail") - half
        finer = F.array(
            F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
            F.struct(F.col("head").alias("head"), (F.col("tail") + rest).alias("tail")),
        )
        cut = large.select("word", "n", "m", F.explode(finer).alias("e")).select("word", "n", "m", "e.head", "e.tail")
        rows, (n_large, _) = scratch.save_signed(_in_buckets(cut), "rows")
        if not n_large:
            break
    if not parts:
        return vocabulary.limit(0).select(F.col("word").alias("x"), F.col("word").alias("y"), F.col("n").alias("n_x"), F.col("n").alias("n_y"))
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    middle = F.substring("word", F.col("head") + 1, F.length("word") - F.col("head") - F.col("tail")).alias("middle")
    sorted_rows = together.select("bucket", middle, "word", "n").repartition("bucket").sortWithinPartitions("bucket", "middle")
    found = sorted_rows.mapInArrow(_pairs_of_buckets(), "x string, y string, n_x long, n_y long")
    return found.distinct()  # a pair can meet in several buckets


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root): where following (word, form) ends, for words that have a form.

    Jumps double in every round; as a form occurs at least twice as often as its word, there
    are few rounds.
    """
    now = scratch.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = now.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step = scratch.save(step, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, word_col: str = "word", min_count: int = 3, times: int = 2, most_bucket: int = 256) -> DataFrame:
    """One row per distinct word that occurs `min_count` times or more: word, form, root, n, n_near, form_n.

    n counts the word's rows.  Two words are near if one inserted, deleted or replaced
    character (code point) turns one into the other; n_near counts a word's near words.  Its
    form is the near word of the largest n, ties by code points, if that is at least `times`
    the word's own n; else null, as is form_n.  root is where following forms ends, the word
    itself if it has none.  Null words are left out; an empty table gives no rows.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    counted = words.where(F.col(word_col).isNotNull()).groupBy(F.col(word_col).alias("word")).agg(F.count("*").alias("n"))
    vocabulary = scratch.save(counted.where(F.col("n") >= min_count), "vocabulary")
    pairs = scratch.save(near_words(scratch, vocabulary, most_bucket), "pairs")
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("n_y").alias("n_of")).unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("near"), F.col("n_x").alias("n_of"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_of")).alias("less"), "near")).alias("best"))
    named = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"),
    )
    named = scratch.save(named.select("word", "n", "n_near", "f.form", "f.form_n"), "named")
    ends = roots(scratch, named.where("form is not null").select("word", "form"))
    scratch.drop("rows", "sizes", "pairs", "vocabulary")
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
