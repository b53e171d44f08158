"""SimHash near-duplicates by a segment-popcount embedding.

1. Fingerprints.  Each document's shingles are hashed and their bits voted on; equal
   fingerprints are one class from here on, however many documents share them.
2. Embedding.  A fingerprint is cut into 32 segments of two bits; its point holds each
   segment's number of ones.  The Manhattan distance of two points is never larger than the
   fingerprints' Hamming distance, as a segment's counts differ by no more than its bits.
3. Grid range-join.  Of two points within distance `2r`, one half of the segments is within
   `r`.  With r = 2 both sides then share a grid point at distance 1 or less from either, in
   that half.  So every point is put into the cells of itself and of its unit neighbours, per
   half, and points of one cell are compared exactly.
4. Components of the links that hold.

A cell yields a spanning forest of its links only, so groups of close fingerprints don't
multiply.  Cells that could exceed `most_cell` points are cut into blocks and compared block
by block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.bpe import slices, text_sizes
from tallyforge.llm.shared import Scratch, components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
SEED = 42
#: Segments of two bits in each half of a fingerprint.
SEGMENTS = 16
#: The largest radius for which two points of a half share a cell with unit neighbours.
MOST_BITS_APART = 5
#: Points in a cell including its unit neighbours: itself and two for each segment.
NEIGHBOURS = 1 + 2 * SEGMENTS


def word_runs(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in order, in runs of about `most` bytes that end at white space."""
    at = 0
    while at < len(text):
        end = SPACE.search(text, at + most)
        stop = end.start() if end else len(text)
        yield text[at:stop].split()
        at = stop


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of `size` words joined by spaces; of all words if there are fewer."""
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(text: bytes, size: int) -> int:
    """Bit i is 1 if it is set in over half of the hashes of a text's shingles; 0 without words."""
    votes, total, carried = np.zeros(64, np.int64), 0, []
    first: list[bytes] = []

    def count(hashes: np.ndarray) -> None:
        nonlocal votes, total
        for i in range(0, len(hashes), 1 << 14):
            bits = np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for run in word_runs(text.translate(LOWER)):
        words = carried + run
        if len(words) >= size:
            count(shingle_hashes(words, size))
            carried = words[len(words) - size + 1 :]
        else:
            carried = words
            first = words
    if not total and first:
        count(shingle_hashes(first, size))
    return sum(1 << i for i in np.flatnonzero(2 * votes > total).tolist()) if total else 0


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp): one row per row of `docs` (doc_id long, text string); fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, text_sizes(whole.column("text"))):
                texts = part.column("text").cast(pa.large_binary())
                own = [fingerprint(x.as_py() or b"", words) for x in texts]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.array(own, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def points(fps: np.ndarray) -> np.ndarray:
    """Each fingerprint's counts of ones by segment, two bits a count, 32 counts a word."""
    odd = np.uint64(0x5555555555555555)
    return (fps & odd) + (fps >> np.uint64(1) & odd)


def own_cells(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells in which a fingerprint's point lies: one number for each half."""
    p = points(fps)
    low = np.uint64(0xFFFFFFFF)
    return (p & low).astype(np.int64), (p >> np.uint64(32)).astype(np.int64) | np.int64(1 << 32)


def cells(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, index of the fingerprint) of every point and its unit neighbours in both halves."""
    keys, rows, everyone = [], [], np.arange(len(fps))
    for cell in own_cells(fps):
        keys.append(cell)
        rows.append(everyone)
        for s in range(SEGMENTS):
            count = cell >> 2 * s & 3
            for step, able in ((1, count < 2), (-1, count > 0)):
                keys.append(cell[able] + (step << 2 * s))
                rows.append(everyone[able])
    return np.concatenate(keys), np.concatenate(rows)


def _exploded(fps: DataFrame, own: bool) -> DataFrame:
    """(cell, fp) for the distinct fingerprints `fps`: their own cells, or those of unit neighbours too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), 4096):
                part = fp[i : i + 4096]
                key, row = (np.concatenate(own_cells(part)), np.tile(np.arange(len(part)), 2)) if own else cells(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row].view(np.int64))], names=["cell", "fp"])

    return fps.mapInArrow(run, "cell long, fp long")


def _united(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, list[int]]:
    """(new number of each of the groups 0 .. n-1 once groups x[i] and y[i] are one, the i that joined any)."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = parent[up]
            i = up
        return i

    joined = []
    for i, (p, q) in enumerate(zip(map(root, x.tolist()), map(root, y.tolist()), strict=True)):
        p, q = root(p), root(q)
        if p != q:
            parent[p] = q
            joined.append(i)
    into = np.arange(n)
    for i in parent:
        into[i] = root(i)
    return into, joined


def _links_in_cells(bits: int, blocks: bool):
    """Links between the fingerprints of each cell; input is sorted by cell (and block).

    Pairs that earlier links of the same rows connect are not looked at again, so a group of
    close fingerprints yields one link less than it has members.
    """
    names = ["cell", "block", "half", "fp"] if blocks else ["cell", "fp"]

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        fp, groups = columns[-1], columns[:2] if blocks else columns[:1]
        half = columns[2] if blocks else None
        same = np.ones(max(len(fp) - 1, 0), bool)
        for g in groups:
            same &= g[1:] == g[:-1]
        run_of = np.concatenate(([0], np.cumsum(~same)))
        values, name = np.unique(fp, return_inverse=True)
        u, part = fp.view(np.uint64), np.arange(len(values))
        left, right, at, shift = [], [], np.arange(len(fp)), 1
        while True:
            at = at[at + shift < len(fp)]
            at = at[run_of[at] == run_of[at + shift]]
            if not len(at):
                break
            apart = part[name[at]] != part[name[at + shift]]
            if half is not None:  # rows of two different blocks, or of one that is compared with itself
                apart &= (half[at] != half[at + shift]) | (half[at] == 2)
            here = at[apart]
            here = here[np.bitwise_count(u[here] ^ u[here + shift]) <= bits]
            if len(here):
                into, joined = _united(part[name[here]], part[name[here + shift]], len(values))
                part = into[part]
                left.append(fp[here[joined]])
                right.append(fp[here[joined] + shift])
            shift += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in names]
            held.append(columns)
            rows += batch.num_rows
            if rows < 1 << 17:
                continue
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = np.ones(rows, bool)
            for g in whole[: 2 if blocks else 1]:
                last &= g == g[-1]
            cut = int(np.argmax(last))  # the last group may go on
            if cut:
                yield links([x[:cut] for x in whole])
            held, rows = [[x[cut:] for x in whole]], rows - cut
        if held:
            yield links([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def close_fingerprints(scratch: Scratch, fps: DataFrame, bits: int, most_cell: int) -> DataFrame:
    """Links (a, b) between the distinct fingerprints `fps` that differ in at most `bits` bits.

    Not all of them, but enough to connect what all of them connect.  A cell holds the points
    of at most NEIGHBOURS own cells, so without an own cell of over most_cell / NEIGHBOURS
    points none exceeds `most_cell`; the others are counted and cut into blocks.
    """
    dense, (n_dense, _) = scratch.save_signed(
        _exploded(fps, own=True).groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") * NEIGHBOURS > most_cell).select("cell"), "dense"
    )
    rows = _exploded(fps, own=False)
    large = None
    if n_dense:
        reached = _neighbours(dense).distinct()
        counted = rows.join(reached, "cell", "left_semi").groupBy("cell").agg(F.count("*").alias("n"))
        large = scratch.save(counted.where(F.col("n") > most_cell).select("cell", F.ceil(F.col("n") / most_cell).cast("int").alias("blocks")), "large")
        rows = rows.join(large.select("cell"), "cell", "left_anti")
    links = rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_links_in_cells(bits, blocks=False), "a long, b long")
    if large is None:
        return links
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (
        _exploded(fps, own=False).join(large, "cell").withColumn("mine", mine)
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cell", (F.least("mine", "partner").cast("long") * F.col("blocks") + F.greatest("mine", "partner")).alias("block"),
            F.when(F.col("mine") == F.col("partner"), 2).otherwise((F.col("mine") > F.col("partner")).cast("int")).alias("half"), "fp",
        )
    )
    blocked = pairs.repartition("cell", "block").sortWithinPartitions("cell", "block").mapInArrow(_links_in_cells(bits, blocks=True), "a long, b long")
    return links.unionByName(blocked)


def _neighbours(dense: DataFrame) -> DataFrame:
    """(cell): the cells `dense` and their unit neighbours."""
    steps = [F.lit(0).cast("long")]
    for s in range(SEGMENTS):
        count = F.shiftrightunsigned("cell", 2 * s).bitwiseAND(F.lit(3).cast("long"))
        steps += [F.when(count < 2, F.lit(1 << 2 * s).cast("long")), F.when(count > 0, F.lit(-(1 << 2 * s)).cast("long"))]
    return dense.select(F.explode(F.array(*steps)).alias("step"), "cell").where("step is not null").select((F.col("cell") + F.col("step")).alias("cell"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4, most_cell: int = 32_768
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 lower-case hex digits), component_id.

    A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D; a shingle is
    `words` successive words joined by a space, repeats included, or all words if there are
    fewer.  A bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 of
    seed 42.  Null and empty texts and those without words have fingerprint zero, which links
    like any other.  Documents link if their fingerprints differ in at most `bits` bits (5 at
    most); component_id is the smallest id reachable by links, the document's own included.
    Null ids rank last: a component of null ids only has null.  Rows that repeat an id or a
    text are documents of their own.  An empty table gives no rows; further columns are ignored.
    """
    if not 0 <= bits <= MOST_BITS_APART:
        raise ValueError(f"bits must be 0 to {MOST_BITS_APART}")
    scratch = Scratch(docs.sparkSession, "simhash")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = scratch.save(fingerprints(own, words), "marked")
    classes = scratch.save(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    links = scratch.save(close_fingerprints(scratch, classes.select("fp"), bits, most_cell).distinct(), "links")
    found = scratch.save(components(scratch, links), "components")
    grouped = scratch.save(
        classes.join(found, F.col("fp") == F.col("id"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "grouped"
    )
    smallest = scratch.save(grouped.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    named = scratch.save(grouped.join(smallest, "component").select("fp", "component_id"), "named")
    scratch.drop("classes", "dense", "large", "links", "edges", "low", "components", "grouped", "smallest")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
