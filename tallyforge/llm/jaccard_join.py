"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes.  It is cut into vertical
fragments, more of them the larger a set is:

1. Candidates.  Two linked sets of sizes a and b differ in at most d n-grams.  With more
   than d fragments, some fragment holds equal n-grams in both, so sets that share the hash
   of no fragment cannot link.  Fragments are counted by key with map-side combine; only
   keys that two different sets share go on.
2. Partial overlaps.  For each candidate pair the overlap is counted within each fragment
   separately and summed per pair; the sum decides.
3. Components.  First each set is compared with one pivot per shared fragment.  Fragments
   whose sets are still in several components are compared set by set: first within blocks of
   bounded size, where a spanning forest of likely links is enough; then, where there are
   several blocks or a likely link failed, the largest component's blocks meet those of the
   other sets, and these meet each other.  Likely links are those with few enough unequal
   fine fragments; each is decided as in 2.  A pair is skipped only if its sets are already
   connected or provably too far apart, so components are exact.

Equal sets are one class: copies never multiply.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.bpe import slices
from tallyforge.llm.shared import MOST_BITS, Scratch, bitmap_array, bitmap_bits, components, marked_rows, refine

M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Sizes from bound k to bound k+1 share their cuts; a size within reach of the next bound takes part there too.
RATIO = 1.4
#: Fine fragments to a coarse one, so that there are about as many as n-grams.  Each is told by four bits, so of sixteen unequal ones fifteen show.
FINE = 4


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of BASE and of its inverse modulo 2^64."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` of UTF-8 bytes, A-Z lower-cased, in order.

    Long inputs go in runs of about `most` bytes that end at white space.
    """
    if len(data) > 2 * most:
        spaces = np.flatnonzero(IS_SPACE[data])
        at, parts = 0, []
        while at < len(data):
            k = np.searchsorted(spaces, at + most)
            end = int(spaces[k]) if k < len(spaces) else len(data)
            parts.append(_word_hashes(data[at:end]))
            at = max(end, at + 1)
        return np.concatenate(parts)
    return _word_hashes(data)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data] + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(data: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `words` words; fewer words count as one shingle."""
    w = word_hashes(data)
    if not len(w):
        return w
    size = min(words, len(w))
    out = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(BASE) + w[k : len(w) - size + 1 + k])
    return np.unique(out)


class Cuts:
    """Fragments by set size, for links at `percent` per cent: 100 * both >= percent * either."""

    def __init__(self, percent: int):
        self.percent = percent

    def differ(self, total):
        """The most n-grams in which linked sets of sizes that sum to `total` differ."""
        return total - 2 * ((self.percent * total + 99 + self.percent) // (100 + self.percent))

    def classes(self, size: int) -> list[int]:
        """The size classes in which a set takes part; linked sets share one."""
        own = int(np.floor(np.log(size) / np.log(RATIO) + 1e-9))
        while self.bound(own + 1) <= size:
            own += 1
        while self.bound(own) > size:
            own -= 1
        largest = size * 100 // self.percent
        out = [own]
        while self.bound(out[-1] + 1) <= largest:
            out.append(out[-1] + 1)
        return out

    @staticmethod
    def bound(k: int) -> int:
        return int(np.ceil(RATIO**k))

    @functools.cache  # noqa: B019
    def coarse(self, k: int) -> tuple[int, int]:
        """Of class k: the number of coarse fragments, and how many of those beyond the guaranteed one are spare.

        The spare ones are enough for nearly all members to leave out their weakest fragments:
        those of up to two or one n-grams if that takes few more fragments, else the empty ones.
        """
        largest = self.bound(k + 1) - 1
        smallest = max(self.bound(k) * self.percent // 100, 1)
        # Members are below the next bound, or below it by class; partners may reach it.
        d = (100 - self.percent) * 2 * largest // (100 + self.percent)  # bounds `differ` for every smaller sum
        for weak, most in ((2, 2 + d // 6), (1, 2 + d // 6), (0, 2 + d // 2)):
            for spare in range(2, most + 1):
                n = d + 1 + spare
                load = smallest / n
                m = n * math.exp(-load) * sum(load**i / math.factorial(i) for i in range(weak + 1))
                if m + 2 * math.sqrt(m) <= spare:
                    return n, spare
        spare = 2 + d // 8
        return d + 1 + spare, spare

    def cut(self, tokens: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """4-bit hashes of the fine fragments, two a byte, and the 64-bit keys of the coarse ones (FINE fine ones each).

        A linked pair has at least one coarse fragment more in common than there are spare
        ones.  So a set's fragments of at most w n-grams can go without a key if there are no
        more of them than spare ones: of those in common one of more n-grams is left, and the
        partner keys it too, as its own w, if larger, leaves one by the same count.
        """
        n, spare = self.coarse(k)
        # fragment number = floor(token * FINE * n / 2^64), from the upper 32 bits
        where = ((tokens >> np.uint64(32)) * np.uint64(FINE * n)) >> np.uint64(32)
        first = np.searchsorted(where, np.arange(FINE * n + 1, dtype=np.uint64))
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(_mix(tokens + np.uint64(BASE)), out=sums[1:])
        at = sums[first]
        nibbles = (_mix(at[1:] - at[:-1]) >> np.uint64(60)).astype(np.uint8)
        fine = nibbles[::2] << 4 | nibbles[1::2]
        counts = np.diff(first[::FINE])
        salt = _mix(np.arange(n, dtype=np.uint64) + np.uint64(((k + 64) << 40) & M64))
        keys = _mix(_mix(np.diff(at[::FINE])) ^ salt)
        # The smallest count of which fragments cannot all go: the next one after the spare ones, in order of counts.
        return fine, keys[counts >= np.partition(counts, spare)[spare]]


FEATURES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("row_key", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("sid", T.LongType()),
    T.StructField("cuts", T.ArrayType(T.StructType([
        T.StructField("size_class", T.IntegerType()),
        T.StructField("fine", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]))),
])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of a batch with each text's bytes (null: none), without making strings of them."""
    for part in slices(batch, _sizes(batch), 1 << 20):
        column = part.column("text")
        offset_type = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], offset_type)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        yield part, [data[offsets[i] : offsets[i + 1]] if valid[i] else data[:0] for i in range(len(column))]


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    from tallyforge.llm.bpe import text_sizes

    return text_sizes(batch.column("text"))


def _sid(tokens: np.ndarray) -> int:
    """An identity of the set as a signed 64-bit value."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        value = _mix(np.array([np.add.reduce(_mix(tokens + np.uint64(7))) * np.uint64(BASE) + np.uint64(len(tokens))], np.uint64))
    return int(value.view(np.int64)[0])


def _cuts_of(docs_text: np.ndarray, words: int, cuts: Cuts) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """A text's shingles, and (size class, fine hashes, keys) for each class it takes part in."""
    tokens = shingles(docs_text, words)
    return tokens, [(k, *cuts.cut(tokens, k)) for k in cuts.classes(len(tokens))] if len(tokens) else []


def features(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: set size, set identity, and the cuts of each size class."""
    cuts = Cuts(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part, texts in _texts(whole):
                sizes, sids, per_doc, classes, fines, keys = [], [], [0], [], [], []
                for data in texts:
                    tokens, own = _cuts_of(data, words, cuts)
                    sizes.append(len(tokens))
                    sids.append(_sid(tokens))
                    for k, fine, key in own:
                        classes.append(k)
                        fines.append(fine.tobytes())
                        keys.append(key.view(np.int64))
                    per_doc.append(len(classes))
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                ends = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
                entries = pa.StructArray.from_arrays(
                    [pa.array(classes, pa.int32()), pa.array(fines, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["size_class", "fine", "keys"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("row_key"), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), entries),
                    ],
                    names=["doc_id", "row_key", "n_shingles", "sid", "cuts"],
                )

    return docs.mapInArrow(run, FEATURES)


#: Keys are counted by their upper 40 bits, which take less room in a shuffle; the few that share them go on and differ later.
SPOT_SHIFT = 24


def spot_of(key) -> Column:
    return F.shiftrightunsigned(key, SPOT_SHIFT)


def marked_keys(sets: DataFrame, repeated: DataFrame, n_repeated: int, most_bits: int) -> DataFrame:
    """(key, sid, size_class) of the keys of `sets` whose spots are among the `repeated` ones, and perhaps of a few others."""
    bits = bitmap_bits(n_repeated, per_row=32)
    if bits > most_bits:
        cut = sets.select("sid", F.explode("cuts").alias("c")).select("sid", "c.size_class", F.explode("c.keys").alias("key"))
        return cut.withColumn("spot", spot_of("key")).join(repeated, "spot", "left_semi").select("key", "sid", "size_class")
    marked = sets.sparkSession.sparkContext.broadcast(bitmap_array(repeated.select(F.pmod("spot", F.lit(bits)).alias("p")).distinct(), "p", bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marked.value
        for batch in batches:
            cut = batch.column("cuts").flatten()
            lists = cut.field("keys")
            per_cut = pc.list_value_length(lists).to_numpy()
            per_set = np.add.reduceat(np.append(per_cut, 0), batch.column("cuts").offsets.to_numpy()[:-1] - batch.column("cuts").offsets[0].as_py())
            per_set[pc.list_value_length(batch.column("cuts")).to_numpy() == 0] = 0
            key = lists.flatten().to_numpy()
            at = (key.view(np.uint64) >> np.uint64(SPOT_SHIFT)).astype(np.int64) % bits
            hit = (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[hit]), pa.array(np.repeat(batch.column("sid").to_numpy(), per_set)[hit]),
                    pa.array(np.repeat(cut.field("size_class").to_numpy(), per_cut)[hit]),
                ],
                names=["key", "sid", "size_class"],
            )

    narrow = sets.select("sid", F.transform("cuts", lambda c: F.struct(c["size_class"].alias("size_class"), c["keys"].alias("keys"))).alias("cuts"))
    return narrow.mapInArrow(run, "key long, sid long, size_class int")


#: Vertical fragments in which overlaps are counted, for sets of any size.
FRAGMENTS = 8


def fragments(docs: DataFrame, wanted: DataFrame, n_wanted: int, words: int, most_bits: int) -> DataFrame:
    """(sid, fragment, tokens) of the sets named by `wanted` (row_key), each once, and perhaps of a few others.

    Only documents that a bitmap over row_key marks are read by the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for _, texts in _texts(whole):
                sids, numbers, tokens = [], [], []
                for data in texts:
                    mine = shingles(data, words)
                    if not len(mine):
                        continue
                    sid = _sid(mine)
                    edges = np.searchsorted(mine >> np.uint64(61), np.arange(FRAGMENTS + 1, dtype=np.uint64))
                    for f in range(FRAGMENTS):
                        if edges[f + 1] > edges[f]:
                            sids.append(sid)
                            numbers.append(f)
                            tokens.append(mine[edges[f] : edges[f + 1]])
                flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
                ends = np.concatenate(([0], np.cumsum([len(x) for x in tokens]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sids, pa.int64()), pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["sid", "fragment", "tokens"],
                )

    found = marked_rows(docs, "row_key", wanted, n_wanted, most_bits).select("text").mapInArrow(run, "sid long, fragment int, tokens array<long>")
    return found.groupBy("sid", "fragment").agg(F.first("tokens").alias("tokens"))


def overlaps(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, size_a, size_b) that link: partial overlaps by fragment, summed per pair.

    N-grams and fine fragments have no proven bound, so their joins are merge joins at every size.
    """
    left = parts.select(F.col("sid").alias("a"), "fragment", F.col("tokens").alias("tokens_a"))
    right = parts.select(F.col("sid").alias("b"), "fragment", F.col("tokens").alias("tokens_b"))
    partial = (
        pairs.join(left.hint("merge"), "a").join(right.hint("merge"), ["b", "fragment"])
        .select("a", "b", "size_a", "size_b", F.size(F.array_intersect("tokens_a", "tokens_b")).alias("both"))
    )
    either = F.col("size_a") + F.col("size_b") - F.col("both")
    return (
        partial.groupBy("a", "b", "size_a", "size_b").agg(F.sum("both").alias("both"))
        .where(100 * F.col("both") >= percent * either)
        .select("a", "b")
    )


def _unequal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Unequal halves of bytes of packed rows."""
    z = x ^ y
    return np.count_nonzero(z & 0xF0, axis=-1) + np.count_nonzero(z & 0x0F, axis=-1)


def _near_enough(cuts: Cuts):
    """Of pairs with sizes and fine fragments of both sets, those that could link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy()
            far = cuts.differ(size_a + size_b)
            keep = np.abs(size_a - size_b) <= far
            fine_a, fine_b = batch.column("fine_a"), batch.column("fine_b")
            for i in np.flatnonzero(keep).tolist():
                keep[i] = _unequal(np.frombuffer(fine_a[i].as_buffer(), np.uint8), np.frombuffer(fine_b[i].as_buffer(), np.uint8)) <= far[i]
            names = ["a", "b", "size_a", "size_b"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names], names=names).filter(pa.array(keep, pa.bool_()))

    return run


def _close_pairs(cuts: Cuts, forest: bool):
    """In-task comparison of the sets of blocks, or of pairs of them: pairs in different components that could link.

    A table holds many such groups, each of bounded size.  With `forest`, only as many pairs
    of a group as would connect what they connect.
    """

    def pairs_of(size: np.ndarray, comp: np.ndarray, half: np.ndarray, fine: np.ndarray) -> list[tuple[int, int]]:
        rows, out, one_block = np.arange(len(size)), [], half[0] == ALONE
        _, tree = np.unique(comp, return_inverse=True)  # components as joined so far
        right = rows if one_block else np.flatnonzero(half == 1)
        for i in rows if one_block else np.flatnonzero(half == 0).tolist():
            other = right[right > i] if one_block else right
            far = cuts.differ(size[other] + size[i])
            near = (tree[other] != tree[i]) & (np.abs(size[other] - size[i]) <= far)
            j = other[near]
            j = j[_unequal(fine[j], fine[i]) <= far[near]]
            for k in j.tolist():
                if not forest:
                    out.append((i, k))
                elif tree[k] != tree[i]:
                    out.append((i, k))
                    tree[tree == tree[k]] = tree[i]
        return out

    def run(table: pa.Table) -> pa.Table:
        d = table.sort_by([("key", "ascending"), ("place", "ascending"), ("sid", "ascending")]).combine_chunks()
        column = {c: d.column(c).to_numpy() for c in ("key", "place", "sid", "n_shingles", "component", "half")}
        packed = pa.concat_arrays(d.column("fine").chunks)
        at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        data = np.frombuffer(packed.buffers()[2], np.uint8)
        changes = (np.diff(column["key"]) != 0) | (np.diff(column["place"]) != 0)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), d.num_rows]
        left, right = [], []
        for lo, hi in zip(edges, edges[1:], strict=False):
            fine = data[at[lo] : at[hi]].reshape(hi - lo, -1)
            own = slice(lo, hi)
            found = pairs_of(column["n_shingles"][own], column["component"][own], column["half"][own], fine)
            left += [lo + i for i, _ in found]
            right += [lo + k for _, k in found]
        sid, size = column["sid"], column["n_shingles"]
        a, b = sid[left], sid[right]
        first = a < b
        return pa.table({
            "key": pa.array(column["key"][left]), "a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)),
            "size_a": pa.array(np.where(first, size[left], size[right])), "size_b": pa.array(np.where(first, size[right], size[left])),
        })

    return run


PAIRS = "a long, b long, size_a long, size_b long"
#: Rows in a block of a fragment's largest component to those in a block of its other sets.
LARGER = 4


#: In place of the number of a half: the block is compared with itself.
ALONE = 2
#: About as many rows go to one call of the comparison.
BUNDLE = 8192


def _by_component(members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`members` with their component, keys whose sets are in several components)."""
    labelled = members.join(found.withColumnRenamed("id", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    parts = labelled.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("y")
    )
    keys = parts.groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    return labelled, keys.where("parts > 1 and n > 2").select("key", "n", F.col("top.n").alias("n_top"), F.col("top.component").alias("top"), "x", "y")


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Each set once, in a block of its fragment."""
    mine = F.pmod(F.xxhash64("sid", "key"), F.ceil(F.col("n") / F.lit(block))).cast("int")
    return rows.withColumns({"place": F.xxhash64(mine), "half": F.lit(ALONE)})


def _in_block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Each set in every pair of blocks in which it meets those of other components.

    The fragment's largest component is in blocks of its own, which meet the blocks of all
    other sets, but not each other.
    """
    n_top, n_rest = (F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("int") for n, size in ((F.col("n_top"), LARGER * block), (F.col("n") - F.col("n_top"), block)))
    is_top = F.col("component") == F.col("top")
    mine = F.pmod(F.xxhash64("sid", "key"), F.when(is_top, n_top).otherwise(n_rest)).cast("int")
    rows = rows.withColumn("mine", mine)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rest = rows.where(~is_top)
    place = lambda kind, a, b: F.xxhash64(F.lit(kind), a, b)
    top = rows.where(is_top).withColumn("partner", every(n_rest)).withColumns({"place": place("top", "mine", "partner"), "half": F.lit(1)})
    to_top = rest.withColumn("partner", every(n_top)).withColumns({"place": place("top", "partner", "mine"), "half": F.lit(0)})
    among = rest.withColumn("partner", every(n_rest)).withColumns({
        "place": place("rest", F.least("mine", "partner"), F.greatest("mine", "partner")),
        "half": F.when(F.col("mine") == F.col("partner"), ALONE).otherwise((F.col("mine") > F.col("partner")).cast("int")),
    })
    return top.unionByName(to_top).unionByName(among)


def labelled(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    block: int = 1024, most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, row_key, n_shingles, component (null for empty sets), component_id.

    row_key is the hash of id and text.  For the rest see `near_duplicates`.
    """
    cuts = Cuts(percent)
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.col(text_col).alias("text"),
    )
    sets = scratch.save(features(own, words, percent), "sets")
    repeated, (n_repeated, _) = scratch.save_signed(
        sets.select(F.explode(F.flatten("cuts.keys")).alias("key")).select(spot_of("key").alias("spot")).groupBy("spot").agg(F.count("*").alias("n")).where("n > 1").select("spot"), "repeated"
    )
    # Copies of a set fold; then only keys that two different sets share go on.
    folded = scratch.save(marked_keys(sets, repeated, n_repeated, most_bits).distinct(), "folded")
    shared = scratch.save(
        folded.groupBy("key").agg(F.min("sid").alias("pivot"), F.max("sid").alias("most")).where("pivot < most").select("key", "pivot"), "shared"
    )
    members = scratch.save(folded.join(shared, "key"), "members")
    names, (n_names, _) = scratch.save_signed(
        sets.select("sid", "row_key").join(members.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.min("row_key").alias("row_key")), "names"
    )
    # Keys are left behind before any row moves, and sets without a partner by their bitmap.
    narrow = sets.select("sid", "n_shingles", F.transform("cuts", lambda c: F.struct(c["size_class"].alias("size_class"), c["fine"].alias("fine"))).alias("cuts"))
    fines = scratch.save(
        marked_rows(narrow, "sid", names.select("sid"), n_names, most_bits).select("sid", "n_shingles", F.explode("cuts").alias("c"))
        .groupBy("sid", "c.size_class").agg(F.first("n_shingles").alias("n_shingles"), F.first("c.fine").alias("fine")),
        "fines",
    )
    rows = scratch.save(sets.select("doc_id", "row_key", "n_shingles", "sid"), "rows")
    scratch.drop("sets", "repeated", "folded", "shared")

    def decided(likely: DataFrame) -> tuple[DataFrame, int]:
        """The links among the likely pairs and their number, from the n-grams of their sets alone."""
        sids = likely.select(F.col("a").alias("sid")).unionByName(likely.select(F.col("b").alias("sid"))).distinct()
        wanted, (n_wanted, _) = scratch.save_signed(names.join(sids, "sid", "left_semi"), "wanted")
        links, (n_links, _) = scratch.save_signed(overlaps(likely, scratch.save(fragments(own, wanted, n_wanted, words, most_bits), "parts"), percent), "links")
        scratch.drop("wanted", "parts")
        return links, n_links

    # Round one: each set against the pivots of its fragments.
    stars = members.where("sid <> pivot").groupBy(F.col("pivot").alias("a"), F.col("sid").alias("b")).agg(F.min("size_class").alias("size_class"))
    both = stars
    for side in ("a", "b"):
        of = fines.select(F.col("sid").alias(side), "size_class", F.col("n_shingles").alias(f"size_{side}"), F.col("fine").alias(f"fine_{side}"))
        both = both.join(of.hint("merge"), [side, "size_class"])
    likely = scratch.save(both.select("a", "b", "size_a", "size_b", "fine_a", "fine_b").mapInArrow(_near_enough(cuts), PAIRS), "likely")
    found = scratch.save(components(scratch, decided(likely)[0]), "components")
    scratch.drop("likely", "links", "edges", "low")

    # Rounds two and three: fragments whose sets are still in several components; one of those with the same sets.
    known, open_keys = _by_component(members, found)
    known, open_keys = scratch.save(known, "known"), scratch.save(open_keys, "open")
    alone = open_keys.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    members = scratch.save(known.join(alone, "key", "left_semi").select("key", "sid", "size_class"), "members")
    scratch.drop("known")
    tried = None
    for forest in (True, False):
        if not forest:
            known, open_keys = _by_component(members, found)
            # A block whose likely links all proved links has nothing left to compare.
            again = open_keys.where(F.col("n") <= block).join(tried, "key", "left_semi")
            open_keys = open_keys.where(F.col("n") > block).unionByName(again)
        else:
            known, _ = _by_component(members, found)
        rows_in = known.join(open_keys, "key").join(fines.hint("merge"), ["sid", "size_class"])
        rows_in = (_in_blocks if forest else _in_block_pairs)(rows_in, block)
        rows_in = rows_in.select("key", "place", "half", "sid", "n_shingles", "component", "fine")
        # Most groups are small, so many of them go to one call; their number grows with the rows.
        bundles = max(open_keys.agg(F.sum("n")).first()[0] or 0, 1) // BUNDLE + 64
        bundle = F.pmod(F.xxhash64("key", "place"), F.lit(bundles))
        close = rows_in.groupBy(bundle).applyInArrow(_close_pairs(cuts, forest), f"key long, {PAIRS}")
        close, (n, _) = scratch.save_signed(close, "close")
        if not n:
            tried = close.select("key")
            continue
        likely = scratch.save(close.drop("key").distinct(), "likely")
        links, n_links = decided(likely)
        tried = scratch.save(close.join(links, ["a", "b"], "left_anti").select("key").distinct(), "tried")
        if n_links:
            found = scratch.save(refine(scratch, found, links), "components")
        scratch.drop("likely", "links", "edges", "low", "joined")

    grouped = (
        rows.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
        .join(found.withColumnRenamed("id", "sid"), "sid", "left")
        .select("sid", "doc_id", F.coalesce("component", "sid").alias("component"))
    )
    grouped = scratch.save(grouped, "grouped")
    smallest = scratch.save(grouped.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = scratch.save(grouped.join(smallest, "component").select("sid", "component", "component_id"), "named")
    scratch.drop("members", "names", "fines", "open", "close", "tried", "components", "grouped", "smallest")
    filled = rows.where("n_shingles > 0").join(named, "sid").select("doc_id", "row_key", "n_shingles", "component", "component_id")
    empty = rows.where("n_shingles = 0").select(
        "doc_id", "row_key", "n_shingles", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id")
    )
    return filled.unionByName(empty)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    block: int = 1024, most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    A document's set holds the distinct shingles of `words` words (A-Z lower-cased, words end
    at ASCII white space); with fewer words, the whole sequence is one shingle; without words
    or text the set is empty and links with nothing.  Documents link when their sets' Jaccard
    similarity is at least `percent` / 100.  component_id is the smallest id reachable by
    links, itself included (null ids rank last; a component of null ids only has null).  Rows
    that repeat an id are documents of their own under that id.  Further columns are ignored.
    Up to `most_bits` / 8 bytes a filter is broadcast; larger ones become joins.
    """
    return labelled(docs, id_col, text_col, words, percent, block, most_bits).select("doc_id", "n_shingles", "component_id")
