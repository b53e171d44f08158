"""Exact top-k inner-product search with dual cover trees.

Vectors are dealt to blocks of bounded size around pivots, queries to groups around the same
pivots.  A first round searches each query's own block, so every query starts from a real kth
score.  Then each query group is held against the centre and radius of every block: blocks
that cannot hold a better score for any of its queries are dropped before anything is copied
to them.  For each pair that is left, a task indexes both sides in cover trees and walks them
together: a pair of nodes is dropped once the inner product of their centres plus what their
covering radii allow is below the worst kth score of the node's queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.shared import Scratch

#: The least score: below every real one.
NONE = np.iinfo(np.int64).min
#: Scaled components from here on do not fit 64 bits.
LARGEST = float(1 << 63)


class CoverTree:
    """A cover tree with expansion base 1.3; every node is a run of rows of the reordered points.

    Children lie within the node's radius divided by the base of their own centres, centres
    are farther than that from each other, and the first child keeps the node's centre.
    Children of fewer than leaf / 8 points are gathered in one leaf around the node's centre,
    so points without neighbours don't become a node each.
    """

    def __init__(self, points: np.ndarray, leaf: int = 256, base: float = 1.3):
        self.leaf, self.base = leaf, base
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.run: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.order = np.arange(len(points))
        self._grow(points)
        self.points = points[self.order]
        place = np.empty(len(points), np.int64)
        place[self.order] = np.arange(len(points))
        self.centres = points[self.centre].astype(np.float64)
        self.norms = np.sqrt((self.centres**2).sum(1))

    def _node(self, centre: int, radius: float, lo: int, hi: int) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.run.append((lo, hi))
        self.children.append([])
        return len(self.centre) - 1

    def _grow(self, x: np.ndarray) -> None:
        first = np.sqrt(((x - x[0]) ** 2).sum(1))
        stack = [(self._node(0, float(first.max()), 0, len(x)), first)]
        while stack:
            node, far = stack.pop()
            lo, hi = self.run[node]
            if hi - lo <= self.leaf or self.radius[node] == 0:
                continue
            rows, reach = self.order[lo:hi].copy(), self.radius[node] / self.base
            centre, parts = self.centre[node], []
            while len(rows):
                if parts:
                    centre = int(rows[0])
                    far = np.sqrt(((x[rows] - x[centre]) ** 2).sum(1))
                near = far <= reach
                parts.append((centre, rows[near], far[near]))
                rows, far = rows[~near], far[~near]
            strays = [own for _, own, _ in parts if len(own) < self.leaf // 8]
            parts = [p for p in parts if len(p[1]) >= self.leaf // 8]
            at = lo
            for centre, own, far in parts:
                self.order[at : at + len(own)] = own
                child = self._node(centre, float(far.max()), at, at + len(own))
                self.children[node].append(child)
                stack.append((child, far))
                at += len(own)
            if strays:
                own = np.concatenate(strays)
                self.order[at:hi] = own
                centre = self.centre[node]
                far = np.sqrt(((x[own] - x[centre]) ** 2).sum(1))
                self.children[node].append(self._node(centre, float(far.max()), at, hi))


def slack(top, size):
    """An upper bound that rounding cannot undercut, for sums of products of about `size`."""
    return top + 1e-9 * size + 1e-3


def dual_search(queries: np.ndarray, query_rows: np.ndarray, floor: np.ndarray, points: np.ndarray, point_rows: np.ndarray, point_ids: np.ndarray, k: int):
    """(query, point id, score) of up to k best points a query with scores of at least `floor`; ties to smaller ids.

    A point is not compared with the query of the same row number.  Sums that could pass 2^53
    are taken in 64-bit integers, those that could pass 2^63 in integers of any size.
    """
    largest = math.prod(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (queries, points)) * queries.shape[1]
    dtype = np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 63 else object
    q_tree, p_tree = CoverTree(queries.astype(np.float64)), CoverTree(points.astype(np.float64))
    qx, px = queries[q_tree.order].astype(dtype), points[p_tree.order].astype(dtype)
    q_rows, p_rows, p_ids = query_rows[q_tree.order], point_rows[p_tree.order], point_ids[p_tree.order]
    worst = floor[q_tree.order].astype(dtype)
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(qx))]

    def bounds(q: int, nodes: list[int]) -> np.ndarray:
        centre, radius = p_tree.centres[nodes], np.array([p_tree.radius[p] for p in nodes])
        rq = q_tree.radius[q]
        reach = rq * p_tree.norms[nodes] + radius * q_tree.norms[q] + rq * radius
        return slack(centre @ q_tree.centres[q] + reach, p_tree.norms[nodes] * q_tree.norms[q] + reach)

    def base_case(q: int, p: int) -> None:
        (a, b), (c, d) = q_tree.run[q], p_tree.run[p]
        scores = qx[a:b] @ px[c:d].T
        hit = (scores >= worst[a:b, None]) & (p_rows[None, c:d] != q_rows[a:b, None])
        for i in np.flatnonzero(hit.any(1)):
            j = np.flatnonzero(hit[i])
            if len(j) > 4 * k:
                # keep what could be among the k best, ties included
                j = j[scores[i, j] >= np.sort(scores[i, j])[len(j) - k]]
            mine = best[a + i]
            mine.extend((-int(s), int(v)) for s, v in zip(scores[i, j], p_ids[c + j], strict=True))
            mine.sort()
            del mine[k:]
            if len(mine) == k:
                worst[a + i] = max(worst[a + i], -mine[-1][0])

    stack = [(0, 0)]
    while stack:
        q, p = stack.pop()
        a, b = q_tree.run[q]
        if bounds(q, [p])[0] < worst[a:b].min():
            continue
        q_kids, p_kids = q_tree.children[q], p_tree.children[p]
        if not q_kids and not p_kids:
            base_case(q, p)
        elif p_kids and (not q_kids or p_tree.radius[p] >= q_tree.radius[q]):
            top = bounds(q, p_kids)
            order = np.argsort(top)  # the most promising is popped first
            stack.extend((q, p_kids[i]) for i in order if top[i] >= worst[a:b].min())
        else:
            stack.extend((child, p) for child in q_kids)
    return [(int(q_tree.order[i]), v, -s) for i, mine in enumerate(best) for s, v in mine]


def _matrices(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal vector length: their numbers in the table, and the vectors."""
    column = table.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, flat[offsets[rows][:, None] + np.arange(length)]


#: Candidates, and (in rows of their own) the centres and radii of the vectors of one length in a block.
FOUND = "row long, query_id long, vec_id long, score long, block int, centre array<double>, radius double"


def _result(found: list[tuple[int, int, int]], rows: np.ndarray, ids: np.ndarray, block: int = 0, spheres: list[tuple[np.ndarray, float]] = ()) -> pa.Table:
    """The candidates (query, vec_id, score), and the `spheres` of the block; scores beyond 64 bits raise OverflowError."""
    n, q = len(spheres), [f[0] for f in found]
    long = lambda x: pa.array([*map(int, x), *[None] * n], pa.int64())
    return pa.table({
        "row": long(rows[i] for i in q), "query_id": long(ids[i] for i in q), "vec_id": long(f[1] for f in found), "score": long(f[2] for f in found),
        "block": pa.array([None] * len(q) + [block] * n, pa.int32()),
        "centre": pa.array([None] * len(q) + [c for c, _ in spheres], pa.list_(pa.float64())), "radius": pa.array([None] * len(q) + [r for _, r in spheres], pa.float64()),
    })


def _sphere(x: np.ndarray) -> tuple[np.ndarray, float]:
    centre = x.astype(np.float64).mean(0)
    return centre, float(np.sqrt(((x - centre) ** 2).sum(1)).max(initial=0.0))


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x); vectors or ids that are null or hold null or non-finite components are left out.

    A component that does not fit 64 bits after scaling raises an error.
    """
    x = F.col("x")
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    too_large = F.raise_error(F.lit("a scaled component does not fit 64 bits")).cast("long")
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select("vec_id", F.transform("x", lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("long")).otherwise(too_large)).alias("v"))
    )


def _in_chain(chosen: list[np.ndarray]) -> list[np.ndarray]:
    """The pivots, each followed by the nearest of those left, so that neighbours share blocks and groups."""
    out = []
    for length in sorted({len(x) for x in chosen}):
        x = np.stack([c for c in chosen if len(c) == length])
        left, at = np.ones(len(x), bool), 0
        for _ in range(len(x)):
            left[at] = False
            out.append(x[at])
            far = np.where(left, ((x - x[at]) ** 2).sum(1), np.inf)
            at = int(far.argmin())
    return out


def top_k(
    vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    pivots: int = 32, most_pivots: int = 2048, block_rows: int = 2048, group_rows: int = 1024, most_centres: int = 1 << 22,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's k best other rows by inner product.

    `is_query` is a condition on vec_id.  Scores are of vectors scaled and floored to integers;
    ties go to the smaller vec_id.  Vectors null or holding null or non-finite components, and
    null ids, take no part.  Rows that repeat an id are vectors of their own, and queries of
    their own.  Vectors of different lengths are not compared; an empty table gives no rows.
    Components may be of any size that fits 64 bits after scaling; a score among a query's best
    that does not fit raises an error.

    One row in `block_rows`, but at least `pivots` and at most `most_pivots`, reaches the driver
    as a pivot.  Centres of blocks are broadcast in parts of `most_centres` numbers.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    data = quantized(vectors, id_col, vector_col, scale).withColumns({"is_query": is_query, "row": F.monotonically_increasing_id()})
    data, (n, _) = scratch.save_signed(data, "vectors")
    n_pivots = min(max(n // block_rows, pivots), most_pivots)
    chosen = [np.array(r["v"], np.float64) for r in data.orderBy(F.xxhash64("vec_id"), "row").limit(n_pivots).select("v").collect()]
    marks = spark.sparkContext.broadcast(_in_chain(chosen))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot = np.zeros(batch.num_rows, np.int32)
            for rows, x in _matrices(pa.Table.from_batches([batch])):
                same = [i for i, m in enumerate(marks.value) if len(m) == x.shape[1]]
                if same:
                    m = np.stack([marks.value[i] for i in same])
                    pivot[rows] = np.array(same)[((m**2).sum(1)[None, :] - 2 * x.astype(np.float64) @ m.T).argmin(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=[*batch.schema.names, "pivot"])

    near = scratch.save(data.mapInArrow(nearest, data.withColumn("pivot", F.lit(0)).schema), "near")
    counts = {r["pivot"]: (r["n"], r["q"]) for r in near.groupBy("pivot").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).collect()}
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def numbered(rows_per: int, which: int) -> dict[int, tuple[int, int]]:
        """(first number, parts) by pivot: large pivots are split evenly, small ones share a number."""
        out, total, room = {}, 0, 0
        for pivot in sorted(counts):
            rows = counts[pivot][which]
            if rows > rows_per:
                out[pivot] = total, math.ceil(rows / rows_per)
                total, room = total + out[pivot][1], 0
            else:
                if rows > room or not total:
                    total, room = total + 1, rows_per
                out[pivot] = total - 1, 1
                room -= rows
        return out

    blocks, groups = numbered(block_rows, 0), numbered(group_rows, 1)
    places = spark.createDataFrame([(p, *blocks[p], *groups[p]) for p in sorted(counts)], "pivot int, block0 int, blocks int, group0 int, groups int")
    part = lambda seed, of: F.pmod(F.xxhash64(F.lit(seed), "row"), F.col(of)).cast("int")
    dealt = near.join(F.broadcast(places), "pivot").select(
        "row", "vec_id", "v", "is_query", (F.col("block0") + part(1, "blocks")).alias("block"), (F.col("group0") + part(2, "groups")).alias("group")
    )

    def own_block(table: pa.Table) -> pa.Table:
        number, ids, flag, found, spheres = table.column("row").to_numpy(), table.column("vec_id").to_numpy(), table.column("is_query").to_numpy().astype(bool), [], []
        for rows, x in _matrices(table):
            spheres.append(_sphere(x))
            q = np.flatnonzero(flag[rows])
            if len(q):
                got = dual_search(x[q], number[rows[q]], np.full(len(q), NONE), x, number[rows], ids[rows], k)
                found += [(rows[q[i]], v, s) for i, v, s in got]
        return _result(found, number, ids, table.column("block")[0].as_py(), spheres)

    searched = scratch.save(dealt.groupBy("block").applyInArrow(own_block, FOUND), "own-block")
    first = searched.where("row IS NOT NULL").select("row", "query_id", "vec_id", "score")
    kth = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k).select("row", "kth")
    queries = scratch.save(dealt.where("is_query").join(kth, "row", "left").select("row", "vec_id", "v", "block", "group", F.coalesce("kth", F.lit(NONE)).alias("kth")), "queries")

    def group_spheres(table: pa.Table) -> pa.Table:
        floor = table.column("kth").to_numpy()
        out = [(*_sphere(x), int(floor[rows].min())) for rows, x in _matrices(table)]
        return pa.table({
            "group": pa.array([table.column("group")[0].as_py()] * len(out), pa.int32()), "centre": pa.array([c for c, _, _ in out], pa.list_(pa.float64())),
            "radius": pa.array([r for _, r, _ in out], pa.float64()), "kth": pa.array([f for _, _, f in out], pa.int64()),
        })

    around = scratch.save(queries.groupBy("group").applyInArrow(group_spheres, "group int, centre array<double>, radius double, kth long"), "groups")
    pairs = scratch.save(_reachable(around, searched.where("centre IS NOT NULL"), most_centres), "pairs")
    points = dealt.join(pairs.select(F.col("at").alias("block"), F.col("group").alias("at_group")), "block")
    both = queries.join(pairs, "group").where("at <> block").select(F.col("at").alias("block"), "group", "row", "vec_id", "v", "kth", F.lit(True).alias("is_query")).unionByName(
        points.select("block", F.col("at_group").alias("group"), "row", "vec_id", "v", F.lit(NONE).alias("kth"), F.lit(False).alias("is_query"))
    )

    def other_block(table: pa.Table) -> pa.Table:
        number, ids, flag, floor, found = table.column("row").to_numpy(), table.column("vec_id").to_numpy(), table.column("is_query").to_numpy().astype(bool), table.column("kth").to_numpy(), []
        for rows, x in _matrices(table):
            q, p = np.flatnonzero(flag[rows]), np.flatnonzero(~flag[rows])
            if len(q) and len(p):
                got = dual_search(x[q], number[rows[q]], floor[rows[q]], x[p], number[rows[p]], ids[rows[p]], k)
                found += [(rows[q[i]], v, s) for i, v, s in got]
        return _result(found, number, ids)

    rest = scratch.save(both.groupBy("block", "group").applyInArrow(other_block, FOUND).select("row", "query_id", "vec_id", "score"), "others")
    scratch.drop("vectors", "near", "queries", "groups", "pairs")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _reachable(around: DataFrame, spheres: DataFrame, most_centres: int) -> DataFrame:
    """(group, at): for each query group, the blocks that could hold a score of at least its worst kth one.

    The spheres of the blocks reach the tasks in parts of at most `most_centres` numbers.
    """
    sizes = spheres.select("block", F.size("centre").alias("d")).groupBy().agg(F.sum(F.col("d") + 2).alias("numbers"), F.max("block").alias("last")).first()
    n_parts = -(-int(sizes["numbers"] or 1) // most_centres)
    out = None
    for i in range(n_parts):
        own = spheres.where(F.pmod(F.col("block"), F.lit(n_parts)) == i).select("block", "centre", "radius").toArrow()
        shipped = around.sparkSession.sparkContext.broadcast([
            (np.array(own.column("block").take(rows)), np.array(own.column("radius").take(rows)), x)
            for rows, x in ((pa.array(rows), x) for rows, x in _matrices(own.rename_columns(["block", "v", "radius"])))
        ])

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for group, centre, radius, kth in zip(*(batch.column(c).to_pylist() for c in ("group", "centre", "radius", "kth")), strict=True):
                    centre = np.array(centre)
                    norm = float(np.sqrt((centre**2).sum()))
                    for block, radii, x in shipped.value:
                        if x.shape[1] == len(centre):
                            norms = np.sqrt((x**2).sum(1))
                            reach = radius * norms + radii * norm + radius * radii
                            at = block[slack(x @ centre + reach, norms * norm + reach) >= kth]
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), group, np.int32)), pa.array(at.astype(np.int32))], names=["group", "at"])

        pairs = around.mapInArrow(run, "group int, at int")
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()
