"""Approximate nearest neighbours by inner product: a forest of random-projection trees, one shared queue, exact reranking.

Fit: trees are grown on a bounded sample (taken by hash, held by the driver: a sixteenth of the vectors, at least
``sample`` and at most ``most`` of them, so that leaves become finer as the table grows): a node splits its vectors
at the median of their projections on the difference of two of them. Only the hyperplanes are kept. Index: every row
of the table walks down every tree to a leaf. Search: a query walks all trees through one priority queue, which
always opens the branch whose smallest margin on the way is least negative over the whole forest, until the opened
leaves hold the share of the table that was found to be enough. Rerank: inner products in double precision of the
query with all rows in the opened leaves.

How many leaves to open is measured on the table itself: the true neighbours of ``held`` sample vectors are found by
comparing them with every row, and the share is the smallest at which the queue reaches ``recall`` of them. So the
share falls as neighbours come nearer; on vectors without structure it stays a large part of the table.

Scale: the forest and all layouts are bounded by the sample. Leaves are cut into pieces of at most ``piece`` rows, by
counts that are aggregated first; pieces fill bins of about ``per_bin`` rows, and a bin that more than ``per_bin_queries``
queries ask is worked through in parts, each with that many queries at most: both sides of a task are bounded. What is
shuffled is, for each query, its vector once for each bin it opens, and for each part of a bin its rows. Each task
keeps a query's best ``k`` before anything is shuffled again. Equal vectors are one entry with their ``k + 1``
smallest ids, which is all that any list of ``k`` can use, so copies cannot fill a leaf.

Defined results. Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
with a null id. Vectors of different lengths have no inner product: each length is searched by itself. Repeated rows
of one id and vector are one candidate. A query never finds its own id. Ties go to smaller ids. Fewer candidates than
``k``: all of them. Other columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import durable, ship, table
from cellweave.llm.crosspolytope import usable

#: Least and most vectors of the sample on which trees are grown.
SAMPLE, MOST = 16384, 262144
LEAF = 48
TREES = 6
#: Sample vectors whose true neighbours show how much to open.
HELD = 256


@dataclass
class Tree:
    """Inner nodes as rows of ``normals`` and ``offsets``; ``children`` >= 0 are inner nodes, below that leaf -1 - c."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.offsets) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", x[inner], self.normals[node]) > self.offsets[node]).astype(int)
            at[inner] = self.children[node, side]
        return -1 - at


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    normals, offsets, children = [], [], []
    leaves = 0
    todo = [(np.arange(len(x)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                normal = a - b
                if not normal.any():
                    continue
                cast = x[rows] @ normal
                middle = float(np.median(cast))
                right = cast > middle
                if 0 < right.sum() < len(rows):
                    split = normal, middle, right
                    break
        if split is None:
            mark = -1 - leaves
            leaves += 1
        else:
            mark = len(offsets)
            normals.append(split[0] / np.linalg.norm(split[0]))
            offsets.append(split[1] / np.linalg.norm(split[0]))
            children.append([0, 0])
            todo += [(rows[split[2]], mark, 1), (rows[~split[2]], mark, 0)]
        if parent >= 0:
            children[parent][side] = mark
    d = x.shape[1]
    return Tree(np.array(normals).reshape(-1, d), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


class Forest:
    def __init__(self, trees: list[Tree], share: float):
        self.trees, self.share = trees, share
        self.first = np.cumsum([0, *(t.leaves for t in trees)])  # leaves are numbered over the whole forest

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([t.leaf_of(x) + f for t, f in zip(self.trees, self.first)], axis=1)

    def open(self, queries: np.ndarray, weight: np.ndarray, enough: float) -> Iterator[list[int]]:
        """For each query the leaves to look into, until their ``weight`` sums to ``enough``.

        One queue over all trees; a branch's priority is the smallest margin on its way, so that the side a
        query lies on keeps its parent's priority and the other side falls by its distance from the plane.
        """
        margins = [q @ t.normals.T - t.offsets if len(t.offsets) else None for t in self.trees for q in [queries]]
        children = [t.children.tolist() for t in self.trees]
        first, weight = self.first.tolist(), weight.tolist()
        roots = [(-np.inf, t, 0 if len(self.trees[t].offsets) else -1) for t in range(len(self.trees))]
        for i in range(len(queries)):
            rows = [None if m is None else m[i].tolist() for m in margins]
            queue, got, opened = list(roots), 0.0, []
            heapq.heapify(queue)
            while queue and got < enough:
                cost, t, node = heapq.heappop(queue)
                row, kids = rows[t], children[t]
                while node >= 0:
                    m = row[node]
                    pair = kids[node]
                    near, far = (pair[1], pair[0]) if m > 0 else (pair[0], pair[1])
                    away = m if m > 0 else -m
                    heapq.heappush(queue, (away if away > cost else cost, t, far))
                    node = near
                leaf = first[t] - 1 - node
                opened.append(leaf)
                got += weight[leaf]
            yield opened


def fit(x: np.ndarray, trees: int, leaf: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    return Forest([grow(x, leaf, rng) for _ in range(trees)], float(trees))


def rows_to_open(forest: Forest, held: np.ndarray, true: list[np.ndarray], weight: np.ndarray, recall: float) -> float:
    """How many rows (summed over trees) to open so that ``recall`` of the held vectors' true neighbours are met.

    ``true``: for each held vector the leaves (neighbours, trees) of its true neighbours; ``weight``: rows by leaf.
    """
    reached = []
    for opened, leaves in zip(forest.open(held, weight, np.inf), true):
        spent = np.full(len(weight), np.inf)
        spent[opened] = np.cumsum(weight[opened])
        reached += spent[leaves].min(axis=1).tolist()
    return float(np.quantile(reached, recall)) * 1.05 if reached else float(weight.sum())


def _stack(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)


def _true_neighbours(shared, k: int):
    """Over rows (vec, leaves): the best ``k`` of each held vector in this task, as (q, score, leaves)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        size = np.einsum("ij,ij->i", held, held)
        best, at = np.empty((len(held), 0)), None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, leaves = _stack(batch.column("vec"), batch.num_rows), np.asarray(batch.column("leaves").flatten()).reshape(batch.num_rows, -1)
            score = held @ x.T
            for q, r in zip(*np.nonzero(np.abs(score - size[:, None]) <= 1e-9 * size[:, None])):
                if (x[r] == held[q]).all():
                    score[q, r] = -np.inf  # the vector itself
            every = np.concatenate([best, score], axis=1)
            where = np.broadcast_to(leaves, (len(held), *leaves.shape)) if at is None else np.concatenate([at, np.broadcast_to(leaves, (len(held), *leaves.shape))], axis=1)
            top = np.argpartition(-every, min(k, every.shape[1]) - 1, axis=1)[:, :k]
            best, at = np.take_along_axis(every, top, 1), np.take_along_axis(where, top[:, :, None], 1)
        if at is not None:
            q, r = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(best[q, r]), pa.array(list(at[q, r]), pa.list_(pa.int64()))], names=["q", "score", "leaves"])

    return run


def _best(k: int, block: int = 128):
    """One bin: rows (spot, ids, vec) and queries (id, vec, spots) to each query's best ``k``."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            ids = left.column("ids").combine_chunks()
            heads = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
            order = np.argsort(heads, kind="stable")  # an entry may lie in leaves of several trees: it is compared once
            _, first, _ = _runs(heads[order])
            x, ids = _stack(left.column("vec"), left.num_rows)[order[first]], ids.take(pa.array(order[first]))
            offset, flat_ids = np.asarray(ids.offsets) - ids.offsets[0].as_py(), np.asarray(ids.flatten())
            spots, row_spot = np.unique(left.column("spot").to_numpy()[order], return_inverse=True)
            for lo in range(0, right.num_rows, block):
                part = right.slice(lo, block)
                q, names = _stack(part.column("vec"), part.num_rows), part.column("id").to_pylist()
                wanted = part.column("spots").combine_chunks()
                asks, who = np.asarray(wanted.flatten()), np.repeat(np.arange(part.num_rows), np.asarray(wanted.value_lengths()))
                at = np.minimum(np.searchsorted(spots, asks), len(spots) - 1)
                there = spots[at] == asks
                open_ = np.zeros((part.num_rows, len(spots)), bool)
                open_[who[there], at[there]] = True
                allowed = np.logical_or.reduceat(open_[:, row_spot], first, axis=1)
                some = np.flatnonzero(allowed.any(axis=0))  # entries that any of these queries opened
                if not len(some):
                    continue
                score = np.where(allowed[:, some], q @ x[some].T, -np.inf)
                most = min(k + 1, len(some))
                # ties at the border all stay: they are decided by id below
                floor = -np.partition(-score, most - 1, axis=1)[:, most - 1]
                for i, name in enumerate(names):
                    pick = np.flatnonzero((score[i] >= floor[i]) & (score[i] > -np.inf))
                    lines = sorted((-score[i, r], v) for r in pick for v in flat_ids[offset[some[r]] : offset[some[r] + 1]].tolist() if v != name)
                    seen: set[int] = set()
                    for s, v in lines:
                        if v not in seen:
                            seen.add(v)
                            out[0].append(name)
                            out[1].append(v)
                            out[2].append(-s)
                            if len(seen) == k:
                                break
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


class Layout:
    """Where the rows of a leaf go: pieces (numbered in the order of the forest) and bins of about ``per_bin`` rows."""

    def __init__(self, counts: np.ndarray, piece: int, per_bin: int):
        self.counts, self.per_bin = counts, per_bin
        self.pieces = -(-counts // piece)
        self.first = np.cumsum(self.pieces) - self.pieces
        self.before = np.cumsum(counts) - counts

    def bin_of(self, leaf: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The bin of a leaf's piece ``number`` (from 0)."""
        return (self.before[leaf] + number * self.counts[leaf] // np.maximum(self.pieces[leaf], 1)) // self.per_bin

    def all_pieces(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(spot, bin) of all pieces of some leaves."""
        n = self.pieces[leaves]
        leaf = np.repeat(leaves, n)
        number = np.arange(len(leaf)) - np.repeat(np.cumsum(n) - n, n)
        return self.first[leaf] + number, self.bin_of(leaf, number)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of equal values: the value, the first place, the place after the last."""
    starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return values[starts], starts, np.concatenate([starts[1:], [len(values)]])


RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, *, ident: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, most: int = MOST, held: int = HELD, trees: int = TREES, leaf: int = LEAF, recall: float = 0.95,
    piece: int = 4096, per_bin: int = 32768, per_bin_queries: int = 65536, seed: int = 11,
) -> DataFrame:
    """Each query's ``k`` nearest: query_id, rank (from 1), vec_id, score. ``is_query`` marks rows of ``vectors``."""
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = vectors.select(F.col(ident).cast("long").alias("id"), is_query.alias("asks"), F.expr(usable(f"cast(`{vector}` as array<{kind}>)")).alias("vec")).where("id is not null and vec is not null")
    ranked = Window.partitionBy("vec").orderBy("id")
    entries = rows.select("id", "vec").distinct().withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = durable(entries)
    widths = entries.groupBy(F.size("vec").alias("width")).agg(F.count("*").alias("n")).orderBy("width").collect()
    found = [spark.createDataFrame([], RESULT)] if not widths else []
    for width, n in widths:
        of_width = F.size("vec") == width
        some = entries.where(of_width)
        size = min(most, max(sample, n // 16))
        # the sample: the vectors with the smallest hashes, of those below a border that leaves a little more than enough
        border = min(1.0, (1.2 * size + 1000) / n)
        low = F.xxhash64("vec", F.lit(seed))
        taken = some.select("vec", low.alias("h")).where(F.col("h") <= int(-(2**63) + border * (2**64 - 1025))).orderBy("h").limit(size).select("vec").toArrow()
        x = _stack(taken.column("vec"), taken.num_rows)
        x = x[np.lexsort(x.T[::-1])]
        found.append(_search_width(some, rows.where("asks").where(of_width).select("id", "vec").distinct(), x, k, kind, held, trees, leaf, recall, piece, per_bin, per_bin_queries, seed))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_width(entries: DataFrame, queries: DataFrame, x: np.ndarray, k: int, kind: str, held: int, trees: int, leaf: int, recall: float, piece: int, per_bin: int, per_bin_queries: int, seed: int) -> DataFrame:
    """``search`` among vectors of one length: ``entries`` (vec, ids), ``queries`` (id, vec), the sample ``x``."""
    spark = entries.sparkSession
    forest = fit(x, trees, leaf, seed)
    shared = spark.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.leaves_of(_stack(batch.column("vec"), batch.num_rows))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * trees), pa.array(leaves.astype(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("vec"), lists], names=["ids", "vec", "leaves"])

    routed = durable(entries.select("ids", "vec").mapInArrow(route, f"ids array<long>, vec array<{kind}>, leaves array<long>"))
    counts = np.zeros(int(forest.first[-1]), np.int64)
    for r in routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).collect():  # at most the forest's leaves
        counts[r["leaf"]] = r["n"]
    # how much to open: the true neighbours of some sample vectors among all rows
    asked_first = x[np.random.default_rng(seed).permutation(len(x))[:held]]
    order = Window.partitionBy("q").orderBy(F.col("score").desc())
    true = routed.select("vec", "leaves").mapInArrow(_true_neighbours(spark.sparkContext.broadcast(asked_first), k), "q long, score double, leaves array<long>").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    by: dict[int, list] = {}
    for r in true.select("q", "leaves").collect():  # at most held x k rows
        by.setdefault(r["q"], []).append(r["leaves"])
    enough = rows_to_open(forest, asked_first[sorted(by)], [np.array(by[q]) for q in sorted(by)], counts.astype(np.float64), recall)
    shared_layout = spark.sparkContext.broadcast((Layout(counts, piece, per_bin), enough))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, _ = shared_layout.value
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves, at = np.asarray(batch.column("leaves").flatten(), np.int64), np.repeat(np.arange(batch.num_rows), trees)
            ids = batch.column("ids")
            smallest = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
            number = ((smallest[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % layout.pieces[leaves]
            pick = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(layout.bin_of(leaves, number)), pa.array(layout.first[leaves] + number), ids.take(pick), batch.column("vec").take(pick)], names=["bin", "spot", "ids", "vec"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, enough = shared_layout.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                bins, spots = [], []
                for opened in shared.value.open(_stack(part.column("vec"), part.num_rows), layout.counts.astype(np.float64), enough):
                    spot, bin_ = layout.all_pieces(np.array(sorted(opened), np.int64))  # in the order of the forest, bins never fall
                    names, starts, ends = _runs(bin_) if len(bin_) else ([], [], [])
                    bins.append(names)
                    spots.append([spot[a:b] for a, b in zip(starts, ends)])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vec"), pa.array(bins, pa.list_(pa.int64())), pa.array(spots, pa.list_(pa.list_(pa.int64())))], names=["id", "vec", "bins", "spots"])

    asked = durable(queries.mapInArrow(ask, f"id long, vec array<{kind}>, bins array<long>, spots array<array<long>>"))
    data = routed.mapInArrow(place, f"bin long, spot long, ids array<long>, vec array<{kind}>")
    rows = asked.select("id", "vec", F.explode(F.arrays_zip("bins", "spots")).alias("b")).select(F.col("b.bins").alias("bin"), "id", "vec", F.col("b.spots").alias("spots"))
    # bins that many queries ask are worked through in parts
    busy = durable(asked.select(F.explode("bins").alias("bin")).groupBy("bin").agg(F.count("*").alias("m")).where(F.col("m") > per_bin_queries).select("bin", F.ceil(F.col("m") / per_bin_queries).cast("int").alias("parts")))
    if busy.isEmpty():
        data, rows = data.withColumn("part", F.lit(0)), rows.withColumn("part", F.lit(0))
    else:
        parts = F.coalesce("parts", F.lit(1))
        data = data.join(busy, "bin", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        rows = rows.join(busy, "bin", "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("parts")
    best = data.groupBy("bin", "part").cogroup(rows.groupBy("bin", "part")).applyInArrow(_best(k), "query_id long, vec_id long, score double")
    # a candidate may come from several trees
    merged = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
