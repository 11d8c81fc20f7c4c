"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A hash rotates a unit vector by three rounds of random signs and a fast Hadamard transform, and takes the
signed axis nearest to the result; a table's key joins ``hashes`` of them. A vector lies in its own bucket of
each table, and also probes the buckets whose axes come next, in order of how little nearness they give up.
Two vectors are a candidate pair if one lies in a bucket that the other lies in or probes; candidates are
verified on the original vectors in double precision.

Work is on distinct vectors, each with the number of its copies, so copies never multiply; equal vectors link
with cosine 1. Inside a bucket no pairs are emitted: each block of a bucket is compared with each other block
of it (a bucket of any size is cut into blocks of at most ``block`` rows, and only blocks of one bucket
meet), and gives counts of links and edges that tie what is linked. A pair that meets in several buckets
counts only in the first: the keys of the two vectors in the tables before are computed again where they meet, for
linked vectors only, so rows carry nothing but the vector. ``hashes`` grows with the number of vectors, so that
buckets stay small, and ``tables`` grows with it to hold ``recall``. What is shuffled is tables x (1 + probes) x the
vectors; it grows with the number of tables, not with its square.

Defined results. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
their rows come back with no links and themselves as component. Vectors of different lengths never link. A null
vec_id: its row takes part in links, but can't name a component. Repeated rows count as further copies. Other
columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import durable, ship, table
from cellweave.llm.graph import components

BLOCK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


def _rotation_signs(width: int, seed: int, number: int) -> np.ndarray:
    return np.random.default_rng([seed, width, number]).integers(0, 2, (3, width)) * 2.0 - 1.0


def bucket_keys(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """For unit vectors (n, d): keys (n, tables, 1 + probes), the vector's own bucket first.

    Probes change one hash at a time to its next nearest axes, least loss first.
    """
    n, d = unit.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = unit
    out = np.empty((n, tables, 1 + probes), np.int64)
    span, deep = 2 * width, min(3, width)
    for t in range(tables):
        axes, losses = [], []
        for h in range(hashes):
            x = padded
            for signs in _rotation_signs(width, seed, t * hashes + h):
                x = hadamard(x * signs)
            size = np.abs(x)
            best = np.argpartition(-size, deep - 1, axis=1)[:, :deep]
            order = np.take_along_axis(best, np.argsort(-np.take_along_axis(size, best, 1), axis=1, kind="stable"), 1)
            axes.append(order * 2 + (np.take_along_axis(x, order, 1) < 0))
            top = np.take_along_axis(size, order, 1)
            losses.append(top[:, :1] - top)
        own = np.zeros(n, np.int64)
        for h in range(hashes):
            own = own * span + axes[h][:, 0]
        out[:, t, 0] = own
        if not probes:
            continue
        change, loss = [], []
        for h in range(hashes):
            scale = span ** (hashes - 1 - h)
            for r in range(1, deep):
                change.append((axes[h][:, r] - axes[h][:, 0]) * scale)
                loss.append(losses[h][:, r])
        least = np.argsort(np.stack(loss, 1), axis=1, kind="stable")[:, :probes]
        moved = own[:, None] + np.take_along_axis(np.stack(change, 1), least, 1)
        out[:, t, 1 : 1 + moved.shape[1]] = moved
        out[:, t, 1 + moved.shape[1] :] = own[:, None]
    return out


def plan(vectors: int, width: int, cosine: float, recall: float, probes: int) -> tuple[int, int]:
    """(hashes, tables) for so many distinct vectors: about 8 in a bucket, and misses below 1 - ``recall``.

    The chance that one hash of two vectors at distance tau agrees falls as d ** -(tau^2 / (4 - tau^2)); the
    factor 0.58 is measured. A pair meets in a table if all hashes agree, or in one of the probes.
    """
    axes = 2 * (1 << max(1, (width - 1).bit_length()))
    hashes = max(1, min(62 // math.ceil(math.log2(axes)), math.ceil(math.log(max(2, vectors / 8)) / math.log(axes))))  # a key has 62 bits
    apart = 2 - 2 * cosine
    own = (0.58 * (axes / 2) ** -(apart / (4 - apart))) ** hashes
    meets = 1 - (1 - own) ** (1 + probes)
    return hashes, max(4, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def usable(column: str) -> str:
    """SQL: the vector as doubles if every component is a finite number and one is not zero, else null."""
    good = f"{column} is not null and size({column}) > 0 and forall({column}, v -> v is not null and not isnan(v) and abs(v) < double('Infinity')) and exists({column}, v -> v <> 0)"
    return f"case when {good} then {column} end"


def _index(tables: int, hashes: int, probes: int, seed: int):
    """Rows (node, n, vec) with ``codes``: the vector's keys table by table, its own bucket first; -1 for a repeated one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                counts = np.asarray(part.column(2).value_lengths())
                for width in np.unique(counts):
                    some = part.take(pa.array(np.flatnonzero(counts == width)))
                    x = np.asarray(some.column(2).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
                    keys = bucket_keys(unit(x), tables, hashes, probes, seed)
                    for p in range(1, 1 + probes):
                        keys[:, :, p][(keys[:, :, p, None] == keys[:, :, :p]).any(axis=2)] = -1
                    per = keys.shape[1] * keys.shape[2]
                    codes = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * per), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([*some.columns, codes], names=["node", "n", "vec", "codes"])

    return run


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _first_meeting(kx: np.ndarray, ky: np.ndarray, t: int, key: int) -> np.ndarray:
    """For pairs with keys (m, tables, 1 + probes): whether table ``t``, bucket ``key`` is the first where they meet."""
    met = np.zeros(len(kx), bool)
    for before in range(t):
        met |= (kx[:, before, :1] == ky[:, before, :]).any(axis=1) | (ky[:, before, :1] == kx[:, before, :]).any(axis=1)
    # within the table a pair may meet in either's own bucket: the smaller key counts
    x_home, y_home = kx[:, t, 0], ky[:, t, 0]
    in_x = (ky[:, t, :] == x_home[:, None]).any(axis=1)
    in_y = (kx[:, t, :] == y_home[:, None]).any(axis=1)
    first = np.where(in_x & in_y, np.minimum(x_home, y_home), np.where(in_x, x_home, y_home))
    return ~met & (first == key)


Found = tuple[list, list, list]  # node, links, other: counts of links where other is null, else edges


@dataclass(frozen=True)
class Hashing:
    cosine: float
    tables: int
    hashes: int
    probes: int
    seed: int


def _compare(rows: pa.RecordBatch | pa.Table, left: np.ndarray, right: np.ndarray | None, how: Hashing, out: Found) -> None:
    """Compare two sets of rows of a bucket (or one with itself, ``right`` None), and add what is found to ``out``."""
    width, t, code = (rows.column(c)[0].as_py() for c in ("width", "t", "code"))
    whole = lambda name: c.combine_chunks() if isinstance(c := rows.column(name), pa.ChunkedArray) else c
    x = unit(np.asarray(whole("vec").flatten(), np.float64).reshape(rows.num_rows, width))
    second = left if right is None else right
    home = None
    edges: dict[int, int] = {}
    links: dict[int, int] = {}
    for lo in range(0, len(left), 512):
        some = left[lo : lo + 512]
        a, b = np.nonzero(x[some] @ x[second].T >= how.cosine)
        a, b = some[a], second[b]
        if right is None:
            a, b = a[a < b], b[a < b]
        if not len(a):
            continue
        if home is None:
            home, node, copies = (np.asarray(whole(n)) for n in ("home", "node", "n"))
            spot = np.full(rows.num_rows, -1)  # where a row's keys are, once they are known
            keys = np.empty((0, t + 1, 1 + how.probes), np.int64)
        ok = (home[a] + home[b] > 0) & (node[a] != node[b])
        a, b = a[ok], b[ok]
        new = np.unique(np.concatenate([a, b]))
        new = new[spot[new] < 0]
        if len(new):
            spot[new] = len(keys) + np.arange(len(new))
            keys = np.concatenate([keys, bucket_keys(x[new], t + 1, how.hashes, how.probes, how.seed)])
        for at in range(0, len(a), 65536):
            p, q = a[at : at + 65536], b[at : at + 65536]
            counted = _first_meeting(keys[spot[p]], keys[spot[q]], t, code)
            p, q = p[counted], q[counted]
            for u, c in zip(np.concatenate([p, q]).tolist(), np.concatenate([copies[q], copies[p]]).tolist()) if len(p) < 64 else _summed(p, q, copies):
                links[u] = links.get(u, 0) + c
            # of the pairs, those that join two trees keep what is connected
            for u, v in zip(*_forest(p, q, edges)):
                out[0].append(int(node[u]))
                out[1].append(0)
                out[2].append(int(node[v]))
    for u, c in links.items():
        out[0].append(int(node[u]))
        out[1].append(c)
        out[2].append(None)


def _summed(p: np.ndarray, q: np.ndarray, copies: np.ndarray) -> zip:
    total = np.zeros(len(copies), np.int64)
    np.add.at(total, p, copies[q])
    np.add.at(total, q, copies[p])
    some = np.flatnonzero(total)
    return zip(some.tolist(), total[some].tolist())


def _table(out: Found) -> dict[str, pa.Array]:
    return {"node": pa.array(out[0], pa.int64()), "links": pa.array(out[1], pa.int64()), "other": pa.array(out[2], pa.int64())}


BUCKET = ["width", "t", "code"]


def worth(batch: pa.RecordBatch, starts: np.ndarray, how: Hashing, small: int = 24) -> np.ndarray:
    """Of the buckets that end where the next of ``starts`` begins, those to compare: larger ones, and small ones with a near pair.

    Members of small buckets are compared for all buckets of the batch at once, each with the one d places after it.
    """
    sizes = np.diff(starts)
    if (batch.column("width").to_numpy() != batch.column("width")[0].as_py()).any():
        return sizes > 1
    out = sizes > small
    few = (sizes > 1) & ~out
    first, last = starts[:-1][few], starts[1:][few]
    at = np.arange(int((last - first).sum())) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
    stop, bucket = np.repeat(last, last - first), np.repeat(np.flatnonzero(few), last - first)
    x = unit(np.asarray(batch.column("vec").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1))
    home, node = batch.column("home").to_numpy(), batch.column("node").to_numpy()
    for d in range(1, small):
        ok = at + d < stop
        at, stop, bucket = at[ok], stop[ok], bucket[ok]
        if not len(at):
            break
        for lo in range(0, len(at), 16384):
            a, b = at[lo : lo + 16384], at[lo : lo + 16384] + d
            near = (np.einsum("ij,ij->i", x[a], x[b]) >= how.cosine - 1e-9) & (home[a] + home[b] > 0) & (node[a] != node[b])
            out[bucket[lo : lo + 16384][near]] = True
    return out


def _verify_runs(how: Hashing):
    """Over rows sorted by bucket, each bucket within one block: counts and edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(batch: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            out: Found = ([], [], [])
            for lo, hi in zip(starts.tolist(), ends.tolist()):
                if hi - lo > 1:
                    _compare(batch.slice(lo, hi - lo), np.arange(hi - lo), None, how, out)
            if out[0]:
                yield pa.RecordBatch.from_pydict(_table(out))

        open_ = None  # the bucket that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ is not None:
                batch = pa.concat_batches([open_, batch])
            changes = np.zeros(batch.num_rows - 1, bool)
            for c in BUCKET:
                values = batch.column(c).to_numpy()
                changes |= values[1:] != values[:-1]
            starts = np.concatenate([[0], np.flatnonzero(changes) + 1]).astype(np.int64)
            open_ = batch.slice(int(starts[-1]))
            some = worth(batch, starts, how)
            yield from work(batch, starts[:-1][some], starts[1:][some])
        if open_ is not None:
            yield from work(open_, np.array([0]), np.array([open_.num_rows]))

    return run


def _verify_blocks(how: Hashing):
    """One pair of blocks of a bucket too large for one block."""

    def run(key: tuple, found: pa.Table) -> pa.Table:
        i, j = key[-2].as_py(), key[-1].as_py()
        part = found.column("part").to_numpy()
        out: Found = ([], [], [])
        _compare(found, np.flatnonzero(part == i), None if i == j else np.flatnonzero(part == j), how, out)
        return pa.table(_table(out))

    return run


def _forest(p: np.ndarray, q: np.ndarray, parent: dict[int, int]) -> tuple[list[int], list[int]]:
    """Of the pairs, those that join two trees of the union-find ``parent`` (which they extend)."""

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = up
        return v

    out_a, out_b = [], []
    for u, v in zip(p.tolist(), q.tolist()):
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out_a.append(u)
            out_b.append(v)
    return out_a, out_b


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, *, ident: str = "vec_id", vector: str = "embedding", recall: float = 0.999, probes: int = 2, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.expr(usable(f"`{vector}`")).alias("vec"))
    rows = rows.withColumn("vec", F.expr(f"transform(vec, v -> v + cast(0 as {kind}))"))  # -0.0 counts as 0.0
    # equal vectors are one node
    nodes = durable(rows.where("vec is not null").groupBy("vec").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).withColumn("node", F.monotonically_increasing_id()))
    size = nodes.agg(F.count("*").alias("c"), F.max(F.size("vec")).alias("w"), F.min("node")).first()
    if size["c"]:
        hashes, tables = plan(size["c"], size["w"], cosine, recall, probes)
        how = Hashing(cosine, tables, hashes, probes, seed)
        coded = durable(nodes.select("node", "n", "vec").mapInArrow(_index(tables, hashes, probes, seed), f"node long, n long, vec array<{kind}>, codes array<long>"))
        spread_out = lambda *more: coded.select(F.size("vec").alias("width"), F.posexplode("codes").alias("at", "code"), *more).where("code >= 0").withColumns({"t": F.expr(f"cast(at div {1 + probes} as int)"), "home": F.expr(f"cast(at % {1 + probes} = 0 as int)")}).drop("at")
        # buckets beyond a block are counted first, from the keys alone: at most rows / block of them
        large = spread_out().groupBy(*BUCKET).agg(F.count("*").alias("m")).where(F.col("m") > block).select(*BUCKET, F.ceil(F.col("m") / block).cast("int").alias("parts"))
        large = durable(large)
        placed = spread_out("node", "n", "vec")
        schema = "node long, links long, other long"
        whole = placed if large.isEmpty() else placed.join(large, BUCKET, "left_anti")
        checked = whole.repartition(*BUCKET).sortWithinPartitions(*BUCKET).mapInArrow(_verify_runs(how), schema)
        if not large.isEmpty():
            cut = placed.join(large, BUCKET).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            spread = cut.withColumn("o", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn("i", F.least("part", "o")).withColumn("j", F.greatest("part", "o"))
            checked = checked.unionByName(spread.groupBy(*BUCKET, "i", "j").applyInArrow(_verify_blocks(how), schema))
        checked = durable(checked)
        counts = checked.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
        linked = components(checked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))).withColumnRenamed("label", "c")
        known = nodes.join(counts, "node", "left").join(linked, "node", "left").select("vec", "n", "first_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("c", "node").alias("label"))
        smallest = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
        known = known.join(smallest, "label").select(F.col("vec"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
        out = rows.join(known, "vec", "left")
    else:
        out = rows.select("id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), "vec")
    component = F.when(F.col("vec").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(ident), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
