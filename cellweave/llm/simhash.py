"""SimHash near-duplicates, found through deletion-variant signatures.

A fingerprint has one or more words of 64 bits; bit b of word w is set if bit b is set in over half of the
XXH64 values (seed + w) of a document's word shingles. Two rules link documents:

``near_duplicates``: 64 bits, linked if at most 3 bits differ. 2 segments of 32 bits, so that of two linked
fingerprints one segment differs by at most one bit: no link is missed.

``keep_one``: a Jaccard similarity of 0.8 or more of the sets of 5-word shingles, always compared exactly;
fingerprints only find the pairs to compare. Bits of two documents differ with probability
acos(2J / (1 + J)) / pi, 0.15 at J = 0.8. A fingerprint is cut into segments, documents that share one meet, and
those that meet are compared if 128 further bits differ little. Segments are as short as the number of documents
allows and, at any number, so many that documents of the least similarity meet with probability ``RECALL``
(more similar ones more often): the number of documents changes the cost, not what is found, up to that share.
First each document is compared with the ``PARTNERS`` nearest of those that its buckets tie it to. Documents that
resemble each other, directly or through others, by what their buckets tie make a clump; in a clump that the first round
left in different groups the sets are compared where they meet, in blocks, all pairs of a clump once and not again in each
bucket that holds them. Only a clump of more than one block whose members seldom meet (less than once in ``THICK`` pairs) is
compared bucket by bucket: buckets that would give more than ``DENSE`` pairs for each member as blocks too.

``near_duplicates``' candidate search: each segment is indexed with every single bit replaced by a wildcard; two segments that
differ by at most one bit have a variant in common. Fingerprints that share a variant are verified.

Work is on distinct fingerprints, so copies never multiply. Of a bucket's verified pairs only as many
are given out as connect what they connect (all of them up to 16 members), so rows do not grow with pairs. A
bucket beyond ``bucket_limit`` members leaves this path, exactly: with 64 bits its members are joined through
the points around them (points within 1 bit on one side and within 2 bits on the other: two
fingerprints are within 3 bits if and only if they share such a point), whose groups cannot exceed 2081
members and whose rows grow with the members; with wider fingerprints it is cut into blocks and every two blocks
are compared, each pair of blocks in a task of its own. No candidate is dropped.

Defined results. A null or empty text, or one of white space only: fingerprint zero, which links like any
other. Fewer words than a shingle holds: one shingle of them all. A null doc_id: its row takes part in links,
but can't name a component (component_id is the smallest doc_id that is not null; null if there is none).
Repeated rows each get their row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import durable, ship, table
from cellweave.llm.graph import components

WORDS_PER_SHINGLE = 3
SEED = 42
BITS = 3
BUCKET_LIMIT = 8192
#: The probability with which documents of the least similarity meet in a segment of ``keep_one``.
RECALL = 0.999
#: Pairs that a bucket may give for each member; beyond that its sets are compared where they meet, so many at a time.
DENSE, TOGETHER = 4, 2048
#: A clump of several blocks is compared as a whole if its buckets hold at least one in so many of its pairs, repeats counted.
THICK = 4
#: Nodes that a node is compared with in the first round.
PARTNERS = 2
#: Standard deviations above the mean up to which their ``CHECK`` further words may differ.
SPREAD, CHECK = 3.7, 2


def fingerprint(text: str | None, words: int = WORDS_PER_SHINGLE, seed: int = SEED, width: int = 1) -> bytes:
    """The fingerprint's 8 bytes for each word, highest bit first. Words of a text are runs without ASCII white space; A-Z count as a-z."""
    import xxhash

    tokens = (text or "").encode().lower().split()  # of bytes: both know ASCII only
    if not tokens:
        return bytes(8 * width)
    shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words))))) if len(tokens) >= words else [b" ".join(tokens)]
    out = b""
    for w in range(width):
        digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed + w))), np.uint8).reshape(-1, 8)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(digests), 32768):
            ones += np.unpackbits(digests[at : at + 32768], axis=1).sum(axis=0, dtype=np.int64)
        out += np.packbits(ones * 2 > len(digests)).tobytes()
    return out


def with_fingerprints(docs: DataFrame, words: int = WORDS_PER_SHINGLE, seed: int = SEED, width: int = 1, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but ``text``) and the fingerprint's words as signed longs f0, f1, ..."""
    ship(docs.sparkSession)
    names = [f"f{w}" for w in range(width)]
    keep = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c not in names]
    source = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].alias("body"))
    schema = ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), *(f"{f} long" for f in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(fingerprint(t.as_py(), words, seed, width) for t in batch.column(batch.num_columns - 1))
            values = np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(np.ascontiguousarray(values[:, w])) for w in range(width))], names=[*(f"k{i}" for i in range(len(keep))), *names])

    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def differing(similarity: float) -> float:
    """The share of bits in which documents of a Jaccard similarity differ on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def shape(documents: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """(segment bits, segments) for so many documents.

    A segment has as many bits as leave about 8 unrelated documents in a bucket. Segments are added until documents
    of the similarity itself share one with probability ``recall``, at any number of documents.
    """
    bits = min(30, max(12, math.ceil(math.log2(max(2, documents))) - 3))
    meet = (1 - differing(min(0.999, similarity))) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingles(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """The set of a text's word shingles, as sorted distinct XXH64 values; words as for ``fingerprint``."""
    import xxhash

    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    found = list(map(b" ".join, zip(*(tokens[i:] for i in range(words))))) if len(tokens) >= words else [b" ".join(tokens)]
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, found, repeat(seed))), ">u8").astype(np.uint64))


def named(found: np.ndarray, seed: int = SEED) -> int:
    """A signed 64-bit name of a set of shingles."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), seed)).view(np.int64))


def wide_bits(found: np.ndarray, width: int) -> np.ndarray:
    """The ``64 * width`` bits of a set's fingerprint: each set if it is set in over half of the remixed shingles."""
    ones = np.zeros(64 * width, np.int64)
    steps = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(found), 2048):
        z = found[at : at + 2048, None] + steps
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        ones += np.unpackbits(z.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return ones * 2 > len(found)


def sketches(slim: DataFrame, words: int, bits: int, segments: int, seed: int = SEED) -> DataFrame:
    """Rows of ``slim(who, n_text)`` as (who, node: the name of the set of shingles, c0, c1: further words, keys: the segments)."""
    ship(slim.sparkSession)
    schema = f"who {slim.schema['who'].dataType.simpleString()}, node long, c0 long, c1 long, keys array<long>"
    width, weights = CHECK - (-segments * bits // 64), 1 << np.arange(bits, dtype=np.int64)
    first = np.arange(segments, dtype=np.int64) << 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, checks, keys = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words, seed)
                own = wide_bits(found, width)
                nodes.append(named(found, seed))
                checks.append(np.packbits(own[: 64 * CHECK]).view(np.int64))
                keys.append(first | own[64 * CHECK : 64 * CHECK + segments * bits].reshape(segments, bits) @ weights)
            n = len(nodes)
            if not n:
                continue
            c = np.stack(checks)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * segments), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), *(pa.array(np.ascontiguousarray(c[:, w])) for w in range(CHECK)), lists], names=["who", "node", "c0", "c1", "keys"])

    return slim.mapInArrow(run, schema)


def _variants(column: str, segment: int, shift: int, bits: int) -> str:
    """SQL: the keys of one segment, one for each bit replaced by a wildcard.

    A key is the wildcard's number beside the segment with that bit cleared.
    """
    mask = (1 << bits) - 1
    return f"transform(sequence(0, {bits - 1}), i -> shiftleft(cast({segment * 64} + i as bigint), 32) | (shiftrightunsigned({column}, {shift}) & {mask}L & ~shiftleft(1L, i)))"


def keyed(distinct: DataFrame, width: int, bits: int, segments: int) -> DataFrame:
    """A row (key, f0, f1, ...) for each variant of the first ``segments`` segments of ``bits`` bits."""
    per = 64 // bits
    lists = [_variants(f"f{n // per}", n, n % per * bits, bits) for n in range(segments)]
    return distinct.select(F.explode(F.expr(f"concat({', '.join(lists)})")).alias("key"), *[f"f{w}" for w in range(width)])


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints (..., words)."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) if x.shape[-1] > 1 else np.bitwise_count(x[..., 0] ^ y[..., 0])


def tie(values: np.ndarray, bits: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fingerprints (n, words): edges as positions that connect what links within ``bits`` connect.

    A breadth-first walk: each step compares those just reached with those not yet reached, in blocks.
    """
    left = np.arange(len(values))
    out_a, out_b = [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            by = np.full(len(left), -1, np.int64)
            for at in range(0, len(front), block):
                part = values[front[at : at + block]]
                open_ = np.flatnonzero(by < 0)
                for lo in range(0, len(open_), 4096):
                    some = open_[lo : lo + 4096]
                    near = apart(values[left[some]][:, None, :], part[None, :, :]) <= bits
                    hit = near.any(axis=1)
                    by[some[hit]] = at + near[hit].argmax(axis=1)
            reached = by >= 0
            out_a.append(left[reached])
            out_b.append(front[by[reached]])
            front, left = left[reached], left[~reached]
    none = np.empty(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _bucket_edges(width: int, bits: int, limit: int, small: int = 16):
    """Over rows (key, f0, ...) sorted by key: edges (a, b, key null) of first words.

    A bucket beyond ``limit`` gives no edges, but (f0, null, key) for each member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(a: np.ndarray, b: np.ndarray | None, key: int | None = None) -> pa.RecordBatch:
            n = len(a)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.nulls(n, pa.int64()) if b is None else pa.array(b.view(np.int64)), pa.nulls(n, pa.int64()) if key is None else pa.array(np.full(n, key))], names=["a", "b", "key"])

        def close(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if sum(map(len, held)) > 1:
                values = np.concatenate(held)
                a, b = tie(values, bits)
                if len(a):
                    yield pack(values[a, 0], values[b, 0])

        held_key, held, held_n, hot = None, [], 0, False  # the bucket that is still open
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = np.stack([batch.column(1 + w).to_numpy(zero_copy_only=False).view(np.uint64) for w in range(width)], axis=1)
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            sizes = np.diff(np.append(starts, len(keys)))
            inner = np.ones(len(starts), bool)
            inner[0] = inner[-1] = False  # these may go on in another batch
            few = inner & (sizes > 1) & (sizes <= small)
            # small buckets at once: each member with the one d places after it
            first, last = starts[few], starts[few] + sizes[few]
            stop = np.repeat(last, last - first)
            at = np.arange(len(stop)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
            for d in range(1, small):
                ok = at + d < stop
                at, stop = at[ok], stop[ok]
                if not len(at):
                    break
                near = apart(fps[at], fps[at + d]) <= bits
                if near.any():
                    yield pack(fps[at[near], 0], fps[at[near] + d, 0])
            for i in np.flatnonzero(~inner | (sizes > small)):
                key, part = keys[starts[i]], fps[starts[i] : starts[i] + sizes[i]]
                if key != held_key:
                    if not hot:
                        yield from close(held)
                    held_key, held, held_n, hot = key, [], 0, False
                held_n += len(part)
                if hot:
                    yield pack(np.ascontiguousarray(part[:, 0]), None, int(key))
                    continue
                held.append(part)
                if held_n > limit:
                    hot = True
                    yield pack(np.concatenate([h[:, 0] for h in held]), None, int(key))
                    held = []
        if not hot:
            yield from close(held)

    return run


def _two_blocks(width: int, bits: int):
    """Two blocks of a bucket too large for one task: edges that connect what links between and inside them connect."""

    def run(found: pa.Table) -> pa.Table:
        values = np.stack([found.column(f"f{w}").to_numpy().view(np.uint64) for w in range(width)], axis=1)
        a, b = tie(values, bits)
        return pa.table({"a": pa.array(np.ascontiguousarray(values[a, 0]).view(np.int64)), "b": pa.array(np.ascontiguousarray(values[b, 0]).view(np.int64))})

    return run


def block_edges(rows: DataFrame, hot: DataFrame, width: int, bits: int, limit: int) -> DataFrame:
    """Edges of the buckets of ``rows(key, f0, ...)`` that ``hot(key, parts)`` names, by pairs of blocks."""
    cut = rows.join(hot, "key").withColumn("part", F.pmod(F.xxhash64("f0"), F.col("parts")).cast("int"))
    spread = cut.withColumn("o", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn("i", F.least("part", "o")).withColumn("j", F.greatest("part", "o"))
    return spread.groupBy("key", "i", "j").applyInArrow(_two_blocks(width, bits), "a long, b long")


def _around(fp: str, reach: int) -> str:
    """SQL: all values within ``reach`` (1 or 2) bits of a fingerprint."""
    one = f"transform(sequence(0, 63), i -> {fp} ^ shiftleft(1L, i))"
    if reach == 1:
        return f"concat(array({fp}), {one})"
    two = f"flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> {fp} ^ shiftleft(1L, i) ^ shiftleft(1L, j))))"
    return f"concat(array({fp}), {one}, {two})"


def hot_edges(hot: DataFrame) -> DataFrame:
    """Edges that connect the fingerprints of ``hot(fp)`` as links within 3 bits do, by the points around them.

    ``near``: the smallest fingerprint within 1 bit of a point, of those that have any. Whoever is within 2
    bits of that point is within 3 bits of it.
    """
    near = hot.select("fp", F.explode(F.expr(_around("fp", 1))).alias("x")).groupBy("x").agg(F.min("fp").alias("m"))
    ones = hot.select("fp", F.explode(F.expr(_around("fp", 1))).alias("x")).join(near, "x").where("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    twos = hot.select("fp", F.explode(F.expr(_around("fp", 2))).alias("x")).join(near, "x").where("fp <> m").select(F.col("fp").alias("a"), F.col("m").alias("b"))
    return ones.unionByName(twos).distinct()


def link_fingerprints(distinct: DataFrame, width: int = 1, segment_bits: int = 32, segments: int = 2, bits: int = BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Components of distinct fingerprints (f0, f1, ...) whose links differ in at most ``bits`` bits: (node, label).

    A node is a first word: fingerprints with equal first words are one. Fingerprints without a link are left out.
    """
    ship(distinct.sparkSession)
    rows = keyed(distinct, width, segment_bits, segments)
    raw = durable(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_bucket_edges(width, bits, bucket_limit), "a long, b long, key long").distinct())
    edges = raw.where("b is not null").select("a", "b")
    hot = raw.where("b is null")
    if not hot.isEmpty():
        if width == 1 and bits == BITS:
            edges = edges.unionByName(hot_edges(durable(hot.select(F.col("a").alias("fp")).distinct())))
        else:
            keys = hot.groupBy("key").agg(F.ceil(F.count("*") / bucket_limit).cast("int").alias("parts"))
            edges = edges.unionByName(block_edges(rows, keys, width, bits, bucket_limit))
    return components(edges)


def across(values: np.ndarray, labels: np.ndarray, bits: int, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions within ``bits`` bits whose labels differ."""
    for at in range(0, len(values), block):
        part = slice(at, at + block)
        for lo in range(at, len(values), 4096):
            other = slice(lo, lo + 4096)
            open_ = labels[part][:, None] != labels[None, other]
            if open_.any():
                i, j = np.nonzero(open_)
                near = apart(values[part][i], values[other][j]) <= bits
                yield i[near] + at, j[near] + lo


def _meetings(bits: int, limit: int, labelled: bool, dense: int | None = None):
    """Over rows (key, node, c0, c1, label) sorted by key and node: pairs (a, b, key null) of nodes to compare.

    Not ``labelled``: as many as connect a bucket's members, from its smallest node on, which a group's buckets often
    share (up to ``small`` members: each with the smallest node it may resemble). ``labelled``: all whose labels differ. A bucket
    beyond ``limit`` gives no pairs, but (null, null, its members, key) once; so does one that would give over ``dense`` pairs
    for each member.
    """
    small = 16 if dense is None else 2 * dense

    def pack(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        if labelled:
            a, b = np.minimum(a, b), np.maximum(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d.astype(np.int32)), pa.nulls(len(a), pa.int64())], names=["a", "b", "d", "key"])

    def named_only(key: int | None, members: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([members], pa.int32()), pa.array([key], pa.int64())], names=["a", "b", "d", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(key: int | None, held: list, n: int) -> Iterator[pa.RecordBatch]:
            if n > limit:
                yield named_only(key, n)
            elif n > 1:
                node, values, label = (np.concatenate(x) for x in zip(*held))
                out, found = [], 0
                for a, b in across(values, label, bits) if labelled else [tie(values, bits)]:
                    found += len(a)
                    if dense is not None and found > dense * n:
                        yield named_only(key, n)
                        return
                    if len(a):
                        out.append(pack(node[a], node[b], np.zeros(len(a)) if labelled else apart(values[a], values[b])))
                yield from out

        held_key, held, held_n = None, [], 0  # the bucket that is still open
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, node, c0, c1, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            values = np.stack([c0, c1], axis=1).view(np.uint64)
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            sizes = np.diff(np.append(starts, len(keys)))
            inner = np.ones(len(starts), bool)
            inner[0] = inner[-1] = False  # these may go on in another batch
            few = inner & (sizes > 1) & (sizes <= small)
            # small buckets at once: each member with the one d places after it
            first, last = starts[few], starts[few] + sizes[few]
            stop = np.repeat(last, last - first)
            at = np.arange(len(stop)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
            lowest = np.full(len(keys), -1)
            for d in range(1, small):
                ok = at + d < stop
                at, stop = at[ok], stop[ok]
                if not len(at):
                    break
                near = (apart(values[at], values[at + d]) <= bits) & (label[at] != label[at + d])
                if labelled and near.any():
                    yield pack(node[at[near]], node[at[near] + d], np.zeros(near.sum()))
                lowest[at[near] + d] = at[near]
            if not labelled and (lowest >= 0).any():
                one, two = np.flatnonzero(lowest >= 0), lowest[lowest >= 0]
                yield pack(node[one], node[two], apart(values[one], values[two]))
            for i in np.flatnonzero(~inner | (sizes > small)):
                key, part = keys[starts[i]], slice(starts[i], starts[i] + sizes[i])
                if key != held_key:
                    yield from close(held_key, held, held_n)
                    held_key, held, held_n = int(key), [], 0
                if held_n <= limit:
                    held.append((node[part].copy(), values[part].copy(), label[part].copy()))
                held_n += int(sizes[i])
        yield from close(held_key, held, held_n)

    return run


def in_blocks(rows: DataFrame, groups: DataFrame, by: str, limit: int) -> DataFrame:
    """The members ``rows(by, node, ...)`` of ``groups(by, n: members)``, with ``part``, once for each pair of blocks (i, j) of at most about ``limit`` that they are in."""
    cut = rows.join(groups.select(by, F.ceil(F.col("n") / limit).cast("int").alias("parts")), by).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return cut.withColumn("o", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn("i", F.least("part", "o")).withColumn("j", F.greatest("part", "o"))


def _block_meetings(bits: int):
    def run(found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("node").to_numpy(), kind="stable")
        node, c0, c1 = (found.column(c).to_numpy()[order] for c in ("node", "c0", "c1"))
        values = np.stack([c0, c1], axis=1).view(np.uint64)
        a, b = tie(values, bits)
        return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b]), "d": pa.array(apart(values[a], values[b]).astype(np.int32))})

    return run


def meetings(sketched: DataFrame, bits: int, limit: int, partners: int = PARTNERS) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of nodes of ``sketched(node, c0, c1, keys, label)`` to compare first, and all nodes that meet another, (node, clump): see ``_meetings``.

    Of the nodes that a node is tied to, one in each bucket, its ``partners`` with the fewest differing bits: pairs
    grow with the nodes. What these do not connect the second round compares. A clump is what all ties connect, named
    by one of its nodes.
    """
    nearest = F.slice(F.array_sort(F.collect_set(F.struct("d", "b"))), 1, partners)  # of one for each bucket, or two blocks of it

    def chosen(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        best = found.groupBy("a").agg(nearest.alias("best")).select("a", F.explode("best.b").alias("b"))
        pairs = durable(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        # the nearest connect most of a clump: other ties are needed only between what these leave apart
        one = durable(components(pairs))
        ends = found.select("a", "b").join(one.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(one.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
        two = components(ends.select(F.col("la").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct())
        nodes = found.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(one, "node", "left").select("node", F.coalesce("label", "node").alias("part"))
        return pairs, durable(nodes.join(two.withColumnRenamed("node", "part"), "part", "left").select("node", F.coalesce("label", "part").alias("clump")))

    rows = sketched.select(F.explode("keys").alias("key"), "node", "c0", "c1", "label")
    raw = durable(rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_meetings(bits, limit, False), "a long, b long, d int, key long").distinct())
    pairs, hot = raw.where("key is null").select("a", "b", "d"), raw.where("key is not null").select("key", F.col("d").alias("n"))
    if hot.isEmpty():
        return chosen(pairs)
    blocks = in_blocks(rows, hot, "key", limit).groupBy("key", "i", "j").applyInArrow(_block_meetings(bits), "a long, b long, d int").distinct()
    return chosen(pairs.unionByName(durable(blocks)))


def _tied_sets(similarity: float):
    """One block, or between two, of a clump or bucket: edges (a, b) of nodes whose sets are similar and whose labels differ, as many as connect them."""

    def run(found: pa.Table) -> pa.Table:
        i, j = found.column("i")[0].as_py(), found.column("j")[0].as_py()
        part = found.column("part").to_numpy()
        found = found.take(pa.array(np.argsort(part, kind="stable")))
        front = int((part == i).sum()) if i < j else 0  # inside a block all pairs, between two only those across
        node, label = found.column("node").to_numpy(), found.column("label").to_numpy()
        lists = found.column("s").combine_chunks()
        size = np.asarray(lists.value_lengths()).astype(np.int64)
        first = np.cumsum(size) - size
        _, flat = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
        out_a, out_b = [], []
        group = np.unique(label, return_inverse=True)[1]
        for x in range(front or len(node) - 1):
            at = max(x + 1, front)
            if at == len(node) or (group[at:] == group[x]).all():
                continue
            mine = flat[first[x] : first[x] + size[x]]
            mark[mine] = True
            both = np.add.reduceat(mark[flat[first[at] :]], first[at:] - first[at], dtype=np.int64)
            mark[mine] = False
            hits = np.flatnonzero((both >= (size[x] + size[at:] - both) * similarity - 1e-6) & (both > 0)) + at
            for y in hits:
                if group[x] != group[y]:
                    group[group == group[y]] = group[x]
                    out_a.append(node[x])
                    out_b.append(node[y])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def tied_inside(members: DataFrame, groups: DataFrame, by: str, sets: DataFrame, similarity: float, limit: int) -> DataFrame:
    """Edges (a, b) that connect what similarity links inside ``groups(by, n)`` of ``members(by, node, label)``; sets are compared where they meet, pairs are no rows."""
    spread = in_blocks(members.select(by, "node", "label"), groups, by, limit)
    whole = spread.select(by, "i", "j", "part", "node", "label").join(sets.select("node", "s").where("n > 0"), "node")
    return whole.groupBy(by, "i", "j").applyInArrow(_tied_sets(similarity), "a long, b long").distinct()


def tied_in_buckets(grouped: DataFrame, sets: DataFrame, compared: DataFrame, bits: int, similarity: float, bucket_limit: int) -> DataFrame:
    """Edges (a, b) of nodes of ``grouped(node, c0, c1, keys, label)`` that meet in a bucket, are not ``compared(a, b)`` and are similar; dense buckets give as many as connect."""
    rows = grouped.select(F.explode("keys").alias("key"), "node", "c0", "c1", "label")
    raw = durable(rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_meetings(bits, bucket_limit, True, DENSE), "a long, b long, d int, key long").distinct())
    edges = alike(raw.where("key is null").select("a", "b").join(compared, ["a", "b"], "left_anti"), sets, similarity)
    hot = raw.where("key is not null").select("key", F.col("d").alias("n"))
    return edges if hot.isEmpty() else edges.unionByName(tied_inside(rows, hot, "key", sets, similarity, min(bucket_limit, TOGETHER)))


def tied(grouped: DataFrame, sets: DataFrame, compared: DataFrame, bits: int, similarity: float, bucket_limit: int) -> DataFrame:
    """The second round: edges (a, b) that connect what similarity links in the clumps of ``grouped(node, c0, c1, keys, label, clump)`` that have several labels.

    A clump is compared as a whole, at least all that met in its buckets; one of several blocks only if its buckets
    hold enough of its pairs, else it is compared bucket by bucket.
    """
    limit = min(bucket_limit, TOGETHER)
    clumps = grouped.groupBy("clump").agg(F.count("*").alias("n"), F.min("label").alias("l"), F.max("label").alias("m"))
    clumps = durable(clumps.where("n > 2 and l <> m").select("clump", "n"))  # the first round has compared clumps of two
    large = clumps.where(F.col("n") > limit)
    if large.isEmpty():
        return tied_inside(grouped, clumps, "clump", sets, similarity, limit)
    inside = grouped.join(large, "clump").select("clump", "n", F.explode("keys").alias("key")).groupBy("clump", "n", "key").agg(F.count("*").cast("double").alias("c"))
    thin = durable(inside.groupBy("clump", "n").agg(F.sum(F.col("c") * F.col("c")).alias("met")).where(F.col("met") * THICK < F.col("n").cast("double") * F.col("n")).select("clump"))
    edges = tied_inside(grouped, clumps.join(thin, "clump", "left_anti"), "clump", sets, similarity, limit)
    return edges if thin.isEmpty() else edges.unionByName(tied_in_buckets(grouped.join(thin, "clump", "left_semi"), sets, compared, bits, similarity, bucket_limit))


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets (node, s, n) have a Jaccard similarity of ``similarity`` or more, compared exactly."""
    one = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("n").alias("na"))
    two = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("n").alias("nb"))
    sized = pairs.join(one.drop("sa"), "a").join(two.drop("sb"), "b").where(F.least("na", "nb") >= F.greatest("na", "nb") * similarity - 1e-6).select("a", "b")
    met = sized.join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return met.where(F.col("both") >= (F.col("na") + F.col("nb") - F.col("both")) * F.lit(float(similarity)) - 1e-6).where("both > 0").select("a", "b")


def shingle_sets(texts: DataFrame, words: int, seed: int = SEED) -> DataFrame:
    """(node, s, n): a row for each distinct set of shingles of ``texts(n_text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingles(t.as_py(), words, seed) for t in batch.column(0)[at : at + 256]]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                s = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([named(f, seed) for f in found], pa.int64()), s, pa.array(np.diff(ends))], names=["node", "s", "n"])

    return texts.mapInArrow(run, "node long, s array<long>, n int").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, words: int = WORDS_PER_SHINGLE, seed: int = SEED, *, text: str = "text", ident: str = "doc_id", bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Per row of ``docs``: its id, ``fp`` (64 bits as a long) and ``component_id``."""
    slim = docs.select(F.col(ident).alias("n_id"), F.col(text).alias("n_text"))
    marked = durable(with_fingerprints(slim, words, seed, text="n_text").withColumnRenamed("f0", "fp"))
    per = marked.groupBy("fp").agg(F.min("n_id").alias("first_id"))
    linked = link_fingerprints(per.select(F.col("fp").alias("f0")), bucket_limit=bucket_limit).withColumnRenamed("node", "fp")
    by_fp = durable(per.join(linked, "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label")))
    smallest = by_fp.groupBy("label").agg(F.min("first_id").alias("component_id"))
    names = by_fp.join(smallest, "label").select("fp", "component_id")
    return marked.join(names, "fp").select(F.col("n_id").alias(ident), "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, seed: int = SEED, *, text: str = "text", ident: str = "doc_id", share: float | None = None, bucket_limit: int = BUCKET_LIMIT, partners: int = PARTNERS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each group of documents that are similar.

    ``share``: the share of differing bits up to which documents that meet are compared; by default that of the
    similarity and ``SPREAD`` standard deviations. ``partners``: what a document is compared with in the first
    round; it changes the work, not the groups. Groups are what exact similarity links. Kept is the row with
    the smallest id (a null id after all others; then the smallest hash of its text); of repeated rows one stays.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keys = {"k_null": F.col(ident).isNull().cast("int"), "k_id": F.coalesce(F.col(ident).cast("string"), F.lit("")), "k_text": F.xxhash64(body)}
    tagged = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)], *[v.alias(k) for k, v in keys.items()])
    slim = docs.select(F.struct(keys["k_null"].alias("no"), F.col(ident).alias("id"), keys["k_text"].alias("h")).alias("who"), F.col(text).alias("n_text"))
    segment_bits, segments = shape(docs.count(), similarity)
    marked = sketches(slim, words, segment_bits, segments, seed)
    per = durable(marked.groupBy("node").agg(F.min("who").alias("who"), *[F.any_value(c).alias(c) for c in ("c0", "c1", "keys")]))
    wide, p = 64 * CHECK, differing(similarity)
    most = int(wide * (share if share is not None else p + SPREAD * math.sqrt(p * (1 - p) / wide)))
    first, nodes = meetings(per.withColumn("label", F.col("node")), most, bucket_limit, partners)
    near = per.join(nodes, "node")
    # one text for each set that may be compared
    texts = docs.select(F.col(text).alias("n_text"), keys["k_text"].alias("h")).join(near.select(F.col("who.h").alias("h")).distinct(), "h", "left_semi").select("n_text")
    sets = durable(shingle_sets(texts, words, seed).join(nodes, "node", "left_semi"))
    sure = durable(alike(first, sets, similarity))
    grouped = durable(near.join(components(sure), "node", "left").withColumn("label", F.coalesce("label", "node")))
    linked = components(sure.unionByName(tied(grouped, sets, first, most, similarity, bucket_limit)))
    chosen = per.join(linked, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(F.min("who").alias("who"))
    chosen = chosen.select(F.col("who.no").alias("k_null"), F.coalesce(F.col("who.id").cast("string"), F.lit("")).alias("k_id"), F.col("who.h").alias("k_text"))
    rows = tagged.join(chosen, list(keys), "left_semi").dropDuplicates(list(keys))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
