"""Each corpus operator on small tables against brute force: nulls, empties, ties, repeats, clashing columns, no rows."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import ann, bpe, crosspolytope, graph, langid, mixing, sharding, simhash, token_counts, toxicity, warc
from cellweave.llm.common import crc_fold, fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} Ünïcode" for i in range(20000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (2, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (2, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (3, None, None, None, None),
            (4, "", "en", "a", 0), (5, "  \n\t ", "de", "b", 4), (6, LONG, "de", "b", 9), (7, "<|endoftext|>a<|endoftext|> b  c\r\n", "fr", "b", 1), (8, "日本語 text ١٢٣ ½ !!", "fr", "c", 1), (None, "no id here", "fr", "c", 1), (9, "x", "fr", "c", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs):
    """The same rows beside columns that bear the operators' own names."""
    extra = ["k0", "body", "score", "fp", "f0", "n_tokens", "lang_pred", "key", "a", "b", "rate", "spot", "who", "id", "h", "s"]
    return docs.select("*", *[F.lit(f"mine {e}").alias(e) for e in extra])


# --- BPE -----------------------------------------------------------------------------------------------------


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def test_bpe_equals_the_library(docs):
    tok = library()
    out = bpe.encode(clashing(docs), keep=["doc_id", "score"], outputs=("n_tokens", "token_ids", "ids_sha256", "decoded_sha256", "decoded")).collect()
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert len(out) == docs.count()
    for r in out:
        text = next(t for (i, t) in texts if i == r["doc_id"])
        ids = tok.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(bytes(r["token_ids"]), "<u4")) == ids and r["n_tokens"] == len(ids) and r["score"] == "mine score"
        assert r["decoded"] == tok.decode(ids, skip_special_tokens=False)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_bpe_long_words_need_linear_memory():
    import tracemalloc

    tok, ours = library(), bpe.TrieBpe(bpe.vocabulary_text())
    letters = np.random.default_rng(4).integers(97, 107, 1_000_000).astype(np.uint8).tobytes().decode()
    for text in (letters, " " * 1_000_000, "a" * 200_000):
        tracemalloc.start()
        ids = ours.encode_block([text])[0]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and ours.decode(ids) == text
        assert most < 200e6 and text not in ours.words


def test_bpe_on_odd_text():
    tok, mine = library(), bpe.TrieBpe(bpe.vocabulary_text())
    rng = np.random.default_rng(0)
    texts = ["".join(chr(c) for c in rng.choice([32, 10, 39, 97, 115, 116, 98, 233, 0x4E2D, 0x1F600, 0x0378, 0x300, 0xA0, 0x2028], 120)) for _ in range(300)]
    texts += ["a" * 5000, "ab" * 3000, "'s'll've", "  x", "<|endoftext|><|endoftext", "é" * 999, *(chr(c) * 3 for c in range(0x530, 0x5A0))]
    for text, ids in zip(texts, mine.encode_block(texts)):
        assert list(np.frombuffer(ids, "<u4")) == tok.encode(text, add_special_tokens=False).ids
        assert mine.decode(ids) == text


def test_bpe_decode_frame(docs, nothing):
    back = bpe.decode(bpe.encode(docs, keep=["doc_id", "text"])).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe.encode(nothing).count() == 0


# --- token counts --------------------------------------------------------------------------------------------


def test_histogram_answers(docs, nothing):
    tok = library()
    lengths = collections.defaultdict(list)
    for r in docs.collect():
        lengths[r["source"]].append(len(tok.encode(r["text"] or "", add_special_tokens=False).ids))
    h = token_counts.histogram(clashing(docs))
    for r in token_counts.answers(h).collect():
        own, n = lengths[r["source"]], r["n_tokens"]
        assert r["n_docs"] == own.count(n) and r["docs_from"] == sum(x >= n for x in own) and r["tokens_to"] == sum(x for x in own if x <= n)
        assert r["total"] == sum(own) and r["truncated_total"] == sum(min(x, n) for x in own) and r["quantile"] == pytest.approx(sum(x <= n for x in own) / len(own))
    for r in token_counts.limits(h, [1, 5, 300]).collect():
        own = lengths[r["source"]]
        assert (r["docs_over"], r["total"], r["truncated_total"]) == (sum(x > r["context"] for x in own), sum(own), sum(min(x, r["context"]) for x in own))
    for r in token_counts.quantiles(h, [0.5, 1.0]).collect():
        own = sorted(lengths[r["source"]])
        assert r["n_tokens"] == own[math.ceil(r["share"] * len(own)) - 1]
    assert token_counts.answers(token_counts.histogram(nothing)).count() == 0


# --- SimHash -------------------------------------------------------------------------------------------------


def brute_fingerprint(text, words=3):
    import xxhash

    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + words]).encode(), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(values, linked):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, x in enumerate(values):
        for y in values[i + 1 :]:
            if linked(x, y):
                parent[max(root(x), root(y))] = min(root(x), root(y))
    return {v: root(v) for v in values}


def test_simhash_rows(docs, nothing):
    out = simhash.near_duplicates(clashing(docs)).collect()
    assert len(out) == docs.count()
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    near = groups(sorted(set(fps.values())), lambda x, y: bin(x ^ y).count("1") <= 3)
    for r in out:
        assert r["fp"] % 2**64 == fps[r["doc_id"]]
        assert r["component_id"] == min((i for i, f in fps.items() if i is not None and near[f] == near[fps[r["doc_id"]]]), default=None)
    assert fps[3] == fps[4] == fps[5] == 0
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("limit", [8192, 8])
def test_links_of_clustered_fingerprints(spark, limit):
    """Dense clusters, in one bucket each: with a small limit the exact way for large buckets takes over."""
    rng = np.random.default_rng(5)
    values = {0}
    for _ in range(4):
        centre = int(rng.integers(0, 2**63))
        for _ in range(60):
            v = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                v ^= 1 << int(b)
            values.add(v % 2**63)
    values = sorted(values)
    want = groups(values, lambda x, y: bin(x ^ y).count("1") <= 3)
    got = {r["node"]: r["label"] for r in simhash.link_fingerprints(spark.createDataFrame([(v,) for v in values], "f0 long"), bucket_limit=limit).collect()}
    assert {v: got.get(v, v) for v in values} == want


def test_wide_buckets_in_blocks(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**62, 2)
    rows = set()
    for _ in range(80):
        flips = rng.integers(0, 128, rng.integers(0, 12))
        f = [int(base[0]), int(base[1])]
        for b in flips:
            f[b // 64] ^= 1 << int(b % 62)
        rows.add(tuple(f))
    df = spark.createDataFrame(sorted(rows), "f0 long, f1 long")
    free = {r["node"]: r["label"] for r in simhash.link_fingerprints(df, 2, 16, 8, 14).collect()}
    cut = {r["node"]: r["label"] for r in simhash.link_fingerprints(df, 2, 16, 8, 14, bucket_limit=10).collect()}
    assert free == cut and len(free) > 40


def test_keep_one(spark, docs, nothing):
    words = [f"w{i}" for i in range(400)]
    near = words[:200] + ["changed"] + words[201:]
    rows = [(10, " ".join(words), "en", "a", 1), (11, " ".join(near), "en", "b", 1), (12, " ".join(reversed(words)), "en", "b", 1)]
    both = clashing(docs.unionByName(spark.createDataFrame(rows, DOCS)))
    kept = simhash.keep_one(both)
    assert kept.columns == both.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda v: (v is None, v))
    assert ids == [1, 3, 6, 7, 8, 9, 10, 12, None]  # 3, 4 and 5 have no words and are one
    assert simhash.keep_one(nothing).count() == 0


@pytest.mark.parametrize("documents", [None, 200_000, 12_000_000])
def test_keep_one_is_exact_at_any_size(spark, monkeypatch, documents):
    """Pairs at 0.80 link and pairs at 0.77 do not, also with the segments of larger tables."""
    if documents:
        sized = simhash.shape
        monkeypatch.setattr(simhash, "shape", lambda n, *a, **k: sized(documents, *a, **k))
    rng = np.random.default_rng(8)

    def pair(i, inner, outer):
        """Two texts that share ``inner`` shingles and have ``outer`` of their own each."""
        own = [f"d{i}w{rng.integers(10**9)}" for _ in range(inner + 4)]
        return [" ".join(own + [f"{i}{side}{j}" for j in range(outer)]) for side in "ab"]

    rows, like = [], {}
    for i in range(300):
        inner, outer = [(160, 20), (80, 10), (154, 23), (200, 30)][i % 4]  # 0.80, 0.80, 0.77, 0.769
        a, b = pair(i, inner, outer)
        rows += [(2 * i, a, "en", "a", 1), (2 * i + 1, b, "en", "a", 1)]
        like[i] = inner / (inner + 2 * outer) >= 0.8
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(2 * i in kept for i in like)
    assert all(2 * i + 1 in kept for i, yes in like.items() if not yes)
    assert sum(2 * i + 1 not in kept for i, yes in like.items() if yes) >= 0.98 * sum(like.values())


@pytest.mark.parametrize("limit, partners", [(8192, simhash.PARTNERS), (8192, 1), (20, simhash.PARTNERS), (20, 1)])
def test_keep_one_in_a_large_group(spark, monkeypatch, limit, partners):
    """Many versions of one text, some similar enough: groups as brute force finds them."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(90):
        mine = list(base)
        for j in rng.choice(200, rng.integers(0, 10), replace=False):
            mine[j] = f"x{i}y{j}"
        texts.append(" ".join(mine))
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    near = groups(list(range(90)), lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))
    meet, first = simhash.meetings, []

    def seen(*args):
        pairs, nodes = meet(*args)
        first.append((pairs.count(), nodes.count()))
        return pairs, nodes

    monkeypatch.setattr(simhash, "meetings", seen)
    kept = simhash.keep_one(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS), bucket_limit=limit, partners=partners)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(near.values()))
    [(pairs, nodes)] = first
    assert nodes <= 90 and 0 < pairs <= partners * nodes  # pairs grow with the nodes, not with pairs in buckets


def versions(n, changed):
    """Texts that are versions of one, and what brute force links: (texts, smallest of each group)."""
    rng = np.random.default_rng(4)
    base, texts = [f"w{i}" for i in range(200)], []
    for i in range(n):
        mine = list(base)
        for j in rng.choice(200, rng.integers(0, changed), replace=False):
            mine[j] = f"x{i}y{j}"
        texts.append(" ".join(mine))
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    near = groups(list(range(n)), lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))
    return texts, sorted(set(near.values()))


def test_keep_one_ships_a_set_once(spark, monkeypatch):
    """Versions of one text share many buckets: their sets are compared in their clump, not again in each bucket."""
    texts, smallest = versions(120, 16)
    shipped, compare = spark.sparkContext.accumulator(0), simhash._tied_sets

    def counted(similarity):
        run = compare(similarity)

        def counting(found):
            shipped.add(found.num_rows)
            return run(found)

        return counting

    monkeypatch.setattr(simhash, "_tied_sets", counted)
    kept = simhash.keep_one(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS))
    assert sorted(r["doc_id"] for r in kept.collect()) == smallest
    assert 0 < shipped.value <= 120


@pytest.mark.parametrize("thick", [0, 10**9])
def test_keep_one_in_thin_and_thick_clumps(spark, monkeypatch, thick):
    """Clumps of several blocks, compared bucket by bucket (0) or as a whole: the same groups, as brute force finds them."""
    texts, smallest = versions(90, 16)
    by_bucket, buckets = [], simhash.tied_in_buckets
    monkeypatch.setattr(simhash, "THICK", thick)
    monkeypatch.setattr(simhash, "tied_in_buckets", lambda *args: by_bucket.append(1) or buckets(*args))
    kept = simhash.keep_one(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS), bucket_limit=20)
    assert sorted(r["doc_id"] for r in kept.collect()) == smallest
    assert len(by_bucket) == (thick == 0)


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 2000), (2000, 3000), (7, 7), (None, 3)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[3000] == got[2000] == got[1000] == 1000 and len(got) == 204


# --- embeddings ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [(i, [float(v) for v in base[i % 60] + rng.normal(scale=[0.0, 0.1, 0.3][i % 3], size=16)], i % 2) for i in range(400)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, [float("inf")] * 16, 1), (1005, [], 1), (1006, rows[0][1], 1), (1007, rows[0][1], 0), (None, rows[0][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def usable(rows):
    return {r["vec_id"]: np.array(r["embedding"], float) for r in rows if r["vec_id"] is not None and r["vec_id"] not in range(1000, 1006)}


def test_cross_polytope_links(vectors):
    good = usable(vectors.collect())
    out = {r["vec_id"]: r for r in crosspolytope.near_duplicates(vectors.withColumn("id", F.lit("x")), block=64).collect()}
    names = sorted(good)
    x = np.stack([good[i] / np.linalg.norm(good[i]) for i in names])
    s = x @ x.T >= 0.9
    np.fill_diagonal(s, False)
    copies = set(np.flatnonzero((np.stack([good[i] for i in names]) == good[0]).all(axis=1)))
    want = s.sum(axis=1) + np.array([bool(set(np.flatnonzero(s[i])) & copies or i in copies) for i in range(len(names))])  # the row without an id links too
    got = np.array([out[i]["n_links"] for i in names])
    assert (got == want).mean() > 0.99 and (got <= want).all()
    assert out[1006]["component_id"] == out[0]["component_id"] and out[1007]["kept"] is False
    assert all(out[i]["n_links"] == 0 and out[i]["component_id"] == i and out[i]["kept"] for i in range(1000, 1006))
    assert len(out) == 409 and crosspolytope.near_duplicates(vectors.limit(0)).count() == 0


def test_cross_polytope_recall_of_planted_pairs(spark):
    """8,000 vectors, among them 1,500 planted pairs of cosine 0.90 to 0.93, just above the border."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(8000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(1500):
        away = rng.normal(size=64)
        away -= away @ x[i] * x[i]
        c = rng.uniform(0.9, 0.93)
        x[7999 - i] = c * x[i] + math.sqrt(1 - c * c) * away / np.linalg.norm(away)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in crosspolytope.near_duplicates(table).collect()}
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert want.sum() >= 2990 and sum(got.values()) / want.sum() >= 0.99 and all(got[i] <= w for i, w in enumerate(want))


def test_rotations_keep_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(crosspolytope.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_forest_search(spark, vectors):
    good = usable(vectors.collect())
    out = ann.search(vectors.withColumn("vec", F.lit(1)), F.col("vec_id") % 20 == 0, k=10).collect()
    names = sorted(good)
    hit = total = 0
    for q in (i for i in names if i % 20 == 0):
        want = sorted(((-float(good[q] @ good[v]), v) for v in names if v != q))[:10]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q)
        assert [g[0] for g in got] == list(range(1, 11))
        assert all(g[2] == pytest.approx(float(good[q] @ good[g[1]])) for g in got)
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        hit += len({w[1] for w in want} & {g[1] for g in got})
        total += 10
    assert hit / total >= 0.9
    assert ann.search(vectors.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    assert ann.search(few, F.col("vec_id") == 0, k=20).count() == 3


def test_forest_search_in_many_pieces_and_parts(spark, vectors):
    """Small pieces, bins and parts give the same result; opening all of it, that of brute force, for each length."""
    how = {"k": 5, "sample": 64, "leaf": 8, "recall": 1.0}
    whole = {tuple(r) for r in ann.search(vectors, F.col("vec_id") % 20 == 0, **how).collect()}
    cut = {tuple(r) for r in ann.search(vectors, F.col("vec_id") % 20 == 0, **how, piece=5, per_bin=40, per_bin_queries=3).collect()}
    assert {r[:3] for r in whole} == {r[:3] for r in cut}
    rng = np.random.default_rng(3)
    two = {i: rng.normal(size=6 if i % 3 else 4) for i in range(200)}
    table = spark.createDataFrame([(i, v.tolist()) for i, v in two.items()], "vec_id long, embedding array<double>")
    got = sorted(tuple(r)[:3] for r in ann.search(table, F.col("vec_id") % 20 == 0, k=4, held=0).collect())
    want = []
    for q in range(0, 200, 20):
        best = sorted((-float(two[q] @ two[v]), v) for v in two if v != q and len(two[v]) == len(two[q]))[:4]
        want += [(q, r, v) for r, (_, v) in enumerate(best, 1)]
    assert got == sorted(want)


def test_forest_copies_give_the_smallest_ids(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0] if i % 3 else [0.0, 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in ann.search(rows, F.col("vec_id") == 1, k=5).orderBy("rank").collect()]
    assert got == [2, 4, 5, 7, 8]


# --- mixing and sharding -------------------------------------------------------------------------------------


def test_poisson_counts_follow_their_law(spark):
    from pyspark.sql import functions as F

    for rate in (0.3, 2.0, 40.0):
        us = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"), F.lit(rate).alias("r"))
        counts = [r[0] for r in us.select(F.expr(mixing.poisson_count("u", "r"))).collect()]
        assert np.mean(counts) == pytest.approx(rate, rel=0.02) and np.var(counts) == pytest.approx(rate, rel=0.05)
        assert counts == sorted(counts)


def test_mix(spark, docs, nothing):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    out = mixing.mix(many, {"rare": 0.5, "hot": 0.5})
    shares = {r["source"]: r["s"] for r in out.groupBy("source").agg(F.sum(F.octet_length("text") + 1).alias("s")).collect()}
    assert shares["rare"] / sum(shares.values()) == pytest.approx(0.5, abs=0.04)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, mixing.mix(many.repartition(7), {"rare": 0.5, "hot": 0.5}).collect()), key=repr)
    assert not {r["source"] for r in mixing.mix(many, {"hot": 1.0}).select("source").distinct().collect()} - {"hot"}
    wide = clashing(docs)
    assert mixing.mix(wide, epochs=200.0).columns == wide.columns and mixing.mix(wide, epochs=200.0).where("source is null").count() > 0
    assert mixing.mix(nothing).count() == 0


def test_mixed_documents_are_whole_and_in_order(spark, sf):
    from cellweave.llm.queries import QUERIES

    given = spark.read.parquet(f"{sf}/documents.parquet")
    out, drawn = QUERIES["op2_poisson_mix"](spark, sf), mixing.copies(given, mixing.rates(given), 17, carry=False).withColumnRenamed("m_id", "doc_id").collect()
    assert out.columns == [*given.columns, "copy", "place"]
    rows = out.collect()  # by partition: in the order in which files are written
    assert [r["place"] for r in rows] == list(range(len(drawn)))
    whole = {tuple(r) for r in given.collect()}
    assert {tuple(r)[: len(given.columns)] for r in rows} <= whole
    spots = collections.defaultdict(list)
    for r in drawn:
        spots[r["doc_id"], r["copy"]].append(r["spot"])
    assert collections.Counter((r["doc_id"], r["copy"]) for r in rows) == {k: len(v) for k, v in spots.items()}
    if all(len(v) == 1 for v in spots.values()):
        hashes = [spots[r["doc_id"], r["copy"]][0] for r in rows]
        assert hashes == sorted(hashes)


def test_places_of_repeated_rows(spark, docs):
    """Rows of one hash get places of their own, whatever the partitioning."""
    rows = mixing.mix(docs, epochs=50.0, placed=True)
    found = rows.orderBy("place").collect()
    assert [r["place"] for r in found] == list(range(len(found)))
    assert [tuple(r) for r in found] == [tuple(r) for r in mixing.mix(docs.repartition(5), epochs=50.0, placed=True).orderBy("place").collect()]


def test_shards(spark, docs, nothing):
    many = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 < 6, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 10).cast("string"))).alias("source"))
    out = sharding.assign(many, 16, per_bucket=64).toPandas()
    sizes = out.groupby("shard").size()
    assert len(out) == 1003 and set(sizes) == {62, 63} and out.doc_id.is_unique
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    for source, part in out.groupby("source"):
        per = part.groupby("shard").size().reindex(range(16), fill_value=0)
        assert (per - len(part) / 16).abs().max() <= 1 + 5 * len(part) / 1003
    assert (out.sort_values("doc_id").shard.values == sharding.assign(many.repartition(5), 16, per_bucket=64).toPandas().sort_values("doc_id").shard.values).all()
    few = sharding.assign(clashing(docs), 16).collect()
    assert len(few) == 11 and sorted(r["shard"] for r in few) == sorted(p * 16 // 11 for p in range(11))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in few)
    assert sharding.assign(nothing).count() == 0


# --- WARC ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i} {'wörd ' * (i % 40)}</p>") for i in range(300)] + [(5, "http://x/5", "<p>again</p>")] + [(7, None, None)] * 40 + [(None, None, f"{i % 20}") for i in range(200)] + [(None, "u", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("mine")).withColumn("name", F.lit("mine"))


def merkle_root(leaves, fanout):
    """Brute force: leaves (offset, length, digest) in order."""
    now, first = list(leaves), True
    while len(now) > 1:
        now = [(kids[0][0], sum(k[1] for k in kids), hashlib.sha256(f"{kids[0][0]}|{sum(k[1] for k in kids)}|{'|'.join(k[2] for k in kids)}".encode()).hexdigest()) for kids in (now[i : i + fanout] for i in range(0, len(now), fanout))]
    return now[0]


def test_warc_places_and_roots(spark, pages):
    leaves = warc.manifest(warc.archive(pages, 11))
    out = warc.fixity(leaves, leaves, fanout=4).toPandas()
    assert len(out) == 542 and (out.status == "ok").all() and out.name.nunique() == 542 and set(out.file) == set(range(11))
    assert out.groupby("file").size().max() < 100  # null and repeated ids spread over the files
    deepest = warc.depth(out.seq.max() + 1, 4)
    for _, f in out.groupby("file"):
        f = f.sort_values("seq")
        assert list(f.seq) == list(range(len(f))) and list(f.off) == [0, *np.cumsum(f.len)[:-1]]
        top = merkle_root(zip(f.off, f.len, f.digest), 4)
        for _ in range(deepest - warc.depth(len(f), 4)):  # roots of all files stand on one level
            top = (*top[:2], hashlib.sha256(f"{top[0]}|{top[1]}|{top[2]}".encode()).hexdigest())
        assert top[2] == f.root.iloc[0]
    none = warc.manifest(warc.archive(pages.limit(0), 1))
    assert warc.fixity(none, none).count() == 0


def test_warc_audit_names_every_kind_of_damage(spark, pages):
    records = warc.archive(pages, 5, also=warc.fate())
    got = warc.fixity(warc.manifest(records), warc.manifest(warc.decayed(records), ("after", "name")), fanout=4).toPandas()
    mark = lambda r: {13: "changed", 29: "changed", 41: "missing"}.get(r % 97, "")
    kinds = got[got.status != "extra"].set_index("name").status
    ids = got[got.status != "extra"].set_index("name").id
    for name, kind in kinds.items():
        want = "" if ids[name] != ids[name] else mark(ids[name])
        assert kind == want if want else kind in ("ok", "moved")
    assert sorted(got[got.status == "extra"].id) == [53, 150, 247] and (kinds == "missing").sum() == 4 - 1 and "moved" in set(kinds)
    # bytes of the same length: nothing else is even suspected
    same = warc.archive(pages, 5, also={"bad": F.col("page_id") == 17})
    flipped = same.withColumn("digest", F.when(F.col("bad"), F.reverse("digest")).otherwise(F.col("digest")))
    found = warc.fixity(warc.manifest(same), warc.manifest(flipped), fanout=4).where("status <> 'ok'").collect()
    assert [(r["id"], r["status"]) for r in found] == [(17, "changed")]


def test_warc_files_are_read_as_written(spark, pages, tmp_path):
    warc.write(pages, f"{tmp_path}/w", per_file=60)
    files = sorted((tmp_path / "w").glob("file=*/*.txt"))
    leaves, there = warc.manifest(warc.archive(pages, warc.files_for(pages, 60))), warc.read(spark, f"{tmp_path}/w/file=*/*.txt")
    assert collections.Counter((r["url"], r["html"]) for r in there.collect()) == collections.Counter((r["url"] or "", r["html"] or "") for r in pages.collect())
    assert sorted(map(tuple, leaves.select("file", "seq", "name", "off", "len", "record", "digest").collect())) == sorted(map(tuple, there.select("file", "seq", "name", "off", "len", "record", "digest").collect()))
    raw = files[3].read_bytes()
    head = raw.split(b"\r\n\r\n")[0].decode().split("\r\n")
    assert head[0] == "WARC/1.1" and {line.split(":")[0] for line in head[1:]} >= {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Type", "Content-Length"}
    target = leaves.where("id = 17").first()
    path = next(f for f in files if f.parent.name == f"file={target['file']}")
    raw = path.read_bytes()
    at = raw.index(b"<p>17 ", target["off"])
    path.write_bytes(raw[:at] + b"<p>71 " + raw[at + 6 :])
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    found = warc.fixity(leaves, there.withColumn("id", F.lit(None).cast("long")), fanout=4).where("status <> 'ok'").collect()
    assert [(r["id"], r["status"]) for r in found] == [(17, "changed")]


def test_shards_equal_a_sort_of_everything(spark, docs):
    """All shards and slots again, by sorting the whole table on the driver."""
    table = docs.unionByName(spark.range(700).selectExpr("id + 100 as doc_id", "concat('text ', id % 90) as text", "'en' as lang", "case when id % 3 = 0 then 'hot' when id % 50 > 0 then concat('s', id % 7) end as source", "1L as n_chars"))
    got = sharding.assign(clashing(table), 16, per_bucket=13).select("doc_id", "source", "shard", "slot").collect()
    h = F.xxhash64(F.lit(5), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    rows = sorted(("null" if r["source"] is None else "=" + r["source"], r["h"], -1 if r["doc_id"] is None else r["doc_id"]) for r in table.withColumn("h", h).collect())
    n = collections.Counter(r[0] for r in rows)
    at, placed = collections.Counter(), []
    for key, hash_, ident in rows:
        at[key] += 1
        placed.append(((at[key] - 0.5) / n[key], key, hash_, ident))
    placed.sort()
    want, slots = [], collections.Counter()
    for place, (_, key, _, ident) in enumerate(placed):
        shard = place * 16 // len(placed)
        want.append((ident, key, shard, slots[shard]))
        slots[shard] += 1
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], "null" if r["source"] is None else "=" + r["source"], r["shard"], r["slot"]) for r in got) == sorted(want)


# --- learned models ------------------------------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "ba"]))
    theta = np.random.default_rng(0).uniform(0.01, 0.5, (len(pieces.names) + 1, 2))

    def brute(word):
        text = "▁" + word
        by = {}
        for s, e, p in zip(*pieces.matches(word)):
            by.setdefault(s, []).append((e, p))

        def walk(at):
            return np.ones(2) if at == len(text) else sum((theta[p] * walk(e) for e, p in by.get(at, [])), np.zeros(2))

        return walk(0)

    words = ["a", "ab", "abab", "bca", "aba"]
    assert np.allclose(langid.Lattice(pieces, words).log_likelihood(theta), np.log([brute(w) for w in words]))
    assert np.allclose(langid.long_log_likelihood(pieces, "abab", theta), np.log(brute("abab")))
    # expected uses of pieces cover each letter (and the mark) once
    uses = langid.Lattice(pieces, ["abab"]).expected(theta, np.ones((1, 2)))
    lengths = np.array([len(n) for n in pieces.names] + [1])
    assert np.allclose((uses * lengths[:, None]).sum(axis=0), 5)


def test_words_of_any_length_are_summed_exactly():
    """Against a forward pass in decimals, which can neither overflow nor underflow."""
    from decimal import Decimal

    pieces = langid.Pieces(sorted(["▁a", "a", "b", "ab", "▁ab", "ba", "abba"]))
    theta = np.full((len(pieces.names) + 1, 2), 1e-9)
    theta[:-1] = np.random.default_rng(0).uniform(0.01, 0.2, (len(pieces.names), 2))
    model = langid.Model(["x", "y"], theta, np.zeros(2), pieces.names).start()
    for word in [c * n for c in ("ñ", "ab", "abñ") for n in (12, 13, 14, 39, 40, 41, 500)]:
        exact = []
        for k in range(2):
            alpha = [Decimal(1)] + [Decimal(0)] * (len(word) + 1)
            for s, e, p in zip(*(v.tolist() for v in pieces.matches(word))):
                alpha[e] += alpha[s] * Decimal(float(theta[p, k]))
            exact.append(float(alpha[-1].ln()))
        model._learn_words({word})
        assert np.allclose(model.logs[model.known[word]], exact, rtol=1e-12), word
        if len(word) <= langid.vector_letters(theta):
            one = langid.Lattice(pieces, [word]).expected(theta, np.array([[2.0, 3.0]]))
            assert np.allclose(langid.long_expected(pieces, word, theta, np.array([2.0, 3.0])), one)


def test_langid_ties_and_too_many_languages(spark, docs):
    tie = langid.Model(["aa", "bb"], np.full((2, 2), 0.5), np.zeros(2), ["x"])
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs.where("doc_id = 1"), tie).collect()} == {("aa", 0.5)}
    many = spark.range(langid.MOST_LANGUAGES + 1).selectExpr("id as doc_id", "'text' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError, match="over 1000 values"):
        langid.learn(many, F.lit(True))


def test_langid(spark, docs, nothing):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(real, fold("doc_id", 4) != 2, per_language=40)
    out = langid.predict(real, model, keep=["doc_id", "lang"]).where(fold("doc_id", 4) == 2).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.predict(clashing(docs), model).collect()}
    assert odd[3] == odd[4] == odd[5] == "und" and odd[1] == "en" and odd[6] != "und"
    assert langid.predict(nothing, model).count() == 0
    empty = langid.learn(nothing, F.lit(True))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs.where("doc_id = 1"), empty).collect()} == {("und", 0.0)}


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in ((0.6, 0.01), (0.5, 0.02), (0.4, 0.01))] , 1).astype(np.uint8)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that repeats the first
    labels = np.where(rng.random(4000) < 0.05, ~y, y).astype(int)
    model, q = toxicity.LabelModel.fit(votes, labels, np.ones(4, bool))
    assert abs(model.balance - 0.2) < 0.05 and ((q > 0.5) == y).mean() > 0.93
    # the copy hangs on what it repeats and has no say of its own; the others are independent
    assert sorted(model.parent) == [-1, -1, -1, max(model.parent)] and {3, 0} == {max(model.parent), int(np.argmax(model.parent))}
    _, without = toxicity.LabelModel.fit(votes[:, :3], labels, np.ones(3, bool))
    assert ((q > 0.5) == (without > 0.5)).mean() > 0.99 and np.abs(q - without).mean() < 0.01


def test_label_model_needs_no_labels():
    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.3
    bad = [np.where(y, rng.random(6000) < a, rng.random(6000) < 0.02) for a in (0.7, 0.6, 0.5)]
    good = [np.where(y, rng.random(6000) < 0.05, rng.random(6000) < 0.6)]
    votes = np.stack(bad + good, 1).astype(np.uint8)
    model, q = toxicity.LabelModel.fit(votes, np.full(6000, -1), np.array([True] * 3 + [False]), rounds=30)
    assert abs(model.balance - 0.3) < 0.05 and ((q > 0.5) == y).mean() > 0.93


def test_posteriors_equal_the_joint_distribution():
    """Every vote pattern of a small model: the probabilities multiply out, sum to one and give the posterior."""
    rng = np.random.default_rng(2)
    parent = np.array([-1, 0, 1, -1, 3])
    model = toxicity.LabelModel(0.3, parent, rng.uniform(0.05, 0.95, (5, 2, 2)), np.array([0.1, 0.8]))
    patterns = np.array([[i >> j & 1 for j in range(5)] for i in range(32)], np.uint8)

    def joint(x, label, y):
        p = model.balance if y else 1 - model.balance
        for j, up in enumerate(parent):
            rate = model.rates[j, x[up] if up >= 0 else 0, y]
            p *= rate if x[j] else 1 - rate
        return p * (model.gold[y] if label else 1 - model.gold[y])

    assert np.isclose(sum(joint(x, label, y) for x in patterns for label in (0, 1) for y in (0, 1)), 1)
    for label in (0, 1):
        brute = [joint(x, label, 1) / (joint(x, label, 0) + joint(x, label, 1)) for x in patterns]
        assert np.allclose(model.posterior(patterns, np.full(32, label)), brute)
    unlabelled = [sum(joint(x, label, 1) for label in (0, 1)) / sum(joint(x, label, y) for label in (0, 1) for y in (0, 1)) for x in patterns]
    assert np.allclose(model.posterior(patterns, np.full(32, -1)), unlabelled) and np.allclose(model.posterior(patterns), unlabelled)


def test_copies_support_few_voters():
    votes = np.zeros((400, 12), np.uint8)
    labels = np.repeat([1, 0], [100, 300])
    votes[:40, 1:9] = 1  # one text, copied: eight of its words
    votes[40:80, 9] = votes[40:80, 10] = 1
    votes[::50, 11] = 1  # chance
    kept = toxicity.telling_voters(votes, labels, np.ones(12, bool), 1)
    assert kept[0] == 0 and len(set(kept) & set(range(1, 9))) == toxicity.COVER and {9, 10} <= set(kept) and 11 not in kept
    fires = toxicity.Voters(["idiot", "~idiot", "idi*", "<addressed>", "<formal>"]).fired
    assert fires("You are an IDIOT") == [0, 2, 3] and fires("1d10t iiidiottt") == [1] and fires("Licensed under X") == [4] and fires("") == []


def test_toxicity(spark, docs, nothing):
    sf = "/root/testdata/sf0.01"
    real, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.learn(real, labels, fold("doc_id", 3) != 1)
    out = toxicity.score(real, model, keep=["doc_id"]).join(labels, "doc_id").toPandas()
    held = out[out.doc_id.map(lambda i: crc_fold(i, 3) == 1)]
    pairs = [(a > b) + 0.5 * (a == b) for a in held[held.toxic == 1].score for b in held[held.toxic == 0].score]
    assert np.mean(pairs) > 0.9 and (held[held.toxic == 0].score < 0.7).all()
    odd = toxicity.score(clashing(docs), model).collect()
    assert len(odd) == 11 and all(0 <= r["score"] < 0.7 for r in odd)
    assert toxicity.score(nothing, model).count() == 0
    none = toxicity.learn(docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}


def test_folds(spark):
    ids = spark.createDataFrame([(i,) for i in (0, 1, 77, 123456789)] + [(None,)], "doc_id long")
    assert [r[0] for r in ids.select(fold("doc_id", 3)).collect()] == [crc_fold(i, 3) for i in (0, 1, 77, 123456789, None)]


# --- the pipeline --------------------------------------------------------------------------------------------


def test_checkpoints_go_when_they_are_done_with(spark):
    from pathlib import Path

    from cellweave.llm.common import durable, release, scratch

    def files():
        root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
        return {p.name for p in root.glob("rdd-*")}

    first = durable(spark.range(5))
    before = files()
    with scratch(first) as held:
        kept = durable(spark.range(6))
        durable(spark.range(7))
        held.remove(kept)
    assert len(files() - before) == 1 and len(before - files()) == 1 and kept.count() == 6
    release(kept)
    assert not files() - before


def test_pipeline_equals_brute_force(spark):
    """All five stages again on the driver: scores text by text, all pairs of documents, every copy drawn one by one."""
    import corpus_pipeline as p

    from cellweave.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs = [r.asDict() for r in table(spark, sf, "documents").collect()]
    frame = lambda rows: spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows], DOCS)
    toxic = toxicity.learn(frame(docs), table(spark, sf, "labels"), fold("doc_id", 3) != 1).start()
    docs = [r for r in docs if toxic.score(r["text"]) < toxicity.THRESHOLD]
    tongue = langid.learn(frame(docs), fold("doc_id", 4) != 2).start()
    docs = [r for r in docs for lang, score in [tongue.predict([r["text"] or ""])[0]] if lang != "und" and score >= 0.5]

    def words(text):
        w = text.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [words(r["text"]) for r in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    groups = collections.defaultdict(list)
    for i, r in enumerate(docs):
        groups[top(i)].append(r)
    docs = [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]
    sizes = collections.Counter()
    for r in docs:
        sizes[r["source"]] += len(r["text"].encode()) + 1
    roots, tok, want = sum(math.sqrt(v) for v in sizes.values()), library(), []
    for r in docs:
        rate = math.sqrt(sizes[r["source"]]) / roots * sum(sizes.values()) / sizes[r["source"]]
        digest = hashlib.md5(f"17|{r['doc_id']}|{hashlib.md5(r['text'].encode()).hexdigest()}".encode()).hexdigest()
        u, k, term, below = ((int(digest[:15], 16) >> 8) + 0.5) / 2**52, 0, math.exp(-rate), math.exp(-rate)
        while u >= below:
            k += 1
            term *= rate / k
            below += term
        ids = np.array(tok.encode(r["text"], add_special_tokens=False).ids, "<u4").tobytes()
        want += [(r["doc_id"], r["lang"], r["source"], len(ids) // 4, ids)] * k
    got = [(r["doc_id"], r["lang"], r["source"], r["n_tokens"], bytes(r["token_ids"])) for r in p.run(spark, sf).collect()]
    key = lambda r: (r[0], r[4])
    assert len(got) > 50 and sorted(got, key=key) == sorted(want, key=key)


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= {r[0] for r in docs.select("doc_id").collect()} and len(ids) > (0 if name == "mixing" else 0.6 * docs.count())
        docs = after
    last = p.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count()
    assert last.select(F.sum("n_tokens")).first()[0] > 0
    assert p.run(spark, sf).count() == last.count()
