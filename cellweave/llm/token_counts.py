"""Token counts from an exact length histogram.

Documents are encoded whole (by the trie encoder) and aggregated by encoded length; everything else is read
from the histogram, which has a row for each distinct length. Suffix sums give, for any context limit, how
many documents exceed it, how many tokens are cut off and how many remain; prefix sums give quantiles.

The histogram is the only thing shuffled: (group, length, count), pre-aggregated in each task. A group's
distinct lengths number at most sqrt(2 x its tokens), since k distinct lengths need k * (k - 1) / 2 tokens;
running sums go over buckets of lengths first and inside a bucket afterwards, so no task needs a whole group.

Defined results. Null or empty text: length 0. Null group: a group of its own. Repeated rows count each. Limits
between two lengths follow from the next larger length: ``truncated_total`` is linear in between. An empty
table gives an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.bpe import encode
from cellweave.llm.common import durable, table

#: Lengths that one bucket of running sums spans.
BUCKET = 256


def histogram(docs: DataFrame, vocabulary: str | None = None, *, text: str = "text", group: str | None = "source") -> DataFrame:
    """(source, n_tokens, n_docs): documents of each encoded length, by group (or all as one, group null)."""
    source = docs.select((F.col(group) if group else F.lit(None).cast("string")).alias("source"), F.col(text).alias("text"))
    return encode(source, vocabulary, keep=["source"], outputs=("n_tokens",)).groupBy("source", "n_tokens").agg(F.count("*").alias("n_docs"))


def _running(h: DataFrame, sums: dict[str, str], up: bool) -> DataFrame:
    """Add running sums over lengths inside each group: up to a row (``up``) or from it on, itself included."""
    order = F.col("bucket") if up else F.col("bucket").desc()
    per = h.groupBy("source", "bucket").agg(*[F.sum(c).alias(f"b_{o}") for o, c in sums.items()])
    earlier = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("g"), F.col("bucket").alias("gb"), *[F.coalesce(F.sum(f"b_{o}").over(earlier), F.lit(0)).alias(f"b_{o}") for o in sums])
    inner = Window.partitionBy("source", "bucket").orderBy(F.col("n_tokens") if up else F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = h.select("*", *[F.sum(c).over(inner).alias(o) for o, c in sums.items()])
    joined = inside.join(per, inside.source.eqNullSafe(per.g) & (inside.bucket == per.gb))
    return joined.select(*h.columns, *[(F.col(o) + F.col(f"b_{o}")).alias(o) for o in sums])


def answers(h: DataFrame) -> DataFrame:
    """A row for each group and length L of a histogram.

    ``n_docs``, ``tokens`` of that length; ``docs_from``, ``tokens_from``: of L and longer; ``docs_to``,
    ``tokens_to``: of L and shorter; ``total``: all tokens; ``truncated_total``: tokens left if every document
    is cut to L; ``quantile``: share of documents of L tokens at most.
    """
    h = durable(h).withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET).cast("long"))
    h = _running(h, {"docs_from": "n_docs", "tokens_from": "tokens"}, up=False)
    h = _running(h, {"docs_to": "n_docs", "tokens_to": "tokens"}, up=True)
    total = F.col("tokens_to") + F.col("tokens_from") - F.col("tokens")
    kept = F.col("tokens_to") + (F.col("docs_from") - F.col("n_docs")) * F.col("n_tokens")
    share = F.col("docs_to") / (F.col("docs_to") + F.col("docs_from") - F.col("n_docs"))
    return h.select("source", "n_tokens", "n_docs", "tokens", "docs_from", "tokens_from", "docs_to", "tokens_to", total.alias("total"), kept.alias("truncated_total"), share.alias("quantile"))


def limits(h: DataFrame, contexts: list[int]) -> DataFrame:
    """For each context limit: (source, context, docs_over, total, truncated_total) from a histogram."""
    over = lambda c: F.col("n_tokens") > c
    aggs = []
    for c in contexts:
        aggs += [F.sum(F.when(over(c), F.col("n_docs")).otherwise(0)).alias(f"o{c}"), F.sum(F.least("n_tokens", F.lit(c)) * F.col("n_docs")).alias(f"t{c}")]
    wide = h.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total"), *aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("context"), F.col(f"o{c}").alias("docs_over"), F.col(f"t{c}").alias("truncated_total")) for c in contexts])).alias("x")
    return wide.select("source", "total", rows).select("source", "x.context", "x.docs_over", "total", "x.truncated_total")


def quantiles(h: DataFrame, shares: list[float]) -> DataFrame:
    """(source, share, n_tokens): the smallest length that at least ``share`` of a group's documents don't exceed."""
    rows = answers(h)
    cuts = F.explode(F.array(*[F.when(F.col("quantile") >= s, F.lit(float(s))) for s in shares]))
    return rows.select("source", "n_tokens", cuts.alias("share")).where("share is not null").groupBy("source", "share").agg(F.min("n_tokens").alias("n_tokens"))


def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(histogram(table(spark, sf_dir, "documents")))
