"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank is (rank - 1/2) / rows of
its source, so every source is spread evenly over (0, 1). Rows sorted by fractional rank are cut into shards
of equal row counts (law ``rows``: counts at most one apart): each shard, and each run inside it, holds every
source in the mixture's proportion, to within 1 + (number of sources) x (the source's share) rows, however many
rows there are.

No global sort and no window over a whole source: rows fall into hash buckets inside their source, and
into equal steps of fractional rank afterwards; bucket sizes are counted first, their running sums give each
bucket its first rank, and only rows inside one bucket are ranked by a window. A source with a third of all
rows is cut into as many buckets as its rows need.

Texts are read once and not shuffled; a row travels as (id, source, size, checksum, hash). Equal texts have no
part in this law: they are rows like any other and may land in different shards.

Defined results. Null source: a source of its own. Null text: size 1, checksum 0, like an empty one. Null id:
hashed as the text 'null'. Repeated rows each get a slot of their own. Fewer rows than shards: the first
shards get one row each. Ties of the hash go by id; rows that tie in both are alike. Texts of any length are measured
whole. Other columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import durable, table

#: Rows that one window bucket holds on average.
PER_BUCKET = 4096


def _ranked(rows: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Rank (from 1) of each row within ``group[:-1]``, by its last column's buckets and then ``order``."""
    # dealt by all columns of the group: a join before leaves a whole source in one task, which would do for what follows
    rows = rows.repartition(*group)
    counts = rows.groupBy(*group).agg(F.count("*").alias("bucket_n")).withColumn("hall", F.expr(f"{group[-1]} div {PER_BUCKET}"))
    # running sums over halls of buckets first, and over the buckets of a hall: no task has all buckets
    hall = [*group[:-1], "hall"]
    earlier = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    halls = counts.groupBy(*hall).agg(F.sum("bucket_n").alias("hall_n")).select(*hall, F.coalesce(F.sum("hall_n").over(earlier(group[:-1], "hall")), F.lit(0)).alias("hall_first"))
    first = counts.withColumn("in_hall", F.coalesce(F.sum("bucket_n").over(earlier(hall, group[-1])), F.lit(0))).join(halls, hall).select(*group, (F.col("hall_first") + F.col("in_hall")).alias("bucket_first"))
    inside = rows.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return inside.join(first, group).withColumn(out, F.col(out) + F.col("bucket_first")).drop("bucket_first")


def assign(docs: DataFrame, shards: int = 16, seed: int = 5, *, ident: str = "doc_id", source: str = "source", text: str = "text", per_bucket: int = PER_BUCKET) -> DataFrame:
    """Per row of ``docs``: id, source, size, text_crc32, shard (from 0), slot (gapless from 0 in its shard)."""
    body = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    slim = docs.select(F.col(ident).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null")).alias("s_key"), F.col(source).alias("src"), (F.octet_length(body).cast("long") + 1).alias("size"), crc.alias("text_crc32"), F.xxhash64(F.lit(seed), F.coalesce(F.col(ident).cast("string"), F.lit("null")), body).alias("h"))
    slim = durable(slim)
    per = slim.groupBy("s_key").agg(F.count("*").alias("s_n"))
    total = slim.count()
    rows = slim.join(per, "s_key")
    # hash buckets inside a source: equal shares of the 64-bit range, in the hash's order
    buckets = F.greatest(F.lit(1), F.ceil(F.col("s_n") / per_bucket)).cast("long")
    rows = rows.withColumn("bucket", F.floor((F.shiftright("h", 32) + F.lit(2**31)) * buckets / F.lit(2**32)).cast("long"))
    rows = _ranked(rows, ["s_key", "bucket"], ["h", "id"], "rank")
    rows = durable(rows.select("id", "src", "s_key", "s_n", "size", "text_crc32", "h", "rank"))
    rows = rows.withColumn("fraction", (F.col("rank") - 0.5) / F.col("s_n"))
    steps = max(1, -(-total // per_bucket))
    rows = rows.withColumn("all_rows", F.lit(0)).withColumn("step", F.least(F.floor(F.col("fraction") * steps), F.lit(steps - 1)).cast("long"))
    rows = _ranked(rows, ["all_rows", "step"], ["fraction", "s_key", "h", "id"], "place")
    # row p (from 0) of N goes to shard floor(p * shards / N); a shard starts at ceil(shard * N / shards)
    place = F.col("place") - 1
    rows = rows.withColumn("shard", F.expr(f"(place - 1) * {shards}L div {max(1, total)}L"))
    start = F.expr(f"(shard * {max(1, total)}L + {shards - 1}) div {shards}L")
    return rows.select(F.col("id").alias(ident), F.col("src").alias(source), "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (place - start).cast("long").alias("slot"))


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
