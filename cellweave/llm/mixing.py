"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is the number of times its documents must appear on average for the mixture to
have the target weights: target weight x target size / size of the source. Each document appears a Poisson
number of times with that mean: a uniform number hashed from (seed, id, text) is put through the inverse of
the distribution, so a rerun, a retry or another partitioning gives the same copies. Copies are exploded and
put in a global order by a hash of (seed, id, text, copy).

Rates are a table with a row for each source, joined by source; size totals are pre-aggregated before the
shuffle. Beyond a rate of 64 a document appears floor(rate - 32) times for sure, and Poisson(rest) times more
(``k_max`` bounds the inverse at rates up to 64 with a tail below 1e-15). The mean stays exact, and
the spread stays below that of Poisson.

The text is read twice: once for sizes, once for the copies. The global order is dealt by ranges of the hash
(no sampling pass over the data) and sorted inside each.

Defined results. Null source: a source of its own (null). Null or empty text: size 1 (UTF-8 bytes plus 1). Null
id: hashed as the text 'null'. Repeated rows are drawn alike: all of them appear equally often. An empty table
gives an empty mixture. Columns named like the added ones are replaced by them in ``mix``'s result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import table

#: Values of the hashes: 60 bits to order by, 52 for the uniform number.
SPAN, UNIFORM = 2**60, 2.0**52


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, *, temperature: float = 0.5, source: str = "source", text: str = "text", epochs: float = 1.0) -> DataFrame:
    """A row for each source: (source, n_docs, size, target, rate).

    ``weights``: target weights by source, scaled to sum to 1; sources left out get 0. Without: in proportion
    to size ** ``temperature``. The mixture's expected size is ``epochs`` times that of ``docs``.
    """
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    per = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_docs"), F.sum(size).alias("size"))
    if weights is None:
        raw = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
        per = per.withColumn("raw", raw)
    else:
        value = F.lit(0.0)
        for name, w in weights.items():
            value = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(value)
        per = per.withColumn("raw", value)
    totals = per.agg(F.sum("raw").alias("raw_all"), F.sum("size").alias("size_all"))
    per = per.crossJoin(totals)  # totals: one row
    target = F.when(F.col("raw_all") > 0, F.col("raw") / F.col("raw_all")).otherwise(F.lit(0.0))
    return per.select("source", "n_docs", "size", target.alias("target"), (target * float(epochs) * F.col("size_all") / F.col("size")).alias("rate"))


def hashed(seed: int, *parts: str) -> str:
    """SQL: 60 bits of md5 over the seed and the parts, as a long."""
    joined = ", ".join([f"'{seed}'", *parts])
    return f"cast(conv(substring(md5(concat_ws('|', {joined})), 1, 15), 16, 10) as bigint)"


def poisson_count(uniform: str, rate: str, k_max: int = 160) -> str:
    """SQL: the inverse of Poisson(rate) at ``uniform`` in (0, 1): how many values of its CDF do not exceed it."""
    steps = f"""aggregate(sequence(1, {k_max}),
        named_struct('p', exp(-{rate}), 'cdf', exp(-{rate}), 'k', if({uniform} >= exp(-{rate}), 1, 0)),
        (s, i) -> named_struct('p', s.p * {rate} / i, 'cdf', s.cdf + s.p * {rate} / i, 'k', s.k + if(s.k = i and {uniform} >= s.cdf + s.p * {rate} / i, 1, 0)),
        s -> s.k)"""
    return f"case when {rate} <= 0 then 0 else {steps} end"


def copies(docs: DataFrame, by_source: DataFrame, seed: int, *, ident: str = "doc_id", source: str = "source", text: str = "text", carry: bool) -> DataFrame:
    """A row for each copy: columns d0.. (all of ``docs`` if ``carry``), id, source, copy (from 1), rate, spot."""
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    cols = [F.col(c).alias(f"d{i}") for i, c in enumerate(docs.columns)] if carry else []
    base = docs.select(*cols, F.col(ident).alias("m_id"), F.col(source).alias("m_source"), F.coalesce(F.col(ident).cast("string"), F.lit("null")).alias("m_key"), body.alias("m_text"))
    base = base.withColumn("u", (F.shiftright(F.expr(hashed(seed, "m_key", "m_text")), 8) + 0.5) / UNIFORM)
    slim = by_source.select(F.col("source").alias("r_source"), "rate", F.when(F.col("rate") > 64, F.floor(F.col("rate") - 32)).otherwise(F.lit(0)).cast("int").alias("sure"))
    slim = slim.withColumn("mean", F.col("rate") - F.col("sure"))
    drawn = base.join(slim, F.col("m_source").eqNullSafe(F.col("r_source"))).withColumn("n_copies", F.expr(f"cast(sure + {poisson_count('u', 'mean')} as int)")).where("n_copies > 0")
    out = drawn.withColumn("copy", F.explode(F.expr("sequence(1, n_copies)")))
    return out.withColumn("spot", F.expr(hashed(seed + 1, "m_key", "m_text", "cast(copy as string)")))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = 17, *, temperature: float = 0.5, epochs: float = 1.0, ident: str = "doc_id", source: str = "source", text: str = "text", placed: bool = False) -> DataFrame:
    """The mixture: all columns of ``docs``, a row for each copy, in a global order that the hash decides.

    Partition i holds the i-th range of the hash, sorted: the files written are in the global order. ``placed``
    adds ``copy`` (from 1) and ``place``, the row's number in that order (from 0).
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_source, names = rates(docs, weights, temperature=temperature, epochs=epochs, source=source, text=text), {"ident": ident, "source": source, "text": text}
    span = -(-SPAN // n)
    dealt = lambda carry: copies(docs, by_source, seed, **names, carry=carry).withColumn("range", F.expr(f"cast(spot div {span}L as int)"))
    # rows of equal id and text tie in hash: the other columns decide, and rows equal in those too are alike
    rest = [F.xxhash64(f"d{i}") for i, f in enumerate(docs.schema) if "map<" not in f.dataType.simpleString()]
    order = ["spot", "m_key", "m_text", "copy", *rest]
    out = dealt(True).repartitionById(n, F.col("range")).sortWithinPartitions("range", *order)
    cols = [F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns) if not placed or c not in ("copy", "place")]
    if not placed:
        return out.select(*cols)
    before = dealt(False).groupBy("range").agg(F.count("*").alias("n"))
    before = before.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))  # a row for each range
    out = out.withColumn("at", F.row_number().over(Window.partitionBy("range").orderBy(*order))).join(F.broadcast(before), "range")
    return out.select(*cols, "copy", (F.col("before") + F.col("at") - 1).alias("place"))


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: all columns of the documents, ``copy`` (from 1) and ``place`` (in the global order, from 0, unique)."""
    return mix(table(spark, sf_dir, "documents"), placed=True)


#: The same rows in DuckDB. CAST to double keeps decimals out.
OP2_SQL = """
with sized as (
  select *, coalesce(text, '') as body, octet_length(encode(coalesce(text, '')))::bigint + 1 as size from documents),
per as (select source, sum(size)::double as size, pow(sum(size)::double, 0.5::double) as raw from sized group by source),
rates as (
  select source, raw / (sum(raw) over ()) * 1.0::double * (sum(size) over ()) / size as rate from per),
drawn as (
  select s.*, r.rate, coalesce(s.doc_id::varchar, 'null') as k, md5(s.body) as b,
    case when r.rate > 64::double then floor(r.rate - 32::double) else 0::double end as sure
  from sized s join rates r on s.source is not distinct from r.source),
hashed as (
  select *, ((('0x' || substr(md5(concat_ws('|', '17', k, b)), 1, 15))::bigint >> 8) + 0.5::double) / 4503599627370496::double as u, rate - sure as mean from drawn),
steps as (
  select h.*,
    list_reduce(list_transform(range(1, 161), lambda i: {'i': i, 'p': 0::double, 'cdf': 0::double, 'n': 0::bigint}),
      lambda s, x: {'i': x.i, 'p': s.p * h.mean / x.i, 'cdf': s.cdf + s.p * h.mean / x.i,
                 'n': s.n + case when s.n = x.i and h.u >= s.cdf + s.p * h.mean / x.i then 1 else 0 end},
      {'i': 0::bigint, 'p': exp(-h.mean), 'cdf': exp(-h.mean), 'n': (case when h.u >= exp(-h.mean) then 1 else 0 end)::bigint}) as fin
  from hashed h),
expanded as (select *, unnest(range(1, sure::bigint + fin.n + 1)) as copy from steps where mean > 0::double),
spotted as (select *, ('0x' || substr(md5(concat_ws('|', '18', k, b, copy::varchar)), 1, 15))::bigint as spot from expanded)
select doc_id, text, lang, source, n_chars, copy::integer as copy, row_number() over (order by spot, k, b, copy) - 1 as place from spotted
"""
