"""WARC records and a Merkle fixity audit of their replicas.

Pages become WARC/1.1 response records (an HTTP block, its digest and its length in the header), laid one behind the
other in files; a record's place in its file is an offset and a length. A tree stands over each file: leaves are
SHA-256 values of (offset, length, digest of the header, which holds the block's digest), and a node above covers
``FANOUT`` neighbours in offset order, hashing its offset range and its children's values. Two replicas agree if
their roots do. An audit compares roots, and descends level by level only into nodes that differ. Beside the roots it
touches FANOUT x depth nodes for each record whose length is unchanged; a record lost, added or of another length
moves all that follow it in its file, so that the rest of that file is visited. In the leaves reached, records are
told apart by their names: sound ones that only moved are no damage.

Trees are built bottom up, a level per aggregation: a group is one node's children, so never more than ``FANOUT``
values. Files hold about ``PER_FILE`` records, by a hash of the record's name, which bounds every window that numbers
a file's records. A name is made of id, url, block and the record's number among rows that are equal in all three,
which are counted and not windowed: null or repeated ids spread over all files. Blocks are hashed where they are read
and not shuffled (but for ``write``, which brings a file's records together).

Defined results. Null url or html: empty ones. Null id: named as the text 'null', keeps its row. Repeated rows are
records of their own. Texts of any length are hashed whole; ``read`` holds one file at a time. A file that one replica
lacks differs at its root, and all its records are ``missing`` or ``extra``. An empty table has no files. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import durable, ship, table

PER_FILE = 1024
FANOUT = 16
#: The date of capture that records bear (pages have none).
DATE = "2000-01-01T00:00:00Z"
#: What ends a record.
END = "\r\n\r\n"


def block(html: Column) -> Column:
    """The HTTP response of a page."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body)


def header(name: Column, url: Column, digest: Column, length: Column, date: str = DATE) -> Column:
    """A record's header. Content-Length counts the block's UTF-8 bytes."""
    part = lambda a, n: F.substring(name, a, n)
    uuid = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"), uuid, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Block-Digest: sha256:"), digest,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(END),
    )


def files_for(pages: DataFrame, per_file: int = PER_FILE) -> int:
    return max(1, -(-pages.count() // per_file))


def _named(counted: DataFrame, files: int) -> DataFrame:
    """Rows (key, url, digest, n, ...) once for each of their ``n`` records, with ``name`` and ``file``."""
    rows = counted.withColumn("of", F.explode(F.expr("sequence(0, (n - 1) div 4096)"))).withColumn("nth", F.explode(F.expr("sequence(of * 4096 + 1, least(n, (of + 1) * 4096))")))
    rows = rows.withColumn("name", F.md5(F.concat_ws("|", "key", "url", "digest", F.col("nth").cast("string")))).drop("of", "nth", "n")
    return rows.withColumn("file", F.expr(f"cast(cast(conv(substring(name, 1, 8), 16, 10) as bigint) % {files} as int)"))


def archive(pages: DataFrame, files: int, *, ident: str = "page_id", url: str = "url", html: str = "html", also: dict[str, Column] | None = None) -> DataFrame:
    """The records of pages, without their texts: (file, name, id, url, digest and length of the block).

    ``also``: further columns over those of ``pages``, on which equal rows must agree too.
    """
    text = block(F.col(html))
    slim = pages.select(F.col(ident).alias("id"), F.coalesce(F.col(ident).cast("string"), F.lit("null")).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.sha2(text.cast("binary"), 256).alias("digest"), F.octet_length(text).cast("long").alias("length"), *[v.alias(k) for k, v in (also or {}).items()])
    return _named(slim.groupBy(*slim.columns).agg(F.count("*").alias("n")), files).drop("key")


def manifest(records: DataFrame, order: tuple[str, ...] = ("name",)) -> DataFrame:
    """The leaves of records (file, name, id, url, digest, length): (file, seq, name, id, off, len, record, digest).

    ``record`` is the digest of the header, which names block and record; ``digest`` the leaf's.
    """
    head = header(F.col("name"), F.col("url"), F.col("digest"), F.col("length"))
    rows = records.select("file", "name", "id", (F.octet_length(head) + F.col("length") + len(END)).cast("long").alias("len"), F.sha2(head.cast("binary"), 256).alias("record"), *[c for c in order if c != "name"])
    inside = Window.partitionBy("file").orderBy(*order)
    rows = rows.withColumn("seq", F.row_number().over(inside) - 1).withColumn("off", F.coalesce(F.sum("len").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.select("file", "seq", "name", "id", "off", "len", "record", _leaf())


def _leaf() -> Column:
    return F.sha2(F.concat_ws("|", F.col("off").cast("string"), F.col("len").cast("string"), "record").cast("binary"), 256).alias("digest")


def write(pages: DataFrame, path: str, per_file: int = PER_FILE, *, ident: str = "page_id", url: str = "url", html: str = "html") -> None:
    """WARC files under ``path``, one in each folder ``file=N``: records in the order of their names."""
    files = files_for(pages, per_file)
    text = block(F.col(html))
    rows = pages.select(F.coalesce(F.col(ident).cast("string"), F.lit("null")).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    named = _named(rows.groupBy("key", "url", "digest").agg(F.first("text").alias("text"), F.count("*").alias("n")), files)
    whole = F.concat(header(F.col("name"), F.col("url"), F.col("digest"), F.octet_length("text")), F.col("text"))  # the writer adds END
    named.select("file", "name", whole.alias("value")).repartition("file").sortWithinPartitions("file", "name").select("file", "value").write.mode("overwrite").partitionBy("file").option("lineSep", END).text(path)


def parse(content: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """(offset, header with its end, block) of each record of a file; what cannot be parsed is one record without header."""
    at = 0
    while at < len(content):
        stop = content.find(END.encode(), at)
        length = -1
        if stop >= 0 and content.startswith(b"WARC/1.1\r\n", at):
            for line in content[at:stop].split(b"\r\n"):
                if line.lower().startswith(b"content-length:") and line[15:].strip().isdigit():
                    length = int(line[15:])
        begin = stop + len(END)
        if length < 0 or content[begin + length : begin + length + len(END)] != END.encode():
            yield at, b"", content[at:]
            return
        yield at, content[at:begin], content[begin : begin + length]
        at = begin + length + len(END)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files that ``write`` made: (file, seq, name, url, off, len, html, record, digest), digests taken from what is there.

    ``name`` is empty where no record can be parsed. The leaf of a record whose block does not fit its header is
    another than that of a sound record.
    """
    ship(spark)
    found = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int").alias("file"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for seq, (off, head, body) in enumerate(parse(content.as_py())):
                    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))}
                    sound = fields.get("warc-block-digest") == "sha256:" + hashlib.sha256(body).hexdigest()
                    record = hashlib.sha256(head if sound else head + hashlib.sha256(body).digest()).hexdigest()
                    rows.append((file, seq, fields.get("warc-record-id", "")[10:-1].replace("-", ""), fields.get("warc-target-uri", ""), off, len(head) + len(body) + (len(END) if head else 0), body.partition(END.encode())[2].decode("utf-8", "replace"), record))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 8, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["file", "seq", "name", "url", "off", "len", "html", "record"])

    return found.mapInArrow(run, "file int, seq int, name string, url string, off long, len long, html string, record string").select("*", _leaf())


def level_up(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """From nodes (file, level, seq, off, len, digest) the level above."""
    groups = nodes.groupBy("file", (F.col("level") + 1).alias("level"), F.expr(f"cast(seq div {fanout} as int)").alias("seq"))
    up = groups.agg(F.min("off").alias("off"), F.sum("len").alias("len"), F.sort_array(F.collect_list(F.struct(F.col("seq"), F.col("digest")))).alias("kids"))
    return up.select("file", "level", "seq", "off", "len", F.sha2(F.concat_ws("|", F.col("off").cast("string"), F.col("len").cast("string"), F.array_join(F.col("kids.digest"), "|")).cast("binary"), 256).alias("digest"))


def depth(per_file: int, fanout: int = FANOUT) -> int:
    """Levels above the leaves of files with at most ``per_file`` records."""
    levels = 0
    while per_file > 1:
        per_file = -(-per_file // fanout)
        levels += 1
    return levels


def tree(leaves: DataFrame, levels: int, fanout: int = FANOUT) -> DataFrame:
    """All nodes (file, level, seq, off, len, digest); the root of a file is its one node at level ``levels``."""
    now = leaves.select("file", F.lit(0).alias("level"), F.col("seq").cast("int").alias("seq"), "off", "len", "digest")
    nodes = now
    for _ in range(levels):
        now = level_up(now, fanout)
        nodes = nodes.unionByName(now)
    return nodes


def audit(first: DataFrame, second: DataFrame, levels: int, fanout: int = FANOUT) -> DataFrame:
    """Places (file, seq) whose leaves differ between two trees, or that only one of them has.

    Top down: nodes of a level are compared only under parents that differ.
    """
    suspects = None
    for level in range(levels, -1, -1):
        side = lambda t, name: t.where(F.col("level") == level).select("file", "seq", F.col("digest").alias(name))  # noqa: B023, E731
        a, b = side(first, "d1"), side(second, "d2")
        if suspects is not None:
            parent = suspects.select("file", F.col("seq").alias("parent"))
            a, b = (x.withColumn("parent", F.expr(f"cast(seq div {fanout} as int)")).join(parent, ["file", "parent"], "left_semi").drop("parent") for x in (a, b))
        suspects = durable(a.join(b, ["file", "seq"], "full_outer").where("d1 is null or d2 is null or d1 <> d2").select("file", "seq"))
    return suspects


def fixity(mine: DataFrame, other: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Every record of two manifests: (file, seq, name, id, off, len, digest, root, status).

    Places, digests and roots are those of ``mine`` (of ``other`` where mine lacks the record). ``status``: ``ok``,
    ``moved`` (sound, at another place), ``changed``, ``missing`` (in other) or ``extra``.
    """
    mine, other = durable(mine), durable(other)
    fullest = mine.select("seq").unionByName(other.select("seq")).agg(F.max("seq")).first()[0]
    levels = depth((fullest or 0) + 1, fanout)
    first, second = (durable(tree(m, levels, fanout)) for m in (mine, other))
    suspects = audit(first, second, levels, fanout)
    columns = ["file", "seq", "name", "id", "off", "len", "digest", "record"]
    a, b = (m.select(*columns).join(suspects, ["file", "seq"], "left_semi") for m in (mine, other))
    theirs = b.select("file", "name", F.col("record").alias("their_record"))
    met = a.join(theirs, ["file", "name"], "left").select(*columns[:-1], F.when(F.col("their_record").isNull(), "missing").when(F.col("record") == F.col("their_record"), "moved").otherwise("changed").alias("status"))
    extra = b.join(a.select("file", "name"), ["file", "name"], "left_anti").select(*columns[:-1], F.lit("extra").alias("status"))
    sound = mine.join(suspects, ["file", "seq"], "left_anti").select(*columns[:-1], F.lit("ok").alias("status"))
    roots = lambda t, name: t.where(F.col("level") == levels).select("file", F.col("digest").alias(name))
    rooted = roots(first, "r1").join(roots(second, "r2"), "file", "full_outer").select("file", F.coalesce("r1", "r2").alias("root"))
    return sound.unionByName(met).unionByName(extra).join(rooted, "file").select("file", "seq", "name", "id", "off", "len", "digest", "root", "status")


#: What happens to the records of pages in the query's replica, by the id's remainder modulo 97.
FATES = {13: "swapped", 29: "longer", 41: "lost", 53: "doubled"}


def decayed(records: DataFrame) -> DataFrame:
    """A replica of records with ``fate``, ``bad_digest`` and ``bad_length``: blocks changed, records lost and added.

    An added record has a name of its own and lies behind the one it doubles (``after``).
    """
    hurt = F.col("fate").isin("swapped", "longer")
    kept = records.where("fate <> 'lost'").withColumns({"digest": F.when(hurt, F.col("bad_digest")).otherwise(F.col("digest")), "length": F.when(hurt, F.col("bad_length")).otherwise(F.col("length")), "after": F.col("name")})
    added = kept.where("fate = 'doubled'").withColumn("name", F.md5(F.concat(F.lit("again|"), F.col("name"))))
    return kept.unionByName(added)


def fate(ident: str = "page_id", html: str = "html") -> dict[str, Column]:
    """Columns that ``decayed`` needs: a swapped first character (nothing where there is none), a character more, or another fate."""
    left = F.col(ident) % 97
    kind = F.lit("none")
    for remainder, name in FATES.items():
        kind = F.when(left == remainder, name).otherwise(kind)
    kind = F.when(left.isNull() | ((kind == "swapped") & (F.length(F.coalesce(F.col(html), F.lit(""))) == 0)), "none").otherwise(kind)
    swapped = F.concat(F.when(F.substring(html, 1, 1) == "#", "*").otherwise("#"), F.expr(f"substring(`{html}`, 2)"))
    bad = block(F.when(kind == "swapped", swapped).otherwise(F.concat(F.coalesce(F.col(html), F.lit("")), F.lit("#"))))
    hurt = kind.isin("swapped", "longer")
    return {"fate": kind, "bad_digest": F.when(hurt, F.sha2(bad.cast("binary"), 256)), "bad_length": F.when(hurt, F.octet_length(bad).cast("long"))}


def op9_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the pages' archive, audited against a replica with blocks changed, and records lost and added."""
    pages = table(spark, sf_dir, "pages")
    records = durable(archive(pages, files_for(pages), also=fate()))
    out = fixity(manifest(records), manifest(decayed(records), ("after", "name")))
    return out.select(F.col("id").alias("page_id"), "name", "file", "seq", "off", "len", "digest", "root", "status")


def _level_sql(side: str, below: str, name: str) -> str:
    return f"""{side}{name} as (select file, seq // {FANOUT} as seq, min(off) as off, sum(len)::bigint as len,
  sha256(concat_ws('|', min(off)::varchar, sum(len)::bigint::varchar, string_agg(digest, '|' order by seq))) as digest from {side}{below} group by file, seq // {FANOUT})"""


def _side_sql(side: str, order: str) -> str:
    """A replica's leaves, levels and roots (in files of at most FANOUT ** 3 records)."""
    return f"""{side}h as (select *, concat('WARC/1.1', e, 'WARC-Type: response', e, 'WARC-Record-ID: <urn:uuid:', substr(name, 1, 8), '-', substr(name, 9, 4), '-', substr(name, 13, 4), '-', substr(name, 17, 4), '-', substr(name, 21, 12), '>', e, 'WARC-Date: {DATE}', e,
  'WARC-Target-URI: ', u, e, 'WARC-Block-Digest: sha256:', sha256(block), e, 'Content-Type: application/http; msgtype=response', e, 'Content-Length: ', octet_length(encode(block)), e, e) as head from {side}),
{side}r as (select *, (octet_length(encode(head)) + octet_length(encode(block)) + 4)::bigint as len, sha256(head) as record from {side}h),
{side}o as (select *, row_number() over (partition by file order by {order}) - 1 as seq, coalesce(sum(len) over (partition by file order by {order} rows between unbounded preceding and 1 preceding), 0)::bigint as off from {side}r),
{side}l0 as (select page_id, name, file, seq, off, len, record, sha256(concat_ws('|', off::varchar, len::varchar, record)) as digest from {side}o),
{_level_sql(side, 'l0', 'l1')}, {_level_sql(side, 'l1', 'l2')}, {_level_sql(side, 'l2', 'l3')}"""


#: The same rows in DuckDB, by comparing all records of both replicas.
OP9_SQL = f"""
with p as (select page_id, coalesce(url, '') as u, coalesce(html, '') as h, coalesce(page_id::varchar, 'null') as k, chr(13) || chr(10) as e, page_id % 97 as m from pages),
f as (select greatest(1, (count(*) + {PER_FILE - 1}) // {PER_FILE}) as files from p),
b as (select *, concat('HTTP/1.1 200 OK', e, 'Content-Type: text/html; charset=utf-8', e, 'Content-Length: ', octet_length(encode(h)), e, e, h) as block,
  case when m = 13 and length(h) > 0 then concat(case when substr(h, 1, 1) = '#' then '*' else '#' end, substr(h, 2)) when m = 29 then concat(h, '#') else h end as h2 from p),
n as (select *, md5(concat_ws('|', k, u, sha256(block), row_number() over (partition by page_id, u, h)::varchar)) as name from b),
a as (select page_id, u, e, block, h2, m, name, (('0x' || substr(name, 1, 8))::bigint % files)::int as file from n, f),
z0 as (select page_id, u, e, concat('HTTP/1.1 200 OK', e, 'Content-Type: text/html; charset=utf-8', e, 'Content-Length: ', octet_length(encode(h2)), e, e, h2) as block, name, name as after, file, m from a where m is null or m <> 41),
z as (select * from z0 union all select page_id, u, e, block, md5('again|' || name), after, file, m from z0 where m = 53),
{_side_sql('a', 'name')},
{_side_sql('z', 'after, name')},
top as (select greatest((select max(seq) from al0), (select max(seq) from zl0)) as most),
d as (select case when most = 0 then 0 when most < 16 then 1 when most < 256 then 2 else 3 end as levels from top),
roots as (select file, max(digest) filter (where side = 'a') as ra, max(digest) filter (where side = 'z') as rz from (
  select 'a' as side, file, digest, 0 as level from al0 union all select 'a', file, digest, 1 from al1 union all select 'a', file, digest, 2 from al2 union all select 'a', file, digest, 3 from al3
  union all select 'z', file, digest, 0 from zl0 union all select 'z', file, digest, 1 from zl1 union all select 'z', file, digest, 2 from zl2 union all select 'z', file, digest, 3 from zl3) t, d where t.level = d.levels group by file)
select coalesce(x.page_id, y.page_id) as page_id, coalesce(x.name, y.name) as name, coalesce(x.file, y.file) as file, coalesce(x.seq, y.seq)::int as seq, coalesce(x.off, y.off) as off, coalesce(x.len, y.len) as len, coalesce(x.digest, y.digest) as digest, coalesce(ra, rz) as root,
  case when y.name is null then 'missing' when x.name is null then 'extra' when x.record <> y.record then 'changed' when x.digest <> y.digest or x.seq <> y.seq then 'moved' else 'ok' end as status
from al0 x full outer join zl0 y on x.file = y.file and x.name = y.name join roots on roots.file = coalesce(x.file, y.file)
"""
