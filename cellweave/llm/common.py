"""Shared plumbing of the corpus operators: tables, durable lineage cuts, what workers keep."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.runtime import ship

__all__ = ["CHUNK_CHARS", "blocks", "crc_fold", "durable", "fold", "release", "resident", "scratch", "ship", "table"]

#: Rows that one Python task handles at a time when it needs a block of texts in memory, in characters.
CHUNK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder that ``spark.checkpoint.dir`` names.

    A folder of this process's own is set only in local mode (tests), where the session names none; on a
    cluster that is an error, since executors would write to disks of their own.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellweave-checkpoint-"))
    made = df.checkpoint(eager=True)
    for held in _SCRATCH[-1:]:
        held.append(made)
    return made


def release(df: DataFrame) -> None:
    """Delete the checkpoint that ``durable`` made: for frames that nothing reads any more."""
    jvm, rdd = df.sparkSession.sparkContext._jvm, df._jdf.queryExecution().logical().rdd()
    file = rdd.getCheckpointFile()
    if file.isDefined():
        path = jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SCRATCH: list[list[DataFrame]] = []


@contextmanager
def scratch(*finished: DataFrame) -> Iterator[list[DataFrame]]:
    """Checkpoints made inside are deleted at the end, but for those taken out of the list that this gives.

    ``finished``: further checkpoints to delete then.
    """
    held: list[DataFrame] = []
    _SCRATCH.append(held)
    try:
        yield held
    finally:
        _SCRATCH.pop()
    for df in (*held, *finished):
        release(df)


_RESIDENT: dict = {}


def resident(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in a Python worker beyond the task for the next with the same key.

    A worker keeps one such thing: whoever comes next with another key replaces it.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def blocks(texts: Sequence | pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about ``limit`` characters, with the position of the first; null texts are empty ones."""
    at, block, size = 0, [], 0
    for i, value in enumerate(texts):
        text = (value.as_py() if isinstance(value, pa.Scalar) else value) or ""
        block.append(text)
        size += len(text)
        if size >= limit:
            yield at, block
            at, block, size = i + 1, [], 0
    if block:
        yield at, block


def fold(column: str, modulus: int) -> Column:
    """crc32 of the value written as text, modulo ``modulus``; a null value counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc_fold(value: object, modulus: int) -> int:
    """Plain-Python twin of ``fold``."""
    import zlib

    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus
