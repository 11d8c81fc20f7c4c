"""Readers: occurrence tables, archives, catalogs, inventories, recipes, raster assets."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from cellweave.runtime import ship

OCCURRENCE = StructType(
    [StructField("gbifid", LongType()), StructField("specieskey", LongType()), StructField("year", IntegerType()), StructField("month", IntegerType()), StructField("day", IntegerType()), StructField("recordedby", StringType()),
     StructField("individualcount", DoubleType()), StructField("decimallatitude", DoubleType()), StructField("decimallongitude", DoubleType()), StructField("coordinateuncertaintyinmeters", DoubleType()), StructField("occurrencestatus", StringType())]
)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """A tab if the first line has one, else a comma."""
    first = spark.read.text(path).limit(1).first()
    return "\t" if first is not None and "\t" in first[0] else ","


def read_occurrences(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet, delimited text without quoting, or a zip with such a text."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".zip"):
        return read_zip(spark, path, schema)
    sep = sniff_separator(spark, path)
    reader = spark.read.option("header", True).option("sep", sep).option("quote", "")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_zip(spark: SparkSession, path: str, schema: StructType | None = None, lines: int = 20_000) -> DataFrame:
    """The first ``*.csv`` member of each archive, tab-separated, streamed line by line in the task that has the archive."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    names = [n for n in z.namelist() if n.endswith(".csv")]
                    if not names:
                        continue
                    with io.TextIOWrapper(z.open(names[0]), encoding="utf-8", newline="\n") as f:
                        header, block = f.readline().rstrip("\r\n"), []
                        for line in f:
                            block.append(line.rstrip("\r\n"))
                            if len(block) == lines:
                                yield pa.RecordBatch.from_arrays([pa.array([header] * len(block)), pa.array(block)], names=["header", "line"])
                                block = []
                        yield pa.RecordBatch.from_arrays([pa.array([header] * len(block), pa.string()), pa.array(block, pa.string())], names=["header", "line"])

    text = files.mapInArrow(unzip, "header string, line string")
    fields = F.map_from_arrays(F.split(F.lower("header"), "\t"), F.split("line", "\t", -1))
    wanted = schema or OCCURRENCE
    return text.select(fields.alias("m")).select(*[F.nullif(F.col("m").getItem(f.name.lower()), F.lit("")).try_cast(f.dataType).alias(f.name) for f in wanted])


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_catalog(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A catalog of assets; an empty one if there is no file."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def asset_href(variable: str = "variable", assets: str = "assets"):
    """The address of a row's own variable in its map of assets."""
    return F.try_element_at(F.col(assets), F.col(variable))["href"]


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("category string, dataset_id string, productType string, resolution string, year int, format string, items_found int, bbox boolean").csv(path)


def load_recipe(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def read_assets(plan: DataFrame, fetch: Callable[[str], Iterator[tuple[int, int, float]]], href: str = "href", attempts: int = 3) -> DataFrame:
    """Pixels of every asset of a plan: its columns, and row, col, value, status.

    ``fetch`` gives (row, col, value) of one address. An asset that fails ``attempts`` times, has no pixels or only
    empty ones gives one row with its status, so that the rest of the plan goes on; one task for each asset.
    """
    ship(plan.sparkSession)
    names = plan.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema), "row long, col long, value double, status string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pixels, status = [], "failed"
                for _ in range(attempts):
                    try:
                        pixels = list(fetch(batch.column(names.index(href))[i].as_py()))
                        status = "ok" if any(v is not None and v == v for _, _, v in pixels) else "empty"
                        break
                    except OSError:
                        continue
                pixels = pixels if status == "ok" else [(None, None, None)]
                n = len(pixels)
                columns = [pa.array([p[k] for p in pixels], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array([i] * n)) for c in range(len(names))), *columns, pa.array([status] * n)], names=[*names, "row", "col", "value", "status"])

    return plan.repartition(max(1, min(plan.count(), 10_000)), href).mapInArrow(run, schema)
