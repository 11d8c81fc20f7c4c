"""Cube aggregation: all metrics of a recipe in one pass over the mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Aggregations a recipe may name. An empty sum is 0; the rest skip nulls and are null where nothing is left.
METHODS = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "nunique": F.countDistinct,
    "median": F.median,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
    "size": lambda c: F.count("*"),
    "prod": lambda c: F.product(F.coalesce(c, F.lit(1))),
}


def weight_column(df: DataFrame) -> Column:
    """The mapping's share of each row: ``areal_fraction``, else ``fraction``, else 1."""
    for name in ("areal_fraction", "fraction"):
        if name in df.columns:
            return F.col(name)
    return F.lit(1.0)


def number(column: Column) -> Column:
    """As a double; null where it is none."""
    return column.cast("string").try_cast("double")


def metric(df: DataFrame, spec: dict) -> Column | None:
    """One aggregate of a recipe: {column, method, weighted, rename}; None if the column is missing.

    A weighted sum counts a missing or non-numeric value as 1, a weighted mean as 0; the weighted mean is the
    plain mean of weight x value.
    """
    name = spec["column"]
    method = spec.get("method") or "nunique"
    if method not in METHODS:
        raise ValueError(f"no aggregation {method!r}; there are {', '.join(METHODS)}")
    if name not in df.columns and method != "size":
        return None
    out = spec.get("rename") or f"{name}_{method}"
    if spec.get("weighted") and method in ("sum", "mean"):
        value = F.coalesce(number(F.col(name)), F.lit(1.0 if method == "sum" else 0.0)) * weight_column(df)
        return METHODS[method](value).alias(out)
    return METHODS[method](F.col(name) if name in df.columns else F.lit(1)).alias(out)


def aggregate_cube(mapping: DataFrame, group_by: list[str], metrics: list[dict], cell: str = "grid_idx") -> DataFrame:
    """Group by cell and dimensions (those that exist; null groups stay) with all metrics at once."""
    keys = [cell, *(c for c in group_by if c in mapping.columns and c != cell)]
    found = [m for m in (metric(mapping, s) for s in metrics) if m is not None]
    grouped = mapping.groupBy(*keys)
    return grouped.agg(*found) if found else mapping.select(*keys).distinct()


def cube_sql(df: DataFrame, dims: list[str], cellcode: Column, metrics: list[dict] | None = None, record: str = "occurrences") -> DataFrame:
    """The cube that an occurrence service would return: grouped by dimensions and cell code.

    Without metrics: how many records. A sum counts a missing value as 1.
    """
    methods = {"sum": lambda c: F.sum(F.coalesce(c, F.lit(1))), "mean": F.avg, "max": F.max, "min": F.min, "nunique": F.countDistinct, "count": F.count}
    aggs = [methods[m.get("method") or "nunique"](F.col(m["column"])).alias(m.get("rename") or f"{m['column']}_{m.get('method') or 'nunique'}") for m in metrics or []]
    return df.withColumn("cellcode", cellcode).groupBy(*dims, "cellcode").agg(*(aggs or [F.count("*").alias(record)]))


def sparse_cube(df: DataFrame, dims: list[str], value: str) -> DataFrame:
    """Coordinates and value of a sparse cube: rows with all dimensions, equal coordinates added."""
    return df.dropna(subset=dims).groupBy(*dims).agg(F.sum(value).alias(value))


def dimension_table(fact: DataFrame, grid, cell: str = "grid_idx") -> DataFrame:
    """The cells of a fact table with their boxes."""
    ids = fact.select(cell).where(F.col(cell).isNotNull()).distinct()
    return ids.select(cell, *[v.alias(k) for k, v in grid.box(F.col(cell)).items()])
