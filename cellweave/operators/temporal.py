"""Dates from parts, month ranges, temporal extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cf_datetime(df: DataFrame, year: str = "year", month: str | None = "month", day: str | None = "day", out: str = "datetime", drop: bool = True) -> DataFrame:
    """A date column from 1 to 3 part columns; null where the parts are no date. Without the year nothing is done."""
    if year not in df.columns:
        return df
    parts = [c for c in (year, month, day) if c and c in df.columns]

    def part(i: int, width: int) -> Column:
        if i >= len(parts):
            return F.lit("01")
        text = F.col(parts[i]).cast("string")
        return F.when(F.length(text) <= width, F.lpad(text, width, "0")).otherwise(text)  # lpad would cut what is longer

    text = F.concat_ws("-", part(0, 4), part(1, 2), part(2, 2))
    given = F.lit(True)
    for c in parts:
        given = given & F.col(c).isNotNull()
    dated = df.withColumn(out, F.when(given, F.try_to_date(text, "yyyy-MM-dd")))
    return dated.drop(*[p for p in parts if p != out]) if drop else dated


def month_range(first_month: int, last_month: int, first_year: int, last_year: int) -> list[str]:
    """All MM_YYYY of the years whose month lies in the range; a range over the year's end wraps."""
    wrapped = list(range(first_month, last_month + 1)) if first_month <= last_month else [*range(first_month, 13), *range(1, last_month + 1)]
    return [f"{m:02d}_{y}" for y in range(first_year, last_year + 1) for m in wrapped]


def window(column: str, start: str, end_year: int, end_month: int, legacy_day28: bool = False) -> Column:
    """Timestamps from ``start`` to the end of a month (or to its 28th day, as some catalogs have it)."""
    last = F.make_date(F.lit(end_year), F.lit(end_month), F.lit(28)) if legacy_day28 else F.last_day(F.make_date(F.lit(end_year), F.lit(end_month), F.lit(1)))
    return (F.col(column) >= F.lit(start).cast("date")) & (F.col(column) <= last)


def extent(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """One row: first day of the first month, last day of the last."""
    day = F.make_date(F.col(year), F.col(month), F.lit(1))
    return df.agg(F.min(day).alias("start"), F.last_day(F.max(day)).alias("end"))
