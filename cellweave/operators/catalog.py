"""Asset catalogs: object keys, execution plans, product inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.filters import members
from cellweave.operators.temporal import window

#: Resampling rules of climate variables.
CLIMATE_RULES = {"tas": "bilinear", "tasmax": "bilinear", "tasmin": "bilinear", "pr": "average", "clt": "bilinear", "hurs": "bilinear", "pet": "average", "rsds": "bilinear", "sfcWind": "bilinear", "vpd": "bilinear"}


def parse_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """level, variable, time_range, model, scenario, month, date of keys ``.../<root>/global/<level>/<variable>/...``.

    Climatologies and bioclim keys name a period, and below it a model and a scenario if they are projections;
    daily, monthly and annual ones name dates in the file name. Years before 1678 are stored as 1981.
    """
    parts = F.split(F.col(key), "/")
    n = F.size(parts)
    file = F.element_at(parts, -1)
    level, variable = F.get(parts, F.lit(2)), F.get(parts, F.lit(3))
    period = level.isin("climatologies", "bioclim")
    tokens = F.split(F.regexp_replace(file, r"\.tif$", ""), "_")
    month_token = F.get(F.filter(tokens, lambda t: t.rlike("^(0[1-9]|1[0-2])$")), F.lit(0))
    year_text = F.regexp_extract(file, r"_(\d{4})(_|\.)", 1)
    year = F.when(year_text.try_cast("int") < 1678, F.lit(1981)).otherwise(year_text.try_cast("int"))
    day_text = F.regexp_extract(file, r"_(\d{2})_(\d{2})_(\d{4})", 1)
    daily_month = F.regexp_extract(file, r"_(\d{2})_(\d{2})_(\d{4})", 2)
    daily_year = F.regexp_extract(file, r"_(\d{2})_(\d{2})_(\d{4})", 3)
    month_year = F.regexp_extract(file, r"_(\d{2})_(\d{4})", 2)
    date = (
        F.when(level == "daily", F.try_to_date(F.concat_ws("-", daily_year, daily_month, day_text), "yyyy-MM-dd"))
        .when(level == "monthly", F.try_to_date(F.concat_ws("-", month_year, month_token, F.lit("01")), "yyyy-MM-dd"))
        .when(level == "annual", F.try_to_date(F.concat_ws("-", year.cast("string"), F.lit("01"), F.lit("01")), "yyyy-MM-dd"))
    )
    return df.select(
        "*", level.alias("level"), variable.alias("variable"), F.when(period, F.get(parts, F.lit(4))).alias("time_range"), F.when(period & (n > 7), F.get(parts, F.lit(5))).alias("model"),
        F.when(period & (n > 7), F.get(parts, F.lit(6))).alias("scenario"), F.when((level == "climatologies") | (level == "monthly"), month_token.cast("int")).alias("month"), date.alias("date"),
    )


def execution_plan(catalog: DataFrame, wanted: dict[str, list], start: str | None = None, end: tuple[int, int] | None = None, legacy_day28: bool = False) -> DataFrame:
    """Assets of a recipe: lists of members, and a date window for those that have dates."""
    found = catalog.where(members(wanted))
    if start and end:
        found = found.where(F.col("date").isNull() | window("date", start, *end, legacy_day28=legacy_day28))
    return found


def placed(catalog: DataFrame) -> DataFrame:
    """The catalog with ``place`` (from 1) in the order of level, variable, date and the rest, nulls last.

    Ranked inside each level; the levels' sizes are a table of a few rows.
    """
    keys = [F.asc("variable"), *[F.asc_nulls_last(k) for k in ("date", "time_range", "month", "model", "scenario")]]
    levels = catalog.groupBy(F.col("level").alias("l_")).agg(F.count("*").alias("n_"))
    before = levels.select("l_", (F.sum("n_").over(Window.orderBy("l_")) - F.col("n_")).alias("before_"))
    ranked = catalog.withColumn("r_", F.row_number().over(Window.partitionBy("level").orderBy(*keys)))
    return ranked.join(F.broadcast(before), F.col("level").eqNullSafe(F.col("l_"))).withColumn("place", F.col("r_") + F.col("before_")).drop("l_", "r_", "before_")


def cover_plan(catalog: DataFrame, wanted: dict[str, list], years: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """Land-cover layers of a recipe: lists of members (level, variable, aggregation, layer_class) and a range of years."""
    found = catalog.where(members(wanted))
    for low, end in ((True, years[0]), (False, years[1])):
        if end is not None:
            found = found.where(F.col("year") >= int(end) if low else F.col("year") <= int(end))
    return found


def cover_label(year: Column) -> Column:
    """The label of a land-cover layer: the first day of its year."""
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-01-01"))


def packed(variable: Column, aggregation: Column, layer_class: Column) -> Column:
    """variable__aggregation__class, without the parts that are null or empty."""
    return F.concat_ws("__", variable, F.nullif(aggregation, F.lit("")), F.nullif(layer_class, F.lit("")))


def z_label(level: Column, scenario: Column, model: Column, time_range: Column, month: Column, date: Column, row: Column) -> Column:
    """The label of a slice: a projection's parts, else its date, else the year's first day, else its number."""
    base = F.concat_ws("_", model, scenario, time_range)
    year = F.regexp_extract(F.coalesce(time_range, F.lit("")), r"((?:19|20)\d{2})", 1)
    return (
        F.when(level == "climatologies", F.concat_ws("_", base, F.lpad(month.cast("string"), 2, "0"))).when(level == "bioclim", base)
        .when(date.isNotNull(), F.date_format(date, "yyyy-MM-dd")).when(year != "", F.concat(year, F.lit("-01-01"))).otherwise(row.cast("string"))
    )


def climate_rule(variable: Column) -> Column:
    """The kernel for a climate variable: totals are averaged, everything unknown interpolated."""
    out = F.when(variable.isin("bio12", "bio13", "bio14"), "average").when(variable.startswith("bio"), "bilinear")
    for name, rule in CLIMATE_RULES.items():
        out = out.when(variable == name, rule)
    return out.otherwise("bilinear")


def cover_rule(aggregation: Column) -> Column:
    """The kernel for a land-cover layer: coverage averages, aggregates keep their own, classes stay as they are."""
    return F.when(aggregation == "coverage", "average").when(aggregation.isin("max", "min", "average", "rms"), aggregation).otherwise("nearest")


def year_of(name: Column) -> Column:
    return F.regexp_extract(name, r"((?:19|20)\d{2})", 1).try_cast("int")


def layer_suffix(name: Column, aggregation: Column) -> Column:
    """What follows the resolution (or the last underscore) in a file's name; null if that is the aggregation."""
    stem = F.regexp_replace(name, r"\.tif$", "")
    last = F.when(stem.contains("100m_"), F.element_at(F.split(stem, "100m_"), -1)).otherwise(F.element_at(F.split(stem, "_"), -1))
    return F.nullif(last, aggregation)


def normalised(name: Column) -> Column:
    """Blanks, slashes and hyphens as underscores, trimmed, in lower case."""
    return F.lower(F.translate(F.trim(name), " /-", "___"))


def metres_column(resolution: Column) -> Column:
    """'10m', '1km' in metres, anything else 999999."""
    text = F.lower(F.trim(resolution))
    return F.when(text.rlike(r"^\d+(\.\d+)?km$"), F.regexp_extract(text, r"^([\d.]+)km$", 1).try_cast("double") * 1000.0).when(text.rlike(r"^\d+(\.\d+)?m$"), F.regexp_extract(text, r"^([\d.]+)m$", 1).try_cast("double")).otherwise(999999.0)


def pick_resolutions(inventory: DataFrame, wanted: str, by: str = "category") -> DataFrame:
    """The resolution that each product gets: finest, coarsest, or the named one with the finest as fallback."""
    m = F.struct(metres_column(F.col("resolution")).alias("m"), F.col("resolution").alias("r"))
    finest, coarsest = F.min(m)["r"], F.max(m)["r"]
    named = F.max(F.when(F.col("resolution") == wanted, F.col("resolution")))
    pick = finest if wanted == "highest" else coarsest if wanted == "lowest" else F.coalesce(named, finest)
    return inventory.groupBy(by).agg(pick.alias("resolution"))


def unknown_products(requested: DataFrame, inventory: DataFrame, on: list[str]) -> DataFrame:
    """Requested rows that the inventory lacks."""
    return requested.join(inventory.select(*on).distinct(), on, "left_anti")


def combinations(*axes: DataFrame) -> DataFrame:
    """All combinations of small lists of options."""
    out = axes[0]
    for a in axes[1:]:
        out = out.crossJoin(a)
    return out


def first_of_each_year(inventory: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return inventory.withColumn("r_", F.row_number().over(Window.partitionBy(*keys, "year").orderBy(*order))).where("r_ = 1").drop("r_")


def usage_key(taxon_id: Column) -> Column:
    """What follows the last slash of an identifier."""
    return F.element_at(F.split(taxon_id, "/"), -1)


def species_names(df: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """Distinct trimmed names of lists."""
    return df.select(F.explode(F.split(column, separator)).alias("name")).select(F.trim("name").alias("name")).where("name <> ''").distinct()


def typed(value: Column) -> Column:
    """A whole number where the text is one, else null."""
    return F.when(value.rlike(r"^\d+$"), value.try_cast("long"))
