"""Input views of the queries, as DataFrames and as DuckDB text: occurrences, rasters and catalogs made of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.crs import Laea
from cellweave.operators.grids import Template, grid
from cellweave.operators.points import to_grid_crs

EEA = grid("EEA_1km")
#: The area of the occurrence view, and its template on the 1 km grid.
AREA = (3.0, 50.5, 5.01, 51.5)
TEMPLATE: Template = EEA.bounds_template(AREA)
ISSUES = ("ZERO_COORDINATE", "COORDINATE_ROUNDED", "COUNTRY_COORDINATE_MISMATCH")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each order."""
    k, c, d = F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), F.col("o_orderdate").cast("date")
    issue = F.when(k % 7 == 0, F.array(F.lit(ISSUES[0]))).when(k % 7 == 1, F.array(F.lit(ISSUES[1]), F.lit(ISSUES[2]))).when(k % 7 == 2, F.array(F.lit(ISSUES[1]))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").select(
        k.alias("src_uid"), (c % 97).alias("specieskey"), (c % 13).alias("genuskey"), (c % 211).alias("recordedby"), F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        (F.lit(3.0) + ((k * 7919) % 20011) / 10000.0 + 0.00003).alias("decimallongitude"), (F.lit(50.5) + ((k * 104729) % 9973) / 10000.0 + 0.00003).alias("decimallatitude"),
        F.when(k % 11 != 0, (50 + (k * 31) % 2500).cast("double")).alias("u"), F.when(F.col("o_orderstatus") == "F", "PRESENT").when(F.col("o_orderstatus") == "O", "ABSENT").otherwise("UNKNOWN").alias("occurrencestatus"),
        issue.alias("issue"), (k % 17 != 0).alias("hascoordinate"),
    )


OCC = """occ as (
  select o_orderkey::bigint as src_uid, (o_custkey % 97)::bigint as specieskey, (o_custkey % 13)::bigint as genuskey, (o_custkey % 211)::bigint as recordedby,
    year(o_orderdate::date)::int as year, month(o_orderdate::date)::int as month, day(o_orderdate::date)::int as day,
    3.0::double + ((o_orderkey::bigint * 7919) % 20011) / 10000.0::double + 0.00003::double as decimallongitude,
    50.5::double + ((o_orderkey::bigint * 104729) % 9973) / 10000.0::double + 0.00003::double as decimallatitude,
    case when o_orderkey % 11 <> 0 then (50 + (o_orderkey::bigint * 31) % 2500)::double end as u,
    case o_orderstatus when 'F' then 'PRESENT' when 'O' then 'ABSENT' else 'UNKNOWN' end as occurrencestatus,
    case o_orderkey % 7 when 0 then ['ZERO_COORDINATE'] when 1 then ['COORDINATE_ROUNDED', 'COUNTRY_COORDINATE_MISMATCH'] when 2 then ['COORDINATE_ROUNDED'] else []::varchar[] end as issue,
    o_orderkey % 17 <> 0 as hascoordinate
  from orders)"""


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences with x, y on the 1 km grid's CRS."""
    return to_grid_crs(occurrences(spark, sf_dir), EEA)


def laea_sql(lon: str, lat: str) -> tuple[str, str, str]:
    """DuckDB: an inner select list for beta and the difference of longitude, and x, y over them."""
    import math

    e, e2 = repr(Laea.e), repr(Laea.e**2)
    s = f"sin(radians({lat}))"
    q = f"((1 - {e2}::double) * ({s} / (1 - {e2}::double * {s} * {s}) - ln((1 - {e}::double * {s}) / (1 + {e}::double * {s})) / (2 * {e}::double)))"
    inner = f"asin({q} / {Laea.qp!r}::double) as beta_, radians({lon}) - {Laea.lon0!r}::double as dl_"
    s0, c0 = repr(math.sin(Laea.beta0)), repr(math.cos(Laea.beta0))
    b = f"({Laea.rq!r}::double * sqrt(2 / (1 + {s0}::double * sin(beta_) + {c0}::double * cos(beta_) * cos(dl_))))"
    return inner, f"{Laea.fe!r}::double + {b} * {Laea.d!r}::double * cos(beta_) * sin(dl_)", f"{Laea.fn!r}::double + {b} / {Laea.d!r}::double * ({c0}::double * sin(beta_) - {s0}::double * cos(beta_) * cos(dl_))"


_INNER, _X, _Y = laea_sql("decimallongitude", "decimallatitude")
PLACED = f"{OCC},\nplaced as (select * exclude (beta_, dl_), {_X} as x, {_Y} as y from (select *, {_INNER} from occ))"


def id_sql(t: Template, col: str, k: str) -> str:
    g = t.grid
    top = int((g.maxy - g.miny) / g.resolution - 0.5)
    return f"(({top} - ({k})) * {g.columns}::bigint + ({col}))::bigint"


def cell_sql(t: Template, x: str = "x", y: str = "y", method: str = "intersect") -> str:
    """DuckDB text of a point's cell."""
    g, r = t.grid, repr(t.grid.resolution)
    nudge = f" + {g.resolution * 1e-6!r}::double" if method == "home" else ""
    px, py = f"(({x}{nudge} - {g.minx!r}::double) / {r}::double)", f"(({y}{nudge} - {g.miny!r}::double) / {r}::double)"
    if method == "intersect":
        ids = id_sql(t, f"greatest(ceil({px})::bigint - 1, {t.c0})", f"least(floor({py})::bigint, {t.k1 - 1})")
        return f"case when {px} between {t.c0} and {t.c1} and {py} between {t.k0} and {t.k1} then {ids} end"
    return id_sql(t, f"least(greatest(floor({px})::bigint, {t.c0}), {t.c1 - 1})", f"least(greatest(floor({py})::bigint, {t.k0}), {t.k1 - 1})")


def box_sql(t: Template, cell: str = "grid_idx") -> dict[str, str]:
    g, r = t.grid, repr(t.grid.resolution)
    top = int((g.maxy - g.miny) / g.resolution - 0.5)
    x0 = f"({g.minx!r}::double + ({cell} % {g.columns}) * {r}::double)"
    y0 = f"({g.miny!r}::double + ({top} - {cell} // {g.columns}) * {r}::double)"
    return {"minx": x0, "miny": y0, "maxx": f"({x0} + {r}::double)", "maxy": f"({y0} + {r}::double)"}


MAPPED = f"{PLACED},\nmapped as (select *, {cell_sql(TEMPLATE)} as grid_idx from placed)"


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.operators.points import map_points

    return map_points(placed(spark, sf_dir), TEMPLATE)


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped occurrences with individual counts: order quantities, null for orders without lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("long").alias("src_uid")).agg(F.sum("l_quantity").cast("double").alias("individualcount"))
    return mapped(spark, sf_dir).join(lines, "src_uid", "left")


COUNTED = f"""{MAPPED},
lines as (select l_orderkey::bigint as src_uid, sum(l_quantity)::double as individualcount from lineitem group by 1),
counted as (select m.*, l.individualcount from mapped m left join lines l using (src_uid))"""


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster 64 pixels wide of classes (255: no data) and prices."""
    k = F.col("p_partkey").cast("long")
    return table(spark, sf_dir, "part").select(F.floor(k / 64).cast("long").alias("row"), (k % 64).alias("col"), F.when(k % 29 == 0, 255).otherwise(F.col("p_size") % 5).cast("int").alias("class"), F.col("p_retailprice").cast("double").alias("value"))


RASTER = """raster as (select (p_partkey // 64)::bigint as row, (p_partkey % 64)::bigint as col,
  (case when p_partkey % 29 = 0 then 255 else p_size % 5 end)::int as class, p_retailprice::double as value from part)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square around each occurrence, as wide as its uncertainty in both directions (at least 100 m)."""
    h = F.greatest(F.coalesce("u", F.lit(0.0)), F.lit(100.0))
    return placed(spark, sf_dir).select("src_uid", "specieskey", "x", "y", h.alias("h"), (F.col("x") - h).alias("minx"), (F.col("y") - h).alias("miny"), (F.col("x") + h).alias("maxx"), (F.col("y") + h).alias("maxy"), ((F.col("src_uid") % 10) + 1).cast("double").alias("value"))


_H = "greatest(coalesce(u, 0::double), 100::double)"
BOXES = f"{PLACED},\nboxes as (select src_uid, specieskey, x, y, {_H} as h, x - {_H} as minx, y - {_H} as miny, x + {_H} as maxx, y + {_H} as maxy, ((src_uid % 10) + 1)::double as value from placed)"


def shattered_sql(t: Template) -> str:
    """DuckDB: parts(boxes.*, grid_idx, areal_fraction)."""
    g, r = t.grid, repr(t.grid.resolution)
    place = lambda v, o, low, high: f"least(greatest(floor(({v} - {o!r}::double) / {r}::double)::bigint, {low}), {high - 1})"
    x0, y0 = f"({g.minx!r}::double + c_ * {r}::double)", f"({g.miny!r}::double + k_ * {r}::double)"
    part = f"greatest(least(maxx, {x0} + {r}::double) - greatest(minx, {x0}), 0::double) * greatest(least(maxy, {y0} + {r}::double) - greatest(miny, {y0}), 0::double) / ((maxx - minx) * (maxy - miny))"
    return f"""cand as (select *, unnest(range({place('miny', g.miny, t.k0, t.k1)}, {place('maxy', g.miny, t.k0, t.k1)} + 1)) as k_ from
  (select *, unnest(range({place('minx', g.minx, t.c0, t.c1)}, {place('maxx', g.minx, t.c0, t.c1)} + 1)) as c_ from boxes)),
parts as (select * from (select * exclude (c_, k_), {id_sql(t, 'c_', 'k_')} as grid_idx, {part} as areal_fraction from cand) where areal_fraction > 0.000001::double)"""


#: Object keys made of nations: a key of each level for each variable.
VARIABLES = ("tas", "pr", "bio01", "bio12")


def asset_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n"))
    v = F.explode(F.array(*[F.lit(x) for x in VARIABLES]))
    p2 = lambda c: F.lpad(c.cast("string"), 2, "0")
    month, day, year = F.col("n") % 12 + 1, F.col("n") + 1, F.col("n") + 1990
    kind = F.explode(F.array(*[F.lit(x) for x in ("climatologies", "bioclim", "daily", "monthly", "annual", "projected")]))
    rows = n.select("n", v.alias("v")).select("n", "v", kind.alias("kind"))
    name = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    var = F.col("v")
    return rows.select(
        F.when(F.col("kind") == "climatologies", name("store/global/climatologies/", var, "/1981-2010/file_", var, "_", p2(month), "_1981-2010_V.2.1.tif"))
        .when(F.col("kind") == "bioclim", name("store/global/bioclim/", var, "/1981-2010/file_", var, "_1981-2010_V.2.1.tif"))
        .when(F.col("kind") == "projected", name("store/global/bioclim/", var, "/2041-2070/MODEL-", (F.col("n") % 3).cast("string"), "/ssp", (F.col("n") % 2 + 1).cast("string"), "/file_", var, "_2041-2070.tif"))
        .when(F.col("kind") == "daily", name("store/global/daily/", var, "/", year.cast("string"), "/file_", var, "_", p2(day), "_", p2(month), "_", year.cast("string"), "_V.2.1.tif"))
        .when(F.col("kind") == "monthly", name("store/global/monthly/", var, "/", year.cast("string"), "/file_", var, "_", p2(month), "_", year.cast("string"), "_V.2.1.tif"))
        .otherwise(name("store/global/annual/", var, "/", year.cast("string"), "/file_", var, "_", year.cast("string"), "_V.2.1.tif")).alias("key")
    )
