"""Queries: resampling, classes, textures, focal kernels, indices, time series."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from cellweave.operators import raster as r
from cellweave.operators import texture
from cellweave.plans.views import MAPPED, RASTER, TEMPLATE, mapped, raster, table
from cellweave.registry import query

FACTOR = 8
_CLASS = "(select row, col, class::double as value from raster)"
_DUCK = {"average": "avg(v)", "sum": "sum(v)", "min": "min(v)", "max": "max(v)", "med": "quantile_cont(v, 0.5)", "q1": "quantile_cont(v, 0.25)", "q3": "quantile_cont(v, 0.75)", "rms": "sqrt(avg(v * v))"}


def _classes(spark, sf_dir):
    return raster(spark, sf_dir).select("row", "col", F.col("class").cast("double").alias("value"))


def _kernel(name: str, sql: str) -> None:
    @query(f"resample_{name}", f"with {RASTER}, p as (select row // {FACTOR} as row, col // {FACTOR} as col, case when class <> 255 then value end as v from raster) select row, col, round({sql}, 6) as value from p group by all")
    def run(spark, sf_dir, name=name):
        pixels = raster(spark, sf_dir).withColumn("value", F.when(F.col("class") == 255, -9999.0).otherwise(F.col("value")))
        return r.coarsen(pixels, FACTOR, name, nodata=-9999).withColumn("value", F.round("value", 6))


for _name, _sql in _DUCK.items():
    _kernel(_name, _sql)


@query("resample_mode", f"with {RASTER}, n as (select row // {FACTOR} as row, col // {FACTOR} as col, class::double as value, count(*) as n from raster where class <> 255 group by all) select row, col, value from n qualify row_number() over (partition by row, col order by n desc, value) = 1")
def resample_mode(spark, sf_dir):
    return r.coarsen(_classes(spark, sf_dir), FACTOR, "mode", nodata=255)


_TARGETS = "targets as (select o_orderkey::bigint as id, (o_orderkey % 97) * 0.37::double as r, (o_orderkey % 211) * 0.37::double + 2 as c from orders)"


def _targets(spark, sf_dir):
    k = F.col("o_orderkey").cast("long")
    return table(spark, sf_dir, "orders").select(k.alias("id"), ((k % 97) * 0.37).alias("r"), ((k % 211) * 0.37 + 2.0).alias("c"))


def _interpolated(n: int, first: str, weight) -> str:
    w = f"({weight('(r - row)')}) * ({weight('(c - col)')})"
    return f"""with {RASTER}, {_TARGETS}, near as (select id, r, c, ({first.format('r')} + i)::bigint as row, ({first.format('c')} + j)::bigint as col from targets, (select unnest(range(0, {n})) as i), (select unnest(range(0, {n})) as j)),
met as (select id, {w} as w, value as v from near join raster using (row, col)) select id, round(sum(w * v) / nullif(sum(w), 0), 6) as value from met group by all"""


def _weights(kernel: str):
    def w(t: str) -> str:
        a = f"abs({t})"
        return {
            "nearest": "1.0::double", "bilinear": f"greatest(1.0::double - {a}, 0)",
            "cubic": f"case when {a} <= 1 then 1.5::double * {a} * {a} * {a} - 2.5::double * {a} * {a} + 1 when {a} < 2 then -0.5::double * {a} * {a} * {a} + 2.5::double * {a} * {a} - 4 * {a} + 2 else 0 end",
            "cubicSpline": f"case when {a} <= 1 then 0.5::double * {a} * {a} * {a} - {a} * {a} + {2 / 3!r}::double when {a} < 2 then pow(2 - {a}, 3) / 6 else 0 end",
            "lanczos": f"case when {a} < 0.000000001 then 1 when {a} < 3 then 3 * sin({math.pi!r}::double * {a}) * sin({math.pi!r}::double * {a} / 3) / ({math.pi**2!r}::double * {a} * {a}) else 0 end",
        }[kernel]

    return w


def _interpolating(name: str, kernel: str, n: int) -> None:
    first = "floor({} + 0.5)" if n == 1 else "floor({}) - " + str(n // 2 - 1)

    @query(f"resample_{name}", _interpolated(n, first, _weights(kernel)))
    def run(spark, sf_dir, kernel=kernel):
        return r.interpolate(raster(spark, sf_dir), _targets(spark, sf_dir), kernel).withColumn("value", F.round("value", 6))


for _name, _k, _n in (("nearest", "nearest", 1), ("bilinear", "bilinear", 2), ("cubic", "cubic", 4), ("cubic_spline", "cubicSpline", 4), ("lanczos", "lanczos", 6)):
    _interpolating(_name, _k, _n)


@query("resample_to_grid", f"""with {MAPPED} select grid_idx, round(avg(coalesce(u, 1000)), 6) as value from mapped where grid_idx is not null group by all""")
def resample_to_grid(spark, sf_dir):
    pixels = mapped(spark, sf_dir).drop("grid_idx").withColumn("value", F.coalesce("u", F.lit(1000.0)))
    return r.to_cells(pixels, TEMPLATE, "x", "y", "average").withColumn("value", F.round("value", 6))


@query("class_fraction", f"with {RASTER} select row // {FACTOR} as row, col // {FACTOR} as col, round(avg((class = 2)::int) filter (where class <> 255), 6) as fraction from raster group by all")
def class_fraction(spark, sf_dir):
    return r.class_fraction(raster(spark, sf_dir), 2, FACTOR, 255, "class").withColumn("fraction", F.round("fraction", 6))


_NAMES = {0: "water", 1: "forest", 2: "grass", 3: "urban", 4: "bare"}


@query("class_fraction_pivot", f"with {RASTER} select row // {FACTOR} as row, col // {FACTOR} as col, {', '.join(f'round(avg((class = {c})::int) filter (where class not in (48, 128, 254, 255)), 6) as {n}' for c, n in _NAMES.items())} from raster group by all")
def class_fraction_pivot(spark, sf_dir):
    return r.class_fractions(raster(spark, sf_dir), _NAMES, FACTOR, value="class").select("row", "col", *[F.round(n, 6).alias(n) for n in _NAMES.values()])


@query("class_mask", f"with {RASTER} select row, col, case when class <> 255 then (class = 3)::int::double end as value from raster")
def class_mask(spark, sf_dir):
    return raster(spark, sf_dir).select("row", "col", F.when(F.col("class") != 255, (F.col("class") == 3).cast("double")).alias("value"))


@query("zonal_mean", f"with {RASTER}, zones as (select distinct row, col, (row + col) % 7 as zone from raster) select zone, round(avg(value), 6) as value, round(avg(class), 6) as class from raster join zones using (row, col) group by all")
def zonal_mean(spark, sf_dir):
    p = raster(spark, sf_dir)
    zones = p.select("row", "col").distinct().withColumn("zone", (F.col("row") + F.col("col")) % 7)
    return r.zonal_mean(p, zones, ["row", "col"], ["zone"], ["value", "class"]).select("zone", F.round("value", 6).alias("value"), F.round("class", 6).alias("class"))


@query("rasterize_add", f"""with {MAPPED}, cells as (select grid_idx, year, 1.0::double as n from mapped where grid_idx is not null), mesh as (select distinct grid_idx from mapped where grid_idx is not null),
years as (select distinct year from cells), sums as (select grid_idx, year, sum(n) as n from cells group by all) select m.grid_idx, y.year, coalesce(s.n, 0) as n from mesh m cross join years y left join sums s on s.grid_idx = m.grid_idx and s.year = y.year""")
def rasterize_add(spark, sf_dir):
    m = mapped(spark, sf_dir).where("grid_idx is not null")
    cells = m.select("grid_idx", "year", F.lit(1.0).alias("n"))
    return r.rasterize_add(cells, m.select("grid_idx").distinct(), "n", "year")


@query("raster_clip", f"with {RASTER} select row, col, value from raster where row between 3 and 9 and col between 10 and 19")
def raster_clip(spark, sf_dir):
    rows, cols = r.window_of((10.2, -9.5, 19.7, -3.1), 0.0, 0.0, 1.0)
    return r.clip(raster(spark, sf_dir), rows, cols).select("row", "col", "value")


@query("raster_integrity", f"with {RASTER} select count(*) as pixels, count(*) filter (where class <> 255) as valid, count(*) filter (where class <> 255) > 0 as usable from raster")
def raster_integrity(spark, sf_dir):
    return r.integrity(raster(spark, sf_dir).withColumn("value", F.when(F.col("class") == 255, float("nan")).otherwise(F.col("value"))))


@query("raster_stack", f"with {RASTER} select row, col, value, m::int as month from raster, (select unnest([1, 2, 3]) as m)")
def raster_stack(spark, sf_dir):
    p = raster(spark, sf_dir).select("row", "col", "value")
    return r.stack([p.withColumn("month", F.lit(m)) for m in (1, 2, 3)])


@query("band_merge", f"with {RASTER} select row, col, a.value as red, b.value as nir from (select * from raster where col < 40) a full outer join (select row, col, value * 2 as value from raster where col >= 30) b using (row, col)")
def band_merge(spark, sf_dir):
    p = raster(spark, sf_dir)
    return r.merge_bands(p.where("col < 40").select("row", "col", F.col("value").alias("red")), p.where("col >= 30").select("row", "col", (F.col("value") * 2).alias("nir")), ["row", "col"])


@query("raster_vector_join", f"with {MAPPED}, clim as (select grid_idx, avg(coalesce(u, 1000)) as tas from mapped where grid_idx is not null group by all), fact as (select grid_idx, count(*) as n from mapped where grid_idx is not null and month = 7 group by all) select grid_idx, n, round(tas, 6) as tas from fact join clim using (grid_idx)")
def raster_vector_join(spark, sf_dir):
    m = mapped(spark, sf_dir).where("grid_idx is not null")
    clim = m.groupBy("grid_idx").agg(F.avg(F.coalesce("u", F.lit(1000.0))).alias("tas"))
    return m.where("month = 7").groupBy("grid_idx").agg(F.count("*").alias("n")).join(clim, "grid_idx").select("grid_idx", "n", F.round("tas", 6).alias("tas"))


@query("block_entropy", f"""with {RASTER}, n as (select row // {FACTOR} as row, col // {FACTOR} as col, class, count(*) as n from raster where class <> 255 group by all), b as (select distinct row // {FACTOR} as row, col // {FACTOR} as col from raster),
t as (select *, n / sum(n) over (partition by row, col) as p from n) select b.row, b.col, round(-sum(p * log2(p)) + 0, 6) as entropy from b left join t using (row, col) group by all""")
def block_entropy(spark, sf_dir):
    return texture.block_entropy(raster(spark, sf_dir), FACTOR, 255, "class").withColumn("entropy", F.round("entropy", 6) + 0.0)


@query("glcm_homogeneity", f"with {RASTER} select a.row // {FACTOR} as row, a.col // {FACTOR} as col, round(avg(1.0::double / (1 + (a.class - b.class) * (a.class - b.class))), 6) as homogeneity from raster a join raster b on a.row = b.row and b.col = a.col + 1 where a.col // {FACTOR} = b.col // {FACTOR} group by all")
def glcm_homogeneity(spark, sf_dir):
    return texture.glcm_homogeneity(raster(spark, sf_dir), FACTOR, "class").withColumn("homogeneity", F.round("homogeneity", 6))


def _convolved(kernels: dict[str, np.ndarray], digits: int = 5) -> str:
    first = next(iter(kernels.values()))
    h, w = first.shape
    values = ", ".join("(" + ", ".join([str(i - h // 2), str(j - w // 2), *(f"{float(k[i, j])!r}::double" for k in kernels.values())]) + ")" for i in range(h) for j in range(w))
    cols = ", ".join(f"round(sum(t.value * k.{n}), {digits}) + 0 as {n}" for n in kernels)
    return f"with {RASTER}, k(dr, dc, {', '.join(kernels)}) as (values {values}) select p.row, p.col, {cols} from raster p, k, raster t where t.row = p.row + k.dr and t.col = p.col + k.dc group by all having count(*) = {h * w}"


_SOBEL = {"gx": texture.sobel_kernel(3), "gy": texture.sobel_kernel(3).T}
_LOG = {"v": texture.log_kernel(5)}


def _whole_windows(spark, sf_dir, kernels):
    out = texture.convolve(raster(spark, sf_dir), kernels)
    return out.select("row", "col", *[(F.round(n, 5) + 0.0).alias(n) for n in kernels])


@query("focal_sobel", _convolved(_SOBEL))
def focal_sobel(spark, sf_dir):
    return _whole_windows(spark, sf_dir, _SOBEL)


@query("focal_log", _convolved(_LOG))
def focal_log(spark, sf_dir):
    return _whole_windows(spark, sf_dir, _LOG)


@query("focal_sd", f"with {RASTER} select p.row, p.col, round(stddev_pop(t.value), 3) as sd from raster p join raster t on t.row between p.row - 1 and p.row + 1 and t.col between p.col - 1 and p.col + 1 group by all having count(*) = 9")
def focal_sd(spark, sf_dir):
    return texture.focal_sd(raster(spark, sf_dir)).withColumn("sd", F.round("sd", 3))


_SG = texture.savitzky_golay(7)
_GRAD = {"gx": _SG[0] / 30.0, "gy": -_SG[1] / 30.0}


@query("terrain_slope", f"select row, col, round(degrees(atan(sqrt(gx * gx + gy * gy))), 2) as slope from ({_convolved(_GRAD, 12)})")
def terrain_slope(spark, sf_dir):
    return texture.terrain(raster(spark, sf_dir), 30.0).select("row", "col", F.round("slope", 2).alias("slope"))


@query("ruggedness", f"with {RASTER} select row // {FACTOR} as row, col // {FACTOR} as col, round(stddev_pop(value), 4) as ruggedness from raster group by all")
def ruggedness(spark, sf_dir):
    by = [F.floor(F.col(c) / FACTOR).cast("long").alias(c) for c in ("row", "col")]
    return texture.ruggedness(raster(spark, sf_dir), by).withColumn("ruggedness", F.round("ruggedness", 4))


_BANDS = ("blue", "green", "red", "re1", "re2", "re3", "nir", "swir1", "swir2")


def _band(i: int) -> str:
    return f"((p_partkey * {7 + 2 * i} + p_size * {i + 3}) % 400) / 500.0::double + {0.02 + 0.01 * i!r}::double"


_INDEX = {
    "ndvi": "(nir - red) / nullif(nir + red, 0)", "evi": "2.5::double * (nir - red) / nullif(nir + 6 * red - 7.5::double * blue + 1, 0)",
    "msavi": "(2 * nir + 1 - sqrt(greatest(pow(2 * nir + 1, 2) - 8 * (nir - red), 0))) / 2", "ndre": "(nir - re1) / nullif(nir + re1, 0)", "reip": "700 + 40 * ((red + re3) / 2 - re1) / nullif(re2 - re1, 0)",
    "ari": "1 / green - 1 / re1", "cri": "1 / blue - 1 / green", "mari": "(1 / green - 1 / re1) * nir", "mcri": "(1 / blue - 1 / re1) * nir", "ndwi": "(green - nir) / nullif(green + nir, 0)",
    "ndmi": "(nir - swir1) / nullif(nir + swir1, 0)", "nbr": "(nir - swir2) / nullif(nir + swir2, 0)", "fpar": "least(greatest(1.24::double * ((nir - red) / nullif(nir + red, 0)) - 0.168::double, 0), 1)",
    "ndli": "(ln(1 / swir1) - ln(1 / swir2)) / nullif(ln(1 / swir1) + ln(1 / swir2), 0)",
}


@query("spectral_indices", f"with b as (select p_partkey::bigint as id, {', '.join(f'{_band(i)} as {n}' for i, n in enumerate(_BANDS))} from part) select id, {', '.join(f'case when abs({e}) < 1000 then round({e}, 9) + 0 end as {n}' for n, e in _INDEX.items())} from b")
def spectral_indices(spark, sf_dir):
    k, s = F.col("p_partkey").cast("long"), F.col("p_size").cast("long")
    bands = table(spark, sf_dir, "part").select(k.alias("id"), *[(((k * (7 + 2 * i) + s * (i + 3)) % 400) / 500.0 + (0.02 + 0.01 * i)).alias(n) for i, n in enumerate(_BANDS)])
    found = texture.spectral_indices({n: F.col(n) for n in _BANDS})
    return bands.select("id", *[F.when(F.abs(v) < 1000, F.round(v, 9) + 0.0).alias(n) for n, v in found.items()])


@query("cloud_mask", "select p_partkey::bigint as id, case when p_size % 12 in (4, 5, 6) and p_size / 100.0::double >= 0.01::double then p_size / 100.0::double end as value from part")
def cloud_mask(spark, sf_dir):
    v = F.col("p_size") / 100.0
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"), texture.cloud_free(F.col("p_size") % 12, texture.bright_enough(v)).alias("value"))


@query("temporal_max", "select user_id::bigint as user_id, date_trunc('month', ts)::date as month, round(max(value), 6) as value from events group by all")
def temporal_max(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("long").alias("user_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    return r.temporal_max(e, ["user_id"], "ts", "value").withColumn("value", F.round("value", 6))


_SERIES = "s as (select p_partkey % 200 as id, (p_partkey // 200)::bigint as t, case when p_size % 3 <> 0 then p_retailprice::double end as value from part)"


@query("gap_fill", f"""with {_SERIES}, w as (select *, last_value(value ignore nulls) over b as v0, first_value(value ignore nulls) over a as v1, last_value(case when value is not null then t end ignore nulls) over b as t0, first_value(case when value is not null then t end ignore nulls) over a as t1
from s window b as (partition by id order by t rows between unbounded preceding and current row), a as (partition by id order by t rows between current row and unbounded following))
select id, t, round(coalesce(value, v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0)), 5) as value from w""")
def gap_fill(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    s = table(spark, sf_dir, "part").select((k % 200).alias("id"), F.floor(k / 200).cast("long").alias("t"), F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice").cast("double")).alias("value"))
    return r.gap_fill(s, ["id"], "t", "value").select("id", "t", F.round("value", 5).alias("value"))
