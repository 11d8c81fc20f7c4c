"""Queries: uncertainty clouds, boxes, polygons, cell codes, quality."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cellweave.operators import boxes as areas
from cellweave.operators import cellcodes, clouds, points, quality
from cellweave.operators.grids import grid
from cellweave.plans.points_and_cubes import SMALL
from cellweave.plans.views import AREA, BOXES, EEA, MAPPED, OCC, PLACED, TEMPLATE, boxes, cell_sql, id_sql, mapped, occurrences, placed, shattered_sql, table
from cellweave.registry import query

PASSES = 8


def _draw(axis: str, seed: int = 42) -> str:
    return f"((('0x' || substr(md5(concat_ws('|', src_uid, p, '{axis}', '{seed}')), 1, 8))::bigint + 0.5::double) / 4294967296::double)"


_DRAWS = f"draws as (select src_uid, x as x0, y as y0, greatest(coalesce(u, 0), 0::double) as u0, unnest(range(0, {PASSES})) as p from placed)"
_UNIFORM = f"""{PLACED}, {_DRAWS},
cloud as (select src_uid, p, x0 + r * cos(t) as x, y0 + r * sin(t) as y from (select *, u0 * sqrt({_draw('a')}) as r, {_draw('b')} * {2 * math.pi!r}::double as t from draws))"""
_GAUSS = f"""{PLACED}, {_DRAWS},
cloud as (select src_uid, p, x0 + sqrt(-2 * ln(a)) * cos(b * {2 * math.pi!r}::double) * u0 / 3 as x, y0 + sqrt(-2 * ln(a)) * sin(b * {2 * math.pi!r}::double) * u0 / 3 as y from (select *, {_draw('a')} as a, {_draw('b')} as b from draws))"""
_COUNTS = f"counts as (select src_uid, grid_idx, count(*) as n from (select src_uid, {cell_sql(TEMPLATE)} as grid_idx from cloud) where grid_idx is not null group by all)"


def _cloud(spark, sf_dir, distribution):
    return clouds.cloud(placed(spark, sf_dir), PASSES, distribution)


@query("cloud_uniform_points", f"with {_UNIFORM} select src_uid, p as pass, round(x, 4) as x, round(y, 4) as y, {1 / PASSES!r}::double as weight_per_point from cloud")
def cloud_uniform_points(spark, sf_dir):
    return _cloud(spark, sf_dir, "uniform").select("src_uid", F.col("pass").cast("long").alias("pass"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "weight_per_point")


@query("cloud_fractional", f"with {_GAUSS}, {_COUNTS} select src_uid, grid_idx, n / {float(PASSES)!r}::double as fraction from counts")
def cloud_fractional(spark, sf_dir):
    found = clouds.map_cloud(placed(spark, sf_dir).select("src_uid", "x", "y", "u"), TEMPLATE, passes=PASSES, distribution="gaussian")
    return found.where("grid_idx is not null").select("src_uid", "grid_idx", "fraction")


@query("cloud_fractional_attrs", f"with {_UNIFORM}, {_COUNTS} select o.src_uid, c.grid_idx, c.n / {float(PASSES)!r}::double as fraction, {cell_sql(TEMPLATE, 'o.x', 'o.y')} as src_grid_idx, o.specieskey from placed o left join counts c using (src_uid)")
def cloud_fractional_attrs(spark, sf_dir):
    return clouds.map_cloud(placed(spark, sf_dir), TEMPLATE, "fractional", passes=PASSES).select("src_uid", "grid_idx", "fraction", "src_grid_idx", "specieskey")


@query("cloud_classify", f"with {_GAUSS}, {_COUNTS} select o.src_uid, b.grid_idx from placed o left join (select * from counts qualify row_number() over (partition by src_uid order by n desc, grid_idx) = 1) b using (src_uid)")
def cloud_classify(spark, sf_dir):
    return clouds.map_cloud(placed(spark, sf_dir), TEMPLATE, "classification", passes=PASSES, distribution="gaussian").select("src_uid", "grid_idx")


@query("cloud_centroid", f"with {_GAUSS}, c as (select src_uid, avg(x) as x, avg(y) as y from cloud group by all) select src_uid, {cell_sql(TEMPLATE, method='home')} as grid_idx from c")
def cloud_centroid(spark, sf_dir):
    return clouds.classify_centroid(_cloud(spark, sf_dir, "gaussian"), TEMPLATE)


@query("cloud_mass", f"with {_UNIFORM}, {_COUNTS} select src_uid, round(sum(n / {float(PASSES)!r}::double), 9) as mass from counts group by all")
def cloud_mass(spark, sf_dir):
    return clouds.fractional(_cloud(spark, sf_dir, "uniform"), TEMPLATE, PASSES).groupBy("src_uid").agg(F.round(F.sum("fraction"), 9).alias("mass"))


@query("cloud_degrees", f"""with {OCC}, placed as (select *, decimallongitude as x, decimallatitude as y from occ), {_DRAWS}
select src_uid, p as pass, round(((x0 + r * cos(t) / (cos(radians(y0)) * 111320::double) + 180) % 360) - 180, 9) as x, round(y0 + r * sin(t) / 111320::double, 9) as y
from (select *, u0 * sqrt({_draw('a')}) as r, {_draw('b')} * {2 * math.pi!r}::double as t from draws)""")
def cloud_degrees(spark, sf_dir):
    c = clouds.cloud(occurrences(spark, sf_dir), PASSES, x="decimallongitude", y="decimallatitude", geographic=True)
    return c.select("src_uid", F.col("pass").cast("long").alias("pass"), F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


# --- boxes and polygons --------------------------------------------------------------------------------------


@query("box_fractional", f"with {BOXES}, {shattered_sql(TEMPLATE)} select src_uid, grid_idx, round(areal_fraction, 7) as areal_fraction from parts")
def box_fractional(spark, sf_dir):
    return areas.shatter_boxes(boxes(spark, sf_dir), TEMPLATE).select("src_uid", "grid_idx", F.round("areal_fraction", 7).alias("areal_fraction"))


@query("box_mass", f"with {BOXES}, {shattered_sql(SMALL)} select src_uid, round(sum(areal_fraction), 5) as mass from parts group by all")
def box_mass(spark, sf_dir):
    return areas.shatter_boxes(boxes(spark, sf_dir), SMALL).groupBy("src_uid").agg(F.round(F.sum("areal_fraction"), 5).alias("mass"))


WIDE = EEA.bounds_template((2.9, 50.4, 5.1, 51.6))
COARSE = grid("EEA_10km").bounds_template(AREA)


@query("boxes_areal_weighting", f"with {BOXES}, {shattered_sql(TEMPLATE)} select grid_idx, round(sum(value * areal_fraction), 4) as value from parts group by all")
def boxes_areal_weighting(spark, sf_dir):
    return areas.transform_cells(boxes(spark, sf_dir), TEMPLATE, "value").select("grid_idx", F.round("value", 4).alias("value"))


@query("boxes_majority", f"with {BOXES}, {shattered_sql(TEMPLATE)}, best as (select * from parts qualify row_number() over (partition by src_uid order by round(areal_fraction, 9) desc, grid_idx) = 1) select grid_idx, specieskey, sum(value) as value from best group by all")
def boxes_majority(spark, sf_dir):
    return areas.transform_cells(boxes(spark, sf_dir), TEMPLATE, "value", "discrete", keep=["specieskey"])


@query("boxes_kdtree", f"with {BOXES} select {cell_sql(COARSE, '((minx + maxx) / 2)', '((miny + maxy) / 2)', 'nearest')} as grid_idx, specieskey, sum(value) as value from boxes group by all")
def boxes_kdtree(spark, sf_dir):
    return areas.transform_cells(boxes(spark, sf_dir), COARSE, "value", "discrete", "kdtree", ["specieskey"])


def _west_and_south(x: str, y: str) -> str:
    """DuckDB: the area that an edge (x0, y0) - (x1, y1) adds to that of its polygon west of x and south of y."""
    k = "case when x1 <> x0 then (y1 - y0) / (x1 - x0) else 0 end"
    a, b = f"least(x0, {x})", f"least(x1, {x})"
    ya, yb = f"(y0 + ({a} - x0) * ({k}))", f"(y0 + ({b} - x0) * ({k}))"
    low, high = f"least({ya}, {yb})", f"greatest({ya}, {yb})"
    part = f"(({y} - {low}) / ({high} - {low}))"
    return f"(({b} - {a}) * case when {high} <= {y} then ({low} + {high}) / 2 when {low} >= {y} then {y} else {part} * ({low} + {y}) / 2 + (1 - {part}) * {y} end)"


_G, _RES = TEMPLATE.grid, repr(TEMPLATE.grid.resolution)
_STEP = 2 * math.pi / 32
#: Cells of 32-corner polygons around the points, by sums over edges at the four corners of each candidate cell.
_POLYGONS = f"""boxes as (select src_uid, x, y, u, x - u as minx, y - u as miny, x + u as maxx, y + u as maxy from placed where u > 0),
cand as (select *, {_G.minx!r}::double + c_ * {_RES}::double - x as west, {_G.miny!r}::double + k_ * {_RES}::double - y as south from (select *, unnest(range(floor((miny - {_G.miny!r}::double) / {_RES}::double)::bigint, floor((maxy - {_G.miny!r}::double) / {_RES}::double)::bigint + 1)) as k_ from
  (select *, unnest(range(floor((minx - {_G.minx!r}::double) / {_RES}::double)::bigint, floor((maxx - {_G.minx!r}::double) / {_RES}::double)::bigint + 1)) as c_ from boxes)) where c_ between {TEMPLATE.c0} and {TEMPLATE.c1 - 1} and k_ between {TEMPLATE.k0} and {TEMPLATE.k1 - 1}),
edges as (select i, cos(i * {_STEP!r}::double) as cx0, sin(i * {_STEP!r}::double) as cy0, cos((i + 1) % 32 * {_STEP!r}::double) as cx1, sin((i + 1) % 32 * {_STEP!r}::double) as cy1 from (select unnest(range(0, 32)) as i)),
pairs as (select src_uid, x, y, u, c_, k_, west, south, west + {_RES}::double as east, south + {_RES}::double as north, u * cx0 as x0, u * cy0 as y0, u * cx1 as x1, u * cy1 as y1 from cand, edges),
cut as (select src_uid, any_value(x) as x, any_value(y) as y, any_value(u) as u, c_, k_, abs(sum({_west_and_south('east', 'north')} - {_west_and_south('west', 'north')} - {_west_and_south('east', 'south')} + {_west_and_south('west', 'south')})) as area from pairs group by src_uid, c_, k_)"""


@query("polygon_fractional", f"""with {PLACED}, {_POLYGONS}
select src_uid, {id_sql(TEMPLATE, 'c_', 'k_')} as grid_idx, round(area / (16 * u * u * sin({_STEP!r}::double)), 6) as areal_fraction, {cell_sql(TEMPLATE, method='home')} as centroid_grid_idx from cut where area / (16 * u * u * sin({_STEP!r}::double)) > 0.000001""")
def polygon_fractional(spark, sf_dir):
    """32-corner polygons around the points, cut by the cells."""
    ringed = areas.buffer_rings(placed(spark, sf_dir).where("u > 0"))
    out = areas.shatter_rings(ringed, TEMPLATE)
    return out.select("src_uid", "grid_idx", F.round("areal_fraction", 6).alias("areal_fraction"), "centroid_grid_idx")


@query("polygon_mass", f"with {PLACED} select src_uid, 1.0::double as mass from placed where u > 0")
def polygon_mass(spark, sf_dir):
    """All cells cut out of a polygon add up to it."""
    return areas.shatter_rings(areas.buffer_rings(placed(spark, sf_dir).where("u > 0")), WIDE).groupBy("src_uid").agg(F.round(F.sum("areal_fraction"), 3).alias("mass"))


@query("polygon_cells_of_squares", f"with {BOXES}, {shattered_sql(TEMPLATE)} select src_uid, grid_idx, round(areal_fraction, 6) as areal_fraction from parts")
def polygon_cells_of_squares(spark, sf_dir):
    """The polygon cutter on squares, which SQL can cut too."""
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ringed = boxes(spark, sf_dir).withColumn("ring", F.array(p("minx", "miny"), p("maxx", "miny"), p("maxx", "maxy"), p("minx", "maxy")))
    return areas.shatter_rings(ringed, TEMPLATE, centroid=False).select("src_uid", "grid_idx", F.round("areal_fraction", 6).alias("areal_fraction"))


@query("buffer_area", f"with {PLACED} select src_uid, round(16 * u * u * sin({2 * math.pi / 32!r}::double), 0) as area from placed where u > 0")
def buffer_area(spark, sf_dir):
    ringed = areas.buffer_rings(placed(spark, sf_dir).where("u > 0").withColumns({"x": F.col("x") - 3800000, "y": F.col("y") - 3000000}))
    return ringed.select("src_uid", F.round(areas.shoelace(F.col("ring")), 0).alias("area"))


@query("utm_buffers")
def utm_buffers(spark, sf_dir):
    """Buffers drawn in UTM, in degrees again; tests hold corner distances against the radius."""
    rows = occurrences(spark, sf_dir).select("src_uid", "decimallongitude", "decimallatitude", "u")
    ringed = areas.geographic_rings(rows, "decimallongitude", "decimallatitude", "u")
    first = F.element_at("ring", 1)
    return ringed.select("src_uid", F.size("ring").alias("corners"), F.round(first["x"], 7).alias("lon0"), F.round(first["y"], 7).alias("lat0"))


_RING = [(3.2, 50.7), (4.4, 50.6), (4.8, 51.1), (3.9, 51.4), (3.1, 51.2)]


def _crossing_sql() -> str:
    tests = [f"((({y0}::double > decimallatitude) <> ({y1}::double > decimallatitude)) and decimallongitude < (decimallatitude - {y0}::double) * {(x1 - x0) / (y1 - y0)!r}::double + {x0}::double)::int" for (x0, y0), (x1, y1) in zip(_RING, _RING[1:] + _RING[:1])]
    return f"({' + '.join(tests)}) % 2 = 1"


@query("points_in_polygon", f"with {OCC} select src_uid from occ where {_crossing_sql()}")
def points_in_polygon(spark, sf_dir):
    from cellweave.operators.filters import in_bounds

    rows = occurrences(spark, sf_dir).where(in_bounds((3.1, 50.6, 4.8, 51.4), "decimallongitude", "decimallatitude"))
    return rows.where(areas.in_ring(F.col("decimallongitude"), F.col("decimallatitude"), _RING)).select("src_uid")


# --- cell codes ----------------------------------------------------------------------------------------------


@query("cellcode_encode", f"with {PLACED} select src_uid, concat('1kmE', floor(x / 1000::double)::bigint, 'N', floor(y / 1000::double)::bigint) as eea, concat('CRS3035RES1000mN', floor(y / 1000::double)::bigint * 1000, 'E', floor(x / 1000::double)::bigint * 1000) as stat, concat('250mE', floor(x / 250::double)::bigint * 25, 'N', floor(y / 250::double)::bigint * 25) as fine from placed")
def cellcode_encode(spark, sf_dir):
    lon, lat = F.col("decimallongitude"), F.col("decimallatitude")
    return occurrences(spark, sf_dir).select("src_uid", cellcodes.eea_code(lon, lat).alias("eea"), cellcodes.eurostat_code(lon, lat).alias("stat"), cellcodes.eea_code(lon, lat, 250).alias("fine"))


def _dms(v: str, positive: str, negative: str, digits: int, s: int) -> str:
    c = f"(floor({v} * 3600.0::double / {s})::bigint * {s})"
    return f"concat(case when {c} >= 0 then '{positive}' else '{negative}' end, lpad((abs({c}) // 3600)::varchar, {digits}, '0'), '-', lpad((abs({c}) % 3600 // 60)::varchar, 2, '0'), '-', lpad((abs({c}) % 60)::varchar, 2, '0'))"


_SHIFTED = "(select src_uid, decimallongitude - 4.0::double as lon, decimallatitude - 51.0::double as lat from occ)"


@query("cellcode_dmsg", f"with {OCC} select src_uid, concat({_dms('lon', 'E', 'W', 3, 30)}, {_dms('lat', 'N', 'S', 2, 30)}) as code from {_SHIFTED}")
def cellcode_dmsg(spark, sf_dir):
    return occurrences(spark, sf_dir).select("src_uid", cellcodes.dmsg_code(F.col("decimallongitude") - 4.0, F.col("decimallatitude") - 51.0, 30).alias("code"))


def _letter(i: int) -> str:
    e, n = f"floor((lon - floor(lon)) * {2**i}.0::double)::bigint % 2 = 1", f"floor((lat - floor(lat)) * {2**i}.0::double)::bigint % 2 = 1"
    return f"case when {n} and not ({e}) then 'A' when {n} then 'B' when not ({e}) then 'C' else 'D' end"


@query("cellcode_eqdg", f"with {OCC} select src_uid, concat(case when lon >= 0 then 'E' else 'W' end, lpad(abs(case when lon >= 0 then floor(lon) else floor(lon) + 1 end)::bigint::varchar, 3, '0'), case when lat >= 0 then 'N' else 'S' end, lpad(abs(case when lat >= 0 then floor(lat) else floor(lat) + 1 end)::bigint::varchar, 2, '0'), {_letter(1)}, {_letter(2)}) as code from {_SHIFTED}")
def cellcode_eqdg(spark, sf_dir):
    return occurrences(spark, sf_dir).select("src_uid", cellcodes.eqdg_code(F.col("decimallongitude") - 4.0, F.col("decimallatitude") - 51.0, 2).alias("code"))


def _codes(spark, sf_dir):
    k = F.col("src_uid")
    code = F.when(k % 53 == 0, F.concat(F.lit("W17"), k.cast("string"))).when(k % 3 == 0, F.concat(F.lit("crs3035res1000mN"), (k % 900 * 1000).cast("string"), F.lit("E"), (k % 700 * 1000).cast("string"))).when(k % 3 == 1, F.concat(F.lit("10kmE"), (k % 500).cast("string"), F.lit("N"), (k % 400).cast("string"))).otherwise(F.concat(F.lit("250mE"), (k % 90000).cast("string"), F.lit("N"), (k % 80000).cast("string")))
    return occurrences(spark, sf_dir).select("src_uid", code.alias("code"))


_CODES = f"{OCC}, codes as (select src_uid, case when src_uid % 53 = 0 then concat('W17', src_uid) when src_uid % 3 = 0 then concat('crs3035res1000mN', src_uid % 900 * 1000, 'E', src_uid % 700 * 1000) when src_uid % 3 = 1 then concat('10kmE', src_uid % 500, 'N', src_uid % 400) else concat('250mE', src_uid % 90000, 'N', src_uid % 80000) end as code from occ)"


@query("cellcode_parse", f"""with {_CODES}, p as (select src_uid, code, src_uid as k from codes) select src_uid,
case when k % 53 = 0 then null when k % 3 = 0 then k % 700 * 1000 when k % 3 = 1 then k % 500 * 10000 else k % 90000 * 10 end::double as minx, case when k % 53 = 0 then null when k % 3 = 0 then k % 900 * 1000 when k % 3 = 1 then k % 400 * 10000 else k % 80000 * 10 end::double as miny,
case when k % 53 = 0 then null when k % 3 = 0 then 1000 when k % 3 = 1 then 10000 else 250 end::double as size from p""")
def cellcode_parse(spark, sf_dir):
    b = _codes(spark, sf_dir).select("src_uid", cellcodes.parse_box(F.col("code")).alias("b"))
    return b.select("src_uid", "b.minx", "b.miny", (F.col("b.maxx") - F.col("b.minx")).alias("size"))


@query("cellcode_strict", "select n_nationkey::bigint as k, (n_nationkey * 1000)::double as minx, (n_nationkey * 1000 + 1000)::double as maxx from nation")
def cellcode_strict(spark, sf_dir):
    n = F.col("n_nationkey").cast("long")
    b = cellcodes.parse_box(F.concat(F.lit("1kmE"), n.cast("string"), F.lit("N7")), strict=True)
    return table(spark, sf_dir, "nation").select(n.alias("k"), b["minx"].alias("minx"), b["maxx"].alias("maxx"))


@query("crs_mining", f"with {_CODES}, f as (select src_uid % 7 as g, arg_min(upper(code), src_uid) as c from codes where src_uid % 53 <> 0 or src_uid % 7 = 3 group by 1) select g, case when c like 'CRS3035%' then 3035 when c like 'CRS4326%' then 4326 when c like '%ME%' then 3035 when regexp_matches(c, '^[WE].*[SN]') then 4326 else 4326 end as epsg from f")
def crs_mining(spark, sf_dir):
    rows = _codes(spark, sf_dir).withColumn("g", F.col("src_uid") % 7).where((F.col("src_uid") % 53 != 0) | (F.col("g") == 3))
    first = rows.groupBy("g").agg(F.min_by("code", "src_uid").alias("code"))
    return first.groupBy("g").agg(cellcodes.mine_crs(F.col("code")).alias("epsg"))


# --- quality -------------------------------------------------------------------------------------------------

_B = SMALL.bounds
_D = f"case when least(x - {_B[0]!r}, {_B[2]!r} - x, y - {_B[1]!r}, {_B[3]!r} - y) >= 0 then least(x - {_B[0]!r}, {_B[2]!r} - x, y - {_B[1]!r}, {_B[3]!r} - y) else sqrt(pow(greatest({_B[0]!r} - x, x - {_B[2]!r}, 0), 2) + pow(greatest({_B[1]!r} - y, y - {_B[3]!r}, 0), 2)) end"
_ZONE = f"case when x between {_B[0]!r} and {_B[2]!r} and y between {_B[1]!r} and {_B[3]!r} and {_D} > coalesce(u, 1000) then 'Interior' when {_D} <= coalesce(u, 1000) then 'Boundary' else 'Exterior' end"


@query("qa_zone", f"with {PLACED} select src_uid, {_ZONE} as zone from placed")
def qa_zone(spark, sf_dir):
    return placed(spark, sf_dir).select("src_uid", quality.zone(F.col("x"), F.col("y"), F.col("u"), _B).alias("zone"))


_MASS = f"with {BOXES}, {shattered_sql(SMALL)}, m as (select src_uid, sum(areal_fraction) as mass from parts group by 1), z as (select b.src_uid, b.h, b.x, b.y, coalesce(m.mass, 0) as mass, {_ZONE.replace('coalesce(u, 1000)', 'h')} as zone from boxes b left join m using (src_uid))"


def _mass(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("zone", quality.zone(F.col("x"), F.col("y"), F.col("h"), _B))
    return quality.masses(b, areas.shatter_boxes(b, SMALL).select("src_uid", "grid_idx", "areal_fraction"), "areal_fraction")


@query("qa_mass", f"{_MASS} select zone, count(*) as n, count(*) filter (where abs(mass - 1) <= 0.01 + 0.00001) as whole, count(*) filter (where mass = 0) as none_ from z group by all")
def qa_mass(spark, sf_dir):
    return _mass(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("n"), F.count_if(quality.close(F.col("mass"), 1.0, 0.01)).alias("whole"), F.count_if(F.col("mass") == 0).alias("none_"))


@query("qa_mass_failures", f"{_MASS} select src_uid, round(mass, 5) as mass from z where zone = 'Interior' and abs(mass - 1) > 0.01 + 0.00001")
def qa_mass_failures(spark, sf_dir):
    return quality.interior_failures(_mass(spark, sf_dir)).select("src_uid", F.round("mass", 5).alias("mass"))


@query("qa_boundary", f"""{_MASS}, e as (select *, greatest(least(x + h, {_B[2]!r}) - greatest(x - h, {_B[0]!r}), 0) * greatest(least(y + h, {_B[3]!r}) - greatest(y - h, {_B[1]!r}), 0) / (4 * h * h) as expected from z where zone = 'Boundary')
select count(*) as n, count(*) filter (where abs(mass - expected) > 0.02 + 0.00001 * abs(expected)) as failures from e""")
def qa_boundary(spark, sf_dir):
    m = _mass(spark, sf_dir)
    bad = quality.boundary_failures(m, _B, u="h").agg(F.count("*").alias("failures"))
    return m.where("zone = 'Boundary'").agg(F.count("*").alias("n")).crossJoin(bad)


@query("qa_drift", f"""with {MAPPED}, d as (select src_uid, u, sqrt(pow(x - (2000000::double + (grid_idx % 4000) * 1000 + 500), 2) + pow(y - (1000000::double + (4499 - grid_idx // 4000) * 1000 + 500), 2)) as d from mapped where grid_idx is not null)
select src_uid, round(d, 3) as drift, d <= coalesce(u, 1000) + sqrt(2) * 1000 as drift_ok from d""")
def qa_drift(spark, sf_dir):
    return quality.drift(mapped(spark, sf_dir).where("grid_idx is not null"), EEA).select("src_uid", F.round("drift", 3).alias("drift"), "drift_ok")


@query("qa_layer_physics", """with l as (select p_partkey, (p_size % 50) / 40.0::double - 0.05::double as f_a, (p_partkey % 10) / 12.0::double as f_b, p_size::double as min, (p_size + p_partkey % 3)::double as avg, (p_size + 1)::double as rms, (p_size + 2)::double as max from part)
select (count(*) filter (where f_a < -0.000001) + count(*) filter (where f_b < -0.000001))::bigint as below_zero, (count(*) filter (where f_a > 1.000001) + count(*) filter (where f_b > 1.000001))::bigint as above_one, count(*) filter (where f_a + f_b > 1.000001) as sum_above_one,
count(*) filter (where min > avg + 0.000001) as min_above_avg, count(*) filter (where avg > rms + 0.000001) as avg_above_rms, count(*) filter (where rms > max + 0.000001) as rms_above_max from l""")
def qa_layer_physics(spark, sf_dir):
    s, k = F.col("p_size"), F.col("p_partkey")
    d = lambda c: c.cast("double")
    layers = table(spark, sf_dir, "part").select(((s % 50) / 40.0 - 0.05).alias("f_a"), ((k % 10) / 12.0).alias("f_b"), d(s).alias("min"), d(s + k % 3).alias("avg"), d(s + 1).alias("rms"), d(s + 2).alias("max"))
    return quality.layer_checks(layers)
