"""Queries: points on the grid, cube aggregation, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import crs
from cellweave.operators import aggregate, filters, grids, points, temporal
from cellweave.plans.views import AREA, BOXES, COUNTED, EEA, MAPPED, OCC, PLACED, TEMPLATE, box_sql, boxes, cell_sql, counted, id_sql, mapped, occurrences, placed, table
from cellweave.registry import query

B = TEMPLATE.bounds


def r6(c: str):
    return F.round(c, 6).alias(c)


@query("points_to_grid", f"with {MAPPED} select src_uid, grid_idx from mapped")
def points_to_grid(spark, sf_dir):
    return mapped(spark, sf_dir).select("src_uid", "grid_idx")


SMALL = EEA.template((3850000.0, 3060000.0, 3900000.0, 3110000.0))


@query("points_kdtree", f"with {PLACED} select src_uid, {cell_sql(SMALL, method='nearest')} as grid_idx from placed")
def points_kdtree(spark, sf_dir):
    return points.map_points(placed(spark, sf_dir), SMALL, "kdtree").select("src_uid", "grid_idx")


@query("points_outside_null", f"with {PLACED} select src_uid, {cell_sql(SMALL)} as grid_idx from placed")
def points_outside_null(spark, sf_dir):
    return points.map_points(placed(spark, sf_dir), SMALL).select("src_uid", "grid_idx")


@query("home_cell", f"with {PLACED} select src_uid, {cell_sql(TEMPLATE, method='home')} as grid_idx from placed")
def home_cell(spark, sf_dir):
    return points.map_points(placed(spark, sf_dir), TEMPLATE, "home").select("src_uid", "grid_idx")


#: Points on lattice lines and corners, by order key.
_EDGE_X, _EDGE_Y = "(3800000 + (o_orderkey % 200) * 500)::double", "(3000000 + (o_orderkey % 90) * 500)::double"
EDGE_T = EEA.template((3800000.0, 3000000.0, 3880000.0, 3040000.0))


def _edges(spark, sf_dir):
    k = F.col("o_orderkey").cast("long")
    return table(spark, sf_dir, "orders").select(k.alias("src_uid"), (3800000 + (k % 200) * 500).cast("double").alias("x"), (3000000 + (k % 90) * 500).cast("double").alias("y"))


@query("points_tie_break", f"with e as (select o_orderkey::bigint as src_uid, {_EDGE_X} as x, {_EDGE_Y} as y from orders) select src_uid, {cell_sql(EDGE_T)} as west_north, {cell_sql(EDGE_T, method='nearest')} as nearest, {cell_sql(EDGE_T, method='home')} as home from e")
def points_tie_break(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    return _edges(spark, sf_dir).select("src_uid", EDGE_T.intersect(x, y).alias("west_north"), EDGE_T.nearest(x, y).alias("nearest"), EDGE_T.home(x, y).alias("home"))


@query("global_index", f"with {PLACED} select src_uid, (floor(({EEA.maxy!r}::double - y) / 1000.0::double)::bigint * 4000 + floor((x - {EEA.minx!r}::double) / 1000.0::double)::bigint) as grid_idx from placed")
def global_index(spark, sf_dir):
    return placed(spark, sf_dir).select("src_uid", EEA.index(F.col("x"), F.col("y")).alias("grid_idx"))


@query("grid_inverse", f"with {MAPPED}, ids as (select distinct grid_idx from mapped where grid_idx is not null) select grid_idx, {', '.join(f'{v} as {k}' for k, v in box_sql(TEMPLATE).items())} from ids")
def grid_inverse(spark, sf_dir):
    return aggregate.dimension_table(mapped(spark, sf_dir), EEA)


@query("grid_mesh", f"select {id_sql(EDGE_T, 'c', 'k')} as grid_idx, 2000000.0::double + c * 1000.0::double + 500.0::double as x, 1000000.0::double + k * 1000.0::double + 500.0::double as y from (select unnest(range({EDGE_T.c0}, {EDGE_T.c1})) as c), (select unnest(range({EDGE_T.k0}, {EDGE_T.k1})) as k)")
def grid_mesh(spark, sf_dir):
    return EDGE_T.cells(spark).select("grid_idx", "x", "y")


_REG = ", ".join(f"('{g.key}', 'EPSG:{g.epsg}', {g.resolution!r}::double, {g.minx!r}::double, {g.miny!r}::double, {g.maxx!r}::double, {g.maxy!r}::double)" for g in grids.registry().values())


@query("grid_registry", f"select * from (values {_REG}) as t(grid_key, crs, resolution, minx, miny, maxx, maxy)")
def grid_registry(spark, sf_dir):
    return grids.registry_table(spark)


@query("map_cell_collection", f"with {BOXES} select src_uid, (floor(({EEA.maxy!r}::double - (miny + maxy) / 2) / 1000.0::double)::bigint * 4000 + floor(((minx + maxx) / 2 - {EEA.minx!r}::double) / 1000.0::double)::bigint) as grid_idx from boxes")
def map_cell_collection(spark, sf_dir):
    return points.map_cells(boxes(spark, sf_dir), EEA, "minx", "miny", "maxx", "maxy").select("src_uid", "grid_idx")


@query("project_laea", f"with {PLACED} select src_uid, round(x, 4) as x, round(y, 4) as y from placed")
def project_laea(spark, sf_dir):
    return placed(spark, sf_dir).select("src_uid", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


_E = crs.Cea.e
_S = "sin(radians(decimallatitude))"
_QS = f"((1 - {_E**2!r}::double) * ({_S} / (1 - {_E**2!r}::double * {_S} * {_S}) - ln((1 - {_E!r}::double * {_S}) / (1 + {_E!r}::double * {_S})) / (2 * {_E!r}::double)))"


@query("project_equal_area", f"with {OCC} select src_uid, round({crs.A!r}::double * {crs.Cea.k0!r}::double * radians(decimallongitude), 4) as x, round({crs.A!r}::double * {_QS} / (2 * {crs.Cea.k0!r}::double), 4) as y from occ")
def project_equal_area(spark, sf_dir):
    x, y = crs.project(F.col("decimallongitude"), F.col("decimallatitude"), 6933)
    return occurrences(spark, sf_dir).select("src_uid", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("utm_zone", f"with {OCC} select src_uid, (least(greatest(floor((decimallongitude + 180.0::double) / 6.0::double) + 1, 1), 60) + case when decimallatitude >= 0 then 32600 else 32700 end)::int as epsg from occ")
def utm_zone(spark, sf_dir):
    return occurrences(spark, sf_dir).select("src_uid", crs.utm_epsg(F.col("decimallongitude"), F.col("decimallatitude")).cast("int").alias("epsg"))


@query("longitude_wrap", "select o_orderkey::bigint as src_uid, ((o_orderkey * 37 % 1000 + 180) % 360 - 180)::double as lon from orders")
def longitude_wrap(spark, sf_dir):
    k = F.col("o_orderkey").cast("long")
    return table(spark, sf_dir, "orders").select(k.alias("src_uid"), crs.wrap_longitude((k * 37 % 1000).cast("double")).alias("lon"))


@query("degree_scaling", f"with {OCC} select src_uid, round(coalesce(u, 0) / (cos(radians(decimallatitude)) * 111320.0::double), 9) as dlon, round(coalesce(u, 0) / 111320.0::double, 9) as dlat from occ")
def degree_scaling(spark, sf_dir):
    u = F.coalesce("u", F.lit(0.0))
    return occurrences(spark, sf_dir).select("src_uid", F.round(crs.degrees_east(u, F.col("decimallatitude")), 9).alias("dlon"), F.round(crs.degrees_north(u), 9).alias("dlat"))


@query("total_bounds", f"with {PLACED} select round(min(x), 3) as minx, round(min(y), 3) as miny, round(max(x), 3) as maxx, round(max(y), 3) as maxy from placed")
def total_bounds(spark, sf_dir):
    return grids.total_bounds(placed(spark, sf_dir)).select(*[F.round(c, 3).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("sanitize_points", "select distinct (p_size % 50)::double as x, (p_partkey % 40)::double as y from part where p_partkey % 5 <> 0")
def sanitize_points(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    x = F.when(k % 5 != 0, (F.col("p_size") % 50).cast("double")).otherwise(F.when(k % 2 == 0, float("nan")))
    return points.sanitize_points(table(spark, sf_dir, "part").select(x.alias("x"), (k % 40).cast("double").alias("y")), deduplicate=True)


@query("validate_points", "select count(*) as n, count(*) filter (where p_partkey % 5 = 0 and p_partkey % 2 <> 0) as missing, count(*) filter (where p_partkey % 10 = 0) as not_a_number from part")
def validate_points(spark, sf_dir):
    k = F.col("p_partkey").cast("long")
    x = F.when(k % 5 != 0, F.lit(1.0)).otherwise(F.when(k % 2 == 0, float("nan")))
    return points.check_points(table(spark, sf_dir, "part").select(x.alias("x"), F.lit(2.0).alias("y")), "x", "y")


_FB = crs.fetch_envelope((3.5, 50.8, 4.0, 51.0), 4326, 4326)


@query("bbox_scan", f"with {OCC} select src_uid, specieskey from occ where decimallongitude between {_FB[0]!r}::double and {_FB[2]!r}::double and decimallatitude between {_FB[1]!r}::double and {_FB[3]!r}::double")
def bbox_scan(spark, sf_dir):
    return filters.scan_bounds(occurrences(spark, sf_dir), (3.5, 50.8, 4.0, 51.0), 4326, "decimallongitude", "decimallatitude").select("src_uid", "specieskey")


@query("cell_wkt", f"""with {MAPPED}, ids as (select distinct grid_idx from mapped where grid_idx is not null), b as (select grid_idx, {', '.join(f'{v}::bigint as {k}' for k, v in box_sql(TEMPLATE).items())} from ids)
select grid_idx, concat('POLYGON ((', maxx, ' ', miny, ', ', maxx, ' ', maxy, ', ', minx, ' ', maxy, ', ', minx, ' ', miny, ', ', maxx, ' ', miny, '))') as wkt from b""")
def cell_wkt(spark, sf_dir):
    d = aggregate.dimension_table(mapped(spark, sf_dir), EEA)
    return d.select("grid_idx", grids.box_wkt(*[F.col(c).cast("long") for c in ("minx", "miny", "maxx", "maxy")]).alias("wkt"))


@query("grid_size_metres", "select n_nationkey::int as level, round(111320.0::double / pow(2, n_nationkey), 6) as eqdg, round(n_nationkey * 111320.0::double / 3600, 6) as dmsg from nation")
def grid_size_metres(spark, sf_dir):
    n = F.col("n_nationkey").cast("int")
    cases = lambda kind: F.round(F.coalesce(*[F.when(n == i, F.lit(grids.grid_size_metres(kind, i))) for i in range(25)]), 6)
    return table(spark, sf_dir, "nation").select(n.alias("level"), cases("EQDG").alias("eqdg"), cases("DMSG").alias("dmsg"))


# --- cubes ---------------------------------------------------------------------------------------------------


@query("cube_monthly_richness", f"""with {MAPPED} select grid_idx, year, month, count(*) as occurrences, count(distinct specieskey) as species, count(distinct recordedby) as observers
from mapped where grid_idx is not null and year between 1995 and 2001 and coalesce(u, 1000) <= 2500 group by all""")
def cube_monthly_richness(spark, sf_dir):
    rows = mapped(spark, sf_dir).where(filters.year_month((1995, 2001)) & filters.max_uncertainty(2500, "u")).where("grid_idx is not null")
    spec = [{"column": "src_uid", "method": "size", "rename": "occurrences"}, {"column": "specieskey", "rename": "species"}, {"column": "recordedby", "method": "nunique", "rename": "observers"}]
    return aggregate.aggregate_cube(rows, ["year", "month"], spec)


@query("cube_expected_occurrences", f"with {COUNTED} select grid_idx, year, round(coalesce(sum(individualcount), 0), 6) as individualcount_sum from counted where grid_idx is not null group by all")
def cube_expected_occurrences(spark, sf_dir):
    rows = counted(spark, sf_dir).where("grid_idx is not null")
    return aggregate.aggregate_cube(rows, ["year", "not_there"], [{"column": "individualcount", "method": "sum"}, {"column": "nothing", "method": "sum"}]).select("grid_idx", "year", F.round("individualcount_sum", 6).alias("individualcount_sum"))


@query("cube_species_richness", f"with {MAPPED} select grid_idx, count(distinct specieskey) as species from mapped where grid_idx is not null group by all")
def cube_species_richness(spark, sf_dir):
    return aggregate.aggregate_cube(mapped(spark, sf_dir).where("grid_idx is not null"), [], [{"column": "specieskey", "method": "nunique", "rename": "species"}])


@query("cube_observers", f"with {MAPPED} select year, month, count(*) as occurrences, count(distinct recordedby) as distinct_observers from mapped group by all")
def cube_observers(spark, sf_dir):
    return mapped(spark, sf_dir).groupBy("year", "month").agg(F.count("*").alias("occurrences"), F.countDistinct("recordedby").alias("distinct_observers"))


def _halves(spark, sf_dir):
    return counted(spark, sf_dir).where("grid_idx is not null").withColumn("fraction", F.when(F.col("src_uid") % 2 == 0, 0.25).otherwise(0.75)).withColumn("tag", F.when(F.col("src_uid") % 3 == 0, F.col("individualcount").cast("string")).when(F.col("src_uid") % 3 == 1, "many"))


_HALVES = f"{COUNTED}, halves as (select *, case when src_uid % 2 = 0 then 0.25::double else 0.75::double end as fraction, case src_uid % 3 when 0 then individualcount::varchar when 1 then 'many' end as tag from counted where grid_idx is not null)"


@query("cube_weighted_sum", f"with {_HALVES} select grid_idx, round(sum(fraction * coalesce(try_cast(tag as double), 1.0::double)), 6) as expected from halves group by all")
def cube_weighted_sum(spark, sf_dir):
    return aggregate.aggregate_cube(_halves(spark, sf_dir), [], [{"column": "tag", "method": "sum", "weighted": True, "rename": "expected"}]).select("grid_idx", r6("expected"))


@query("cube_weighted_mean", f"with {_HALVES} select grid_idx, round(avg(fraction * coalesce(try_cast(tag as double), 0.0::double)), 6) as tag_mean from halves group by all")
def cube_weighted_mean(spark, sf_dir):
    return aggregate.aggregate_cube(_halves(spark, sf_dir), [], [{"column": "tag", "method": "mean", "weighted": True}]).select("grid_idx", r6("tag_mean"))


@query("cube_stats", f"""with {COUNTED} select specieskey, round(avg(individualcount), 6) as m, round(min(individualcount), 6) as lo, round(max(individualcount), 6) as hi, count(individualcount) as n, round(median(individualcount), 6) as mid,
round(stddev_samp(individualcount), 6) as sd, round(var_samp(individualcount), 4) as var from counted group by all""")
def cube_stats(spark, sf_dir):
    spec = [{"column": "individualcount", "method": m, "rename": n} for m, n in (("mean", "m"), ("min", "lo"), ("max", "hi"), ("count", "n"), ("median", "mid"), ("std", "sd"), ("var", "var"))]
    return aggregate.aggregate_cube(counted(spark, sf_dir), [], spec, cell="specieskey").select("specieskey", "n", r6("m"), r6("lo"), r6("hi"), r6("mid"), r6("sd"), F.round("var", 4).alias("var"))


@query("cube_null_groups", f"with {PLACED}, m as (select *, {cell_sql(SMALL)} as grid_idx from placed) select grid_idx, count(distinct specieskey) as specieskey_nunique, coalesce(sum(case when u is null then null else 1::bigint end), 0)::bigint as known from m group by all")
def cube_null_groups(spark, sf_dir):
    rows = points.map_points(placed(spark, sf_dir), SMALL).withColumn("k", F.when(F.col("u").isNotNull(), F.lit(1).cast("long")))
    return aggregate.aggregate_cube(rows, [], [{"column": "specieskey"}, {"column": "k", "method": "sum", "rename": "known"}])


@query("api_cube_sql", f"""with {COUNTED} select specieskey, year, concat('1kmE', floor(x / 1000.0::double)::bigint, 'N', floor(y / 1000.0::double)::bigint) as cellcode, round(sum(coalesce(individualcount, 1)), 6) as total, count(distinct recordedby) as observers
from counted where occurrencestatus in ('PRESENT') and hascoordinate group by all""")
def api_cube_sql(spark, sf_dir):
    from cellweave.operators.cellcodes import eea_code_of

    rows = filters.request(counted(spark, sf_dir), {"record_type": "presence"})
    spec = [{"column": "individualcount", "method": "sum", "rename": "total"}, {"column": "recordedby", "method": "nunique", "rename": "observers"}]
    out = aggregate.cube_sql(rows, ["specieskey", "year"], eea_code_of(F.col("x"), F.col("y")), spec)
    return out.withColumn("total", F.round("total", 6))


@query("api_cube_counts", f"with {PLACED} select month, concat('10kmE', floor(x / 10000.0::double)::bigint, 'N', floor(y / 10000.0::double)::bigint) as cellcode, count(*) as absences from placed where hascoordinate and occurrencestatus in ('ABSENT') group by all")
def api_cube_counts(spark, sf_dir):
    from cellweave.operators.cellcodes import eea_code_of

    rows = filters.request(placed(spark, sf_dir), {"record_type": "absence"})
    return aggregate.cube_sql(rows, ["month"], eea_code_of(F.col("x"), F.col("y"), 10000), record="absences")


@query("sparse_cube", f"with {COUNTED} select specieskey, year, round(sum(individualcount), 6) as individualcount from counted where u is not null and grid_idx is not null group by all")
def sparse_cube(spark, sf_dir):
    rows = counted(spark, sf_dir).where("grid_idx is not null").withColumn("year", F.when(F.col("u").isNotNull(), F.col("year")))
    return aggregate.sparse_cube(rows, ["specieskey", "year"], "individualcount").select("specieskey", "year", r6("individualcount"))


@query("temporal_extent", f"with {OCC} select min(make_date(year, month, 1)) as start, last_day(max(make_date(year, month, 1))) as \"end\" from occ")
def temporal_extent(spark, sf_dir):
    return temporal.extent(occurrences(spark, sf_dir))


@query("star_join", f"""with {MAPPED}, fact as (select grid_idx, year, count(*) as n from mapped where grid_idx is not null group by all)
select year, {box_sql(TEMPLATE)['minx']} as minx, sum(n)::bigint as n from fact group by all""")
def star_join(spark, sf_dir):
    fact = mapped(spark, sf_dir).where("grid_idx is not null").groupBy("grid_idx", "year").agg(F.count("*").alias("n"))
    return fact.join(aggregate.dimension_table(fact, EEA), "grid_idx").groupBy("year", "minx").agg(F.sum("n").alias("n"))


@query("rank_per_cell", f"with {MAPPED}, n as (select grid_idx, specieskey, count(*) as n from mapped where grid_idx is not null group by all) select grid_idx, specieskey, n from n qualify row_number() over (partition by grid_idx order by n desc, specieskey) = 1")
def rank_per_cell(spark, sf_dir):
    from cellweave.operators.clouds import first_per_source

    n = mapped(spark, sf_dir).where("grid_idx is not null").groupBy("grid_idx", "specieskey").agg(F.count("*").alias("n"))
    return first_per_source(n, [F.col("n").desc(), F.col("specieskey")], "grid_idx")


@query("late_attribute_join", f"with {MAPPED} select src_uid, grid_idx, specieskey, year from mapped")
def late_attribute_join(spark, sf_dir):
    narrow = mapped(spark, sf_dir).select("src_uid", "grid_idx")
    return occurrences(spark, sf_dir).join(narrow, "src_uid", "left").select("src_uid", "grid_idx", "specieskey", "year")


@query("event_windows", "select date_trunc('day', ts) as start, (user_id % 50)::bigint as grid_idx, count(*) as occurrences from events group by all")
def event_windows(spark, sf_dir):
    from cellweave.streaming.cubes import windowed_counts

    cells = grids.Grid("g", 3035, 1.0, 0.0, 0.0, 50.0, 1.0)
    ev = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), ((F.col("user_id") % 50) + 0.5).alias("x"), F.lit(0.5).alias("y"))
    return windowed_counts(ev, cells.template((0.0, 0.0, 50.0, 1.0))).withColumn("start", F.col("start").cast("timestamp_ntz"))
