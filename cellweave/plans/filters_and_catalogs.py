"""Queries: request filters, dates, catalogs, inventories, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cellweave.operators import catalog, filters, grids, raster, temporal
from cellweave.plans.views import OCC, VARIABLES, asset_keys, occurrences, table
from cellweave.registry import query


@query("filter_year_month", f"with {OCC} select src_uid from occ where year between 1996 and 1998 and month = 5")
def filter_year_month(spark, sf_dir):
    return occurrences(spark, sf_dir).where(filters.year_month((1996, 1998), (5, 5))).select("src_uid")


@query("filter_membership", f"with {OCC} select src_uid from occ where specieskey in (1, 2, 3) and month in (4, 6)")
def filter_membership(spark, sf_dir):
    return occurrences(spark, sf_dir).where(filters.members({"specieskey": [1, 2, 3], "month": [4, 6], "year": []})).select("src_uid")


@query("filter_uncertainty", f"with {OCC} select src_uid, coalesce(u, 1000) as u from occ where coalesce(u, 1000) <= 927")
def filter_uncertainty(spark, sf_dir):
    auto = filters.max_uncertainty("auto", "u", grid_type="DMSG", resolution=30)
    return occurrences(spark, sf_dir).where(auto).select("src_uid", F.coalesce("u", F.lit(1000.0)).alias("u"))


@query("filter_issues", f"with {OCC} select src_uid from occ where not list_contains(issue, 'ZERO_COORDINATE') and not list_contains(issue, 'COUNTRY_COORDINATE_MISMATCH') and hascoordinate")
def filter_issues(spark, sf_dir):
    return filters.request(occurrences(spark, sf_dir), {"issues": filters.BAD_ISSUES}).select("src_uid")


@query("filter_status", f"with {OCC} select occurrencestatus, count(*) as n from occ where occurrencestatus in ('PRESENT', 'ABSENT') group by all")
def filter_status(spark, sf_dir):
    return occurrences(spark, sf_dir).where(filters.status_of("frequency")).groupBy("occurrencestatus").agg(F.count("*").alias("n"))


@query("filter_taxa", f"with {OCC} select src_uid, specieskey, genuskey from occ where specieskey in (5, 8) or genuskey in (3)")
def filter_taxa(spark, sf_dir):
    return occurrences(spark, sf_dir).where(filters.taxa({"species": [5, 8], "genus": [3], "family": []})).select("src_uid", "specieskey", "genuskey")


@query("filter_taxa_backbone", f"with {OCC} select src_uid from occ where specieskey in (5, 8)")
def filter_taxa_backbone(spark, sf_dir):
    nested = F.create_map(F.lit("list-1"), F.create_map(F.lit("specieskey"), F.col("specieskey").cast("string")))
    return occurrences(spark, sf_dir).withColumn("classificationdetails", nested).where(filters.taxa({"species": [5, 8]}, "list-1")).select("src_uid")


@query("filter_time_present", "select o_orderkey::bigint as src_uid from orders where o_orderkey % 5 <> 0")
def filter_time_present(spark, sf_dir):
    rows = occurrences(spark, sf_dir).withColumn("year", F.when(F.col("src_uid") % 5 != 0, F.col("year"))).drop("hascoordinate")
    return filters.request(rows, {"require": ["year", "month"]}).select("src_uid")


@query("occurrence_request", f"""with {OCC} select src_uid, specieskey, year, month, coalesce(u, 1000) as coordinateuncertaintyinmeters from occ where hascoordinate and year between 1996 and 2000 and decimallongitude between 3.2 and 4.5
and decimallatitude between 50.6 and 51.2 and occurrencestatus = 'PRESENT' and not list_contains(issue, 'ZERO_COORDINATE') and coalesce(u, 1000) <= 2000 and (specieskey in (1, 2, 3, 4, 5, 6, 7, 8, 9) or genuskey in (1, 2))""")
def occurrence_request(spark, sf_dir):
    rows = occurrences(spark, sf_dir).withColumnRenamed("u", "coordinateuncertaintyinmeters")
    found = filters.request(rows, {"years": (1996, 2000), "bounds": (3.2, 50.6, 4.5, 51.2), "record_type": "presence", "issues": ["ZERO_COORDINATE"], "max_uncertainty": 2000, "taxa": {"species": list(range(1, 10)), "genus": [1, 2]}})
    return found.select("src_uid", "specieskey", "year", "month", F.coalesce("coordinateuncertaintyinmeters", F.lit(1000.0)).alias("coordinateuncertaintyinmeters"))


@query("rank_slice", f"with {OCC} select distinct genuskey, specieskey from occ")
def rank_slice(spark, sf_dir):
    return occurrences(spark, sf_dir).select(*filters.rank_slice("genus")).distinct()


@query("rename_columns", f"with {OCC} select src_uid as \"SRC_UID\", specieskey as \"speciesKey\" from occ")
def rename_columns(spark, sf_dir):
    return filters.align_case(occurrences(spark, sf_dir), ["SRC_UID", "speciesKey"]).select("SRC_UID", "speciesKey")


def _matches(spark, sf_dir):
    n = F.col("c_custkey").cast("long")
    kinds = F.array(*[F.lit(k) for k in ("EXACT", "FUZZY", "VARIANT", "HIGHERRANK", "NONE")])
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.when(n % 23 != 0, F.get(kinds, (n % 5).cast("int"))).alias("matchtype"), (n % 300).alias("usagekey"), F.when(n % 2 == 0, "SPECIES").otherwise("GENUS").alias("rank"))


_MATCHES = "m as (select c_name as name, case when c_custkey % 23 <> 0 then ['EXACT', 'FUZZY', 'VARIANT', 'HIGHERRANK', 'NONE'][c_custkey % 5 + 1] end as matchtype, (c_custkey % 300)::bigint as usagekey, case when c_custkey % 2 = 0 then 'SPECIES' else 'GENUS' end as rank from customer)"


@query("taxon_match_split", f"with {_MATCHES} select name, coalesce(matchtype in ('EXACT', 'HIGHERRANK'), false) as valid from m")
def taxon_match_split(spark, sf_dir):
    good, bad = filters.split_matches(_matches(spark, sf_dir), higher_ok=True)
    return good.select("name", F.lit(True).alias("valid")).unionByName(bad.select("name", F.lit(False).alias("valid")))


@query("taxon_keys_by_rank", f"with {_MATCHES} select lower(rank) as rank, count(distinct usagekey) as n, min(usagekey) as first_key from m where matchtype = 'EXACT' group by all")
def taxon_keys_by_rank(spark, sf_dir):
    keys = filters.keys_by_rank(filters.split_matches(_matches(spark, sf_dir))[0])
    return keys.select("rank", F.size("keys").cast("long").alias("n"), F.element_at("keys", 1).alias("first_key"))


@query("taxon_lookup", f"with {_MATCHES}, {OCC} select o.src_uid, b.rank from occ o left join (select usagekey, min(rank) as rank from m group by 1) b on o.specieskey = b.usagekey")
def taxon_lookup(spark, sf_dir):
    backbone = _matches(spark, sf_dir).groupBy("usagekey").agg(F.min("rank").alias("rank"))
    o = occurrences(spark, sf_dir)
    return o.join(backbone, o.specieskey == backbone.usagekey, "left").select("src_uid", "rank")


@query("usage_keys", "select distinct (c_custkey % 300)::varchar as usagekey from customer")
def usage_keys(spark, sf_dir):
    ids = F.concat(F.lit("urn/taxa/"), (F.col("c_custkey") % 300).cast("string"))
    return table(spark, sf_dir, "customer").select(catalog.usage_key(ids).alias("usagekey")).distinct()


@query("species_names", "select distinct 'Name ' || (c_custkey % 40)::varchar as name from customer union select distinct 'Other ' || (c_custkey % 7)::varchar from customer")
def species_names(spark, sf_dir):
    k = F.col("c_custkey")
    lists = F.concat(F.lit(" Name "), (k % 40).cast("string"), F.lit(" ,Other "), (k % 7).cast("string"), F.lit(", "))
    return catalog.species_names(table(spark, sf_dir, "customer").select(lists.alias("l")), "l")


@query("numeric_typing", "select c_custkey::bigint as k, case when c_custkey % 3 = 0 then c_custkey::bigint end as value from customer")
def numeric_typing(spark, sf_dir):
    k = F.col("c_custkey").cast("long")
    text = F.when(k % 3 == 0, k.cast("string")).otherwise(F.concat(F.lit("x"), k.cast("string")))
    return table(spark, sf_dir, "customer").select(k.alias("k"), catalog.typed(text).alias("value"))


@query("cf_datetime", f"with {OCC} select src_uid, case when src_uid % 9 = 0 then null when src_uid % 10 = 0 then null else make_date(year, month, day) end as datetime from occ")
def cf_datetime(spark, sf_dir):
    rows = occurrences(spark, sf_dir).withColumn("month", F.when(F.col("src_uid") % 9 != 0, F.col("month"))).withColumn("day", F.when(F.col("src_uid") % 10 == 0, 32).otherwise(F.col("day")))
    return temporal.cf_datetime(rows).select("src_uid", "datetime")


@query("cf_datetime_month", f"with {OCC} select src_uid, make_date(year, month, 1) as datetime from occ")
def cf_datetime_month(spark, sf_dir):
    return temporal.cf_datetime(occurrences(spark, sf_dir).drop("day")).select("src_uid", "datetime")


@query("sha256_texts", "select n_nationkey::bigint as k, sha256(n_name) as sha256 from nation")
def sha256_texts(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.sha2("n_name", 256).alias("sha256"))


# --- catalogs ------------------------------------------------------------------------------------------------

_PAD = lambda e: f"lpad(({e})::varchar, 2, '0')"
_KEYS = f"""axes as (select n_nationkey as n, v, kind from nation, (select unnest({list(VARIABLES)}) as v), (select unnest(['climatologies', 'bioclim', 'daily', 'monthly', 'annual', 'projected']) as kind)),
parsed as (select
  case kind when 'projected' then 'bioclim' else kind end as level, v as variable, case kind when 'climatologies' then '1981-2010' when 'bioclim' then '1981-2010' when 'projected' then '2041-2070' end as time_range,
  case kind when 'projected' then concat('MODEL-', n % 3) end as model, case kind when 'projected' then concat('ssp', n % 2 + 1) end as scenario, case when kind in ('climatologies', 'monthly') then (n % 12 + 1)::int end as month,
  case kind when 'daily' then case when n % 12 + 1 = 2 and n + 1 > 28 then null else make_date((n + 1990)::bigint, (n % 12 + 1)::bigint, (n + 1)::bigint) end when 'monthly' then make_date((n + 1990)::bigint, (n % 12 + 1)::bigint, 1) when 'annual' then make_date((n + 1990)::bigint, 1, 1) end as date
  from axes)"""


@query("catalog_key_parse", f"with {_KEYS} select * from parsed")
def catalog_key_parse(spark, sf_dir):
    return catalog.parse_keys(asset_keys(spark, sf_dir)).drop("key")


@query("execution_plan", f"with {_KEYS} select * from parsed where level in ('bioclim', 'daily', 'monthly') and variable in ('tas', 'bio01') and (date is null or date between date '1992-01-01' and date '2005-06-30')")
def execution_plan(spark, sf_dir):
    c = catalog.parse_keys(asset_keys(spark, sf_dir)).drop("key")
    return catalog.execution_plan(c, {"level": ["bioclim", "daily", "monthly"], "variable": ["tas", "bio01"], "scenario": []}, "1992-01-01", (2005, 6))


@query("execution_plan_day28", f"with {_KEYS} select * from parsed where date between date '1990-01-01' and date '2014-01-28'")
def execution_plan_day28(spark, sf_dir):
    c = catalog.parse_keys(asset_keys(spark, sf_dir)).drop("key").where("date is not null")
    return catalog.execution_plan(c, {}, "1990-01-01", (2014, 1), legacy_day28=True)


@query("catalog_sorted", f"with {_KEYS} select level, variable, date, time_range, row_number() over (order by level, variable, date nulls last, time_range nulls last, month nulls last, model nulls last, scenario nulls last) as place from parsed")
def catalog_sorted(spark, sf_dir):
    return catalog.placed(catalog.parse_keys(asset_keys(spark, sf_dir))).select("level", "variable", "date", "time_range", "place")


@query("z_labels", f"""with {_KEYS} select level, variable, case when level = 'climatologies' then concat_ws('_', model, scenario, time_range, {_PAD('month')}) when level = 'bioclim' then concat_ws('_', model, scenario, time_range) when date is not null then strftime(date, '%Y-%m-%d') else '0' end as z, count(*) as n from parsed group by all""")
def z_labels(spark, sf_dir):
    c = catalog.parse_keys(asset_keys(spark, sf_dir))
    z = catalog.z_label(*[F.col(k) for k in ("level", "scenario", "model", "time_range", "month", "date")], F.lit(0))
    return c.select("level", "variable", z.alias("z")).groupBy("level", "variable", "z").agg(F.count("*").alias("n"))


@query("resample_rules", f"with {_KEYS} select distinct variable, case variable when 'tas' then 'bilinear' when 'pr' then 'average' when 'bio12' then 'average' else 'bilinear' end as rule from parsed")
def resample_rules(spark, sf_dir):
    c = catalog.parse_keys(asset_keys(spark, sf_dir)).select("variable").distinct()
    return c.withColumn("rule", catalog.climate_rule(F.col("variable")))


@query("cover_rules", "select n_nationkey::bigint as k, case n_nationkey % 5 when 0 then 'average' when 1 then 'max' when 2 then 'rms' else 'nearest' end as rule from nation")
def cover_rules(spark, sf_dir):
    k = F.col("n_nationkey").cast("long")
    kind = F.when(k % 5 == 0, "coverage").when(k % 5 == 1, "max").when(k % 5 == 2, "rms").when(k % 5 == 3, "dominant")
    return table(spark, sf_dir, "nation").select(k.alias("k"), catalog.cover_rule(kind).alias("rule"))


@query("file_names", "select n_nationkey::bigint as k, (1990 + n_nationkey)::int as year, case when n_nationkey % 4 = 0 then null else 'class' || n_nationkey end as layer, 'a_b_c_' || n_nationkey as name from nation")
def file_names(spark, sf_dir):
    k = F.col("n_nationkey").cast("long")
    s = k.cast("string")
    file = F.concat(F.lit("cover_"), (k + 1990).cast("string"), F.when(k % 2 == 0, "_100m_").otherwise("_"), F.when(k % 4 == 0, "mean").otherwise(F.concat(F.lit("class"), s)), F.lit(".tif"))
    return table(spark, sf_dir, "nation").select(k.alias("k"), catalog.year_of(file).alias("year"), catalog.layer_suffix(file, F.lit("mean")).alias("layer"), catalog.normalised(F.concat(F.lit(" A b/C-"), s)).alias("name"))


def _inventory(spark, sf_dir):
    r, n = table(spark, sf_dir, "region").select("r_name", "r_regionkey"), table(spark, sf_dir, "nation").select("n_nationkey")
    res = F.explode(F.array(*[F.lit(x) for x in ("10m", "20m", "100m", "1km")]))
    rows = r.crossJoin(n).select(F.col("r_name").alias("category"), F.col("r_regionkey").cast("int").alias("r"), (F.col("n_nationkey") + 2000).cast("int").alias("year"), res.alias("resolution"))
    return rows.where((F.col("r") + F.length("resolution")) % 3 != 0)


_INVENTORY = "inventory as (select r_name as category, r_regionkey::int as r, (n_nationkey + 2000)::int as year, resolution from region, nation, (select unnest(['10m', '20m', '100m', '1km']) as resolution) where (r_regionkey + length(resolution)) % 3 <> 0)"
_METRES = "case when resolution like '%km' then regexp_extract(resolution, '^([\\d.]+)km$', 1)::double * 1000 else regexp_extract(resolution, '^([\\d.]+)m$', 1)::double end"


@query("inventory_resolution", f"with {_INVENTORY}, m as (select distinct category, resolution, {_METRES} as m from inventory) select category, arg_min(resolution, m) as finest, arg_max(resolution, m) as coarsest, coalesce(max(resolution) filter (where resolution = '20m'), arg_min(resolution, m)) as named from m group by category")
def inventory_resolution(spark, sf_dir):
    inv = _inventory(spark, sf_dir)
    picks = [catalog.pick_resolutions(inv, w).withColumnRenamed("resolution", n) for w, n in (("highest", "finest"), ("lowest", "coarsest"), ("20m", "named"))]
    return reduce(lambda a, b: a.join(b, "category"), picks)


@query("inventory_anti", f"with {_INVENTORY}, req as (select r_name as category, resolution from region, (select unnest(['10m', '100m', '5m']) as resolution)) select * from req where (category, resolution) not in (select category, resolution from inventory)")
def inventory_anti(spark, sf_dir):
    req = catalog.combinations(table(spark, sf_dir, "region").select(F.col("r_name").alias("category")), spark.createDataFrame([("10m",), ("100m",), ("5m",)], "resolution string"))
    return catalog.unknown_products(req, _inventory(spark, sf_dir), ["category", "resolution"])


@query("inventory_first_per_year", f"with {_INVENTORY}, f as (select *, {_METRES} as m from inventory) select category, year, resolution from f qualify row_number() over (partition by category, year order by m) = 1")
def inventory_first_per_year(spark, sf_dir):
    return catalog.first_of_each_year(_inventory(spark, sf_dir), ["category"], [catalog.metres_column(F.col("resolution"))]).select("category", "year", "resolution")


@query("inventory_years", f"with {_INVENTORY} select distinct year from inventory order by year")
def inventory_years(spark, sf_dir):
    return _inventory(spark, sf_dir).select("year").distinct().orderBy("year")


@query("combo_grid", "select r_name as category, (n_nationkey + 2000)::int as year, f as format from region, nation, (select unnest(['zip', 'tif']) as f)")
def combo_grid(spark, sf_dir):
    years = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 2000).cast("int").alias("year"))
    return catalog.combinations(table(spark, sf_dir, "region").select(F.col("r_name").alias("category")), years, spark.createDataFrame([("zip",), ("tif",)], "format string"))


@query("asset_lookup", "select n_nationkey::bigint as k, case when n_nationkey % 3 = 0 then null else 'store/' || n_nationkey end as href from nation")
def asset_lookup(spark, sf_dir):
    from cellweave.sources.readers import asset_href

    k = F.col("n_nationkey").cast("long")
    rows = table(spark, sf_dir, "nation").select(k.alias("k"), F.lit("tas").alias("variable"), F.create_map(F.when(k % 3 == 0, "pr").otherwise("tas"), F.struct(F.concat(F.lit("store/"), k.cast("string")).alias("href"))).alias("assets"))
    return rows.select("k", asset_href().alias("href"))


# --- set operations ------------------------------------------------------------------------------------------


@query("union_tiles", "select p_partkey::bigint as id, 'west' as tile from part where p_partkey % 64 < 40 union all select p_partkey::bigint, 'east' from part where p_partkey % 64 >= 32")
def union_tiles(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"))
    return raster.stack([p.where("id % 64 < 40").withColumn("tile", F.lit("west")), p.where("id % 64 >= 32").withColumn("tile", F.lit("east"))])


@query("param_except", "select distinct n_name from nation where n_nationkey % 3 <> 0")
def param_except(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_name").subtract(n.where("n_nationkey % 3 = 0").select("n_name"))


@query("param_intersect", "select distinct n_name from nation where n_nationkey % 3 = 0 and n_nationkey % 2 = 0")
def param_intersect(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.where("n_nationkey % 3 = 0").select("n_name").intersect(n.where("n_nationkey % 2 = 0").select("n_name"))


@query("distinct_species", f"with {OCC} select distinct specieskey from occ")
def distinct_species(spark, sf_dir):
    return occurrences(spark, sf_dir).select("specieskey").distinct()


@query("month_ranges", "select unnest(['11_2000', '12_2000', '01_2000', '11_2001', '12_2001', '01_2001']) as label")
def month_ranges(spark, sf_dir):
    return spark.createDataFrame([(m,) for m in temporal.month_range(11, 1, 2000, 2001)], "label string")


@query("resolution_metres", "select unnest(['10m', '1km', '30sec', '250m']) as r, unnest([10.0::double, 1000.0::double, 999999.0::double, 250.0::double]) as m")
def resolution_metres(spark, sf_dir):
    names = ["10m", "1km", "30sec", "250m"]
    return spark.createDataFrame([(n, grids.metres(n)) for n in names], "r string, m double")
