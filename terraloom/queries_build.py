"""More registered queries: cube builds in their modes, grids and alignment, publishing and catalogue joins, each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .functions import expressions, identifiers, masks
from .operators import catalog, composite, grid, mosaic, timeline
from .plans import cube as plans
from .queries import _GRID, _ITEMS, _MONTHS, CELL, OBS, RATIO, STATS, catalogue, cube_assets, observations, query, raster, stats, table, tiles
from .sources import publish

#: Pixels of the builds: one row for each asset, pixel and date; the word is a bit-field quality.
_WORD = "CASE WHEN l_linenumber <> 7 THEN (l_partkey * 7 + l_orderkey) % 256 END"
_A = f"""a AS (SELECT (l_suppkey % 10)::VARCHAR AS tile, date_trunc('month', l_shipdate)::DATE AS date, (l_partkey % 100 // 10)::INT AS row, (l_partkey % 10)::INT AS col, l_linenumber % 3 AS source,
  row(l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax, l_partkey, l_suppkey) AS s, CASE WHEN l_linenumber <> 6 THEN floor(l_extendedprice)::BIGINT % 10000 END AS nir,
  floor(l_quantity * 50)::INT AS red, CASE WHEN l_linenumber <> 7 THEN l_linenumber - 1 END AS quality, {_WORD} AS word FROM lineitem)"""
_NDVI = "CASE WHEN nir + red <> 0 THEN trunc(least(greatest(10000.0::DOUBLE * ((nir::DOUBLE - red) / nullif(nir::DOUBLE + red, 0)), -32768), 32767)) END::BIGINT AS \"NDVI\""


def _mosaic(q: str = "quality", pick: str = "arg_max", source: bool = False) -> str:
    held = ", ".join(f"{pick}({x}, s) FILTER (WHERE {x} IS NOT NULL) AS {y}" for x, y in (("nir", "nir"), ("red", "red"), (q, "quality")))
    held += f", {pick}(source, s) FILTER (WHERE {q} IS NOT NULL) AS source" if source else ""
    return f"""{_A}, m AS (SELECT tile, date, row, col, {held} FROM a GROUP BY ALL),
o AS (SELECT * REPLACE (CASE WHEN nir IS NULL OR red IS NULL THEN NULL ELSE quality END AS quality), year(date) AS y FROM m)"""


def _ranked(clear: str) -> str:
    return f"""st AS (SELECT tile, y, date, {RATIO.format(p=f"count(*) FILTER (WHERE {clear})", w="count(*)", z="0.0")} AS e FROM o GROUP BY ALL),
rk AS (SELECT tile, y, date, row_number() OVER (PARTITION BY tile, y ORDER BY e DESC, date DESC) AS rank FROM st), h AS (SELECT o.*, rank FROM o JOIN rk USING (tile, y, date))"""


def _best(usable: dict[str, str], more: str = "") -> str:
    firsts = ", ".join(f"min(CASE WHEN {u} THEN rank END) OVER (PARTITION BY tile, y, row, col) AS i_{b}" for b, u in usable.items())
    took = ", ".join(f"arg_min({b}, rank) FILTER (WHERE {b} IS NOT NULL AND rank >= coalesce(i_{b}, 1)) AS {b}" for b in usable)
    return f"""f AS (SELECT *, {firsts} FROM h), c AS (SELECT tile, make_date(y, 1, 1) AS period_start, row, col, {took}, count(*) FILTER (WHERE {usable["quality"]}) AS clearob, count(quality) AS totalob,
  coalesce(arg_min(dayofyear(date), rank) FILTER (WHERE quality IS NOT NULL AND rank >= coalesce(i_quality, 1)), arg_min(dayofyear(date), rank) FILTER (WHERE {usable["quality"]}), -1)::INT AS provenance{more} FROM f GROUP BY tile, y, row, col)
SELECT * REPLACE (nir::INT AS nir), {_NDVI} FROM c"""


def cube(function: str = "LCF", **parameters) -> plans.Cube:
    bands = (plans.Band("nir", "nir"), plans.Band("red", "red"), plans.Band("quality", "quality", "uint8", 255))
    mask = {"clear_data": [0, 1], "not_clear_data": [2, 3, 4], "nodata": 255}
    return plans.Cube("demo", 1, "g", function, timeline.Schema("continuous", "year"), bands, (plans.Band("NDVI", "ndvi"),), "quality", {"mask": mask} | parameters)


def years(spark):
    return timeline.timeline(spark, timeline.Schema("continuous", "year"), dt.date(1990, 1, 1), dt.date(2030, 12, 31))


def assets(spark, d):
    return cube_assets(spark, d).withColumn("source", F.col("asset_seq.l_linenumber") % 3)


_CLASS = {b: f"(coalesce(quality IN (0, 1), false) OR NOT (quality IS NULL OR {b} IS NULL OR quality IN (2, 3, 4)))" for b in ("quality", "nir", "red")}
_BITS = "coalesce((quality & 192) <> 0 AND (quality & 6) = 0, false)"


@query(f"""WITH {_mosaic("word")}, {_ranked(_BITS)}, {_best({b: f"({_BITS} AND {b} IS NOT NULL)" for b in ("quality", "nir", "red")})}""")
def cube_build_bits(spark, d):
    """Bit-field quality: scenes are ranked by their usable words."""
    mask = {"clear_data": [6, 7], "not_clear_data": [1, 2], "nodata": 1, "bits": True}
    word = F.when(F.col("asset_seq.l_linenumber") != 7, (F.col("asset_seq.l_partkey") * 7 + F.col("asset_seq.l_orderkey")) % 256)
    return plans.build(assets(spark, d).withColumn("quality", word), years(spark), cube(mask=mask))


@query(f"""WITH {_mosaic("quality", "arg_min", True)}, {_ranked("quality IN (0, 1)")},
{_best(_CLASS, ", coalesce(arg_min(source, rank) FILTER (WHERE quality IS NOT NULL AND rank >= coalesce(i_quality, 1)), 255)::INT AS datasource")}""")
def cube_build_combined(spark, d):
    """Several platforms: the first valid asset, with the source of the contributing scene."""
    return plans.build(assets(spark, d), years(spark), cube(combined=True)).withColumn("datasource", F.col("datasource").cast("int"))


@query(f"""WITH {_mosaic()}, p AS (SELECT tile, y FROM o GROUP BY tile, y HAVING count(nir) > 0 AND count(red) > 0)
SELECT tile, make_date(y, 1, 1) AS period_start, date, row, col, nir::INT AS nir, red, quality, {_NDVI} FROM o JOIN p USING (tile, y)""")
def cube_build_idt(spark, d):
    """The cube of single dates."""
    return plans.build(assets(spark, d), years(spark), cube("IDT"))


@query(f"""WITH {_mosaic()}, c AS (SELECT tile, make_date(y, 1, 1) AS period_start, row, col, {", ".join(f"trunc(median({b}) FILTER (WHERE {u}))::BIGINT AS {b}" for b, u in _CLASS.items())},
  count(*) FILTER (WHERE {_CLASS["quality"]}) AS clearob, count(quality) AS totalob FROM o GROUP BY tile, y, row, col) SELECT *, {_NDVI} FROM c""")
def cube_build_median(spark, d):
    return plans.build(assets(spark, d), years(spark), cube("MED"))


@query(f"""WITH {OBS}, {STATS} SELECT tile_id, period, arg_max(scene_date, struct_pack(a := efficacy, b := -epoch(scene_date))) AS best_date FROM st GROUP BY tile_id, period""")
def best_scene(spark, d):
    return composite.best_scene(stats(observations(spark, d)), ["tile_id", "period"], "scene_date")


def _spread(name: str, value: str) -> str:
    return f"{name} AS (SELECT tile_id, scene_date, x, sum(n) OVER (PARTITION BY tile_id, scene_date ORDER BY x) / sum(n) OVER (PARTITION BY tile_id, scene_date) AS p FROM (SELECT tile_id, scene_date, {value}::DOUBLE AS x, count(*)::DOUBLE AS n FROM b WHERE v IS NOT NULL AND r IS NOT NULL GROUP BY ALL))"


@query(f"""WITH {OBS.replace("obs AS", "raw AS")}, obs AS (SELECT * REPLACE (v // 500 AS v) FROM raw), {STATS},
best AS (SELECT tile_id, period, arg_max(scene_date, struct_pack(a := efficacy, b := -epoch(scene_date))) AS best_date FROM st GROUP BY tile_id, period),
ref AS (SELECT tile_id, period, pixel, v AS r FROM obs JOIN best USING (tile_id, period) WHERE scene_date = best_date),
b AS (SELECT obs.*, best_date, r FROM obs JOIN best USING (tile_id, period) LEFT JOIN ref USING (tile_id, period, pixel)), {_spread("sc", "v")}, {_spread("rc", "r")},
m AS (SELECT sc.tile_id, sc.scene_date, sc.x, sc.p, arg_max(struct_pack(p := rc.p, x := rc.x), rc.p) FILTER (WHERE rc.p <= sc.p) AS lo, arg_min(struct_pack(p := rc.p, x := rc.x), rc.p) FILTER (WHERE rc.p >= sc.p) AS hi FROM sc JOIN rc USING (tile_id, scene_date) GROUP BY ALL),
k AS (SELECT tile_id, scene_date, x, p, coalesce(lo, hi) AS lo, coalesce(hi, lo) AS hi FROM m)
SELECT b.tile_id, b.period, b.scene_date, pixel, CASE WHEN b.scene_date = best_date OR r IS NULL OR v IS NULL THEN v ELSE round_even(CASE WHEN hi.p > lo.p THEN lo.x + (hi.x - lo.x) * (p - lo.p) / (hi.p - lo.p) ELSE lo.x END, 0) END::BIGINT AS v
FROM b LEFT JOIN k ON b.tile_id = k.tile_id AND b.scene_date = k.scene_date AND b.v = k.x""")
def histogram_match_to_best(spark, d):
    """Every date's values matched to those of its period's best date."""
    rows = observations(spark, d).withColumn("v", F.floor(F.col("v") / 500).cast("int"))
    out = composite.match_to_best(rows, stats(rows), ["tile_id", "period"], ["pixel"], ["v"], "scene_date")
    return out.select("tile_id", "period", "scene_date", "pixel", "v")


@query(f"""WITH {OBS} SELECT tile_id, period, {RATIO.format(p="count(*) FILTER (WHERE q IN (0, 1))", w="count(*)", z="0.0")} AS efficacy,
  {RATIO.format(p="count(*) FILTER (WHERE q IN (2, 3, 4))", w="count(*) FILTER (WHERE q IN (0, 1, 2, 3, 4))", z="0.0")} AS cloud FROM obs GROUP BY ALL""")
def composite_stats(spark, d):
    q = F.col("q")
    return composite.composite_stats(observations(spark, d), ["tile_id", "period"], q.isin(0, 1), q.isin(2, 3, 4))


@query(f"""WITH {_GRID} SELECT tile_id, row::INT AS row, col::INT AS col, v FROM p WHERE row < 7 AND col < 4""")
def fixed_shape(spark, d):
    return mosaic.fixed_shape(raster(spark, d), 7, 4).select("tile_id", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), "v")


@query(f"""WITH {_GRID}, t AS (SELECT DISTINCT tile_id FROM p), c AS (SELECT tile_id, r.k::INT AS row, c.k::INT AS col FROM t, range(8) r(k), range(9) c(k)),
x AS (SELECT *, floor((1000.0 - (985.0 - (row + 0.5) * 13.0)) / 10.0)::INT AS srow, floor((112.0 + (col + 0.5) * 11.0 - 100.0) / 10.0)::INT AS scol FROM c)
SELECT x.tile_id, x.row, x.col, v FROM x LEFT JOIN p ON x.tile_id = p.tile_id AND srow = p.row AND scol = p.col""")
def reproject_nearest(spark, d):
    """A raster at (100, 1000) with pixels of 10 on a grid at (112, 985) with pixels of 11 x 13."""
    source = raster(spark, d)
    return mosaic.reproject_nearest(source, source.select("tile_id").distinct(), ["tile_id"], (100.0, 1000.0, 10.0, 10.0), (112.0, 985.0, 11.0, 13.0), (8, 9))


@query("""WITH x AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'LC8SR-1' WHEN 1 THEN 'CBERS4-MUX' WHEN 2 THEN 'S2-L2A' ELSE 'LC8DN' END AS ds, CASE WHEN p_size % 3 = 0 THEN 'uint8' ELSE 'int16' END AS kind,
  CASE WHEN p_partkey % 5 <> 0 THEN -1.0 * (p_partkey % 5) END AS file, CASE WHEN p_partkey % 7 <> 0 THEN -7.0 END AS asset, p_size % 10 = 2 AS quality FROM part)
SELECT p_partkey, CASE WHEN starts_with(ds, 'LC8SR') AND kind <> 'int16' THEN 0.0 WHEN starts_with(ds, 'CBERS') THEN -9999.0 WHEN file IS NOT NULL THEN file WHEN quality THEN 255.0 WHEN asset IS NOT NULL THEN asset ELSE -9999.0 END::DOUBLE AS nodata FROM x""")
def source_nodata(spark, d):
    k = F.col("p_size") % 4
    dataset = F.when(k == 0, "LC8SR-1").when(k == 1, "CBERS4-MUX").when(k == 2, "S2-L2A").otherwise("LC8DN")
    file = F.when(F.col("p_partkey") % 5 != 0, -1.0 * (F.col("p_partkey") % 5))
    found = mosaic.source_nodata(dataset, F.when(F.col("p_size") % 3 == 0, "uint8").otherwise("int16"), F.lit(-9999.0), F.when(F.col("p_partkey") % 7 != 0, -7.0), file, F.lit(255.0), F.col("p_size") % 10 == 2)
    return table(spark, d, "part").select("p_partkey", found.cast("double").alias("nodata"))


@query("""SELECT s_suppkey AS source, s_suppkey % 3 = 0 AND s_suppkey % 11 > 7 AS oli FROM supplier""")
def oli_sources(spark, d):
    platform = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("LANDSAT-"), (F.col("s_suppkey") % 11).cast("string"))).otherwise("Sentinel-2A")
    return mosaic.oli_sources(table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"), platform.alias("platform")))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 AS band FROM lineitem), w AS (SELECT l_orderkey FROM x GROUP BY 1 HAVING count(DISTINCT band) = 3) SELECT l_orderkey, l_linenumber, band FROM x WHERE l_orderkey IN (SELECT l_orderkey FROM w)""")
def whole_periods(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") % 3).alias("band"))
    return mosaic.whole_periods(rows, ["l_orderkey"], [0, 1, 2])


@query(f"""WITH {OBS} SELECT o.tile_id, o.pixel, o.scene_date, o.v, o.q AS radsat FROM obs o""")
def attach_saturation(spark, d):
    rows = observations(spark, d)
    long = rows.select(*CELL, "scene_date", F.explode(F.create_map(F.lit("nir"), F.col("v"), F.lit("radsat"), F.col("q"))).alias("band", "v"))
    return mosaic.attach_saturation(long, [*CELL, "scene_date"], "radsat").drop("band")


@query("""WITH RECURSIVE c AS (SELECT 4000.0 AS left_, 7000.0 AS top_), k AS (SELECT 5000.0 - 1000.0 AS l, 6000.0 + 750.0 AS t), o AS (SELECT l - ceil(abs(l - 1300.0) / 2000.0) * 2000.0 AS gx, t + (ceil(abs(t - 9100.0) / 1500.0) + 1) * 1500.0 AS gy FROM k)
SELECT name, gx::DOUBLE AS left_x, gy::DOUBLE AS top_y, w::DOUBLE AS width, h::DOUBLE AS height FROM o, (VALUES ('sm', 2000.0, 1500.0), ('md', 4000.0, 3000.0), ('lg', 8000.0, 6000.0)) v(name, w, h)""")
def grid_hierarchy(spark, d):
    """Grids that share an origin, anchored at a tile centred on the meridian's point."""
    found = grid.hierarchy(["sm", "md", "lg"], (1000.0, 750.0), [(2, 2), (4, 4), (8, 8)], (1300.0, -2000.0, 9000.0, 9100.0), (5000.0, 6000.0))
    return spark.createDataFrame([(g.name, *g.origin, *g.size) for g in found], "name string, left_x double, top_y double, width double, height double")


_SINU = "degrees({x} / (6371007.181::DOUBLE * cos({y} / 6371007.181::DOUBLE))) - 54"


def _corners(pick: str) -> str:
    return f"{pick}({', '.join(_SINU.format(x=x, y=y) for x in ('xmin', 'xmax') for y in ('ymin', 'ymax'))})"


@query(f"""WITH t AS (SELECT s_suppkey, s_suppkey * 1000.0::DOUBLE AS xmin, s_suppkey * -900.0::DOUBLE - 100000 AS ymin, s_suppkey * 1000.0::DOUBLE + 105600 AS xmax, s_suppkey * -900.0::DOUBLE + 5600 AS ymax FROM supplier)
SELECT s_suppkey, round({_corners("least")}, 6) AS west, round({_corners("greatest")}, 6) AS east, round(degrees(ymin / 6371007.181::DOUBLE), 6) AS south, round(degrees(ymax / 6371007.181::DOUBLE), 6) AS north FROM t""")
def raster_extent(spark, d):
    x, y = F.col("s_suppkey") * 1000.0, F.col("s_suppkey") * -900.0
    rows = table(spark, d, "supplier").select("s_suppkey", x.alias("xmin"), (y - 100000).alias("ymin"), (x + 105600).alias("xmax"), (y + 5600).alias("ymax"))
    out = grid.raster_extent(rows, "sinu", -54)
    return out.select("s_suppkey", *[F.round(c, 6).alias(c) for c in ("west", "east", "south", "north")])


@query(f"""WITH {_ITEMS}, tl AS (SELECT range AS tile, 'T' || range::VARCHAR AS label FROM range(0, 30)) SELECT id, name, tile, label FROM it JOIN tl USING (tile)""")
def items_with_tiles(spark, d):
    named = spark.range(30).select(F.col("id").alias("tile"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("label"))
    return catalog.items_with_tiles(catalogue(spark, d).select("id", "name", "tile"), named).select("id", "name", "tile", "label")


@query("""SELECT n_nationkey, r_regionkey AS srid, r_name AS proj FROM nation JOIN region ON n_regionkey = r_regionkey""")
def grids_with_reference(spark, d):
    grids = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("srid"))
    return catalog.grids_with_reference(grids, table(spark, d, "region").select(F.col("r_regionkey").alias("srid"), F.col("r_name").alias("proj"))).select("n_nationkey", "srid", "proj")


@query("""WITH u AS (SELECT o_custkey AS cube, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS datasets FROM orders GROUP BY 1)
SELECT c_custkey AS cube, c_mktsegment AS parameters, coalesce(datasets, '') AS datasets FROM customer LEFT JOIN u ON c_custkey = cube""")
def cube_meta(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("cube"))
    stored = table(spark, d, "customer").select(F.col("c_custkey").alias("cube"), F.col("c_mktsegment").alias("parameters"))
    used = table(spark, d, "orders").select(F.col("o_custkey").alias("cube"), F.col("o_orderpriority").alias("dataset"))
    return catalog.cube_meta(rows, stored, used).select("cube", "parameters", F.array_join("datasets", ",").alias("datasets"))


@query(f"""WITH {_MONTHS}, k AS (SELECT DISTINCT l_suppkey % 100 AS tile, date_trunc('month', l_shipdate)::DATE AS s FROM lineitem), g AS (SELECT DISTINCT tile FROM k)
SELECT tile, s AS period_start, (s + INTERVAL 1 MONTH - INTERVAL 1 DAY)::DATE AS period_end FROM g, ps WHERE (tile, s) NOT IN (SELECT (tile, s) FROM k)""")
def missing_periods(spark, d):
    periods = timeline.timeline(spark, timeline.Schema("continuous", "month"), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    known = table(spark, d, "lineitem").select((F.col("l_suppkey") % 100).alias("tile"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("period_start")).distinct()
    return timeline.missing_periods(known, periods)


@query("""SELECT o_orderkey AS scene, o_orderpriority AS dataset, o_orderdate::DATE AS date, b AS band, 'x/' || a || o_orderkey::VARCHAR AS link FROM orders, (VALUES ('B4', 'red'), ('B8', 'nir')) v(a, b)""")
def normalized_scenes(spark, d):
    links = F.create_map(*[x for a in ("B4", "B8", "meta") for x in (F.lit(a), F.concat(F.lit(f"x/{a}"), F.col("o_orderkey").cast("string")))])
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("scene"), F.col("o_orderpriority").alias("dataset"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"), links.alias("assets"))
    return catalog.normalized_scenes(rows, spark.createDataFrame([("B4", "red"), ("B8", "nir")], "asset string, band string"))


@query("""SELECT o_orderpriority AS band, o_orderdate::DATE AS date, min(o_orderkey) AS id, arg_min(o_custkey, o_orderkey) AS scene FROM orders GROUP BY 1, 2""")
def first_by_band_date(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("band"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("scene"))
    return catalog.first_by_band_date(rows)


@query("""SELECT DISTINCT 'B' || (p_size % 20)::VARCHAR AS band FROM part WHERE 'B' || (p_size % 20)::VARCHAR NOT IN (SELECT 'B' || (n_nationkey % 15)::VARCHAR FROM nation)""")
def bands_missing(spark, d):
    name = lambda c: F.concat(F.lit("B"), c.cast("string")).alias("band")
    return catalog.bands_missing(table(spark, d, "part").select(name(F.col("p_size") % 20)), table(spark, d, "nation").select(name(F.col("n_nationkey") % 15)))


@query("""WITH b AS (SELECT n_regionkey AS cube, string_agg(n_name, ',' ORDER BY n_nationkey) AS bands FROM nation GROUP BY 1), i AS (SELECT o_custkey % 4 AS cube, min(o_orderdate)::DATE AS first_date, max(o_orderdate)::DATE + 15 AS last_date, count(*) AS n_items FROM orders GROUP BY 1)
SELECT r_regionkey AS cube, r_name AS name, bands, first_date, last_date, coalesce(n_items, 0) AS n_items FROM region LEFT JOIN b ON b.cube = r_regionkey LEFT JOIN i ON i.cube = r_regionkey""")
def cube_detail(spark, d):
    cubes = table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("cube"), F.col("r_name").alias("name"))
    bands = table(spark, d, "nation").select(F.col("n_regionkey").cast("long").alias("cube"), F.col("n_nationkey").alias("position"), F.col("n_name").alias("band"))
    day = F.col("o_orderdate").cast("date")
    items = table(spark, d, "orders").select((F.col("o_custkey") % 4).alias("cube"), day.alias("start_date"), F.date_add(day, 15).alias("end_date"))
    return catalog.cube_detail(cubes, bands, items).withColumn("bands", F.array_join("bands", ","))


@query("""SELECT c_custkey AS k, 'old' AS src FROM customer UNION ALL SELECT DISTINCT o_custkey + 5, 'new' FROM orders WHERE o_custkey + 5 NOT IN (SELECT c_custkey FROM customer)""")
def get_or_create(spark, d):
    held = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("old").alias("src"))
    return catalog.get_or_create(held, table(spark, d, "orders").select((F.col("o_custkey") + 5).alias("k"), F.lit("new").alias("src")).distinct(), ["k"])


@query("""WITH e AS (SELECT l_orderkey AS k, 'B' || (l_linenumber % 4)::VARCHAR AS asset, arg_max('x' || l_linenumber::VARCHAR, l_linenumber) AS link FROM lineitem GROUP BY 1, 2)
SELECT k, (SELECT max(l_linenumber) FROM lineitem WHERE l_orderkey = k) AS version, string_agg(asset || '=' || link, ',' ORDER BY asset) AS assets FROM e GROUP BY k""")
def merged_assets(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("version"), F.create_map(F.concat(F.lit("B"), (F.col("l_linenumber") % 4).cast("string")), F.concat(F.lit("x"), F.col("l_linenumber").cast("string"))).alias("assets"))
    out = catalog.merged_assets(rows.where("version <= 3"), rows.where("version > 3"), ["k"], "version")
    return out.select("k", "version", F.array_join(F.transform(F.map_entries("assets"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("assets"))


@query("""SELECT ps::DATE AS period_start, (ps + INTERVAL 15 DAY)::DATE AS period_end FROM range(DATE '2020-01-01', DATE '2021-01-01', INTERVAL 16 DAY) r(ps) WHERE ps >= DATE '2020-03-01' AND ps + INTERVAL 15 DAY <= DATE '2020-10-15'""")
def timeline_clip(spark, d):
    whole = timeline.timeline(spark, timeline.Schema("continuous", "day", 16), dt.date(2020, 1, 1), dt.date(2020, 12, 31))
    return timeline.clip(whole, dt.date(2020, 3, 1), dt.date(2020, 10, 15))


@query("""SELECT o_orderkey, date_diff('day', o_orderdate::DATE, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE)::INT AS days, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS at FROM orders""")
def days_to_next_month(spark, d):
    return table(spark, d, "orders").select("o_orderkey", timeline.days_to_next_month(F.col("o_orderdate").cast("date")).alias("days"), catalog.rfc3339(F.col("o_orderdate")).alias("at"))


@query("""SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 3 = 0 THEN 100001 END, CASE WHEN n_nationkey % 2 = 0 THEN 31983 END, 4326)::INT AS srid FROM nation""")
def spatial_reference(spark, d):
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select("n_nationkey", grid.spatial_reference(F.when(k % 3 == 0, 100001), F.when(k % 2 == 0, 31983)).alias("srid"))


@query("""SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_custkey % 10 IN (4, 5, 7, 8, 9) AS archive, CASE WHEN o_orderkey % 2 = 0 THEN 'LC8' ELSE 'LC8_S' END AS bare FROM orders""")
def landsat_archive(spark, d):
    name = F.concat(F.lit("LC0"), (F.col("o_custkey") % 10).cast("string"), F.lit("_L1TP_1_2_3_01_T1"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("_x"))
    plain = F.when(F.col("o_orderkey") % 2 == 0, "LC8_SR").otherwise("LC8_S")
    return table(spark, d, "orders").select("o_orderkey", identifiers.is_landsat_archive(name).alias("archive"), identifiers.strip_suffix(plain).alias("bare"))


@query("""SELECT o_orderkey, (l & 3)::BIGINT AS cloud, ((l >> 2) & 3) >= 1 OR (l & 3) = 0 AS hit FROM (SELECT o_orderkey, (o_orderkey * 13 + o_custkey) % 256 AS l FROM orders)""")
def qa_named_levels(spark, d):
    """Predicates by the stored names of fields and levels."""
    word = F.shiftleft((F.col("o_orderkey") * 13 + F.col("o_custkey")) % 256, 8)
    return table(spark, d, "orders").select("o_orderkey", masks.confidence(word)["cloud"].alias("cloud"), masks.confidence_hit(word, "cloud_shadow >= LOW or cloud == NO_CONFIDENCE").alias("hit"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN (l_suppkey & 4) = 0 OR l_linenumber % 2 = 0 ELSE NOT (l_linenumber % 2 = 1 AND (l_suppkey & 4) <> 0) END AND (l_suppkey & 8) <> 0 AS usable FROM lineitem""")
def qa_cirrus_by_sensor(spark, d):
    """The cirrus bit counts for the newer sensor only, here on odd lines."""
    mask = masks.Mask((3,), 1, (2,), bits=True)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", masks.qa_usable(F.col("l_suppkey"), mask, F.col("l_linenumber") % 2 == 1).alias("usable"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'S2' || CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END END AS mission, CASE WHEN o_orderkey % 4 <> 0 THEN '22KBA' END AS tile,
  CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y%m%d') END AS sensed, CASE WHEN o_orderkey % 4 <> 0 THEN 'L2A' END AS level, CASE WHEN o_orderkey % 4 <> 0 THEN 'N0' || (o_custkey % 5)::VARCHAR || '00' END AS baseline FROM orders""")
def sentinel_short_id(spark, d):
    name = F.concat(F.lit("S2"), F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("B"), F.when(F.col("o_orderkey") % 4 == 0, "_22KBA_").otherwise("_T22KBA_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_0_L2A"))
    parts = identifiers.parse_short_product(name, F.concat(F.lit("0"), (F.col("o_custkey") % 5).cast("string"), F.lit(".00")))
    return table(spark, d, "orders").select("o_orderkey", *[parts[n].alias(n) for n in ("mission", "tile", "sensed", "level", "baseline")])


def _shape() -> str:
    return "SELECT tile, '{\"type\":\"Feature\",\"properties\":{\"name\":\"' || tile || '\"},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":[[' || " + " || ',' || ".join(f"'[' || {x}::VARCHAR || ',' || {y}::VARCHAR || ']'" for x, y in (("xmin", "ymax"), ("xmax", "ymax"), ("xmax", "ymin"), ("xmin", "ymin"), ("xmin", "ymax"))) + " || ']]}}' AS feature"


@query(f"""WITH tl AS (SELECT lpad(ix::VARCHAR, 3, '0') || lpad(iy::VARCHAR, 3, '0') AS tile, -60.0::DOUBLE + ix * 2.5::DOUBLE AS xmin, 5.0::DOUBLE - iy * 2.0::DOUBLE - 2.0::DOUBLE AS ymin,
  -60.0::DOUBLE + ix * 2.5::DOUBLE + 2.5::DOUBLE AS xmax, 5.0::DOUBLE - iy * 2.0::DOUBLE AS ymax FROM range(0, 9) a(ix), range(0, 13) b(iy)) {_shape()} FROM tl""")
def grid_geojson(spark, d):
    return tiles(spark).select("tile", catalog.geojson(F.col("tile"), F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")).alias("feature"))


@query("""SELECT * REPLACE (nodata::DOUBLE AS nodata, scale::DOUBLE AS scale) FROM (VALUES ('blue', 'blue', 'int16', -9999.0, 0, 10000, 0.0001), ('q', 'quality', 'uint8', 255.0, 0, 10000, NULL), ('EVI', 'evi', 'int16', -9999.0, -10000, 10000, 0.0001), ('CLEAROB', 'clearob', 'uint8', 0.0, 0, 255, NULL),
  ('TOTALOB', 'totalob', 'uint8', 0.0, 0, 255, NULL), ('PROVENANCE', 'provenance', 'int16', -1.0, 0, 366, NULL)) v(name, common_name, data_type, nodata, "min", "max", scale)""")
def item_assets(spark, d):
    """The catalogue of a cube's assets."""
    made = plans.Cube("c", 1, "g", "LCF", timeline.Schema("continuous", "month"), (plans.Band("blue", "blue"), plans.Band("q", "quality", "uint8", 255)), (plans.Band("EVI", "evi", expression=expressions.EVI),), "q", {"mask": {"clear_data": [0], "nodata": 255}})
    rows = [(a["name"], a["common_name"], a["data_type"], float(a["nodata"]), a["min"], a["max"], a["scale"]) for a in plans.item_assets(made)]
    return spark.createDataFrame(rows, "name string, common_name string, data_type string, nodata double, min int, max int, scale double")


@query("""SELECT name, how FROM (VALUES ('quality', 'nearest'), ('asked', 'average'), ('plain', 'bilinear'), ('saturated', 'nearest'), ('bare', 'bilinear')) v(name, how)""")
def resampling_choice(spark, d):
    made = {
        "quality": mosaic.resampling_choice(True, "average"), "asked": mosaic.resampling_choice(False, "AVERAGE"), "plain": mosaic.resampling_choice(False, saturated_band="RADSAT", band="B1"),
        "saturated": mosaic.resampling_choice(False, saturated_band="RADSAT", band="RADSAT"), "bare": mosaic.resampling_choice(False, has_mask=False, has_quality=False),
    }
    return spark.createDataFrame(list(made.items()), "name string, how string")


@query("""SELECT c_custkey, 'B' || b::VARCHAR AS band, 'x/' || c_custkey::VARCHAR || '.SAFE' AS link FROM customer, range(1, 4) r(b)""")
def single_asset_spread(spark, d):
    """One archive asset serves every band."""
    rows = table(spark, d, "customer").select("c_custkey", F.create_map(F.lit("safe"), F.concat(F.lit("x/"), F.col("c_custkey").cast("string"), F.lit(".SAFE"))).alias("assets"))
    return catalog.scene_assets(catalog.spread_single_asset(rows, ["B1", "B2", "B3"], "safe")).select("c_custkey", F.col("asset").alias("band"), "link")


@query(f"""WITH {_GRID} SELECT tile_id, coalesce(min(v), -1) AS least, coalesce(max(v), -1) AS most, count(v) AS valid FROM p GROUP BY tile_id""")
def raster_guard(spark, d):
    return publish.raster_guard(raster(spark, d), ["tile_id"])
