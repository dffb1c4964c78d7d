"""The registered queries of the engine's own operators over the driver's tables, each with its SQL.

Rasters are derived from ``lineitem``: a tile from the supplier, a pixel from the part, a date from the ship month, a quality
class from the line number and a value from the price. All queries run over whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import expressions, identifiers, masks
from .operators import catalog, composite, grid, mosaic, timeline
from .plans import cube as plans
from .sources import directory, publish

MASK = masks.Mask((0, 1), 255, (2, 3, 4))
CELL, PERIOD_CELL = ["tile_id", "pixel"], ["tile_id", "pixel", "period"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def observations(spark: SparkSession, d: str) -> DataFrame:
    """(tile_id, pixel, scene_date, q, v, period): one row for each pixel and date, null for nodata."""
    q = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") - 1)
    v = F.when(F.col("l_linenumber") != 6, (F.floor("l_extendedprice") % 10000).cast("int"))
    key = [(F.col("l_suppkey") % 10).cast("int").alias("tile_id"), (F.col("l_partkey") % 100).cast("int").alias("pixel"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("scene_date")]
    rows = table(spark, d, "lineitem").groupBy(*key).agg(F.min(q).alias("q"), F.min(v).alias("v"))
    return rows.withColumn("period", F.year("scene_date"))


OBS = """obs AS (SELECT (l_suppkey % 10)::INT AS tile_id, (l_partkey % 100)::INT AS pixel, date_trunc('month', l_shipdate)::DATE AS scene_date,
  min(CASE WHEN l_linenumber <> 7 THEN l_linenumber - 1 END) AS q, min(CASE WHEN l_linenumber <> 6 THEN floor(l_extendedprice)::BIGINT % 10000 END)::INT AS v,
  year(date_trunc('month', l_shipdate))::INT AS period FROM lineitem GROUP BY ALL)"""
USABLE = "(coalesce(q IN (0, 1), false) OR NOT (q IS NULL OR v IS NULL OR q IN (2, 3, 4)))"
#: bround to two places: both numbers are whole, so a tie is exact.
RATIO = "CASE WHEN {w} > 0 THEN round_even(100.0::DOUBLE * {p} / {w}, 2) ELSE {z} END"
STATS = f"""st AS (SELECT tile_id, period, scene_date, {RATIO.format(p="count(*) FILTER (WHERE q IN (0, 1))", w="count(*)", z="0.0")} AS efficacy,
  {RATIO.format(p="count(*) FILTER (WHERE q IN (2, 3, 4))", w="count(*) FILTER (WHERE q IN (0, 1, 2, 3, 4))", z="100.0")} AS cloud FROM obs GROUP BY ALL)"""
RANKED = f"""rk AS (SELECT tile_id, period, scene_date, row_number() OVER (PARTITION BY tile_id, period ORDER BY efficacy DESC, scene_date DESC) AS rank FROM st),
h AS (SELECT obs.*, rank, {USABLE} AS usable FROM obs JOIN rk USING (tile_id, period, scene_date))"""


def stats(obs: DataFrame) -> DataFrame:
    return composite.scene_stats(obs, ["tile_id", "period", "scene_date"], F.col("q").isin(0, 1), F.col("q").isin(2, 3, 4))


def history(spark: SparkSession, d: str) -> DataFrame:
    obs = observations(spark, d)
    ranked = composite.rank_scenes(stats(obs), ["tile_id", "period"], "scene_date").select("tile_id", "period", "scene_date", "rank")
    return obs.join(ranked, ["tile_id", "period", "scene_date"]).withColumn("usable", masks.class_usable(F.col("q"), F.col("v"), MASK))


@query(f"""WITH {OBS}, {STATS} SELECT tile_id, period, scene_date, efficacy, cloud FROM st""")
def scene_stats(spark, d):
    return stats(observations(spark, d))


@query(f"""WITH {OBS}, {STATS}, {RANKED},
f AS (SELECT *, min(CASE WHEN usable THEN rank END) OVER (PARTITION BY tile_id, pixel, period) AS i FROM h)
SELECT tile_id, pixel, period, arg_min(v, rank) FILTER (WHERE v IS NOT NULL AND rank >= coalesce(i, 1)) AS v,
  coalesce(arg_min(dayofyear(scene_date), rank) FILTER (WHERE v IS NOT NULL AND rank >= coalesce(i, 1)), arg_min(dayofyear(scene_date), rank) FILTER (WHERE usable), -1)::INT AS provenance,
  count(*) FILTER (WHERE usable) AS clearob, count(*) FILTER (WHERE q IS NOT NULL) AS totalob FROM f GROUP BY tile_id, pixel, period""")
def composite_lcf(spark, d):
    return composite.best_pixel(history(spark, d), PERIOD_CELL, date="scene_date")


@query(f"""WITH {OBS}, {STATS}, {RANKED}, g AS (SELECT * REPLACE (usable AND v IS NOT NULL AS usable) FROM h)
SELECT tile_id, pixel, period, arg_min(v, struct_pack(a := NOT usable, b := rank)) FILTER (WHERE v IS NOT NULL) AS v,
  coalesce(arg_min(dayofyear(scene_date), struct_pack(a := NOT usable, b := rank)) FILTER (WHERE v IS NOT NULL), -1)::INT AS provenance FROM g GROUP BY tile_id, pixel, period""")
def composite_lcf_fast(spark, d):
    rows = history(spark, d).withColumn("usable", F.col("usable") & F.col("v").isNotNull())
    return composite.best_pixel_fast(rows, PERIOD_CELL, date="scene_date")


@query(f"""WITH {OBS}, {STATS}, {RANKED} SELECT tile_id, pixel, period, trunc(median(v) FILTER (WHERE usable))::BIGINT AS v,
  count(*) FILTER (WHERE usable) AS clearob, count(*) FILTER (WHERE q IS NOT NULL) AS totalob FROM h GROUP BY tile_id, pixel, period""")
def composite_med(spark, d):
    return composite.median(observations(spark, d).withColumn("usable", masks.class_usable(F.col("q"), F.col("v"), MASK)), PERIOD_CELL)


@query(f"""WITH {OBS}, {STATS}, {RANKED}, g AS (SELECT *, (tile_id + month(scene_date)) % 3 AS src FROM h),
f AS (SELECT *, min(CASE WHEN usable THEN rank END) OVER (PARTITION BY tile_id, pixel, period) AS i FROM g)
SELECT tile_id, pixel, period, coalesce(arg_min(src, rank) FILTER (WHERE v IS NOT NULL AND rank >= coalesce(i, 1)), 255)::INT AS datasource FROM f GROUP BY tile_id, pixel, period""")
def datasource(spark, d):
    rows = history(spark, d).withColumn("src", ((F.col("tile_id") + F.month("scene_date")) % 3).cast("int"))
    return composite.best_pixel(rows, PERIOD_CELL, date="scene_date", source="src").select(*PERIOD_CELL, "datasource")


@query(f"""WITH {OBS} SELECT tile_id, pixel, scene_date, {USABLE} AS usable FROM obs""")
def class_mask(spark, d):
    return observations(spark, d).select(*CELL, "scene_date", masks.class_usable(F.col("q"), F.col("v"), MASK).alias("usable"))


@query("""SELECT l_orderkey, l_linenumber, ((l_partkey >> 1) & 127)::BIGINT AS field, (l_partkey & 32)::BIGINT AS bit5, ((l_partkey >> 1) & 127) <> 0 AS saturated FROM lineitem""")
def radsat_bits(spark, d):
    x = F.col("l_partkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", masks.bit_range(x, 1, 7).alias("field"), masks.bit_test(x, 5).alias("bit5"), masks.saturated(x).alias("saturated"))


_QA = "((l_orderkey * 31 + l_partkey * 7) % 65536)"


@query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN {_QA} <> 1 THEN {_QA} END AS qa FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce((qa & 192) <> 0 AND (qa & 30) = 0 AND NOT ((qa >> 8) & 3) = 2, false) AS usable FROM x""")
def qa_bit_mask(spark, d):
    qa = F.expr(_QA)
    mask = masks.Mask((6, 7), 1, (1, 2, 3, 4), bits=True, confidence="cloud == MEDIUM")
    rows = table(spark, d, "lineitem").withColumn("qa", F.when(qa != 1, qa))
    return rows.select("l_orderkey", "l_linenumber", masks.qa_usable(F.col("qa"), mask).alias("usable"))


@query(f"""SELECT l_orderkey, l_linenumber, (({_QA} >> 8) & 3)::BIGINT AS cloud, (({_QA} >> 10) & 3)::BIGINT AS shadow, (({_QA} >> 12) & 3)::BIGINT AS snow, (({_QA} >> 14) & 3)::BIGINT AS cirrus,
  (({_QA} >> 8) & 3) >= 2 OR (({_QA} >> 10) & 3) = 3 AS hit FROM lineitem""")
def qa_confidence(spark, d):
    rows = table(spark, d, "lineitem").withColumn("qa", F.expr(_QA))
    return rows.select("l_orderkey", "l_linenumber", *[c.alias(n.removeprefix("cloud_")) for n, c in masks.confidence(F.col("qa")).items()], masks.confidence_hit(F.col("qa"), "cloud >= MEDIUM or shadow == HIGH").alias("hit"))


#: Several assets on each pixel, in a unique order.
def pixel_assets(spark, d):
    v = F.when(F.col("l_linenumber") != 6, (F.floor("l_extendedprice") % 10000).cast("int"))
    order = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey")
    return table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).cast("int").alias("tile_id"), (F.col("l_partkey") % 100).cast("int").alias("pixel"), v.alias("v"), (F.col("l_linenumber") % 3).alias("source"), order.alias("asset_seq"))


_ASSETS = """a AS (SELECT (l_suppkey % 10)::INT AS tile_id, (l_partkey % 100)::INT AS pixel, CASE WHEN l_linenumber <> 6 THEN floor(l_extendedprice)::BIGINT % 10000 END::INT AS v, l_linenumber % 3 AS source,
  row(l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax, l_partkey, l_suppkey) AS s FROM lineitem)"""


@query(f"""WITH {_ASSETS} SELECT tile_id, pixel, arg_max(v, s) FILTER (WHERE v IS NOT NULL) AS v FROM a GROUP BY tile_id, pixel""")
def mosaic_last_valid(spark, d):
    return mosaic.mosaic(pixel_assets(spark, d), CELL, F.col("asset_seq"))


@query(f"""WITH {_ASSETS} SELECT tile_id, pixel, arg_min(v, s) FILTER (WHERE v IS NOT NULL) AS v FROM a GROUP BY tile_id, pixel""")
def mosaic_first_valid(spark, d):
    return mosaic.mosaic(pixel_assets(spark, d), CELL, F.col("asset_seq"), first=True)


@query(f"""WITH {_ASSETS} SELECT tile_id, pixel, arg_min(source, s) FILTER (WHERE v IS NOT NULL) AS source FROM a GROUP BY tile_id, pixel""")
def mosaic_source_index(spark, d):
    return mosaic.mosaic(pixel_assets(spark, d), CELL, F.col("asset_seq"), source="source", first=True).select(*CELL, "source")


#: A 10 x 10 raster for each tile.
_GRID = f"""{_ASSETS}, p AS (SELECT tile_id, pixel // 10 AS row, pixel % 10 AS col, arg_max(v, s) FILTER (WHERE v IS NOT NULL) AS v FROM a GROUP BY tile_id, pixel)"""
_TARGET = "t AS (SELECT tile_id, r.k AS row, c.k AS col FROM (SELECT DISTINCT tile_id FROM p), range(13) r(k), range(13) c(k))"


def raster(spark, d):
    m = mosaic.mosaic(pixel_assets(spark, d), CELL, F.col("asset_seq"))
    return m.select("tile_id", F.floor(F.col("pixel") / 10).cast("int").alias("row"), (F.col("pixel") % 10).alias("col"), "v")


@query(f"""WITH {_GRID}, {_TARGET} SELECT tile_id, t.row::INT AS row, t.col::INT AS col, v FROM t JOIN p USING (tile_id)
WHERE p.row = floor((t.row + 0.5) * 0.75) AND p.col = floor((t.col + 0.5) * 0.75)""")
def resample_nearest(spark, d):
    return mosaic.resample_nearest(raster(spark, d), ["tile_id"], 0.75, 13, 13)


@query(f"""WITH {_GRID}, {_TARGET}, w AS (SELECT tile_id, t.row, t.col, v, greatest(0, 1 - abs((t.row + 0.5) * 0.75 - 0.5 - p.row)) * greatest(0, 1 - abs((t.col + 0.5) * 0.75 - 0.5 - p.col)) AS w
  FROM t JOIN p USING (tile_id) WHERE v IS NOT NULL)
SELECT tile_id, row::INT AS row, col::INT AS col, round(sum(v * w) / sum(w) + 1e-7, 3) AS v FROM w WHERE w > 0 GROUP BY tile_id, row, col""")
def resample_bilinear(spark, d):
    out = mosaic.resample_bilinear(raster(spark, d), ["tile_id"], 0.75, 13, 13)
    return out.withColumn("v", F.round(F.col("v") + 1e-7, 3))


@query(f"""WITH {_GRID} SELECT tile_id, (row // 2)::INT AS row, (col // 2)::INT AS col, round(avg(v) + 1e-7, 4) AS average, min(v) AS least, median(v) AS mid FROM p GROUP BY tile_id, row // 2, col // 2""")
def resample_block(spark, d):
    key, made = ["tile_id", "row", "col"], [mosaic.resample_block(raster(spark, d), ["tile_id"], 2, h).withColumnRenamed("v", h) for h in ("average", "min", "med")]
    out = made[0].join(made[1], key).join(made[2], key)
    return out.select(*key, F.round(F.col("average") + 1e-7, 4).alias("average"), F.col("min").alias("least"), F.col("med").alias("mid"))


@query(f"""WITH {_GRID}, {_TARGET.replace("range(13)", "range(12)")} SELECT tile_id, row::INT AS row, col::INT AS col, v FROM t LEFT JOIN p USING (tile_id, row, col)
WHERE (tile_id, row // 4, col // 4) IN (SELECT (tile_id, row // 4, col // 4) FROM p)""")
def block_round_trip(spark, d):
    return mosaic.to_pixels(mosaic.to_blocks(raster(spark, d), ["tile_id"], 4), ["tile_id"], 4)


@query(f"""WITH {OBS}, n AS (SELECT tile_id, pixel, scene_date, q, v, CASE WHEN pixel % 17 <> 0 THEN v END AS w FROM obs)
SELECT tile_id, pixel, scene_date, CASE WHEN q IS NULL THEN NULL WHEN v IS NULL OR w IS NULL THEN 1 ELSE q END AS q FROM n""")
def quality_repair(spark, d):
    rows = observations(spark, d).withColumn("w", F.when(F.col("pixel") % 17 != 0, F.col("v")))
    return composite.repair_quality(rows, CELL, ["v", "w"], "q", F.lit(1)).select(*CELL, "scene_date", "q")


@query("""SELECT l_orderkey, l_linenumber, trunc(least(greatest(trunc(0) + least(greatest(l_partkey::DOUBLE * 2.75e-5 + -0.2, -32768), 32767) / 0.0001, -32768), 32767))::BIGINT AS v FROM lineitem""")
def rescale_clamp(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", expressions.rescale(F.col("l_partkey"), 2.75e-5, -0.2, 1e-4).alias("v"))


@query("""SELECT o_orderkey, round((least(greatest(o_totalprice, 1000), 100000) - 1000) / 99000 * 255 + 1e-7, 4) AS v FROM orders""")
def linear_scale(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.round(expressions.linear_scale(F.col("o_totalprice"), 1000, 100000) + 1e-7, 4).alias("v"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 0 THEN trunc(least(greatest(o_totalprice / 200000.0::DOUBLE * 255, 0), 255)) ELSE 0 END::BIGINT AS v FROM orders""")
def quicklook_scale(spark, d):
    return table(spark, d, "orders").select("o_orderkey", expressions.quicklook(F.col("o_totalprice"), 200000.0).alias("v"))


_BANDS = "floor(l_extendedprice) % 10000 AS nir, floor(l_quantity) * 50 AS red, floor(l_discount * 1000) AS blue"


def band_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.floor("l_extendedprice") % 10000).cast("double").alias("nir"), (F.floor("l_quantity") * 50).cast("double").alias("red"), F.floor(F.col("l_discount") * 1000).cast("double").alias("blue"))


@query(f"""WITH b AS (SELECT l_orderkey, l_linenumber, {_BANDS} FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN nir + red <> 0 THEN trunc(least(greatest(10000.0::DOUBLE * ((nir - red) / nullif(nir + red, 0)), -32768), 32767)) END::BIGINT AS ndvi FROM b""")
def index_ndvi(spark, d):
    rows = band_rows(spark, d)
    return rows.select("l_orderkey", "l_linenumber", expressions.index_band(expressions.NDVI, {c: F.col(c) for c in ("nir", "red", "blue")}).alias("ndvi"))


@query(f"""WITH b AS (SELECT l_orderkey, l_linenumber, {_BANDS} FROM lineitem), e AS (SELECT *, 10000.0::DOUBLE * 2.5::DOUBLE * (nir - red) / nullif(nir + 6.0::DOUBLE * red - 7.5::DOUBLE * blue + 10000.0::DOUBLE, 0) AS x FROM b)
SELECT l_orderkey, l_linenumber, CASE WHEN x IS NOT NULL THEN trunc(least(greatest(x, -32768), 32767)) END::BIGINT AS evi FROM e""")
def index_evi(spark, d):
    rows = band_rows(spark, d)
    return rows.select("l_orderkey", "l_linenumber", expressions.index_band(expressions.EVI, {c: F.col(c) for c in ("nir", "red", "blue")}).alias("evi"))


@query("""WITH x AS (SELECT o_orderkey, 'S2' || CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'b' END || '_MSIL2A_' || strftime(o_orderdate, '%Y%m%d') || 'T101112_N0' || lpad((o_custkey % 500)::VARCHAR, 3, '0') || '_R037_T' ||
  CASE WHEN o_orderkey % 5 = 0 THEN '22K' ELSE '22KBA' END || '_' || strftime(o_orderdate, '%Y%m%d') || 'T232323' AS id FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN upper(substr(id, 1, 3)) END AS mission, CASE WHEN o_orderkey % 5 <> 0 THEN 'L2A' END AS level, CASE WHEN o_orderkey % 5 <> 0 THEN '22KBA' END AS tile,
  CASE WHEN o_orderkey % 5 <> 0 THEN substr(id, 29, 2)::INT END AS major, CASE WHEN o_orderkey % 5 <> 0 THEN substr(id, 31, 2)::INT END AS minor FROM x""")
def sentinel_id_parse(spark, d):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    sat, tile = F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("b"), F.when(F.col("o_orderkey") % 5 == 0, "22K").otherwise("22KBA")
    name = F.concat(F.lit("S2"), sat, F.lit("_MSIL2A_"), day, F.lit("T101112_N0"), F.lpad((F.col("o_custkey") % 500).cast("string"), 3, "0"), F.lit("_R037_T"), tile, F.lit("_"), day, F.lit("T232323"))
    parts = identifiers.parse_product(name)
    major, minor = identifiers.baseline(parts["baseline"])
    return table(spark, d, "orders").select("o_orderkey", parts["mission"].alias("mission"), parts["level"].alias("level"), parts["tile"].alias("tile"), major.alias("major"), minor.alias("minor"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, floor(l_extendedprice)::BIGINT AS v, (l_suppkey % 8)::INT AS major, CASE WHEN l_linenumber = 3 THEN 'SCL' ELSE 'B04' END AS band FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN major >= 4 AND band <> 'SCL' THEN CASE WHEN v - 1000 >= 0 THEN v - 1000 END ELSE v END AS v FROM x""")
def sentinel_offset(spark, d):
    band = F.when(F.col("l_linenumber") == 3, "SCL").otherwise("B04")
    v = identifiers.offset_value(F.floor("l_extendedprice"), (F.col("l_suppkey") % 8).cast("int"), band)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.alias("v"))


@query(f"""WITH x AS (SELECT o_orderkey, o_custkey % 10 AS n FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 AND n IN (4, 5, 7, 8, 9) THEN 'Landsat-' || n::VARCHAR END AS platform FROM x""")
def landsat_platform(spark, d):
    name = F.concat(F.lit("LC0"), (F.col("o_custkey") % 10).cast("string"), F.lit("_L1TP_"), F.col("o_orderkey").cast("string"), F.lit("_20200101_20200102_01"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("_T1"))
    return table(spark, d, "orders").select("o_orderkey", identifiers.landsat_platform(name).alias("platform"))


@query("""SELECT o_orderkey, upper(o_orderstatus || 'cube') || '_V2_' || lpad((o_custkey % 1000)::VARCHAR, 6, '0') || '_' || strftime(o_orderdate, '%Y%m%d') AS item,
  'data/composed/' || lower(o_orderstatus || 'cube') || '/v2/' || '000/' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') || strftime(o_orderdate, '/%Y/%m/%d/') || upper(o_orderstatus || 'cube') || '_V2_' || lpad((o_custkey % 1000)::VARCHAR, 6, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '_B1.tif' AS path FROM orders""")
def item_id_format(spark, d):
    cube, tile, day = F.concat("o_orderstatus", F.lit("cube")), F.lpad((F.col("o_custkey") % 1000).cast("string"), 6, "0"), F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", identifiers.item_id(cube, F.lit(2), tile, day).alias("item"), identifiers.asset_path("data", cube, F.lit(2), tile, day, F.lit("B1")).alias("path"))


@query("""SELECT page_id, CASE WHEN contains(url, '.SAFE') THEN regexp_extract(url, '([^/]+\\.SAFE)', 1) ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) END AS file,
  CASE WHEN lower(url) LIKE '%.zip' THEN 'zip' WHEN regexp_matches(lower(url), '\\.tar(\\.gz)?$') THEN 'tar' ELSE 'plain' END AS reader FROM pages""")
def reader_dispatch(spark, d):
    name = identifiers.file_name(F.col("url"))
    return table(spark, d, "pages").select("page_id", name.alias("file"), identifiers.reader_kind(F.col("url"), name).alias("reader"))


@query("""SELECT p_partkey, CASE WHEN length(b) = 2 THEN 'B0' || substr(b, 2) ELSE b END AS band, CASE WHEN b IN ('B2', 'B3', 'B4', 'B8') THEN 0 WHEN b IN ('B5', 'B6', 'B7', 'B11', 'B12') THEN 1 WHEN b IN ('B1', 'B9', 'B10') THEN 2 END AS grp
FROM (SELECT p_partkey, 'B' || (p_size % 14)::VARCHAR AS b FROM part)""")
def band_groups(spark, d):
    b = F.concat(F.lit("B"), (F.col("p_size") % 14).cast("string"))
    return table(spark, d, "part").select("p_partkey", identifiers.canonical_band(b).alias("band"), identifiers.band_group(b).alias("grp"))


@query("""SELECT p_partkey, 'x/' || upper(p_brand) || '/' || lower(p_type) || '-' || upper(p_name[1]) || lower(substr(p_name, 2)) AS filled, p_size % 2 = 0 AS truth FROM part""")
def template_fill(spark, d):
    filled = identifiers.fill_template("x/{brand:upper}/{kind:lower}-{name:capitalize}", {"brand": F.col("p_brand"), "kind": F.col("p_type"), "name": F.col("p_name")})
    words = F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("off")
    return table(spark, d, "part").select("p_partkey", filled.alias("filled"), identifiers.truth(words).alias("truth"))


def _periods(sql: str) -> str:
    return f"SELECT ps::DATE AS period_start, pe::DATE AS period_end FROM ({sql})"


@query(_periods("SELECT ps, ps + INTERVAL 1 MONTH - INTERVAL 1 DAY AS pe FROM range(DATE '2020-01-01', DATE '2021-01-01', INTERVAL 1 MONTH) r(ps)"))
def timeline_month(spark, d):
    return timeline.timeline(spark, timeline.Schema("continuous", "month"), dt.date(2020, 1, 1), dt.date(2020, 12, 31))


@query(_periods("SELECT ps, ps + INTERVAL 15 DAY AS pe FROM range(DATE '2020-06-12', DATE '2021-01-01', INTERVAL 16 DAY) r(ps)"))
def timeline_16d(spark, d):
    return timeline.timeline(spark, timeline.Schema("continuous", "day", 16), dt.date(2020, 6, 12), dt.date(2020, 12, 31))


@query(_periods("SELECT ps, least(ps + INTERVAL 15 DAY, DATE '2020-12-31') AS pe FROM range(DATE '2020-01-01', DATE '2021-01-01', INTERVAL 16 DAY) r(ps) WHERE ps >= DATE '2020-06-15'"))
def timeline_cyclic_16d(spark, d):
    return timeline.timeline(spark, timeline.Schema("cyclic", "day", 16, ("year", 1)), dt.date(2020, 6, 15), dt.date(2020, 12, 31))


@query(_periods("""SELECT make_date(y, a, 21) AS ps, make_date(y + (b < a)::INT, b, 20) AS pe FROM range(2019, 2022) r(y), (VALUES (12, 3), (3, 6), (6, 9), (9, 12)) v(a, b)
WHERE make_date(y + (b < a)::INT, b, 20) >= DATE '2020-01-01' AND make_date(y, a, 21) <= DATE '2020-12-31'"""))
def timeline_seasons(spark, d):
    names = ("12-21_03-20", "03-21_06-20", "06-21_09-20", "09-21_12-20")
    return timeline.timeline(spark, timeline.Schema("cyclic", "month", 1, ("year", 1), names), dt.date(2020, 1, 1), dt.date(2020, 12, 31))


@query("""WITH x AS (SELECT DISTINCT o_custkey % 50 AS g, o_orderdate::DATE AS date FROM orders), m AS (SELECT *, min(date) OVER (PARTITION BY g) AS m FROM x)
SELECT g, date, row_number() OVER (PARTITION BY g ORDER BY abs(date_diff('day', m + 14, date)), date)::INT AS priority FROM m""")
def temporal_priority(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("g"), F.col("o_orderdate").cast("date").alias("date")).distinct()
    return timeline.temporal_priority(rows, 15, group=("g",))


@query("""WITH p AS (SELECT ps::DATE AS ps, (ps + INTERVAL 15 DAY)::DATE AS pe FROM range(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 16 DAY) r(ps))
SELECT ps AS period_start, event_type, count(*) AS n FROM events JOIN p ON ts::DATE BETWEEN ps AND pe GROUP BY ALL""")
def period_bucket_join(spark, d):
    periods = timeline.timeline(spark, timeline.Schema("continuous", "day", 16), dt.date(2024, 1, 1), dt.date(2024, 2, 9))
    rows = table(spark, d, "events").withColumn("date", F.col("ts").cast("date"))
    return timeline.in_period(rows, periods).groupBy("period_start", "event_type").agg(F.count("*").alias("n"))


_MONTHS = "ps AS (SELECT ps::DATE AS s FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 MONTH) r(ps))"


@query(f"""WITH {_MONTHS}, k AS (SELECT DISTINCT l_suppkey % 100 AS tile, date_trunc('month', l_shipdate)::DATE AS s FROM lineitem), g AS (SELECT DISTINCT tile FROM k)
SELECT tile, s AS period_start FROM g, ps WHERE (tile, s) NOT IN (SELECT (tile, s) FROM k)""")
def missing_instants(spark, d):
    periods = timeline.timeline(spark, timeline.Schema("continuous", "month"), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    known = table(spark, d, "lineitem").select((F.col("l_suppkey") % 100).alias("tile"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("period_start")).distinct()
    return timeline.missing_instants(known, periods)


_TILES = """tl AS (SELECT lpad(ix::VARCHAR, 3, '0') || lpad(iy::VARCHAR, 3, '0') AS tile, ix::INT AS ix, iy::INT AS iy, -60.0::DOUBLE + ix * 2.5::DOUBLE AS xmin, 5.0::DOUBLE - iy * 2.0::DOUBLE - 2.0::DOUBLE AS ymin,
  -60.0::DOUBLE + ix * 2.5::DOUBLE + 2.5::DOUBLE AS xmax, 5.0::DOUBLE - iy * 2.0::DOUBLE AS ymax FROM range(0, 9) a(ix), range(0, 13) b(iy))"""


def tiles(spark):
    return grid.enumerate_tiles(spark, (-60.0, 5.0), (2.5, 2.0), (-60.0, -20.0, -40.0, 5.0), 4326)


@query(f"""WITH {_TILES} SELECT tile, ix, iy, xmin, ymin, xmax, ymax, 4326 AS srid FROM tl""")
def tile_grid(spark, d):
    return tiles(spark)


_ORDER_BOX = "(-60 + o_custkey % 200 / 10.0::DOUBLE) AS bx, (-20 + o_orderkey % 240 / 10.0::DOUBLE) AS by_"


@query(f"""WITH {_TILES}, b AS (SELECT o_orderkey, {_ORDER_BOX} FROM orders)
SELECT tile, count(*) AS n FROM b JOIN tl ON bx <= xmax AND xmin <= bx + 0.7::DOUBLE AND by_ <= ymax AND ymin <= by_ + 0.7::DOUBLE GROUP BY tile""")
def bbox_intersects(spark, d):
    x, y = F.lit(-60) + F.col("o_custkey") % 200 / 10.0, F.lit(-20) + F.col("o_orderkey") % 240 / 10.0
    boxes = table(spark, d, "orders").select("o_orderkey", x.alias("bx0"), y.alias("by0"), (x + 0.7).alias("bx1"), (y + 0.7).alias("by1"))
    return grid.box_join(boxes, tiles(spark), ("bx0", "by0", "bx1", "by1"), ("xmin", "ymin", "xmax", "ymax"), 2.5).groupBy("tile").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, round(6371007.181::DOUBLE * radians(lon + 54) * cos(radians(lat)), 2) AS x, round(6371007.181::DOUBLE * radians(lat), 2) AS y
FROM (SELECT c_custkey, -70 + c_custkey % 300 / 10.0::DOUBLE AS lon, -30 + c_custkey % 370 / 10.0::DOUBLE AS lat FROM customer)""")
def project_sinusoidal(spark, d):
    lon, lat = F.lit(-70) + F.col("c_custkey") % 300 / 10.0, F.lit(-30) + F.col("c_custkey") % 370 / 10.0
    x, y = grid.sinusoidal(lon, lat, -54)
    return table(spark, d, "customer").select("c_custkey", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


#: The projection from its definition: m and q at the two standard parallels and at the origin.
_Q = "((1 - e2) * (sin({b}) / (1 - e2 * sin({b}) ** 2) - ln((1 - sqrt(e2) * sin({b})) / (1 + sqrt(e2) * sin({b}))) / (2 * sqrt(e2))))"
_M2 = "(cos({b}) ** 2 / (1 - e2 * sin({b}) ** 2))"


@query(f"""WITH k AS (SELECT 2 / 298.257222101::DOUBLE - 1 / 298.257222101::DOUBLE ** 2 AS e2, radians(-2) AS b1, radians(-22) AS b2, radians(-12) AS b0, 6378137.0::DOUBLE AS a),
c AS (SELECT *, ({_M2.format(b="b1")} - {_M2.format(b="b2")}) / ({_Q.format(b="b2")} - {_Q.format(b="b1")}) AS n FROM k), g AS (SELECT *, {_M2.format(b="b1")} + n * {_Q.format(b="b1")} AS cc FROM c),
p AS (SELECT c_custkey, -70 + c_custkey % 300 / 10.0::DOUBLE AS lon, radians(-30 + c_custkey % 370 / 10.0::DOUBLE) AS lat FROM customer),
r AS (SELECT c_custkey, n * radians(lon + 54) AS theta, a * sqrt(cc - n * {_Q.format(b="lat")}) / n AS rho, a * sqrt(cc - n * {_Q.format(b="b0")}) / n AS rho0 FROM p, g)
SELECT c_custkey, round(5000000 + rho * sin(theta), 2) AS x, round(10000000 + rho0 - rho * cos(theta), 2) AS y FROM r""")
def project_albers(spark, d):
    lon, lat = F.lit(-70) + F.col("c_custkey") % 300 / 10.0, F.lit(-30) + F.col("c_custkey") % 370 / 10.0
    x, y = grid.albers(lon, lat, -54)
    return table(spark, d, "customer").select("c_custkey", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query("""SELECT s_suppkey, round_even(dx / 30, 0)::BIGINT AS cols, floor(dx / 30)::BIGINT AS native_cols, round(dx / round_even(dx / 30, 0), 6) AS eff_x FROM (SELECT s_suppkey, 168000 + s_suppkey * 7.5::DOUBLE AS dx FROM supplier)""")
def target_shape(spark, d):
    dx = F.lit(168000) + F.col("s_suppkey") * 7.5
    a, b = grid.target_shape(dx, dx, F.lit(30.0), F.lit(30.0)), grid.target_shape(dx, dx, F.lit(30.0), F.lit(30.0), truncate=True)
    return table(spark, d, "supplier").select("s_suppkey", a["cols"].alias("cols"), b["cols"].alias("native_cols"), F.round(a["eff_x"], 6).alias("eff_x"))


@query("""SELECT tile FROM (SELECT DISTINCT 'T' || (n_nationkey % 30)::VARCHAR AS tile FROM nation) WHERE tile NOT IN (SELECT 'T' || (r_regionkey * 3)::VARCHAR FROM region)""")
def unknown_tiles(spark, d):
    name = lambda c: F.concat(F.lit("T"), c.cast("string")).alias("tile")
    return grid.unknown_tiles(table(spark, d, "nation").select(name(F.col("n_nationkey") % 30)), table(spark, d, "region").select(name(F.col("r_regionkey") * 3)))


@query()
def footprint_hull(spark, d):
    valid = raster(spark, d).where((F.col("v") > 2000) & (F.col("row") + F.col("col") > 3))
    return grid.convex_hull(valid, ["tile_id"])


def catalogue(spark, d):
    """Items: (id, cube, tile, name, start_date, end_date, collection, status, box)."""
    day = F.col("o_orderdate").cast("date")
    x, y = F.lit(-60) + F.col("o_custkey") % 200 / 10.0, F.lit(-20) + F.col("o_orderkey") % 240 / 10.0
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("collection"), (F.col("o_custkey") % 40).alias("tile"), F.concat(F.lit("I"), F.col("o_orderkey").cast("string")).alias("name"),
        day.alias("start_date"), F.date_add(day, 15).alias("end_date"), F.col("o_orderstatus").alias("status"), x.alias("xmin"), y.alias("ymin"), (x + 0.7).alias("xmax"), (y + 0.7).alias("ymax"),
    )
    return rows


_ITEMS = f"""it AS (SELECT o_orderkey AS id, o_orderpriority AS collection, o_custkey % 40 AS tile, 'I' || o_orderkey::VARCHAR AS name, o_orderdate::DATE AS start_date, o_orderdate::DATE + 15 AS end_date, o_orderstatus AS status,
  bx AS xmin, by_ AS ymin, bx + 0.7::DOUBLE AS xmax, by_ + 0.7::DOUBLE AS ymax FROM (SELECT *, {_ORDER_BOX} FROM orders))"""
_TOUCH = "xmin <= -45 AND xmax >= -55 AND ymin <= 0 AND ymax >= -10"


@query(f"""WITH {_ITEMS} SELECT id, tile, name, start_date FROM it WHERE tile IN (1, 2, 3, 4, 5) AND start_date >= DATE '1995-06-01' AND {_TOUCH} ORDER BY start_date DESC, tile, name LIMIT 20 OFFSET 20""")
def items_page(spark, d):
    return catalog.items_page(catalogue(spark, d), 2, 20, [1, 2, 3, 4, 5], "1995-06-01", None, (-55, -10, -45, 0)).select("id", "tile", "name", "start_date")


@query(f"""WITH {_ITEMS} SELECT id, collection, tile, start_date FROM it WHERE collection IN ('1-URGENT', '2-HIGH') AND start_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' AND {_TOUCH}""")
def catalog_search(spark, d):
    rows = catalogue(spark, d).withColumnRenamed("start_date", "date")
    return catalog.search(rows, ["1-URGENT", "2-HIGH"], "1995-01-01", "1997-12-31", (-55, -10, -45, 0)).select("id", "collection", "tile", F.col("date").alias("start_date"))


@query("""SELECT count(*) AS total, 20 AS per_page, ceil(count(*) / 20.0)::BIGINT AS pages FROM orders""")
def items_count(spark, d):
    return catalog.page_counts(catalogue(spark, d), 20)


@query("""SELECT p_partkey AS id, p_name AS name FROM part WHERE p_size % 3 IN (0, 1) AND contains(p_name, 'a') AND p_size % 2 = 0""")
def list_cubes_like(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("cube", "mosaic", "collection"))), (F.col("p_size") % 3 + 1).cast("int"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), kind.alias("kind"), (F.col("p_size") % 2 == 0).alias("is_public"))
    return catalog.list_cubes(rows, "a", public=True).select("id", "name")


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS id, c_custkey // 3 AS source FROM customer WHERE c_custkey // 3 > 0), up AS (SELECT id, source AS ancestor, 1 AS depth FROM e UNION ALL SELECT up.id, e.source, depth + 1 FROM up JOIN e ON up.ancestor = e.id)
SELECT id, ancestor, depth FROM up""")
def lineage_recursive(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.floor(F.col("c_custkey") / 3).alias("source")).where("source > 0")
    return catalog.lineage(rows, rows.select("id").distinct())


@query(f"""WITH {_ITEMS} SELECT tile, arg_min(xmin, id) AS xmin, arg_min(ymin, id) AS ymin FROM it GROUP BY tile""")
def distinct_on_tile(spark, d):
    return catalog.one_per_tile(catalogue(spark, d), ["xmin", "ymin"])


@query(f"""WITH {_ITEMS} SELECT collection, min(start_date) AS first_date, max(end_date) AS last_date FROM it GROUP BY collection""")
def min_max_dates(spark, d):
    return catalog.date_range(catalogue(spark, d), ["collection"])


@query(f"""WITH {_ITEMS} SELECT tile, array_to_string(list_sort(list(DISTINCT start_date::VARCHAR)), ',') AS timeline, count(DISTINCT start_date) AS total FROM it GROUP BY tile""")
def timeline_collect(spark, d):
    return catalog.tile_timelines(catalogue(spark, d)).withColumn("timeline", F.array_join(F.col("timeline").cast("array<string>"), ","))


@query(f"""WITH {_ITEMS} SELECT collection, count(*) AS total, count(*) FILTER (WHERE status = 'F') AS success, count(*) FILTER (WHERE status = 'P') AS failure, count(*) FILTER (WHERE status = 'O') AS started,
  count(*) FILTER (WHERE status IN ('F', 'P')) = count(*) AS finished FROM it GROUP BY collection""")
def activity_status(spark, d):
    names = F.when(F.col("status") == "F", "SUCCESS").when(F.col("status") == "P", "FAILURE").when(F.col("status") == "O", "STARTED")
    return catalog.activity_status(catalogue(spark, d).withColumn("status", names), ["collection"])


@query("""SELECT event_id, (props->>'k')::INT AS k, u.b AS band, 'http://x/' || u.b || '/' || event_id::VARCHAR AS link FROM events, (VALUES ('red'), ('nir')) u(b)""")
def asset_explode(spark, d):
    link = lambda b: F.concat(F.lit(f"http://x/{b}/"), F.col("event_id").cast("string"))
    args = F.to_json(F.struct(F.array(*[F.struct(link(b).alias("link"), F.lit(b).alias("band"), F.lit("d").alias("dataset")) for b in ("red", "nir")]).alias("assets")))
    rows = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), args.alias("args"))
    return catalog.activity_assets(rows).select("event_id", "k", "band", "link")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN CASE WHEN p_size % 8 = 0 THEN 'SR_B4' END WHEN p_size % 4 = 1 THEN 'red' WHEN p_size % 4 = 2 THEN 'B4.TIF' ELSE 'sr_B4' END AS asset FROM part""")
def band_resolution(spark, d):
    k = F.col("p_size") % 4
    dataset = F.when(k == 1, "CBERS4").otherwise("LC8")
    held = F.when(k == 1, F.array(F.lit("red"), F.lit("B4"))).when(k == 2, F.array(F.lit("B4.TIF"), F.lit("sr_B4"))).otherwise(F.array(F.lit("sr_B4")))
    found = catalog.asset_name(F.lit("B4"), F.lit("red"), dataset, F.when(F.col("p_size") % 8 == 0, "SR_B4"), k == 0, held)
    return table(spark, d, "part").select("p_partkey", found.alias("asset"))


@query("""SELECT o_orderdate::DATE AS date, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS collections, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_errors, arg_min('e' || o_orderkey::VARCHAR, o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS first_error, array_to_string(list_sort(list(o_orderkey::VARCHAR)), ',') AS links FROM orders GROUP BY 1""")
def merge_audit(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("date"), F.lit("red").alias("band"), F.col("o_orderkey").cast("string").alias("link"), F.col("o_orderpriority").alias("collection"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))).alias("error"),
    )
    return catalog.merge_report(rows).select("date", F.array_join("collections", ",").alias("collections"), "n_errors", "first_error", F.array_join(F.col("links")["red"], ",").alias("links"))


@query(f"""WITH {_MONTHS}, g AS (SELECT DISTINCT l_suppkey % 20 AS tile FROM lineitem), sc AS (SELECT l_suppkey % 20 AS tile, date_trunc('month', l_shipdate)::DATE AS s, min(l_shipdate)::DATE AS date, count(*)::DOUBLE AS efficacy, 5.0::DOUBLE AS cloud FROM lineitem GROUP BY 1, 2)
SELECT tile, s AS period_start, coalesce(date, s) AS date, coalesce(efficacy, 100) AS efficacy, coalesce(cloud, 0) AS cloud, date IS NULL AS empty FROM (SELECT * FROM g, ps) LEFT JOIN sc USING (tile, s)""")
def empty_period_fill(spark, d):
    rows = table(spark, d, "lineitem").withColumn("tile", F.col("l_suppkey") % 20).withColumn("day", F.col("l_shipdate").cast("date"))
    periods = timeline.timeline(spark, timeline.Schema("continuous", "month"), dt.date(1995, 1, 1), dt.date(2001, 12, 31)).select("period_start")
    listed = periods.groupBy().agg(F.collect_set("period_start").alias("all"))
    wanted = rows.select("tile").distinct().join(listed, F.lit(True)).select("tile", F.explode("all").alias("period_start"))
    scenes = rows.groupBy("tile", F.trunc("day", "MM").alias("period_start")).agg(F.min("day").alias("date"), F.count("*").cast("double").alias("efficacy"), F.lit(5.0).alias("cloud"))
    return mosaic.fill_empty_periods(wanted, scenes, ["tile", "period_start"])


@query("""SELECT o_orderkey AS id, o_custkey % 40 AS tile FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def reuse_antijoin(spark, d):
    done = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return mosaic.still_to_do(catalogue(spark, d).select("id", "tile"), done, ["id"])


@query("""SELECT l_orderkey, count(DISTINCT l_linenumber % 3) AS n_bands FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber % 3) < 3""")
def inconsistent_bands(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).alias("band"))
    return mosaic.inconsistent_bands(rows, ["l_orderkey"], [0, 1, 2])


@query("""WITH n AS (SELECT o_custkey AS k, max(o_orderdate) AS w FROM orders GROUP BY 1), c AS (SELECT c_custkey AS k, TIMESTAMP '1998-01-01' AS w FROM customer)
SELECT k, arg_max(src, struct_pack(a := w, b := p)) AS src FROM (SELECT k, w, 'new' AS src, 1 AS p FROM n UNION ALL SELECT k, w, 'old', 0 FROM c) GROUP BY k""")
def upsert_items(spark, d):
    news = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max(F.col("o_orderdate").cast("timestamp")).alias("at")).withColumn("src", F.lit("new"))
    now = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("1998-01-01").cast("timestamp").alias("at"), F.lit("old").alias("src"))
    return catalog.upsert(now, news, ["k"], "at").select("k", "src")


@query("""WITH x AS (SELECT o_orderpriority AS collection, o_orderstatus AS p FROM orders UNION SELECT o_orderpriority, 'K' FROM orders) SELECT collection, array_to_string(list_sort(list(DISTINCT p)), ',') AS platforms FROM x GROUP BY collection""")
def platform_union(spark, d):
    seen = table(spark, d, "orders").select(F.col("o_orderpriority").alias("collection"), F.col("o_orderstatus").alias("platform"))
    known = seen.select("collection", F.lit("K").alias("platform")).distinct()
    return catalog.platforms(seen, known).select("collection", F.array_join("platforms", ",").alias("platforms"))


def _shares(col: str, value: str) -> str:
    return f"{col} AS (SELECT tile_id, x, sum(n) OVER (PARTITION BY tile_id ORDER BY x) / sum(n) OVER (PARTITION BY tile_id) AS p FROM (SELECT tile_id, {value}::DOUBLE AS x, count(*)::DOUBLE AS n FROM b WHERE s IS NOT NULL AND r IS NOT NULL GROUP BY ALL))"


@query(f"""WITH {OBS}, b AS (SELECT tile_id, pixel, scene_date, v // 500 AS s, CASE WHEN pixel % 9 <> 0 THEN (v * 3 + pixel * 7) % 6000 // 400 END AS r FROM obs), {_shares("sc", "s")}, {_shares("rc", "r")},
m AS (SELECT sc.tile_id, sc.x, sc.p, arg_max(struct_pack(p := rc.p, x := rc.x), rc.p) FILTER (WHERE rc.p <= sc.p) AS lo, arg_min(struct_pack(p := rc.p, x := rc.x), rc.p) FILTER (WHERE rc.p >= sc.p) AS hi FROM sc JOIN rc USING (tile_id) GROUP BY ALL),
k AS (SELECT tile_id, x, p, coalesce(lo, hi) AS lo, coalesce(hi, lo) AS hi FROM m)
SELECT tile_id, pixel, scene_date, CASE WHEN r IS NULL OR s IS NULL THEN s ELSE round_even(CASE WHEN hi.p > lo.p THEN lo.x + (hi.x - lo.x) * (p - lo.p) / (hi.p - lo.p) ELSE lo.x END, 0) END::BIGINT AS matched
FROM b LEFT JOIN k ON b.tile_id = k.tile_id AND b.s = k.x""".replace("SELECT tile_id, pixel, scene_date, CASE WHEN r IS", "SELECT b.tile_id, pixel, scene_date, CASE WHEN r IS"))
def histogram_match_lookup(spark, d):
    ref = F.when(F.col("pixel") % 9 != 0, F.floor((F.col("v") * 3 + F.col("pixel") * 7) % 6000 / 400))
    rows = observations(spark, d).select(*CELL, "scene_date", F.floor(F.col("v") / 500).alias("s"), ref.alias("r"))
    return composite.match_histograms(rows, ["tile_id"], "s", "r").select(*CELL, "scene_date", "matched")


@query(f"""WITH {_GRID} SELECT tile_id, (row // 2)::INT AS row, (col // 2)::INT AS col, v FROM p WHERE row % 2 = 1 AND col % 2 = 1""")
def quicklook_decimate(spark, d):
    return publish.decimate(raster(spark, d), ["tile_id"], 10, 5)


@query(f"""WITH {_GRID} SELECT tile_id, row::INT AS row, col::INT AS col, CASE WHEN v IS NOT NULL THEN floor(least(v, 5000) / 5000.0::DOUBLE * 255) END::BIGINT AS red, CASE WHEN v IS NOT NULL THEN floor(least(v // 2, 5000) / 5000.0::DOUBLE * 255) END::BIGINT AS green,
  CASE WHEN v IS NOT NULL THEN floor(least(v // 3, 5000) / 5000.0::DOUBLE * 255) END::BIGINT AS blue FROM p""")
def rgb_stack(spark, d):
    bands = F.explode(F.array(*[F.struct(F.lit(n).alias("band"), F.floor(F.col("v") / k).alias("w")) for k, n in ((1, "b1"), (2, "b2"), (3, "b3"))])).alias("x")
    rows = raster(spark, d).select("tile_id", "row", "col", bands).select("tile_id", "row", "col", "x.band", F.col("x.w").alias("v"))
    return publish.rgb_rows(rows, ["tile_id"], ("b1", "b2", "b3"), 0, 5000)


def demo_cube(function: str = "LCF") -> plans.Cube:
    bands = (plans.Band("nir", "nir"), plans.Band("red", "red"), plans.Band("quality", "quality", "uint8", 255))
    params = {"mask": {"clear_data": [0, 1], "not_clear_data": [2, 3, 4], "nodata": 255}}
    return plans.Cube("demo", 1, "g", function, timeline.Schema("continuous", "year"), bands, (plans.Band("NDVI", "ndvi", expression=expressions.NDVI),), "quality", params)


def cube_assets(spark, d):
    q, v = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") - 1), F.when(F.col("l_linenumber") != 6, (F.floor("l_extendedprice") % 10000).cast("int"))
    pixel = (F.col("l_partkey") % 100).cast("int")
    rows = table(spark, d, "lineitem")
    return rows.select(
        (F.col("l_suppkey") % 10).cast("string").alias("tile"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("date"), F.floor(pixel / 10).cast("int").alias("row"), (pixel % 10).alias("col"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey").alias("asset_seq"), v.alias("nir"), F.floor(F.col("l_quantity") * 50).cast("int").alias("red"), q.cast("int").alias("quality"),
    )


def _cube(b: str) -> str:
    own = f"(coalesce(quality IN (0, 1), false) OR NOT (quality IS NULL OR {b} IS NULL OR quality IN (2, 3, 4)))"
    return f"""f_{b} AS (SELECT tile, y, row, col, rank, {b} AS v, min(CASE WHEN {own} THEN rank END) OVER (PARTITION BY tile, y, row, col) AS i FROM h),
c_{b} AS (SELECT tile, y, row, col, arg_min(v, rank) FILTER (WHERE v IS NOT NULL AND rank >= coalesce(i, 1)) AS {b} FROM f_{b} GROUP BY ALL)"""


@query(f"""WITH a AS (SELECT (l_suppkey % 10)::VARCHAR AS tile, date_trunc('month', l_shipdate)::DATE AS date, (l_partkey % 100 // 10)::INT AS row, (l_partkey % 10)::INT AS col,
  row(l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax, l_partkey, l_suppkey) AS s, CASE WHEN l_linenumber <> 6 THEN floor(l_extendedprice)::BIGINT % 10000 END AS nir, floor(l_quantity * 50)::INT AS red, CASE WHEN l_linenumber <> 7 THEN l_linenumber - 1 END AS quality FROM lineitem),
m AS (SELECT tile, date, row, col, arg_max(nir, s) FILTER (WHERE nir IS NOT NULL) AS nir, arg_max(red, s) FILTER (WHERE red IS NOT NULL) AS red, arg_max(quality, s) FILTER (WHERE quality IS NOT NULL) AS quality FROM a GROUP BY ALL),
o AS (SELECT * REPLACE (CASE WHEN nir IS NULL OR red IS NULL THEN NULL ELSE quality END AS quality), year(date) AS y FROM m),
st AS (SELECT tile, y, date, {RATIO.format(p="count(*) FILTER (WHERE quality IN (0, 1))", w="count(*)", z="0.0")} AS e FROM o GROUP BY ALL),
rk AS (SELECT tile, y, date, row_number() OVER (PARTITION BY tile, y ORDER BY e DESC, date DESC) AS rank FROM st), h AS (SELECT o.*, rank FROM o JOIN rk USING (tile, y, date)),
{_cube("quality")}, {_cube("nir")}, {_cube("red")}, n AS (SELECT tile, y, row, col, count(*) FILTER (WHERE quality IN (0, 1) OR quality = 5) AS clearob, count(quality) AS totalob FROM h GROUP BY ALL)
SELECT tile, make_date(y, 1, 1) AS period_start, row, col, quality, nir::INT AS nir, red, clearob, totalob, CASE WHEN nir + red <> 0 THEN trunc(least(greatest(10000.0::DOUBLE * ((nir::DOUBLE - red) / nullif(nir::DOUBLE + red, 0)), -32768), 32767)) END::BIGINT AS "NDVI"
FROM c_quality JOIN c_nir USING (tile, y, row, col) JOIN c_red USING (tile, y, row, col) JOIN n USING (tile, y, row, col)""")
def cube_build(spark, d):
    cube = demo_cube()
    periods = timeline.timeline(spark, cube.schema, dt.date(1990, 1, 1), dt.date(2030, 12, 31))
    return plans.build(cube_assets(spark, d), periods, cube).drop("provenance")


@query("""SELECT page_id, 'SCENE' || page_id::VARCHAR AS item, CASE WHEN page_id % 3 = 0 THEN 'B04' WHEN page_id % 3 = 1 THEN 'B08' END AS band, (DATE '2020-01-01' + (page_id % 365)::INT) AS date FROM pages WHERE page_id % 3 < 2 AND page_id % 365 <= 181""")
def directory_scan(spark, d):
    fmt = directory.Format("demo", r"^SCENE\d+_", r"_(\d{8})_", "yyyyMMdd", {"B04": r"B04\.tif$", "B08": r"B08\.tif$"})
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") % 365).cast("int")), "yyyyMMdd")
    band = F.element_at(F.array(*map(F.lit, ("B04", "B08", "B99"))), (F.col("page_id") % 3 + 1).cast("int"))
    files = table(spark, d, "pages").select("page_id", F.concat(F.lit("file:/x/SCENE"), F.col("page_id").cast("string"), F.lit("_"), day, F.lit("_"), band, F.lit(".tif")).alias("path"))
    out = directory.scan(files, fmt, "2020-01-01", "2020-06-30")
    return out.select("page_id", F.regexp_extract(identifiers.file_name(F.col("path")), r"^[^_]+", 0).alias("item"), "band", "date")


from . import queries_build  # noqa: E402, F401  registers its queries too
