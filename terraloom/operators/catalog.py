"""Catalogue operators: search, band resolution, items, lineage, activities, reports. Metadata tables, never pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grid import box_intersects


def search(scenes: DataFrame, collections: list[str], start: str, end: str, box: tuple | None = None, box_cols: tuple = ("xmin", "ymin", "xmax", "ymax"), max_cloud: float | None = None) -> DataFrame:
    """Scenes of the collections within the dates (both inclusive), touching the box, at most so cloudy; all filters reach the scan."""
    out = scenes.where(F.col("collection").isin(collections) & (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") <= F.lit(end).cast("date")))
    if box is not None:
        out = out.where(box_intersects(box_cols, box))
    return out if max_cloud is None else out.where(F.col("cloud") <= max_cloud)


def scene_assets(items: DataFrame, assets: str = "assets") -> DataFrame:
    """One row for each item and asset of its map: ``asset`` and ``link``; the date is that of the item's timestamp."""
    return items.select(*[c for c in items.columns if c != assets], F.explode(assets).alias("asset", "link"))


def asset_name(band: Column, common_name: Column, dataset: Column, mapped: Column | None, has_map: Column, assets: Column) -> Column:
    """The asset key of a band: the platform's band map decides where there is one (unmapped: none); CBERS data sets go by common
    name except for indices; else the first of name, name.TIF and sr_name that the item has."""
    common = dataset.startswith("CBERS") & ~F.lower(common_name).isin("ndvi", "evi")
    found = F.coalesce(*[F.when(F.array_contains(assets, k), k) for k in (band, F.concat(band, F.lit(".TIF")), F.concat(F.lit("sr_"), band))])
    plain = F.when(common, F.when(F.array_contains(assets, common_name), common_name)).otherwise(found)
    return plain if mapped is None else F.when(has_map, mapped).otherwise(plain)


def rewrite_link(link: Column, old: str, new: str) -> Column:
    """Links that start with ``old`` start with ``new``."""
    return F.when(link.startswith(old), F.concat(F.lit(new), F.substring(link, F.lit(len(old) + 1), F.length(link)))).otherwise(link)


def spread_single_asset(items: DataFrame, bands: list[str], key: str) -> DataFrame:
    """Items whose one archive asset ``key`` serves all bands."""
    return items.withColumn("assets", F.map_from_arrays(F.array(*map(F.lit, bands)), F.array_repeat(F.col("assets")[key], len(bands))))


def items_page(items: DataFrame, page: int, per_page: int, tiles: list[str] | None = None, start: str | None = None, end: str | None = None, box: tuple | None = None) -> DataFrame:
    """One page of items, latest first (ties by tile and name): a top-k, not a full sort."""
    out = items
    if tiles:
        out = out.where(F.col("tile").isin(tiles))
    if start:
        out = out.where(F.col("start_date") >= F.lit(start).cast("date"))
    if end:
        out = out.where(F.col("end_date") <= F.lit(end).cast("date"))
    if box is not None:
        out = out.where(box_intersects(("xmin", "ymin", "xmax", "ymax"), box))
    return out.orderBy(F.desc("start_date"), "tile", "name").offset((page - 1) * per_page).limit(per_page)


def page_counts(items: DataFrame, per_page: int) -> DataFrame:
    n = items.agg(F.count("*").alias("total"))
    return n.select("total", F.lit(per_page).alias("per_page"), F.ceil(F.col("total") / per_page).cast("long").alias("pages"))


def list_cubes(cubes: DataFrame, name: str | None = None, kind: str | None = None, public: bool | None = None) -> DataFrame:
    """Cubes and mosaics, or one kind, by part of the name, in order of id."""
    out = cubes.where(F.col("kind").isin("cube", "mosaic") if kind is None else F.col("kind") == kind)
    if name:
        out = out.where(F.contains(F.col("name"), F.lit(name)))
    if public is not None:
        out = out.where(F.col("is_public") == public)
    return out.orderBy("id")


def lineage(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(id, ancestor, depth) up the edges (id, source), each ancestor once at its least depth, however deep; cycles end by themselves.

    Ancestors are doubled round by round (ancestors of ancestors), so a chain of n takes log n rounds. Edges are metadata.
    """
    spark = edges.sparkSession
    steps = edges.select("id", F.col("source").alias("ancestor")).where("id IS NOT NULL AND ancestor IS NOT NULL").distinct().withColumn("depth", F.lit(1))
    known = steps.checkpoint() if spark.sparkContext.getCheckpointDir() else steps.cache()
    n, total = -1, known.agg(F.count("*"), F.sum("depth")).first()
    while total != n:
        n = total
        further = known.alias("a").join(known.alias("b"), F.col("a.ancestor") == F.col("b.id")).select("a.id", "b.ancestor", (F.col("a.depth") + F.col("b.depth")).alias("depth"))
        then = known.union(further).groupBy("id", "ancestor").agg(F.min("depth").alias("depth"))
        then = then.checkpoint() if spark.sparkContext.getCheckpointDir() else then.cache()
        total = then.agg(F.count("*"), F.sum("depth")).first()
        known = then
    return known.join(start.select("id").distinct(), "id")


def first_ancestor(ancestors: DataFrame, cubes: DataFrame, function: str) -> DataFrame:
    """(id, ancestor): the nearest ancestor whose cube (id, function) has the function; ties to the lesser id."""
    of = cubes.where(F.col("function") == function).select(F.col("id").alias("ancestor"))
    return ancestors.join(of, "ancestor").groupBy("id").agg(F.min_by("ancestor", F.struct("depth", "ancestor")).alias("ancestor"))


def one_per_tile(items: DataFrame, keep: list[str], order: str = "id") -> DataFrame:
    """One row for each tile: that of the least ``order``."""
    best = items.groupBy("tile").agg(F.min_by(F.struct(*keep), order).alias("b"))
    return best.select("tile", *[F.col(f"b.{c}").alias(c) for c in keep])


def date_range(items: DataFrame, by: list[str]) -> DataFrame:
    return items.groupBy(*by).agg(F.min("start_date").alias("first_date"), F.max("end_date").alias("last_date"))


def tile_timelines(items: DataFrame) -> DataFrame:
    """(tile, timeline, total): the distinct starts of each tile in order; bounded by the timeline's length."""
    out = items.groupBy("tile").agg(F.sort_array(F.collect_set("start_date")).alias("timeline"))
    return out.withColumn("total", F.size("timeline").cast("long"))


def activity_assets(activities: DataFrame, args: str = "args") -> DataFrame:
    """Activities with one row for each asset of their JSON arguments."""
    listed = F.from_json(F.col(args), "assets array<struct<link:string,band:string,dataset:string>>")["assets"]
    return activities.withColumn("__a", F.explode(listed)).select(*activities.columns, "__a.link", "__a.band", "__a.dataset")


def activity_status(activities: DataFrame, by: list[str]) -> DataFrame:
    """Counts by state and whether all are done."""
    n = activities.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("SUCCESS", "FAILURE", "STARTED")])
    return n.withColumn("finished", F.col("success") + F.col("failure") == F.col("total"))


def merge_report(merges: DataFrame) -> DataFrame:
    """By date: links for each band, collections, number of errors and the error of the least id."""
    out = merges.groupBy("date").agg(
        F.sort_array(F.collect_set("collection")).alias("collections"), F.count("error").alias("n_errors"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("id"))).alias("first_error"),
    )
    links = merges.groupBy("date", "band").agg(F.sort_array(F.collect_set("link")).alias("l")).groupBy("date").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("band", "l")))).alias("links"))
    return out.join(links, "date")


def platforms(scenes: DataFrame, known: DataFrame) -> DataFrame:
    """(collection, platforms): those known and those seen."""
    both = known.select("collection", "platform").unionByName(scenes.select("collection", "platform"))
    return both.groupBy("collection").agg(F.sort_array(F.collect_set("platform")).alias("platforms"))


def first_by_band_date(activities: DataFrame, order: str = "id") -> DataFrame:
    """One activity for each band and date: the first."""
    rest = [c for c in activities.columns if c not in ("band", "date")]
    out = activities.groupBy("band", "date").agg(F.min_by(F.struct(*rest), order).alias("b"))
    return out.select("band", "date", *[F.col(f"b.{c}").alias(c) for c in rest])


def cube_detail(cubes: DataFrame, bands: DataFrame, items: DataFrame) -> DataFrame:
    """Cubes with their bands in order, first and last date and number of items."""
    listed = bands.groupBy("cube").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "band"))), lambda b: b["band"]).alias("bands"))
    span = items.groupBy("cube").agg(F.min("start_date").alias("first_date"), F.max("end_date").alias("last_date"), F.count("*").alias("n_items"))
    return cubes.join(listed, "cube", "left").join(span, "cube", "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)))


def bands_missing(composed: DataFrame, reused: DataFrame) -> DataFrame:
    """Bands that a cube needs but the reused one lacks; empty if it may be reused."""
    return composed.select("band").distinct().join(reused.select("band").distinct(), "band", "left_anti")


def upsert(current: DataFrame, news: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The rows of both with one row a key: the greatest version, the new row on ties."""
    both = current.withColumn("__new", F.lit(0)).unionByName(news.withColumn("__new", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc(version), F.desc("__new"))
    return both.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k", "__new")


def get_or_create(current: DataFrame, news: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` and the new rows whose key it lacks."""
    return current.unionByName(news.join(current.select(*keys).distinct(), keys, "left_anti"))


def geojson(tile: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A box as a GeoJSON feature."""
    ring = F.array(*[F.array(x, y) for x, y in ((xmin, ymax), (xmax, ymax), (xmax, ymin), (xmin, ymin), (xmin, ymax))])
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(tile.alias("name")).alias("properties"), shape.alias("geometry")))


def items_with_tiles(items: DataFrame, tiles: DataFrame) -> DataFrame:
    """Items with the columns of their tile; items of tiles that the grid lacks are left out."""
    return items.join(tiles, "tile")


def grids_with_reference(grids: DataFrame, references: DataFrame) -> DataFrame:
    """Grids (name, srid) with the projection text of their reference (srid, proj)."""
    return grids.join(references, "srid")


def cube_meta(cubes: DataFrame, parameters: DataFrame, activities: DataFrame) -> DataFrame:
    """Cubes with their stored parameters and, sorted, the data sets that their activities used."""
    used = activities.groupBy("cube").agg(F.sort_array(F.collect_set("dataset")).alias("datasets"))
    out = cubes.join(parameters, "cube", "left").join(used, "cube", "left")
    return out.withColumn("datasets", F.coalesce("datasets", F.array().cast("array<string>")))


def rfc3339(at: Column) -> Column:
    """A UTC timestamp as text."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def merged_assets(current: DataFrame, news: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Items of both: one row a key with the assets (a map) of both, the later version's winning, and its other columns."""
    both = current.unionByName(news)
    rest = [c for c in both.columns if c not in (*keys, "assets", version)]
    entries = both.select(*keys, version, F.explode("assets").alias("asset", "link")).groupBy(*keys, "asset").agg(F.max_by("link", version).alias("link"))
    maps = entries.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("asset", "link")))).alias("assets"))
    heads = both.groupBy(*keys).agg(F.max(version).alias(version), *[F.max_by(c, version).alias(c) for c in rest])
    return heads.join(maps, keys, "left")


def normalized_scenes(items: DataFrame, bands: DataFrame) -> DataFrame:
    """Search results (scene, dataset, datetime, assets) as (scene, dataset, date, band, link): the date is the timestamp text's
    first ten characters; only the assets that ``bands`` (asset, band) names. The bands are a platform's list and go whole to every
    task: joined by a shuffle, all links of one asset would meet in one task."""
    rows = items.select("scene", "dataset", F.substring("datetime", 1, 10).cast("date").alias("date"), F.explode("assets").alias("asset", "link"))
    return rows.join(F.broadcast(bands), "asset").select("scene", "dataset", "date", "band", "link")


def legacy_box(geometry_box: tuple, intersects: bool) -> dict:
    """The search of a catalogue that may lack the intersection test: such a catalogue is asked by box and without a query."""
    return {"intersects": geometry_box} if intersects else {"bbox": geometry_box}
