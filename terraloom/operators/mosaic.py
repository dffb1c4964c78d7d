"""From assets to one value per tile, date, band and pixel: resampling, mosaics, source index, reuse and empty periods.

Pixels are rows; null means nodata. Every mosaic is one hash aggregation by pixel with partial results before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESAMPLING = ("nearest", "bilinear", "average", "mode", "min", "max", "med", "sum")


def resampling_choice(is_quality: bool, explicit: str | None = None, has_mask: bool = True, saturated_band: str | None = None, band: str | None = None, has_quality: bool = True) -> str:
    """Quality bands are never blended; else the explicit method; else bilinear unless the band marks saturation."""
    if is_quality:
        return "nearest"
    if explicit:
        if explicit.lower() not in RESAMPLING:
            raise ValueError(f"unknown resampling: {explicit}")
        return explicit.lower()
    return "bilinear" if not has_quality or (has_mask and saturated_band != band) else "nearest"


def mosaic(assets: DataFrame, keys: list[str], order: Column, value: str = "v", source: str | None = None, first: bool = False) -> DataFrame:
    """(keys, value, source): the value of the last valid asset by ``order``, or the first (combined sources); null if none.

    ``order`` must be unique within a pixel.
    """
    pick = F.min_by if first else F.max_by
    valid = F.when(F.col(value).isNotNull(), order)
    out = [pick(F.col(value), valid).alias(value)] + ([pick(F.col(source), valid).alias(source)] if source else [])
    return assets.groupBy(*keys).agg(*out)


def resample_nearest(pixels: DataFrame, keys: list[str], step: float, cols: int, rows: int) -> DataFrame:
    """(keys, row, col, v) on a grid whose pixels are ``step`` source pixels wide: the source pixel under each centre.

    Each source pixel works out the targets whose centres it holds, so there is no join.
    """

    def span(c: str, n: int) -> Column:
        # Centres (k + 0.5) * step in [c, c + 1).
        lo, hi = F.ceil(F.col(c) / step - 0.5), F.ceil((F.col(c) + 1) / step - 0.5) - 1
        lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, F.lit(n - 1))
        return F.when(lo <= hi, F.sequence(lo, hi))

    out = pixels.withColumn("__row", F.explode(span("row", rows))).withColumn("__col", F.explode(span("col", cols)))
    return out.select(*keys, F.col("__row").cast("int").alias("row"), F.col("__col").cast("int").alias("col"), "v")


def resample_bilinear(pixels: DataFrame, keys: list[str], step: float, cols: int, rows: int) -> DataFrame:
    """The same by the four nearest centres; weights of valid ones are scaled to 1. Each source pixel sends its weighted value
    to the targets it can touch, and one aggregation adds them up."""

    def span(c: str, n: int) -> Column:
        # Targets whose centre, in source pixels minus a half, lies within (c - 1, c + 1).
        lo = F.greatest(F.floor((F.col(c) - 0.5) / step - 0.5), F.lit(0))
        hi = F.least(F.ceil((F.col(c) + 1.5) / step - 0.5), F.lit(n - 1))
        return F.when(lo <= hi, F.sequence(lo, hi))

    def weight(c: str, k: str) -> Column:
        return F.greatest(F.lit(0.0), 1 - F.abs((F.col(k) + 0.5) * step - 0.5 - F.col(c)))

    out = pixels.where("v IS NOT NULL").withColumn("__row", F.explode(span("row", rows))).withColumn("__col", F.explode(span("col", cols)))
    out = out.withColumn("__w", weight("row", "__row") * weight("col", "__col")).where("__w > 0")
    out = out.groupBy(*keys, F.col("__row").cast("int").alias("row"), F.col("__col").cast("int").alias("col"))
    return out.agg((F.sum(F.col("v") * F.col("__w")) / F.sum("__w")).alias("v"))


def resample_block(pixels: DataFrame, keys: list[str], factor: int, how: str) -> DataFrame:
    """Whole-number reduction: average, mode (ties to the least), min, max, med or sum over factor x factor pixels."""
    v = F.col("v")
    made = {"average": F.avg(v), "min": F.min(v), "max": F.max(v), "sum": F.sum(v), "med": F.median(v), "mode": F.mode(v, deterministic=True)}[how]
    return pixels.groupBy(*keys, F.floor(F.col("row") / factor).cast("int").alias("row"), F.floor(F.col("col") / factor).cast("int").alias("col")).agg(made.alias("v"))


def to_blocks(pixels: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows of ``size`` x ``size`` pixels: (keys, brow, bcol, vals), the physical form of a raster."""
    at = (F.col("row") % size) * size + F.col("col") % size
    rows = pixels.groupBy(*keys, F.floor(F.col("row") / size).cast("int").alias("brow"), F.floor(F.col("col") / size).cast("int").alias("bcol"))
    listed = rows.agg(F.map_from_entries(F.collect_list(F.struct(at.alias("k"), F.col("v").alias("v")))).alias("m"))
    return listed.select(*keys, "brow", "bcol", F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.try_element_at(F.col("m"), k.cast("long"))).alias("vals"))


def to_pixels(blocks: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Blocks back to (keys, row, col, v)."""
    out = blocks.select(*keys, "brow", "bcol", F.posexplode("vals").alias("k", "v"))
    return out.select(*keys, (F.col("brow") * size + F.floor(F.col("k") / size)).cast("int").alias("row"), (F.col("bcol") * size + F.col("k") % size).cast("int").alias("col"), "v")


def still_to_do(wanted: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Work that has no valid result yet; all of it if forced."""
    return wanted if force else wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def fill_empty_periods(wanted: DataFrame, scenes: DataFrame, keys: list[str]) -> DataFrame:
    """Every wanted (keys, period_start) with its scenes; one without any gets the period's first day, efficacy 100, cloud 0."""
    out = wanted.join(scenes.withColumn("__found", F.lit(True)), keys, "left")
    for name, value in (("date", F.col("period_start")), ("efficacy", F.lit(100.0)), ("cloud", F.lit(0.0))):
        out = out.withColumn(name, F.when(F.col("__found"), F.col(name)).otherwise(value))
    return out.withColumn("empty", F.col("__found").isNull()).drop("__found")


def inconsistent_bands(scenes: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Keys in which some but not all of ``bands`` have scenes; a build stops if there are any."""
    seen = scenes.where(F.col("band").isin(bands)).groupBy(*keys).agg(F.count_distinct("band").alias("n_bands"))
    return seen.where(F.col("n_bands") < len(set(bands)))


def fixed_shape(pixels: DataFrame, rows: int, cols: int) -> DataFrame:
    """The raster read as it is, cut to a fixed shape, without reprojection."""
    return pixels.where((F.col("row") < rows) & (F.col("col") < cols))


def reproject_nearest(source: DataFrame, targets: DataFrame, keys: list[str], source_at: tuple[float, float, float, float], target_at: tuple[float, float, float, float], shape: tuple[int, int], to_source=None) -> DataFrame:
    """(keys, row, col, v) of ``targets`` (keys) on another grid: the source pixel under each target centre, null where there is none.

    A grid is (left, top, pixel width, pixel height). ``to_source`` maps the columns (x, y) of target centres to the source's
    coordinates, by default the same. Each target pixel works out its source pixel, and one join by key and index fetches it.
    """
    (sx, sy, sw, sh), (tx, ty, tw, th) = source_at, target_at
    cells = targets.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(shape[0] - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(shape[1] - 1))).alias("col"))
    x, y = F.lit(tx) + (F.col("col") + 0.5) * tw, F.lit(ty) - (F.col("row") + 0.5) * th
    x, y = to_source(x, y) if to_source else (x, y)
    cells = cells.withColumn("__row", F.floor((F.lit(sy) - y) / sh).cast("int")).withColumn("__col", F.floor((x - F.lit(sx)) / sw).cast("int"))
    held = source.select(*keys, F.col("row").cast("int").alias("__row"), F.col("col").cast("int").alias("__col"), "v")
    return cells.join(held, [*keys, "__row", "__col"], "left").select(*keys, "row", "col", "v")


def source_nodata(dataset: Column, data_type: Column, band_nodata: Column, asset_nodata: Column, file_nodata: Column, mask_nodata: Column, is_quality: Column) -> Column:
    """The nodata value of an asset: its file's; else the mask's for quality; else the asset's or the band's.

    Files of LC8SR that aren't int16 have 0, and those of CBERS the band's.
    """
    own = F.coalesce(F.when(is_quality, mask_nodata), asset_nodata, band_nodata)
    named = F.when(dataset.startswith("LC8SR") & (data_type != "int16"), F.lit(0.0)).when(dataset.startswith("CBERS"), band_nodata)
    return F.coalesce(named, file_nodata, own)


def oli_sources(platforms: DataFrame) -> DataFrame:
    """(source, oli) of a combined cube's platforms (source, platform): Landsat versions above 7 carry the newer sensor."""
    version = F.regexp_extract(F.lower("platform"), r"^landsat-?(\d+)$", 1)
    return platforms.select("source", F.when(version != "", version.cast("int") > 7).otherwise(F.lit(False)).alias("oli"))


def whole_periods(scenes: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """The scenes of the keys in which every band of ``bands`` has one; a cube of single dates skips the others."""
    whole = scenes.where(F.col("band").isin(bands)).groupBy(*keys).agg(F.count_distinct("band").alias("n")).where(F.col("n") == len(set(bands)))
    return scenes.join(whole.select(*keys), keys, "left_semi")


def attach_saturation(pixels: DataFrame, keys: list[str], band: str) -> DataFrame:
    """Rows of all other bands with ``radsat``, the value of the saturation band at the same pixel and date.

    ``pixels`` has (keys, band, v). A date without any saturation row is an error when it is read.
    """
    radsat = pixels.where(F.col("band") == band).select(*keys, F.col("v").alias("radsat"), F.lit(True).alias("__held"))
    out = pixels.where(F.col("band") != band).join(radsat, keys, "left")
    held = F.when(F.col("__held"), F.col("radsat")).otherwise(F.raise_error(F.lit(f"missing {band}")).cast(pixels.schema["v"].dataType))
    return out.withColumn("radsat", held).drop("__held")
