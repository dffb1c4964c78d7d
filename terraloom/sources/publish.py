"""Sinks: block rows, empty rasters, display rows, scene lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import linear_scale


def write_blocks(blocks: DataFrame, root: str, codec: str = "zstd", mode: str = "append") -> None:
    """Block rows as Parquet by tile, band and date, one shuffle so that each folder gets few files."""
    blocks.repartition("tile", "band", "date").write.mode(mode).option("compression", codec).partitionBy("tile", "band", "date").parquet(root)


def empty_raster(spark: SparkSession, dist_x: float, dist_y: float, resolution: float, nodata: int) -> DataFrame:
    """(row, col, v) of an all-nodata raster with the profile of a tile: distances over the resolution, half to even."""
    cols, rows = round(dist_x / resolution), round(dist_y / resolution)
    return spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"), F.lit(nodata).alias("v"))


def decimate(pixels: DataFrame, keys: list[str], rows: int, out_rows: int) -> DataFrame:
    """Every pixel that the nearest-neighbour reduction to ``out_rows`` keeps; the width follows in proportion."""
    step = rows / out_rows

    def at(c: str):
        k = F.floor((F.col(c) + 0.5) / step)
        return k, F.floor((k + 0.5) * step) == F.col(c)

    (r, on_r), (c, on_c) = at("row"), at("col")
    return pixels.where(on_r & on_c).select(*keys, r.cast("int").alias("row"), c.cast("int").alias("col"), "v")


def rgb_rows(pixels: DataFrame, keys: list[str], bands: tuple[str, str, str], low: float, high: float) -> DataFrame:
    """(keys, row, col, red, green, blue) bytes of three bands."""
    shown = pixels.where(F.col("band").isin(*bands)).groupBy(*keys, "row", "col").pivot("band", list(bands)).agg(F.first("v"))
    return shown.select(*keys, "row", "col", *[F.floor(linear_scale(F.col(b), low, high)).alias(n) for b, n in zip(bands, ("red", "green", "blue"), strict=True)])


def export_scene_list(scenes: DataFrame, root: str) -> None:
    """JSON lines by tile and period."""
    scenes.write.mode("overwrite").partitionBy("tile", "period_start").json(root)


def raster_guard(pixels: DataFrame, keys: list[str], none: float = -1) -> DataFrame:
    """(keys, least, most, valid) of the valid pixels; ``none`` where there is none."""
    v = F.col("v")
    return pixels.groupBy(*keys).agg(F.coalesce(F.min(v), F.lit(none)).alias("least"), F.coalesce(F.max(v), F.lit(none)).alias("most"), F.count(v).alias("valid"))


def readable(files: DataFrame, path_col: str = "path") -> DataFrame:
    """``files`` plus ``readable``: whether the file's Parquet magic stands at both ends. The contents are not parsed.

    ``files`` comes from Spark's ``binaryFile`` source with its content, so any store works.
    """
    magic = F.lit(b"PAR1")
    whole = (F.length("content") >= 12) & (F.substring("content", 1, 4) == magic) & (F.expr("substring(content, length(content) - 3, 4)") == magic)
    return files.select(F.col(path_col).alias("path"), F.coalesce(whole, F.lit(False)).alias("readable"))
