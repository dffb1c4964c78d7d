"""Reader of ASCII grid files: open, profile, pixels and integrity, all as column expressions over whole-text files.

A file is a header of ``name value`` lines (ncols, nrows, xllcorner or xllcenter, yllcorner or yllcenter, cellsize and, if there
is one, nodata_value) and the values row by row from the top. Spark reads the files, so any store works; a raster is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
HEADER = r"(?im)^\s*[a-z_]+\s+\S+\s*$\n?"


def open_grids(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _field(text: Column, name: str) -> Column:
    found = F.regexp_extract(text, rf"(?im)^\s*{name}\s+{NUMBER}\s*$", 1)
    return F.when(found != "", found).cast("double")


def profile(files: DataFrame) -> DataFrame:
    """(path, cols, rows, left, top, size, nodata): null where the header lacks a field; corners, also of centred headers."""
    text = F.col("text")
    size, rows = _field(text, "cellsize"), _field(text, "nrows")
    left = F.coalesce(_field(text, "xllcorner"), _field(text, "xllcenter") - size / 2)
    bottom = F.coalesce(_field(text, "yllcorner"), _field(text, "yllcenter") - size / 2)
    return files.select("path", _field(text, "ncols").cast("int").alias("cols"), rows.cast("int").alias("rows"), left.alias("left"), (bottom + rows * size).alias("top"), size.alias("size"), _field(text, "nodata_value").alias("nodata"))


def _values(text: Column) -> Column:
    body = F.btrim(F.regexp_replace(F.regexp_replace(text, HEADER, ""), r"\s+", " "))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, " "))


def integrity(files: DataFrame) -> DataFrame:
    """(path, whole): whether the header is complete and as many numbers follow as it says."""
    known = profile(files.select("path", "text"))
    counted = files.select("path", _values(F.col("text")).alias("__v"))
    numbers = F.size(F.filter("__v", lambda v: v.try_cast("double").isNotNull()))
    fits = (numbers == F.col("rows") * F.col("cols")) & (F.size("__v") == numbers) & F.col("left").isNotNull() & F.col("top").isNotNull()
    return known.join(counted, "path").select("path", F.coalesce(fits, F.lit(False)).alias("whole"))


def read_pixels(files: DataFrame) -> DataFrame:
    """(path, row, col, v), null for nodata and for what is no number; files without a header's width give no rows."""
    cols, nodata = _field(F.col("text"), "ncols").cast("int"), _field(F.col("text"), "nodata_value")
    rows = files.select("path", cols.alias("__cols"), nodata.alias("__nodata"), F.posexplode(_values(F.col("text"))).alias("__k", "__v")).where("__cols > 0")
    v = F.col("__v").try_cast("double")
    return rows.select("path", F.floor(F.col("__k") / F.col("__cols")).cast("int").alias("row"), (F.col("__k") % F.col("__cols")).alias("col"), F.when(F.col("__nodata").isNull() | (v != F.col("__nodata")), v).alias("v"))
