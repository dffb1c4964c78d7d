"""Scenes of a local or remote directory, described by a small format document of regular expressions."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import reader_kind


@dataclass(frozen=True)
class Format:
    """pattern: files that belong to the collection; datetime: pattern with one group and its Spark date format; bands in order."""

    name: str
    pattern: str
    datetime_pattern: str
    datetime_format: str
    bands: dict[str, str]

    @classmethod
    def parse(cls, text: str, path: str) -> Format:
        spec = json.loads(text)
        return cls(PurePosixPath(path).stem, spec["pattern"], spec["datetime"]["pattern"], spark_date_format(spec["datetime"]["format"]), {b: v["pattern"] for b, v in spec["bands"].items()})


def spark_date_format(text: str) -> str:
    """A strftime format as Spark writes it."""
    for a, b in (("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"), ("%S", "ss"), ("%j", "DDD"), ("T", "'T'")):
        text = text.replace(a, b)
    return text


def list_files(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """(path, size, modified) of the files, without reading them."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root if recursive else f"{root}/*/*")
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def band_of(name: Column, bands: dict[str, str]) -> Column:
    """The first band whose name stands in the file name and whose pattern fits."""
    return F.coalesce(*[F.when(F.contains(name, F.lit(b)) & name.rlike(p), F.lit(b)) for b, p in bands.items()])


def scan(files: DataFrame, fmt: Format, start: str, end: str) -> DataFrame:
    """(path, band, date, reader) of the files of the format within the dates (both inclusive)."""
    name = F.element_at(F.split("path", "/"), -1)
    out = files.where(name.rlike(fmt.pattern)).withColumn("band", band_of(name, fmt.bands))
    out = out.withColumn("date", F.try_to_timestamp(F.regexp_extract("path", fmt.datetime_pattern, 1), F.lit(fmt.datetime_format)).cast("date"))
    out = out.where(F.col("band").isNotNull() & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return out.withColumn("reader", reader_kind(F.col("path"), F.regexp_replace(name, r"\.[^.]*$", "")))


def read_blocks(spark: SparkSession, root: str) -> DataFrame:
    """Block rows written by the sink; tile, band and date are partitions, so filters on them skip files."""
    return spark.read.parquet(root)
