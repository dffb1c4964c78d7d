"""Stored cube definitions: from the JSON document to the plan, and the build of a range of dates from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..operators import timeline
from .cube import Band, Cube, build, merge_parameters


def _band(doc: dict) -> Band:
    value = ((doc.get("metadata") or {}).get("expression") or {}).get("value")
    nodata = doc.get("nodata")
    return Band(doc["name"], doc["common_name"], doc.get("data_type", "int16"), -9999 if nodata is None else nodata, value)


def parse_schema(doc: dict) -> timeline.Schema:
    """The temporal composition: kind, step, unit, and the cycle or the intervals, which may also stand inside the cycle."""
    cycle = doc.get("cycle") or {}
    intervals = doc.get("intervals") or cycle.get("intervals") or ()
    held = (cycle["unit"], cycle["step"]) if cycle.get("unit") else None
    return timeline.Schema(doc["schema"].lower(), doc.get("unit") or "month", doc.get("step") or 1, held, tuple(intervals))


def parse_cube(doc: dict, parameters: dict | None = None) -> Cube:
    """A cube from its definition; ``parameters`` of the call stand above the stored ones."""
    held = merge_parameters(doc.get("parameters") or {}, parameters or {})
    return Cube(
        doc["datacube"], doc.get("version", 1), doc["grs"], doc["composite_function"], parse_schema(doc["temporal_composition"]),
        tuple(map(_band, doc["bands"])), tuple(map(_band, doc.get("indexes") or ())), doc.get("quality_band"), held,
    )


def build_range(assets: DataFrame, cube: Cube, start: dt.date, end: dt.date, datasets: tuple[str, ...] = ()) -> DataFrame:
    """The composites of the periods inside the range; a cube of single dates has the range as its one period."""
    spark = assets.sparkSession
    if cube.function == "IDT":
        periods = spark.createDataFrame([(start, end)], "period_start date, period_end date")
    else:
        periods = timeline.clip(timeline.timeline(spark, cube.schema, start, end), start, end)
    return build(assets, periods, cube, datasets=datasets)
