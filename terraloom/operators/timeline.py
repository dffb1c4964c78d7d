"""Period timelines without loops: sequences of dates, cycles and named intervals."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNITS = ("day", "month", "year")


@dataclass(frozen=True)
class Schema:
    """kind: continuous or cyclic. cycle: (unit, step) of a cyclic one. intervals: ``mm-dd_mm-dd`` windows in place of steps."""

    kind: str
    unit: str
    step: int = 1
    cycle: tuple[str, int] | None = None
    intervals: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in ("continuous", "cyclic") or self.unit not in UNITS or self.step < 1:
            raise ValueError(f"not a temporal schema: {self}")


def _starts(first: Column, last: Column, unit: str, step: int) -> Column:
    """Period starts: ``first`` itself, then months and years from their first day."""
    if unit == "day":
        return F.sequence(first, last, F.make_dt_interval(F.lit(step)))
    field = "MM" if unit == "month" else "YEAR"
    months = step * (12 if unit == "year" else 1)
    whole = F.sequence(F.trunc(first, field), last, F.make_ym_interval(F.lit(0), F.lit(months)))
    return F.transform(whole, lambda d, k: F.when(k == 0, first).otherwise(d))


def _end(start: Column, unit: str, step: int) -> Column:
    if unit == "day":
        return F.date_add(start, step - 1)
    months = step * (12 if unit == "year" else 1)
    return F.date_sub(F.add_months(F.trunc(start, "MM" if unit == "month" else "YEAR"), months), 1)


def timeline(spark: SparkSession, schema: Schema, start: dt.date, end: dt.date) -> DataFrame:
    """(period_start, period_end) in order of start. Without any period the whole range is one.

    Continuous: steps from ``start``; the last period is whole even beyond ``end``. Cyclic: steps from the start of each
    cycle, cut at its end; only periods that start in the range. Intervals: those that touch the range, a window whose end is
    before its start ends in the next year.
    """
    if start > end:
        raise ValueError("the start is after the end")
    s, e = F.lit(start), F.lit(end)
    one = spark.range(1)
    if schema.intervals:
        years = F.explode(F.sequence(F.lit(start.year - 1), F.lit(end.year + 1))).alias("y")
        parts = [tuple(int(x) for x in t.replace("_", "-").split("-")) for t in schema.intervals]
        spans = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(p, ("sm", "sd", "em", "ed"), strict=True)]) for p in parts])).alias("i")
        rows = one.select(years).select("y", spans)
        wraps = (F.struct("i.em", "i.ed") < F.struct("i.sm", "i.sd")).cast("int")
        rows = rows.select(F.make_date("y", "i.sm", "i.sd").alias("period_start"), F.make_date(F.col("y") + wraps, "i.em", "i.ed").alias("period_end"))
        rows = rows.where((F.col("period_end") >= s) & (F.col("period_start") <= e))
    elif schema.kind == "continuous":
        rows = one.select(F.explode(_starts(s, e, schema.unit, schema.step)).alias("period_start"))
        rows = rows.select("period_start", _end(F.col("period_start"), schema.unit, schema.step).alias("period_end"))
    else:
        unit, step = schema.cycle or ("year", 1)
        cycles = one.select(F.explode(_starts(F.trunc(s, "MM" if unit == "month" else "YEAR"), e, unit, step)).alias("cs"))
        cycles = cycles.select("cs", _end(F.col("cs"), unit, step).alias("ce"))
        rows = cycles.select("ce", F.explode(_starts(F.col("cs"), F.col("ce"), schema.unit, schema.step)).alias("period_start"))
        rows = rows.select("period_start", F.least(_end(F.col("period_start"), schema.unit, schema.step), "ce").alias("period_end"))
        rows = rows.where(F.col("period_start").between(s, e))
    whole = one.select(s.alias("period_start"), e.alias("period_end")).join(rows.limit(1).select("period_start").alias("r"), F.lit(True), "left_anti")
    return rows.unionByName(whole).orderBy("period_start", "period_end")


def clip(periods: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Only periods that lie inside the range."""
    return periods.where((F.col("period_start") >= F.lit(start)) & (F.col("period_end") <= F.lit(end)))


def temporal_priority(dates: DataFrame, day: int, date_col: str = "date", group: tuple[str, ...] = ()) -> DataFrame:
    """``dates`` plus ``priority`` from 1: nearest to the day-th day from the group's first date, ties to the earlier date."""
    whole = Window.partitionBy(*group)
    away = F.abs(F.datediff(F.col(date_col), F.date_add(F.min(date_col).over(whole), day - 1)))
    return dates.withColumn("__away", away).withColumn("priority", F.row_number().over(whole.orderBy("__away", date_col))).drop("__away")


def days_to_next_month(d: Column) -> Column:
    return F.datediff(F.add_months(d, 1), d)


def in_period(obs: DataFrame, periods: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows of ``obs`` with the period that contains their date.

    Periods become one row a day, so that the join is by equality. A timeline has a day or a few for each day of its span: a
    bounded table, but Spark decides from its size whether to broadcast it.
    """
    days = periods.select("period_start", "period_end", F.explode(F.sequence("period_start", "period_end")).alias("__day"))
    return obs.join(days, F.col(date_col) == F.col("__day")).drop("__day")


def missing_instants(known: DataFrame, periods: DataFrame, group_col: str = "tile", start_col: str = "period_start") -> DataFrame:
    """(group, period_start) for which ``known`` has no row. Groups and periods are catalogue tables, not pixels."""
    groups = known.select(group_col).distinct().withColumn("__p", F.lit(1))
    starts = periods.select(F.col("period_start").alias(start_col)).distinct()
    listed = starts.groupBy(F.lit(1).alias("__p")).agg(F.sort_array(F.collect_set(start_col)).alias("__all"))
    wanted = groups.join(listed, "__p").select(group_col, F.explode("__all").alias(start_col))
    return wanted.join(known.select(group_col, start_col).distinct(), [group_col, start_col], "left_anti")


def missing_periods(known: DataFrame, periods: DataFrame) -> DataFrame:
    """(tile, period_start, period_end) to run again: each tile's periods of the timeline for which ``known`` has no item."""
    return missing_instants(known, periods).join(periods, "period_start").select("tile", "period_start", "period_end")


#: The range of a timeline that is asked for without one.
FIRST, LAST = "2016-01-01", "2019-12-31"


def asked_range(start: str | None = None, end: str | None = None) -> tuple[dt.date, dt.date]:
    """The dates of a request: the first ten characters count; what is left out has a default."""
    return dt.date.fromisoformat((start or FIRST)[:10]), dt.date.fromisoformat((end or LAST)[:10])
