"""Newly landed observations: only the cells and periods they touch are composed anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def affected(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.select(*keys).distinct()


def recompose_stream(stream: DataFrame, keys: list[str], history: Callable[[], DataFrame], compose: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """For each micro-batch: the history of the touched keys is composed and handed to ``sink`` with the batch number.

    The batch number repeats after a failure, so a sink that replaces by it writes each batch once.
    """

    def step(batch: DataFrame, number: int) -> None:
        sink(compose(history().join(affected(batch, keys), keys, "left_semi")), number)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def daily_counts(stream: DataFrame, time_col: str, late: str = "1 day") -> DataFrame:
    """Observations by day and tile with a watermark for late ones."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, "1 day").alias("w"), "tile").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "tile", "n")
