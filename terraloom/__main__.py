"""``python -m terraloom build``: composites of a stored cube definition from a Parquet table of assets."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .functions.masks import literal_mask
from .operators.timeline import asked_range
from .plans.document import build_range, parse_cube


def main(given: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="terraloom")
    build = parser.add_subparsers(required=True).add_parser("build")
    for name in ("cube", "assets", "out"):
        build.add_argument(f"--{name}", required=True)
    for name in ("start", "end", "mask"):
        build.add_argument(f"--{name}")
    build.add_argument("--dataset", action="append", default=[])
    asked = parser.parse_args(given)
    spark = SparkSession.builder.getOrCreate()
    text = spark.read.text(asked.cube, wholetext=True).first().value
    cube = parse_cube(json.loads(text), {"mask": literal_mask(asked.mask)} if asked.mask else None)
    out = build_range(spark.read.parquet(asked.assets), cube, *asked_range(asked.start, asked.end), tuple(asked.dataset))
    out.write.mode("overwrite").partitionBy("tile", "period_start").parquet(asked.out)


if __name__ == "__main__":
    main()
