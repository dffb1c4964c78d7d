"""Temporal composites: best pixel, median, counts, provenance and source, with scene statistics and quality repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, none: float) -> Column:
    """100 * part / whole to two places, half to even; ``none`` where whole is 0."""
    return F.when(whole > 0, F.bround(100.0 * part / whole, 2)).otherwise(F.lit(none))


def scene_stats(obs: DataFrame, keys: list[str], clear: Column, not_clear: Column) -> DataFrame:
    """(keys, efficacy, cloud): the clear share of all pixels, nodata included, and the unclear share of the classified ones."""
    n = obs.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(clear).alias("c"), F.count_if(not_clear).alias("u"))
    return n.select(*keys, ratio(F.col("c"), F.col("n"), 0.0).alias("efficacy"), ratio(F.col("u"), F.col("c") + F.col("u"), 100.0).alias("cloud"))


def rank_scenes(stats: DataFrame, group: list[str], date_col: str = "date", resolution: Column | None = None) -> DataFrame:
    """``stats`` plus ``rank`` from 1: 100 * efficacy / resolution descending, ties to the later date."""
    score = F.col("efficacy") * 100 / (resolution if resolution is not None else F.lit(1.0))
    return stats.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(score.desc(), F.col(date_col).desc())))


def repair_quality(pixels: DataFrame, keys: list[str], band_cols: list[str], quality: str, repair: Column) -> DataFrame:
    """``pixels`` (one row for each pixel and date, bands as columns): quality becomes ``repair`` where any band is nodata.

    A quality that was nodata stays so.
    """
    some = F.lit(False)
    for b in band_cols:
        some = some | F.col(b).isNull()
    return pixels.withColumn(quality, F.when(F.col(quality).isNotNull(), F.when(some, repair).otherwise(F.col(quality))))


def best_pixel(obs: DataFrame, keys: list[str], value: str = "v", date: str = "date", rank: str = "rank", usable: str = "usable", quality: str = "q", source: str | None = None, valid_range: tuple[float, float] | None = None) -> DataFrame:
    """(keys, value, provenance, clearob, totalob[, datasource]): the best date of each pixel.

    With i the best rank whose quality is usable: the value of the first rank from i on (from 1 if there is none) that holds
    data. Provenance is that date's day of the year, without data the day of i, else -1. One shuffle: the window and the
    aggregation share the keys. ``valid_range`` leaves values outside it to later ranks.
    """
    w = Window.partitionBy(*keys)
    v = F.col(value) if valid_range is None else F.when(F.col(value).between(*valid_range), F.col(value))
    first = F.min(F.when(F.col(usable), F.struct(F.col(rank).alias("r"), F.col(date).alias("d")))).over(w)
    rows = obs.withColumn("__first", first).withColumn("__v", v)
    open_ = F.col("__v").isNotNull() & (F.col(rank) >= F.coalesce(F.col("__first.r"), F.lit(1)))
    took = F.min_by(F.struct(F.col("__v").alias("v"), F.col(date).alias("d"), *([F.col(source).alias("s")] if source else [])), F.when(open_, F.col(rank)))
    out = rows.groupBy(*keys).agg(took.alias("t"), F.max("__first").alias("f"), F.count_if(F.col(usable)).alias("clearob"), F.count_if(F.col(quality).isNotNull()).alias("totalob"))
    day = F.coalesce(F.dayofyear("t.d"), F.dayofyear("f.d"), F.lit(-1))
    more = [F.coalesce(F.col("t.s"), F.lit(255)).alias("datasource")] if source else []
    return out.select(*keys, F.col("t.v").alias(value), day.alias("provenance"), "clearob", "totalob", *more)


def best_pixels(obs: DataFrame, keys: list[str], bands: list[str], usable: dict[str, Column], quality: str, date: str = "date", rank: str = "rank", source: str | None = None) -> DataFrame:
    """``best_pixel`` of several bands in one pass: (keys, bands, provenance, clearob, totalob[, datasource]).

    Each band starts at its own first usable rank; provenance, counts and source are those of ``quality``. One shuffle whatever
    the number of bands.
    """
    w = Window.partitionBy(*keys)
    rows = obs.withColumns({f"__u_{b}": usable[b] for b in bands})
    rows = rows.withColumns({f"__f_{b}": F.min(F.when(F.col(f"__u_{b}"), F.struct(F.col(rank).alias("r"), F.col(date).alias("d")))).over(w) for b in bands})
    own = [F.col(date).alias("d"), *([F.col(source).alias("s")] if source else [])]
    took = [
        F.min_by(F.struct(F.col(b).alias("v"), *own), F.when(F.col(b).isNotNull() & (F.col(rank) >= F.coalesce(F.col(f"__f_{b}.r"), F.lit(1))), F.col(rank))).alias(f"__t_{b}")
        for b in bands
    ]
    out = rows.groupBy(*keys).agg(*took, F.max(f"__f_{quality}").alias("__f"), F.count_if(F.col(f"__u_{quality}")).alias("clearob"), F.count_if(F.col(quality).isNotNull()).alias("totalob"))
    day = F.coalesce(F.dayofyear(f"__t_{quality}.d"), F.dayofyear("__f.d"), F.lit(-1))
    more = [F.coalesce(F.col(f"__t_{quality}.s"), F.lit(255)).alias("datasource")] if source else []
    return out.select(*keys, *[F.col(f"__t_{b}.v").alias(b) for b in bands], day.alias("provenance"), "clearob", "totalob", *more)


def medians(obs: DataFrame, keys: list[str], bands: list[str], usable: dict[str, Column], quality: str) -> DataFrame:
    """``median`` of several bands in one pass."""
    mids = [F.median(F.when(usable[b], F.col(b))).cast("long").alias(b) for b in bands]
    return obs.groupBy(*keys).agg(*mids, F.count_if(usable[quality]).alias("clearob"), F.count_if(F.col(quality).isNotNull()).alias("totalob"))


def best_scene(stats: DataFrame, group: list[str], date_col: str = "date") -> DataFrame:
    """(group, best_date): the date with the greatest efficacy, ties to the earlier."""
    return stats.groupBy(*group).agg(F.max_by(date_col, F.struct("efficacy", -F.unix_date(date_col))).alias("best_date"))


def match_to_best(pixels: DataFrame, stats: DataFrame, group: list[str], cell: list[str], bands: list[str], date_col: str = "date") -> DataFrame:
    """``pixels`` (group, date, cell, bands) with the bands of every date matched to those of the group's best date.

    ``stats`` has (group, date, efficacy). The best date itself stays; each band is matched by itself (``match_histograms``).
    """
    best = best_scene(stats, group, date_col)
    rows = pixels.join(best, group)
    reference = rows.where(F.col(date_col) == F.col("best_date")).select(*group, *cell, *[F.col(b).alias(f"__r_{b}") for b in bands])
    out = rows.join(reference, [*group, *cell], "left")
    for b in bands:
        out = match_histograms(out, [*group, date_col], b, f"__r_{b}").withColumn(b, F.when(F.col(date_col) == F.col("best_date"), F.col(b).cast("long")).otherwise(F.col("matched"))).drop("matched")
    return out.select(*pixels.columns)


def composite_stats(composed: DataFrame, keys: list[str], clear: Column, not_clear: Column) -> DataFrame:
    """(keys, efficacy, cloud) of composites; the cloud share is 0 where nothing is classified."""
    known = F.count_if(clear | not_clear).alias("__known")
    n = composed.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(clear).alias("c"), F.count_if(not_clear).alias("u"), known)
    return n.select(*keys, ratio(F.col("c"), F.col("n"), 0.0).alias("efficacy"), ratio(F.col("u"), F.col("__known"), 0.0).alias("cloud"))


def best_pixel_fast(obs: DataFrame, keys: list[str], value: str = "v", date: str = "date", rank: str = "rank", usable: str = "usable") -> DataFrame:
    """(keys, value, provenance) by one hash aggregation; the same where every usable pixel holds data, as after quality repair."""
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col(date).alias("d")), F.when(F.col(value).isNotNull(), F.struct(~F.col(usable), F.col(rank))))
    out = obs.groupBy(*keys).agg(best.alias("t"))
    return out.select(*keys, F.col("t.v").alias(value), F.coalesce(F.dayofyear("t.d"), F.lit(-1)).alias("provenance"))


def median(obs: DataFrame, keys: list[str], value: str = "v", usable: str = "usable", quality: str = "q") -> DataFrame:
    """(keys, value, clearob, totalob): the median of usable values cut towards 0, null if there is none."""
    mid = F.median(F.when(F.col(usable), F.col(value))).cast("long")
    return obs.groupBy(*keys).agg(mid.alias(value), F.count_if(F.col(usable)).alias("clearob"), F.count_if(F.col(quality).isNotNull()).alias("totalob"))


#: Composite functions by alias. STK is kept as another name of LCF; IDT keeps every date.
FUNCTIONS = {"LCF": best_pixel, "STK": best_pixel, "MED": median, "IDT": None}


def composed_bands(function: str, bands: list[str], combined: bool = False) -> list[str]:
    """The bands that a composite of this function has."""
    if function not in FUNCTIONS:
        raise ValueError(f"unknown composite function: {function}")
    if function == "IDT":
        return list(bands)
    return [*bands, "CLEAROB", "TOTALOB", *(["PROVENANCE", *["DATASOURCE"] * combined] if function != "MED" else [])]


def match_histograms(pixels: DataFrame, keys: list[str], source: str, reference: str) -> DataFrame:
    """``pixels`` plus ``matched``: source values moved to the reference's distribution, over pixels valid in both.

    Quantile mapping: a source value's cumulative share is found among the reference's by linear interpolation and rounded half
    to even. Only distinct values are ranked and joined; pixels are counted once and joined to the map by value. Keys without
    a pixel valid in both keep their source values.
    """
    both = pixels.where(F.col(source).isNotNull() & F.col(reference).isNotNull())

    def shares(value: str) -> DataFrame:
        n = both.groupBy(*keys, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))
        w = Window.partitionBy(*keys)
        upto = F.sum("n").over(w.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(w)
        return n.select(*keys, "x", upto.alias("p"))

    src, ref = shares(source), shares(reference)
    # Source and reference shares in one order; each source share looks back and ahead to the nearest reference shares.
    every = src.select(*keys, "p", F.col("x").alias("sx"), F.lit(None).cast("double").alias("rx")).unionByName(ref.select(*keys, "p", F.lit(None).cast("double").alias("sx"), F.col("x").alias("rx")))
    w = Window.partitionBy(*keys).orderBy(F.col("p"))
    point = F.when(F.col("rx").isNotNull(), F.struct(F.col("p").alias("p"), F.col("rx").alias("x")))
    every = every.withColumn("lo", F.last(point, True).over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("hi", F.first(point, True).over(w.rangeBetween(0, Window.unboundedFollowing)))
    lo, hi = F.coalesce("lo", "hi"), F.coalesce("hi", "lo")
    x = F.when(hi["p"] > lo["p"], lo["x"] + (hi["x"] - lo["x"]) * (F.col("p") - lo["p"]) / (hi["p"] - lo["p"])).otherwise(lo["x"])
    table = every.where(F.col("sx").isNotNull()).select(*keys, F.col("sx").alias("__x"), F.bround(x, 0).cast("long").alias("matched"))
    out = pixels.withColumn("__x", F.col(source).cast("double")).join(table, [*keys, "__x"], "left").drop("__x")
    return out.withColumn("matched", F.when(F.col(reference).isNotNull(), F.coalesce("matched", F.col(source).cast("long"))).otherwise(F.col(source).cast("long")))
