"""Cube definitions and the build: one lazy plan from assets to a composite."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import EVI, NDVI, index_band
from ..functions.masks import Mask, clear_and_not, usable
from ..operators import composite, timeline


#: Expressions of indexes that are defined by their common name alone.
INDEXES = {"ndvi": NDVI, "evi": EVI}


@dataclass(frozen=True)
class Band:
    name: str
    common_name: str
    data_type: str = "int16"
    nodata: float = -9999
    expression: str | None = None

    @property
    def is_index(self) -> bool:
        return self.expression is not None or self.common_name in ("ndvi", "evi")

    def defaults(self, quality: bool) -> dict[str, float | None]:
        return {"min": -10000 if self.is_index else 0, "max": 10000, "scale": None if quality else 0.0001}


@dataclass(frozen=True)
class Cube:
    name: str
    version: int
    grid: str
    function: str
    schema: timeline.Schema
    bands: tuple[Band, ...]
    indexes: tuple[Band, ...] = ()
    quality_band: str | None = None
    parameters: dict = field(default_factory=dict)

    def __post_init__(self):
        names = [b.name for b in self.bands]
        if clash := set(names) & {b.name for b in self.indexes}:
            raise ValueError(f"an index repeats a band: {sorted(clash)}")
        if len(set(names)) < len(names):
            raise ValueError("band names repeat")
        if self.function not in composite.FUNCTIONS:
            raise ValueError(f"unknown composite function: {self.function}")
        if self.function != "IDT":
            if not self.quality_band or not self.parameters.get("mask"):
                raise ValueError("a composite needs a quality band and a mask")
            if self.quality_band not in names:
                raise ValueError(f"the quality band is not a band: {self.quality_band}")

    def spectral(self) -> list[str]:
        return [b.name for b in self.bands if b.name != self.quality_band]

    def identity(self) -> Cube:
        """The cube of single dates that a composite is made from."""
        return Cube(f"{self.name}_IDT" if self.function != "IDT" else self.name, self.version, self.grid, "IDT", self.schema, self.bands, self.indexes, self.quality_band, self.parameters)

    def all_bands(self) -> list[str]:
        spectral = [b.name for b in (*self.bands, *self.indexes)]
        return spectral if self.function == "IDT" else composite.composed_bands(self.function, spectral, bool(self.parameters.get("combined")))


def create(cube: Cube, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cubes, edges): the rows (name, version, grid, function) and lineage (id, source) of a composite and its identity cube.

    A name and version that ``existing`` (name, version) has already is an error, but for an identity cube made before.
    """
    spark, names = existing.sparkSession, {cube.name: cube, cube.identity().name: cube.identity()}
    held = {(r.name, r.version) for r in existing.where(F.col("name").isin(*names) & (F.col("version") == cube.version)).select("name", "version").collect()}
    if (cube.name, cube.version) in held:
        raise ValueError(f"the cube exists: {cube.name} version {cube.version}")
    rows = [(c.name, c.version, c.grid, c.function) for c in names.values() if (c.name, c.version) not in held]
    edges = [(cube.name, cube.identity().name)] if cube.function != "IDT" else []
    return spark.createDataFrame(rows, "name string, version int, grid string, function string"), spark.createDataFrame(edges, "id string, source string")


def changed(cube: Cube, **given) -> Cube:
    """The cube with metadata replaced; parameters are merged, bands can be added but none dropped, the grid and the function stay."""
    if fixed := {"name", "grid", "function", "version"} & given.keys():
        raise ValueError(f"not to be changed: {sorted(fixed)}")
    if "bands" in given and (lost := {b.name for b in cube.bands} - {b.name for b in given["bands"]}):
        raise ValueError(f"bands can't be dropped: {sorted(lost)}")
    return replace(cube, **(given | ({"parameters": merge_parameters(cube.parameters, given["parameters"])} if "parameters" in given else {})))


def item_assets(cube: Cube) -> list[dict]:
    """The catalogue of a cube's assets: name, common name, data type, nodata and display defaults of every band."""
    known = {b.name: b for b in (*cube.bands, *cube.indexes)}
    derived = {"CLEAROB": ("uint8", 0), "TOTALOB": ("uint8", 0), "PROVENANCE": ("int16", -1), "DATASOURCE": ("uint8", 255)}
    out = []
    for name in cube.all_bands():
        if name in known:
            b = known[name]
            out.append({"name": name, "common_name": b.common_name, "data_type": b.data_type, "nodata": b.nodata, **b.defaults(name == cube.quality_band)})
        else:
            kind, nodata = derived[name]
            out.append({"name": name, "common_name": name.lower(), "data_type": kind, "nodata": nodata, "min": 0, "max": 255 if kind == "uint8" else 366, "scale": None})
    return out


def merge_parameters(stored: dict, given: dict) -> dict:
    """Stored parameters with those of the call on top; a null removes one."""
    return {k: v for k, v in (stored | given).items() if v is not None}


def may_reuse(cube: Cube, other: Cube, force: bool = False) -> bool:
    """Whether the other's single dates serve this cube."""
    return not force and other.function == "IDT" and other.grid == cube.grid and {b.name for b in cube.bands} <= {b.name for b in other.bands}


def repair_value(datasets: list[str]) -> int | None:
    """The quality of pixels that lack a band: 1 where a data set is of Sentinel-2, else nodata (null)."""
    return 1 if any(d.lower().startswith(("s2", "sentinel")) for d in datasets) else None


def mosaics(assets: DataFrame, cube: Cube, keys: list[str], repair: int | None) -> DataFrame:
    """One row for each pixel and date: bands as columns, repaired quality, ``__source`` of a combined cube's quality."""
    q, spectral = cube.quality_band, cube.spectral()
    combined = bool(cube.parameters.get("combined"))
    pick = F.min_by if combined else F.max_by
    picked = [pick(F.col(b), F.when(F.col(b).isNotNull(), F.col("asset_seq"))).alias(b) for b in (*spectral, *([q] if q else []))]
    if combined and q:
        picked.append(pick(F.col("source"), F.when(F.col(q).isNotNull(), F.col("asset_seq"))).alias("__source"))
    out = assets.groupBy(*keys).agg(*picked)
    judged = [b for b in spectral if b != cube.parameters.get("mask", {}).get("saturated_band")]
    if q and judged and not cube.parameters.get("no_post_process"):
        out = composite.repair_quality(out, keys, judged, q, F.lit(repair))
    return out


def with_indexes(rows: DataFrame, cube: Cube) -> DataFrame:
    columns = {b.common_name: F.col(b.name).cast("double") for b in cube.bands}
    return rows.withColumns({i.name: index_band(i.expression or INDEXES[i.common_name], columns, i.data_type) for i in cube.indexes})


def build(assets: DataFrame, periods: DataFrame, cube: Cube, repair: int | None = None, datasets: tuple[str, ...] = (), oli_sources: tuple[int, ...] = ()) -> DataFrame:
    """The composite of a cube: (tile, period_start, row, col, one column a band and index, clearob, totalob, provenance[,
    datasource]); without provenance for MED. IDT: (tile, period_start, date, row, col, bands and indexes) of every date of the
    periods in which each spectral band has data.

    ``assets`` has tile, date, row, col, asset_seq, source and a column for each band, null for nodata. All bands are composed in
    one pass: pixels are shuffled once for the mosaics and once for the composite, whatever the number of bands; the mosaics'
    quality alone is also counted by scene for the ranking. Each band is composed by its own first usable date; counts,
    provenance and source are those of the quality band. Parameters of the cube: ``mask``, ``combined``, ``no_post_process``,
    ``reference_day``, ``histogram_matching``. ``repair`` defaults to the value that ``datasets`` ask for. Sources in
    ``oli_sources`` are judged with the cirrus bit in a combined cube of bit masks, others without.
    """
    keys, scene, cell = ["tile", "date", "row", "col"], ["tile", "period_start"], ["tile", "period_start", "row", "col"]
    q, spectral = cube.quality_band, cube.spectral()
    one = mosaics(assets, cube, keys, repair_value(list(datasets)) if repair is None else repair)
    if cube.function == "IDT":
        placed = timeline.in_period(one, periods)
        whole = placed.groupBy(*scene).agg(*[F.count(b).alias(f"__n_{b}") for b in spectral])
        whole = whole.where(" AND ".join(f"`__n_{b}` > 0" for b in spectral) or "true").select(*scene)
        return with_indexes(placed.join(whole, scene), cube).select("tile", "period_start", "date", "row", "col", *[b.name for b in (*cube.bands, *cube.indexes)])
    mask = Mask.parse(cube.parameters["mask"])
    combined = bool(cube.parameters.get("combined"))
    oli = F.col("__source").isin(*oli_sources) if combined and mask.bits and oli_sources else None
    clear, not_clear = clear_and_not(F.col(q), mask, oli)
    stats = timeline.in_period(composite.scene_stats(one, ["tile", "date"], clear, not_clear), periods)
    if cube.parameters.get("histogram_matching"):
        one = composite.match_to_best(timeline.in_period(one, periods), stats, scene, ["row", "col"], spectral)
    if cube.function == "MED":
        rows = one if "period_start" in one.columns else timeline.in_period(one, periods)
    else:
        day = cube.parameters.get("reference_day")
        if day:
            ranked = timeline.temporal_priority(stats, day, "date", ("tile", "period_start")).withColumnRenamed("priority", "rank")
        else:
            ranked = composite.rank_scenes(stats, scene)
        on = [c for c in ("tile", "date", "period_start") if c in one.columns]
        rows = one.join(ranked.select("tile", "date", "period_start", "rank"), on)
    radsat = F.col(mask.saturated_band) if mask.saturated_band else None
    bands = [q, *spectral]
    able = {b: usable(F.col(q), F.col(b), mask, radsat if b not in (q, mask.saturated_band) else None, oli) for b in bands}
    if cube.function == "MED":
        made = composite.medians(rows, cell, bands, able, q)
    else:
        made = composite.best_pixels(rows, cell, bands, able, q, source="__source" if combined else None)
    return with_indexes(made, cube)
