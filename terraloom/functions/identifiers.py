"""Names: scene, product and file identifiers, band names, item ids and paths, as string expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bands of a zipped product by subdataset.
BAND_GROUPS = {0: ("B02", "B03", "B04", "B08"), 1: ("B05", "B06", "B07", "B8A", "B11", "B12", "SCL"), 2: ("B01", "B09", "B10"), 3: ("TCI",)}
#: A product identifier: mission, level, sensing time, baseline, orbit, tile, discriminator.
PRODUCT = r"(?i)^(S2[A-Z])_(MSI)(L\d[A-Z])_(\d{8}T\d{6})_(N\d{4})_(R\d{3})_T(\w{5})_(\d{8}T\d{6})(\.SAFE)?$"
#: The short form of a product identifier: mission, tile, date, number, level.
SHORT_PRODUCT = r"(?i)^(S2[AB])_T(\d{2}\w\w{2})_(\d{8})_(\d{1,2})_(L[0-2][ABC])$"
TRUE_WORDS, FALSE_WORDS = ("y", "yes", "t", "true", "on", "1"), ("n", "no", "f", "false", "off", "0")


def parse_product(c: Column) -> dict[str, Column]:
    """Parts of a product id; null where the id has another form."""
    part = lambda k: F.when(c.rlike(PRODUCT), F.regexp_extract(c, PRODUCT, k))
    names = {"mission": 1, "level": 3, "sensed": 4, "baseline": 5, "orbit": 6, "tile": 7}
    return {n: F.upper(part(k)) for n, k in names.items()}


def parse_short_product(c: Column, processing_baseline: Column) -> dict[str, Column]:
    """Parts of a short product id, whose baseline comes from the catalogue (``04.00``); null where the id has another form.

    An id of this form without a baseline is an error.
    """
    fits = c.rlike(SHORT_PRODUCT)
    part = lambda k: F.when(fits, F.upper(F.regexp_extract(c, SHORT_PRODUCT, k)))
    known = F.when(processing_baseline.isNull(), F.raise_error(F.concat(F.lit("no processing baseline: "), c)).cast("string")).otherwise(F.concat(F.lit("N"), F.replace(processing_baseline, F.lit("."), F.lit(""))))
    return {n: part(k) for n, k in {"mission": 1, "tile": 2, "sensed": 3, "number": 4, "level": 5}.items()} | {"baseline": F.when(fits, known)}


def baseline(c: Column) -> tuple[Column, Column]:
    """(major, minor) of ``Nxxyy``; null for any other form."""
    ok = c.rlike(r"^N\d{4}$")
    return tuple(F.when(ok, F.substring(c, k, 2)).cast("int") for k in (2, 4))


def parse_baseline(text: str) -> tuple[int, int]:
    if not (m := re.fullmatch(r"N(\d\d)(\d\d)", text)):
        raise ValueError(f"not a processing baseline: {text}")
    return int(m[1]), int(m[2])


def offset_value(v: Column, major: Column, band: Column) -> Column:
    """Reflectance of a product of baseline 4 or later: 1000 less, null below 0; classification bands stay."""
    moved = F.when(v - 1000 >= 0, v - 1000)
    return F.when((major >= 4) & (F.lower(band) != "scl"), moved).otherwise(v)


def canonical_band(c: Column) -> Column:
    """B1 to B01; other names stay."""
    return F.when(c.rlike(r"^B\d$"), F.concat(F.lit("B0"), F.substring(c, 2, 1))).otherwise(c)


def band_group(c: Column) -> Column:
    """The subdataset that holds a band, null for unknown bands."""
    pairs = [(b, g) for g, names in BAND_GROUPS.items() for b in names]
    return F.coalesce(*[F.when(canonical_band(c) == b, F.lit(g)) for b, g in pairs])


def landsat_platform(c: Column) -> Column:
    """``Landsat-n`` of a seven-part scene id that starts with L and a sensor and two digits; null otherwise."""
    parts = F.split(c, "_")
    number = F.try_to_number(F.substring(F.get(parts, F.lit(0)), 3, 2), F.lit("99")).cast("int")
    ok = (F.size(parts) == 7) & c.rlike(r"^L.\d\d_") & number.isin(4, 5, 7, 8, 9)
    return F.when(ok, F.concat(F.lit("Landsat-"), number.cast("string")))


def is_landsat_archive(c: Column) -> Column:
    """Eight-part archive names of the known satellites."""
    parts = F.split(c, "_")
    return (F.size(parts) == 8) & c.rlike(r"^L.0[45789]_")


def file_name(url: Column) -> Column:
    """The folder that ends in .SAFE if there is one, else the last part of the path, without a query."""
    path = F.regexp_replace(url, r"[?#].*$", "")
    safe = F.regexp_extract(path, r"([^/]+\.SAFE)(/|$)", 1)
    return F.when(safe != "", safe).otherwise(F.regexp_extract(path, r"([^/]*)$", 1))


def reader_kind(uri: Column, scene: Column) -> Column:
    """Which reader opens a URI: zip, tar, offset (a Sentinel-2 product) or plain."""
    low = F.lower(uri)
    return (
        F.when(low.startswith("zip+") | low.endswith(".zip"), "zip")
        .when(low.startswith("vsitar+") | low.rlike(r"\.tar(\.gz)?$"), "tar")
        .when(scene.rlike(PRODUCT), "offset")
        .otherwise("plain")
    )


def strip_suffix(c: Column, suffix: str = "_SR") -> Column:
    return F.when(c.endswith(suffix), F.substring(c, F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def truth(c: Column) -> Column:
    """yes/no words to boolean; an error for others, null for null."""
    low = F.lower(F.trim(c))
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a truth value: "), c)).cast("boolean"))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.greatest(F.length(c) - 1, F.lit(0)))))


def fill_template(template: str, fields: dict[str, Column]) -> Column:
    """``{name}``, ``{name:upper}``, ``{name:lower}``, ``{name:capitalize}`` filled from columns."""
    how = {"": lambda c: c, "upper": F.upper, "lower": F.lower, "capitalize": capitalize}
    parts = []
    for k, bit in enumerate(re.split(r"\{(\w+(?::\w*)?)\}", template)):
        if k % 2:
            name, _, spec = bit.partition(":")
            parts.append(how[spec](fields[name].cast("string")))
        elif bit:
            parts.append(F.lit(bit))
    return F.concat(*parts)


def version_tag(version: Column, legacy: bool = False) -> Column:
    return F.concat(F.lit("v"), F.lpad(version.cast("string"), 3, "0") if legacy else version.cast("string"))


def item_id(cube: Column, version: Column, tile: Column, date: Column) -> Column:
    """``CUBE_V2_000000_20170101``."""
    return F.concat_ws("_", F.upper(cube), F.concat(F.lit("V"), version.cast("string")), tile, F.date_format(date, "yyyyMMdd"))


def asset_path(prefix: str, cube: Column, version: Column, tile: Column, date: Column, band: Column, composed: bool = True) -> Column:
    """prefix/identity or composed/cube/v2/ttt/ttt/year/month/day/item_band.tif"""
    folder = F.lit("composed" if composed else "identity")
    day = [F.date_format(date, f) for f in ("yyyy", "MM", "dd")]
    name = F.concat(item_id(cube, version, tile, date), F.lit("_"), band, F.lit(".tif"))
    halves = F.substring(tile, 1, 3), F.right(tile, F.lit(3))
    return F.concat_ws("/", F.lit(prefix), folder, F.lower(cube), version_tag(version), *halves, *day, name)
