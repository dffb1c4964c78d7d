"""Tile grids: enumeration, hierarchies, closed-form projections, and predicates over bounding boxes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ellipsoid (GRS80), the sphere of the sinusoidal grid, and the equal-area grid's parameters.
A, INV_F = 6378137.0, 298.257222101
SPHERE = 6371007.181
AEA = {"lat_0": -12.0, "lat_1": -2.0, "lat_2": -22.0, "x_0": 5_000_000.0, "y_0": 10_000_000.0}
E2 = 2 / INV_F - 1 / INV_F**2


def enumerate_tiles(spark: SparkSession, origin: tuple[float, float], size: tuple[float, float], box: tuple[float, float, float, float], srid: int = 0) -> DataFrame:
    """(tile, ix, iy, xmin, ymin, xmax, ymax, srid) of the tiles that touch ``box``, from the upper left origin."""
    (gx, gy), (w, h), (x0, y0, x1, y1) = origin, size, box
    cols, rows = (int((x0 - gx) / w), int((x1 - gx) / w)), (int((gy - y1) / h), int((gy - y0) / h))
    at = spark.range(1).select(F.explode(F.sequence(F.lit(cols[0]), F.lit(cols[1]))).alias("ix")).select("ix", F.explode(F.sequence(F.lit(rows[0]), F.lit(rows[1]))).alias("iy"))
    name = F.concat(F.lpad(F.col("ix").cast("string"), 3, "0"), F.lpad(F.col("iy").cast("string"), 3, "0"))
    left, top = F.lit(gx) + F.col("ix") * F.lit(w), F.lit(gy) - F.col("iy") * F.lit(h)
    return at.select(name.alias("tile"), "ix", "iy", left.alias("xmin"), (top - F.lit(h)).alias("ymin"), (left + F.lit(w)).alias("xmax"), top.alias("ymax"), F.lit(srid).alias("srid"))


@dataclass(frozen=True)
class Grid:
    name: str
    origin: tuple[float, float]
    size: tuple[float, float]


def hierarchy(names: list[str], shape: tuple[float, float], factors: list[tuple[int, int]], box: tuple[float, float, float, float], centre: tuple[float, float] = (0.0, 0.0)) -> list[Grid]:
    """Grids of shape x factor that share an origin.

    A tile of the first grid is centred at ``centre`` (the meridian's point in the projection); whole tiles are counted from it
    to the left edge of the projected ``box`` and, with one more, to its top.
    """
    w, h = shape[0] * factors[0][0], shape[1] * factors[0][1]
    left, top = centre[0] - w / 2, centre[1] + h / 2
    origin = (left - math.ceil(abs(left - box[0]) / w) * w, top + (math.ceil(abs(top - box[3]) / h) + 1) * h)
    return [Grid(n, origin, (shape[0] * fx, shape[1] * fy)) for n, (fx, fy) in zip(names, factors, strict=True)]


def project(kind: str, lon: Column, lat: Column, meridian: float) -> tuple[Column, Column]:
    if kind == "longlat":
        return lon, lat
    return albers(lon, lat, meridian) if kind == "aea" else sinusoidal(lon, lat, meridian)


def projected(spark: SparkSession, kind: str, meridian: float, box: tuple[float, float, float, float]) -> tuple[tuple[float, float], tuple[float, float, float, float]]:
    """(centre, envelope) for ``hierarchy``: the meridian's point at 12 degrees south and the box's corners in the projection."""
    corners = [(0, float(meridian), -12.0), *((1, float(x), float(y)) for x in (box[0], box[2]) for y in (box[1], box[3]))]
    rows = spark.createDataFrame(corners, "corner int, lon double, lat double")
    x, y = project(kind, F.col("lon"), F.col("lat"), meridian)
    got = rows.select("corner", x.alias("x"), y.alias("y")).collect()
    xs, ys = [r.x for r in got if r.corner], [r.y for r in got if r.corner]
    return next((r.x, r.y) for r in got if not r.corner), (min(xs), min(ys), max(xs), max(ys))


def raster_extent(rasters: DataFrame, kind: str, meridian: float) -> DataFrame:
    """(columns of ``rasters``, west, south, east, north): projected bounds (xmin, ymin, xmax, ymax) as degrees, by their corners."""
    inverse = {"aea": albers_inverse, "sinu": sinusoidal_inverse}.get(kind)
    at = [(F.col(x), F.col(y)) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    ends = [inverse(x, y, meridian) if inverse else (x, y) for x, y in at]
    lon, lat = [e[0] for e in ends], [e[1] for e in ends]
    return rasters.withColumns({"west": F.least(*lon), "south": F.least(*lat), "east": F.greatest(*lon), "north": F.greatest(*lat)})


def projection_string(kind: str, meridian: float) -> str:
    if kind == "aea":
        return "+proj=aea +lat_0={lat_0:g} +lon_0={m:g} +lat_1={lat_1:g} +lat_2={lat_2:g} +x_0={x_0:g} +y_0={y_0:g} +ellps=GRS80 +units=m +no_defs".format(m=meridian, **AEA)
    if kind == "sinu":
        return f"+proj=sinu +lon_0={meridian:g} +x_0=0 +y_0=0 +a={SPHERE} +b={SPHERE} +units=m +no_defs"
    return "+proj=longlat +ellps=GRS80 +no_defs"


def sinusoidal(lon: Column, lat: Column, meridian: float) -> tuple[Column, Column]:
    phi = F.radians(lat)
    return F.lit(SPHERE) * F.radians(lon - F.lit(float(meridian))) * F.cos(phi), F.lit(SPHERE) * phi


def sinusoidal_inverse(x: Column, y: Column, meridian: float) -> tuple[Column, Column]:
    phi = y / F.lit(SPHERE)
    return F.degrees(x / (F.lit(SPHERE) * F.cos(phi))) + F.lit(float(meridian)), F.degrees(phi)


def _q(s):
    """Authalic q of a sine of latitude, on numbers."""
    e = math.sqrt(E2)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))


def _aea_constants() -> tuple[float, float, float]:
    s = {k: math.sin(math.radians(AEA[k])) for k in ("lat_0", "lat_1", "lat_2")}
    m = {k: math.cos(math.radians(AEA[k])) / math.sqrt(1 - E2 * s[k] ** 2) for k in ("lat_1", "lat_2")}
    n = (m["lat_1"] ** 2 - m["lat_2"] ** 2) / (_q(s["lat_2"]) - _q(s["lat_1"]))
    c = m["lat_1"] ** 2 + n * _q(s["lat_1"])
    return n, c, A * math.sqrt(c - n * _q(s["lat_0"])) / n


def albers(lon: Column, lat: Column, meridian: float) -> tuple[Column, Column]:
    """Equal-area conic over the ellipsoid with the grid's fixed parallels."""
    n, c, rho_0 = _aea_constants()
    e, s = math.sqrt(E2), F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (s / (1 - F.lit(E2) * s * s) - F.ln((1 - F.lit(e) * s) / (1 + F.lit(e) * s)) / F.lit(2 * e))
    rho = F.lit(A) * F.sqrt(F.lit(c) - F.lit(n) * q) / F.lit(n)
    theta = F.lit(n) * F.radians(lon - F.lit(float(meridian)))
    return F.lit(AEA["x_0"]) + rho * F.sin(theta), F.lit(AEA["y_0"]) + F.lit(rho_0) - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, meridian: float) -> tuple[Column, Column]:
    """Longitude and latitude; the latitude by the series of the authalic latitude (under a millimetre)."""
    n, c, rho_0 = _aea_constants()
    dx, dy = x - F.lit(AEA["x_0"]), F.lit(rho_0) - (y - F.lit(AEA["y_0"]))
    sign = 1 if n > 0 else -1
    rho = F.sqrt(dx * dx + dy * dy)
    theta = F.atan2(dx * sign, dy * sign)
    q = (F.lit(c) - rho * rho * F.lit(n * n / A**2)) / F.lit(n)
    beta = F.asin(q / F.lit(_q(1.0)))
    e2, e4, e6 = E2, E2**2, E2**3
    terms = ((2, e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040), (4, 23 * e4 / 360 + 251 * e6 / 3780), (6, 761 * e6 / 45360))
    lat = beta
    for k, t in terms:
        lat = lat + F.lit(t) * F.sin(beta * k)
    return F.degrees(theta / F.lit(n)) + F.lit(float(meridian)), F.degrees(lat)


def box_intersects(a: tuple[str, str, str, str], b: tuple) -> Column:
    """Whether two boxes (xmin, ymin, xmax, ymax) of columns or numbers touch."""
    ax0, ay0, ax1, ay1 = (F.col(c) for c in a)
    bx0, by0, bx1, by1 = (F.col(c) if isinstance(c, str) else F.lit(float(c)) for c in b)
    return (ax0 <= bx1) & (bx0 <= ax1) & (ay0 <= by1) & (by0 <= ay1)


def box_join(left: DataFrame, right: DataFrame, a: tuple[str, str, str, str], b: tuple[str, str, str, str], cell: float) -> DataFrame:
    """Pairs of rows whose boxes touch, each once. Boxes are dealt to square cells; a pair meets in its least common cell."""

    def dealt(df: DataFrame, box: tuple[str, str, str, str], tag: str) -> DataFrame:
        lo, hi = [F.floor(F.col(box[k]) / cell) for k in (0, 1)], [F.floor(F.col(box[k]) / cell) for k in (2, 3)]
        df = df.withColumn("__cx", F.explode(F.sequence(lo[0], hi[0]))).withColumn("__cy", F.explode(F.sequence(lo[1], hi[1])))
        return df.withColumns({f"__{tag}x": lo[0], f"__{tag}y": lo[1]})

    both = dealt(left, a, "l").join(dealt(right, b, "r"), ["__cx", "__cy"]).where(box_intersects(a, b))
    once = (F.col("__cx") == F.greatest("__lx", "__rx")) & (F.col("__cy") == F.greatest("__ly", "__ry"))
    return both.where(once).drop("__cx", "__cy", "__lx", "__ly", "__rx", "__ry")


def spatial_reference(column: Column | None, geometry: Column | None, default: int = 4326) -> Column:
    """The row's own srid, else the geometry's, else the default."""
    return F.coalesce(*[c for c in (column, geometry) if c is not None], F.lit(default))


def unknown_tiles(wanted: DataFrame, tiles: DataFrame) -> DataFrame:
    """Wanted tile names that the grid doesn't have."""
    return wanted.select("tile").distinct().join(tiles.select("tile").distinct(), "tile", "left_anti")


def target_shape(dist_x: Column, dist_y: Column, res_x: Column, res_y: Column, truncate: bool = False) -> dict[str, Column]:
    """Columns and rows of a target raster (half to even, or cut) and its effective resolutions."""
    whole = (lambda c: F.floor(c)) if truncate else (lambda c: F.bround(c, 0))
    cols, rows = whole(dist_x / res_x).cast("long"), whole(dist_y / res_y).cast("long")
    return {"cols": cols, "rows": rows, "eff_x": dist_x / cols, "eff_y": dist_y / rows}


def convex_hull(points: DataFrame, keys: list[str], x: str = "col", y: str = "row") -> DataFrame:
    """(keys, hull): the corners of the convex hull of each group's points, counter-clockwise from the least.

    First only the ends of each row of points stay, by an aggregation with partial sums, so that a group's task gets two
    points for each raster row and not one for each pixel. The hull itself needs an imperative scan.
    """
    ends = points.groupBy(*keys, y).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    schema = ", ".join(f"`{k}` {ends.schema[k].dataType.simpleString()}" for k in keys) + ", hull array<array<double>>"

    def hull(pdf):
        pts = sorted({(float(a), float(r)) for lo, hi, r in zip(pdf["lo"], pdf["hi"], pdf[y], strict=True) for a in (lo, hi)})

        def chain(seq):
            out = []
            for p in seq:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                    out.pop()
                out.append(p)
            return out

        corners = pts if len(pts) < 3 else chain(pts)[:-1] + chain(pts[::-1])[:-1]
        head = pdf.iloc[:1][keys].copy()
        head["hull"] = [[list(p) for p in corners]]
        return head

    return ends.groupBy(*keys).applyInPandas(hull, schema)


def footprints(valid: DataFrame, keys: list[str], x: str = "col", y: str = "row") -> DataFrame:
    """``convex_hull`` of the valid pixels for the keys whose hull has an area."""
    area = F.aggregate(
        F.sequence(F.lit(0), F.size("hull") - 1), F.lit(0.0),
        lambda s, k: s + F.get(F.get("hull", k), F.lit(0)) * F.get(F.get("hull", (k + 1) % F.size("hull")), F.lit(1)) - F.get(F.get("hull", (k + 1) % F.size("hull")), F.lit(0)) * F.get(F.get("hull", k), F.lit(1)),
    )
    return convex_hull(valid, keys, x, y).where((F.size("hull") > 2) & (F.abs(area) > 0))

