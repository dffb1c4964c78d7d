"""Golden vectors and properties of the data-cube operators."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from terraloom.__main__ import main
from terraloom.functions import expressions, identifiers, masks
from terraloom.operators import catalog, composite, grid, mosaic, timeline
from terraloom.plans import cube as plans
from terraloom.plans import document
from terraloom.sources import directory, gridfile, publish
from terraloom.streaming import recompose

D = dt.date


def periods(spark, *args, start, end):
    return [(r.period_start, r.period_end) for r in timeline.timeline(spark, timeline.Schema(*args), start, end).collect()]


def test_timelines(spark):
    year = {"start": D(2020, 1, 1), "end": D(2020, 12, 31)}
    assert len(periods(spark, "continuous", "month", **year)) == 12
    got = periods(spark, "continuous", "day", 16, **year)
    assert len(got) == 23 and got[-1][1].year == 2021
    got = periods(spark, "continuous", "day", 16, start=D(2020, 6, 12), end=D(2020, 12, 31))
    assert len(got) == 13 and got[0][0] == D(2020, 6, 12) and got[-1][1].year == 2021
    got = periods(spark, "cyclic", "day", 16, ("year", 1), **year)
    assert len(got) == 23 and got[-1][1] == D(2020, 12, 31) and (got[-1][1] - got[-1][0]).days < 15
    got = periods(spark, "cyclic", "day", 16, ("year", 1), start=D(2020, 6, 15), end=D(2020, 12, 31))
    assert len(got) == 12 and got[0][0] == D(2020, 6, 25) and got[-1][1] == D(2020, 12, 31)
    assert len(periods(spark, "cyclic", "month", 3, ("year", 1), **year)) == 4
    got = periods(spark, "cyclic", "month", 1, ("year", 1), ("08-01_10-31",), start=D(2000, 1, 1), end=D(2002, 12, 31))
    assert got == [(D(y, 8, 1), D(y, 10, 31)) for y in (2000, 2001, 2002)]
    got = periods(spark, "cyclic", "month", 1, ("year", 1), ("12-21_03-20", "03-21_06-20", "06-21_09-20", "09-21_12-20"), **year)
    assert len(got) == 5 and got[0][0] == D(2019, 12, 21) and got[-1][1] == D(2021, 3, 20)
    with pytest.raises(ValueError):
        timeline.timeline(spark, timeline.Schema("continuous", "month"), D(2021, 1, 1), D(2020, 1, 1))


@pytest.mark.parametrize(
    ("day", "want"),
    [(15, "01-15 01-12 01-18 01-07 01-23 01-28 01-01 02-01"), (2, "12-20 12-19 12-25 12-26"), (42, "05-03 04-25 05-31 04-18 06-13 04-01")],
)
def test_temporal_priority(spark, day, want):
    year = 2020 if day != 2 else 2019
    rows = [(D.fromisoformat(f"{year}-{x}"),) for x in sorted(want.split())]
    if day == 2:
        rows = [(D(2019, 12, 19),), (D(2019, 12, 20),), (D(2019, 12, 25),), (D(2019, 12, 26),)]
    got = timeline.temporal_priority(spark.createDataFrame(rows, "date date"), day).orderBy("priority").collect()
    assert [f"{r.date:%m-%d}" for r in got] == want.split()


def test_bits_and_masks(spark):
    x = spark.createDataFrame([(43, 1026), (0, 1037)], "a int, b int")
    r = x.select(*[masks.bit_test(F.col("a"), k).alias(str(k)) for k in (0, 1, 3, 5)], masks.bit_range(F.col("b"), 1, 7).alias("r")).collect()
    assert list(r[0])[:4] == [1, 2, 8, 32] and [y.r for y in r] == [1, 6]
    q = spark.createDataFrame([(22080,)], "q int")
    plain = masks.Mask((6, 7), 1, (1, 2, 3, 4), bits=True)
    cloudy = masks.Mask((6, 7), 1, (1, 2, 3, 4), bits=True, confidence="cloud == MEDIUM")
    assert tuple(q.select(masks.qa_usable(F.col("q"), plain), masks.qa_usable(F.col("q"), cloudy)).first()) == (True, False)
    rows = spark.createDataFrame([(0, None), (0, 5), (2, 5), (None, 5), (9, 5), (9, None)], "q int, v int")
    got = [r[0] for r in rows.select(masks.class_usable(F.col("q"), F.col("v"), masks.Mask((0, 1), 255, (2,)))).collect()]
    assert got == [True, True, False, False, True, False]
    with pytest.raises(ValueError):
        masks.Mask.parse({"clear_data": [1]})


def test_rescale_golden(spark):
    src = [17834, 16269, 8275, 27369, 15755, 19081, 21684, 20865, 24655, 21416, 8932, 32578, 27168, 21827, 11382, 37001]
    want = [2904, 2473, 275, 5526, 2332, 3247, 3963, 3737, 4780, 3889, 456, 6958, 5471, 4002, 1130, 8175]
    df = spark.createDataFrame([(v,) for v in src], "v int")
    assert [r[0] for r in df.select(expressions.rescale(F.col("v"), 2.75e-5, -0.2, 1e-4)).collect()] == want


def test_expressions_are_whitelisted(spark):
    for bad in ("__import__('os')", "nir.real", "f(nir)", "unknown + 1", "[1]", "'x'"):
        with pytest.raises(ValueError):
            expressions.to_column(bad, {"nir": F.lit(1)})
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 1.0), (None, 1.0)], "nir double, red double")
    got = [r[0] for r in df.select(expressions.index_band(expressions.NDVI, {c: F.col(c) for c in ("nir", "red")})).collect()]
    assert got == [None, 5000, None]


def sequential(scenes):
    """One pixel's history by the rule, scene after scene: (value, provenance)."""
    value, day, done = None, -1, False
    for v, usable, d in scenes:
        if not done and usable:
            value, day, done = v, d, True
        elif value is None and v is not None:
            value, day = v, d
    return value, day


def test_best_pixel_is_the_sequential_rule(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for p in range(400):
        hist = [(rng.choice([None, 1, 2, 3]), rng.random() < 0.4) for _ in range(rng.randint(1, 5))]
        days = [(v, u, 10 * (k + 1)) for k, (v, u) in enumerate(hist)]
        rows += [(p, k + 1, D(2021, 1, 1) + dt.timedelta(d - 1), v, u, 0) for k, (v, u, d) in enumerate(days)]
        want[p] = sequential(days)
    df = spark.createDataFrame(rows, "p int, rank int, date date, v int, usable boolean, q int")
    got = {r.p: (r.v, r.provenance) for r in composite.best_pixel(df, ["p"]).collect()}
    assert got == want
    safe = df.where("v IS NOT NULL OR NOT usable")
    a = {r.p: (r.v, r.provenance) for r in composite.best_pixel(safe, ["p"]).collect()}
    b = {r.p: (r.v, r.provenance) for r in composite.best_pixel_fast(safe, ["p"]).collect()}
    assert a == b


def test_scene_stats_and_median(spark):
    df = spark.createDataFrame([(0, 421), (0, 402), (4, 9), (None, None)], "q int, v int")
    r = composite.scene_stats(df.withColumn("k", F.lit(1)), ["k"], F.col("q") == 0, F.col("q") == 4).first()
    assert (r.efficacy, r.cloud) == (50.0, 33.33)
    empty = composite.scene_stats(df.where("q IS NULL").withColumn("k", F.lit(1)), ["k"], F.col("q") == 0, F.col("q") == 4).first()
    assert (empty.efficacy, empty.cloud) == (0.0, 100.0)
    m = composite.median(df.withColumn("k", F.lit(1)).withColumn("usable", F.coalesce(F.col("q") == 0, F.lit(False))), ["k"]).first()
    assert (m.v, m.clearob, m.totalob) == (411, 2, 3)


def test_mosaic_and_histogram(spark):
    df = spark.createDataFrame([(1, 1, 5, 0), (1, 2, None, 1), (1, 3, 7, 2), (2, 1, None, 0)], "p int, n int, v int, s int")
    last = {r.p: (r.v, r.s) for r in mosaic.mosaic(df, ["p"], F.col("n"), source="s").collect()}
    first = {r.p: (r.v, r.s) for r in mosaic.mosaic(df, ["p"], F.col("n"), source="s", first=True).collect()}
    assert last == {1: (7, 2), 2: (None, None)} and first == {1: (5, 0), 2: (None, None)}
    same = spark.createDataFrame([(1, v, v) for v in range(50)], "k int, s int, r int")
    assert composite.match_histograms(same, ["k"], "s", "r").where("matched <> s").count() == 0


def test_projections_round_trip(spark):
    df = spark.createDataFrame([(-54.0, -12.0), (-70.5, -31.0), (-40.25, 3.5)], "lon double, lat double")
    for there, back in ((grid.sinusoidal, grid.sinusoidal_inverse), (grid.albers, grid.albers_inverse)):
        x, y = there(F.col("lon"), F.col("lat"), -54)
        lon, lat = back(F.col("x"), F.col("y"), -54)
        r = df.withColumn("x", x).withColumn("y", y).select((lon - F.col("lon")).alias("a"), (lat - F.col("lat")).alias("b")).collect()
        assert max(abs(v) for q in r for v in q) < 1e-7
    x, y = grid.albers(F.lit(-54.0), F.lit(-12.0), -54)
    assert [round(v, 6) for v in spark.range(1).select(x, y).first()] == [5_000_000.0, 10_000_000.0]


def test_grid_and_hull(spark):
    g = grid.hierarchy(["a", "b"], (10.0, 10.0), [(2, 2), (1, 1)], (-5.0, -5.0, 30.0, 33.0))
    # A tile of 20 x 20 is centred at (0, 0); one tile to the left holds -5, two and one more upwards hold 33.
    assert g[0].origin == (-30.0, 70.0) and g[1].size == (10.0, 10.0)
    df = spark.createDataFrame([(1, r, c) for r in range(4) for c in range(5)], "k int, row int, col int")
    assert grid.convex_hull(df, ["k"]).first().hull == [[0.0, 0.0], [4.0, 0.0], [4.0, 3.0], [0.0, 3.0]]
    line = df.where("row = 1").withColumn("k", F.lit(2)).union(df)
    assert [r.k for r in grid.footprints(line.select("k", "row", "col"), ["k"]).collect()] == [1]


def test_names(spark):
    df = spark.range(1)
    day = F.lit(D(2017, 1, 1))
    assert df.select(identifiers.item_id(F.lit("MyCube"), F.lit(2), F.lit("000000"), day)).first()[0] == "MYCUBE_V2_000000_20170101"
    assert identifiers.parse_baseline("N0400") == (4, 0) and identifiers.parse_baseline("N0301") == (3, 1)
    for bad in ("X0400", "N04"):
        with pytest.raises(ValueError):
            identifiers.parse_baseline(bad)
    assert df.select(identifiers.canonical_band(F.lit("B1")), identifiers.canonical_band(F.lit("B8A"))).first()[:] == ("B01", "B8A")
    assert df.select(identifiers.landsat_platform(F.lit("LC08_L1TP_1_2_3_01_T1")), identifiers.strip_suffix(F.lit("a_SR"))).first()[:] == ("Landsat-8", "a")
    with pytest.raises(Exception):  # noqa: B017
        df.select(identifiers.truth(F.lit("perhaps"))).collect()


def test_definitions():
    bands = (plans.Band("nir", "nir"), plans.Band("q", "quality"))
    ok = {"mask": {"clear_data": [0], "nodata": 255}}
    c = plans.Cube("c", 1, "g", "LCF", timeline.Schema("continuous", "month"), bands, quality_band="q", parameters=ok)
    assert c.all_bands() == ["nir", "q", "CLEAROB", "TOTALOB", "PROVENANCE"] and c.identity().function == "IDT"
    assert plans.may_reuse(c, c.identity()) and not plans.may_reuse(c, c.identity(), force=True)
    for change in ({"quality_band": None}, {"quality_band": "x"}, {"function": "AVG"}, {"indexes": (plans.Band("nir", "ndvi"),)}, {"parameters": {}}):
        with pytest.raises(ValueError):
            plans.Cube(**({"name": "c", "version": 1, "grid": "g", "function": "LCF", "schema": c.schema, "bands": bands, "quality_band": "q", "parameters": ok} | change))
    assert plans.merge_parameters({"a": 1, "b": 2}, {"b": None, "c": 3}) == {"a": 1, "c": 3}


def test_build_median_and_reference_day(spark):
    rows = [("t", D(2020, 1, d), 0, 0, d, 100 * d, 50, 0) for d in (1, 11, 21)]
    df = spark.createDataFrame(rows, "tile string, date date, row int, col int, asset_seq int, nir int, red int, quality int")
    from terraloom.queries import demo_cube

    per = spark.createDataFrame([(D(2020, 1, 1), D(2020, 12, 31))], "period_start date, period_end date")
    assert plans.build(df, per, demo_cube("MED")).first().nir == 1100
    assert plans.build(df, per, demo_cube()).first().nir == 2100
    import dataclasses

    c = demo_cube()
    r = plans.build(df, per, dataclasses.replace(c, parameters=c.parameters | {"reference_day": 10})).first()
    assert (r.nir, r.provenance) == (1100, 11)


def test_sources_and_sinks(spark, tmp_path):
    pixels = spark.createDataFrame([("t", "b", "2020-01-01", r, c, r * 10 + c) for r in range(5) for c in range(7)], "tile string, band string, date string, row int, col int, v int")
    keys = ["tile", "band", "date"]
    publish.write_blocks(mosaic.to_blocks(pixels, keys, 4), str(tmp_path / "out"))
    back = mosaic.to_pixels(directory.read_blocks(spark, str(tmp_path / "out")).withColumn("date", F.col("date").cast("string")), keys, 4).where("v IS NOT NULL")
    assert back.exceptAll(pixels.select(*back.columns)).count() == 0 and back.count() == 35
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "SCENE1_20200105_B04.tif").write_bytes(b"x")
    fmt = directory.Format("f", "^SCENE", r"_(\d{8})_", "yyyyMMdd", {"B04": "B04"})
    r = directory.scan(directory.list_files(spark, str(tmp_path / "in"), True), fmt, "2020-01-01", "2020-01-31").collect()
    assert [(x.band, x.date, x.reader) for x in r] == [("B04", D(2020, 1, 5), "plain")]
    assert publish.empty_raster(spark, 95.0, 45.0, 10.0, -9999).count() == round(9.5) * round(4.5)


def test_stream_recomposes_touched_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 6), (1, 7)], "k int, v int")
    df.write.parquet(str(tmp_path / "in"))
    got = {}
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = recompose.recompose_stream(stream.where("k = 1"), ["k"], lambda: spark.read.parquet(str(tmp_path / "in")), lambda h: h.groupBy("k").agg(F.max("v").alias("v")), lambda out, n: got.update({r.k: r.v for r in out.collect()}), str(tmp_path / "ck"))
    q.awaitTermination()
    assert got == {1: 7}


def test_catalogue(spark):
    e = spark.createDataFrame([(3, 2), (2, 1)], "id int, source int")
    got = {tuple(r) for r in catalog.lineage(e, e.select("id").distinct()).collect()}
    assert got == {(3, 2, 1), (3, 1, 2), (2, 1, 1)}
    old, new = spark.createDataFrame([(1, 1, "o"), (2, 5, "o")], "k int, at int, s string"), spark.createDataFrame([(1, 1, "n"), (2, 4, "n"), (3, 1, "n")], "k int, at int, s string")
    assert {r.k: r.s for r in catalog.upsert(old, new, ["k"], "at").collect()} == {1: "n", 2: "o", 3: "n"}
    assert {r.k: r.s for r in catalog.get_or_create(old, new, ["k"]).collect()} == {1: "o", 2: "o", 3: "n"}
    cycle = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(60, 0)], "id int, source int")
    got = catalog.lineage(cycle, spark.createDataFrame([(0,)], "id int"))
    assert {(r.ancestor, r.depth) for r in got.collect()} == {(k, k or 61) for k in range(61)}
    near = catalog.first_ancestor(got, spark.createDataFrame([(7, "IDT"), (3, "LCF"), (9, "IDT")], "id int, function string"), "IDT")
    assert near.collect()[0][:] == (0, 7)


def test_links_of_an_asset_stay_in_their_partitions(spark):
    rows = [(k, "S", f"2020-01-{k % 28 + 1:02}T10:00:00", {"B4": f"r{k}", "B8": f"n{k}", "meta": "m"}) for k in range(400)] + [(400, "S", None, {"B8": "n400"}), (401, "S", "2020-01-01", None), (402, "S", "2020-01-01", {})]
    items = spark.createDataFrame(rows, "scene int, dataset string, datetime string, assets map<string,string>").repartition(4)
    bands = spark.createDataFrame([("B4", "red"), ("B4", "r"), ("B8", "nir"), ("B9", "cirrus"), (None, "none")], "asset string, band string")
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")  # the default: at few partitions Spark undoes the shuffle by itself
    try:
        got = catalog.normalized_scenes(items, bands).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
    want = {(k, "S", D(2020, 1, k % 28 + 1), b, f"{b[0]}{k}") for k in range(400) for b in ("red", "r", "nir")} | {(400, "S", None, "nir", "n400")}
    assert {r[:5] for r in got} == want and len(got) == len(want)
    assert all(len({r.p for r in got if r.band == b}) == 4 for b in ("red", "r", "nir"))


def test_definitions_are_created_and_changed(spark):
    bands = (plans.Band("nir", "nir"), plans.Band("q", "quality"))
    c = plans.Cube("c", 1, "g", "LCF", timeline.Schema("continuous", "month"), bands, (), "q", {"mask": {"clear_data": [0], "nodata": 255}, "a": 1})
    none = spark.createDataFrame([], "name string, version int")
    cubes, edges = plans.create(c, none)
    assert {r["name"] for r in cubes.collect()} == {"c", "c_IDT"} and edges.collect()[0][:] == ("c", "c_IDT")
    assert [r["name"] for r in plans.create(c, spark.createDataFrame([("c_IDT", 1)], none.schema))[0].collect()] == ["c"]
    with pytest.raises(ValueError):
        plans.create(c, spark.createDataFrame([("c", 1)], none.schema))
    assert plans.changed(c, parameters={"a": None, "b": 2}).parameters == {"mask": c.parameters["mask"], "b": 2}
    for bad in ({"function": "MED"}, {"bands": bands[:1]}):
        with pytest.raises(ValueError):
            plans.changed(c, **bad)
    assert plans.repair_value(["S2-L2A"]) == 1 and plans.repair_value(["LC8SR-1"]) is None
    assert masks.literal_mask("{'clear_data': [0, 1], 'bits': True}") == {"clear_data": [0, 1], "bits": True}
    assert timeline.asked_range("2020-01-05T00:00:00Z") == (D(2020, 1, 5), D(2019, 12, 31))


def test_bits_rank_scenes_by_usable_words(spark):
    # The later date has one usable pixel of four, the earlier is clear: it must win.
    rows = [(1, D(2020, 1, 5), 0, k, 1, 64, 100 + k) for k in range(4)] + [(1, D(2020, 1, 20), 0, k, 2, 64 if not k else 2, 200 + k) for k in range(4)]
    assets = spark.createDataFrame(rows, "tile int, date date, row int, col int, asset_seq int, q int, nir int").withColumn("source", F.lit(0))
    mask = {"clear_data": [6], "not_clear_data": [1], "nodata": 1, "bits": True}
    cube = plans.Cube("c", 1, "g", "LCF", timeline.Schema("continuous", "month"), (plans.Band("nir", "nir"), plans.Band("q", "quality")), (), "q", {"mask": mask})
    periods = timeline.timeline(spark, cube.schema, D(2020, 1, 1), D(2020, 1, 31))
    got = plans.build(assets, periods, cube).orderBy("col").collect()
    assert [r.nir for r in got] == [100, 101, 102, 103] and {r.provenance for r in got} == {5} and [r.clearob for r in got] == [2, 1, 1, 1]


def test_alignment_and_files(spark, tmp_path):
    source = spark.createDataFrame([(1, r, c, 10 * r + c) for r in range(4) for c in range(4)], "k int, row int, col int, v int")
    half = mosaic.reproject_nearest(source, source.select("k").distinct(), ["k"], (0.0, 4.0, 1.0, 1.0), (0.0, 4.0, 2.0, 2.0), (2, 3))
    assert {(r.row, r.col): r.v for r in half.collect()} == {(0, 0): 11, (0, 1): 13, (0, 2): None, (1, 0): 31, (1, 1): 33, (1, 2): None}
    long = spark.createDataFrame([(1, "nir", 5), (1, "sat", 2), (2, "nir", 6)], "p int, band string, v int")
    assert mosaic.attach_saturation(long.where("p = 1"), ["p"], "sat").collect()[0][:] == (1, "nir", 5, 2)
    with pytest.raises(Exception):  # noqa: B017
        mosaic.attach_saturation(long, ["p"], "sat").collect()
    (tmp_path / "a.asc").write_text("ncols 3\nnrows 2\nxllcorner 100\nyllcorner 50\ncellsize 10\nNODATA_value -9\n1 2 -9\n4 5.5 6\n")
    (tmp_path / "b.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\n1 2\n")
    files = gridfile.open_grids(spark, str(tmp_path)).withColumn("path", F.substring_index("path", "/", -1))
    assert gridfile.profile(files).where("path = 'a.asc'").collect()[0][1:] == (3, 2, 100.0, 70.0, 10.0, -9.0)
    assert {r.path: r.whole for r in gridfile.integrity(files).collect()} == {"a.asc": True, "b.asc": False}
    assert sorted((r.row, r.col, r.v) for r in gridfile.read_pixels(files.where("path = 'a.asc'")).collect() if r.v is not None) == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 4.0), (1, 1, 5.5), (1, 2, 6.0)]
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"PAR1 cut off here")
    held = publish.readable(spark.read.format("binaryFile").load(str(tmp_path / "p" / "*.parquet"))).collect()
    assert sorted(r.readable for r in held) == [False, True]


def test_extent_of_projected_bounds(spark):
    x, y = grid.albers(F.lit(-50.0), F.lit(-10.0), -54)
    at = spark.range(1).select(x.alias("xmin"), y.alias("ymin")).select("*", F.col("xmin").alias("xmax"), F.col("ymin").alias("ymax"))
    got = grid.raster_extent(at, "aea", -54).first()
    assert abs(got.west + 50) < 1e-6 and abs(got.north + 10) < 1e-6
    centre, box = grid.projected(spark, "sinu", -54, (-60.0, -20.0, -50.0, 0.0))
    assert abs(centre[0]) < 1e-6 and box[0] < 0 < box[2] and box[1] < centre[1] < box[3]


def test_stored_definition_is_built(spark, tmp_path):
    doc = {
        "datacube": "demo", "grs": "g", "composite_function": "LCF", "quality_band": "q", "version": 2,
        "temporal_composition": {"schema": "Cyclic", "unit": "day", "step": 16, "cycle": {"unit": "year", "step": 1}},
        "bands": [{"name": "nir", "common_name": "nir", "data_type": "int16", "nodata": -9999}, {"name": "red", "common_name": "red"}, {"name": "q", "common_name": "quality", "data_type": "uint8", "nodata": 255}],
        "indexes": [{"name": "X", "common_name": "x", "metadata": {"expression": {"bands": ["nir", "red"], "value": "nir - red"}}}],
        "parameters": {"mask": {"clear_data": [0], "not_clear_data": [1], "nodata": 255}},
    }
    (tmp_path / "cube.json").write_text(json.dumps(doc))
    rows = [("t", D(2020, 1, d), 0, 0, d, 0, q, n, 5) for d, q, n in ((3, 1, 10), (9, 0, 20), (20, 0, 30))]
    spark.createDataFrame(rows, "tile string, date date, row int, col int, asset_seq int, source int, q int, nir int, red int").write.parquet(str(tmp_path / "in"))
    main(["build", "--cube", str(tmp_path / "cube.json"), "--assets", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--start", "2020-01-01", "--end", "2020-02-01"])
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("period_start").collect()
    assert [(r.period_start, r.nir, r.X, r.provenance) for r in got] == [(D(2020, 1, 1), 20, 15, 9), (D(2020, 1, 17), 30, 25, 20)]
    assert document.parse_cube(doc, {"mask": None, "mask_": 1} | {"mask": doc["parameters"]["mask"]}).version == 2

