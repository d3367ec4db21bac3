import math

import pytest
from pyspark.sql import functions as F

from terraloom.functions import scalar as fn
from terraloom.functions.kernel import ensure, geo, with_bounds
from terraloom.operators import attributes as at
from terraloom.operators.graph import connected_components, greedy_match
from terraloom.operators.spatial import box_pairs, dissolve, spatial_join, subdivide
from terraloom.plans import composites as cp

A = "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
BOW = "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"


@pytest.fixture(scope="module")
def shapes(spark):
    ensure(spark)
    ensure(spark)
    rows = [(1, A), (2, "POLYGON ((2 2, 6 2, 6 6, 2 6, 2 2))"), (3, "MULTIPOLYGON (((10 10, 11 10, 11 11, 10 10)), ((20 20, 21 20, 21 21, 20 20)))"), (4, None), (5, "POLYGON EMPTY")]
    return with_bounds(spark.createDataFrame(rows, "fid int, wkt string").withColumn("geom", geo("from_text", "wkt")))


def one(df, c):
    return df.select(c.alias("v")).first().v


def test_overlay_identities(shapes):
    pair = box_pairs(shapes.where("fid = 1"), shapes.where("fid = 2"), 1.0)
    area = lambda op: one(pair, geo("area", geo(op, "l_geom", "r_geom")))
    a = one(shapes.where("fid = 1"), geo("area", "geom"))
    assert a == 15.0 and area("intersection") == 4.0
    assert area("intersection") + area("difference") == a
    assert area("union") == a + 16.0 - 4.0


def test_kernel_functions(spark, shapes):
    f = shapes.where("fid = 1")
    r = math.sqrt(2)
    grown = one(f, geo("area", geo("buffer", "geom", 1.0)))
    assert 15 + 16 < grown < 16 + 16 + math.pi
    assert one(f, geo("is_ccw", geo("orient", "geom"))) and not one(f, geo("is_ccw", "geom"))
    assert one(f, F.size(geo("holes", "geom"))) == 1 and one(f, geo("unique_vertices", geo("exterior", "geom"))) == 4
    assert one(f, geo("text", geo("point_along", geo("exterior", "geom"), 5.0))) == "POINT (1 4)"
    assert one(f, geo("distance", "geom", geo("from_text", F.lit("POINT (5 5)")))) == pytest.approx(r)
    assert one(f, geo("text", geo("nearest_on", geo("from_text", F.lit("POINT (9 2)")), "geom"))) == "POINT (4 2)"
    bow = spark.range(1).select(geo("from_text", F.lit(BOW)).alias("geom"))
    assert not one(bow, geo("is_valid", "geom")) and "ntersection" in one(bow, geo("invalid_reason", "geom"))
    assert one(bow, geo("area", geo("make_valid", "geom"))) == 2.0
    assert one(shapes.where("fid = 4"), geo("area", "geom")) is None
    assert one(shapes.where("fid = 5"), geo("is_empty", "geom")) and one(shapes.where("fid = 5"), F.col("x0")) is None
    assert one(f, geo("contains", "geom", geo("inside_point", "geom")))


def test_parts_types_and_violations(shapes):
    assert cp.single_parts(shapes.where("fid = 3")).count() == 2
    polygons, rest = cp.split_by_type(shapes)
    assert {r.fid for r in polygons.collect()} == {1, 2, 3, 5} and [r.fid for r in rest.collect()] == [4]
    assert {(r.fid, r.reason) for r in cp.geometry_violations(shapes).collect()} == {(4, "null"), (5, "empty")}
    with pytest.raises(ValueError, match="features"):
        cp.clip_land(shapes, shapes.limit(0), 1.0)


def test_clip_removes_feature_wholly_on_land(shapes):
    land = with_bounds(shapes.where("fid = 2").withColumn("geom", geo("buffer", "geom", 5.0)))
    left = cp.clip_land(shapes.where("fid in (1, 2, 3)"), land, 2.0)
    assert sorted(r.fid for r in left.collect()) == [1, 3] or sorted(r.fid for r in left.collect()) == [3]
    assert cp.clip_land(shapes, land, 2.0, strict=False).where("fid = 2").count() == 0


def test_subdivide_and_dissolve_keep_area(shapes):
    f = shapes.where("fid in (1, 2)").withColumn("k", F.lit("x"))
    cut = subdivide(f, 1.5)
    assert cut.agg(F.round(F.sum(geo("area", "geom")), 9)).first()[0] == 31.0
    assert dissolve(cut, ["k"], 3.0).select(F.round(geo("area", "geom"), 9)).first()[0] == 27.0


def test_joins_on_touch_and_empty(spark):
    s = "fid bigint, x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0), (3, None, None, None, None)], s)
    b = spark.createDataFrame([(7, 1.0, 1.0, 2.0, 2.0), (8, -5.0, -5.0, 9.0, 9.0)], s)
    assert {(r.l_fid, r.r_fid) for r in box_pairs(a, b, 0.7).collect()} == {(1, 7), (1, 8), (2, 8)}
    assert box_pairs(a, b, 0.7).count() == 3
    assert {(r.l_fid, r.r_fid) for r in spatial_join(a, b, 0.7, how="left").collect()} == {(1, 7), (1, 8), (2, 8), (3, None)}
    assert [r.fid for r in spatial_join(a, b, 0.7, how="anti").collect()] == [3]
    assert box_pairs(a.limit(0), b, 1.0).count() == 0 and spatial_join(a, b.limit(0), 1.0, how="semi").count() == 0
    assert {(r.l_fid, r.r_fid) for r in box_pairs(a, b.where("fid = 7"), 0.7, within=3.0).collect()} == {(1, 7), (2, 7)}


def test_components_and_greedy(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a bigint, b bigint")
    v = spark.createDataFrame([(500,), (7,)], "v bigint")
    got = {r.v: r.component for r in connected_components(e, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert {r.v: r.component for r in connected_components(e, "a", "b", v).collect()} == {500: 500, 7: 0}
    assert connected_components(e.limit(0), "a", "b").count() == 0
    p = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (2, 1, 0.85), (2, 2, 0.7), (3, 3, 0.5), (3, 4, 0.5)], "a bigint, b bigint, s double")
    assert {(r.a, r.b) for r in greedy_match(p, "a", "b", "s").collect()} == {(1, 1), (2, 2), (3, 3)}
    assert greedy_match(p.limit(0), "a", "b", "s").count() == 0


def test_geodesic_and_projection(spark):
    import numpy as np

    # Published test line: Flinders Peak to Buninyon, 54 972.271 m on GRS80.
    d = fn.geodesic_metres(np.array([-37.95103341]), np.array([144.42486789]), np.array([-37.65282114]), np.array([143.92649554]))[0]
    assert d == pytest.approx(54972.271, abs=0.02)
    same = fn.geodesic_metres(np.array([1.0, np.nan]), np.array([2.0, 1.0]), np.array([1.0, 1.0]), np.array([2.0, 1.0]))
    assert same[0] == 0.0 and np.isnan(same[1])
    df = spark.createDataFrame([(134.0, -25.0), (115.5, -31.9), (153.0, -9.5)], "lon double, lat double")
    x, y = fn.lonlat_to_3112(F.col("lon"), F.col("lat"))
    got = df.select(x.alias("x"), y.alias("y")).collect()
    assert abs(got[0].x) < 1e-6 and got[1].x < 0 < got[2].x
    mx, my = fn.lonlat_to_mercator(F.col("lon"), F.col("lat"))
    lon, lat = fn.mercator_to_lonlat(mx, my)
    assert df.where((F.abs(lon - F.col("lon")) > 1e-9) | (F.abs(lat - F.col("lat")) > 1e-9)).count() == 0


def test_size_class_uses_unrounded_width(spark):
    w = spark.createDataFrame([(99.96,), (100.0,), (3000.0,), (-1.0,), (None,)], "w double")
    got = [tuple(r) for r in w.select(fn.half_even(F.col("w"), 1), fn.size_class(F.col("w"))).collect()]
    assert got == [(100.0, "Very small"), (100.0, "Small"), (3000.0, "Very large"), (-1.0, "Very large"), (None, "Very large")]


def test_attribute_rules(spark):
    df = spark.createDataFrame([("a", " Land ", "Odd", "High", "12.7"), ("a", "", "Deep", "??", "x"), ("a", None, None, None, None), ("b", None, "", "Low", "NA")], "k string, att string, dep string, conf string, num string")
    got = {r.k: r for r in df.groupBy("k").agg(at.pick_attachment("att").alias("a"), at.pick_depth("dep").alias("d"), at.worst_confidence("conf").alias("c"), at.max_whole("num").alias("n"), at.joined_set("dep").alias("j")).collect()}
    assert (got["a"].a, got["a"].d, got["a"].c, got["a"].n, got["a"].j) == ("Land", "Deep", "??", 12, "Deep;Odd")
    assert (got["b"].a, got["b"].d, got["b"].c, got["b"].n, got["b"].j) == ("", "", "Low", 0, "")
    with pytest.raises(ValueError, match="missing"):
        at.require_columns(df, ["k", "nope"])
    ids = at.sequential_id(df.withColumn("o", F.monotonically_increasing_id()), [-F.col("o")], "id").orderBy("id").collect()
    assert [r.id for r in ids] == [1, 2, 3, 4] and [r.o for r in ids] == sorted((r.o for r in ids), reverse=True)


def test_crosswalk_rejects_double_class(spark):
    cw = spark.createDataFrame([("A; B", "x"), ("B", "y"), (None, "z")], "old string, new string")
    f = spark.createDataFrame([(1, "A"), (2, "q")], "fid int, cls string")
    with pytest.raises(ValueError, match="twice"):
        cp.crosswalk_by_list(f, cw, "old", "new", "cls")
    ok = cp.crosswalk_by_list(f, cw.where("new <> 'y'"), "old", "new", "cls")
    assert {(r.fid, r.cls) for r in ok.collect()} == {(1, "x"), (2, None)}


def test_ring_samples_skip_simple_outlines(spark, shapes):
    octagon = geo("from_text", F.lit("POLYGON ((1 0, 2 0, 3 1, 3 2, 2 3, 1 3, 0 2, 0 1, 1 0))"))
    df = shapes.where("fid = 1").select("fid", "geom").unionByName(spark.range(1).select(F.lit(9).alias("fid"), octagon.alias("geom")))
    got = cp.ring_samples(df).collect()
    assert {r.fid for r in got} == {9} and sorted(r.sid for r in got) == list(range(8))


def test_dither_stays_in_range(spark):
    df = spark.range(500).select(F.col("id").alias("fid"), F.lit(2.0).alias("edgeacc_m"))
    r = cp.dithered(df).agg(F.min("ratio"), F.max("ratio"), F.count_if(F.col("buffer_m") < 0), F.count_if(F.col("ratio").isNull())).first()
    assert r[0] >= 0.05 and r[1] <= 2.0 and 180 < r[2] < 320 and r[3] == 0


def test_validation_batch(spark, sf):
    from terraloom.plans.polygons import QUERIES

    ensure(spark)
    rows = QUERIES["validation_batch"](spark, sf.replace("0.001", "0.01")).select("valid_id", "fake", "extent", geo("x0", "centroid").alias("cx"), geo("y0", "centroid").alias("cy"), geo("x0", "boundary").alias("bx")).collect()
    fake = sum(r.fake for r in rows)
    assert sorted(r.valid_id for r in rows) == list(range(1, len(rows) + 1)) and abs(fake - (len(rows) - fake) * 3 / 7) <= 0.5 and len(rows) - fake > 120
    for r in rows:
        assert r.extent.x0 - 0.001 < r.cx < r.extent.x1 + 0.001 and r.extent.y0 - 0.001 < r.cy < r.extent.y1 + 0.001
    assert sum(r.bx is None for r in rows) <= len(rows) // 30


def test_clip_and_feature_mask(shapes):
    window = with_bounds(shapes.sparkSession.range(1).select(F.lit(1).alias("fid"), geo("from_text", F.lit("POLYGON ((3 -1, 5 -1, 5 9, 3 9, 3 -1))")).alias("geom")))
    got = {r.fid: r.a for r in cp.clip(shapes, window, 2.0).select("fid", geo("area", "geom").alias("a")).collect()}
    assert got == {1: 4.0, 2: 8.0}
    mask = cp.feature_mask(shapes.where("fid = 2"), shapes.where("fid = 1"), window, shapes.where("fid = 1"), 2.0, 0.5)
    land = shapes.where("fid = 1").select("fid", "geom", "x0", "y0", "x1", "y1")
    overlap = box_pairs(mask, land, 2.0).agg(F.sum(geo("area", geo("intersection", "l_geom", "r_geom")))).first()[0]
    assert mask.count() == 2 and overlap < 0.02


def test_parts_of_multipolygons_all_count(spark, shapes):
    f = shapes.where("fid = 3")
    assert one(f, geo("type", geo("exterior", "geom"))) == "MultiLineString" and one(f, geo("length", geo("exterior", "geom"))) == pytest.approx(2 * (2 + math.sqrt(2)))
    two = spark.range(1).select(F.lit(7).alias("fid"), geo("from_text", F.lit("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 7 6, 6 7, 5 7, 4 6, 5 5)))")).alias("geom"))
    assert {(r.part, r.sid) for r in cp.ring_samples(two).collect()} in ({(0, k) for k in range(6)}, {(1, k) for k in range(6)})


def test_decoys_without_a_place_raise(spark, shapes):
    with pytest.raises(ValueError, match="no place"):
        cp.decoys(3, shapes.where("fid = 2"), (50.0, 50.0, 60.0, 60.0), 1, rounds=2)
    got = cp.decoys(40, shapes.where("fid = 2"), (0.0, 0.0, 60.0, 60.0), 1, cell=5.0).collect()
    assert sorted(r.no for r in got) == list(range(40))


def test_dither_raises_where_no_ratio_fits(spark):
    df = spark.range(3).select(F.col("id").alias("fid"), F.lit(2.0).alias("edgeacc_m"))
    with pytest.raises(Exception, match="no ratio"):
        cp.dithered(df, low=50.0, high=50.001, tries=3).collect()


def test_edge_sampling_by_hand(spark):
    """One reef meets the other layer; samples near land and of the reef without a partner go, far ones are unmatched."""
    ensure(spark)
    poly = lambda *p: "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*p, p[0]]) + "))"
    def make(rows):
        return with_bounds(spark.createDataFrame(rows, "fid bigint, cls string, wkt string").withColumn("geom", geo("from_text", "wkt")))
    hexagon = poly((0, 0), (10, 0), (20, 10), (10, 20), (0, 20), (-10, 10))
    a = make([(1, "Reef", hexagon), (2, "Reef", poly((100, 100), (110, 100), (120, 110), (110, 120), (100, 120), (90, 110))), (3, "Bank", hexagon)])
    b = make([(1, "", poly((0, 0), (12, 0), (12, 5), (0, 5)))])
    land = make([(1, "", poly((-12, 9), (-11, 9), (-11, 11), (-12, 11)))])
    region = make([(1, "", poly((-50, -50), (500, -50), (500, 500), (-50, 500)))])
    near, far = cp.edge_sampling(a, b, land, region, 16.0, 9.0, 3.0, F.col("cls") == "Reef")
    near, far = near.collect(), far.collect()
    assert {r.fid for r in near + far} == {1} and 0 < len(near) < 6 and near[0].part == 0
    assert len(near) + len(far) == 5 and all(r.dist_m <= 9 for r in near) and all(r.dist_m is None for r in far)


def test_masks_that_touch_the_box_of_a_feature(spark):
    """One mask overlaps, one only touches the feature's box along a line, one at a corner: what is gathered stays polygonal."""
    ensure(spark)
    square = lambda x0, y0, x1, y1: f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"
    make = lambda rows: with_bounds(spark.createDataFrame(rows, "fid bigint, wkt string").withColumn("geom", geo("from_text", "wkt")))
    f = make([(1, square(0, 0, 10, 10))])
    m = make([(1, square(8, 8, 20, 20)), (2, square(10, 0, 30, 5)), (3, square(-5, -5, 0, 0)), (4, "MULTIPOLYGON (((-9 4, 1 4, 1 5, -9 5, -9 4)), ((2 10, 3 10, 3 12, 2 12, 2 10)))")])
    assert one(cp.difference(f, m, 4.0), geo("area", "geom")) == 95.0
    assert one(cp.clip(f, m, 4.0), geo("area", "geom")) == 5.0
