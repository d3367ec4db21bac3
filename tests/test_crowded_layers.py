"""Layers with very many features on the same spots: what is put together, measured and compared there must not grow with the pairs."""

import random

import pytest
from pyspark.sql import functions as F

from terraloom.functions.kernel import ensure, geo, with_bounds
from terraloom.operators import spatial
from terraloom.operators.graph import connected_components
from terraloom.operators.spatial import box_pairs, exact
from terraloom.plans import composites as cp


@pytest.fixture(scope="module")
def stacked(spark):
    """Boxes with a corner cut off, holes and plain boxes, 24 on each of 12 spots, some on whole numbers and some not, and a crossed one."""
    ensure(spark)
    r, rows = random.Random(3), []
    for k in range(288):
        x, y = k % 12 % 4 * 37, k % 12 // 4 * 31
        w, h = r.randint(8, 40), r.randint(8, 34)
        if k % 5 == 0:
            x, y, w, h = x + r.random(), y + r.random(), w + r.random(), h + r.random()
        box = f"({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y})"
        cut = f"({x + 6} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y + 6}, {x + 6} {y})"
        hole = f"({x + 2} {y + 2}, {x + 2} {y + h - 2}, {x + w - 2} {y + h - 2}, {x + w - 2} {y + 2}, {x + 2} {y + 2})"
        two = f"MULTIPOLYGON ((({x} {y}, {x + 3} {y}, {x + 3} {y + h}, {x} {y + h}, {x} {y})), (({x + 5} {y}, {x + w} {y + h}, {x + 5} {y + h}, {x + 5} {y})))"
        rows.append((k, "ab"[k % 7 == 0], [f"POLYGON ({box})", f"POLYGON ({cut})", f"POLYGON ({box}, {hole})", two][k % 4]))
    rows += [(1000, "a", "POLYGON ((-9 -9, -5 -5, -5 -9, -9 -5, -9 -9))"), (1001, "a", "POLYGON ((-6 -6, 1 -6, 1 -1, -6 -1, -6 -6))"), (1002, "a", "POLYGON EMPTY"), (1003, "a", None)]
    df = spark.createDataFrame(rows, "fid bigint, cls string, wkt string").withColumn("geom", geo("from_text", "wkt"))
    return with_bounds(df.drop("wkt")).cache()


@pytest.mark.parametrize(("within", "batch"), [(0.0, 4096), (0.0, 5), (2.5, 4096)])
def test_components_of_a_crowded_cell(spark, stacked, monkeypatch, within, batch):
    monkeypatch.setattr(spatial, "BATCH", batch)
    pairs = box_pairs(stacked, stacked, 16.0, within).where("l_cls = r_cls AND l_fid < r_fid").where(geo("is_near", "l_geom", "r_geom", within))
    want = {tuple(r) for r in connected_components(pairs, "l_fid", "r_fid", stacked, "fid").collect()}
    got = {tuple(r) for r in spatial.contact_components(stacked, 16.0, within, ("cls",)).collect()}
    assert got == want and 4 < len({c for _, c in got}) < 60


def test_what_pairs_share_equals_the_overlay(spark, stacked):
    valid = stacked.where("fid <> 1000")
    got = {(r.feature_1, r.feature_2): (r.area, r.x, r.y) for r in cp.overlap_report(valid, 16.0).collect()}
    pairs = box_pairs(valid, valid, 16.0).where("l_fid < r_fid").withColumn("o", geo("overlap", "l_geom", "r_geom")).where("o.area > 1e-4")
    want = {(r.l_fid, r.r_fid): tuple(r.o) for r in pairs.select("l_fid", "r_fid", "o").collect()}
    assert got.keys() == want.keys() and len(want) > 3000
    assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)
    plain = {r.fid: r.p for r in stacked.select("fid", geo("plain", "geom").alias("p")).collect()}
    assert plain[1000] == 0 and plain[1002] == 0 and plain[1003] is None and {plain[0], plain[1]} == {1, 2}


def test_type_pairs_without_the_overlay(spark, stacked, monkeypatch):
    """Counts and areas by classes come from the measured pairs; the plan has no overlay of each pair."""
    out = cp.overlap_report(stacked.where("fid < 1000"), 16.0).groupBy("types").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))
    assert "geo_overlap" not in out._jdf.queryExecution().toString()
    pairs = box_pairs(stacked, stacked, 16.0).where("l_fid < r_fid AND l_fid < 1000 AND r_fid < 1000").withColumn("a", geo("area", geo("intersection", "l_geom", "r_geom"))).where("a > 1e-4")
    want = pairs.groupBy(F.concat_ws(" | ", F.least("l_cls", "r_cls"), F.greatest("l_cls", "r_cls")).alias("types")).agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("area"))
    want = {r.types: (r.n, r.area) for r in want.collect()}
    got = {r.types: (r.n, r.area) for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_relation_equals_the_four_predicates(spark, stacked):
    p = box_pairs(stacked.withColumn("plain", geo("plain", "geom")), stacked.withColumn("plain", geo("plain", "geom")), 16.0)
    four = [exact(k).cast("int") * v for k, v in {"intersects": 1, "touches": 2, "contains": 4, "within": 8}.items()]
    rows = p.select(spatial.pair("relation").alias("got"), sum(four[1:], four[0]).alias("want")).groupBy("got", "want").count().collect()
    assert all(r.got == r.want for r in rows) and {1, 3, 5, 9, 13} <= {r.got for r in rows}


def test_difference_unites_once_for_a_cell(spark, stacked):
    f, m = stacked.where("fid % 2 = 0 AND fid < 1000"), stacked.where("fid % 4 = 1 AND fid < 1000")
    assert spatial.cell_masks(f, m, 64.0).count() < box_pairs(f, m, 64.0).count() / 2
    whole = m.agg(geo("union_all", F.collect_list("geom")).alias("_m"))
    want = {r.fid: r.a for r in f.crossJoin(whole).select("fid", geo("area", geo("difference", "geom", "_m")).alias("a")).collect() if r.a > 1e-9}
    got = {r.fid: r.a for r in cp.difference(f, m, 16.0).select("fid", geo("area", "geom").alias("a")).collect()}
    assert {k for k, a in got.items() if a > 1e-9} == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    far = stacked.where("fid = 1001")
    assert cp.difference(far, m, 16.0).select("geom").first().geom == far.select("geom").first().geom


def test_mask_is_united_by_cell(spark, stacked, monkeypatch):
    seen = []
    monkeypatch.setattr(cp, "box_pairs", lambda *a, **k: seen.append(a) or box_pairs(*a, **k))
    mask = stacked.where("fid < 1000")
    none = stacked.limit(0).withColumn("operation", F.lit("Add"))
    got = cp.correct_mask(mask, none, 16.0).agg(F.sum(geo("area", "geom"))).first()[0]
    assert got == pytest.approx(mask.agg(geo("area", geo("union_all", F.collect_list("geom")))).first()[0], rel=1e-9)
    assert not seen


def test_equal_outlines_are_found_by_their_boxes(spark, stacked):
    moved = with_bounds(stacked.select((F.col("fid") + 5000).alias("fid"), geo("moved", "geom", F.when(F.col("fid") % 3 == 0, 5e-10).when(F.col("fid") % 3 == 1, -2e-9).otherwise(0.0), F.lit(0.0)).alias("geom")))
    equal = geo("equals_exact", "l_geom", "r_geom", 1e-9)
    want = {tuple(r) for r in box_pairs(moved, stacked, 16.0).where(equal).select("l_fid", "r_fid").collect()}
    found = spatial.equal_boxes(moved, stacked, 1e-9)
    got = {tuple(r) for r in found.where(equal & exact("intersects")).select("l_fid", "r_fid").collect()}
    assert got == want and len(got) > 150 and found.count() < 3 * len(got)


def test_dithered_outlines_make_no_pairs(spark, stacked, monkeypatch):
    monkeypatch.setattr(cp, "box_pairs", lambda *a, **k: pytest.fail("pairs"))
    layer = stacked.where("fid < 60").withColumn("edgeacc_m", F.lit(1.0))
    moved = cp.dithered(layer).select(geo("buffer", "geom", F.col("buffer_m")).alias("geom"))
    want = moved.agg(geo("area", geo("union_all", F.collect_list("geom")))).first()[0]
    assert cp.dithered_dissolve(layer, 16.0).agg(F.sum("area")).first()[0] == pytest.approx(want, rel=1e-6)
