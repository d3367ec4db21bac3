"""Counts of overlaps by classes: the same as over the pairs, but without a row for each pair, as pairs grow with the square of a spot's features."""

import random

import pytest
from pyspark.sql import functions as F

from terraloom.functions.kernel import ensure, geo, with_bounds
from terraloom.operators import spatial
from terraloom.plans import composites as cp
from terraloom.plans import polygons
from terraloom.plans.fixtures import outlines


def by_types(pairs):
    return {r.types: (r.n, r.area) for r in pairs.groupBy("types").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area")).collect()}


@pytest.fixture(scope="module")
def mixed(spark):
    """Outlines many of which are equal, in several classes and none, on whole numbers and not, touching, across cells; crossed, round, no polygons, empty and null ones."""
    ensure(spark)
    r, rows = random.Random(5), []
    for k in range(160):
        x, y, w, h = r.choice([(0, 0), (13, 3), (-20, 10), (30, 30)]) + (r.randint(4, 6) * 4, r.randint(2, 4) * 5)
        if k % 6 == 0:
            x, y = x + r.choice([0.25, 0.3]), y + 0.7
        box = f"({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y})"
        cut = f"({x + 6} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y + 6}, {x + 6} {y})"
        hole = f"({x + 2} {y + 2}, {x + 2} {y + h - 2}, {x + w - 2} {y + h - 2}, {x + w - 2} {y + 2}, {x + 2} {y + 2})"
        two = f"MULTIPOLYGON ((({x} {y}, {x + 3} {y}, {x + 3} {y + h}, {x} {y + h}, {x} {y})), (({x + 5} {y}, {x + w} {y + h}, {x + 5} {y + h}, {x + 5} {y})))"
        rows.append((k, r.choice(["a", "b", "b", "c", None]), r.choice([f"POLYGON ({box})", f"POLYGON ({cut})", f"POLYGON ({box}, {hole})", two])))
    rows += [(1000, "a", "POLYGON ((300 300, 305 305, 305 300, 300 305, 300 300))"), (1100, "b", "POLYGON EMPTY"), (1101, "b", None), (1102, "c", "LINESTRING (0 0, 30 30)"), (1103, "c", "POLYGON ((200 0, 210 0, 210 9, 200 9, 200 0))"), (1104, "c", "POLYGON ((210 0, 215 0, 215 9, 210 9, 210 0))")]
    df = spark.createDataFrame(rows, "fid bigint, cls string, wkt string").withColumn("geom", geo("from_text", "wkt"))
    round_ = df.where("fid < 3").withColumn("fid", F.col("fid") + 1200).withColumn("geom", geo("buffer", geo("centroid", "geom"), 9.0)).withColumn("geom", geo("buffer", "geom", 0.5))
    return with_bounds(df.unionByName(round_).drop("wkt")).cache()


@pytest.mark.parametrize("batch", [4096, 7])
@pytest.mark.parametrize("ids", ["fid", "CASE WHEN fid % 10 = 0 THEN NULL WHEN fid % 10 < 4 THEN fid % 40 ELSE fid END", "CAST(fid AS STRING)"])
def test_counts_equal_those_of_the_pairs(spark, mixed, monkeypatch, batch, ids):
    monkeypatch.setattr(spatial, "BATCH", batch)
    layer = mixed.withColumn("fid", F.expr(ids))
    want = by_types(cp.overlap_report(layer, 16.0))
    got = {r.types: (r.n, r.area) for r in cp.overlap_counts(layer, 16.0).collect()}
    assert got.keys() == want.keys() and len(want) > 8
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-9) for k in want)


def test_query_without_a_row_for_each_pair(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    want = by_types(cp.overlap_report(outlines(spark, sf, "shapes"), polygons.CELL))

    def refused(*args, **kwargs):
        raise AssertionError("a row for each pair")

    monkeypatch.setattr(cp, "box_pairs", refused)
    monkeypatch.setattr(spatial, "box_pairs", refused)
    got = polygons.overlap_type_pairs(spark, sf)
    assert {r.types: (r.n, r.area) for r in got.collect()} == want and want


def test_stacked_features_are_counted_whole(spark, tmp_path):
    """6,000 equal boxes on one spot, more than a batch: 17,997,000 pairs."""
    spark.range(6000).selectExpr("id * 444000 + 4 AS p_partkey", "5 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    n = 6000 * 5999 // 2
    assert [tuple(r) for r in polygons.overlap_type_pairs(spark, str(tmp_path)).collect()] == [("Coral Reef | Coral Reef", n, n * 13 * 12.0)]
