import pytest
from pyspark.sql import functions as F

from terraloom.functions.kernel import ensure, geo, with_bounds
from terraloom.plans import composites as cp
from terraloom.sources import layers
from terraloom.sources.shapefile import register


def test_shapefile_round_trip(spark, tmp_path):
    ensure(spark)
    register(spark)
    wkt = ["POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", "MULTIPOLYGON (((10 10, 11 10, 11 11, 10 10)), ((20 20, 21 20, 21 21, 20 20)))", None]
    rows = [(1, "Réef; a", 0.5, True, wkt[0]), (2, None, None, None, wkt[1]), (3, "", -12.25, False, wkt[2])]
    df = spark.createDataFrame(rows, "fid bigint, a_very_long_name string, n double, ok boolean, wkt string")
    df = with_bounds(df.withColumn("geom", geo("from_text", "wkt"))).drop("wkt").coalesce(1)
    at = str(tmp_path / "layer")
    df.write.format("shapefile").mode("append").save(at)
    back = spark.read.format("shapefile").load(at)
    assert back.columns == ["fid", "a_very_lon", "n", "ok", "geom", "x0", "y0", "x1", "y1"]
    got = {r.fid: r for r in back.withColumn("area", geo("area", "geom")).withColumn("holes", F.size(geo("holes", "geom"))).collect()}
    assert (got[1].a_very_lon, got[1].n, got[1].ok, got[1].area, got[1].holes) == ("Réef; a", 0.5, True, 15.0, 1)
    assert (got[2].a_very_lon, got[2].n, got[2].ok, got[2].area) == (None, None, None, 1.0)
    assert got[3].geom is None and got[3].x0 is None and (got[1].x0, got[1].y1) == (0.0, 4.0)
    with pytest.raises(Exception, match="FileExists|layer"):
        df.write.format("shapefile").mode("append").save(at)


def test_shapefile_points_and_lines(spark, tmp_path):
    ensure(spark)
    register(spark)
    for k, w in {"p": "POINT (3 4)", "l": "LINESTRING (0 0, 3 4)", "m": "MULTILINESTRING ((0 0, 1 0), (5 5, 5 7))"}.items():
        df = spark.range(1).select(F.col("id").alias("fid"), geo("from_text", F.lit(w)).alias("geom"))
        df.coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path / k))
        assert spark.read.format("shapefile").load(str(tmp_path / k)).select(geo("text", "geom")).first()[0] == w


def test_layers(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0)], "fid bigint, x0 double, y0 double, x1 double, y1 double")
    at = str(tmp_path / "a")
    layers.write_layer(df, at)
    got = layers.read_layer(spark, at, (0.5, 0.5, 2.0, 2.0))
    assert [r.fid for r in got.collect()] == [1]
    assert "PushedFilters: [IsNotNull(x1)" in got._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|exists"):
        layers.write_layer(df, at)
    layers.write_layer(df.limit(0), at, "ignore")
    assert layers.read_layer(spark, at).count() == 2
    layers.empty_templates(spark, [str(tmp_path / "t1"), at])
    assert spark.read.parquet(str(tmp_path / "t1")).count() == 0 and spark.read.parquet(at).count() == 2


def test_csv_and_batches(spark, tmp_path):
    spark.createDataFrame([("a", None), (None, "2")], "k string, v string").coalesce(1).write.csv(str(tmp_path / "c"), header=True)
    assert sorted(map(tuple, layers.read_table_csv(spark, str(tmp_path / "c")).collect())) == [("", "2"), ("a", "")]
    assert layers.read_table_csv(spark, str(tmp_path / "c"), "k string, v int").where("v = 2").count() == 1
    for k in ("02", "01"):
        spark.createDataFrame([(int(k),)], "valid_id int").coalesce(1).write.json(str(tmp_path / f"batch-{k}"))
    got = layers.read_batches(spark, str(tmp_path / "batch-*"), "json").collect()
    assert sorted((r.valid_id, r.batch) for r in got) == [(1, 0), (2, 1)]


def test_fetch_tiles_and_config(spark):
    found, missing = layers.fetched(spark.createDataFrame([("a", 200), ("b", 404)], "tile string, status int"))
    assert [r.tile for r in found.collect()] == ["a"] and [r.tile for r in missing.collect()] == ["b"]
    with pytest.raises(Exception, match="status 500"):
        layers.fetched(spark.createDataFrame([("a", 500)], "tile string, status int"))[0].collect()
    tiles = spark.createDataFrame([("N", "t1"), ("G", "t1"), ("G", "t2")], "region string, tile_id string")
    assert cp.choose_tiles(tiles, "all").count() == 3
    assert [r.tile_id for r in cp.choose_tiles(tiles, "G", ["t2"]).collect()] == ["t2"]
    with pytest.raises(ValueError, match="outside"):
        cp.choose_tiles(tiles, "N", ["t2"])
    with pytest.raises(ValueError, match="no tiles"):
        cp.choose_tiles(tiles)
    cfg = layers.Config.from_ini("[general]\nversion = v2\n[paths]\nout = work/{version}/x\n")
    assert cfg.path("out") == "work/v2/x"


def test_nothing_is_cut_on_writing(spark, tmp_path):
    ensure(spark)
    register(spark)
    point = geo("from_text", F.lit("POINT (1 2)"))
    for k, (v, kind) in enumerate([("x" * 255, "string"), (10**19, "decimal(20,0)"), (1e30, "double")]):
        df = spark.createDataFrame([(v,)], f"v {kind}") if kind != "decimal(20,0)" else spark.range(1).select(F.lit(10**18 - 1 + 10**18).cast("bigint").alias("v"))
        with pytest.raises(Exception, match="fit a field"):
            df.withColumn("geom", point).coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path / f"a{k}"))
    two = spark.createDataFrame([(1, 2)], "same_start_a int, same_start_b int").withColumn("geom", point)
    with pytest.raises(Exception, match="ten characters"):
        two.coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path / "b"))
    big = spark.createDataFrame([(123456789012.5,)], "v double").withColumn("geom", point)
    big.coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path / "c"))
    assert spark.read.format("shapefile").load(str(tmp_path / "c")).first().v == 123456789012.5


def test_batches_of_shapefiles_are_numbered(spark, tmp_path):
    ensure(spark)
    register(spark)
    for k in ("b-02", "b-01", "b-03"):
        df = spark.createDataFrame([(int(k[-1]),)], "ValidID int").withColumn("geom", geo("from_text", F.lit("POINT (1 2)")))
        df.coalesce(1).write.format("shapefile").mode("append").save(str(tmp_path / k))
    got = layers.read_batches(spark, str(tmp_path / "b-??" / "*.shp"), "shapefile").collect()
    assert sorted((r.ValidID, r.batch) for r in got) == [(1, 0), (2, 1), (3, 2)]


def test_coordinate_systems(spark, tmp_path):
    from terraloom.plans.storage import GDA94
    from terraloom.sources.shapefile import srid_of

    assert srid_of(GDA94) == 4283 and srid_of("") is None and srid_of('LOCAL["x"]') is None
    assert srid_of('GEOGCS["WGS 84",DATUM["x",AUTHORITY["EPSG","6326"]],AUTHORITY["EPSG","4326"]]') == 4326
    a, b = (spark.createDataFrame([(n,)], "srid int") for n in (4283, 4326))
    layers.require_same_crs(a, a, a.limit(0))
    for bad in ((a, b), (a, a.withColumn("srid", F.lit(None).cast("int")))):
        with pytest.raises(ValueError, match="coordinate systems"):
            layers.require_same_crs(*bad)
    (tmp_path / "t.lock").write_text("")
    with pytest.raises(BlockingIOError):
        layers.write_layer(a, str(tmp_path / "t"))


def test_a_feature_without_a_row_stops_the_expansion(spark):
    ensure(spark)
    f = spark.createDataFrame([(1, "A", "Land", "Deep", "3"), (2, "B", "Land", "Deep", "x")], "fid int, cls string, attachment string, depthcat string, edgeacc_m string")
    f = f.withColumn("geom", geo("from_text", F.lit("POLYGON ((120 -20, 121 -20, 121 -21, 120 -21, 120 -20))")))
    rules = spark.createDataFrame([(1, "A", "Land", "Deep;Shallow", "q")], "row_no int, key string, att string, dep string, so string")
    with pytest.raises(ValueError, match="without a crosswalk row"):
        cp.expand_strict(f, rules, ("cls", "key"), {"attachment": "att", "depthcat": "dep"}, ["so"])
    got = cp.expand_strict(f.where("fid = 1"), rules, ("cls", "key"), {"attachment": "att", "depthcat": "dep"}, ["so"]).first()
    assert got.so == "q" and 11_000 < got.area_km2 < 12_000
