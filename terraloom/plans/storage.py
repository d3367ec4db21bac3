"""Queries over what is written and read again: shapefiles, CSV, batches, templates, fetches, and the attribute pipelines on layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.common import Scratch, table
from terraloom.functions import scalar as fn
from terraloom.functions.kernel import ensure, geo, with_bounds
from terraloom.operators import attributes as at
from terraloom.plans import composites as cp
from terraloom.plans.fixtures import cte, layer, outlines
from terraloom.sources import layers
from terraloom.sources.shapefile import register

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Fixed value: text of a coordinate system as it stands in .prj files.
GDA94 = 'GEOGCS["GCS_GDA_1994",DATUM["D_GDA_1994",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one; it goes when the session ends."""
    return Scratch(spark).root


@query(f"WITH {cte('shapes')} SELECT fid, cls, x0, y0, x1, y1, 4283 AS srid, fid % 5 = 2 AS holed FROM shapes")
def shapefile_round_trip(spark, d):
    """A layer written as shapefiles and read again, with the coordinate system of the .prj."""
    register(spark)
    at_ = _folder(spark) + "/layer"
    df = outlines(spark, d, "shapes").select("fid", "cls", "geom", "x0", "y0", "x1", "y1")
    df.write.format("shapefile").option("prj", GDA94).mode("append").save(at_)
    back = spark.read.format("shapefile").option("crs", "true").load(at_)
    return back.select("fid", "cls", "x0", "y0", "x1", "y1", F.col("srid").cast("int").alias("srid"), (F.size(geo("holes", "geom")) > 0).alias("holed"))


@query(f"WITH {cte('shapes')} SELECT fid, x0, y0 FROM shapes WHERE x1 >= 500 AND x0 <= 1500 AND y1 >= 700 AND y0 <= 1900")
def stored_window(spark, d):
    """A stored layer read by a window, which the scan prunes by; a second writer is turned away or ignored."""
    at_ = _folder(spark) + "/layer"
    layers.write_layer(outlines(spark, d, "shapes"), at_)
    layers.write_layer(outlines(spark, d, "shapes").limit(0), at_, "ignore")
    return layers.read_layer(spark, at_, (500.0, 700.0, 1500.0, 1900.0)).select("fid", "x0", "y0")


@query(f"WITH {cte('attrs')} SELECT CAST(fid AS VARCHAR) AS fid, coalesce(depthcat, '') AS depthcat, coalesce(edgeacc_m, '') AS edgeacc_m, fid % 5 = 3 AS parts FROM attrs")
def csv_round_trip(spark, d):
    """Attributes and outlines as text written as CSV and read again, all text, nothing as ''."""
    at_ = _folder(spark) + "/table"
    layers.write_table_csv(outlines(spark, d, "attr_shapes").select("fid", "depthcat", "edgeacc_m", geo("text", "geom").alias("wkt")), at_)
    return layers.read_table_csv(spark, at_).select("fid", "depthcat", "edgeacc_m", F.col("wkt").startswith("MULTI").alias("parts"))


@query("""WITH b AS (SELECT o_orderkey % 3 AS batch, o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) AS v FROM orders)
SELECT CAST(batch AS INTEGER) AS batch, v + batch * 100000000 AS valid_id FROM b JOIN orders USING (o_orderkey) WHERE lower(o_orderstatus) = 'f'""")
def batch_combine(spark, d):
    """Batches read from shapefiles in the order of their names, ids moved apart by it, points whose centroid says that the feature exists."""
    register(spark)
    ensure(spark)
    root = _folder(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    spot = geo("from_text", F.concat(F.lit("POINT ("), (F.col("o_orderkey") % 360 - 180).cast("string"), F.lit(" 0)")))
    for k in range(3):
        one = at.sequential_id(o.where(F.col("o_orderkey") % 3 == k), [F.col("o_orderkey")], "ValidID")
        points = one.select("ValidID", F.lower("o_orderstatus").alias("exists"), spot.alias("geom"))
        points.coalesce(1).write.format("shapefile").mode("append").save(f"{root}/batch-{k + 1:02d}")  # a batch is one file
    every = layers.read_batches(spark, root + "/batch-??/*.shp", "shapefile")
    out = cp.combine_batches(every, "batch", "ValidID", 100_000_000)
    there = out.where("`exists` = 'f'").select("valid_id")
    return out.join(there, "valid_id", "left_semi").select("batch", "valid_id")


@query("SELECT unnest(['bath_i', 'bath_m', 'cht_i', 'cht_m']) AS name, 0 AS n, 6 AS n_cols")
def template_layers(spark, d):
    """Four empty layers, left as they are if they are there."""
    names, root = ["bath_m", "bath_i", "cht_m", "cht_i"], _folder(spark)
    for _ in range(2):
        layers.empty_templates(spark, [f"{root}/{n}" for n in names])
    counts = [(n, df.count(), len(df.columns)) for n in names for df in [layers.read_layer(spark, f"{root}/{n}")]]
    return spark.createDataFrame(counts, "name string, n int, n_cols int")


@query("""SELECT CASE WHEN p_partkey % 17 = 0 THEN 'missing' ELSE 'found' END AS result, count(*) AS n FROM part GROUP BY 1""")
def fetch_results(spark, d):
    """The results of fetches, missing tiles apart; other failures stop it when they are reached. Fetching itself is out of the engine."""
    got = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 17 == 0, 404).otherwise(200).alias("status"))
    found, missing = layers.fetched(got)
    one = lambda df, name: df.select(F.lit(name).alias("result"))
    return one(found, "found").unionByName(one(missing, "missing")).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


# Attributes of layers


_KINDS = ("Platform Coral Reef", "Fringing Coral Reef", "Rocky Reef", "Sand Bank")
_FIELDS = (
    "rb_type_l2 rb_type_l1 nvcleco nvclecocom inundtn smb_cmp as_tidalz as_bdepth as_system as_subsys bc_level1 bc_level2 bc_level3 bc_level4 so_level1 so_level2 so_level3 sc_level1"
).split()
_ALL = "Land;Isolated;Fringing;Oceanic", "Land;Surface;Intertidal;Very Shallow;Shallow;Deep"


def _rules_sql() -> str:
    # Later rows for the same class never win, as the first row that matches does.
    rows = [(i + 1 + 10 * k, c, *_ALL, *[f"{f[:2]}-{i}{k}" for f in _FIELDS]) for k in range(2) for i, c in enumerate(_KINDS)]
    return f"rules(row_no, cls, att, dep, {', '.join(_FIELDS)}) AS (VALUES {', '.join(map(str, rows))})"


_GRID = "SELECT fid, wkt, rb_type_l3, CASE WHEN attachment IN ('Land', 'Fringing', 'Isolated', 'Oceanic') THEN attachment ELSE 'Isolated' END AS attachment, depthcat, edgeacc_m"


@query(f"""WITH {cte('attr_shapes')}, {_rules_sql()}, f AS ({_GRID} FROM attr_shapes)
SELECT fid, CAST(row_no AS BIGINT) AS matched_row, {', '.join(_FIELDS)}, coalesce(CAST(trunc(TRY_CAST(edgeacc_m AS DOUBLE)) AS INTEGER), 0) AS edgeacc_m, coalesce(nullif(trim(depthcat), ''), 'Shallow') AS depthcat
FROM f JOIN rules ON cls = rb_type_l3 WHERE row_no < 10""")
def attribute_expansion(spark, d):
    """All 18 fields of the first crosswalk row that matches; a feature that matches none would stop it."""
    rows = [(i + 1 + 10 * k, c, *_ALL, *[f"{f[:2]}-{i}{k}" for f in _FIELDS]) for k in range(2) for i, c in enumerate(_KINDS)]
    rules = spark.createDataFrame(rows, f"row_no bigint, cls string, att string, dep string, {', '.join(f'{f} string' for f in _FIELDS)}")
    known = F.when(F.col("attachment").isin("Land", "Fringing", "Isolated", "Oceanic"), F.col("attachment")).otherwise("Isolated")
    features = outlines(spark, d, "attr_shapes").withColumn("attachment", known)
    small = features.withColumn("geom", geo("moved", geo("scaled", "geom", 0.001), 120.0, -20.0))
    out = cp.expand_strict(small, rules, ("rb_type_l3", "cls"), {"attachment": "att", "depthcat": "dep"}, _FIELDS)
    return out.select("fid", "matched_row", *_FIELDS, "edgeacc_m", "depthcat")


_LCC = (
    "c AS (SELECT sqrt(0.00669438002290) AS e, radians(-18) AS p1, radians(-36) AS p2), "
    "m AS (SELECT *, cos(p1) / sqrt(1 - pow(e * sin(p1), 2)) AS m1, cos(p2) / sqrt(1 - pow(e * sin(p2), 2)) AS m2, tan(pi() / 4 - p1 / 2) / pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1, "
    "tan(pi() / 4 - p2 / 2) / pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2 FROM c), "
    "n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM m), f AS (SELECT *, m1 / (n * pow(t1, n)) AS f FROM n)"
)


@query(f"""WITH {cte('rects')}, {_LCC}, v AS (SELECT fid, unnest([0, 1, 2, 3]) AS k, 120 + unnest([x0, x1, x1, x0]) / 1000 AS lon, -20 + unnest([y0, y0, y1, y1]) / 1000 AS lat FROM rects),
q AS (SELECT fid, k, n * radians(lon - 134) AS h, 6378137 * f AS r0, 6378137 * f * pow(tan(pi() / 4 - radians(lat) / 2) / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2), n) AS r FROM v, f),
p AS (SELECT fid, k, r * sin(h) AS x, r0 - r * cos(h) AS y FROM q)
SELECT a.fid, round_even(round(abs(sum(a.x * b.y - b.x * a.y)) / 2 / 1e6, 12), 4) AS area_km2 FROM p a JOIN p b ON b.fid = a.fid AND b.k = (a.k + 1) % 4 GROUP BY a.fid""")
def area_3112(spark, d):
    """Areas in square kilometres of outlines in degrees, in the national grid."""
    ensure(spark)
    ring = fn.ring_wkt(fn.box_ring(*[(120 if c[0] == "x" else -20) + F.col(c) / 1000 for c in ("x0", "y0", "x1", "y1")]))
    r = layer(spark, d, "rects").withColumn("geom", geo("to_3112", geo("from_text", ring)))
    return r.select("fid", fn.half_even(geo("area", "geom") / 1e6, 4).alias("area_km2"))


_CLASSES = [(f"Class {i:02d}", f"Feature {i % 9}", ("Isolated", "Fringing")[i % 2], ("High", "Low", None)[i % 3], "No", ("Carbonate", "Terrigenous")[i % 2], "No") for i in range(27)]
_SETS = ("feat_l3", "geoattach", "relief", "flowinflu", "so_l2", "paleo")


@query(f"""WITH {cte('attr_shapes')}, m(rb_type_l3, {', '.join(_SETS)}) AS (VALUES {', '.join(str(r).replace('None', 'NULL') for r in _CLASSES)}), a AS (SELECT fid, x0, y0, edgeacc_m, 'Class ' || lpad(CAST(fid % 31 AS VARCHAR), 2, '0') AS rb_type_l3 FROM attr_shapes WHERE fid % 11 <> 0)
SELECT fid, a.rb_type_l3, {', '.join(f"CASE WHEN m.rb_type_l3 IS NULL THEN '{'N' if c == 'paleo' else 'Unknown'}' ELSE {c} END AS {c}" for c in _SETS)}, CAST(trunc(TRY_CAST(edgeacc_m AS DOUBLE)) AS INTEGER) AS edgeacc_m,
  'NW_' || CAST(row_number() OVER (ORDER BY fid) - 1 AS VARCHAR) AS debugid, round(degrees(x0 * 100 / 6378137), 9) AS lon, round(degrees(2 * atan(exp(y0 * 100 / 6378137)) - pi() / 2), 9) AS lat FROM a LEFT JOIN m USING (rb_type_l3)""")
def class_crosswalk(spark, d):
    """27 classes to six attributes, others Unknown; null geometries go, web mercator to degrees, accuracy whole or null, running ids."""
    m = spark.createDataFrame(_CLASSES, f"rb_type_l3 string, {', '.join(f'{c} string' for c in _SETS)}")
    a = outlines(spark, d, "attr_shapes").withColumn("geom", F.when(F.col("fid") % 11 != 0, geo("from_mercator", geo("scaled", "geom", 100.0))))
    a = a.withColumn("rb_type_l3", F.concat(F.lit("Class "), F.lpad((F.col("fid") % 31).cast("string"), 2, "0"))).withColumn("edgeacc_m", fn.int_or_null("edgeacc_m"))
    out = cp.class_crosswalk(with_bounds(a), m, "rb_type_l3", list(_SETS))
    return out.select("fid", "rb_type_l3", *_SETS, "edgeacc_m", "debugid", F.round("x0", 9).alias("lon"), F.round("y0", 9).alias("lat"))
