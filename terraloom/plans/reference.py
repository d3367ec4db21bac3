"""Queries over the operators of feature layers, attributes and statistics, each with the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.common import name_key, table
from terraloom.functions import scalar as fn
from terraloom.operators import attributes as at
from terraloom.operators.packed import split_packed, vocabulary
from terraloom.operators.spatial import box_area
from terraloom.plans import composites as cp
from terraloom.plans.fixtures import cte, layer

FLAG_SOURCES = ["src_ahs", "src_kim", "src_unep", "src_ga", "src_bath_m", "src_bath_i", "src_cht_m", "src_cht_i"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _even(e: str, n: int) -> str:
    return f"round_even(round({e}, {n + 8}), {n})"


# Sources, filters, projections


@query(f"WITH {cte('rects')} SELECT fid, x0, y0, x1, y1, cls FROM rects WHERE x1 >= 500 AND x0 <= 1500 AND y1 >= 700 AND y0 <= 1900")
def scan_window(spark, d):
    """Features whose box meets a window; the geometry isn't cut."""
    r = layer(spark, d, "rects")
    return r.where((F.col("x1") >= 500) & (F.col("x0") <= 1500) & (F.col("y1") >= 700) & (F.col("y0") <= 1900))


@query("""SELECT c_custkey AS k, CAST('Reef' AS VARCHAR) AS label FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
  AND coalesce(regexp_full_match(c_mktsegment, 'BUILDING'), false)""")
def filters(spark, d):
    """IN, NOT IN by anti-join, full match with null as false, constant column."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation").where("n_regionkey = 2")
    c = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).join(n, c.c_nationkey == n.n_nationkey, "left_anti")
    c = c.where(F.coalesce(F.col("c_mktsegment").rlike("^BUILDING$"), F.lit(False)))
    return c.select(F.col("c_custkey").alias("k"), F.lit("Reef").alias("label"))


@query(f"""WITH {cte('attrs')} SELECT fid, coalesce(nullif(trim(depthcat), ''), 'Shallow') AS depthcat,
  coalesce(nullif(trim(attachment), ''), 'Isolated') AS attachment, CAST(NULL AS VARCHAR) AS paleo FROM attrs""")
def fill_defaults(spark, d):
    """Columns in a given order, missing ones as null, defaults for null and blank."""
    out = at.fill_blanks(layer(spark, d, "attrs"), {"depthcat": "Shallow", "attachment": "Isolated"})
    return at.align(out, ["fid", "depthcat", "attachment", "paleo"])


@query(f"""WITH {cte('attrs')} SELECT fid, CAST(trunc(TRY_CAST(edgeacc_m AS DOUBLE)) AS INTEGER) AS whole, TRY_CAST(edgeacc_m AS DOUBLE) AS number,
  coalesce(CAST(trunc(TRY_CAST(edgeacc_m AS DOUBLE)) AS INTEGER), 0) AS whole_or_0 FROM attrs""")
def lenient_numbers(spark, d):
    """P13."""
    a = layer(spark, d, "attrs")
    whole = fn.int_or_null("edgeacc_m")
    return a.select("fid", whole.alias("whole"), fn.number_or_null("edgeacc_m").alias("number"), F.coalesce(whole, F.lit(0)).alias("whole_or_0"))


@query(f"""WITH {cte('attrs')}, long AS (
  SELECT 'attachment' AS field, attachment AS value FROM attrs UNION ALL SELECT 'depthcat', depthcat FROM attrs
  UNION ALL SELECT 'featconf', featconf FROM attrs UNION ALL SELECT 'typeconf', typeconf FROM attrs)
SELECT field, value, count(*) AS n FROM long WHERE nullif(trim(value), '') IS NOT NULL AND NOT CASE field
  WHEN 'attachment' THEN value IN ('Land', 'Isolated', 'Fringing', 'Oceanic')
  WHEN 'depthcat' THEN value IN ('Land', 'Surface', 'Intertidal', 'Very Shallow', 'Shallow', 'Deep')
  ELSE value IN ('Very Low', 'Low', 'Medium', 'High') END GROUP BY field, value""")
def enum_violations(spark, d):
    """P14."""
    return at.enum_violations(layer(spark, d, "attrs"))


@query(f"""WITH {cte('rects')}, w AS (SELECT *, 2 * sqrt((x1 - x0) * (y1 - y0) * 400 / pi()) AS width FROM rects)
SELECT fid, {_even('width', 1)} AS width,
  CASE WHEN width >= 0 AND width < 100 THEN 'Very small' WHEN width < 300 THEN 'Small' WHEN width < 1000 THEN 'Medium' WHEN width < 3000 THEN 'Large' ELSE 'Very large' END AS size_class,
  CAST(trunc(50 / width * 100) AS INTEGER) AS edge_percent, x0 / 111000 AS degrees, greatest(x0 / 100, 2.5) AS clamped, x0 IS DISTINCT FROM y0 AS changed,
  CASE WHEN (x1 - x0) / 1000 > 0.01 THEN 'Large' ELSE 'Small' END AS large, width < 10 AS narrow, fid % 700 / width > 1 AS over_width, fid % 700 / width > 0.5 AS over_half, fid % 700 / width < 0.01 AS under_1_percent,
  contains(cls, 'Reef') AS reef, CASE WHEN y0 > 0 THEN x0 / y0 * 100 ELSE 0 END AS ratio, lpad(CAST(fid % 100 AS VARCHAR), 2, '0') AS padded, upper(cls) AS cls FROM w""")
def scalar_functions(spark, d):
    """F2, F3, F5, F7 to F14, P11."""
    r = layer(spark, d, "rects")
    w = fn.effective_width(box_area() * 400)
    return r.select(
        "fid", fn.half_even(w, 1).alias("width"), fn.size_class(w).alias("size_class"), fn.edge_width_percent(F.lit(50.0), w).alias("edge_percent"),
        fn.metres_to_degrees(F.col("x0")).alias("degrees"), fn.clamp_low(F.col("x0") / 100, 2.5).alias("clamped"),
        fn.large_small((F.col("x1") - F.col("x0")) / 1000).alias("large"), *[v.alias(k) for k, v in fn.edge_checks((F.col("fid") % 700).cast("double"), w).items()], F.contains("cls", F.lit("Reef")).alias("reef"),
        fn.differs([(F.col("x0"), F.col("y0"))]).alias("changed"), fn.safe_ratio(F.col("x0"), F.col("y0")).alias("ratio"),
        F.lpad((F.col("fid") % 100).cast("string"), 2, "0").alias("padded"), F.upper("cls").alias("cls"),
    )


@query(f"""WITH {cte('rects')} SELECT fid, (x1 - x0) * (y1 - y0) AS area, 2 * (x1 - x0) + 2 * (y1 - y0) AS length, true AS ccw,
  'POLYGON ((' || CAST(x0 AS VARCHAR) || ' ' || CAST(y0 AS VARCHAR) || ', ' || CAST(x1 AS VARCHAR) || ' ' || CAST(y0 AS VARCHAR) || ', ' || CAST(x1 AS VARCHAR) || ' '
  || CAST(y1 AS VARCHAR) || ', ' || CAST(x0 AS VARCHAR) || ' ' || CAST(y1 AS VARCHAR) || ', ' || CAST(x0 AS VARCHAR) || ' ' || CAST(y0 AS VARCHAR) || '))' AS wkt,
  true AS same, fid % 2 = 0 AS same_turned FROM rects""")
def ring_functions(spark, d):
    """Rings as columns, half of them turned round first."""
    r = layer(spark, d, "rects").withColumn("ring", fn.box_ring(*map(F.col, ("x0", "y0", "x1", "y1"))))
    given = F.when(F.col("fid") % 2 == 0, F.col("ring")).otherwise(F.reverse("ring"))
    r = r.withColumn("given", given).withColumn("turned", fn.oriented(F.col("given")))
    return r.select(
        "fid", (fn.ring_area2(F.col("turned")) / 2).alias("area"), fn.ring_length(F.col("given")).alias("length"), (fn.ring_area2(F.col("turned")) > 0).alias("ccw"),
        fn.ring_wkt(F.col("turned")).alias("wkt"), fn.rings_equal(F.col("turned"), F.col("ring"), 1e-9).alias("same"),
        fn.rings_equal(F.col("given"), F.col("ring"), 1e-9).alias("same_turned"),
    )


@query("""WITH k AS (SELECT err_id, any_value(actlon) AS lon, any_value(actlat) AS lat FROM position_error WHERE actlon BETWEEN 90 AND 170 AND actlat BETWEEN -50 AND -5 GROUP BY err_id),
c AS (SELECT sqrt(0.00669438002290) AS e, radians(-18) AS p1, radians(-36) AS p2),
m AS (SELECT *, cos(p1) / sqrt(1 - pow(e * sin(p1), 2)) AS m1, cos(p2) / sqrt(1 - pow(e * sin(p2), 2)) AS m2,
  tan(pi() / 4 - p1 / 2) / pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1, tan(pi() / 4 - p2 / 2) / pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2 FROM c),
n AS (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM m), f AS (SELECT *, m1 / (n * pow(t1, n)) AS f FROM n),
q AS (SELECT err_id, n, f, radians(lon - 134) * n AS theta, 6378137 * f AS rho0,
  6378137 * f * pow(tan(pi() / 4 - radians(lat) / 2) / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2), n) AS rho FROM k, f)
SELECT err_id, round(rho * sin(theta), 2) AS x, round(rho0 - rho * cos(theta), 2) AS y, true AS back FROM q""")
def projection_3112(spark, d):
    """Degrees to the national Lambert grid and back."""
    e = table(spark, d, "position_error").where(F.col("actlon").between(90, 170) & F.col("actlat").between(-50, -5)).groupBy("err_id").agg(F.any_value("actlon").alias("lon"), F.any_value("actlat").alias("lat"))
    x, y = fn.lonlat_to_3112(F.col("lon"), F.col("lat"))
    e = e.withColumns({"x": x, "y": y})
    lon, lat = fn.lonlat_from_3112(F.col("x"), F.col("y"))
    return e.select("err_id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), ((F.abs(lon - F.col("lon")) < 1e-9) & (F.abs(lat - F.col("lat")) < 1e-9)).alias("back"))


# Crosswalks


def _crosswalk(spark, d):
    """Names in the class lists of the crosswalk, in the form in which names compare, one row for each name and place."""
    cw = table(spark, d, "rb_type_l3_crosswalk")
    names = vocabulary(table(spark, d, "nw_features"), "rb_type_l3")
    read = split_packed(cw, "cw_id", "rb_type_l3_v0_3", names).select(F.col("row_key").alias("row_no"), name_key("val").alias("old"))
    return read.join(cw.select(F.col("cw_id").alias("row_no"), F.col("rb_type_l3_v0_4").alias("new")).distinct(), "row_no")


@query()
def crosswalk_explode(spark, d):
    """List field exploded, classes overwritten, unmatched ones null."""
    pairs = _crosswalk(spark, d).groupBy("old").agg(F.min_by(F.struct("new"), "row_no")["new"].alias("new"))
    return cp.crosswalk_by_name(table(spark, d, "nw_features").select("row_id", "rb_type_l3"), pairs, "old", "new", "rb_type_l3")


@query()
def crosswalk_duplicates(spark, d):
    """A22."""
    return at.duplicate_keys(_crosswalk(spark, d), "old")


_MAPPED = [
    ("Platform Coral Reef", "Coral Reef Shallow", "Isolated", "No"), ("Fringing Coral Reef", "Coral Reef Shallow", "Fringing", "No"), ("Sand Bank", "Sand Bank", "Isolated", "No"),
]


@query(f"""WITH {cte('attrs')}, m(rb_type_l3, feat_l3, geoattach, paleo) AS (VALUES {', '.join(map(str, _MAPPED))})
SELECT fid, a.rb_type_l3, coalesce(feat_l3, 'Unknown') AS feat_l3, coalesce(geoattach, 'Unknown') AS geoattach, coalesce(paleo, 'N') AS paleo,
  'NW_' || CAST(fid AS VARCHAR) AS debugid FROM attrs a LEFT JOIN m USING (rb_type_l3)""")
def crosswalk_dict(spark, d):
    """D3, P10: attribute sets by class with an Unknown default; ids by key."""
    m = spark.createDataFrame(_MAPPED, "rb_type_l3 string, feat_l3 string, geoattach string, paleo string")
    out = cp.crosswalk_by_dict(layer(spark, d, "attrs").select("fid", "rb_type_l3"), m, "rb_type_l3", ["feat_l3", "geoattach", "paleo"])
    return out.withColumn("debugid", F.concat(F.lit("NW_"), F.col("fid").cast("string")))


_RULES = [
    (1, "Platform Coral Reef", "Isolated;Oceanic", "Shallow; Deep", "A"), (2, "Platform Coral Reef", "Isolated;Fringing", "Shallow;Surface", "B"),
    (3, "Rocky Reef", "Land;Fringing;Isolated;Oceanic", "Intertidal;Very Shallow;Shallow", "C"), (4, "Sand Bank", "Oceanic; ;Land", "Surface;Land;Shallow", "D"),
    (5, "Rocky Reef", "Fringing", "Deep;Shallow", "E"), (6, "Fringing Coral Reef", "Fringing;Land", "Surface;Deep;Shallow;Intertidal", "F"),
]


def _expanded(spark, d):
    rules = spark.createDataFrame(_RULES, "row_no bigint, cls string, att string, dep string, so_level1 string")
    return cp.expand_attributes(layer(spark, d, "attrs"), rules, ("rb_type_l3", "cls"), {"attachment": "att", "depthcat": "dep"}, ["so_level1"])


_EXPANDED = f"""{cte('attrs')}, rules(row_no, cls, att, dep, so_level1) AS (VALUES {', '.join(map(str, _RULES))}),
ready AS (SELECT fid, rb_type_l3, attachment, coalesce(nullif(depthcat, ''), 'Shallow') AS depthcat, coalesce(CAST(trunc(TRY_CAST(edgeacc_m AS DOUBLE)) AS INTEGER), 0) AS edgeacc_m FROM attrs),
hit AS (SELECT f.*, row_no, so_level1, row_number() OVER (PARTITION BY fid ORDER BY row_no) AS rn FROM ready f JOIN rules r ON r.cls = f.rb_type_l3
  AND list_contains(list_transform(string_split(att, ';'), lambda x: trim(x)), attachment) AND attachment <> ''
  AND list_contains(list_transform(string_split(dep, ';'), lambda x: trim(x)), depthcat))"""


@query(f"WITH {_EXPANDED} SELECT fid, row_no AS matched_row, so_level1, edgeacc_m FROM hit WHERE rn = 1")
def crosswalk_first_match(spark, d):
    """D11, J10, F6."""
    return _expanded(spark, d)[0].select("fid", "matched_row", "so_level1", "edgeacc_m")


@query(f"""WITH {_EXPANDED} SELECT rb_type_l3, attachment, depthcat, count(*) AS n FROM ready WHERE fid NOT IN (SELECT fid FROM hit) GROUP BY ALL""")
def crosswalk_mismatch(spark, d):
    """Mismatches grouped for review (A1 with nulls kept)."""
    return _expanded(spark, d)[1].groupBy("rb_type_l3", "attachment", "depthcat").agg(F.count(F.lit(1)).alias("n"))


# Components, clusters, sources

def _set(c):
    return f"coalesce(array_to_string(list_sort(list(DISTINCT nullif(trim({c}), '')) FILTER (WHERE nullif(trim({c}), '') IS NOT NULL)), ';'), '')"


def _ranked(c, order, other):
    arms = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order))
    return f"coalesce(arg_min(trim({c}), (CASE trim({c}) {arms} ELSE {other} END, trim({c}))) FILTER (WHERE nullif(trim({c}), '') IS NOT NULL), '')"


@query(f"""WITH {cte('rects')}, p AS (SELECT fid % 50 AS grp, fid, CAST((fid * 37) % 201 - 100 AS DOUBLE) AS buf, cls FROM rects)
SELECT grp, arg_max(buf, (abs(buf), fid)) AS buffer_m, {_set('cls')} AS classes FROM p GROUP BY grp""")
def largest_shift(spark, d):
    """The signed value of the largest magnitude, and a distinct join."""
    p = layer(spark, d, "rects").select((F.col("fid") % 50).alias("grp"), "fid", ((F.col("fid") * 37) % 201 - 100).cast("double").alias("buf"), "cls")
    return p.groupBy("grp").agg(cp.largest_shift(p, "fid", "buf").alias("buffer_m"), at.joined_set("cls").alias("classes"))


_COV = "\nUNION ALL\n".join(
    f"SELECT '{s}' AS source, count(*) FILTER (WHERE {s}) AS n, count(*) FILTER (WHERE {s} AND hits = 1) AS n_only, count(*) AS t FROM h" for s in FLAG_SOURCES
)
_HITS = f"h AS (SELECT *, {' + '.join(f'CAST({s} AS INTEGER)' for s in FLAG_SOURCES)} AS hits FROM flags)"


@query(f"""WITH {cte('flags')}, {_HITS}, c AS ({_COV}) SELECT source, n, {_even('n * 100.0 / t', 4)} AS share, n_only, {_even('n_only * 100.0 / t', 4)} AS share_only FROM c""")
def source_coverage(spark, d):
    """D18, A24, A25."""
    return cp.coverage(layer(spark, d, "flags"), FLAG_SOURCES)


@query(f"""WITH {cte('flags')}, {_HITS}, c AS ({_COV}), o AS (SELECT source, row_number() OVER (ORDER BY n DESC, list_position({FLAG_SOURCES}, source)) AS place FROM c),
first AS (SELECT cluster_id, min(place) AS place FROM (SELECT cluster_id, unnest(list_filter([{', '.join(f"CASE WHEN {s} THEN '{s}' END" for s in FLAG_SOURCES)}], lambda x: x IS NOT NULL)) AS source FROM flags) JOIN o USING (source) GROUP BY cluster_id)
SELECT CAST(place AS INTEGER) AS place, source, count(cluster_id) AS n_new, CAST(sum(count(cluster_id)) OVER (ORDER BY place) AS BIGINT) AS n_upto FROM o LEFT JOIN first USING (place) GROUP BY place, source""")
def source_cumulative(spark, d):
    """D18, A23."""
    return cp.cumulative_coverage(layer(spark, d, "flags"), FLAG_SOURCES)


# Statistics


@query("""WITH once AS (SELECT DISTINCT err_id, lower(trim(regexp_replace(regionname, '\\s+', ' ', 'g'))) AS regionname, matchfnd AND isfinite(error_m) AND error_m >= 0 AS ok, error_m FROM position_error),
e AS (SELECT *, CASE WHEN coalesce(ok, false) THEN error_m END AS v FROM once)
SELECT regionname, count(*) AS n_points, count(*) FILTER (WHERE coalesce(ok, false)) AS n_matched, count(*) FILTER (WHERE NOT coalesce(ok, false)) AS n_unmatched,
  round_even(avg(v), 4) AS mean_m, round_even(stddev_samp(v), 4) AS std_m, median(v) AS median_m, quantile_cont(v, 0.9) AS p90_m, quantile_cont(v, 0.95) AS p95_m, max(v) AS max_m
FROM e WHERE regionname IS NOT NULL AND regionname <> '' GROUP BY regionname""")
def error_stats(spark, d):
    """A15, A16, D22 statistics."""
    e = table(spark, d, "position_error").select("err_id", name_key("regionname").alias("regionname"), "matchfnd", "error_m").distinct()
    ok = F.coalesce(F.col("matchfnd") & (F.col("error_m") >= 0) & (F.col("error_m") < float("inf")), F.lit(False))
    return cp.error_statistics(e.withColumn("ok", ok), "regionname", "error_m", "ok")


@query("""WITH once AS (SELECT DISTINCT err_id, assessment, CASE WHEN isfinite(error_m) AND error_m >= 0 THEN greatest(error_m, 2.5) END AS value FROM position_error),
c AS (SELECT assessment, value, count(*) AS n FROM once GROUP BY ALL), t AS (SELECT assessment, count(*) AS t FROM once GROUP BY assessment)
SELECT assessment, value, n, round_even(sum(n) OVER (PARTITION BY assessment ORDER BY value) / t * 100, 6) AS percent FROM c JOIN t USING (assessment) WHERE value IS NOT NULL""")
def error_cdf(spark, d):
    """Section 2.7: empirical distribution; rows without an error count in the total."""
    v = F.when((F.col("error_m") >= 0) & (F.col("error_m") < float("inf")), F.col("error_m"))
    e = table(spark, d, "position_error").select("err_id", "assessment", v.alias("v")).distinct()
    return cp.cumulative_distribution(e, ["assessment"], "v")


@query("""WITH once AS (SELECT DISTINCT err_id, error_m AS y, edgeacc_m AS x FROM position_error), o AS (SELECT * FROM once WHERE x > 0 AND y > 0 AND isfinite(x) AND isfinite(y))
SELECT count(*) AS n, round_even(regr_slope(log10(y), log10(x)), 6) AS slope, round_even(regr_intercept(log10(y), log10(x)), 6) AS intercept,
  round_even(regr_r2(log10(y), log10(x)), 6) AS r2, round_even(avg(CASE WHEN y > x THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_exceeds FROM o""")
def loglog_regression(spark, d):
    """A20."""
    return cp.loglog_fit(table(spark, d, "position_error").select("err_id", "error_m", "edgeacc_m").distinct(), "edgeacc_m", "error_m")


_PCT = ", ".join(f"{(i + 1) / 20}" for i in range(20))


@query(f"""WITH once AS (SELECT DISTINCT line_id, fid, dist_m, edgeacc_m FROM match_lines WHERE isfinite(dist_m) AND dist_m >= 0 AND fid IS NOT NULL),
g AS (SELECT fid, count(*) AS n_samples, max(edgeacc_m) AS edge, quantile_cont(dist_m, [{_PCT}]) AS p, list_sort(list(dist_m)) AS v FROM once GROUP BY fid),
r AS (SELECT *, list_transform(p, lambda x: round_even(round(x, 9), 1)) AS pr, len(list_filter(v, lambda x: x <= edge)) AS j FROM g)
SELECT fid, n_samples, edge, CASE WHEN edge IS NULL THEN NULL WHEN edge <= v[1] THEN 0.0 WHEN edge >= v[n_samples] THEN 100.0
  ELSE round_even(round((j - 1 + (edge - v[j]) / (v[j + 1] - v[j])) / (n_samples - 1) * 100, 9), 1) END AS edge_perc, pr AS percentiles,
  CASE WHEN edge > 0 THEN list_transform(pr, lambda x: round_even(round(x / edge, 12), 4)) END AS ratios FROM r""")
def edge_metrics(spark, d):
    """D24, A15, A18, A19, J11."""
    ok = (F.col("dist_m") >= 0) & (F.col("dist_m") < float("inf")) & F.col("fid").isNotNull()
    lines = table(spark, d, "match_lines").where(ok).select("line_id", "fid", "dist_m", "edgeacc_m").distinct()
    return cp.edge_metrics(lines, "fid", "dist_m", "edgeacc_m")


@query("""WITH once AS (SELECT DISTINCT line_id, dist_m / edgeacc_m AS r FROM match_lines WHERE isfinite(dist_m) AND dist_m >= 0 AND edgeacc_m > 0), k AS (SELECT ln(r) AS l FROM once WHERE r BETWEEN 0.05 AND 5)
SELECT count(*) AS n, round_even(avg(l), 6) AS mu, round_even(stddev_pop(l), 6) AS sigma FROM k""")
def edge_ratio_lognormal(spark, d):
    """A17."""
    ok = (F.col("dist_m") >= 0) & (F.col("dist_m") < float("inf")) & (F.col("edgeacc_m") > 0)
    return cp.lognormal_fit(table(spark, d, "match_lines").where(ok).select("line_id", (F.col("dist_m") / F.col("edgeacc_m")).alias("r")).distinct(), "r")


# Batches, sampling, catalogues


@query("""WITH n AS (SELECT n_nationkey, count(*) AS t FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT n_nationkey AS region, CAST(unnest(range(0, CAST(ceil(t / 10.0) AS BIGINT))) AS INTEGER) AS batch, unnest(list_transform(range(0, CAST(ceil(t / 10.0) AS BIGINT)), lambda i: least(10, t - i * 10))) AS n FROM n""")
def stratified_batches(spark, d):
    """10 features per region and batch, none twice; sizes are fixed whatever the draw."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("region"), F.col("c_custkey").alias("fid"))
    return cp.stratified_batches(c, "region", "fid", 10, 42).groupBy("region", "batch").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(CASE WHEN p_partkey % 3 = 0 THEN 'NAU' ELSE 'GBR' END AS VARCHAR) || CAST(p_partkey % 40 AS VARCHAR) AS tile_id FROM part WHERE p_partkey % 3 = 0")
def tile_selection(spark, d):
    """Tiles of a region, repeats kept."""
    t = table(spark, d, "part").select(
        F.when(F.col("p_partkey") % 3 == 0, "NAU").otherwise("GBR").alias("region"), (F.col("p_partkey") % 40).cast("string").alias("t")
    )
    return cp.choose_tiles(t.select("region", F.concat("region", "t").alias("tile_id")), region="NAU")


@query("""WITH p AS (SELECT 'base' || CASE WHEN p_partkey % 5 > 0 THEN '/a' || CAST(p_partkey % 5 AS VARCHAR) ELSE '' END || CASE WHEN p_partkey % 7 > 3 THEN '/b/c/d' ELSE '/b' END AS folder,
  CASE WHEN p_partkey % 2 = 0 THEN 'tif' ELSE 'txt' END AS ext, p_partkey FROM part), k AS (SELECT folder, p_partkey || '.tif' AS tile, len(string_split(folder, '/')) - 1 AS depth FROM p WHERE ext = 'tif')
SELECT folder, count(*) AS n, folder || '/' || string_split(folder, '/')[-1] || '.vrt' AS mosaic, list(tile ORDER BY tile) AS tiles FROM k WHERE depth BETWEEN 1 AND 3 GROUP BY folder HAVING count(*) >= 2""")
def raster_catalog(spark, d):
    """S13."""
    k = F.col("p_partkey")
    folder = F.concat(F.lit("base"), F.when(k % 5 > 0, F.concat(F.lit("/a"), (k % 5).cast("string"))).otherwise(""), F.when(k % 7 > 3, "/b/c/d").otherwise("/b"))
    path = F.concat(folder, F.lit("/"), k.cast("string"), F.when(k % 2 == 0, ".tif").otherwise(".txt"))
    return cp.raster_catalogue(table(spark, d, "part").select(path.alias("path")), base_depth=1)
