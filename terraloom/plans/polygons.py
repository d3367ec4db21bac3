"""Queries over outlines: joins, components, overlays, version diff and sampling, each with the SQL for the same rows.

All edges of the outlines run along whole numbers or x + y = constant. So SQL finds areas by counting half cells (the two
halves of a unit cell along that diagonal), contact by looking for a lattice point that both outlines hold, and distances
from the vertices and edges in the text of the outlines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.common import Scratch, table
from terraloom.functions import scalar as fn
from terraloom.functions.kernel import geo, with_bounds
from terraloom.operators import attributes as at
from terraloom.operators.spatial import dissolve, exact, nearest, pair, spatial_join, subdivide
from terraloom.plans import composites as cp
from terraloom.plans.fixtures import cte, holds, layer, outlines
from terraloom.plans.reference import _even, _ranked, _set

CELL = 64.0
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _spread(cols: str, src: str, box: tuple[str, str, str, str], more: int) -> str:
    x0, y0, x1, y1 = box
    return (
        f"FROM (SELECT {cols}, unnest(range(CAST({x0} AS BIGINT), CAST({x1} AS BIGINT) + {more})) AS gx FROM {src}) s, "
        f"LATERAL (SELECT unnest(range(CAST(s.{y0} AS BIGINT), CAST(s.{y1} AS BIGINT) + {more})) AS gy)"
    )


_HALVES = "(VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.75 AS DOUBLE))) v(d)"
#: Centroid of a half cell in x and in y, less the cell's corner.
_MID = "(CASE WHEN d < 0.5 THEN 1 ELSE 2 END / 3.0)"


def _halves(name: str, where: str = "true", cols: str = "s.fid") -> str:
    """The half cells (px, py) of every outline."""
    src = f"(SELECT * FROM {name} WHERE {where})"
    return f"SELECT {cols}, gx + d AS px, gy + d AS py, gx + {_MID} AS mx, gy + {_MID} AS my {_spread('*', src, ('x0', 'y0', 'x1', 'y1'), 0)}, {_HALVES} WHERE {holds('s', 'gx + d', 'gy + d')}"


_MEET = "l.x0 <= r.x1 AND r.x0 <= l.x1 AND l.y0 <= r.y1 AND r.y0 <= l.y1"
_BOX = ("cx0", "cy0", "cx1", "cy1")


def _cand(left: str, right: str, on: str = "true", tag: str = "") -> str:
    return (
        f"cand{tag} AS (SELECT l, r, greatest(l.x0, r.x0) AS cx0, least(l.x1, r.x1) AS cx1, greatest(l.y0, r.y0) AS cy0, least(l.y1, r.y1) AS cy1 "
        f"FROM {left} l JOIN {right} r ON {on} AND {_MEET})"
    )


def _contact(left: str, right: str, on: str = "true", tag: str = "") -> str:
    """contact (lf, rf): pairs of outlines that meet."""
    both = f"{holds('l', 'gx', 'gy')} AND {holds('r', 'gx', 'gy')}"
    return f"{_cand(left, right, on, tag)}, contact{tag} AS (SELECT DISTINCT l.fid AS lf, r.fid AS rf {_spread('*', f'cand{tag}', _BOX, 1)} WHERE {both})"


def _common(tag: str = "") -> str:
    """common (lf, rf, area, x, y): what the candidate pairs have in common, with its centroid."""
    both = f"{holds('l', 'gx + d', 'gy + d')} AND {holds('r', 'gx + d', 'gy + d')}"
    return (
        f"common{tag} AS (SELECT l.fid AS lf, r.fid AS rf, count(*) / 2.0 AS area, avg(gx + {_MID}) AS x, avg(gy + {_MID}) AS y "
        f"{_spread('*', f'cand{tag}', _BOX, 0)}, {_HALVES} WHERE {both} GROUP BY ALL)"
    )


def _edges(name: str, tag: str = "") -> str:
    """edges (fid, x1, y1, x2, y2) of the outlines of a layer."""
    return rf"""rings{tag} AS (SELECT fid, unnest(regexp_extract_all(wkt, '\(([^()]+)\)', 1)) AS body FROM {name}),
vertices{tag} AS (SELECT fid, body, generate_subscripts(string_split(body, ', '), 1) AS k, unnest(string_split(body, ', ')) AS v FROM rings{tag}),
ends{tag} AS (SELECT fid, body, k, CAST(string_split(v, ' ')[1] AS DOUBLE) AS x, CAST(string_split(v, ' ')[2] AS DOUBLE) AS y FROM vertices{tag}),
edges{tag} AS (SELECT fid, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM ends{tag} WINDOW w AS (PARTITION BY fid, body ORDER BY k) QUALIFY x2 IS NOT NULL)"""


def _foot(px: str, py: str, e: str = "e") -> tuple[str, str, str]:
    """Nearest point of an edge, and its squared distance."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    t = f"greatest(0, least(1, (({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    x, y = f"({e}.x1 + {t} * {dx})", f"({e}.y1 + {t} * {dy})"
    return x, y, f"(pow({px} - {x}, 2) + pow({py} - {y}, 2))"


def _reach(nodes: str, links: str) -> str:
    """comp (fid, comp): components by the links (a, b) in both directions."""
    return f"""links AS ({links}), comp AS (WITH RECURSIVE reach(fid, comp) USING KEY (fid) AS (SELECT fid, fid FROM {nodes} UNION
  SELECT r.fid, min(n.comp) FROM recurring.reach r JOIN links k ON k.a = r.fid JOIN reach n ON n.fid = k.b GROUP BY r.fid, r.comp HAVING min(n.comp) < r.comp) SELECT * FROM reach)"""


_BOTH = "SELECT lf AS a, rf AS b FROM contact UNION ALL SELECT rf, lf FROM contact"


def _area(name: str = "area", geom: str = "geom"):
    return F.round(geo("area", geom), 6).alias(name)


# Joins


@query(f"""WITH {cte('shapes')}, {_cand('shapes', 'shapes', 'l.fid < r.fid')}, {_common()}
SELECT lf AS feature_1, rf AS feature_2, CAST(area AS DOUBLE) AS area, round(x, 6) AS x, round(y, 6) AS y, least(a.cls, b.cls) || ' | ' || greatest(a.cls, b.cls) AS types
FROM common JOIN shapes a ON a.fid = lf JOIN shapes b ON b.fid = rf""")
def overlap_pairs(spark, d):
    """Overlapping outlines with the centroid of what they share; contact alone is none."""
    out = cp.overlap_report(outlines(spark, d, "shapes"), CELL)
    return out.select("feature_1", "feature_2", F.round("area", 6).alias("area"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "types")


@query(f"""WITH {cte('shapes')}, {_cand('shapes', 'shapes', 'l.fid < r.fid')}, {_common()}
SELECT least(a.cls, b.cls) || ' | ' || greatest(a.cls, b.cls) AS types, count(*) AS n, CAST(sum(area) AS DOUBLE) AS area
FROM common JOIN shapes a ON a.fid = lf JOIN shapes b ON b.fid = rf GROUP BY 1""")
def overlap_type_pairs(spark, d):
    """Counts by sorted pair of classes."""
    return cp.overlap_counts(outlines(spark, d, "shapes"), CELL).withColumn("area", F.round("area", 4))


@query(f"""WITH {cte('shapes')}, {_contact('shapes', 'shapes', 'l.fid < r.fid')}, {_common()}, size AS (SELECT fid, count(*) / 2.0 AS a FROM ({_halves('shapes')}) GROUP BY fid)
SELECT lf, rf, c.lf IS NOT NULL AS intersects, area IS NULL AS touches, coalesce(area = b.a, false) AS contains, coalesce(area = a.a, false) AS within
FROM contact c LEFT JOIN common USING (lf, rf) JOIN size a ON a.fid = lf JOIN size b ON b.fid = rf""")
def pair_predicates(spark, d):
    """The four predicates over all pairs that meet."""
    s = outlines(spark, d, "shapes").select("fid", "geom", geo("plain", "geom").alias("plain"), "x0", "y0", "x1", "y1")
    s = Scratch(spark).keep(s)  # read for both sides
    p = spatial_join(s, s, CELL, on=F.col("l_fid") < F.col("r_fid")).select("l_fid", "r_fid", pair("relation").alias("_r")).where("_r > 0")
    kinds = {"intersects": 1, "touches": 2, "contains": 4, "within": 8}
    return p.select(F.col("l_fid").alias("lf"), F.col("r_fid").alias("rf"), *[(F.col("_r").bitwiseAND(F.lit(k)) > 0).alias(c) for c, k in kinds.items()])


@query(f"""WITH {cte('rects', 'zones')}, c AS (SELECT fid, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM rects)
SELECT c.fid, regionname FROM c LEFT JOIN zones z ON {holds('z', 'c.x', 'c.y')}""")
def region_assign(spark, d):
    """Points to regions that are no boxes, unassigned kept, border points in both regions."""
    c = layer(spark, d, "rects").select("fid", ((F.col("x0") + F.col("x1")) / 2).alias("x0"), ((F.col("y0") + F.col("y1")) / 2).alias("y0"))
    text = F.concat(F.lit("POINT ("), F.col("x0").cast("string"), F.lit(" "), F.col("y0").cast("string"), F.lit(")"))
    zones = outlines(spark, d, "zones")
    c = c.withColumns({"x1": F.col("x0"), "y1": F.col("y0"), "geom": geo("from_text", text)})
    return spatial_join(c, zones, 400.0, on=exact("intersects"), how="left").select(F.col("l_fid").alias("fid"), F.col("r_regionname").alias("regionname"))


@query(f"WITH {cte('shapes', 'land_shapes')}, {_contact('shapes', 'land_shapes')} SELECT fid FROM shapes WHERE fid NOT IN (SELECT lf FROM contact)")
def away_from_land(spark, d):
    """J4."""
    return spatial_join(outlines(spark, d, "shapes"), outlines(spark, d, "land_shapes"), CELL, on=exact("intersects"), how="anti").select("fid")


@query(f"""WITH {cte('shapes', 'ref_shapes')}, {_contact('shapes', 'ref_shapes')}
SELECT 'a' AS side, lf AS fid FROM contact GROUP BY lf UNION ALL SELECT 'b', rf FROM contact GROUP BY rf""")
def mutual_overlap(spark, d):
    """Features of either layer that meet the other."""
    a, b = outlines(spark, d, "shapes"), outlines(spark, d, "ref_shapes")
    one = spatial_join(a, b, CELL, on=exact("intersects"), how="semi").select(F.lit("a").alias("side"), "fid")
    return one.unionByName(spatial_join(b, a, CELL, on=exact("intersects"), how="semi").select(F.lit("b").alias("side"), "fid"))


def _nearest_sql(points: str, layer_: str, radius: float) -> str:
    _, _, d2 = _foot("n.x", "n.y")
    return f"""{_edges(layer_)}, near AS (SELECT s.fid AS sid, s.x, s.y, r.fid AS rid, {holds('r', 's.x', 's.y')} AS inn FROM {points} s JOIN {layer_} r
  ON s.x BETWEEN r.x0 - {radius} AND r.x1 + {radius} AND s.y BETWEEN r.y0 - {radius} AND r.y1 + {radius}),
dist AS (SELECT sid, rid, round(CASE WHEN inn THEN 0 ELSE sqrt(min({d2})) END, 12) AS dd FROM near n JOIN edges e ON e.fid = rid GROUP BY sid, rid, inn),
best AS (SELECT sid, arg_min(rid, (dd, rid)) AS m, min(dd) AS dd FROM dist WHERE dd <= {radius} GROUP BY sid)"""


@query(f"""WITH {cte('spots_off', 'shapes')}, {_nearest_sql('spots_off', 'shapes', 20.0)}
SELECT fid, m AS match_fid, round(dd, 9) AS distance, dd IS NOT NULL AS matched FROM spots_off LEFT JOIN best ON fid = sid""")
def nearest_within(spark, d):
    """Nearest outline within a radius, 0 inside it, unmatched points kept."""
    s = layer(spark, d, "spots_off").select("fid", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    shapes = outlines(spark, d, "shapes").select("fid", "geom", "x0", "y0", "x1", "y1")
    text = F.concat(F.lit("POINT ("), F.col("x0").cast("string"), F.lit(" "), F.col("y0").cast("string"), F.lit(")"))
    s = s.withColumn("geom", geo("from_text", text))
    return nearest(s, shapes, 20.0, F.round(geo("distance", "l_geom", "r_geom"), 12), "fid", "fid").withColumn("distance", F.round("distance", 9))


@query(f"""WITH {cte('shapes', 'zones')}, {_cand('shapes', 'zones')}, {_common()} SELECT lf AS fid, rf AS regionid, CAST(area AS DOUBLE) AS area FROM common""")
def clip_area(spark, d):
    """What features and regions share, all regions."""
    s, z = (outlines(spark, d, n).select("fid", "geom", "x0", "y0", "x1", "y1") for n in ("shapes", "zones"))
    met = spatial_join(s, z, 400.0).withColumn("_o", geo("overlap", "l_geom", "r_geom")).where(F.col("_o.area") > 0)
    return met.select(F.col("l_fid").alias("fid"), F.col("r_fid").alias("regionid"), F.round("_o.area", 6).alias("area"))


@query(f"""WITH {cte('shapes', 'land_shapes')}, a AS ({_halves('shapes')}), b AS (SELECT DISTINCT px, py FROM ({_halves('land_shapes')}))
SELECT a.fid, s.cls, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM a SEMI JOIN b USING (px, py) JOIN shapes s ON s.fid = a.fid GROUP BY ALL""")
def clip_layer(spark, d):
    """Features cut to the union of a mask, their attributes kept, those without area dropped."""
    out = cp.clip(outlines(spark, d, "shapes"), outlines(spark, d, "land_shapes"), CELL)
    return out.select("fid", "cls", _area()).where("area > 0")


# Geometry functions


_PER = "sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)))"


@query(f"""WITH {cte('shapes')}, {_edges('shapes')}, h AS (SELECT fid, count(*) / 2.0 AS area, avg(mx) AS cx, avg(my) AS cy FROM ({_halves('shapes')}) GROUP BY fid),
p AS (SELECT fid, {_PER} AS per FROM edges GROUP BY fid), n AS (SELECT fid, count(*) AS rings FROM rings GROUP BY fid)
SELECT fid, x0, y0, x1, y1, CAST(area AS DOUBLE) AS area, round(per, 6) AS perimeter, round(cx, 6) AS cx, round(cy, 6) AS cy, fid % 5 <> 3 OR false AS single,
  CASE WHEN fid % 5 = 2 THEN 1 ELSE 0 END AS n_holes, CASE WHEN fid % 5 = 3 THEN 2 ELSE 1 END AS n_parts, true AS valid, true AS ccw, CAST(area AS DOUBLE) AS repaired, true AS inside
FROM shapes JOIN h USING (fid) JOIN p USING (fid) JOIN n USING (fid)""")
def geometry_functions(spark, d):
    """Measures, bounds, centroid, interior point, rings, parts, validity, repair by a buffer of nothing, orientation."""
    s = outlines(spark, d, "shapes").drop("x0", "y0", "x1", "y1").withColumn("c", geo("centroid", "geom"))
    return with_bounds(s).select(
        "fid", "x0", "y0", "x1", "y1", _area(), F.round(geo("perimeter", "geom"), 6).alias("perimeter"), F.round(geo("x0", "c"), 6).alias("cx"), F.round(geo("y0", "c"), 6).alias("cy"),
        (geo("type", "geom") == "Polygon").alias("single"), F.size(geo("holes", "geom")).alias("n_holes"), F.size(geo("parts", "geom")).alias("n_parts"), geo("is_valid", "geom").alias("valid"),
        geo("is_ccw", geo("orient", "geom")).alias("ccw"), F.round(geo("area", geo("buffer0", "geom")), 6).alias("repaired"), geo("contains", "geom", geo("inside_point", "geom")).alias("inside"),
    )


@query(f"""WITH {cte('rects')} SELECT fid, false AS valid, 'Self-intersection' AS reason, round((x1 - x0) * (y1 - y0) / 2, 6) AS mended, 2 AS parts FROM rects""")
def bow_ties(spark, d):
    """Crossed outlines, the reason, and their two halves after the repair."""
    x0, y0, x1, y1 = (F.col(c).cast("string") for c in ("x0", "y0", "x1", "y1"))
    ring = [(x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0)]
    text = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat_ws(" ", *p) for p in ring]), F.lit("))"))
    b = outlines(spark, d, "shapes").select("fid").join(layer(spark, d, "rects"), "fid").withColumn("geom", geo("from_text", text)).withColumn("good", geo("make_valid", "geom"))
    return b.select("fid", geo("is_valid", "geom").alias("valid"), geo("invalid_reason", "geom").alias("reason"), _area("mended", "good"), F.size(geo("parts", "good")).alias("parts"))


@query(f"""WITH {cte('rects')}, r AS (SELECT *, x1 - x0 AS w, y1 - y0 AS h, fid % 7 + 1 AS b FROM rects)
SELECT fid, round(w * h + 2 * (w + h) * b + 32 * sin(pi() / 32) * b * b, 6) AS grown, round((w - 2) * (h - 2), 6) AS shrunk, w * h AS closed, 5 AS n_points,
  x1 AS along_x, y0 + 1 AS along_y, x0 AS near_x, y0 AS near_y, sqrt(74) AS away FROM r""")
def box_functions(spark, d):
    """G10, G11, G12, G14, G15, G16 where they are known in closed form: buffers of 16 segments a quarter, closing, simplifying, places on a line."""
    outlines(spark, d, "shapes")
    r = layer(spark, d, "rects").withColumn("geom", geo("from_text", fn.ring_wkt(fn.box_ring(*map(F.col, ("x0", "y0", "x1", "y1"))))))
    x0, y0, x1, y1 = map(F.col, ("x0", "y0", "x1", "y1"))
    rough = F.concat(F.array(F.struct(x0.alias("x"), y0.alias("y")), F.struct(((x0 + x1) / 2).alias("x"), (y0 + 0.01).alias("y"))), F.slice(fn.box_ring(x0, y0, x1, y1), 2, 4))
    line = geo("exterior", "geom")
    spot = geo("from_text", F.concat(F.lit("POINT ("), (x0 - 5).cast("string"), F.lit(" "), (y0 - 7).cast("string"), F.lit(")")))
    at_, near = geo("point_along", line, x1 - x0 + 1), geo("nearest_on", spot, line)
    return r.select(
        "fid", F.round(geo("area", geo("buffer", "geom", (F.col("fid") % 7 + 1).cast("double"))), 6).alias("grown"), F.round(geo("area", geo("buffer", "geom", -1.0)), 6).alias("shrunk"),
        F.round(geo("area", geo("close", "geom", 1e-6)), 3).alias("closed"), geo("n_points", geo("simplify", geo("from_text", fn.ring_wkt(rough)), 0.1)).alias("n_points"),
        F.round(geo("x0", at_), 9).alias("along_x"), F.round(geo("y0", at_), 9).alias("along_y"), geo("x0", near).alias("near_x"), geo("y0", near).alias("near_y"), geo("distance", spot, "geom").alias("away"),
    )


@query(f"WITH {cte('shapes')} SELECT fid, true AS same, fid % 3 <> 0 AS same_moved, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM ({_halves('shapes')}) GROUP BY fid")
def cut_and_join(spark, d):
    """Outlines cut along a grid and put together again; equality within 1e-9."""
    s = outlines(spark, d, "shapes")
    whole = dissolve(subdivide(s.select("fid", "geom", "x0", "y0", "x1", "y1"), 16.0), ["fid"], 32.0).withColumnRenamed("geom", "again")
    moved = geo("moved", "geom", F.when(F.col("fid") % 3 == 0, 1e-6).otherwise(0.0), F.lit(0.0))
    return s.join(whole, "fid").select("fid", geo("equals_exact", "geom", "geom", 1e-9).alias("same"), geo("equals_exact", "geom", moved, 1e-9).alias("same_moved"), _area("area", "again"))


# Components, clusters, sources


@query(f"""WITH {cte('attr_shapes')}, {_contact('attr_shapes', 'attr_shapes', 'l.fid < r.fid AND l.cls = r.cls')}, {_reach('attr_shapes', _BOTH)},
u AS (SELECT comp, count(*) / 2.0 AS area FROM (SELECT DISTINCT comp, px, py FROM ({_halves('attr_shapes')}) JOIN comp USING (fid)) GROUP BY comp)
SELECT cls, comp AS component, {_set('rb_type_l3')} AS rb_l3_agg, {_ranked('attachment', at.ATTACHMENT_PRIORITY, 99)} AS attachment,
  array_to_string(list_filter(['Land', 'Isolated', 'Fringing', 'Oceanic'], lambda v: list_contains(list(trim(attachment)), v)), ';') AS attset,
  {_ranked('depthcat', at.DEPTH_ORDER, 999)} AS depthcat, {_ranked('featconf', tuple(at.CONFIDENCE), -1)} AS featconf, {_ranked('typeconf', tuple(at.CONFIDENCE), -1)} AS typeconf,
  {_set('edgesrc')} AS edgesrc, coalesce(CAST(trunc(max(TRY_CAST(edgeacc_m AS DOUBLE))) AS INTEGER), 0) AS edgeacc_m, count(*) AS n_parts, attset LIKE '%;%' AS multi_attachment, CAST(any_value(area) AS DOUBLE) AS area
FROM attr_shapes JOIN comp USING (fid) JOIN u USING (comp) GROUP BY cls, comp""")
def dissolve_l2(spark, d):
    """Groups of a class by contact, attributes put together, united outline."""
    out = cp.dissolve_layer(outlines(spark, d, "attr_shapes"), CELL)
    return out.withColumn("area", F.round(geo("area", "geom"), 3)).drop("geom")


def _pair_distance(name: str, reach: float) -> str:
    _, _, d2 = _foot("v.x", "v.y")
    side = lambda p, q: f"SELECT a, b, {d2} AS d2 FROM pairs JOIN ends v ON v.fid = {p} JOIN edges e ON e.fid = {q}"
    wide = f"l.x0 - {reach} <= r.x1 AND r.x0 <= l.x1 + {reach} AND l.y0 - {reach} <= r.y1 AND r.y0 <= l.y1 + {reach}"
    return f"""{_edges(name)}, pairs AS (SELECT l.fid AS a, r.fid AS b FROM {name} l JOIN {name} r ON l.cls = r.cls AND l.fid < r.fid AND {wide}),
apart AS (SELECT a, b FROM ({side('a', 'b')} UNION ALL {side('b', 'a')}) GROUP BY a, b HAVING min(d2) <= {reach} * {reach})"""


@query(f"""WITH {cte('shapes')}, {_contact('shapes', 'shapes', 'l.fid < r.fid AND l.cls = r.cls')}, {_pair_distance('shapes', 3.3)},
{_reach('shapes', _BOTH + ' UNION ALL SELECT a, b FROM apart UNION ALL SELECT b, a FROM apart')},
c AS (SELECT cls, comp, count(DISTINCT fid) AS n_parts, count(*) / 2.0 * 16 AS a, count(DISTINCT (px, py)) / 2.0 AS u FROM ({_halves('shapes', cols='s.fid, s.cls')}) JOIN comp USING (fid) GROUP BY cls, comp), w AS (SELECT *, 2 * sqrt(a / pi()) AS w FROM c)
SELECT cls, comp AS cluster_id, n_parts, {_even('a / 1e6', 5)} AS c_area_km2, {_even('w', 1)} AS eff_wid_m,
  CASE WHEN w < 100 THEN 'Very small' WHEN w < 300 THEN 'Small' WHEN w < 1000 THEN 'Medium' WHEN w < 3000 THEN 'Large' ELSE 'Very large' END AS size_class, CAST(u AS DOUBLE) AS area FROM w""")
def reef_clusters(spark, d):
    """Features of a class at most 3.3 units apart, their area, effective width and united outline."""
    return cp.clusters(outlines(spark, d, "shapes"), CELL, 3.3, 4.0).withColumn("area", F.round(geo("area", "geom"), 6)).drop("geom")


@query(f"""WITH {cte('shapes')}, {_contact('shapes', 'shapes', 'l.fid < r.fid')}, {_reach('shapes', _BOTH)}, h AS ({_halves('shapes')}),
e AS (SELECT fid, CAST(fid % 97 AS DOUBLE) AS edge, count(*) / 2.0 AS a FROM h GROUP BY fid), u AS (SELECT comp, count(DISTINCT (px, py)) / 2.0 AS u FROM h JOIN comp USING (fid) GROUP BY comp)
SELECT comp AS fid, max(edge) AS edgeacc_m, CAST(sum(a) AS DOUBLE) AS area, count(*) AS n, CAST(any_value(u) AS DOUBLE) AS united FROM e JOIN comp USING (fid) JOIN u USING (comp) GROUP BY comp""")
def dissolve_all(spark, d):
    """One dissolve over all classes with the largest accuracy, the summed area and the united outline; groups keep a left join of their statistics."""
    keep = Scratch(spark).keep  # each is read several times
    r = keep(outlines(spark, d, "shapes").withColumn("cls", F.lit("all")))
    m = keep(r.withColumn("edge", (F.col("fid") % 97).cast("double")).join(cp.same_class_components(r, CELL), "fid"))
    union = dissolve(m, ["component"], CELL * 8).select("component", _area("united"))
    facts = m.groupBy("component").agg(F.max("edge").alias("edgeacc_m"), F.round(F.sum(geo("area", "geom")), 6).alias("area"), F.count(F.lit(1)).alias("n"))
    return union.join(facts, "component", "left").withColumnRenamed("component", "fid")


_SRC = ["AHS", "KIM", "UNEP", "GA", "bath_m", "bath_i", "cht_m", "cht_i"]
_HIT = f"""{_contact('shapes', 'ref_shapes', tag='_r')}, {_contact('shapes', 'tag_shapes', tag='_t')},
hits AS (SELECT lf, source FROM contact_r JOIN ref_shapes ON fid = rf UNION SELECT lf, source FROM contact_t JOIN tag_shapes ON fid = rf),
f AS (SELECT s.fid, any_value(cls) AS cls, {', '.join(f"coalesce(bool_or(source = '{x}'), false) AS src_{x.lower()}" for x in _SRC)} FROM shapes s LEFT JOIN hits ON lf = s.fid GROUP BY s.fid),
g AS (SELECT *, CASE WHEN src_ahs OR src_kim OR src_unep OR src_ga OR src_bath_m OR src_cht_m THEN 'Previously mapped' WHEN src_bath_i OR src_cht_i THEN 'Previously indicated' ELSE 'Newly mapped' END AS known_stat FROM f)"""


@query(f"WITH {cte('shapes', 'ref_shapes', 'tag_shapes')}, {_HIT} SELECT * EXCLUDE (cls) FROM g")
def source_status(spark, d):
    """D16, J3, P11, P12."""
    refs = outlines(spark, d, "ref_shapes").unionByName(outlines(spark, d, "tag_shapes"))
    out = cp.source_flags(outlines(spark, d, "shapes"), refs, _SRC, CELL, exact("intersects"))
    return out.withColumn("known_stat", cp.known_status()).drop("x0", "y0", "x1", "y1", "cls", "geom")


@query(f"""WITH {cte('shapes', 'ref_shapes', 'tag_shapes')}, {_HIT}, a AS (SELECT fid, count(*) / 2.0 AS a FROM ({_halves('shapes')}) GROUP BY fid)
SELECT cls, count(*) AS n, count(*) FILTER (WHERE known_stat = 'Previously mapped') AS n_mapped, count(*) FILTER (WHERE known_stat = 'Previously indicated') AS n_indicated,
  count(*) FILTER (WHERE known_stat = 'Newly mapped') AS n_new, CAST(sum(CASE WHEN known_stat = 'Newly mapped' THEN a ELSE 0 END) AS DOUBLE) AS area_new FROM g JOIN a USING (fid) GROUP BY cls""")
def status_breakdown(spark, d):
    """A3: conditional counts and areas."""
    s = source_status(spark, d).join(outlines(spark, d, "shapes"), "fid")
    st = F.col("known_stat")
    return s.groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(st == "Previously mapped").alias("n_mapped"), F.count_if(st == "Previously indicated").alias("n_indicated"),
        F.count_if(st == "Newly mapped").alias("n_new"), F.round(F.sum(F.when(st == "Newly mapped", geo("area", "geom")).otherwise(0.0)), 4).alias("area_new"),
    )


@query(f"""WITH {cte('shapes', 'ref_shapes', 'tag_shapes', 'zones')}, {_contact('ref_shapes', 'shapes', tag='_r')}, {_contact('tag_shapes', 'shapes', tag='_t')},
miss AS (SELECT * FROM ref_shapes WHERE fid NOT IN (SELECT lf FROM contact_r) UNION ALL SELECT * FROM tag_shapes WHERE fid NOT IN (SELECT lf FROM contact_t)),
h AS ({_halves('miss', cols='s.source, s.fid')}), z AS (SELECT DISTINCT px, py FROM ({_halves('zones', 'fid % 2 = 0')}))
SELECT source, count(DISTINCT fid) AS n, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM h SEMI JOIN z USING (px, py) GROUP BY source""")
def missed_references(spark, d):
    """References that no feature meets, cut to the boundary, by source."""
    every = outlines(spark, d, "ref_shapes").unionByName(outlines(spark, d, "tag_shapes"))
    bound = outlines(spark, d, "zones").where("fid % 2 = 0")  # the boundary: every other zone of the chequered fixture
    out = cp.missed_references(every, outlines(spark, d, "shapes"), bound, CELL).withColumn("a", geo("area", "geom")).where("a > 0")
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("a"), 4).alias("area"))


@query(f"""WITH {cte('shapes', 'ref_shapes', 'land_shapes')}, {_contact('shapes', 'land_shapes', tag='_l')}, {_contact('ref_shapes', 'land_shapes', tag='_m')}, {_contact('ref_shapes', 'shapes', tag='_p')},
coastal AS (SELECT DISTINCT lf FROM contact_l), own AS (SELECT fid FROM ref_shapes WHERE fid NOT IN (SELECT lf FROM contact_m) AND fid NOT IN (SELECT lf FROM contact_p WHERE rf IN (FROM coastal))),
m AS (SELECT lf AS a, rf AS r FROM contact_p WHERE lf IN (FROM own) AND rf NOT IN (FROM coastal)),
v AS (SELECT (SELECT count(*) FROM shapes WHERE fid NOT IN (FROM coastal)) AS p, (SELECT count(*) FROM own) AS o, (SELECT count(DISTINCT a) FROM m) AS tp, (SELECT count(DISTINCT r) FROM m) AS tr)
SELECT unnest(['rough_platform', 'auto_platform', 'true_positives', 'true_positives_rough', 'false_positives', 'false_negatives', 'true_positive_rate', 'false_positive_rate', 'false_negative_rate', 'true_positive_rate_rough']) AS metric,
  unnest([p, o, tp, tr, o - tp, p - tr, {_even('tp * 100.0 / p', 4)}, {_even('(o - tp) * 100.0 / o', 4)}, {_even('(p - tr) * 100.0 / p', 4)}, {_even('tr * 100.0 / p', 4)}]::DOUBLE[]) AS value FROM v""")
def mask_confusion(spark, d):
    """D13, A21, A27."""
    return cp.mask_confusion(*(outlines(spark, d, n) for n in ("shapes", "ref_shapes", "land_shapes")), CELL)


_UNCHARTED = f"""{cte('shapes', 'land_shapes', 'zones')}, reg AS (SELECT * FROM zones WHERE fid IN (6, 7, 8)), big AS (SELECT fid, cls, count(*) / 2.0 AS area FROM ({_halves('shapes', cols='s.fid, s.cls')}) GROUP BY ALL)"""


@query(f"""WITH {_UNCHARTED}, {_cand('shapes', 'reg', tag='_z')}, pts AS (SELECT l.fid AS fid, gx, gy {_spread('*', 'cand_z', _BOX, 1)} WHERE {holds('l', 'gx', 'gy')} AND {holds('r', 'gx', 'gy')}),
inside AS (SELECT fid, bool_or(EXISTS (SELECT 1 FROM land_shapes r WHERE {holds('r', 'pts.gx', 'pts.gy')})) AS u FROM pts GROUP BY fid)
SELECT cls, count(*) AS n, count(*) FILTER (WHERE u) AS n_uncharted, {_even('count(*) FILTER (WHERE u) * 100.0 / count(*)', 4)} AS pct, CAST(sum(area) AS DOUBLE) AS area FROM inside JOIN big USING (fid) GROUP BY cls""")
def uncharted(spark, d):
    """Features cut to a region, the share in an uncharted area."""
    reg = outlines(spark, d, "zones").where(F.col("fid").isin(6, 7, 8))
    s = outlines(spark, d, "shapes").withColumn("area", geo("area", "geom"))
    return cp.uncharted(s, reg, outlines(spark, d, "land_shapes"), CELL, 600.0)[0].withColumn("area", F.round("area", 4))


@query(f"WITH {_UNCHARTED} SELECT CASE WHEN area > 600 THEN 'Large' ELSE 'Small' END AS size, count(*) AS n, CAST(sum(area) AS DOUBLE) AS area FROM big GROUP BY 1")
def uncharted_sizes(spark, d):
    """Sizes of all features, in the region or not."""
    reg = outlines(spark, d, "zones").where(F.col("fid").isin(6, 7, 8))
    s = outlines(spark, d, "shapes").withColumn("area", geo("area", "geom"))
    return cp.uncharted(s, reg, outlines(spark, d, "land_shapes"), CELL, 600.0)[1].withColumn("area", F.round("area", 4))


@query(f"""WITH {cte('shapes', 'ref_shapes')}, {_contact('ref_shapes', 'shapes')}, {_reach('shapes', 'SELECT DISTINCT a.rf AS a, b.rf AS b FROM contact a JOIN contact b USING (lf) WHERE a.rf <> b.rf')},
cells AS (SELECT comp, px, py FROM ({_halves('shapes')}) JOIN comp USING (fid) UNION SELECT comp, px, py FROM ({_halves('ref_shapes')}) h JOIN contact ON lf = h.fid JOIN comp c ON c.fid = rf),
u AS (SELECT comp, count(*) / 2.0 AS area FROM cells GROUP BY comp)
SELECT comp AS fid, count(DISTINCT c.fid) AS n_members, count(DISTINCT lf) AS n_absorbed, CAST(any_value(area) AS DOUBLE) AS area FROM comp c LEFT JOIN contact ON rf = c.fid JOIN u USING (comp) GROUP BY comp""")
def connected_merge(spark, d):
    """Masters joined through shared absorbed features, with the united outline."""
    out, _ = cp.connected_merge(outlines(spark, d, "shapes"), outlines(spark, d, "ref_shapes"), CELL, exact("intersects"))
    absorbed = F.greatest(F.size(F.coalesce("absorbed", F.array().cast("array<bigint>"))), F.lit(0)).cast("bigint")
    return out.select("fid", F.size("members").cast("bigint").alias("n_members"), absorbed.alias("n_absorbed"), _area())


@query(f"WITH {cte('shapes', 'ref_shapes')}, {_contact('ref_shapes', 'shapes')} SELECT fid, 'Semi-auto' AS edgesrc, 'High' AS featconf FROM ref_shapes WHERE fid NOT IN (SELECT lf FROM contact)")
def merge_untouched(spark, d):
    """What no master touches comes with the defaults."""
    _, rest = cp.connected_merge(outlines(spark, d, "shapes"), outlines(spark, d, "ref_shapes"), CELL, exact("intersects"))
    rest = at.align(rest, ["fid", "edgesrc", "featconf"])
    return at.fill_blanks(rest, {k.lower(): v for k, v in at.MERGE_DEFAULTS.items()})


# Version diff

_DIFF = f"""{cte('attr_shapes', 'new_shapes', 'added_shapes')}, new AS (SELECT * FROM new_shapes UNION ALL SELECT * FROM added_shapes), {_contact('new', 'attr_shapes')}, {_common()},
size AS (SELECT fid, count(*) / 2.0 AS a FROM ({_halves('new')}) GROUP BY fid), osize AS (SELECT fid, count(*) / 2.0 AS a FROM ({_halves('attr_shapes')}) GROUP BY fid),
near AS (SELECT c.lf AS n, c.rf AS o, x.wkt = y.wkt AS same, round(coalesce(area, 0) / (s.a + z.a - coalesce(area, 0)), 12) AS iou FROM contact c LEFT JOIN common USING (lf, rf)
  JOIN new x ON x.fid = c.lf JOIN attr_shapes y ON y.fid = c.rf JOIN size s ON s.fid = c.lf JOIN osize z ON z.fid = c.rf),
e1 AS (SELECT n, o, row_number() OVER (PARTITION BY n ORDER BY n, o) AS i, row_number() OVER (PARTITION BY o ORDER BY n, o) AS j FROM near WHERE same),
eq AS (SELECT n, o FROM e1 WHERE i = j),
p0 AS (SELECT n, o, iou FROM near WHERE iou >= 0.5 AND n NOT IN (SELECT n FROM eq) AND o NOT IN (SELECT o FROM eq))"""
_ROUNDS = "".join(
    f""",
w{k} AS (SELECT n, o, iou FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY iou DESC, n, o) AS i, row_number() OVER (PARTITION BY o ORDER BY iou DESC, n, o) AS j FROM p{k}) WHERE i = 1 AND j = 1),
p{k + 1} AS (SELECT n, o, iou FROM p{k} WHERE n NOT IN (SELECT n FROM w{k}) AND o NOT IN (SELECT o FROM w{k}))"""
    for k in range(6)
)


@query(f"""WITH {_DIFF}{_ROUNDS}, better AS ({' UNION ALL '.join(f'SELECT n, o FROM w{k}' for k in range(6))}),
pairs AS (SELECT 'unchanged' AS change, n, o FROM eq UNION ALL SELECT 'improved', n, o FROM better),
rn AS (SELECT fid FROM new WHERE fid NOT IN (SELECT n FROM pairs)), ro AS (SELECT fid FROM attr_shapes WHERE fid NOT IN (SELECT o FROM pairs)),
met AS (SELECT n, o FROM near WHERE n IN (SELECT fid FROM rn) AND o IN (SELECT fid FROM ro))
SELECT change, n AS new_fid, o AS old_fid, (a.attachment IS DISTINCT FROM b.attachment) OR (a.depthcat IS DISTINCT FROM b.depthcat) AS attr_chg
FROM pairs JOIN new a ON a.fid = n JOIN attr_shapes b ON b.fid = o
UNION ALL SELECT 'improved', n, NULL, NULL FROM met GROUP BY n
UNION ALL SELECT 'new', fid, NULL, NULL FROM rn WHERE fid NOT IN (SELECT n FROM met)
UNION ALL SELECT 'deleted', NULL, fid, NULL FROM ro WHERE fid NOT IN (SELECT o FROM met)""")
def version_diff(spark, d):
    """Versions matched by equal outlines, then by the overlap of outlines."""
    new = outlines(spark, d, "new_shapes").unionByName(outlines(spark, d, "added_shapes"))
    return cp.version_diff(outlines(spark, d, "attr_shapes"), new, CELL)


# Overlays


def _less(a: str, b: str) -> str:
    return f"a AS ({a}), b AS (SELECT DISTINCT px, py FROM ({b}))"


@query(f"""WITH {cte('shapes')}, {_less(_halves('shapes', "cls = 'Coral Reef'"), _halves('shapes', "cls = 'Rocky Reef'"))}
SELECT fid, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM a ANTI JOIN b USING (px, py) GROUP BY fid""")
def class_difference(spark, d):
    """One class minus every feature of the other that it meets."""
    r = outlines(spark, d, "shapes")
    return cp.difference(r.where("cls = 'Coral Reef'"), r.where("cls = 'Rocky Reef'"), CELL).select("fid", _area())


@query(f"""WITH {cte('shapes', 'land_shapes')}, {_less(_halves('shapes'), _halves('land_shapes'))}
SELECT fid, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM a ANTI JOIN b USING (px, py) GROUP BY fid""")
def clip_land(spark, d):
    """The strict clip; polygons only go in, others would come out apart."""
    kept, _ = cp.clip_land_split(outlines(spark, d, "shapes"), outlines(spark, d, "land_shapes"), CELL)
    return kept.select("fid", _area())


def _mixed(spark, d) -> DataFrame:
    """Every seventh outline as its boundary line instead, every eleventh as null."""
    line = F.when(F.col("fid") % 7 == 0, geo("boundary", "geom")).when(F.col("fid") % 11 != 0, F.col("geom"))
    return outlines(spark, d, "shapes").withColumn("geom", line)


@query(f"WITH {cte('shapes')} SELECT CASE WHEN fid % 7 = 0 OR fid % 11 = 0 THEN 'rejected' ELSE 'polygons' END AS side, fid FROM shapes")
def split_types(spark, d):
    """Polygons apart from lines and nulls."""
    polygons, rest = cp.split_by_type(_mixed(spark, d))
    return polygons.select(F.lit("polygons").alias("side"), "fid").unionByName(rest.select(F.lit("rejected").alias("side"), "fid"))


@query(f"WITH {cte('shapes')} SELECT fid, CASE WHEN fid % 7 = 0 THEN 'not polygonal' ELSE 'null' END AS reason FROM shapes WHERE fid % 7 = 0 OR fid % 11 = 0")
def bad_geometries(spark, d):
    """Null, empty, invalid and other geometries with the reason."""
    return cp.geometry_violations(_mixed(spark, d))


@query(f"""WITH {cte('rects', 'land_shapes')}, t AS (SELECT fid, x0, y0, x1, y1, gx + dx AS px, gy + dy AS py {_spread('*', 'rects', ('x0', 'y0', 'x1', 'y1'), 0)}, (VALUES (0.25, 0.25), (0.75, 0.75)) v(dx, dy)),
b AS (SELECT DISTINCT CAST(px AS DOUBLE) AS px, CAST(py AS DOUBLE) AS py FROM ({_halves('land_shapes')}))
SELECT fid, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM t ANTI JOIN b ON b.px = t.px AND b.py = t.py GROUP BY fid""")
def clip_land_repaired(spark, d):
    """Boxes whose outlines run once to and fro along their diagonal are repaired, then clipped."""
    outlines(spark, d, "land_shapes")
    x0, y0, x1, y1 = (F.col(c).cast("string") for c in ("x0", "y0", "x1", "y1"))
    ring = [(x0, y0), (x1, y1), (x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    text = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat_ws(" ", *p) for p in ring]), F.lit("))"))
    bad = layer(spark, d, "rects").withColumn("geom", geo("from_text", text))
    return cp.clip_land(bad, outlines(spark, d, "land_shapes"), CELL, strict=False).select("fid", _area())


@query(f"""WITH {cte('shapes', 'ref_shapes')}, t AS ({_halves('shapes', "cls = 'Coral Reef'")}), hits AS (SELECT l.fid AS tid, r FROM shapes l JOIN ref_shapes r ON {_MEET} WHERE l.cls = 'Coral Reef'),
cut AS (SELECT t.fid, px, py, min(r.fid) AS k FROM t JOIN hits ON tid = t.fid AND {holds('r', 'px', 'py')} GROUP BY ALL)
SELECT t.fid, CAST(count(DISTINCT c.k) AS INTEGER) AS n_cuts, CAST(count(*) FILTER (WHERE c.k IS NULL) / 2.0 AS DOUBLE) AS area FROM t LEFT JOIN cut c USING (fid, px, py)
GROUP BY t.fid HAVING count(*) FILTER (WHERE c.k IS NULL) > 0""")
def priority_overlap(spark, d):
    """Overlays folded off each target in order, only overlaps above the threshold counted."""
    r = outlines(spark, d, "shapes")
    return cp.priority_overlaps(r.where("cls = 'Coral Reef'"), outlines(spark, d, "ref_shapes"), CELL).select("fid", "n_cuts", _area())


@query(f"""WITH {cte('shapes', 'ref_shapes', 'land_shapes')}, keep AS (SELECT DISTINCT px, py FROM (({_halves('shapes')}) UNION ALL ({_halves('ref_shapes')}))), gone AS (SELECT DISTINCT px, py FROM ({_halves('land_shapes')}))
SELECT (SELECT arg_min(cls, fid) FROM shapes) AS cls, CAST(count(*) / 2.0 AS DOUBLE) AS area FROM keep ANTI JOIN gone USING (px, py)""")
def mask_correction(spark, d):
    """(mask and additions) minus removals, as single parts with the first mask row's attributes; their total area."""
    add = outlines(spark, d, "ref_shapes").withColumn("operation", F.lit("Add"))
    cut = outlines(spark, d, "land_shapes").withColumn("operation", F.lit("Remove"))
    parts = cp.correct_mask(outlines(spark, d, "shapes"), add.drop("source").unionByName(cut), CELL)
    return parts.select("cls", _area()).groupBy("cls").agg(F.round(F.sum("area"), 4).alias("area"))


@query(f"""WITH {cte('shapes', 'ref_shapes')}, {_less(_halves('ref_shapes'), _halves('shapes'))}
SELECT fid, CAST(count(*) / 2.0 AS DOUBLE) AS area, 'Shallow Sediment' AS rb_type_l3 FROM a ANTI JOIN b USING (px, py) GROUP BY fid""")
def residual_features(spark, d):
    """What of a mask no feature covers."""
    out = cp.residual_features(outlines(spark, d, "ref_shapes"), outlines(spark, d, "shapes"), {"rb_type_l3": "Shallow Sediment"}, CELL)
    return out.select("fid", "rb_type_l3", _area()).groupBy("fid", "rb_type_l3").agg(F.round(F.sum("area"), 6).alias("area"))


@query(f"WITH {cte('shapes')} SELECT cls, CAST(count(DISTINCT (px, py)) / 2.0 AS DOUBLE) AS area FROM ({_halves('shapes', cols='s.cls')}) GROUP BY cls")
def dissolve_union(spark, d):
    """A5: union per class in two levels."""
    return dissolve(outlines(spark, d, "shapes"), ["cls"], 500.0).select("cls", _area())


# Boundary error and sampling


def _geodesic_sql(src: str, rounds: int = 8) -> str:
    """CTEs that end in ``geodesic`` (fid, error_m): Vincenty's inverse series between (act_lat, act_lon) and (match_lat, match_lon) of ``src``."""
    a, f = fn.WGS84_A, fn.WGS84_F
    b = a * (1 - f)
    flat = lambda c: f"atan({1 - f!r} * tan(radians({c})))"
    out = [
        f"v0 AS (SELECT fid, sin({flat('act_lat')}) AS su1, cos({flat('act_lat')}) AS cu1, sin({flat('match_lat')}) AS su2, cos({flat('match_lat')}) AS cu2, "
        f"radians(match_lon - act_lon) AS ell, radians(match_lon - act_lon) AS lam FROM {src})"
    ]
    for k in range(rounds):
        out.append(f"s{k} AS (SELECT *, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss, su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM v{k})")
        out.append(f"t{k} AS (SELECT *, atan2(ss, cs) AS sigma, cu1 * cu2 * sin(lam) / nullif(ss, 0) AS sa FROM s{k})")
        out.append(f"u{k} AS (SELECT *, 1 - sa * sa AS c2, cs - 2 * su1 * su2 / nullif(1 - sa * sa, 0) AS c2m FROM t{k})")
        last = k == rounds - 1
        c = f"({f!r} / 16 * c2 * (4 + {f!r} * (4 - 3 * c2)))"
        lam = f"ell + (1 - {c}) * {f!r} * sa * (sigma + {c} * ss * (c2m + {c} * cs * (2 * c2m * c2m - 1)))"
        out.append(f"v{k + 1} AS (SELECT fid, su1, cu1, su2, cu2, ell, {lam} AS lam{', ss, cs, sigma, c2, c2m' if last else ''} FROM u{k})")
    uu = f"(c2 * {(a * a - b * b) / (b * b)!r})"
    out.append(f"w AS (SELECT *, 1 + {uu} / 16384 * (4096 + {uu} * (-768 + {uu} * (320 - 175 * {uu}))) AS ba, {uu} / 1024 * (256 + {uu} * (-128 + {uu} * (74 - 47 * {uu}))) AS bb FROM v{rounds})")
    ds = "bb * ss * (c2m + bb / 4 * (cs * (2 * c2m * c2m - 1) - bb / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))"
    out.append(f"geodesic AS (SELECT fid, {b!r} * ba * (sigma - {ds}) AS error_m FROM w)")
    return ",\n".join(out)


_QX, _QY, _Q2 = _foot("s.x", "s.y")


@query(f"""WITH {cte('spots_off', 'attr_shapes', 'zones')}, {_nearest_sql('spots_off', 'attr_shapes', 10.0)},
hit AS (SELECT s.fid, arg_min({_QX}, {_Q2}) AS qx, arg_min({_QY}, {_Q2}) AS qy FROM spots_off s JOIN best ON sid = s.fid JOIN edges e ON e.fid = m GROUP BY s.fid),
o AS (SELECT s.fid, s.x, s.y, -20 + s.y / 1000 AS act_lat, 120 + s.x / 1000 AS act_lon, -20 + qy / 1000 AS match_lat, 120 + qx / 1000 AS match_lon, m FROM spots_off s LEFT JOIN hit USING (fid) LEFT JOIN best ON sid = s.fid),
{_geodesic_sql('(SELECT * FROM o WHERE m IS NOT NULL)')}
SELECT o.fid, round(act_lat, 9) AS act_lat, round(act_lon, 9) AS act_lon, round(match_lat, 9) AS match_lat, round(match_lon, 9) AS match_lon, TRY_CAST(a.edgeacc_m AS DOUBLE) AS edgeacc_m,
  m IS NOT NULL AS match_found, m AS match_fid, round(error_m, 3) AS error_m, regionname
FROM o LEFT JOIN attr_shapes a ON a.fid = m LEFT JOIN geodesic g ON g.fid = o.fid LEFT JOIN zones z ON {holds('z', 'o.x', 'o.y')}""")
def boundary_error(spark, d):
    """Nearest outline, its nearest boundary point, geodesic error, region; degrees scaled from the fixture."""
    s, a, z = layer(spark, d, "spots_off"), outlines(spark, d, "attr_shapes"), outlines(spark, d, "zones").select("geom", "regionname", "x0", "y0", "x1", "y1")
    out = cp.boundary_error(s, a.select("fid", "geom", "edgeacc_m", "x0", "y0", "x1", "y1"), 10.0, z, lambda x, y: (120 + x / 1000, -20 + y / 1000))
    return out.withColumns({c: F.round(c, 9) for c in ("act_lat", "act_lon", "match_lat", "match_lon")}).withColumn("error_m", F.round("error_m", 3))


_AROUND = f"""WITH {cte('shapes')}, parts AS (SELECT fid, 0 AS part, x0, y0, x1, y1 FROM shapes WHERE fid % 5 = 0), k AS (SELECT *, x0 + floor((x1 - x0) / 2) AS xm, y0 + floor((y1 - y0) / 2) AS ym FROM parts)"""


@query(f"""{_AROUND}, leg AS (SELECT fid, part, unnest([0, 1, 2, 3, 4, 5]) AS i, unnest([x0, x0, xm, xm, x1, x1]) AS ax, unnest([y0, y1, y1, ym, ym, y0]) AS ay, unnest([x0, xm, xm, x1, x1, x0]) AS bx, unnest([y1, y1, ym, ym, y0, y0]) AS by_ FROM k),
run AS (SELECT *, abs(bx - ax) + abs(by_ - ay) AS len, sum(abs(bx - ax) + abs(by_ - ay)) OVER (PARTITION BY fid ORDER BY i) AS upto, sum(abs(bx - ax) + abs(by_ - ay)) OVER (PARTITION BY fid) AS total FROM leg),
s AS (SELECT fid, part, total, unnest(range(6)) AS sid FROM (SELECT DISTINCT fid, part, total FROM run))
SELECT s.fid, part, CAST(sid AS INTEGER) AS sid, round(ax + (bx - ax) * (s.total * sid / 6 - upto + len) / len, 6) AS x, round(ay + (by_ - ay) * (s.total * sid / 6 - upto + len) / len, 6) AS y
FROM s JOIN run USING (fid, part) WHERE s.total * sid / 6 >= upto - len AND s.total * sid / 6 < upto""")
def perimeter_samples(spark, d):
    """Places at i/k of the outlines that have a corner out, clockwise from the least vertex."""
    got = cp.ring_samples(outlines(spark, d, "shapes").where("fid % 5 = 0"))  # the outlines of this form; the others have 4 or 5 vertices
    return got.select("fid", "part", "sid", F.round(geo("x0", "geom"), 6).alias("x"), F.round(geo("y0", "geom"), 6).alias("y"))


@query()
def edge_samples(spark, d):
    """Samples of dissolved reef outlines of a region away from land, and the nearest outline of another layer."""
    s, r, land, z = (outlines(spark, d, n) for n in ("shapes", "ref_shapes", "land_shapes", "zones"))
    near, far = cp.edge_sampling(s, r, land, z.select("fid", "geom", "x0", "y0", "x1", "y1"), CELL, 200.0, 3.0, F.col("cls") == "Coral Reef")
    return near.unionByName(far).select("fid", "part", "sid", "dist_m", "matched")


@query()
def dithered_outlines(spark, d):
    """Outlines moved by a truncated log-normal share of their accuracy, parts that meet united."""
    a = outlines(spark, d, "shapes").withColumn("edgeacc_m", (F.col("fid") % 9 + 1).cast("double"))
    return cp.dithered_dissolve(a, CELL).select("fid", "buffer_m", "n_parts", "classes", F.round("area", 6).alias("area"))


def _degrees(df: DataFrame) -> DataFrame:
    """The layer at a thousandth of its size, as positions."""
    return with_bounds(df.withColumn("geom", geo("moved", geo("scaled", "geom", 0.001), 120.0, -20.0)))


@query("SELECT CAST(round(0.3 * (count(*) * 10) / 0.7) AS BIGINT) AS n, true AS all_inside FROM nation")
def validation_decoys(spark, d):
    """As many decoys as the share asks for, each with its centre within the mask before it is shifted by up to 0.3 of its size."""
    mask = _degrees(outlines(spark, d, "zones"))
    n = cp.decoy_count(table(spark, d, "nation").count() * 10)
    got = cp.decoys(n, mask, (120.0, -20.0, 124.0, -16.0), 5)
    box = got.withColumn("g", F.greatest(F.lit(1.0), 1 / F.col("aspect")) * F.col("width_m") * 0.3 / 111000)
    spot = geo("from_text", F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")")))
    box = box.select("no", "g", spot.alias("geom"), (F.col("x") - F.col("g")).alias("x0"), (F.col("y") - F.col("g")).alias("y0"), (F.col("x") + F.col("g")).alias("x1"), (F.col("y") + F.col("g")).alias("y1"))
    near = spatial_join(box, mask.select("geom", "x0", "y0", "x1", "y1"), 0.4, on=geo("distance", "l_geom", "r_geom") <= F.col("l_g") * 2**0.5, how="semi", key="no")
    return got.agg(F.count(F.lit(1)).alias("n")).join(near.agg(F.count(F.lit(1)).alias("m"))).select("n", (F.col("n") == F.col("m")).alias("all_inside"))


@query()
def validation_batch(spark, d):
    """One batch of real features and decoys with centroid, extent and boundary point."""
    s, land, z = (_degrees(outlines(spark, d, n)) for n in ("shapes", "land_shapes", "zones"))
    regions = z.select("geom", F.col("fid").alias("regionid"), "x0", "y0", "x1", "y1")
    return cp.validation_batch(s, regions, land, 0, 10, z, (120.0, -20.0, 124.0, -16.0), 0.05)


@query("SELECT 1 AS least_id, true AS consecutive, true AS shares")
def validation_ids(spark, d):
    """A batch's ids run from 1 without gaps; decoys are three tenths of it, to the nearest whole number."""
    b = validation_batch(spark, d).agg(F.count(F.lit(1)).alias("n"), F.min("valid_id").alias("a"), F.max("valid_id").alias("z"), F.count_distinct("valid_id").alias("k"), F.count_if("fake").alias("f"))
    real = F.col("n") - F.col("f")
    return b.select(F.col("a").cast("int").alias("least_id"), ((F.col("z") == F.col("n")) & (F.col("k") == F.col("n"))).alias("consecutive"), (F.abs(F.col("f") - real * 3 / 7) <= 0.5).alias("shares"))

