"""Spatial joins over layers with a bounding box (x0, y0, x1, y1) and, optionally, a geometry column.

Boxes are laid on a square grid and joined on the cell; of the cells a pair shares, only the one that holds the
lower left corner of the common part reports it, so no distinct is needed. The exact predicate comes last, and
only for pairs whose boxes meet. A feature that covers very many cells (a coastline) should be cut with
``subdivide`` first. Cells that hold many features are split by AQE's skew join.

Defined results: boxes that only touch do meet; null or empty geometries (null boxes) meet nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.common import Scratch
from terraloom.functions.kernel import geo
from terraloom.functions.scalar import point_on_segment
from terraloom.operators.graph import connected_components

BOX = ("x0", "y0", "x1", "y1")
#: Features of a cell that are put together in one call; beyond it, the cell is dealt to several.
BATCH = 4096


def _cells(df: DataFrame, cell: float, grow: float = 0.0) -> DataFrame:
    lo = lambda c: F.floor((F.col(c) - grow) / cell).cast("bigint")
    hi = lambda c: F.floor((F.col(c) + grow) / cell).cast("bigint")
    df = df.where(F.col("x0").isNotNull())
    return df.withColumn("_cx", F.explode(F.sequence(lo("x0"), hi("x1")))).withColumn("_cy", F.explode(F.sequence(lo("y0"), hi("y1"))))


def suggested_cell(df: DataFrame) -> float:
    """Twice the median extent of the boxes: most features then lie in one to four cells."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return max(float(df.agg(F.percentile_approx(side, 0.5, 1000)).first()[0] or 0.0) * 2, 1e-9)


def box_pairs(left: DataFrame, right: DataFrame, cell: float, within: float = 0.0) -> DataFrame:
    """All pairs whose boxes meet, or are at most ``within`` apart in x and in y. Columns become l_* and r_*."""
    ll = _cells(left, cell, within).select(*[F.col(c).alias(f"l_{c}") for c in left.columns], "_cx", "_cy")
    rr = _cells(right, cell).select(*[F.col(c).alias(f"r_{c}") for c in right.columns], "_cx", "_cy")
    meet = (
        (F.col("l_x0") - within <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1") + within)
        & (F.col("l_y0") - within <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1") + within)
    )
    own = (F.col("_cx") == F.floor(F.greatest(F.col("l_x0") - within, F.col("r_x0")) / cell)) & (
        F.col("_cy") == F.floor(F.greatest(F.col("l_y0") - within, F.col("r_y0")) / cell)
    )
    return ll.join(rr, ["_cx", "_cy"]).where(meet & own).drop("_cx", "_cy")


def exact(predicate: str, geom: str = "geom") -> Column:
    """A kernel predicate over the pair."""
    return geo(predicate, f"l_{geom}", f"r_{geom}")


def pair(measure: str) -> Column:
    """A kernel measure over the pair of outlines whose ``plain`` says how it may be taken."""
    return geo(measure, "l_geom", "r_geom", "l_plain", "r_plain")


def equal_boxes(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """Pairs whose boxes are equal within ``tolerance`` in each number; columns become l_* and r_*.

    The numbers go to steps of a thousand tolerances with multiples of them in the middle, so most rows have one place and meet only their equals.
    """
    step = tolerance * 1000
    at = lambda c, d: F.floor((F.col(c) + d) / step + 0.5).cast("bigint")
    ll = left.where(F.col("x0").isNotNull())
    for c in BOX:
        ll = ll.withColumn(f"_{c}", F.explode(F.sequence(at(c, -tolerance), at(c, tolerance))))
    ll = ll.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], *[f"_{c}" for c in BOX])
    rr = right.where(F.col("x0").isNotNull()).select(*[F.col(c).alias(f"r_{c}") for c in right.columns], *[at(c, 0.0).alias(f"_{c}") for c in BOX])
    return ll.join(rr, [f"_{c}" for c in BOX]).drop(*[f"_{c}" for c in BOX])


def cell_masks(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Each left row (l_fid, l_geom) with the united right geometries (r_geom) around each of its cells, by dimension.

    The right side is united once for each cell instead of once for each left row. Of a larger geometry what lies within a cell
    around the cell is taken.
    """
    num = lambda c: c.cast("string")
    lo, hi = lambda c: num((F.col(c) - 0.5) * cell), lambda c: num((F.col(c) + 1.5) * cell)
    line = F.concat(F.lit("LINESTRING ("), lo("_cx"), F.lit(" "), lo("_cy"), F.lit(", "), hi("_cx"), F.lit(" "), hi("_cy"), F.lit(")"))
    fits = (F.col("x0") >= (F.col("_cx") - 1) * cell) & (F.col("x1") <= (F.col("_cx") + 2) * cell) & (F.col("y0") >= (F.col("_cy") - 1) * cell) & (F.col("y1") <= (F.col("_cy") + 2) * cell)
    ll = _cells(left.select("fid", "geom", *BOX), cell).select(F.col("fid").alias("l_fid"), F.col("geom").alias("l_geom"), "_cx", "_cy")
    parts = _cells(right.select("geom", *BOX), cell).withColumn("g", F.when(fits, F.col("geom")).otherwise(geo("cut_to_box", "geom", geo("from_text", line))))
    parts = parts.select("_cx", "_cy", "g", geo("dimension", "g").alias("_d"), F.pmod(F.xxhash64("g"), F.lit(16)).alias("_s"))
    for by in (["_cx", "_cy", "_d", "_s"], ["_cx", "_cy", "_d"]):
        parts = parts.groupBy(*by).agg(geo("union_all", F.collect_list("g")).alias("g"))
    return ll.join(parts.select("_cx", "_cy", F.col("g").alias("r_geom")), ["_cx", "_cy"]).drop("_cx", "_cy")


def spatial_join(
    left: DataFrame, right: DataFrame, cell: float, on: Column | None = None, how: str = "inner", key: str = "fid", within: float = 0.0
) -> DataFrame:
    """``how``: inner and left give l_* and r_* columns; semi and anti give rows of ``left`` as they are."""
    pairs = box_pairs(left, right, cell, within)
    pairs = pairs if on is None else pairs.where(on)
    if how == "inner":
        return pairs
    if how in ("semi", "anti"):
        hit = pairs.select(F.col(f"l_{key}").alias(key)).distinct()
        return left.join(hit, key, f"left_{how}")
    if how == "left":
        rest = left.join(pairs.select(F.col(f"l_{key}").alias(key)).distinct(), key, "left_anti")
        rest = rest.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
        return pairs.unionByName(rest, allowMissingColumns=True)
    raise ValueError(how)


def common_box(a: str = "l_", b: str = "r_") -> dict[str, Column]:
    return {
        "x0": F.greatest(F.col(f"{a}x0"), F.col(f"{b}x0")), "y0": F.greatest(F.col(f"{a}y0"), F.col(f"{b}y0")),
        "x1": F.least(F.col(f"{a}x1"), F.col(f"{b}x1")), "y1": F.least(F.col(f"{a}y1"), F.col(f"{b}y1")),
    }


def box_area(prefix: str = "") -> Column:
    return (F.col(f"{prefix}x1") - F.col(f"{prefix}x0")) * (F.col(f"{prefix}y1") - F.col(f"{prefix}y0"))


def common_area() -> Column:
    c = common_box()
    return F.greatest(c["x1"] - c["x0"], F.lit(0.0)) * F.greatest(c["y1"] - c["y0"], F.lit(0.0))


def box_distance() -> Column:
    dx = F.greatest(F.col("l_x0") - F.col("r_x1"), F.col("r_x0") - F.col("l_x1"), F.lit(0.0))
    dy = F.greatest(F.col("l_y0") - F.col("r_y1"), F.col("r_y0") - F.col("l_y1"), F.lit(0.0))
    return F.hypot(dx, dy)


def nearest(left: DataFrame, right: DataFrame, radius: float, distance: Column, left_key: str, right_key: str, keep_unmatched: bool = True) -> DataFrame:
    """The one nearest right row within ``radius`` of each left row; ties go to the smallest right key.

    Cells are as wide as the radius, so a left row looks into at most nine. Only the best candidate per left row
    is kept in the shuffle.
    """
    pairs = box_pairs(left, right, max(radius, 1e-12), within=radius).withColumn("distance", distance).where(F.col("distance") <= radius)
    best = pairs.groupBy(F.col(f"l_{left_key}").alias(left_key)).agg(
        F.min(F.struct("distance", F.col(f"r_{right_key}").alias("match"))).alias("b")
    )
    best = best.select(left_key, F.col("b.match").alias(f"match_{right_key}"), F.col("b.distance").alias("distance"))
    if not keep_unmatched:
        return best
    return left.select(left_key).join(best, left_key, "left").withColumn("matched", F.col("distance").isNotNull())


def nearest_on_ring(px: Column, py: Column, ring: Column) -> Column:
    """Nearest point struct<d, x, y> of a closed ring of struct<x, y>."""
    legs = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.struct(F.element_at(ring, i).alias("p"), F.element_at(ring, i + 1).alias("q")))
    spots = F.transform(legs, lambda e: point_on_segment(px, py, e["p"]["x"], e["p"]["y"], e["q"]["x"], e["q"]["y"]))
    return F.array_min(F.transform(spots, lambda s: F.struct(s["d"].alias("d"), s["x"].alias("x"), s["y"].alias("y"))))


def first_come(pairs: DataFrame, a: str, b: str, order: list[Column]) -> DataFrame:
    """1:1 subset of candidate pairs that are equal matches: k-th partner on one side meets k-th on the other."""
    wa, wb = Window.partitionBy(a).orderBy(*order), Window.partitionBy(b).orderBy(*order)
    ranked = pairs.withColumn("_ra", F.row_number().over(wa)).withColumn("_rb", F.row_number().over(wb))
    return ranked.where(F.col("_ra") == F.col("_rb")).drop("_ra", "_rb")


def contact_components(layer: DataFrame, cell: float, within: float = 0.0, by: tuple[str, ...] = ()) -> DataFrame:
    """(fid, component): features linked by contact, or by a distance of at most ``within``, and of equal ``by``; the smallest ``fid`` reachable.

    The features of a cell are put together in one call, in which a pair that is linked already is not looked at again, so pairs never
    leave the call. What remains to be linked are the groups that share a feature, a few for each cell. A cell of more than ``BATCH`` features is cut into
    slices, and every two slices are a call.
    """
    at = [*by, "_cx", "_cy"]
    spread = _cells(layer.select("fid", *by, "geom", *BOX), cell, within).select("fid", "geom", *at)
    crowded = spread.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BATCH).select(*at, F.ceil(F.col("_n") / BATCH).alias("_s"))
    dealt = spread.join(crowded, at, "left").withColumn("_s", F.coalesce("_s", F.lit(1))).withColumn("_h", F.pmod(F.xxhash64("fid"), F.col("_s")))
    dealt = dealt.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)))
    called = dealt.groupBy(*at, F.least("_h", "_t").alias("_i"), F.greatest("_h", "_t").alias("_j")).agg(F.sort_array(F.collect_list(F.struct("fid", "geom"))).alias("_m"))
    ids, roots = F.col("_m.fid"), geo("roots", F.col("_m.geom"), float(within))
    grouped = F.zip_with(ids, F.transform(roots, lambda r: F.get(ids, r)), lambda u, w: F.struct(u.alias("fid"), w.alias("root")))
    found = called.select(F.explode(grouped).alias("_l")).groupBy("_l.fid").agg(F.sort_array(F.collect_set("_l.root")).alias("_r"))
    found = Scratch(layer.sparkSession).keep(found)
    first = F.get("_r", F.lit(0))
    links = found.where(F.size("_r") > 1).select(first.alias("a"), F.explode("_r").alias("b"))
    comps = connected_components(links, "a", "b").select(F.col("v").alias("_f"), "component")
    placed = found.select("fid", first.alias("_f")).join(comps, "_f", "left").select("fid", F.coalesce("component", "_f").alias("component"))
    return layer.select("fid").where(F.col("fid").isNotNull()).distinct().join(placed, "fid", "left").select("fid", F.coalesce("component", "fid").alias("component"))


def overlap_totals(layer: DataFrame, cell: float, least: float) -> DataFrame:
    """(l_cls, r_cls, n, area): unordered pairs that share more than ``least``, counted and summed by their classes in each cell.

    ``layer`` has ``plain`` beside its geometry. The features of a cell are measured in one call, so pairs never leave it; of the cells of a pair the one that
    ``box_pairs`` takes counts it. A cell of more than ``BATCH`` features is cut into slices, and every two slices are a call.
    """
    at = ["_cx", "_cy"]
    spread = _cells(layer.where(F.col("fid").isNotNull()), cell)
    starts = sum(F.when(F.floor(F.col(c) / cell) == F.col(k), v).otherwise(0) for c, k, v in (("x0", "_cx", 1), ("y0", "_cy", 2)))
    crowded = spread.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BATCH).select(*at, F.ceil(F.col("_n") / BATCH).cast("int").alias("_s"))
    crowded = Scratch(layer.sparkSession).keep(crowded)  # its size is known then, and the features need not be shuffled to meet it
    dealt = spread.join(crowded, at, "left").withColumn("_s", F.coalesce("_s", F.lit(1))).withColumn("_h", F.pmod(F.xxhash64("fid"), F.col("_s")).cast("int"))
    dealt = dealt.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)))
    x0, y0, x1, y1 = (F.col(c).cast("double").alias(c) for c in BOX)
    member = F.struct(x0, y0, "fid", x1, y1, "cls", "geom", "plain", starts.alias("_a"), "_h")
    called = dealt.groupBy(*at, F.least("_h", "_t").alias("_i"), F.greatest("_h", "_t").alias("_j")).agg(F.sort_array(F.collect_list(member)).alias("_m"))
    names, found = F.col("_m.cls"), geo("totals", "_m", (F.col("_i") != F.col("_j")).cast("double"), float(least))
    named = F.transform(found, lambda t: F.struct(F.get(names, t["a"]).alias("l_cls"), F.get(names, t["b"]).alias("r_cls"), t["n"].alias("n"), t["area"].alias("area")))
    return called.select(F.explode(named).alias("_t")).select("_t.*")


def dissolve(df: DataFrame, by: list[str], cell: float, geom: str = "geom") -> DataFrame:
    """Union per group in three levels: within small cells, within grid cells, then over the cells, so no task unites everything at once."""
    out = df.select(*by, geom)
    for size in (cell / 8, cell):
        spot = [F.floor(geo(k, geom) / size).alias(f"_c{k}") for k in ("x0", "y0")]
        out = out.groupBy(*by, *spot).agg(geo("union_all", F.collect_list(geom)).alias(geom)).select(*by, geom)
    return out.groupBy(*by).agg(geo("union_all", F.collect_list(geom)).alias(geom))


def subdivide(df: DataFrame, cell: float, geom: str = "geom") -> DataFrame:
    """Cuts each geometry along the grid; every part keeps the attributes. Boxes are renewed."""
    spread = _cells(df, cell).withColumn("_box", F.format_string(
        "POLYGON ((%1$s %2$s, %3$s %2$s, %3$s %4$s, %1$s %4$s, %1$s %2$s))",
        (F.col("_cx") * cell).cast("string"), (F.col("_cy") * cell).cast("string"),
        ((F.col("_cx") + 1) * cell).cast("string"), ((F.col("_cy") + 1) * cell).cast("string"),
    ))
    cut = spread.withColumn(geom, geo("polygons_only", geo("intersection", geom, geo("from_text", "_box")))).drop("_cx", "_cy", "_box")
    return cut.where(F.col(geom).isNotNull()).withColumns({k: geo(k, geom) for k in BOX})
