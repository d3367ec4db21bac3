"""Points near other points, and the regions that hold them, both by decomposition into ordered slabs.

``locate`` builds the trapezoidal decomposition of the regions' boundaries. The plane is cut into strips of
longitude; a strip that the boundary of one region part crosses with more than ``MOST_VERTICES`` vertices is halved
until none does. Within a strip the vertices of a part cut it into slabs, in each of which the edges do not
cross and are kept in order from south to north. Strips, not regions, are what tasks work on, so a long coastline is
spread over many. A point meets each part that crosses its strip once; its slab is found by binary search of the
cuts and its place among the slab's edges by another one; an odd number of edges below it means that it is inside.

``near_places`` takes the search circle of each place as a region. Its boundary is cut by parallels as far apart as
the radius into slabs, in each of which it has a western and an eastern edge. Within a slab all circles are given the
width of the widest, so the order of the western edges is that of the centres, and those a place lies between are one
run, found by two binary searches; the exact distance decides. A circle is laid into its own slab and the one north of
it only, so a pair is met once. Slabs are dealt to tasks in segments; a segment with more than ``SEGMENT_ROWS`` places
is dealt by columns as wide as the radius, and a column with more than ``COLUMN_ROWS`` in salted blocks.

Points at one place are joined as one, by the smallest id of the place; ``near_pairs`` puts the other ids back.

Defined results: rows without a usable position (null, NaN, 0/0, off the globe) match nothing; an id counts once, at
the least of its positions; null ids match nothing; a hole is outside its part, and parts of a region that overlap are
inside; copies of a region that differ count as parts of it. A point on an edge belongs to the trapezoid above a lower
or left edge. Regions with null or blank text hold nothing. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.common import Scratch, position_ok

EARTH_M = 6_371_008.8
SEGMENT_ROWS, COLUMN_ROWS, SEGMENT = 16_384, 2_000, 64
MOST_VERTICES = 64
#: Candidates that a task holds at once.
AT_ONCE = 1 << 20


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = EARTH_M) -> Column:
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _metres(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    a1, a2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def places(points: DataFrame, id_col: str, lon: str, lat: str) -> tuple[DataFrame, DataFrame]:
    """(members, places): (id, x, y) of every usable id, and (x, y, rep, n) of every place, ``rep`` its smallest id."""
    usable = points.where(position_ok(F.col(lon), F.col(lat)) & F.col(id_col).isNotNull())
    home = usable.select(F.col(id_col).alias("id"), F.col(lon).alias("x"), F.col(lat).alias("y"))
    home = home.groupBy("id").agg(F.min(F.struct("x", "y")).alias("p")).select("id", "p.x", "p.y")
    home = Scratch(points.sparkSession).keep(home)
    return home, home.groupBy("x", "y").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))


def _sweep(metres: float):
    """Meets the places and circles of whole (band, cell, block) groups, which come sorted by group and longitude."""

    def pairs(g: np.ndarray, t: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        circle = t["circle"]
        own = {k: v[~circle] for k, v in t.items()}
        around = {k: v[circle] for k, v in t.items()}
        # One axis for all groups, too coarse by less than the margin; the exact distance decides later.
        axis, gap, margin = g * 2000.0, own["half"] * (1 + 1e-9), 1e-6
        at, line = own["x"] + axis[~circle], around["x"] + axis[circle]
        lo, hi = np.searchsorted(line, at - gap - margin, "left"), np.searchsorted(line, at + gap + margin, "right")
        upto = np.concatenate([[0], np.cumsum(hi - lo)])
        start = 0
        while start < len(at):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] + AT_ONCE, "right")) - 1)
            n = (hi - lo)[start:end]
            p = np.repeat(np.arange(start, end), n)
            q = np.arange(len(p)) - np.repeat(upto[start:end] - upto[start], n) + lo[p]
            same = own["band"][p] == around["home"][q]
            px, qx = own["x"][p], around["real"][q]
            first = (qx < px) | ((qx == px) & (around["y"][q] < own["y"][p]))
            keep = np.flatnonzero(~same | first)
            p, q = p[keep], q[keep]
            d = _metres(own["x"][p], own["y"][p], around["real"][q], around["y"][q])
            keep = np.flatnonzero(d <= metres)
            a, b = own["rep"][p[keep]], around["rep"][q[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(d[keep])], ["rep_a", "rep_b", "metres"])
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def whole(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            t = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            new = np.ones(len(t["x"]), bool)
            new[1:] = (t["band"][1:] != t["band"][:-1]) | (t["cell"][1:] != t["cell"][:-1]) | (t["block"][1:] != t["block"][:-1])
            yield from pairs(np.cumsum(new), t)

        for b in batches:
            if not b.num_rows:
                continue
            t = {k: b.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(b.schema.names)}
            last = [t[k][-1] for k in ("band", "cell", "block")]
            inside = (t["band"] == last[0]) & (t["cell"] == last[1]) & (t["block"] == last[2])
            cut = int(np.argmax(inside))
            if held and cut == 0 and all(held[-1][k][-1] == v for k, v in zip(("band", "cell", "block"), last, strict=True)):
                held.append(t)
                continue
            held.append({k: v[:cut] for k, v in t.items()})
            yield from whole(held)
            held = [{k: v[cut:] for k, v in t.items()}]
        if held:
            yield from whole(held)

    return run


def near_places(spots: DataFrame, metres: float) -> DataFrame:
    """(rep_a, rep_b, metres) of all pairs of places (x, y, rep) at most ``metres`` apart on the sphere, smaller rep first."""
    scratch = Scratch(spots.sparkSession)
    step = math.degrees(metres / EARTH_M) * (1 + 1e-9)
    reach = math.sin(math.radians(min(step, 90.0)))

    def edge(band: Column) -> Column:
        """Latitude farthest from the equator of a slab and its southern neighbour, from which circles reach into it."""
        return F.greatest(F.abs((band - 1) * step), F.abs((band + 1) * step))

    def grid(df: DataFrame) -> DataFrame:
        """Half the width of the widest circle in the slab, and the number of the slab's columns, each at least as wide as the radius."""
        far = edge(F.col("band"))
        half = F.when(far + step >= 90.0, F.lit(400.0)).otherwise(F.degrees(F.asin(F.least(reach / F.cos(F.radians(far)), F.lit(1.0)))) * (1 + 1e-9))
        return df.withColumn("half", half).withColumn("n", F.greatest(F.floor(360.0 / F.col("half")), F.lit(1)).cast("int"))

    band = F.floor(F.col("y") / step).cast("int")
    column = lambda x: F.greatest(F.least(F.floor((x + 180.0) / 360.0 * F.col("n")).cast("int"), F.col("n") - 1), F.lit(0))
    home = grid(spots.select("x", "y", "rep").withColumn("band", band)).withColumn("col", column(F.col("x")))
    # Read from several places below, so it is written rather than made again.
    home = scratch.keep(home)
    seg = F.floor(F.col("col") / SEGMENT).cast("int")
    full = home.groupBy("band", seg.alias("seg")).count().where(F.col("count") > SEGMENT_ROWS).select("band", "seg", F.lit(True).alias("hot"))
    full = scratch.keep(full)
    own = home.withColumns({"circle": F.lit(False), "real": F.col("x"), "home": F.col("band"), "seg": seg})
    # A circle over the antimeridian is laid on either side of it; one around a pole covers its whole slab anyhow.
    lay = home.select("x", "y", "rep", F.col("band").alias("home"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    lay = grid(lay.withColumn("real", F.col("x")))
    round_ = F.col("half") < 180.0
    east, west = F.when(round_ & (F.col("x") - F.col("half") < -180.0), F.col("x") + 360.0), F.when(round_ & (F.col("x") + F.col("half") > 180.0), F.col("x") - 360.0)
    lay = lay.withColumn("x", F.explode(F.filter(F.array("x", east, west), lambda v: v.isNotNull()))).withColumn("circle", F.lit(True))
    lay = lay.withColumns({"c0": column(F.col("x") - F.col("half")), "c1": column(F.col("x") + F.col("half"))})
    lay = lay.withColumn("seg", F.explode(F.sequence(F.floor(F.col("c0") / SEGMENT).cast("int"), F.floor(F.col("c1") / SEGMENT).cast("int"))))
    own, lay = own.withColumns({"cell": -1 - F.col("seg"), "block": F.lit(0)}), lay.withColumns({"cell": -1 - F.col("seg"), "block": F.lit(0)})
    if not full.isEmpty():
        crowd = home.join(full.withColumnRenamed("seg", "s"), (home["band"] == full["band"]) & (F.floor(home["col"] / SEGMENT) == F.col("s")))
        crowd = crowd.groupBy(home["band"], home["col"].alias("cell")).agg(F.ceil(F.count(F.lit(1)) / COLUMN_ROWS).cast("int").alias("blocks"))
        crowd = scratch.keep(crowd)
        own = own.join(full, ["band", "seg"], "left").withColumn("cell", F.when(F.col("hot"), F.col("col")).otherwise(F.col("cell")))
        own = own.join(crowd, ["band", "cell"], "left").withColumn("block", F.pmod(F.xxhash64("x", "y"), F.coalesce("blocks", F.lit(1))).cast("int"))
        inside = F.sequence(F.greatest("c0", F.col("seg") * SEGMENT), F.least("c1", F.col("seg") * SEGMENT + SEGMENT - 1))
        lay = lay.join(full, ["band", "seg"], "left").withColumn("cell", F.explode(F.when(F.col("hot"), inside).otherwise(F.array("cell"))))
        lay = lay.join(crowd, ["band", "cell"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    cols = ["band", "cell", "block", "x", "y", "rep", "circle", "real", "home", "half"]
    every = own.select(*cols).unionByName(lay.select(*cols)).repartition("band", "cell", "block").sortWithinPartitions("band", "cell", "block", "x")
    return every.mapInArrow(_sweep(metres), "rep_a bigint, rep_b bigint, metres double")


def near_pairs(points: DataFrame, id_col: str, lon: str, lat: str, metres: float) -> DataFrame:
    """(key_a, key_b, metres) of all pairs of ids at most ``metres`` apart on the sphere, smaller id first."""
    home, spots = places(points, id_col, lon, lat)
    shared = home.join(spots.where("n > 1"), ["x", "y"]).select("rep", "id")
    met = near_places(spots, metres)
    for side in ("a", "b"):
        more = shared.select(F.col("rep").alias(f"rep_{side}"), F.col("id").alias(f"id_{side}"))
        met = met.join(more, f"rep_{side}", "left").withColumn(f"id_{side}", F.coalesce(f"id_{side}", f"rep_{side}"))
    across = met.select(F.least("id_a", "id_b").alias("key_a"), F.greatest("id_a", "id_b").alias("key_b"), "metres")
    one, other = shared.withColumnRenamed("id", "key_a"), shared.withColumnRenamed("id", "key_b")
    at_one_place = one.join(other, "rep").where(F.col("key_a") < F.col("key_b")).select("key_a", "key_b", F.lit(0.0).alias("metres"))
    return across.unionByName(at_one_place)


def near_counts(points: DataFrame, id_col: str, lon: str, lat: str, metres: float) -> DataFrame:
    """(id, place, n_near): each id with the representative of its place and the number of other places within ``metres``."""
    home, spots = places(points, id_col, lon, lat)
    met = near_places(spots, metres)
    ends = met.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_near"))
    named = spots.select("x", "y", "rep").join(ends, "rep", "left").fillna(0, ["n_near"])
    return home.join(named, ["x", "y"]).select("id", F.col("rep").alias("place"), "n_near")


_PART = re.compile(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)")
_RING = re.compile(r"\(([^()]*)\)")


def part_edges(wkt: str | None) -> list[tuple[int, float, float, float, float]]:
    """(part, x1, y1, x2, y2) of the edges of a polygon text, west end first, without those that run north and south."""
    out = []
    for no, part in enumerate(_PART.findall(wkt or "")):
        for body in _RING.findall(part):
            pts = [tuple(float(v) for v in p.split()[:2]) for p in body.split(",") if p.strip()]
            for (x1, y1), (x2, y2) in zip(pts, [*pts[1:], *pts[:1]], strict=True):
                if x1 != x2:
                    out.append((no, x1, y1, x2, y2) if x1 < x2 else (no, x2, y2, x1, y1))
    return out


def boundary_edges(regions: DataFrame, id_col: str, wkt_col: str) -> DataFrame:
    """(regionid, part, x1, y1, x2, y2) of all boundaries."""
    src = regions.select(F.col(id_col).cast("bigint").alias("regionid"), F.col(wkt_col).alias("wkt"))
    src = src.where(F.col("regionid").isNotNull() & F.col("wkt").isNotNull()).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rid, wkt in zip(b.regionid, b.wkt, strict=True):
                copy = hashlib.md5(wkt.encode()).hexdigest()
                rows = [(rid, f"{no} of {copy}", *e) for no, *e in part_edges(wkt)]
                yield pd.DataFrame(rows, columns=["regionid", "part", "x1", "y1", "x2", "y2"])

    return src.mapInPandas(run, "regionid bigint, part string, x1 double, y1 double, x2 double, y2 double")


def _slabs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The slabs of one part in one strip: cuts from west to east, and the edges of each slab from south to north."""
    e = rows[["x1", "y1", "x2", "y2"]].to_numpy()
    lo, hi = float(key[2]), float(key[3])
    cuts = np.unique(np.clip(np.concatenate([e[:, 0], e[:, 2]]), lo, hi))
    starts, flat = [0], []
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        on = e[(e[:, 0] <= a) & (e[:, 2] >= z)]
        mid = (a + z) / 2
        height = on[:, 1] + (on[:, 3] - on[:, 1]) * ((mid - on[:, 0]) / (on[:, 2] - on[:, 0]))
        flat += [dict(zip(("x1", "y1", "x2", "y2"), map(float, r), strict=True)) for r in on[np.argsort(height, kind="stable")]]
        starts.append(len(flat))
    y0, y1 = float(e[:, [1, 3]].min()), float(e[:, [1, 3]].max())
    return pd.DataFrame(
        [(int(key[0]), float(key[2]), cuts.tolist(), starts, flat, y0, y1)], columns=["regionid", "strip", "cuts", "starts", "edges", "y_lo", "y_hi"]
    )


_SLABS = "regionid bigint, strip double, cuts array<double>, starts array<int>, edges array<struct<x1: double, y1: double, x2: double, y2: double>>, y_lo double, y_hi double"


def halvings(edges: DataFrame, cell: float, most: int = MOST_VERTICES) -> DataFrame:
    """(cell, depth): how often strips must be halved; strips that need none are left out, so this is as long as boundaries are fine."""
    per = edges.groupBy("regionid", "part", F.floor(F.col("x1") / cell).cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("cell").agg(F.max("n").alias("n")).where(F.col("n") > most)
    return per.select("cell", F.least(F.ceil(F.log2(F.col("n") / most)), F.lit(16)).cast("int").alias("depth"))


def _in_strips(df: DataFrame, deep: DataFrame, x0: str, x1: str, cell: float) -> DataFrame:
    """Adds ``strip`` and ``strip_end``, the ends of each strip that [x0, x1] meets."""
    df = df.withColumn("cell", F.explode(F.sequence(F.floor(F.col(x0) / cell).cast("int"), F.floor(F.col(x1) / cell).cast("int"))))
    df = df.join(deep, "cell", "left").withColumn("_n", F.pow(F.lit(2), F.coalesce("depth", F.lit(0))).cast("int"))
    part = lambda x: F.greatest(F.least(F.floor((F.col(x) / cell - F.col("cell")) * F.col("_n")).cast("int"), F.col("_n") - 1), F.lit(0))
    df = df.withColumn("_s", F.explode(F.sequence(part(x0), part(x1))) if x0 != x1 else part(x0))
    strip = lambda more: (F.col("cell") + (F.col("_s") + more) / F.col("_n")) * cell
    return df.withColumns({"strip": strip(0), "strip_end": strip(1)}).drop("cell", "depth", "_n", "_s")


def trapezoids(edges: DataFrame, deep: DataFrame, cell: float = 0.5) -> DataFrame:
    """The slabs of every region part by strip: (regionid, strip, cuts, starts, edges, y_lo, y_hi)."""
    laid = _in_strips(edges, deep, "x1", "x2", cell)
    return laid.groupBy("regionid", "part", "strip", "strip_end").applyInPandas(_slabs, _SLABS)


def _search(n: Column, size: Column, yes) -> Column:
    """Number of leading entries for which ``yes`` (of their index) holds, by binary search; ``size`` bounds the rounds."""

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        go = s["lo"] < s["hi"]
        ok = go & yes(mid)
        return F.struct(F.when(ok, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(go & ~ok, mid).otherwise(s["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(size + F.lit(1))).cast("int"))
    return F.aggregate(rounds, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step, lambda s: s["lo"])


def edges_below(edges: Column, start: Column, end: Column, x: Column, y: Column) -> Column:
    """Number of the edges from ``start`` to ``end`` (without it) at or below (x, y), by binary search in their order."""

    def below(k: Column) -> Column:
        e = F.get(edges, start + k)
        return (e["x2"] - e["x1"]) * (y - e["y1"]) >= (e["y2"] - e["y1"]) * (x - e["x1"])

    return _search(end - start, end - start, below)


def locate(
    points: DataFrame, id_col: str, lon: str, lat: str, regions: DataFrame, region_id: str, wkt_col: str, cell: float = 0.5, most: int = MOST_VERTICES
) -> DataFrame:
    """(key_a, regionid): each point id with every region that holds it."""
    scratch = Scratch(points.sparkSession)
    edges = scratch.keep(boundary_edges(regions, region_id, wkt_col))
    deep = halvings(edges, cell, most)
    pts = points.where(position_ok(F.col(lon), F.col(lat)) & F.col(id_col).isNotNull())
    pts = _in_strips(pts.select(F.col(id_col).alias("key_a"), F.col(lon).alias("x"), F.col(lat).alias("y")), deep, "x", "x", cell).drop("strip_end")
    # A strip that holds a large share of the points is split by AQE; the slab side has one row for each part there.
    met = pts.join(trapezoids(edges, deep, cell), "strip")
    met = met.where((F.col("y") >= F.col("y_lo")) & (F.col("y") <= F.col("y_hi")) & (F.col("x") >= F.element_at("cuts", 1)) & (F.col("x") < F.element_at("cuts", -1)))
    slab = _search(F.size("cuts"), F.size("cuts"), lambda k: F.get(F.col("cuts"), k) <= F.col("x"))  # from 1
    # Each search is bound by a lambda, so that it runs once and not at every step of the next.
    ends = F.transform(F.array(slab), lambda k: F.struct(F.get(F.col("starts"), k - 1).alias("a"), F.get(F.col("starts"), k).alias("b")))
    below = F.transform(ends, lambda r: edges_below(F.col("edges"), r["a"], r["b"], F.col("x"), F.col("y")))
    inside = F.get(below, F.lit(0)) % 2 == 1
    return met.where(inside).select("key_a", "regionid").distinct()
