"""Scalar functions over feature attributes and coordinates, as plain Column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: GRS80 / EPSG:3112 Lambert conformal conic, from the public registry.
GRS80_A, GRS80_F = 6378137.0, 1 / 298.257222101
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
LCC_3112 = {"lat1": -18.0, "lat2": -36.0, "lat0": 0.0, "lon0": 134.0, "x0": 0.0, "y0": 0.0}
METRES_PER_DEGREE = 111_000.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: Column | str, sep: str = ";") -> Column:
    """Trimmed, non-blank items of a separated list; null gives null."""
    return F.filter(F.transform(F.split(col(c), sep), lambda x: F.trim(x)), lambda x: x != "")


def blank_to_null(c: Column | str) -> Column:
    t = F.trim(col(c))
    return F.when(t != "", t)


def int_or_null(c: Column | str) -> Column:
    """Text to a whole number; NA, blanks and other text become null; fractions are cut off."""
    n = F.trim(col(c)).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < 2147483648.0), n.cast("int"))


def number_or_null(c: Column | str) -> Column:
    n = F.trim(col(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(n), n)


def half_even(c: Column, digits: int) -> Column:
    """Rounds ties to even. Noise in the last bits is rounded off first, so that 3.3499999999999996 is the tie 3.35."""
    return F.bround(F.round(c, digits + 8), digits)


def effective_width(area_m2: Column) -> Column:
    """Diameter of the circle with this area."""
    return 2 * F.sqrt(area_m2 / F.pi())


#: Size classes of clusters by effective width in metres.
SIZE_CLASSES = ((100.0, "Very small"), (300.0, "Small"), (1000.0, "Medium"), (3000.0, "Large"))


def size_class(width_m: Column) -> Column:
    """Half-open classes; anything else, null and negative widths too, falls through to Very large as below 0."""
    out = F.lit("Very large")
    for top, name in reversed(SIZE_CLASSES):
        low = {"Very small": 0.0, "Small": 100.0, "Medium": 300.0, "Large": 1000.0}[name]
        out = F.when((width_m >= low) & (width_m < top), name).otherwise(out)
    return out


def area_class(area_km2: Column) -> Column:
    return F.when(area_km2 < 0.1, "small").when(area_km2 <= 1.0, "medium").when(area_km2 > 1.0, "large")


def large_small(area_km2: Column, large: float = 0.01) -> Column:
    """Large above ``large``, else Small, null and NaN too."""
    return F.when((area_km2 > large) & ~F.isnan(area_km2), "Large").otherwise("Small")


def edge_checks(edge_m: Column, width_m: Column) -> dict[str, Column]:
    """The checks of accuracy against width: narrower than 10 m, accuracy above the width, above half of it, below 1 % of it."""
    share = edge_m / F.when(width_m > 0, width_m)
    return {"narrow": width_m < 10, "over_width": share > 1, "over_half": share > 0.5, "under_1_percent": share < 0.01}


def safe_ratio(n: Column, d: Column, scale: float = 100.0) -> Column:
    """``scale * n / d``, 0 where the denominator is 0."""
    return F.when(d > 0, n / d * scale).otherwise(F.lit(0.0))


def edge_width_percent(edge_m: Column, width_m: Column) -> Column:
    return F.when(width_m > 0, (edge_m / width_m * 100).cast("int"))


def metres_to_degrees(m: Column | float) -> Column:
    return (F.lit(m) if isinstance(m, int | float) else m) / METRES_PER_DEGREE


def clamp_low(c: Column, low: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True if any pair differs; NaN, null and null count as equal to each other."""
    parts = [~a.eqNullSafe(b) for a, b in pairs]
    return reduce(lambda x, y: x | y, parts)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def pair_key(a: Column, b: Column, sep: str = " | ") -> Column:
    return F.concat_ws(sep, F.array_sort(F.array(a, b)))


def any_flag(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in cols])


# Rings are arrays of struct<x, y>, closed.


def ring_area2(ring: Column) -> Column:
    """Twice the signed area: positive for counter-clockwise rings."""
    n = F.size(ring)
    legs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(F.element_at(ring, i).alias("p"), F.element_at(ring, i + 1).alias("q")))
    cross = lambda a, e: a + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    return F.when(n > 2, F.aggregate(legs, F.lit(0.0), cross)).otherwise(0.0)


def ring_length(ring: Column) -> Column:
    n = F.size(ring)
    legs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(F.element_at(ring, i).alias("p"), F.element_at(ring, i + 1).alias("q")))
    add = lambda a, e: a + F.hypot(e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"])
    return F.when(n > 1, F.aggregate(legs, F.lit(0.0), add)).otherwise(0.0)


def oriented(ring: Column, ccw: bool = True) -> Column:
    turn = ring_area2(ring) < 0 if ccw else ring_area2(ring) > 0
    return F.when(turn, F.reverse(ring)).otherwise(ring)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))


def ring_wkt(ring: Column) -> Column:
    pts = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(pts, ", "), F.lit("))"))


def rings_equal(a: Column, b: Column, tol: float) -> Column:
    """Same number of vertices in the same order, each at most ``tol`` off in x and y."""
    near = lambda p, q: (F.abs(p["x"] - q["x"]) <= tol) & (F.abs(p["y"] - q["y"]) <= tol)
    return (F.size(a) == F.size(b)) & F.forall(F.zip_with(a, b, near), lambda ok: ok)


def point_on_segment(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Nearest point of a segment to (px, py) as struct<x, y, d>."""
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    t = F.when(len2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / len2))).otherwise(0.0)
    x, y = x1 + t * dx, y1 + t * dy
    return F.struct(x.alias("x"), y.alias("y"), F.hypot(px - x, py - y).alias("d"))


# Projections


def mercator_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """EPSG:3857 metres to degrees."""
    return F.degrees(x / WGS84_A), F.degrees(2 * F.atan(F.exp(y / WGS84_A)) - math.pi / 2)


def lonlat_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * WGS84_A, F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * WGS84_A


def lcc_constants() -> tuple[float, float, float, float]:
    e = math.sqrt(GRS80_F * (2 - GRS80_F))

    def m(lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (e * math.sin(lat)) ** 2)

    def t(lat: float) -> float:
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    a, b, o = (math.radians(LCC_3112[k]) for k in ("lat1", "lat2", "lat0"))
    n = (math.log(m(a)) - math.log(m(b))) / (math.log(t(a)) - math.log(t(b)))
    f = m(a) / (n * t(a) ** n)
    return e, n, f, GRS80_A * f * t(o) ** n


def lonlat_to_3112(lon: Column, lat: Column) -> tuple[Column, Column]:
    """GDA94 degrees to the national Lambert grid (EPSG:3112)."""
    e, n, f, rho0 = lcc_constants()
    phi = F.radians(lat)
    s = e * F.sin(phi)
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    rho, theta = GRS80_A * f * F.pow(t, F.lit(n)), n * F.radians(lon - LCC_3112["lon0"])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def lonlat_from_3112(x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
    e, n, f, rho0 = lcc_constants()
    sign = math.copysign(1.0, n)
    rho = sign * F.hypot(x, rho0 - y)
    theta = F.atan2(sign * x, sign * (rho0 - y))
    t = F.pow(rho / (GRS80_A * f), F.lit(1 / n))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = e * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))
    return F.degrees(theta / n) + LCC_3112["lon0"], F.degrees(phi)


def geodesic_metres(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Length of the shortest line on the WGS-84 ellipsoid (Vincenty's inverse series); NaN where it doesn't settle."""
    a, f = WGS84_A, WGS84_F
    b = a * (1 - f)
    u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
    ell = np.radians((lon2 - lon1 + 180) % 360 - 180)
    lam = ell.copy()
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(200):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sin_al = np.where(ss == 0, 0.0, cu1 * cu2 * sl / np.where(ss == 0, 1, ss))
            c2 = 1 - sin_al**2
            c2m = np.where(c2 > 0, cs - 2 * su1 * su2 / np.where(c2 > 0, c2, 1), 0.0)
            c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
            new = ell + (1 - c) * f * sin_al * (sigma + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
            step, lam = np.abs(new - lam), new
            if not np.nanmax(step, initial=0.0) > 1e-12:
                break
        uu = c2 * (a * a - b * b) / (b * b)
        big_a = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
        big_b = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
        ds = big_b * ss * (c2m + big_b / 4 * (cs * (2 * c2m**2 - 1) - big_b / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3)))
        out = b * big_a * (sigma - ds)
    return np.where(step > 1e-9, np.nan, out)


@F.pandas_udf(T.DoubleType())
def geodesic(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Metres between two positions on WGS-84; null where one is missing."""
    out = pd.Series(geodesic_metres(*(s.to_numpy(float, na_value=np.nan) for s in (lat1, lon1, lat2, lon2))))
    return out.where(out.notna(), None)


def hashed_uniform(seed: int, *keys: Column | str) -> Column:
    """Number in [0, 1) fixed by seed and keys, so that a draw doesn't depend on partitioning."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[col(k) for k in keys]), 11) * F.lit(2.0**-53)


def hashed_normal(seed: int, *keys: Column | str) -> Column:
    u, v = hashed_uniform(seed, *keys), hashed_uniform(seed + 7919, *keys)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)
