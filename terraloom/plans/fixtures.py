"""Feature layers derived from the star-schema tables by integer arithmetic, so that coordinates are exact.

Each layer is a source table and column expressions that Spark and ANSI SQL read alike; ``layer`` builds it in
Spark and ``cte`` as text for the SQL side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from terraloom.common import table
from terraloom.functions.kernel import ensure, geo


def _pick(key: str, n: int, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {key} % {n} = {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values) if i < n - 1)
    last = values[n - 1]
    return f"CASE {arms} ELSE " + ("CAST(NULL AS VARCHAR(20))" if last is None else f"'{last}'") + " END"


_K = "CAST(p_partkey AS BIGINT)"
_D = lambda e: f"CAST({e} AS DOUBLE)"
_RECT = {
    "fid": _K,
    "x0": _D(f"({_K} * 7919) % 4000"),
    "y0": _D(f"({_K} * 104729) % 4000"),
    "x1": _D(f"({_K} * 7919) % 4000 + 8 + p_size"),
    "y1": _D(f"({_K} * 104729) % 4000 + 8 + {_K} % 37"),
}
_ATTRS = {
    "attachment": _pick(_K, 6, ["Land", "Fringing", "Isolated", "Oceanic", "", None]),
    "depthcat": _pick(_K, 8, ["Surface", "Intertidal", "Very Shallow", "Shallow", "Deep", "Land", "", None]),
    "featconf": _pick(_K, 5, ["Very Low", "Low", "Medium", "High", None]),
    "typeconf": _pick(_K, 7, ["Very Low", "Low", "Medium", "High", "", None, "Guess"]),
    "edgeacc_m": _pick(_K, 7, ["10", "NA", "", "12.5", None, "200", "50"]),
    "edgesrc": _pick(_K, 3, ["S2 R1", "S2 R2", "Chart"]),
    "rb_type_l3": _pick(_K, 4, ["Platform Coral Reef", "Fringing Coral Reef", "Rocky Reef", "Sand Bank"]),
}
_S, _C, _E = "CAST(s_suppkey AS BIGINT)", "CAST(c_custkey AS BIGINT)", "CAST(event_id AS BIGINT)"
_MOVE = f"(CASE WHEN {_K} % 4 = 0 THEN {_K} % 5 ELSE 0 END)"

LAYERS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "rects": ("part", _RECT | {"cls": f"CASE WHEN {_K} % 3 = 0 THEN 'Rocky Reef' ELSE 'Coral Reef' END"}, None),
    "attrs": ("part", _RECT | _ATTRS | {"cls": f"CASE WHEN {_K} % 3 = 0 THEN 'Rocky Reef' ELSE 'Coral Reef' END"}, None),
    "rects_new": (
        "part",
        {
            "fid": _K,
            "x0": _D(f"({_K} * 7919) % 4000 + {_MOVE}"), "y0": _D(f"({_K} * 104729) % 4000"),
            "x1": _D(f"({_K} * 7919) % 4000 + 8 + p_size + {_MOVE}"), "y1": _D(f"({_K} * 104729) % 4000 + 8 + {_K} % 37"),
            "attachment": _pick(f"({_K} + (CASE WHEN {_K} % 10 = 0 THEN 1 ELSE 0 END))", 6, ["Land", "Fringing", "Isolated", "Oceanic", "", None]),
            "depthcat": _ATTRS["depthcat"],
        },
        f"{_K} % 11 <> 0",
    ),
    "rects_added": (
        "part",
        {
            "fid": f"{_K} + 10000000",
            "x0": _D(f"({_K} * 6101) % 4000"), "y0": _D(f"({_K} * 3571) % 4000"),
            "x1": _D(f"({_K} * 6101) % 4000 + 8 + p_size"), "y1": _D(f"({_K} * 3571) % 4000 + 8 + {_K} % 37"),
            "attachment": _ATTRS["attachment"], "depthcat": _ATTRS["depthcat"],
        },
        f"{_K} % 13 = 0",
    ),
    "refs": (
        "supplier",
        {
            "fid": _S,
            "x0": _D(f"({_S} * 6151) % 4000"), "y0": _D(f"({_S} * 9377) % 4000"),
            "x1": _D(f"({_S} * 6151) % 4000 + 60"), "y1": _D(f"({_S} * 9377) % 4000 + 40 + {_S} % 30"),
            "source": _pick(_S, 4, ["AHS", "KIM", "UNEP", "GA"]),
        },
        None,
    ),
    "tags": (
        "customer",
        {
            "fid": _C,
            "x0": _D(f"({_C} * 7001) % 4000 - 5"), "y0": _D(f"({_C} * 3907) % 4000 - 5"),
            "x1": _D(f"({_C} * 7001) % 4000 + 5"), "y1": _D(f"({_C} * 3907) % 4000 + 5"),
            "source": _pick(_C, 4, ["bath_m", "bath_i", "cht_m", "cht_i"]),
        },
        None,
    ),
    "spots": ("events", {"fid": _E, "x": _D(f"({_E} * 31) % 4000"), "y": _D(f"({_E} * 57) % 4000 + 0.5")}, None),
    "squares": (
        "nation",
        {
            "fid": "CAST(n_nationkey AS BIGINT)", "regionid": "CAST(n_nationkey AS BIGINT)", "regionname": "n_name",
            "x0": _D("(n_nationkey % 5) * 800"), "y0": _D("((n_nationkey - n_nationkey % 5) / 5) * 800"),
            "x1": _D("(n_nationkey % 5) * 800 + 800"), "y1": _D("((n_nationkey - n_nationkey % 5) / 5) * 800 + 800"),
        },
        None,
    ),
    "land": (
        "nation",
        {
            "fid": "CAST(n_nationkey AS BIGINT)",
            "x0": _D("(n_nationkey * 487) % 3900"), "y0": _D("(n_nationkey * 911) % 3900"),
            "x1": _D("(n_nationkey * 487) % 3900 + 90 + n_nationkey"), "y1": _D("(n_nationkey * 911) % 3900 + 70"),
        },
        "n_nationkey % 3 = 0",
    ),
    "flags": (
        "part",
        {"cluster_id": _K}
        | {s: f"{_K} % {p} = 0" for s, p in zip(
            ("src_ahs", "src_kim", "src_unep", "src_ga", "src_bath_m", "src_bath_i", "src_cht_m", "src_cht_i"), (2, 3, 5, 7, 11, 13, 17, 19), strict=True)},
        None,
    ),
}


# Outlines: the box of a layer with a corner taken out, a corner cut off, a hole, or as two parts, by fid; so the box of each is
# known, and all edges run along whole numbers or x + y = constant, so that SQL can count half cells and lattice points.

KIND = "fid % 5"


def _at(x: str, y: str) -> str:
    return f"CAST({x} AS VARCHAR(20)) || ' ' || CAST({y} AS VARCHAR(20))"


def _ring(*pts: tuple[str, str]) -> str:
    return "'(' || " + " || ', ' || ".join(_at(*p) for p in [*pts, pts[0]]) + " || ')'"


_XM, _YM, _CUT, _THIRD = "(x0 + floor((x1 - x0) / 2))", "(y0 + floor((y1 - y0) / 2))", "(least(x1 - x0, y1 - y0) - 1)", "floor((x1 - x0) / 3)"
_RINGS = {
    "corner out": [[[("x0", "y0"), ("x1", "y0"), ("x1", _YM), (_XM, _YM), (_XM, "y1"), ("x0", "y1")]]],
    "corner cut": [[[(f"x0 + {_CUT}", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", f"y0 + {_CUT}")]]],
    "hole": [[[("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")], [("x0 + 2", "y0 + 2"), ("x0 + 2", "y1 - 2"), ("x1 - 2", "y1 - 2"), ("x1 - 2", "y0 + 2")]]],
    "two parts": [
        [[("x0", "y0"), (f"x0 + {_THIRD}", "y0"), (f"x0 + {_THIRD}", "y1"), ("x0", "y1")]],
        [[(f"x1 - {_THIRD}", "y0"), ("x1", "y0"), ("x1", "y1"), (f"x1 - {_THIRD}", "y1")]],
    ],
    "box": [[[("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]]],
}


def _wkt(parts: list) -> str:
    bodies = ["'(' || " + " || ', ' || ".join(_ring(*r) for r in rings) + " || ')'" for rings in parts]
    return f"'POLYGON ' || {bodies[0]}" if len(bodies) == 1 else "'MULTIPOLYGON (' || " + " || ', ' || ".join(bodies) + " || ')'"


WKT = "CASE " + " ".join(f"WHEN {KIND} = {i} THEN {_wkt(parts)}" for i, parts in enumerate(_RINGS.values())) + " END"


def holds(t: str, x: str, y: str) -> str:
    """SQL: the closed outline of the row ``t`` holds (x, y)."""
    c = lambda e: re.sub(r"\b(x0|y0|x1|y1|fid)\b", rf"{t}.\1", e)
    return c(
        f"({x} BETWEEN x0 AND x1 AND {y} BETWEEN y0 AND y1 AND CASE {KIND} WHEN 0 THEN NOT ({x} > {_XM} AND {y} > {_YM}) WHEN 1 THEN ({x} - x0) + ({y} - y0) >= {_CUT} "
        f"WHEN 2 THEN NOT ({x} > x0 + 2 AND {x} < x1 - 2 AND {y} > y0 + 2 AND {y} < y1 - 2) WHEN 3 THEN {x} <= x0 + {_THIRD} OR {x} >= x1 - {_THIRD} ELSE true END)"
    )


for _name, _base in {
    "shapes": "rects", "attr_shapes": "attrs", "new_shapes": "rects_new", "added_shapes": "rects_added", "ref_shapes": "refs", "land_shapes": "land", "tag_shapes": "tags", "zones": "squares",
}.items():
    LAYERS[_name] = (_base, {c: c for c in LAYERS[_base][1]} | {"wkt": WKT}, None)
LAYERS["spots_off"] = ("events", {"fid": _E, "x": _D(f"({_E} * 31) % 4000 + 0.37"), "y": _D(f"({_E} * 57) % 4000 + 0.29")}, None)


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, cols, where = LAYERS[name]
    src = layer(spark, sf_dir, source) if source in LAYERS else table(spark, sf_dir, source)
    src = src.where(where) if where else src
    return src.selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])


def outlines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A layer of outlines with its geometry, dealt to all cores: its source is one small file, what is done with it is not small."""
    ensure(spark)
    dealt = layer(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism, "fid")
    return dealt.withColumn("geom", geo("from_text", "wkt")).drop("wkt")


def cte(*names: str) -> str:
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        source, cols, where = LAYERS[name]
        if source in LAYERS:
            add(source)
        body = ", ".join(f"{e} AS {c}" for c, e in cols.items())
        parts.setdefault(name, f"{name} AS (SELECT {body} FROM {source}{f' WHERE {where}' if where else ''})")

    for name in names:
        add(name)
    return ",\n".join(parts.values())
