from pyspark.sql import functions as F

from terraloom.common import table
from terraloom.plans import polygons
from terraloom.plans.fixtures import layer


def _boxes(df, *cols):
    return [tuple(map(int, r)) if len(r) == 5 else tuple(r) for r in df.select(*cols, "x0", "y0", "x1", "y1").collect()]


def _holds(k, b, x, y):
    """The closed outline of feature ``k`` in the box ``b`` holds (x, y)."""
    x0, y0, x1, y1 = b
    if not (x0 <= x <= x1 and y0 <= y <= y1):
        return False
    return {
        0: not (x > x0 + (x1 - x0) // 2 and y > y0 + (y1 - y0) // 2), 1: x - x0 + y - y0 >= min(x1 - x0, y1 - y0) - 1, 2: not (x0 + 2 < x < x1 - 2 and y0 + 2 < y < y1 - 2),
        3: x <= x0 + (x1 - x0) // 3 or x >= x1 - (x1 - x0) // 3, 4: True,
    }[k % 5]


def _shared(f, b, k, c, steps):
    """Places of a half-cell or lattice pattern that both outlines hold."""
    xs, ys = range(max(b[0], c[0]), min(b[2], c[2]) + 1), range(max(b[1], c[1]), min(b[3], c[3]) + 1)
    return sum(_holds(f, b, x + s, y + s) and _holds(k, c, x + s, y + s) for x in xs for y in ys for s in steps)


def _meet(f, b, k, c):
    return _shared(f, b, k, c, (0,)) > 0


def test_every_customer_is_a_tag(spark, sf):
    assert layer(spark, sf, "tags").count() == table(spark, sf, "customer").count()


def test_status_by_brute_force_over_all_tags(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("k")).collect()
    kinds = ["bath_m", "bath_i", "cht_m", "cht_i"]
    tags = [(kinds[r.k % 4], r.k * 7001 % 4000 - 5, r.k * 3907 % 4000 - 5, r.k * 7001 % 4000 + 5, r.k * 3907 % 4000 + 5) for r in c]
    got = {r.fid: r for r in polygons.source_status(spark, sf).collect()}
    rects = _boxes(layer(spark, sf, "rects"), "fid")
    assert len(rects) == len(got)
    keys = [r.k for r in c]
    for f, *b in rects:
        want = {t[0] for k, t in zip(keys, tags, strict=True) if _meet(f, b, k, t[1:])}
        assert {k for k in kinds if got[f][f"src_{k}"]} == want
    zones = [(z, b) for z, *b in _boxes(layer(spark, sf, "zones"), "fid") if z % 2 == 0]
    missed = {r.source: r.n for r in polygons.missed_references(spark, sf).collect()}
    for kind in kinds:
        alone = [(k, t[1:]) for k, t in zip(keys, tags, strict=True) if t[0] == kind and not any(_meet(f, b, k, t[1:]) for f, *b in rects)]
        assert missed.get(kind, 0) == sum(any(_shared(k, t, z, b, (0.25, 0.75)) for z, b in zones) for k, t in alone)


def test_clip_covers_every_region(spark, sf):
    got = {(r.fid, r.regionid): r.area for r in polygons.clip_area(spark, sf).collect()}
    want = {}
    for f, *b in _boxes(layer(spark, sf, "rects"), "fid"):
        for z, *c in _boxes(layer(spark, sf, "zones"), "fid"):
            if n := _shared(f, b, z, c, (0.25, 0.75)):
                want[f, z] = n / 2
    assert got == want
    assert len({z for _, z in got}) > 12
