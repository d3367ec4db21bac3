import math
import random

from terraloom.operators.proximity import EARTH_M, locate, near_counts, near_pairs


def dist(a, b):
    p, q = math.radians(a[2]), math.radians(b[2])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(min(1, h)))


def test_near_against_brute_force(spark, monkeypatch):
    from terraloom.operators import proximity

    monkeypatch.setattr(proximity, "COLUMN_ROWS", 20)
    monkeypatch.setattr(proximity, "SEGMENT_ROWS", 30)  # so that the dense cells here are cut into blocks
    rnd = random.Random(3)
    pts = []
    for clon, clat in ((179.9995, 10.0), (-179.9995, 10.0), (0.2, 89.9995), (120.0, -89.9995), (140.0, -20.0), (140.0, 0.0)):
        pts += [(len(pts) + i, clon + rnd.uniform(-0.004, 0.004), max(-90.0, min(90.0, clat + rnd.uniform(-0.004, 0.004)))) for i in range(60)]
    pts = [(i, (x + 180) % 360 - 180, y) for i, x, y in pts]
    pts += [(1000, 140.0, -20.0), (1001, 140.0, -20.0), (1002, 140.0, -20.0)]
    rows = [*pts, pts[0], (2000, None, 1.0), (2001, 0.0, 0.0), (2002, 999.0, 1.0), (2003, float("nan"), 1.0), (None, 140.0, -20.0)]
    df = spark.createDataFrame(rows, "id bigint, lon double, lat double")
    got = sorted((r.key_a, r.key_b) for r in near_pairs(df, "id", "lon", "lat", 250.0).collect())
    want = sorted((min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(pts) for b in pts[:i] if dist(a, b) <= 250)
    assert got == want and len(got) == len(set(got))
    assert near_pairs(df.limit(0), "id", "lon", "lat", 250.0).count() == 0


def test_locate_against_crossing_number(spark):
    rnd = random.Random(5)
    star = [(10 + (4 if k % 2 else 9) * math.cos(k * math.pi / 9), 10 + (4 if k % 2 else 9) * math.sin(k * math.pi / 9)) for k in range(18)]
    hole = [(9, 9), (11, 9), (11, 11), (9, 11)]
    box = [(0, 0), (8, 0), (8, 12), (0, 12)]
    text = lambda rings: ", ".join("(" + ", ".join(f"{x} {y}" for x, y in [*r, r[0]]) + ")" for r in rings)
    regions = [(1, f"POLYGON ({text([star, hole])})"), (1, f"POLYGON ({text([star, hole])})"), (2, f"MULTIPOLYGON (({text([box])}), ({text([[(30, 30), (31, 30), (31, 31)]])}))"), (3, None), (4, "")]
    pts = [(i, rnd.uniform(-1, 33), rnd.uniform(-1, 33)) for i in range(3000)] + [(9001, None, 2.0), (9002, 0.0, 0.0)]

    def odd(x, y, rings):
        c = 0
        for r in rings:
            for (x1, y1), (x2, y2) in zip(r, [*r[1:], r[0]], strict=True):
                if (x1 <= x) != (x2 <= x) and y1 + (x - x1) / (x2 - x1) * (y2 - y1) <= y:
                    c += 1
        return c % 2 == 1

    p = spark.createDataFrame([*pts, pts[0]], "id bigint, lon double, lat double")
    g = spark.createDataFrame(regions, "regionid int, wkt string")
    got = sorted((r.key_a, r.regionid) for r in locate(p, "id", "lon", "lat", g, "regionid", "wkt").collect())
    want = [(i, 1) for i, x, y in pts[:3000] if odd(x, y, [star, hole])] + [(i, 2) for i, x, y in pts[:3000] if odd(x, y, [box]) or odd(x, y, [[(30, 30), (31, 30), (31, 31)]])]
    assert got == sorted(want)
    assert locate(p.limit(0), "id", "lon", "lat", g, "regionid", "wkt").count() == 0
    assert locate(p, "id", "lon", "lat", g.limit(0), "regionid", "wkt").count() == 0


def test_fine_boundaries_are_cut_into_strips(spark):
    rnd = random.Random(8)
    radii = [20 + rnd.uniform(-3, 3) for _ in range(1800)]
    coast = [(50 + r * math.cos(k * math.pi / 900), r * math.sin(k * math.pi / 900)) for k, r in enumerate(radii)]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*coast, coast[0]]) + "))"
    pts = [(i, rnd.uniform(25, 75), rnd.uniform(-25, 25)) for i in range(1500)]

    def inside(x, y):
        n = 0
        for (x1, y1), (x2, y2) in zip(coast, [*coast[1:], coast[0]], strict=True):
            if (x1 <= x) != (x2 <= x):
                n += y1 + (x - x1) / (x2 - x1) * (y2 - y1) <= y
        return n % 2 == 1

    p = spark.createDataFrame(pts, "id bigint, lon double, lat double")
    g = spark.createDataFrame([(7, text)], "regionid int, wkt string")
    want = sorted(i for i, x, y in pts if inside(x, y))
    for cell, most in ((0.5, 64), (5.0, 4), (200.0, 8)):
        assert sorted(r.key_a for r in locate(p, "id", "lon", "lat", g, "regionid", "wkt", cell, most).collect()) == want


def test_overlapping_parts_and_differing_copies(spark):
    box = lambda a, b: f"(({a} {a}, {b} {a}, {b} {b}, {a} {b}, {a} {a}))"
    g = [(1, f"MULTIPOLYGON ({box(0, 4)}, {box(2, 6)})"), (2, f"POLYGON {box(10, 12)}"), (2, f"POLYGON {box(11, 14)}"), (None, f"POLYGON {box(0, 9)}")]
    pts = [(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 5.0, 5.0), (4, 5.0, 1.0), (5, 11.5, 11.5), (6, 13.0, 13.0), (7, 10.5, 13.0)]
    p, r = spark.createDataFrame(pts, "id bigint, lon double, lat double"), spark.createDataFrame(g, "regionid int, wkt string")
    got = sorted(tuple(x) for x in locate(p, "id", "lon", "lat", r, "regionid", "wkt").collect())
    assert got == [(1, 1), (2, 1), (3, 1), (5, 2), (6, 2)]


def test_counts_by_place(spark):
    rows = [(5, 100.0, 0.0), (2, 100.0, 0.0), (9, 100.001, 0.0), (4, 100.0, 5.0), (4, 100.0, 4.0)]
    df = spark.createDataFrame(rows, "id bigint, lon double, lat double")
    got = sorted(tuple(r) for r in near_counts(df, "id", "lon", "lat", 250.0).collect())
    assert got == [(2, 2, 1), (4, 4, 0), (5, 2, 1), (9, 9, 1)]
