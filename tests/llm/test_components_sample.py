import random
from collections import Counter

from terraloom.common import name_key
from terraloom.llm.components import groups
from terraloom.llm.proportional import ProportionalSample


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return find, parent


def test_groups_against_union_find(spark):
    rnd = random.Random(1)
    pairs = [(f"C_{i:04d}", f"C_{i + 1:04d}") for i in range(300)] + [("HUB", f"S_{i}") for i in range(200)]
    pairs += [(f"R_{rnd.randrange(200)}", f"R_{rnd.randrange(200)}") for _ in range(120)]
    rows = [(f" {a.lower()}" if rnd.random() < 0.3 else a, b, "Touches " if rnd.random() < 0.5 else "intersects", 0) for a, b in pairs]
    rows += [(b, a, r, 0) for a, b, r, _ in rows[::7]]
    rows += [("LONE", None, "touches", 0), (None, "  ", "touches", 0), ("SELF", "self", "touches", 0), ("C_0000", "FAR", "disjoint", 0), ("FAR2", "HUB", None, 0)]
    df = spark.createDataFrame(rows, "left_id string, right_id string, relation string, a int")
    got = {r.debugid: r.group_id for r in groups(df, "left_id", "right_id", name_key("relation").isin("touches", "intersects")).collect()}
    find, parent = union_find(pairs)
    want = {x: find(x) for x in list(parent)} | {x: x for x in ("LONE", "SELF", "FAR", "FAR2")}
    least = {}
    for x, g in want.items():
        least[g] = min(least.get(g, x), x)
    assert got == {x: least[g] for x, g in want.items()}
    salted = groups(df, "left_id", "right_id", name_key("relation").isin("touches", "intersects"), hub_links=20, links_per_task=30)
    assert {r.debugid: r.group_id for r in salted.collect()} == got
    on = name_key("relation") == "touches"
    assert groups(df.limit(0), "left_id", "right_id", on).count() == 0
    assert {r.debugid for r in groups(df.where("relation = 'disjoint'"), "left_id", "right_id", on).collect()} == {"C_0000", "FAR"}


def test_sample_is_exact_and_reports_deficits(spark):
    rows = [(i, " Big  Reef", "X") for i in range(5000)] + [(10_000 + i, "small", "x ") for i in range(3)] + [(20_000 + i, "Mid", "Y") for i in range(40)]
    rows += rows[:100] + [(None, "Big Reef", "X"), (1, None, "X"), (2, "elsewhere", "X")]
    cand = spark.createDataFrame(rows, "fid bigint, regionname string, rb_type_l3 string")
    goal = [("Big Reef", "X", 5000, 5, 800), ("Small", "X", 100, 5, 800), ("Mid", "Y", 500, 5, 800), ("None here", "Z", None, 5, 800), ("Odd", "Z", 1, 0, 800)]
    targets = spark.createDataFrame(goal, "regionname string, rb_type_l3 string, target_bp int, min_rows int, sample_size int")
    s = ProportionalSample(cand, targets, ["regionname", "rb_type_l3"], "fid")
    drawn = s.rows.collect()
    assert Counter(r.regionname for r in drawn) == {"Big Reef": 400, "Small": 3, "Mid": 40}
    assert len({(r.fid, r.regionname) for r in drawn}) == len(drawn)
    assert {r.regionname: r.reached for r in s.report.collect()}["Big Reef"] == round(4_000_000 / 443, 4)
    report = {r.regionname: (r.wanted, r.observed, r.drawn, r.deficit) for r in s.report.collect()}
    assert report == {"Big Reef": (400, 5000, 400, 0), "Small": (8, 3, 3, 5), "Mid": (40, 40, 40, 0), "None here": (5, 0, 0, 5), "Odd": (1, 0, 0, 1)}
    again = ProportionalSample(cand.repartition(7), targets, ["regionname", "rb_type_l3"], "fid").rows.collect()
    assert sorted(again) == sorted(drawn)
    other = ProportionalSample(cand, targets, ["regionname", "rb_type_l3"], "fid", seed=18).rows.collect()
    assert sorted(other) != sorted(drawn)
    none = ProportionalSample(cand.limit(0), targets, ["regionname", "rb_type_l3"], "fid")
    assert none.rows.count() == 0 and none.report.count() == 5
    assert ProportionalSample(cand, targets.limit(0), ["regionname", "rb_type_l3"], "fid").report.count() == 0


def test_short_draw_is_topped_up(spark):
    cand = spark.createDataFrame([(i, "a") for i in range(400)], "fid bigint, k string")
    targets = spark.createDataFrame([("A", 10_000, 0, 390)], "k string, target_bp int, min_rows int, sample_size int")
    for seed in range(3):
        s = ProportionalSample(cand, targets, ["k"], "fid", oversample=-0.3, seed=seed)
        assert s.report.first().drawn == 390
