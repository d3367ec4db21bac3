import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terraloom.llm.quantiles import Summary, exact_ranks, merge_summaries, percentiles, summaries


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=0, max_size=400), min_size=1, max_size=6), st.floats(0.01, 0.2))
def test_rank_intervals_hold_after_merges(parts, eps):
    made = [Summary.of_sorted(np.sort(np.array(p, float))).compress(eps) for p in parts]
    while len(made) > 1:
        made = [a.merge(b).compress(eps) for a, b in zip(made[::2], made[1::2], strict=False)] + made[len(made) & ~1 :]
    s, every = made[0], np.sort(np.array([x for p in parts for x in p], float))
    assert s.n == len(every)
    if s.n:
        for rank in range(1, s.n + 1):
            lo, hi = s.bracket(rank)
            assert lo <= every[rank - 1] <= hi
        assert s.rmin.min() >= 1 and s.rmax.max() <= s.n


def test_accumulated_error_is_bounded():
    rnd = np.random.default_rng(2)
    made = [Summary.of_sorted(np.sort(rnd.lognormal(size=20_000))).compress(0.0025) for _ in range(16)]
    while len(made) > 1:
        made = [a.merge(b) for a, b in zip(made[::2], made[1::2], strict=True)]
    s = made[0].compress(0.005)
    assert s.error() <= 0.0025 and len(s.v) <= 1000


def _table(spark):
    rnd = np.random.default_rng(4)
    rows = [(7, i, float(v)) for i, v in enumerate(np.round(rnd.lognormal(3, 1, 6000), 1))]
    rows += [(g, 10_000 + g * 100 + i, float(v)) for g in range(20, 40) for i, v in enumerate(rnd.integers(0, 50, 30))]
    bad = [(7, 90_001, None), (7, 90_002, float("nan")), (7, 90_003, float("inf")), (7, 90_004, -1.0), (None, 90_005, 3.0), (50, 90_006, None)]
    return rows, spark.createDataFrame([*rows, *rows[:300], *rows[-40:], *bad], "fid bigint, id bigint, v double").repartition(5)


def test_hot_group_in_bounds_and_exact(spark):
    rows, df = _table(spark)
    made = summaries(df, F.col("fid"), F.col("v"), F.col("id"), eps=0.02, hot_rows=1000)
    got = {r.grp: r for r in percentiles(made, {"p50": 0.5, "p90": 0.9}).collect()}
    assert set(got) == {"7", *map(str, range(20, 40))}
    for g, r in got.items():
        vals = np.array([v for f, _, v in rows if f == int(g)])
        assert r.n == len(vals) and r.err <= 0.02
        for name, q in (("p50", 50), ("p90", 90)):
            want = np.percentile(vals, q)
            assert r[f"{name}_lo"] - 1e-9 <= want <= r[f"{name}_hi"] + 1e-9
            if g != "7":
                assert abs(r[f"{name}_lo"] - want) < 1e-9 and abs(r[f"{name}_hi"] - want) < 1e-9
    todo = spark.createDataFrame([("7",), ("20",)], "grp string")
    exact = {r.grp: r.exact for r in exact_ranks(df, F.col("fid"), F.col("v"), F.col("id"), todo, 0.9, eps=0.02, hot_rows=1000).collect()}
    for g in ("7", "20"):
        assert abs(exact[g] - np.percentile([v for f, _, v in rows if f == int(g)], 90)) < 1e-9


def test_parts_made_apart_merge(spark):
    rows, df = _table(spark)
    parts = None
    for day in range(3):
        p = summaries(df.where(F.col("id") % 3 == day), F.col("fid"), F.col("v"), F.col("id"), eps=0.02).withColumn("salt", F.lit(day))
        parts = p if parts is None else parts.unionByName(p)
    r = percentiles(merge_summaries(parts, 3, eps=0.02).where("grp = '7'"), {"p50": 0.5}).first()
    want = np.percentile([v for f, _, v in rows if f == 7], 50)
    assert r.n == 6000 and r.p50_lo <= want <= r.p50_hi and r.err <= 0.04


def test_empty(spark):
    df = spark.createDataFrame([], "fid bigint, id bigint, v double")
    assert percentiles(summaries(df, F.col("fid"), F.col("v"), F.col("id")), {"p": 0.5}).count() == 0
