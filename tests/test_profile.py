import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from terraloom.operators.profile import Form, footer_profile, load_profile, make_up, shifts, suspects, violations
from terraloom.sources.chunks import column_chunks

FORMS = {"num": Form(lo=1.0, hi=5000.0), "cat": Form(values=("Very Low", "High"))}


@pytest.fixture
def loads(spark, tmp_path):
    rows = [
        (1, 1, "a", "50", "High"), (2, 1, "a", " 50.0 ", "very  LOW"), (2, 1, "a", " 50.0 ", "very  LOW"), (3, 1, "a", "NaN", ""), (4, 1, "a", None, None),
        (5, 2, "b", "0", "High."), (6, 2, "b", "5000", "high"), (7, 2, "b", "5,5", " na "), (8, 2, "b", "５０", "Low"), (None, 2, "b", "1e3", "x"),
    ]
    t = pa.Table.from_pylist([dict(zip(("id", "no", "load", "num", "cat"), r, strict=True)) | {"col": "clash"} for r in rows], pa.schema(
        [("id", pa.int64()), ("no", pa.int32()), ("load", pa.string()), ("num", pa.string()), ("cat", pa.string()), ("col", pa.string())]))
    (tmp_path / "t").mkdir()
    pq.write_table(t.slice(0, 5), tmp_path / "t" / "clean.parquet")
    pq.write_table(t.slice(5, 3), tmp_path / "t" / "dirty.parquet", use_dictionary=False)
    pq.write_table(t.slice(8), tmp_path / "t" / "more.parquet", compression="zstd", data_page_version="2.0", row_group_size=1)
    return spark.read.parquet(str(tmp_path / "t"))


def test_chunks_are_ruled_out_by_dictionary(spark, loads):
    found = suspects(column_chunks(spark, loads, list(FORMS)), FORMS).collect()
    got = sorted((r["col"], r.path.rsplit("/", 1)[1], r.row_group, r.bad and sorted(r.bad)) for r in found)
    assert got == [
        ("cat", "dirty.parquet", 0, None), ("cat", "more.parquet", 0, ["Low"]), ("cat", "more.parquet", 1, ["x"]),
        ("num", "dirty.parquet", 0, None), ("num", "more.parquet", 0, ["５０"]), ("num", "more.parquet", 1, ["1e3"]),
    ]


def test_a_clean_table_is_not_read(spark, tmp_path, monkeypatch):
    t = pa.table({"id": pa.array(range(5000)), "no": pa.array([1] * 5000, pa.int32()), "load": ["a"] * 5000, "num": ["50", "7.5"] * 2500, "cat": ["High", " "] * 2500})
    pq.write_table(t, tmp_path / "clean.parquet", row_group_size=1000)
    df = spark.read.parquet(str(tmp_path / "clean.parquet"))
    assert suspects(column_chunks(spark, df, list(FORMS)), FORMS).count() == 0
    assert violations(spark, df, "id", "load", FORMS).count() == 0
    got = {r["col"]: r for r in footer_profile(spark, df, ["no", "num", "load"]).collect()}
    assert all(r.chunks == 5 and r.chunks_read == 0 for r in got.values())
    assert (got["num"].lo, got["num"].hi, got["num"].n_distinct, got["no"].n_distinct) == ("50", "7.5", 2, 1)


@pytest.mark.parametrize("dictionary", [True, False])
def test_ranges_of_every_kind(spark, tmp_path, dictionary):
    import datetime as dt

    long = "z" * 200
    when = [dt.datetime(2024, 1, 2, 3, 4, 5), None, dt.datetime(2023, 12, 31)]
    t = pa.table({"t": pa.array(when, pa.timestamp("us")), "d": pa.array([dt.date(2024, 5, 1), dt.date(1999, 1, 1), None]), "x": [float("nan"), 2.5, -1.0], "b": [True, None, False],
                  "s": [long + "b", long + "a", None], "n": pa.array([None] * 3, pa.string())})
    pq.write_table(t, tmp_path / "k.parquet", use_dictionary=dictionary)
    df = spark.read.parquet(str(tmp_path / "k.parquet"))
    got = {r["col"]: (r.n_nulls, r.n_distinct, r.lo, r.hi, r.lo_num, r.hi_num) for r in footer_profile(spark, df).collect()}
    assert got == {
        "t": (1, 2, "2023-12-31 00:00:00.000000", "2024-01-02 03:04:05.000000", None, None), "d": (1, 2, "1999-01-01", "2024-05-01", None, None), "x": (0, 3, None, None, -1.0, 2.5),
        "b": (1, 2, "false", "true", None, None), "s": (1, 2, long + "a", long + "b", None, None), "n": (3, 0, None, None, None, None),
    }


def test_violations(spark, loads):
    got = sorted((r["col"], r.row_id or 0) for r in violations(spark, loads, "id", "load", FORMS).collect())
    assert got == [("cat", 0), ("cat", 5), ("cat", 8), ("num", 0), ("num", 5), ("num", 7), ("num", 8)]


def test_shift_counts_repeats_once(loads):
    got = {(r["col"], r.load_id): round(r.change, 6) for r in shifts(make_up(loads, "id", "load", "no", FORMS)).collect()}
    # num: {50: .5, missing: .5} -> {5000: .2, other: .8}; cat: {high .25, very low .25, m .5} -> {o .6, high .2, m .2}
    assert got == {("num", "b"): 1.0, ("cat", "b"): 0.6}


def test_load_profile(loads):
    got = {(r["col"], r.load_id): (r.n_rows, r.n_missing, r.n_broken, r.n_values, r.lo, r.hi) for r in load_profile(loads, "id", "load", "no", FORMS).collect()}
    assert got[("num", "a")] == (4, 2, 0, 1, 50.0, 50.0)
    assert got[("cat", "b")] == (5, 1, 3, 1, None, None)


def test_footers_agree_with_a_scan(spark, loads):
    from pyspark.sql import functions as F

    got = {r["col"]: r for r in footer_profile(spark, loads).collect()}
    for c in ("id", "no", "load", "num", "cat"):
        want = loads.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.count_distinct(c)).first()
        assert (got[c].n_rows, got[c].n_nulls, got[c].n_distinct) == tuple(want), c
    assert (got["id"].lo_num, got["id"].hi_num) == (1.0, 8.0)
    assert got["num"].chunks_read == 1 and got["num"].chunks == 4
    assert got["id"].chunks_read == 0 and got["id"].chunks == 4


def test_empty_table(spark, loads):
    empty = loads.limit(0)
    assert violations(spark, spark.createDataFrame([], loads.schema), "id", "load", FORMS).count() == 0
    assert shifts(make_up(empty, "id", "load", "no", FORMS)).count() == 0
