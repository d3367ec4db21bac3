from datetime import date

from pyspark.sql import functions as F

from terraloom.operators.profile import Form, column_profile
from terraloom.plans import quality

FORMS = {"num": Form(lo=1.0, hi=5000.0), "cat": Form(values=("Very Low", "High"))}
ROWS = [
    (1, 1, "a", "50", "High", 1.5, date(2024, 1, 1)), (2, 1, "a", " 7000 ", "very  LOW", float("nan"), None), (2, 1, "a", " 7000 ", "very  LOW", float("nan"), None),
    (3, 1, "a", "NaN", "odd", 9.0, date(2023, 5, 1)), (4, 1, "a", "x", "ODD ", None, date(2023, 5, 1)),
    (5, 3, "b", "50", None, 1.5, date(2024, 1, 1)), (6, 3, "b", "0", "high", 9.0, None), (None, 3, "b", "0", "high", 9.0, None), (None, 3, "b", "0", "high", 9.0, None),
]


def test_all_entries_of_all_columns(spark):
    df = spark.createDataFrame(ROWS, "id bigint, no int, load string, num string, cat string, size double, day date")
    rows = column_profile(df, "id", F.col("load"), F.col("no"), FORMS).collect()
    got = {(r.load_id, r["col"]): tuple(r[3:]) for r in rows}
    assert len(rows) == len(got) == 2 * 7
    assert got["a", "num"] == (4, 1, 2, 3, "50", "x", 50.0, 7000.0, None)
    assert got["b", "num"] == (4, 0, 3, 2, "0", "50", 0.0, 50.0, 0.75)
    assert got["a", "cat"] == (4, 0, 2, 3, "high", "very low", None, None, None)
    assert got["b", "cat"] == (4, 1, 0, 1, "high", "high", None, None, 0.75)
    assert got["a", "size"] == (4, 2, None, 2, None, None, 1.5, 9.0, None)
    assert got["b", "size"] == (4, 0, None, 2, None, None, 1.5, 9.0, 0.5)
    assert got["a", "day"] == (4, 1, None, 2, "2023-05-01", "2024-01-01", None, None, None)
    assert column_profile(df.limit(0), "id", F.col("load"), F.col("no"), FORMS).count() == 0


def test_every_column_of_the_large_tables(spark, sf):
    got = {(r.tab, r["col"]) for r in quality.p2_columns(spark, sf).collect()}
    tables = ("nw_features", "match_lines", "position_error")
    assert got == {(t, c) for t in tables for c in spark.read.parquet(f"{sf}/{t}.parquet").columns}
