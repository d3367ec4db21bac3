import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.common import Scratch
from terraloom.llm.quantiles import exact_ranks

GROUPS = {
    "border": [40.0] * 1000 + [50.0] * 1000,
    "lower": [40.0] * 1003 + [50.0] * 1000,
    "upper": [40.0] * 1000 + [50.0] * 1003,
    "one between": [40.0] * 1000 + [45.0] + [50.0] * 1000,
    "two between": [40.0] * 1000 + [44.0, 46.0] + [50.0] * 1000,
    "first between": [40.0] * 1000 + [44.0] + [50.0] * 999,
    "last between": [40.0] * 999 + [46.0] + [50.0] * 1000,
    "layers": [float(x) for x in (10, 20, 30, 40, 50, 60) for _ in range(700)],
}


@pytest.fixture
def few_tables(monkeypatch):
    """Fails a search that goes on for ever instead of waiting for it."""
    keep, made = Scratch.keep, []

    def counted(self, df):
        made.append(1)
        assert len(made) < 60, "no end of rounds"
        return keep(self, df)

    monkeypatch.setattr(Scratch, "keep", counted)


@pytest.mark.parametrize("hot_rows", [200_000, 500])
def test_ties_on_both_sides_of_the_rank_are_settled(spark, few_tables, hot_rows):
    rows = [(g, i, v) for g, vs in GROUPS.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "grp string, id bigint, v double").repartition(3)
    todo = spark.createDataFrame([(g,) for g in GROUPS], "grp string")
    got = {r.grp: r.exact for r in exact_ranks(df, F.col("grp"), F.col("v"), F.col("id"), todo, 0.5, hot_rows=hot_rows).collect()}
    assert got == {g: float(np.percentile(vs, 50)) for g, vs in GROUPS.items()}
