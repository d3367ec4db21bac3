"""Sample whose category shares match given targets, with a minimum for small categories.

Each candidate gets a fixed pseudo-random number from its id and the seed. The acceptance probability of a
category is its wanted count over its observed count, raised by a slight oversampling; candidates whose number
is below it are accepted independently of each other. Accepted counts are then cut to the wanted ones exactly:
a histogram of the numbers says in which bin the cut falls, and only that bin is ranked, so no category is ever
ordered as a whole. A category in which chance accepted too few takes part with all its candidates.

Defined results: categories compare by name (case and blanks don't matter) and come out as the targets write
them; candidates with a null id or category, or outside the targets, are no candidates; an id counts once per
category; null shares and minima count as 0; a category repeated in the targets is taken once, with its larger
wanted count. Equal inputs and seed give the same sample. Other columns of the inputs are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.common import Scratch, name_key

BINS = 1024


def _same(a: list[str], b: list[str]) -> list[tuple[str, str]]:
    return list(zip(a, b, strict=True))


class ProportionalSample:
    """``rows``: the sample, (id, categories as the targets write them).

    ``report``: one row per category with ``wanted``, ``observed``, ``drawn``, ``deficit`` and ``reached``, the share it has of the
    sample in the measure of ``share``. Wanted counts are rounded up and minima go on top, so a sample may be larger than ``size``
    asks; what a category falls short of is not given to others, as their shares would go off their targets.
    """

    def __init__(
        self, candidates: DataFrame, targets: DataFrame, by: list[str], id_col: str, *, share: str = "target_bp",
        whole: int = 10_000, size: str = "sample_size", least: str = "min_rows", oversample: float = 0.1, seed: int = 17,
    ):
        scratch = Scratch(candidates.sparkSession)
        keys = [f"_k{i}" for i in range(len(by))]
        part = F.coalesce(F.col(share), F.lit(0)).cast("bigint") * F.coalesce(F.col(size), F.lit(0)).cast("bigint")
        goal = (
            targets.select(*[F.col(c) for c in by], part.alias("_p"), F.coalesce(F.col(least), F.lit(0)).cast("bigint").alias("_m"))
            .withColumn("wanted", F.greatest("_m", F.expr(f"(_p + {whole - 1}) div {whole}")))
            .select(*[name_key(c).alias(k) for c, k in _same(by, keys)], *by, "wanted")
            .groupBy(*keys)
            .agg(*[F.min(c).alias(c) for c in by], F.max("wanted").alias("wanted"))
        )
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 11) * F.lit(2.0**-53)).alias("_u")
        pool = candidates.where(F.col(id_col).isNotNull()).select(
            F.col(id_col), *[name_key(c).alias(k) for c, k in _same(by, keys)]
        )
        pool = scratch.keep(pool.join(goal, keys).select(id_col, *keys).distinct().withColumn("_u", u))
        seen = pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("observed"))
        w, n = F.col("wanted"), F.col("observed")
        rate = F.least(F.lit(1.0), (w * (1 + oversample) + 4 * F.sqrt(w)) / n)
        rates = goal.join(seen, keys, "left").fillna(0, ["observed"]).withColumn("rate", F.when(n > 0, rate).otherwise(1.0))
        taken = (
            pool.join(rates.select(*keys, "rate"), keys).where(F.col("_u") < F.col("rate")).groupBy(*keys).agg(F.count(F.lit(1)).alias("accepted"))
        )
        plan = rates.join(taken, keys, "left").fillna(0, ["accepted"])
        short = F.col("accepted") < F.least(w, n)
        self._plan = scratch.keep(plan.withColumn("rate", F.when(short, F.lit(1.0)).otherwise(F.col("rate"))))
        step = self._plan.select(*keys, *by, "wanted", "rate")
        accepted = pool.join(step, keys).where((F.col("_u") < F.col("rate")) | (F.col("rate") >= 1.0))
        accepted = accepted.withColumn("_bin", F.least(F.floor(F.col("_u") / F.col("rate") * BINS), F.lit(BINS - 1)).cast("int"))
        bins = accepted.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).join(
            self._plan.select(*keys, "wanted"), keys
        )
        bins = bins.where(F.col("_before") < F.col("wanted"))
        bins = bins.withColumn("_room", F.when(F.col("_before") + F.col("_n") > F.col("wanted"), F.col("wanted") - F.col("_before")))
        kept = accepted.drop("wanted").join(bins.select(*keys, "_bin", "_room"), [*keys, "_bin"])
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_u", id_col))
        whole_bins = kept.where(F.col("_room").isNull())
        cut_bins = kept.where(F.col("_room").isNotNull()).withColumn("_r", rank).where(F.col("_r") <= F.col("_room")).drop("_r")
        self.rows = scratch.keep(whole_bins.unionByName(cut_bins).select(id_col, *by, *keys))
        drawn = self.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("drawn"))
        self.report = (
            self._plan.join(drawn, keys, "left")
            .fillna(0, ["drawn"])
            .select(*by, "wanted", "observed", "drawn", (F.col("wanted") - F.col("drawn")).alias("deficit"))
        )
        share_of = F.col("drawn") * float(whole) / F.sum("drawn").over(Window.partitionBy(F.lit(0)))  # one row per category
        self.report = self.report.withColumn("reached", F.bround(F.round(F.when(F.col("drawn") > 0, share_of).otherwise(0.0), 12), 4))
        self.rows = self.rows.drop(*keys)

