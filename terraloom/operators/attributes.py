"""Attribute rules of the feature layers: enumerations, fills, assertions and the aggregates of a dissolve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.common import Scratch
from terraloom.functions.scalar import blank_to_null, number_or_null

#: Enumerations and their orders.
ATTACHMENT = ("Land", "Isolated", "Fringing", "Oceanic")
ATTACHMENT_PRIORITY = ("Land", "Fringing", "Oceanic", "Isolated")
DEPTH_ORDER = ("Land", "Surface", "Intertidal", "Very Shallow", "Shallow", "Deep")
CONFIDENCE = {"Very Low": 0, "Low": 1, "Medium": 2, "High": 3}
ENUMS = {"attachment": ATTACHMENT, "depthcat": DEPTH_ORDER, "featconf": tuple(CONFIDENCE), "typeconf": tuple(CONFIDENCE)}
#: Defaults of absorbed features.
MERGE_DEFAULTS = {"EdgeSrc": "Semi-auto", "FeatConf": "High", "TypeConf": "Medium", "FlowInflu": "None", "Paleo": "No"}


def rank_of(c: Column, order: tuple[str, ...], other: int) -> Column:
    out = F.lit(other)
    for i, v in reversed(list(enumerate(order))):
        out = F.when(c == v, i).otherwise(out)
    return out


def joined_set(c: Column | str) -> Column:
    """Distinct non-blank values, sorted and joined by ';'; '' if none."""
    return F.array_join(F.sort_array(F.collect_set(blank_to_null(c))), ";")


def _best(c: Column | str, rank) -> Column:
    v = blank_to_null(c)
    return F.coalesce(F.min(F.when(v.isNotNull(), F.struct(rank(v).alias("r"), v.alias("v"))))["v"], F.lit(""))


def pick_attachment(c: Column | str) -> Column:
    """Land, then Fringing, Oceanic, Isolated, then the first other value in order; '' if none."""
    return _best(c, lambda v: rank_of(v, ATTACHMENT_PRIORITY, 99))


def pick_depth(c: Column | str) -> Column:
    """Shallowest known value; unknown ones only if there is no other."""
    return _best(c, lambda v: rank_of(v, DEPTH_ORDER, 999))


def worst_confidence(c: Column | str) -> Column:
    """Lowest confidence; an unknown value counts as lower than any."""
    return _best(c, lambda v: rank_of(v, tuple(CONFIDENCE), -1))


def max_whole(c: Column | str) -> Column:
    return F.coalesce(F.max(number_or_null(c)).cast("int"), F.lit(0))


def listed_set(c: Column | str, order: tuple[str, ...]) -> Column:
    """Values present, in the order of the enumeration, joined by ';'."""
    have = F.collect_set(blank_to_null(c))
    return F.array_join(F.filter(F.array(*map(F.lit, order)), lambda v: F.array_contains(have, v)), ";")


def enum_violations(df: DataFrame, enums: dict[str, tuple[str, ...]] = ENUMS) -> DataFrame:
    """(field, value, n) of entries outside their enumeration; blanks and nulls are allowed."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), blank_to_null(c).alias("value")) for c in enums])
    bad = reduce(lambda a, b: a | b, [(F.col("field") == c) & ~F.col("value").isin(*vs) for c, vs in enums.items()])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull() & bad).groupBy("field", "value").count().withColumnRenamed("count", "n")


def require(violations: DataFrame, what: str) -> None:
    """Raises if there is any violation, showing a few."""
    some = violations.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where(F.col("count") > 1)


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in the given order; those that are missing come as null text."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def fill_blanks(df: DataFrame, defaults: dict[str, str], blanks_too: bool = True) -> DataFrame:
    empty = lambda c: F.col(c).isNull() | ((F.trim(c) == "") if blanks_too else F.lit(False))
    return df.withColumns({c: F.when(empty(c), F.lit(v)).otherwise(F.col(c)) for c, v in defaults.items() if c in df.columns})


def lookup_first(features: DataFrame, crosswalk: DataFrame, key: tuple[str, str], lists: dict[str, str], order: str, fields: list[str], fid: str) -> DataFrame:
    """First crosswalk row (by ``order``) with an equal key whose lists hold the feature's values.

    ``lists`` maps feature columns to crosswalk array columns. Features that match nothing get null fields and a null
    ``order``. A feature's null or blank value is in no list.
    """
    cw = crosswalk.select(F.col(key[1]).alias("_key"), F.col(order).alias("_order"), *[F.col(c).alias(f"_l{i}") for i, c in enumerate(lists.values())], *fields)
    fits = reduce(lambda a, b: a & b, [F.array_contains(F.col(f"_l{i}"), F.col(c)) for i, c in enumerate(lists)])
    hit = features.join(cw, (features[key[0]] == cw["_key"]) & fits)
    first = hit.groupBy(fid).agg(F.min(F.struct("_order", *fields)).alias("m")).select(fid, F.col("m._order").alias("matched_row"), *[F.col(f"m.{f}").alias(f) for f in fields])
    return features.join(first, fid, "left")


def percentile_vector(c: Column, steps: int = 20) -> Column:
    """Exact percentiles at 5, 10, ... 100, by linear interpolation."""
    return F.percentile(c, F.array(*[F.lit((i + 1) / steps) for i in range(steps)]))


def percentile_rank(x: Column, v: Column) -> Column:
    """Aggregate: rank (0-100) of x, constant in the group, among the values v, linear between neighbours.

    0 up to the least, 100 from the largest on. Needs only counts and extrema on either side of x, all combined
    before the shuffle.
    """
    n, upto = F.count(v), F.count(F.when(v <= x, v))
    d0, d1 = F.max(F.when(v <= x, v)), F.min(F.when(v > x, v))
    edge = F.max(x)
    inner = (upto - 1 + (edge - d0) / (d1 - d0)) / (n - 1) * 100
    return F.when(n == 0, None).when(edge <= F.min(v), 0.0).when(edge >= F.max(v), 100.0).otherwise(inner)


def sequential_id(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive ids in the ascending order of the given expressions, without one task holding all rows.

    Rows are range-partitioned in that order, counted by partition, and numbered within their partition from the
    count of those before; only the counts, one per partition, meet in one place.
    """
    cols = df.columns
    part = df.withColumns({f"_o{i}": o for i, o in enumerate(order)}).repartitionByRange(*[F.col(f"_o{i}") for i in range(len(order))])
    part = part.withColumn("_p", F.spark_partition_id())
    part = Scratch(df.sparkSession).keep(part)
    sizes = part.groupBy("_p").count()
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_p", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*[F.col(f"_o{i}") for i in range(len(order))]))
    return part.join(base, "_p").withColumn(name, (F.col("_base") + rank - 1 + start).cast("bigint")).select(*cols, name)


