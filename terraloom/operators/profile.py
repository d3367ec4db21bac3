"""Column-level quality profiles of large tables, load by load.

``footer_profile`` answers row, null, extrema and distinct counts from footers and dictionaries and reads only
the chunks whose statistics are insufficient. ``violations`` finds entries that break a column's form: the form is held
against the dictionaries, and only chunks with a broken entry there, or without a full dictionary, are read, for the
rows that have it. ``make_up`` and ``shifts``
compare the shares of values between consecutive loads; deliveries are repeated, so footers cannot give those
counts, and the rows are read, reduced to one short label per column before the only shuffle.

Defined results: a row delivered twice (same key) counts once; null, blank, NA and NaN in any case are missing;
rows with null key are all counted; an empty table gives no rows; a load without rows cannot be compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terraloom.common import Scratch, name_key, trim_blanks
from terraloom.sources.chunks import column_chunks, ends, open_file


@dataclass(frozen=True)
class Form:
    """Admissible entries of a column: a value list, or numbers written with digits within a range."""

    values: tuple[str, ...] = ()
    lo: float | None = None
    hi: float | None = None

    def label(self, c: Column) -> Column:
        """``m`` for missing, ``o`` for other entries, ``v:`` and the value for admissible ones.

        Clean entries are settled by plain comparisons; only the rest pays for the unicode expressions.
        """
        key = name_key(c)
        missing = key.isNull() | key.isin("na", "nan")
        if self.values:
            lower = [v.lower() for v in self.values]
            clean, quick = F.lower(c).isin(lower), F.concat(F.lit("v:"), F.lower(c))
            good = F.when(key.isin(lower), F.concat(F.lit("v:"), key))
        else:
            digits, text = r"\A[0-9]+(\.[0-9]+)?\z", trim_blanks(c)
            clean, quick = c.rlike(digits), F.coalesce(self._number(c), F.lit("o"))
            good = F.when(text.rlike(digits), self._number(text))
        return (
            F.when(c.isNull() | (c == ""), F.lit("m"))
            .when(clean, quick)
            .when(missing, F.lit("m"))
            .otherwise(F.coalesce(good, F.lit("o")))
        )

    def _number(self, text: Column) -> Column:
        n = text.try_cast("double")
        return F.when(n.between(self.lo, self.hi), F.concat(F.lit("v:"), n.cast("string")))


def suspects(chunks: DataFrame, forms: dict[str, Form]) -> DataFrame:
    """(path, row_group, col, bad) of chunks that may hold violations: their broken dictionary entries, or null without a full dictionary."""
    value = chunks.select("path", "row_group", "col", F.explode_outer("candidates").alias("v"), F.col("candidates").isNull().alias("unknown"))
    broken = reduce(lambda a, x: a | x, [(F.col("col") == c) & (f.label(F.col("v")) == "o") for c, f in forms.items()])
    # A set is at most as long as one dictionary page.
    bad = F.when(~F.max("unknown"), F.collect_set("v")).alias("bad")
    return value.where(F.col("unknown") | broken).groupBy("path", "row_group", "col").agg(bad)


def violations(spark: SparkSession, df: DataFrame, key: str, load: str, forms: dict[str, Form]) -> DataFrame:
    """(load_id, col, row_id) of each entry that is neither missing nor admissible."""
    at = suspects(column_chunks(spark, df, list(forms)), forms)
    one = at.groupBy("path", "row_group").agg(F.collect_list(F.struct("col", "bad")).alias("cols"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for b in batches:
            for r in b.to_pylist():
                cols = {c["col"]: c["bad"] for c in r["cols"]}
                with open_file(r["path"]) as f:
                    t = pq.ParquetFile(f, read_dictionary=list(cols)).read_row_group(r["row_group"], columns=[*dict.fromkeys([key, load, *cols])])
                for c, bad in cols.items():
                    v = t.column(c)
                    hit = t if bad is None else t.filter(pc.is_in(v, pa.array(bad, pa.string())))
                    if hit.num_rows:
                        texts, known = hit.column(c).cast(pa.string()), pa.array(np.full(hit.num_rows, bad is not None))
                        parts = [hit.column(load).cast(pa.string()), pa.array([c] * hit.num_rows), hit.column(key).cast(pa.int64()), texts, known]
                        yield from pa.table(parts, ["load_id", "col", "row_id", "v", "known"]).to_batches()

    found = one.repartition("path", "row_group").mapInArrow(read, "load_id string, col string, row_id bigint, v string, known boolean")
    label = reduce(lambda a, x: a | x, [(F.col("col") == c) & (f.label(F.col("v")) == "o") for c, f in forms.items()])
    return found.where(F.col("known") | label).select("load_id", "col", "row_id").distinct()


def make_up(df: DataFrame, key: str, load: str, load_no: str, forms: dict[str, Form]) -> DataFrame:
    """(load_no, load_id, col, label, n): rows of each load by label, repeats counted once."""
    labels = [f.label(F.col(c)).alias(c) for c, f in forms.items()]
    once = df.select(F.col(key).alias("_k"), F.col(load_no).alias("load_no"), F.col(load).alias("load_id"), *labels)
    # Repeats are identical, so distinct over everything drops them, and needs no sort as picking a first row would.
    known, unnamed = once.where(F.col("_k").isNotNull()).distinct(), once.where(F.col("_k").isNull())
    one_row_each = known.unionByName(unnamed).groupBy("load_no", "load_id", *forms).count()
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("label")) for c in forms])
    return (
        one_row_each.select("load_no", "load_id", "count", F.explode(pairs).alias("p"))
        .groupBy("load_no", "load_id", "p.col", "p.label")
        .agg(F.sum("count").alias("n"))
    )


def shifts(made: DataFrame) -> DataFrame:
    """(col, load_no, load_id, change): half the summed absolute differences of the shares to the load before.

    ``made`` is read four times and as small as the value lists, so it is written once rather than computed again.
    """
    made = Scratch(made.sparkSession).keep(made)
    total = made.groupBy("col", "load_no", "load_id").agg(F.sum("n").alias("rows"))
    w = Window.partitionBy("col").orderBy("load_no")  # one row per load and column
    order = total.withColumn("prev", F.lag("load_no").over(w)).withColumn("prev_rows", F.lag("rows").over(w))
    now = made.join(order, ["col", "load_no", "load_id"]).select(
        "col", "load_no", "label", (F.col("n") / F.col("rows")).alias("share"), F.lit(0.0).alias("before")
    )
    then = made.select("col", F.col("load_no").alias("prev"), "label", "n").join(
        order.where(F.col("prev").isNotNull()).select("col", "load_no", "prev", "prev_rows"), ["col", "prev"]
    )
    then = then.select("col", "load_no", "label", F.lit(0.0).alias("share"), (F.col("n") / F.col("prev_rows")).alias("before"))
    diff = (
        now.unionByName(then)
        .groupBy("col", "load_no", "label")
        .agg(F.abs(F.sum("share") - F.sum("before")).alias("d"))
        .groupBy("col", "load_no")
        .agg((F.sum("d") / 2).alias("change"))
    )
    return order.where(F.col("prev").isNotNull()).join(diff, ["col", "load_no"]).select("col", "load_no", "load_id", "change")


def load_profile(df: DataFrame, key: str, load: str, load_no: str, forms: dict[str, Form]) -> DataFrame:
    """Per load and column of ``forms``: rows, missing, broken, distinct entries, range, change to the load before."""
    made = Scratch(df.sparkSession).keep(make_up(df, key, load, load_no, forms))
    value = F.when(F.col("label").startswith("v:"), F.substring("label", 3, 1000))
    per = made.groupBy("col", "load_no", "load_id").agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("label") == "m", F.col("n"))), F.lit(0)).cast("bigint").alias("n_missing"),
        F.coalesce(F.sum(F.when(F.col("label") == "o", F.col("n"))), F.lit(0)).cast("bigint").alias("n_broken"),
        F.count(value).alias("n_values"),
        F.min(value.try_cast("double")).alias("lo"),
        F.max(value.try_cast("double")).alias("hi"),
    )
    change = shifts(made).select("col", "load_no", F.round("change", 9).alias("change"))
    return per.join(change, ["col", "load_no"], "left")


def column_profile(df: DataFrame, key: str, load_id: Column, load_no: Column, forms: dict[str, Form]) -> DataFrame:
    """Per load and flat column, whether it has a form or not: (load_no, load_id, col, n_rows, n_missing, n_broken, n_distinct, lo, hi, lo_num, hi_num, change).

    Distinct counts, ranges and changes are over all entries that are not missing, broken ones included. Text compares as
    names do; ``lo`` and ``hi`` are for text, dates and times, ``lo_num`` and ``hi_num`` for numbers and for the numbers in
    text columns with a range. ``n_broken`` is null for columns without a form, ``change`` for the first load.
    """
    scratch = Scratch(df.sparkSession)
    fields = [f for f in df.schema if not isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)]
    known, unnamed = df.where(F.col(key).isNotNull()).distinct(), df.where(F.col(key).isNull())
    once = known.unionByName(unnamed).withColumns({"_no": load_no, "_id": load_id})
    entries = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, T.StringType)
        number = isinstance(f.dataType, T.NumericType)
        form = forms.get(f.name)
        entries.append(F.struct(
            F.lit(f.name).alias("col"), (name_key(c) if text else F.lower(c.cast("string"))).alias("v"),
            (form.label(c) == "o" if form else F.lit(None).cast("boolean")).alias("broken"),
            F.lit("number" if number else "both" if form and form.lo is not None else "text").alias("range"),
        ))
    long = once.select("_no", "_id", F.explode(F.array(*entries)).alias("e")).select("_no", "_id", "e.*")
    long = long.withColumn("v", F.when(~F.col("v").isin("na", "nan"), F.col("v")))
    made = scratch.keep(long.groupBy("_no", "_id", "col", "v", "broken", "range").agg(F.count(F.lit(1)).alias("n")))
    loads = made.where(F.col("col") == fields[0].name).groupBy("_no", "_id").agg(F.sum("n").alias("rows"))
    loads = scratch.keep(loads.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_no", "_id"))))  # one row per load
    made = made.join(loads, ["_no", "_id"])
    num, kind, n = F.col("v").try_cast("double"), F.col("range"), F.col("n")
    there = F.col("v").isNotNull()
    per = made.groupBy("place", F.col("_no").alias("load_no"), F.col("_id").alias("load_id"), "col").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~there, n)), F.lit(0)).alias("n_missing"),
        F.sum(F.when(F.col("broken"), n).when(F.col("broken").isNotNull(), 0)).alias("n_broken"), F.count("v").alias("n_distinct"),
        *[f(F.when(kind != "number", F.col("v"))).alias(a) for f, a in ((F.min, "lo"), (F.max, "hi"))],
        *[f(F.when((kind != "text") & ~F.isnan(num), num)).alias(a) for f, a in ((F.min, "lo_num"), (F.max, "hi_num"))],
    )
    # Half the summed absolute differences of two sets of shares is 1 less the shares they have in common.
    w = Window.partitionBy("col", "v").orderBy("place")  # at most one row per load
    share = made.select("col", "v", "place", (n / F.col("rows")).alias("share"))
    share = share.withColumns({"before": F.lag("share").over(w), "at": F.lag("place").over(w)})
    same = share.where(F.col("at") == F.col("place") - 1).groupBy("col", "place").agg(F.sum(F.least("share", "before")).alias("same"))
    change = F.when(F.col("place") > 1, F.round(1 - F.coalesce("same", F.lit(0.0)), 9)).alias("change")
    cols = ["load_no", "load_id", "col", "n_rows", "n_missing", "n_broken", "n_distinct", "lo", "hi", "lo_num", "hi_num"]
    return per.join(same, ["col", "place"], "left").select(*cols, change)


def footer_profile(spark: SparkSession, df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(col, n_rows, n_nulls, n_distinct, lo, hi, lo_num, hi_num, chunks, chunks_read) over all rows as stored.

    ``n_distinct`` counts values that are not null. ``lo`` and ``hi`` are for texts, dates, times and truth values, ``lo_num`` and
    ``hi_num`` for numbers; NaN is left out of the range. Chunks are read where a null count or an end is missing, columns
    for their distinct values where a chunk has no full dictionary: Spark counts those, as they may be as many as rows. Only
    flat columns are profiled.
    """
    flat = [f.name for f in df.schema if not isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType)]
    cols = [c for c in (cols or flat) if c in flat]
    ch = Scratch(spark).keep(column_chunks(spark, df, cols))
    sure = F.col("has_nulls") & F.col("has_ends")
    names = ["col", "n_rows", "n_nulls", "lo", "hi", "lo_num", "hi_num", "was_read"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                with open_file(r["path"]) as f:
                    data = pq.ParquetFile(f).read_row_group(r["row_group"], columns=[r["col"]]).column(0)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]
                row = (r["col"], r["n_rows"], data.null_count, *ends(data.drop_null().combine_chunks()), 1)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    part = "col string, n_rows bigint, n_nulls bigint, lo string, hi string, lo_num double, hi_num double, was_read int"
    read = ch.where(~sure).select("path", "row_group", "col", "n_rows").repartition("path", "row_group", "col").mapInArrow(scan, part)
    every = ch.where(sure).withColumn("was_read", F.lit(0)).select(*names).unionByName(read)
    facts = every.groupBy("col").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("lo_num").alias("lo_num"), F.max("hi_num").alias("hi_num"), F.count(F.lit(1)).alias("chunks"), F.sum("was_read").alias("chunks_read"),
    )
    lacking = [r["col"] for r in ch.where(F.col("candidates").isNull()).select("col").distinct().collect()]  # at most one per column
    values = ch.where(~F.col("col").isin(lacking)).select("col", F.explode("candidates").alias("v")).distinct()
    distinct = values.groupBy("col").agg(F.count("v").alias("n_distinct"))
    for c in lacking:
        counted = df.select(F.col(f"`{c}`").alias("v")).where("v IS NOT NULL").distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
        distinct = distinct.unionByName(counted.select(F.lit(c).alias("col"), "n_distinct"))
    return facts.join(distinct, "col", "left").fillna(0, ["n_distinct"])
