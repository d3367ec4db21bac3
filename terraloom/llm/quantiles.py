"""Percentiles of very large groups from rank-interval summaries with a tracked error.

A summary of a group is a list of tuples (value, lowest rank, highest rank) in value order: the value is known
to stand between these two ranks among the group's values. One shuffle brings a group's rows together, sorted;
they are summarised as they stream by, with constant memory, and repeats of a row fall out next to each other.
A group with more than ``hot_rows`` rows is dealt by row key to several tasks; their partial summaries, like
those of separate days or files, are merged in a tree, ``FAN`` at a time. A merge adds the ranks a value can have in the
other summary; compression drops tuples as long as no gap between neighbours grows beyond the permitted
uncertainty. ``err`` is the error that has accumulated, as a share of the rows: half the widest gap.

Groups of up to ``1 / eps`` rows are kept whole and come out exact. Where a decision needs an exact percentile of
a larger group, ``exact_ranks`` narrows the bracket between two tuples round by round, reading that group only;
ties at both ends are counted, so every round takes at least two distinct values off and ties cannot stall it.

Defined results: null, NaN, infinite and negative values are not usable and are left out; null groups and null
keys are left out; a key counts once per group and value; a group without usable values has no summary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.common import Scratch

EPS = 0.005
HOT_ROWS = 200_000
FAN = 32
BLOCK = 1 << 16
_SUMMARY = "grp string, salt int, n bigint, v array<double>, rmin array<bigint>, rmax array<bigint>"


def usable(c: Column) -> Column:
    return F.coalesce((c >= 0.0) & (c < float("inf")), F.lit(False))


class Summary:
    """Rank-interval tuples of one group."""

    __slots__ = ("n", "rmax", "rmin", "v")

    def __init__(self, n: int, v: np.ndarray, rmin: np.ndarray, rmax: np.ndarray):
        self.n, self.v, self.rmin, self.rmax = n, v, rmin, rmax

    @staticmethod
    def of_sorted(values: np.ndarray) -> Summary:
        ranks = np.arange(1, len(values) + 1, dtype=np.int64)
        return Summary(len(values), values, ranks, ranks)

    def compress(self, eps: float) -> Summary:
        """Keeps a tuple only where the gap to the one kept before would exceed ``eps * n`` ranks without it."""
        room = max(1, int(eps * self.n))
        if len(self.v) <= max(3, 1 / eps):
            return self
        keep, k, last = [0], 0, len(self.v) - 1
        while k < last:
            to = int(np.searchsorted(self.rmax, self.rmin[k] + room, "right")) - 1
            k = min(max(to, k + 1), last)
            keep.append(k)
        at = np.array(keep)
        return Summary(self.n, self.v[at], self.rmin[at], self.rmax[at])

    def followed_by(self, other: Summary) -> Summary:
        """Both as one, where no value of ``other`` is smaller than any of this one."""
        return Summary(
            self.n + other.n,
            np.concatenate([self.v, other.v]),
            np.concatenate([self.rmin, other.rmin + self.n]),
            np.concatenate([self.rmax, other.rmax + self.n]),
        )

    def _among(self, other: Summary, side: str) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(other.v, self.v, side)
        low = np.concatenate([[0], other.rmin])[at]
        high = np.concatenate([other.rmax - 1, [other.n]])[at]
        return self.rmin + low, self.rmax + high

    def merge(self, other: Summary) -> Summary:
        if not self.n or not other.n:
            return self if self.n else other
        a_min, a_max = self._among(other, "left")  # of equal values, this one's come first
        b_min, b_max = other._among(self, "right")
        v = np.concatenate([self.v, other.v])
        order = np.argsort(v, kind="stable")
        return Summary(
            self.n + other.n, v[order], np.concatenate([a_min, b_min])[order], np.concatenate([a_max, b_max])[order]
        )

    def error(self) -> float:
        if len(self.v) < 2:
            return 0.0
        return max(0.0, float(np.max(self.rmax[1:] - self.rmin[:-1]) - 1) / 2 / self.n)

    def bracket(self, rank: int) -> tuple[float, float]:
        """Values between which the value of this rank (from 1) lies."""
        below = int(np.searchsorted(np.maximum.accumulate(self.rmax), rank, "right")) - 1
        above = int(np.searchsorted(self.rmin, rank, "left"))
        return float(self.v[max(below, 0)]), float(self.v[min(above, len(self.v) - 1)])


def target_ranks(n: int, phi: float) -> tuple[int, int, float]:
    """Ranks (from 1) of the two neighbours of a percentile and the share of the way to the second."""
    h = (n - 1) * phi
    lower = int(np.floor(h))
    return lower + 1, min(lower + 2, n), h - lower


def _summarise(eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        head: tuple | None = None
        so_far: Summary | None = None
        pending: list[np.ndarray] = []
        last: tuple | None = None

        def fold() -> Summary:
            block = Summary.of_sorted(np.concatenate(pending) if pending else np.zeros(0))
            pending.clear()
            if so_far is not None:
                block = so_far.followed_by(block)
            return block.compress(eps / 2)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["grp", "salt", "n", "v", "rmin", "rmax"]
            )
            done.clear()
            return out

        def close() -> None:
            s = fold()
            if s.n:
                done.append((*head, s.n, s.v, s.rmin, s.rmax))

        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(0).dictionary_encode()
            names, code = g.dictionary.to_pylist(), g.indices.to_numpy(zero_copy_only=False)
            salt = b.column(1).to_numpy(zero_copy_only=False)
            v = b.column(2).to_numpy(zero_copy_only=False)
            key = b.column(3).to_numpy(zero_copy_only=False)
            fresh = np.ones(len(v), bool)
            fresh[1:] = (code[1:] != code[:-1]) | (salt[1:] != salt[:-1]) | (v[1:] != v[:-1]) | (key[1:] != key[:-1])
            fresh[0] = last != (names[code[0]], salt[0], v[0], key[0])
            last = (names[code[-1]], salt[-1], v[-1], key[-1])
            starts = np.concatenate([[0], np.flatnonzero((code[1:] != code[:-1]) | (salt[1:] != salt[:-1])) + 1, [len(v)]])
            for i, j in zip(starts[:-1], starts[1:], strict=True):
                this = (names[code[i]], int(salt[i]))
                if this != head:
                    if head is not None:
                        close()
                    head, so_far = this, None
                pending.append(v[i:j][fresh[i:j]])
                if sum(map(len, pending)) > BLOCK:
                    so_far = fold()
            if len(done) > 5_000:
                yield flush()
        if head is not None:
            close()
        if done:
            yield flush()

    return run


def _merge(gap: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [
            Summary(int(r.n), np.asarray(r.v, float), np.asarray(r.rmin, np.int64), np.asarray(r.rmax, np.int64))
            for r in rows.itertuples()
        ]
        while len(parts) > 1:
            parts = [a.merge(b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) & ~1 :]
        s = parts[0].compress(gap)
        return pd.DataFrame([(key[0], int(key[1]), s.n, s.v, s.rmin, s.rmax)], columns=["grp", "salt", "n", "v", "rmin", "rmax"])

    return run


def merge_summaries(parts: DataFrame, most_parts: int, eps: float = EPS) -> DataFrame:
    """One summary for each group from up to ``most_parts`` partial ones, whose ``salt`` runs from 0.

    Partial summaries have gaps of up to ``eps / 2``. Each level of the tree may widen them by an equal share of
    the other half, so that a merged summary keeps a bounded number of tuples however many parts it has.
    """
    levels, left = 0, most_parts
    while left > 1:
        levels, left = levels + 1, -(-left // FAN)
    for level in range(1, levels + 1):
        step = parts.withColumn("salt", F.floor(F.col("salt") / FAN).cast("int"))
        parts = step.groupBy("grp", "salt").applyInPandas(_merge(eps / 2 * (1 + level / levels)), _SUMMARY)
    return parts


def summaries(df: DataFrame, grp: Column, value: Column, key: Column, eps: float = EPS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(grp, salt, n, v, rmin, rmax): the summary of the usable values of each group; ``key`` names a row."""
    scratch = Scratch(df.sparkSession)
    src = df.select(grp.cast("string").alias("grp"), value.cast("double").alias("v"), key.cast("bigint").alias("key"))
    src = src.where(usable(F.col("v")) & F.col("grp").isNotNull() & F.col("key").isNotNull())
    hot = src.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot_rows)
    hot = scratch.keep(hot.select("grp", F.ceil(F.col("rows") / hot_rows).cast("int").alias("salts")))
    most = hot.agg(F.max("salts")).first()[0] or 1
    src = src.withColumn("salt", F.lit(0))
    if most > 1:
        src = src.drop("salt").join(hot, "grp", "left")
        src = src.withColumn("salt", F.pmod(F.xxhash64("key"), F.coalesce("salts", F.lit(1))).cast("int"))
    streams = src.select("grp", "salt", "v", "key").repartition("grp", "salt").sortWithinPartitions("grp", "salt", "v", "key")
    parts = streams.mapInArrow(_summarise(eps), _SUMMARY)
    if most == 1:
        return parts
    parts = scratch.keep(parts)
    cold = parts.join(hot, "grp", "left_anti")
    return cold.unionByName(merge_summaries(parts.join(hot, "grp", "left_semi"), most, eps))


def percentiles(made: DataFrame, phis: dict[str, float]) -> DataFrame:
    """(grp, n, err) and, for each name in ``phis``, the bounds ``<name>_lo`` and ``<name>_hi`` of the percentile."""
    cols = [f"{k}_{end}" for k in phis for end in ("lo", "hi")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                s = Summary(int(r.n), np.asarray(r.v), np.asarray(r.rmin), np.asarray(r.rmax))
                out = [r.grp, s.n, s.error()]
                for phi in phis.values():
                    r1, r2, f = target_ranks(s.n, phi)
                    (a, b1), (c, d) = s.bracket(r1), s.bracket(r2)
                    out += [a + (c - a) * f, b1 + (d - b1) * f]
                rows.append(out)
            yield pd.DataFrame(rows, columns=["grp", "n", "err", *cols])

    schema = "grp string, n bigint, err double, " + ", ".join(f"{c} double" for c in cols)
    return made.select("grp", "n", "v", "rmin", "rmax").mapInPandas(run, schema)


def exact_ranks(
    df: DataFrame, grp: Column, value: Column, key: Column, todo: DataFrame, phi: float, eps: float = EPS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(grp, exact): the percentile itself for the groups of ``todo`` (grp)."""
    scratch = Scratch(df.sparkSession)
    src = df.select(grp.cast("string").alias("grp"), value.cast("double").alias("v"), key.cast("bigint").alias("key"))
    src = src.where(usable(F.col("v")) & F.col("key").isNotNull()).join(todo.select("grp"), "grp", "left_semi")
    src = scratch.keep(src.dropDuplicates(["grp", "key", "v"]))
    size = src.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    state = size.select("grp", "n", F.lit(0.0).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(0).cast("bigint").alias("below"))
    found: list[DataFrame] = []

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples():
                s = Summary(int(r.inside), np.asarray(r.v), np.asarray(r.rmin), np.asarray(r.rmax))
                r1, r2, f = target_ranks(int(r.n), phi)
                (a, b1), (c, d) = s.bracket(r1 - int(r.below)), s.bracket(r2 - int(r.below))
                exact = a + (c - a) * f if a == b1 and c == d else None
                rows.append((r.grp, r.n, a, d, r1, r2, f, exact))
            yield pd.DataFrame(rows, columns=["grp", "n", "lo", "hi", "r1", "r2", "share", "exact"])

    step_schema = "grp string, n bigint, lo double, hi double, r1 bigint, r2 bigint, share double, exact double"
    v, lo, hi = src["v"], F.col("lo"), F.col("hi")
    inside = (v > lo) & (v < hi)
    upto_lo, upto_inner = F.col("below") + F.col("ties"), F.col("below") + F.col("ties") + F.col("inner")
    at_end = lambda r: F.when(F.col(r) <= upto_lo, lo).when(F.col(r) > upto_inner, hi)
    while True:
        near = src.join(state, "grp").where(v.between(lo, hi))
        made = summaries(near, F.col("grp"), F.col("v"), F.col("key"), eps, hot_rows).withColumnRenamed("n", "inside")
        step = scratch.keep(made.join(state.select("grp", "n", "below"), "grp").mapInPandas(narrow, step_schema))
        found.append(step.where(F.col("exact").isNotNull()).select("grp", "exact"))
        left = step.where(F.col("exact").isNull()).drop("exact")
        if left.isEmpty():
            break
        # Both ends are counted, so a rank among their ties is settled, and the next bracket lies strictly between them.
        counted = src.join(left, "grp").groupBy(*left.columns).agg(
            F.count_if(v < lo).alias("below"), F.count_if(v == lo).alias("ties"), F.count_if(inside).alias("inner"),
            F.min(F.when(inside, v)).alias("first"), F.max(F.when(inside, v)).alias("last"),
        )
        counted = scratch.keep(counted.withColumns({"v1": at_end("r1"), "v2": at_end("r2")}))
        known = counted.where(F.col("v1").isNotNull() | F.col("v2").isNotNull())
        one, two = F.coalesce("v1", "last"), F.coalesce("v2", "first")
        found.append(known.select("grp", (one + (two - one) * F.col("share")).alias("exact")))
        still = counted.where(F.col("v1").isNull() & F.col("v2").isNull())
        if still.isEmpty():
            break
        state = still.select("grp", "n", F.col("first").alias("lo"), F.col("last").alias("hi"), upto_lo.alias("below"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
