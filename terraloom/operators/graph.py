"""Connected components and greedy one-to-one matching over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.common import Scratch

EDGES_PER_TASK = 250_000


def connected_components(edges: DataFrame, a: str, b: str, vertices: DataFrame | None = None, v: str = "v") -> DataFrame:
    """(v, component): the smallest vertex reachable. Isolated ``vertices`` are their own component.

    Alternates large-star and small-star: every vertex links its larger, then its smaller neighbours to the smallest
    one. The number of edges never grows and paths shorten fast; each round starts from written tables. Minima are
    combined before each shuffle. Ends when a round changes nothing. Null ends are no edges. Up to ``EDGES_PER_TASK`` edges are one
    task's work, by the same steps, and need no shuffle.
    """
    scratch = Scratch(edges.sparkSession)
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("w")).where((F.col("u") != F.col("w")))
    e = scratch.keep(e.select(F.greatest("u", "w").alias("u"), F.least("u", "w").alias("w")).distinct())

    def star(e: DataFrame, large: bool, alone: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("w").alias("u"), F.col("u").alias("w"))) if large else e
        low = both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = both.join(low.hint("shuffle_hash") if alone else low, "u")
        if large:
            return linked.where(F.col("w") > F.col("u")).select(F.col("w").alias("u"), F.col("m").alias("w")).distinct()
        ends = linked.where(F.col("w") != F.col("m")).select(F.col("w").alias("u"), F.col("m").alias("w"))
        return ends.unionByName(low.select("u", F.col("m").alias("w"))).where(F.col("u") != F.col("w")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first())

    seen = mark(e)
    while seen[0]:
        alone = seen[0] <= EDGES_PER_TASK
        nxt = scratch.keep(star(star(e.coalesce(1) if alone else e, True, alone), False, alone))
        now = mark(nxt)
        scratch.drop(e)
        e = nxt
        if now == seen:
            break
        seen = now
    found = e.select(F.col("u").alias(v), F.col("w").alias("component"))
    roots = e.select(F.col("w").alias(v), F.col("w").alias("component")).distinct()
    out = found.unionByName(roots)
    if vertices is None:
        return out
    return vertices.select(v).where(F.col(v).isNotNull()).distinct().join(out, v, "left").select(v, F.coalesce("component", v).alias("component"))


def greedy_match(pairs: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """One-to-one pairs as a greedy pass by (score descending, a, b) would pick them.

    A pair that ranks first for both its ends is picked by the greedy pass too, so all such pairs are taken at once
    and their ends leave the field; rounds go on until no pair is left. The first of an end is a minimum, combined before the
    shuffle, so an end with very many partners is no task of its own. A chain of partners with falling scores takes a round for
    each link; with scores that few partners of an end can share, as overlaps of at least a half, such chains are short.
    """
    scratch = Scratch(pairs.sparkSession)
    left = scratch.keep(pairs.select(a, b, score).where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(score).isNotNull()))
    picked: list[DataFrame] = []
    while n := left.count():
        here = left.coalesce(1) if n <= EDGES_PER_TASK else left
        first = lambda end, other: here.groupBy(end).agg(F.min(F.struct((-F.col(score)).alias("s"), other)).alias("m")).select(end, F.col(f"m.{other}").alias(other), "m.s")  # noqa: B023, E731
        won = first(a, b).join(first(b, a).select(a, b), [a, b])
        won = scratch.keep(won.select(a, b, (-F.col("s")).alias(score)))
        picked.append(won)
        rest = scratch.keep(here.join(won.select(a), a, "left_anti").join(won.select(b), b, "left_anti").select(a, b, score))
        scratch.drop(left)
        left = rest
    out = left
    for p in picked:
        out = out.unionByName(p)
    return out
