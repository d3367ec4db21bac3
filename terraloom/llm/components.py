"""Consolidates pairwise matches into groups by low-diameter decomposition.

Every record draws an exponential shift from its number; a cluster starts at its centre as much earlier as the
shift is longer and grows one link per step, and each record joins the cluster that reaches it first. Shifts
are cut at ``hops``, so that this many steps settle the clusters. Clusters are contracted to super-vertices,
links within one fall away, links between two become one, and the decomposition runs again on what is left
until no link is. The assignments of the levels are then composed from the last one back, smaller tables first.

The state of a record, when a cluster reaches it and which, is one number: the time in 1/4096 steps above
``CENTRE_BITS`` bits for the centre, so that the earliest arrival is a plain minimum, hashed and combined before the
shuffle. A record's own start follows from its number, so only records that another cluster has reached have a
stored state, and only arrivals before the record's own start are sent. Links are kept once, smaller end first.

A level writes two tables to the shared folder, from which the next one starts, so a lost executor costs no
more than the level at hand. A level of up to ``LINKS_PER_TASK`` links runs as one task, by the same steps; larger ones
are spread. The links of a record with more than ``HUB_LINKS`` of them are dealt to several tasks and meet its number or
state there, in the numbering, the steps and the contraction.

Defined results: ids are trimmed and compared in upper case; null and blank ids name nothing; a row that names
one id only, twice the same, or with another relation makes its ids records but links nothing. Every record
gets the smallest id of its group in byte order. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.common import Scratch, trim_blanks

BETA = 0.4
HOPS = 8
HUB_LINKS = 200_000
LINKS_PER_TASK = 500_000
CENTRE_BITS = 47
TICKS = 4096
#: Numbers are dealt in turns to so many partitions at most.
TURNS = 1 << 15


def record_key(c: str) -> Column:
    k = F.upper(trim_blanks(F.col(c)))
    return F.when(k != "", k)


def attach(rows: DataFrame, key: str, facts: DataFrame, hubs: DataFrame | None, alone: bool = False) -> DataFrame:
    """Left join of ``rows`` with ``facts`` on ``key``; rows of ``hubs`` (``key``, salts) are dealt to so many tasks."""
    if hubs is None:
        return rows.join(facts.hint("shuffle_hash") if alone else facts, key, "left")
    hubs = hubs.withColumnRenamed(hubs.columns[0], key)
    n = F.coalesce("salts", F.lit(1))
    dealt = rows.join(hubs, key, "left").withColumn("_z", F.pmod(F.xxhash64(*rows.columns), n).cast("int")).drop("salts")
    spread = facts.join(hubs, key, "left").withColumn("_z", F.explode(F.sequence(F.lit(0), n - 1))).drop("salts")
    return dealt.join(spread, [key, "_z"], "left").drop("_z")


def start_of(v: str, beta: float, hops: int) -> Column:
    """State of a record that no other cluster has reached. The level is read from the links, not written into the plan, so
    that the code compiled for one level serves the next."""
    draw = (F.shiftrightunsigned(F.xxhash64(F.col("level"), F.col(v)), 11) + 1) * F.lit(2.0**-53)
    shift = F.floor(F.least(-F.log(draw) / beta, F.lit(float(hops))) * TICKS).cast("bigint")
    return F.shiftleft(F.lit(hops * TICKS).cast("bigint") - shift, CENTRE_BITS) + F.col(v)


def _once(links: DataFrame, beta: float, hops: int) -> DataFrame:
    """Links (a, b, level) between different ends, each once, with the starts of both ends for the next level."""
    found = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "level")
    found = found.groupBy("a", "b").agg((F.max("level") + 1).alias("level"))
    return found.select("a", "b", "level", start_of("a", beta, hops).alias("sa"), start_of("b", beta, hops).alias("sb"))


def decompose(links: DataFrame, hops: int = HOPS, hubs: DataFrame | None = None, alone: bool = False) -> DataFrame:
    """(v, c): the centre of the cluster that each end of ``links`` (a, b, sa, sb) joins, where it isn't itself. Ends are numbers below 2 ** CENTRE_BITS.

    The steps are one text of SQL, as Spark analyses a plan anew with every call that adds to it.
    """
    if not 0 < hops < (1 << (63 - CENTRE_BITS)) // TICKS - 1:
        raise ValueError(f"{hops} hops don't fit beside the centre")
    step = f"{TICKS << CENTRE_BITS}L"
    salt = "CAST(pmod(xxhash64(e.w), coalesce(salts, 1)) AS INT)" if hubs is not None else "0"
    more = " LEFT JOIN {hubs} h ON e.v = h.v" if hubs is not None else ""
    ways = "SELECT e.* FROM (SELECT explode(array(struct(a AS v, b AS w, sa AS sv, sb AS sw), struct(b AS v, a AS w, sb AS sv, sa AS sw))) AS e FROM {links})"
    steps = [f"arcs AS (SELECT e.v, e.w, e.sv, e.sw, {salt} AS z FROM ({ways}) e{more})"]
    steps.append(f"s1 AS (SELECT w AS v, min(sv + {step}) AS s FROM arcs WHERE sv + {step} < sw GROUP BY w)")
    for k in range(2, hops + 1):
        met, on, hint = f"s{k - 1}", "a.v = m.v", "/*+ SHUFFLE_HASH(m) */ " if alone else ""
        if hubs is not None:
            met = f"(SELECT e.v, s, explode(sequence(0, coalesce(salts, 1) - 1)) AS z FROM s{k - 1} e{more})"
            on += " AND a.z = m.z"
        sent = f"SELECT {hint}a.w, a.sw, coalesce(m.s, a.sv) + {step} AS s FROM arcs a LEFT JOIN {met} m ON {on}"
        steps.append(f"s{k} AS (SELECT w AS v, min(s) AS s FROM ({sent}) WHERE s < sw GROUP BY w)")
    text = f"WITH {', '.join(steps)} SELECT v, s & {(1 << CENTRE_BITS) - 1}L AS c FROM s{hops}"
    return links.sparkSession.sql(text, links=links, **({"hubs": hubs} if hubs is not None else {}))


def contract(links: DataFrame, joined: DataFrame, hubs: DataFrame | None = None, alone: bool = False) -> DataFrame:
    """Links (a, b, level) between the clusters."""
    links = links.select("a", "b", "level")
    for side in ("a", "b"):
        centre = joined.select(F.col("v").alias(side), F.col("c").alias("_c"))
        links = attach(links, side, centre, hubs, alone).withColumn(side, F.coalesce("_c", side)).drop("_c")
    return links


def hub_salts(links: DataFrame, hub_links: int = HUB_LINKS) -> DataFrame:
    """(v, salts) of records with more than ``hub_links`` links."""
    ends = links.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return ends.where(F.col("n") > hub_links).select("v", F.ceil(F.col("n") / hub_links).cast("int").alias("salts"))


def groups(
    pairs: DataFrame, left: str, right: str, linked: Column, beta: float = BETA, hops: int = HOPS, hub_links: int = HUB_LINKS,
    links_per_task: int = LINKS_PER_TASK,
) -> DataFrame:
    """(debugid, group_id) of every id that ``left`` or ``right`` names."""
    spark = pairs.sparkSession
    if int(spark.conf.get("spark.sql.shuffle.partitions")) > TURNS:
        raise ValueError(f"more than {TURNS} shuffle partitions")
    scratch = Scratch(spark)
    rows = pairs.select(record_key(left).alias("a"), record_key(right).alias("b"), F.coalesce(linked, F.lit(False)).alias("on"))
    ids = rows.select(F.explode(F.array("a", "b")).alias("id")).where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    row = F.monotonically_increasing_id()
    number = F.shiftright(row, 33) + row.bitwiseAND(F.lit((1 << 33) - 1)) * TURNS
    ids = scratch.keep(ids.select("id", "n", number.alias("v")))
    salts = F.ceil(F.col("n") / hub_links).cast("int").alias("salts")
    busy = scratch.keep(ids.where(F.col("n") > hub_links).select("id", salts))
    busy = None if busy.isEmpty() else busy
    links = rows.where(F.col("on") & (F.col("a") != F.col("b"))).select("a", "b", F.lit(0).alias("level"))
    for side in ("a", "b"):
        links = attach(links, side, ids.select(F.col("id").alias(side), F.col("v").alias("_v")), busy).withColumn(side, F.col("_v")).drop("_v")
    links = scratch.keep(_once(links, beta, hops))
    levels: list[DataFrame] = []
    while n := links.count():
        alone = n <= links_per_task
        # A hub has more than hub_links links, so there is none to look for among fewer.
        hubs = scratch.keep(hub_salts(links, hub_links)) if n > hub_links and not alone else None
        hubs = None if hubs is None or hubs.isEmpty() else hubs
        here = links.coalesce(1) if alone else links
        joined = scratch.keep(decompose(here, hops, hubs, alone))
        levels.append(joined)
        fewer = scratch.keep(_once(contract(here, joined.coalesce(1) if alone else joined, hubs, alone), beta, hops))
        scratch.drop(links)
        links = fewer
    if not levels:
        return ids.select(F.col("id").alias("debugid"), F.col("id").alias("group_id"))
    # A centre is in its own cluster, so what a level moves, the levels after it no longer hold.
    final = levels[-1].select("v", F.col("c").alias("top"))
    for below in reversed(levels[:-1]):
        up = final.select(F.col("v").alias("c"), "top")
        final = scratch.keep(below.join(up, "c", "left").select("v", F.coalesce("top", "c").alias("top")).unionByName(final))
    named = scratch.keep(ids.select("id", "v").join(final, "v", "left").select("id", F.coalesce("top", "v").alias("top")))
    first = scratch.keep(named.groupBy("top").agg(F.min("id").alias("group_id")))
    return named.join(first, "top").select(F.col("id").alias("debugid"), "group_id")
