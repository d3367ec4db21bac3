"""Queries of the training-data operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.common import Scratch, name_key, table
from terraloom.llm.components import groups
from terraloom.llm.containers import Capacity, pack
from terraloom.llm.encode import decode_corpus, encode_corpus
from terraloom.llm.pieces import split_oversized
from terraloom.llm.proportional import ProportionalSample
from terraloom.llm.quantiles import EPS, exact_ranks, merge_summaries, percentiles, summaries, usable

#: Most sizes of containers or pieces; they go to every worker.
MOST_LIMITS = 100
PHIS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def _sample(spark: SparkSession, sf_dir: str) -> ProportionalSample:
    nw = table(spark, sf_dir, "nw_features")
    latest = nw.where(F.col("load_no") == nw.select(F.max("load_no")).scalar())
    return ProportionalSample(latest, table(spark, sf_dir, "sample_targets"), ["regionname", "rb_type_l3"], "fid")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).report.where(F.col("deficit") > 0).select("regionname", "rb_type_l3")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).report


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).rows


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable errors by assessment|region, the region spelled as in validation_regions."""
    named = table(spark, sf_dir, "validation_regions").select(name_key("regionname").alias("k"), F.trim("regionname").alias("region"))
    named = named.where(F.col("k").isNotNull()).groupBy("k").agg(F.min("region").alias("region"))
    err = table(spark, sf_dir, "position_error").withColumn("k", name_key("regionname"))
    err = err.where(usable(F.col("error_m")) & F.col("k").isNotNull()).join(named, "k", "left")
    region = F.coalesce("region", F.trim("regionname"))
    return err.select("err_id", "error_m", "edgeacc_m", F.concat(F.trim("assessment"), F.lit("|"), region).alias("grp"))


def _decide(bounds: DataFrame, exact: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(grp) where the left quantity is above the right one; undecided brackets are settled exactly."""
    sure = bounds.where(F.col("a_lo") > F.col("b_hi")).select("grp")
    open_ = bounds.where((F.col("a_lo") <= F.col("b_hi")) & (F.col("a_hi") > F.col("b_lo")))
    open_ = open_.where((F.col("a_lo") != F.col("a_hi")) | (F.col("b_lo") != F.col("b_hi")))
    if open_.isEmpty():
        return sure
    return sure.unionByName(exact(open_.select("grp")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "match_lines")
    fid, dist, line = F.col("fid"), F.col("dist_m"), F.col("line_id")
    edge = lines.where(F.col("edgeacc_m").isNotNull()).groupBy(fid.cast("string").alias("grp")).agg(F.max("edgeacc_m").alias("edge"))
    reach = percentiles(summaries(lines, fid, dist, line), {"a": 0.9}).join(edge, "grp")
    far = _decide(
        reach.select("grp", "a_lo", "a_hi", F.col("edge").alias("b_lo"), F.col("edge").alias("b_hi")),
        lambda todo: exact_ranks(lines, fid, dist, line, todo, 0.9).join(edge, "grp").where(F.col("exact") > F.col("edge")).select("grp"),
    )
    err = _errors(spark, sf_dir)

    def side(kind: str, value: str) -> DataFrame:
        return err.select(F.concat(F.lit(kind), F.col("grp")).alias("g"), F.col(value).alias("v"), "err_id")

    both = side("a", "error_m").unionByName(side("b", "edgeacc_m").where(F.col("v").isNotNull()))
    g, v, k = F.col("g"), F.col("v"), F.col("err_id")

    def halves(df: DataFrame, *cols: Column) -> DataFrame:
        pick = lambda s: df.where(F.col("grp").startswith(s)).select(F.expr("substring(grp, 2)").alias("grp"), *[F.col(c).alias(f"{s}_{n}") for c, n in cols])
        return pick("a").join(pick("b"), "grp")

    medians = halves(percentiles(summaries(both, g, v, k), {"m": 0.5}), ("m_lo", "lo"), ("m_hi", "hi"))

    def settle(todo: DataFrame) -> DataFrame:
        sides = todo.select(F.explode(F.array(F.concat(F.lit("a"), "grp"), F.concat(F.lit("b"), "grp"))).alias("grp"))
        exact = halves(exact_ranks(both, g, v, k, sides, 0.5), ("exact", "x"))
        return exact.where(F.col("a_x") > F.col("b_x")).select("grp")

    off = _decide(medians, settle)
    return far.select(F.lit("dist_m").alias("field"), "grp").unionByName(off.select(F.lit("error_m").alias("field"), "grp"))


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and high percentiles by reef, and by assessment and region, with the bounds they are known to lie in."""
    lines = table(spark, sf_dir, "match_lines")
    by_reef = percentiles(summaries(lines, F.col("fid"), F.col("dist_m"), F.col("line_id")), PHIS)
    by_region = percentiles(summaries(_errors(spark, sf_dir), F.col("grp"), F.col("error_m"), F.col("err_id")), PHIS)
    return by_reef.withColumn("field", F.lit("dist_m")).unionByName(by_region.withColumn("field", F.lit("error_m")))


def p5_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles by reef from summaries that were made day by day and brought together afterwards."""
    lines = table(spark, sf_dir, "match_lines").where(F.col("run_day").isNotNull())
    first = lines.select(F.min("run_day")).scalar()
    days = lines.select(F.datediff(F.max("run_day"), F.min("run_day")).alias("d")).first().d
    tagged = lines.withColumn("day", F.datediff(F.col("run_day"), first))
    daily = summaries(tagged, F.concat_ws("@", "fid", "day"), F.col("dist_m"), F.col("line_id"))
    daily = daily.withColumn("salt", F.split_part(F.col("grp"), F.lit("@"), F.lit(2)).cast("int"))
    daily = daily.withColumn("grp", F.split_part(F.col("grp"), F.lit("@"), F.lit(1)))
    return percentiles(merge_summaries(daily, (days or 0) + 1, 2 * EPS), PHIS)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "reef_touches"), "left_id", "right_id", name_key("relation").isin("touches", "intersects"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of every text after its ids have been decoded again."""
    back = decode_corpus(p7_ids(spark, sf_dir))
    return back.select("doc_id", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def _limits(spark: SparkSession, sf_dir: str, purpose: str) -> list[tuple[int, int]]:
    rows = table(spark, sf_dir, "size_limits").where((F.col("purpose") == purpose) & (F.col("tokenizer") == "byte_bpe_50k"))
    found = rows.select("limit_tokens", "overlap_tokens").distinct().limit(MOST_LIMITS + 1).collect()
    if len(found) > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} limits for {purpose}")
    return sorted((r.limit_tokens, r.overlap_tokens or 0) for r in found)


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), [n for n, _ in _limits(spark, sf_dir, "container")])


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per size of container: documents, those without tokens, and what must not be: containers over a limit, documents with gaps, small documents cut."""
    made = Scratch(spark).keep(p8_containers(spark, sf_dir).withColumn("end", F.col("start_token") + F.col("n_tokens")))
    caps = spark.createDataFrame([(n, *dataclasses.astuple(Capacity.usual(n))) for n, _ in _limits(spark, sf_dir, "container")], "limit_tokens int, t int, s int, l int")
    boxes = made.where("container_id IS NOT NULL").groupBy("limit_tokens", "container_id").agg(F.sum("n_tokens").alias("nt"), F.count(F.lit(1)).alias("ns"), F.sum("n_loss").alias("nl"), F.max("over_loss").alias("o"))
    over = (F.col("nt") > F.col("t")) | (F.col("ns") > F.col("s")) | ((F.col("nl") > F.col("l")) & ~(F.col("o") & (F.col("ns") == 1)))
    boxes = boxes.join(caps, "limit_tokens").groupBy("limit_tokens").agg(F.count_if(over).alias("n_over"))
    docs = made.groupBy("limit_tokens", "doc_id").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n_tokens").alias("n"), F.max("end").alias("end"), F.count("container_id").alias("placed"), F.count_distinct("piece_no").alias("pieces"),
    )
    gap = (F.col("n") != F.col("end")) | (F.col("k") != F.col("pieces")) | ((F.col("n") > 0) & (F.col("placed") < F.col("k")))
    docs = docs.groupBy("limit_tokens").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("n") == 0).alias("n_empty"), F.count_if(gap).alias("n_gaps"), F.count_if((F.col("k") > 1) & (F.col("n") <= F.col("limit_tokens"))).alias("n_cut")
    )
    return docs.join(boxes, "limit_tokens")


def p9_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per size of piece, what must not be: texts that are not the document's there, gaps, overlaps of another size, pieces over the limit.

    Texts are held against each other by digest, so the text of a document is moved once and that of a piece never.
    """
    cols = ["limit_tokens", "doc_id", "piece_no", "start_token", "n_tokens", "ends_at", "start_char"]
    made = Scratch(spark).keep(p9_pieces(spark, sf_dir).select(*cols, F.length("text").alias("n"), F.md5(F.col("text").cast("binary")).alias("digest")))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("whole"))
    asked = spark.createDataFrame(_limits(spark, sf_dir, "piece"), "limit_tokens int, overlap int")
    w = Window.partitionBy("limit_tokens", "doc_id").orderBy("piece_no")  # the pieces of one document
    facts = made.withColumn("z", F.col("start_char") + F.col("n")).join(docs.select("doc_id", F.length("whole").alias("size")), "doc_id").join(asked, "limit_tokens")
    facts = facts.withColumns({"before": F.lag("z").over(w), "upto": F.lag(F.col("start_token") + F.col("n_tokens")).over(w)})
    gap = F.coalesce(F.col("start_char") > F.col("before"), F.col("start_char") != 0) | ((F.col("ends_at") == "end") & (F.col("z") != F.col("size")))
    counted = facts.groupBy("limit_tokens").agg(
        F.count_if(gap).alias("n_gaps"), F.count_if(F.col("upto") - F.col("start_token") != F.col("overlap")).alias("n_overlaps"),
        F.count_if(F.col("n_tokens") > F.col("limit_tokens")).alias("n_over"),
    )
    places = made.groupBy("doc_id").agg(F.collect_list(F.struct("limit_tokens", "start_char", "n", "digest")).alias("at"))  # of one document
    there = docs.join(places, "doc_id").select("whole", F.explode("at").alias("p"))
    same = F.md5(F.expr("substring(whole, p.start_char + 1, p.n)").cast("binary")) == F.col("p.digest")
    off = there.groupBy("p.limit_tokens").agg(F.count_if(~same).alias("n_off"))
    return counted.join(off, "limit_tokens")


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "documents"), _limits(spark, sf_dir, "piece"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_report, p1_sample, p5_found, p5_percentiles, p5_days, p6_found, p7_ids, p7_round_trip, p8_containers, p8_invariants, p9_pieces, p9_invariants)
}

_KEY = "nullif(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '')"
_STRATA = f"""goal AS (
  SELECT {_KEY.format(c="regionname")} AS r, {_KEY.format(c="rb_type_l3")} AS t, min(regionname) AS regionname, min(rb_type_l3) AS rb_type_l3,
    max(greatest(min_rows, CAST(ceil(target_bp * sample_size / 10000) AS BIGINT))) AS wanted FROM sample_targets GROUP BY r, t),
seen AS (
  SELECT {_KEY.format(c="regionname")} AS r, {_KEY.format(c="rb_type_l3")} AS t, count(DISTINCT fid) AS observed
  FROM nw_features WHERE load_no = (SELECT max(load_no) FROM nw_features) GROUP BY 1, 2)"""
_USABLE = "{c} >= 0 AND isfinite({c})"

SQL: dict[str, str] = {
    "p1_found": f"WITH {_STRATA} SELECT regionname, rb_type_l3 FROM goal LEFT JOIN seen USING (r, t) WHERE coalesce(observed, 0) < wanted",
    "p1_report": f"""WITH {_STRATA} SELECT regionname, rb_type_l3, wanted, coalesce(observed, 0) AS observed,
  least(coalesce(observed, 0), wanted) AS drawn, wanted - least(coalesce(observed, 0), wanted) AS deficit,
  round_even(round(least(coalesce(observed, 0), wanted) * 10000.0 / sum(least(coalesce(observed, 0), wanted)) OVER (), 12), 4) AS reached FROM goal LEFT JOIN seen USING (r, t)""",
    "p7_round_trip": "SELECT doc_id, CAST(length(coalesce(text, '')) AS INTEGER) AS n_chars, md5(coalesce(text, '')) AS digest FROM documents",
    "p8_invariants": """SELECT limit_tokens, (SELECT count(DISTINCT doc_id) FROM documents) AS n_docs, (SELECT count(DISTINCT doc_id) FROM documents WHERE coalesce(text, '') = '') AS n_empty,
  0 AS n_gaps, 0 AS n_cut, 0 AS n_over FROM size_limits WHERE purpose = 'container' AND tokenizer = 'byte_bpe_50k' GROUP BY limit_tokens""",
    "p9_invariants": "SELECT limit_tokens, 0 AS n_off, 0 AS n_gaps, 0 AS n_overlaps, 0 AS n_over FROM size_limits WHERE purpose = 'piece' AND tokenizer = 'byte_bpe_50k' GROUP BY limit_tokens",
    "p5_found": f"""WITH once AS (SELECT DISTINCT line_id, fid, dist_m, edgeacc_m FROM match_lines),
far AS (SELECT fid FROM once GROUP BY fid
  HAVING quantile_cont(dist_m, 0.9) FILTER (WHERE {_USABLE.format(c="dist_m")}) > max(edgeacc_m)),
named AS (SELECT {_KEY.format(c="regionname")} AS k, min(regionname) AS region FROM validation_regions GROUP BY k),
err AS (SELECT DISTINCT err_id, assessment, region, error_m, e.edgeacc_m FROM position_error e JOIN named n ON {_KEY.format(c="e.regionname")} = n.k
  WHERE {_USABLE.format(c="error_m")}),
off AS (SELECT assessment || '|' || region AS grp FROM err GROUP BY grp HAVING median(error_m) > median(edgeacc_m))
SELECT 'dist_m' AS field, CAST(fid AS VARCHAR) AS grp FROM far UNION ALL SELECT 'error_m', grp FROM off""",
    "p6_found": """WITH RECURSIVE pairs AS (
  SELECT nullif(upper(trim(left_id)), '') AS a, nullif(upper(trim(right_id)), '') AS b,
    coalesce(lower(trim(relation)) IN ('touches', 'intersects'), false) AS linked FROM reef_touches),
ids AS (SELECT a AS id FROM pairs WHERE a IS NOT NULL UNION SELECT b FROM pairs WHERE b IS NOT NULL),
links AS (SELECT a, b FROM pairs WHERE linked AND a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM pairs WHERE linked AND a IS NOT NULL AND b IS NOT NULL),
reach(id, best) USING KEY (id) AS (
  SELECT id, id AS best FROM ids
  UNION
  SELECT r.id, min(n.best) FROM recurring.reach r JOIN links l ON l.a = r.id JOIN reach n ON n.id = l.b
  GROUP BY r.id, r.best HAVING min(n.best) < r.best)
SELECT id AS debugid, best AS group_id FROM reach""",
}
