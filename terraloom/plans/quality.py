"""Queries of the general data problems (packed fields, profiles, proximity) over the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.common import name_key, table
from terraloom.operators.packed import split_packed, vocabulary
from terraloom.operators.profile import Form, column_profile, footer_profile, load_profile, make_up, shifts, violations
from terraloom.operators.proximity import locate, near_counts, near_pairs

#: Admissible entries of the profiled columns.
NW_FORMS = {
    "edgeacc_m": Form(lo=1.0, hi=5000.0),
    "depthcat": Form(values=("Land", "Surface", "Intertidal", "Very Shallow", "Shallow", "Deep")),
    "typeconf": Form(values=("Very Low", "Low", "Medium", "High")),
}
#: Natures of the seabed that count as reef-like.
REEF_LIKE = ("coral", "sand/mud/coral", "rock", "stone")
NEAR_M = 250.0
MOST_CHANGE = 0.25


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    nw = table(spark, sf_dir, "nw_features")
    broken = violations(spark, nw, "row_id", "load_id", NW_FORMS).select(F.lit("value").alias("kind"), "load_id", "col", "row_id")
    moved = shifts(make_up(nw, "row_id", "load_id", "load_no", NW_FORMS)).where(F.col("change") > MOST_CHANGE)
    return broken.unionByName(
        moved.select(F.lit("shift").alias("kind"), "load_id", "col", F.lit(0).cast("bigint").alias("row_id"))
    )


def p2_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the large tables by load; tables without loads by the day of delivery."""
    day = F.to_date("loaded_at")
    by_day = F.coalesce(day.cast("string"), F.lit("")), F.coalesce(F.unix_date(day), F.lit(-1))
    parts = [
        column_profile(table(spark, sf_dir, "nw_features"), "row_id", F.col("load_id"), F.col("load_no"), NW_FORMS).withColumn("tab", F.lit("nw_features")),
        column_profile(table(spark, sf_dir, "match_lines"), "line_id", *by_day, {}).withColumn("tab", F.lit("match_lines")),
        column_profile(table(spark, sf_dir, "position_error"), "err_id", *by_day, {}).withColumn("tab", F.lit("position_error")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admissible entries of the three columns with a form; ``p2_columns`` has all columns and all entries."""
    return load_profile(table(spark, sf_dir, "nw_features"), "row_id", "load_id", "load_no", NW_FORMS)


def p2_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["col", "n_rows", "n_nulls", "n_distinct", "lo", "hi", "lo_num", "hi_num"]
    parts = [
        footer_profile(spark, table(spark, sf_dir, t)).select(F.lit(t).alias("tab"), *cols)
        for t in ("nw_features", "match_lines", "position_error")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = vocabulary(table(spark, sf_dir, "nw_features"), "rb_type_l3")
    crosswalk, l2 = table(spark, sf_dir, "rb_type_l3_crosswalk"), table(spark, sf_dir, "reef_l2")
    parts = [
        split_packed(crosswalk, "cw_id", f, names).withColumn("tab", F.lit("rb_type_l3_crosswalk"))
        for f in ("rb_type_l3_v0_3", "attachment_v0_4")
    ]
    parts.append(split_packed(l2, "l2_id", "rb_l3_agg", names).withColumn("tab", F.lit("reef_l2")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("tab", "row_key", "field", "pos", "val")


def _reef_like(ahs: DataFrame) -> DataFrame:
    return ahs.where(F.regexp_replace(name_key("native_cl"), " ?/ ?", "/").isin(*REEF_LIKE))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_pairs(_reef_like(table(spark, sf_dir, "ahs_features")), "ahs_id", "lon", "lat", NEAR_M)
    inside = locate(
        table(spark, sf_dir, "position_error"), "err_id", "actlon", "actlat",
        table(spark, sf_dir, "validation_regions"), "regionid", "wkt",
    )
    return near.select(F.lit("near").alias("kind"), "key_a", "key_b").unionByName(
        inside.select(F.lit("in").alias("kind"), "key_a", F.col("regionid").alias("key_b"))
    )


def p4_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reef-like features by place, with the number of other places close to theirs."""
    ahs = table(spark, sf_dir, "ahs_features")
    return near_counts(_reef_like(ahs), "ahs_id", "lon", "lat", NEAR_M).withColumnRenamed("id", "ahs_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_columns, p2_profile, p2_footers, p3_found, p4_found, p4_places)}

_KEY = r"nullif(lower(trim(regexp_replace({c}, '[\s\x{{85}}\x{{A0}}\x{{3000}}]+', ' ', 'g'))), '')"


def _label(col: str) -> str:
    key = _KEY.format(c=col)
    form = NW_FORMS[col]
    if form.values:
        good = f"CASE WHEN {key} IN ({', '.join(repr(v.lower()) for v in form.values)}) THEN 'v:' || {key} END"
    else:
        number = f"CASE WHEN regexp_full_match(trim({col}), '[0-9]+([.][0-9]+)?') THEN CAST(trim({col}) AS DOUBLE) END"
        good = f"CASE WHEN {number} BETWEEN {form.lo} AND {form.hi} THEN 'v:' || CAST({number} AS VARCHAR) END"
    return f"CASE WHEN {key} IS NULL OR {key} IN ('na', 'nan') THEN 'm' ELSE coalesce({good}, 'o') END"


_LABELS = "\nUNION ALL\n".join(
    f"SELECT load_no, load_id, '{c}' AS col, row_id, {_label(c)} AS label FROM (SELECT DISTINCT row_id, load_no, load_id, {c} FROM nw_features)"
    for c in NW_FORMS
)
_SHIFTS = f"""labels AS ({_LABELS}),
made AS (SELECT col, load_no, load_id, label, count(*) AS n FROM labels GROUP BY ALL),
total AS (SELECT col, load_no, load_id, sum(n) AS rows FROM made GROUP BY ALL),
ordered AS (SELECT *, lag(load_no) OVER w AS prev, lag(rows) OVER w AS prev_rows FROM total WINDOW w AS (PARTITION BY col ORDER BY load_no)),
both_loads AS (
  SELECT m.col, m.load_no, m.label, m.n / o.rows AS s FROM made m JOIN ordered o USING (col, load_no)
  UNION ALL
  SELECT m.col, o.load_no, m.label, -m.n / o.prev_rows FROM made m JOIN ordered o ON o.col = m.col AND o.prev = m.load_no),
moved AS (
  SELECT col, load_no, sum(abs(d)) / 2 AS change
  FROM (SELECT col, load_no, label, sum(s) AS d FROM both_loads GROUP BY ALL) GROUP BY ALL)"""

_FLAT = {
    "nw_features": (
        "row_id fid load_no area_km2 lon lat",
        "debugid load_id loaded_at regionname rb_type_l3 attachment featconf typeconf depthcat depthcatsr edgesrc edgeacc_m",
    ),
    "match_lines": ("line_id fid sid dist_m edgeacc_m x0 y0 x1 y1", "run_day loaded_at"),
    "position_error": ("err_id validid actlon actlat matchlon matchlat error_m edgeacc_m", "assessment matchfnd regionname observed_at loaded_at"),
}


def _footer_row(tab: str, col: str, number: bool) -> str:
    ends = [f"{f}(CAST({col} AS DOUBLE)) FILTER (WHERE NOT isnan(CAST({col} AS DOUBLE)))" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max")]
    form = lambda f: f"strftime({f}({col}), '%Y-%m-%d %H:%M:%S.%f')" if col in ("loaded_at", "observed_at") else f"CAST({f}({col}) AS VARCHAR)"
    texts = [f"CAST({'NULL' if number else form(f)} AS VARCHAR)" for f in ("min", "max")]
    return (
        f"SELECT '{tab}' AS tab, '{col}' AS col, count(*) AS n_rows, count(*) - count({col}) AS n_nulls, "
        f"count(DISTINCT {col}) AS n_distinct, {texts[0]} AS lo, {texts[1]} AS hi, {ends[0]} AS lo_num, {ends[1]} AS hi_num FROM {tab}"
    )


_NEAR = f"""pts AS (
  SELECT ahs_id, any_value(lon) AS x, any_value(lat) AS y FROM ahs_features
  WHERE regexp_replace({_KEY.format(c="native_cl")}, ' ?/ ?', '/', 'g') IN ({", ".join(map(repr, REEF_LIKE))})
    AND lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AND NOT (lon = 0 AND lat = 0) GROUP BY ahs_id),
near AS (
  SELECT a.ahs_id AS key_a, b.ahs_id AS key_b FROM pts a JOIN pts b
    ON a.ahs_id < b.ahs_id AND b.y BETWEEN a.y - 0.003 AND a.y + 0.003
  WHERE 2 * 6371008.8 * asin(sqrt(least(1, pow(sin(radians(b.y - a.y) / 2), 2)
    + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= {NEAR_M})"""

SQL = {
    "p4_places": f"""WITH {_NEAR}, spot AS (SELECT x, y, min(ahs_id) AS place FROM pts GROUP BY x, y),
named AS (SELECT ahs_id, place FROM pts JOIN spot USING (x, y)),
met AS (SELECT DISTINCT a.place AS p, b.place AS q FROM near JOIN named a ON a.ahs_id = key_a JOIN named b ON b.ahs_id = key_b WHERE a.place <> b.place),
n AS (SELECT p, count(*) AS n FROM (SELECT p, q FROM met UNION SELECT q, p FROM met) GROUP BY p)
SELECT ahs_id, place, coalesce(n, 0) AS n_near FROM named LEFT JOIN n ON p = place""",
    "p2_footers": "\nUNION ALL\n".join(
        _footer_row(t, c, number) for t, kinds in _FLAT.items() for number, cols in zip((True, False), kinds, strict=True) for c in cols.split()
    ),
    "p2_found": f"""WITH {_SHIFTS}
SELECT 'value' AS kind, load_id, col, row_id FROM labels WHERE label = 'o'
UNION ALL
SELECT 'shift', o.load_id, o.col, 0 FROM moved JOIN ordered o USING (col, load_no) WHERE o.prev IS NOT NULL AND change > {MOST_CHANGE}""",
    "p2_profile": f"""WITH {_SHIFTS}
SELECT m.col, m.load_no, m.load_id, CAST(sum(n) AS BIGINT) AS n_rows,
  CAST(coalesce(sum(n) FILTER (WHERE label = 'm'), 0) AS BIGINT) AS n_missing,
  CAST(coalesce(sum(n) FILTER (WHERE label = 'o'), 0) AS BIGINT) AS n_broken,
  count(*) FILTER (WHERE label LIKE 'v:%') AS n_values,
  min(TRY_CAST(substr(label, 3) AS DOUBLE)) AS lo, max(TRY_CAST(substr(label, 3) AS DOUBLE)) AS hi,
  any_value(CASE WHEN o.prev IS NOT NULL THEN round(change, 9) END) AS change
FROM made m JOIN ordered o USING (col, load_no) LEFT JOIN moved v USING (col, load_no) GROUP BY m.col, m.load_no, m.load_id""",
    "p4_found": f"""WITH {_NEAR},
rings AS (SELECT DISTINCT regionid, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS body FROM validation_regions),
vertices AS (SELECT regionid, body, generate_subscripts(string_split(body, ','), 1) AS k, unnest(string_split(body, ',')) AS v FROM rings),
ends AS (SELECT regionid, body, k, CAST(string_split(trim(v), ' ')[1] AS DOUBLE) AS x, CAST(string_split(trim(v), ' ')[2] AS DOUBLE) AS y FROM vertices),
edges AS (SELECT regionid, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM ends WINDOW w AS (PARTITION BY regionid, body ORDER BY k)),
spots AS (SELECT DISTINCT err_id, actlon AS x, actlat AS y FROM position_error
  WHERE actlon BETWEEN -180 AND 180 AND actlat BETWEEN -90 AND 90 AND NOT (actlon = 0 AND actlat = 0))
SELECT 'near' AS kind, key_a, key_b FROM near
UNION ALL
SELECT 'in', err_id, regionid FROM spots s JOIN edges e ON (e.x1 <= s.x) <> (e.x2 <= s.x)
  AND e.y1 + (s.x - e.x1) / (e.x2 - e.x1) * (e.y2 - e.y1) <= s.y
GROUP BY err_id, regionid HAVING count(*) % 2 = 1""",
}
