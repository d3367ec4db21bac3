"""Reading and writing feature layers: parquet with boxes, CSV, batches of files, empty templates, tile fetches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE = "fid bigint, geom binary, x0 double, y0 double, x1 double, y1 double"


@dataclass(frozen=True)
class Config:
    """Settings of a run: versions and named paths."""

    version: str
    previous_version: str = ""
    paths: tuple[tuple[str, str], ...] = ()

    def path(self, name: str) -> str:
        return dict(self.paths)[name].format(version=self.version, previous_version=self.previous_version)

    @staticmethod
    def from_ini(text: str) -> Config:
        import configparser

        cfg = configparser.ConfigParser()
        cfg.read_string(text)
        general = cfg["general"] if cfg.has_section("general") else {}
        paths = tuple(cfg["paths"].items()) if cfg.has_section("paths") else ()
        return Config(general.get("version", ""), general.get("previous_version", ""), paths)


def in_window(x0: float, y0: float, x1: float, y1: float) -> Column:
    """Boxes that meet the window; pushed down to parquet row groups as it compares plain columns."""
    return (F.col("x1") >= x0) & (F.col("x0") <= x1) & (F.col("y1") >= y0) & (F.col("y0") <= y1)


def read_layer(spark: SparkSession, path: str, window: tuple[float, float, float, float] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(in_window(*window)) if window else df


def write_layer(df: DataFrame, path: str, if_exists: str = "error") -> None:
    """``if_exists``: error, ignore (keep what is there) or overwrite."""
    if locked(path):
        raise BlockingIOError(f"{path} is locked")
    df.write.mode({"error": "errorifexists"}.get(if_exists, if_exists)).parquet(path)


def read_table_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Typed by ``schema``, else all text with nothing read as ''."""
    if schema:
        return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")
    return spark.read.csv(path, header=True, inferSchema=False).na.fill("")


def write_table_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").csv(path, header=True)


def read_batches(spark: SparkSession, pattern: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All files of a pattern with ``batch``, the position of the file in name order. Files are listed, not rows.

    Files without rows have a position too, where Spark lists them; those of shapefiles count as the reader lists them.
    """
    if fmt == "shapefile":
        from terraloom.sources.shapefile import list_files

        df = spark.read.format(fmt).options(**options, source="true").load(pattern).withColumnRenamed("source_file", "_file")
        names = list_files(pattern)
    else:
        df = spark.read.format(fmt).options(**options).load(pattern)
        names = sorted(df.inputFiles())
        df = df.withColumn("_file", F.input_file_name())
    order = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "_file string, batch int")
    return df.join(order, "_file").drop("_file")


def require_same_crs(*layers: DataFrame) -> None:
    """Raises unless all layers with rows have one ``srid``; a layer without one is in no system."""
    found = set()
    for df in layers:
        found |= {r.srid for r in df.select("srid").distinct().limit(5).collect()}
    if len(found) > 1 or None in found:
        raise ValueError(f"coordinate systems differ or are unknown: {sorted(map(str, found))}")


def locked(path: str) -> bool:
    """Something else is writing to a local or shared folder: its lock file is there. Object stores have no locks and need none."""
    import os

    return os.path.exists(path.removeprefix("file://").rstrip("/") + ".lock")


def empty_templates(spark: SparkSession, paths: list[str], schema: str = TEMPLATE) -> None:
    """Empty layers, unless they are there already."""
    for path in paths:
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def fetched(requests: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(found, missing) of a table of fetch results; any status but 200 and 404 raises when it is reached."""
    fail = F.raise_error(F.concat(F.lit("fetch failed with status "), F.coalesce(F.col(status).cast("string"), F.lit("null"))))
    known = lambda want: F.when(F.col(status).isin(200, 404), F.col(status) == want).otherwise(fail.cast("boolean"))
    return requests.where(known(200)), requests.where(known(404))
