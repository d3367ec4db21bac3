"""Helpers that every operator shares: table access, name comparison, lineage cuts."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Unicode White_Space as the body of a Java or Python character class.
BLANKS = (
    r"\t-\r \x85\xa0"
    + "".join(map(chr, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
    + f"{chr(0x2000)}-{chr(0x200A)}"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def squeeze(c: Column | str) -> Column:
    """Outer blanks off, inner runs of blanks to one space; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, f"[{BLANKS}]+", " "))


def name_key(c: Column | str) -> Column:
    """Form in which names compare: squeezed and in lower case. Blank names become null."""
    k = F.lower(squeeze(c))
    return F.when(k != "", k)


def trim_blanks(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{BLANKS}]+|[{BLANKS}]+$", "")


def position_ok(lon: Column, lat: Column) -> Column:
    """True for a usable position: both present, inside the globe and not 0/0."""
    ok = lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0) & ~((lon == 0.0) & (lat == 0.0))
    return F.coalesce(ok, F.lit(False))


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share. On a cluster it must be set; a local session gets one of its own."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="terraloom-")
    atexit.register(shutil.rmtree, own, True)
    sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get()


def store(spark: SparkSession, name: str, data: bytes) -> str:
    """Writes a file to the shared folder and gives its path."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    stream.write(bytearray(data))
    stream.close()
    return path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which need not have it installed; once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent).as_posix())
    spark.sparkContext.addPyFile(store(spark, f"terraloom-{uuid.uuid4().hex}.zip", packed.getvalue()))
    _SHIPPED.add(app)


class Scratch:
    """Tables written to the shared folder so that a plan can start afresh from them.

    They outlive a lost executor. ``drop`` removes one that no later plan reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.hadoop = spark._jsc.hadoopConfiguration()
        self.root = f"{shared_dir(spark).rstrip('/')}/terraloom-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self.made = 0
        atexit.register(self.clear)

    def clear(self) -> None:
        """Removes everything written here; runs at the end of the driver's process, if its JVM is still there."""
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.hadoop).delete(p, True)

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/t{self.made}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path:
            self._delete(path)
