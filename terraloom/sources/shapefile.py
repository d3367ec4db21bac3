"""Shapefile source and sink: ``spark.read.format("shapefile").load(path)`` and ``df.write.format("shapefile")``.

Reading gives the attribute columns, ``geom`` as WKB and the box x0, y0, x1, y1; one partition per .shp file. The
schema comes from the .dbf header. Writing makes one set of .shp, .shx, .dbf and .prj per partition; the WKB may
hold points, lines, polygons and their collections, one kind per partition. Z and M values are dropped.

The options ``source`` and ``crs`` add a column ``source_file`` with the path of the row's file and ``srid`` with the code of its
.prj, null where it is missing or unknown.

Defined results: null shapes and null geometries are null both ways; numbers that don't parse are null; an empty partition
writes nothing. Column names are cut to ten characters on writing, as the format has no longer ones; names that are then
equal raise, and so do texts of more than 254 bytes and numbers that don't fit their field: nothing is cut silently.
"""

from __future__ import annotations

import glob
import os
import re
import struct
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

BOX = ("x0", "y0", "x1", "y1")
Ring = list[tuple[float, float]]


def _area2(r: Ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False))


def _inside(p: tuple[float, float], r: Ring) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(r, r[1:], strict=False):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) / (y2 - y1) * (x2 - x1):
            odd = not odd
    return odd


def _pts(r: Ring) -> bytes:
    return struct.pack("<I", len(r)) + struct.pack(f"<{2 * len(r)}d", *(v for p in r for v in p))


def _head(kind: int) -> bytes:
    return struct.pack("<BI", 1, kind)


def polygon_wkb(rings: list[Ring]) -> bytes:
    """Clockwise rings are shells; a counter-clockwise one is a hole of the smallest shell around it."""
    shells = [[r] for r in rings if _area2(r) <= 0] or [[r] for r in rings]
    for hole in (r for r in rings if _area2(r) > 0 and [r] not in shells):
        around = [s for s in shells if _inside(hole[0], s[0])]
        if around:
            min(around, key=lambda s: abs(_area2(s[0]))).append(hole)
        else:
            shells.append([hole])
    polys = [_head(3) + struct.pack("<I", len(s)) + b"".join(map(_pts, s)) for s in shells]
    return polys[0] if len(polys) == 1 else _head(6) + struct.pack("<I", len(polys)) + b"".join(polys)


def _shape(data: bytes) -> tuple[bytes | None, tuple]:
    (kind,) = struct.unpack_from("<i", data)
    base = kind % 10
    if base == 1:
        x, y = struct.unpack_from("<2d", data, 4)
        return _head(1) + struct.pack("<2d", x, y), (x, y, x, y)
    if base == 8:
        (n,) = struct.unpack_from("<i", data, 36)
        pts = [struct.unpack_from("<2d", data, 40 + 16 * i) for i in range(n)]
        return _head(4) + struct.pack("<I", n) + b"".join(_head(1) + struct.pack("<2d", *p) for p in pts), struct.unpack_from("<4d", data, 4)
    if base in (3, 5):
        parts, n = struct.unpack_from("<2i", data, 36)
        starts = [*struct.unpack_from(f"<{parts}i", data, 44), n]
        at = 44 + 4 * parts
        flat = struct.unpack_from(f"<{2 * n}d", data, at)
        rings = [list(zip(flat[2 * a : 2 * b : 2], flat[2 * a + 1 : 2 * b : 2], strict=True)) for a, b in zip(starts, starts[1:], strict=False)]
        box = struct.unpack_from("<4d", data, 4)
        if base == 5:
            return polygon_wkb(rings), box
        lines = [_head(2) + _pts(r) for r in rings]
        return (lines[0] if len(lines) == 1 else _head(5) + struct.pack("<I", len(lines)) + b"".join(lines)), box
    return None, (None,) * 4


def _fields(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    with open(path, "rb") as f:
        head = f.read(32)
        n, size, width = struct.unpack("<IHH", head[4:12])
        out = []
        while (raw := f.read(32))[0] != 0x0D:
            out.append((raw[:11].split(b"\0")[0].decode("ascii", "replace"), chr(raw[11]), raw[16], raw[17]))
            if f.tell() >= size - 1:
                break
    return n, size, width, out


def _value(kind: str, digits: int, raw: bytes, encoding: str):
    text = raw.decode(encoding, "replace").strip("\0 ")
    if not text or (kind in "NF" and set(text) == {"*"}):
        return None
    if kind in "NF":
        try:
            return float(text) if digits or kind == "F" else int(text)
        except ValueError:
            return None
    if kind == "L":
        return True if text in "YyTt" else False if text in "NnFf" else None
    return text


def list_files(path: str) -> list[str]:
    at = path.removeprefix("file://")
    if os.path.isdir(at):
        return sorted(glob.glob(os.path.join(at, "*.shp")))
    return sorted(glob.glob(at))


#: Names of coordinate systems in .prj texts, in their usual spellings, and their codes.
CRS_NAMES = {
    "gcs_gda_1994": 4283, "gda94": 4283, "gcs_wgs_1984": 4326, "wgs 84": 4326, "wgs_1984_web_mercator_auxiliary_sphere": 3857, "wgs 84 / pseudo-mercator": 3857,
    "gda_1994_geoscience_australia_lambert": 3112, "gda94 / geoscience australia lambert": 3112, "gda94_geoscience_australia_lambert": 3112, "gcs_north_american_1983": 4269,
    "international terrestrial reference frame 2005": 4368, "gda2020": 7844, "gcs_gda2020": 7844,
}


def srid_of(prj: str) -> int | None:
    """Code of the outermost coordinate system of a .prj text: that of its own authority entry, else of its name."""
    text = prj.strip()
    if not text:
        return None
    if code := re.search(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]\s*\]\s*$', text, re.I):
        return int(code[1])
    name = re.match(r'\w+\["([^"]*)"', text)
    return CRS_NAMES.get(name[1].lower()) if name else None


def _srid(shp: str) -> int | None:
    at = shp[:-4] + ".prj"
    if not os.path.exists(at):
        return None
    with open(at, encoding="utf-8", errors="replace") as f:
        return srid_of(f.read())


class _Reader(DataSourceReader):
    def __init__(self, path: str, encoding: str, source: bool, crs: bool):
        self.path, self.encoding, self.source, self.crs = path, encoding, source, crs

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in list_files(self.path)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        stem = partition.value[:-4]
        _, size, width, fields = _fields(stem + ".dbf")
        more = (*([partition.value] if self.source else []), *([_srid(partition.value)] if self.crs else []))
        with open(partition.value, "rb") as shp, open(stem + ".dbf", "rb") as dbf:
            shp.seek(100)
            dbf.seek(size)
            while len(head := shp.read(8)) == 8:
                geom, box = _shape(shp.read(struct.unpack(">2i", head)[1] * 2))
                row, at, values = dbf.read(width), 1, []
                for _, kind, n, digits in fields:
                    values.append(_value(kind, digits, row[at : at + n], self.encoding))
                    at += n
                if row[:1] != b"*":
                    yield (*values, geom, *box, *more)


def _parse(wkb: bytes) -> tuple[int, list[Ring]]:
    """(shape type, rings or points) of a WKB geometry."""
    order = "<" if wkb[0] else ">"

    def read(at: int) -> tuple[int, list[Ring], int]:
        kind = struct.unpack_from(order + "I", wkb, at + 1)[0] % 1000 & 0xFF
        at += 5
        if kind == 1:
            return 1, [[struct.unpack_from(order + "2d", wkb, at)]], at + 16
        (n,) = struct.unpack_from(order + "I", wkb, at)
        at += 4
        rings: list[Ring] = []
        if kind == 2:
            flat = struct.unpack_from(f"{order}{2 * n}d", wkb, at)
            return 3, [list(zip(flat[::2], flat[1::2], strict=True))], at + 16 * n
        if kind == 3:
            for k in range(n):
                (m,) = struct.unpack_from(order + "I", wkb, at)
                flat = struct.unpack_from(f"{order}{2 * m}d", wkb, at + 4)
                ring = list(zip(flat[::2], flat[1::2], strict=True))
                rings.append(ring if (_area2(ring) <= 0) == (k == 0) else ring[::-1])
                at += 4 + 16 * m
            return 5, rings, at
        base = 0
        for _ in range(n):
            base, more, at = read(at)
            rings += more
        return (8 if base == 1 else base), rings, at

    kind, rings, _ = read(0)
    return kind, rings


class _Writer(DataSourceWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, prj: str):
        self.path, self.schema, self.prj = path.removeprefix("file://"), schema, prj
        if os.path.exists(self.path) and os.listdir(self.path) and not overwrite:
            raise FileExistsError(self.path)

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        stem = os.path.join(self.path, f"part-{TaskContext.get().partitionId():05d}")
        names = [f.name for f in self.schema if f.name not in ("geom", *BOX)]
        if len({n[:10] for n in names}) < len(names):
            raise ValueError(f"column names are equal in their first ten characters: {names}")
        kinds = {f.name: f.dataType for f in self.schema}
        shapes, records, kind = [], [], 0
        for r in rows:
            base, rings = _parse(bytes(r.geom)) if r.geom is not None else (0, [])
            kind = kind or base
            if base not in (0, kind):
                raise ValueError("one kind of geometry per partition")
            shapes.append((base, rings))
            records.append([r[n] for n in names])
        if not records:
            return WriterCommitMessage()
        self._shp(stem, shapes, kind)
        self._dbf(stem, names, kinds, records)
        if self.prj:
            with open(stem + ".prj", "w") as f:
                f.write(self.prj)
        return WriterCommitMessage()

    @staticmethod
    def _shp(stem: str, shapes: list, kind: int) -> None:
        every = [p for _, rings in shapes for r in rings for p in r] or [(0.0, 0.0)]
        xs, ys = [p[0] for p in every], [p[1] for p in every]
        bodies = []
        for base, rings in shapes:
            pts = [p for r in rings for p in r]
            if base == 0:
                bodies.append(struct.pack("<i", 0))
                continue
            box = struct.pack("<4d", min(p[0] for p in pts), min(p[1] for p in pts), max(p[0] for p in pts), max(p[1] for p in pts))
            flat = struct.pack(f"<{2 * len(pts)}d", *(v for p in pts for v in p))
            if base == 1:
                bodies.append(struct.pack("<i", 1) + flat)
            elif base == 8:
                bodies.append(struct.pack("<i", 8) + box + struct.pack("<i", len(pts)) + flat)
            else:
                starts = [sum(map(len, rings[:k])) for k in range(len(rings))]
                bodies.append(struct.pack("<i", base) + box + struct.pack("<2i", len(rings), len(pts)) + struct.pack(f"<{len(rings)}i", *starts) + flat)

        def head(words: int) -> bytes:
            return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i", 1000, kind) + struct.pack("<8d", min(xs), min(ys), max(xs), max(ys), 0, 0, 0, 0)

        with open(stem + ".shp", "wb") as shp, open(stem + ".shx", "wb") as shx:
            shp.write(head(50 + sum(4 + len(b) // 2 for b in bodies)))
            shx.write(head(50 + 4 * len(bodies)))
            at = 50
            for k, b in enumerate(bodies, 1):
                shp.write(struct.pack(">2i", k, len(b) // 2) + b)
                shx.write(struct.pack(">2i", at, len(b) // 2))
                at += 4 + len(b) // 2

    @staticmethod
    def _dbf(stem: str, names: list[str], kinds: dict, records: list) -> None:
        specs = []
        for i, n in enumerate(names):
            if isinstance(kinds[n], BooleanType):
                specs.append((n[:10], "L", 1, 0))
            elif isinstance(kinds[n], StringType):
                longest = max((len(str(r[i]).encode()) for r in records if r[i] is not None), default=1)
                specs.append((n[:10], "C", min(254, max(1, longest)), 0))
            elif isinstance(kinds[n], DoubleType):
                specs.append((n[:10], "N", 24, 15))
            else:
                specs.append((n[:10], "N", 18, 0))

        def cell(v, kind: str, size: int, digits: int) -> bytes:
            if v is None:
                return b"?" if kind == "L" else b" " * size
            if kind == "L":
                return b"T" if v else b"F"
            text = (f"{v:.{digits}f}" if digits else str(v)).encode()
            while kind == "N" and digits and len(text) > size and digits > 1:  # large numbers have fewer digits after the point
                digits -= 1
                text = f"{v:.{digits}f}".encode()
            if len(text) > size:
                raise ValueError(f"{v!r} doesn't fit a field of {size} bytes")
            return text.rjust(size) if kind == "N" else text.ljust(size)

        width = 1 + sum(s[2] for s in specs)
        with open(stem + ".dbf", "wb") as f:
            f.write(struct.pack("<4BIHH20x", 3, 124, 1, 1, len(records), 33 + 32 * len(specs), width))
            for name, kind, size, digits in specs:
                f.write(name.encode("ascii", "replace").ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([size, digits]) + b"\0" * 14)
            f.write(b"\x0d")
            for r in records:
                f.write(b" " + b"".join(cell(v, *s[1:]) for v, s in zip(r, specs, strict=True)))
            f.write(b"\x1a")


class ShapefileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> StructType:
        files = list_files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        *_, fields = _fields(files[0][:-4] + ".dbf")
        kind = {"N": LongType(), "F": DoubleType(), "L": BooleanType()}
        out = [StructField(n, DoubleType() if k in "NF" and d else kind.get(k, StringType())) for n, k, _, d in fields]
        out += [StructField("geom", BinaryType()), *[StructField(c, DoubleType()) for c in BOX]]
        out += [StructField("source_file", StringType())] if self._on("source") else []
        return StructType([*out, *([StructField("srid", LongType())] if self._on("crs") else [])])

    def _on(self, option: str) -> bool:
        return self.options.get(option, "false").lower() == "true"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("encoding", "utf-8"), self._on("source"), self._on("crs"))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], schema, overwrite, self.options.get("prj", ""))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShapefileSource)
