"""What the footers and dictionary pages of parquet files say about each column chunk.

One task reads the footers of a share of the files. A chunk's null count and extrema are taken where the writer
stored them. Its distinct candidates are decoded from the dictionary page, of texts, numbers, dates and times, when every
data page of the chunk is dictionary-encoded; the page headers are walked for that, the data pages themselves are skipped
over. Writers may cut the extrema of long texts short, so those of texts come from the dictionary and are unknown without one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "path string, row_group int, col string, n_rows bigint, n_nulls bigint, lo string, hi string, "
    "lo_num double, hi_num double, has_nulls boolean, has_ends boolean, candidates array<string>"
)
_DICTIONARY, _DATA, _DATA_V2 = 2, 0, 3
_DICT_ENCODINGS = (2, 8)


def open_file(path: str) -> pa.NativeFile:
    filesystem, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return filesystem.open_input_file(at)


class _Compact:
    """Reader of the compact protocol, as far as page headers need it."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def varint(self) -> int:
        out = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    def signed(self) -> int:
        v = self.varint()
        return (v >> 1) ^ -(v & 1)

    def value(self, kind: int):
        if kind in (1, 2):
            return kind == 1
        if kind == 3:
            self.at += 1
            return self.data[self.at - 1]
        if kind in (4, 5, 6):
            return self.signed()
        if kind == 7:
            self.at += 8
            return None
        if kind == 8:
            n = self.varint()
            self.at += n
            if self.at > len(self.data):
                raise IndexError
            return None
        if kind == 12:
            return self.fields()
        raise ValueError(f"compact type {kind}")

    def fields(self) -> dict[int, object]:
        out: dict[int, object] = {}
        number = 0
        while True:
            head = self.data[self.at]
            self.at += 1
            if head == 0:
                return out
            number = number + (head >> 4) if head >> 4 else self.signed()
            out[number] = self.value(head & 15)


def _page(f: pa.NativeFile, at: int) -> tuple[dict, int]:
    size = 256
    while True:
        f.seek(at)
        data = f.read(size)
        try:
            r = _Compact(data)
            return r.fields(), r.at
        except IndexError:
            if len(data) < size:
                raise
            size *= 8


_NUMBERS = {"INT32": np.int32, "INT64": np.int64, "FLOAT": np.float32, "DOUBLE": np.float64}


def _decoded(raw: bytes, n: int, kind: str, to: pa.DataType) -> pa.Array | None:
    """The entries of a dictionary page."""
    if kind == "BYTE_ARRAY":
        if not (pa.types.is_string(to) or pa.types.is_large_string(to)):
            return None
        values, k = [], 0
        for _ in range(n):
            (size,) = struct.unpack_from("<I", raw, k)
            values.append(raw[k + 4 : k + 4 + size].decode("utf-8", "replace"))
            k += 4 + size
        return pa.array(values, pa.string())
    if kind not in _NUMBERS:
        return None
    numbers = pa.array(np.frombuffer(raw, _NUMBERS[kind], n))
    if pa.types.is_timestamp(to) or pa.types.is_date32(to):
        return numbers.view(to)
    return numbers if numbers.type == to else None


def dictionary_candidates(f: pa.NativeFile, chunk: pq.ColumnChunkMetaData, to: pa.DataType) -> pa.Array | None:
    """Values of the chunk's dictionary; None unless all its data pages use the dictionary."""
    if not chunk.has_dictionary_page:
        return None
    at = chunk.dictionary_page_offset
    end = at + chunk.total_compressed_size
    values: pa.Array | None = None
    while at < end:
        head, size = _page(f, at)
        kind = head[1]
        if kind == _DICTIONARY:
            f.seek(at + size)
            raw = f.read(head[3])
            if chunk.compression != "UNCOMPRESSED":
                raw = pa.Codec(chunk.compression.lower()).decompress(raw, head[2], asbytes=True)
            values = _decoded(raw, head[7][1], chunk.physical_type, to)
            if values is None:
                return None
        elif kind == _DATA and head[5][2] not in _DICT_ENCODINGS:
            return None
        elif kind == _DATA_V2 and head[8][4] not in _DICT_ENCODINGS:
            return None
        at += size + head[3]
    return values


def as_text(values: pa.Array) -> list[str]:
    """One form of each value, whether it comes from a dictionary, a footer or a data page."""
    if pa.types.is_timestamp(values.type):
        values = pc.strftime(values.cast(pa.timestamp("us")), "%Y-%m-%d %H:%M:%S")
    return values.cast(pa.string()).to_pylist()


def ends(values: pa.Array) -> tuple[str | None, str | None, float | None, float | None]:
    """(lo, hi, lo_num, hi_num): the range of texts, dates, times and truth values, or that of numbers, NaN left out."""
    kind = values.type
    if pa.types.is_floating(kind):
        values = values.filter(pc.invert(pc.is_nan(values)))
    if not len(values) or pa.types.is_nested(kind) or pa.types.is_null(kind):
        return None, None, None, None
    if pa.types.is_boolean(kind):
        texts = sorted({str(v).lower() for v in values.unique().to_pylist()})
        return texts[0], texts[-1], None, None
    mm = pc.min_max(values)
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        return None, None, float(mm["min"].as_py()), float(mm["max"].as_py())
    lo, hi = as_text(pa.array([mm["min"].as_py(), mm["max"].as_py()], kind))
    return lo, hi, None, None


def chunk_facts(path: str, cols: list[str], decode: bool) -> list[tuple]:
    out = []
    with open_file(path) as f:
        whole = pq.ParquetFile(f)
        meta, kinds = whole.metadata, {x.name: x.type for x in whole.schema_arrow}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                chunk = group.column(c)
                name = chunk.path_in_schema
                if name not in cols:
                    continue
                s = chunk.statistics
                has_null = s is not None and s.has_null_count
                try:
                    values = dictionary_candidates(f, chunk, kinds[name]) if decode else None
                except (ValueError, KeyError, TypeError, IndexError, struct.error, OSError, pa.ArrowException):
                    values = None
                none = has_null and s.null_count == group.num_rows
                if none:
                    values, found = pa.array([], kinds[name]), (None,) * 4
                elif values is not None and len(values):
                    found = ends(values)
                elif s is not None and s.has_min_max and chunk.physical_type not in ("BYTE_ARRAY", "FIXED_LEN_BYTE_ARRAY"):
                    found = ends(pa.array([s.min, s.max], kinds[name]))
                else:
                    found = None
                texts = None if values is None else as_text(values)
                out.append((path, g, name, group.num_rows, s.null_count if has_null else None, *(found or (None,) * 4), has_null, found is not None, texts))
    return out


def column_chunks(spark: SparkSession, df: DataFrame, cols: list[str], decode: bool = True, per_task: int = 8) -> DataFrame:
    """One row for each column chunk of the files behind ``df``, for ``cols``."""
    paths = sorted(df.inputFiles())
    tasks = max(1, -(-len(paths) // per_task))
    src = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "row_group", "col", "n_rows", "n_nulls", "lo", "hi", "lo_num", "hi_num", "has_nulls", "has_ends", "candidates"]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = chunk_facts(path, cols, decode)
                by_col = list(zip(*rows, strict=True)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(by_col, kinds, strict=True)], names)

    return src.mapInArrow(run, SCHEMA)
