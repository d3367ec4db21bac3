"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

``encode_corpus`` runs one pass over the texts, without a shuffle. In each Python worker the distinct words
that were not met before go to an in-process DuckDB, where a recursive query contracts every word's leftmost
pair of lowest rank until no pair is in the merge table, and an ordered aggregation gives the id lists. For words of more
than ``MANY_PAIRS`` bytes a step contracts all places of that pair, of places that overlap every other one: a pair made by a
merge ranks after it, so this is what the leftmost one at a time comes to, and a row of dots takes a dozen steps however
long it is. A word of more than ``LONG_WORD`` bytes without such repeats could still take a step for each of its pairs, all
kept in memory; it goes to the library's own encoder, which gives the same ids.

``decode_corpus`` goes back: token positions join the vocabulary, an ordered aggregation gives the bytes.

Defined results: null and empty texts give an empty list; special tokens are never formed from text. Null and empty lists
give an empty text; ids outside the vocabulary give nothing; bytes that are no text come as the replacement character.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.llm.units import UnitEncoder

TOKENIZERS = "/opt/tokenizers"
MANY_PAIRS, LONG_WORD = 64, 2048
MOST_CHARS = 4_000_000

_STEP = """
WITH RECURSIVE state(word, pos, tok, live) AS (
    SELECT word, pos, tok, true FROM symbols
  UNION ALL
    (WITH paired AS (
        SELECT s.word, s.pos, s.tok, lead(s.tok) OVER w AS nxt{index}
        FROM state s WHERE s.live WINDOW w AS (PARTITION BY s.word ORDER BY s.pos)),
     ranked AS (
        SELECT p.*, m.out_tok, {rank} AS own, min({rank}) OVER (PARTITION BY p.word) AS best
        FROM paired p LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt),
     taken AS ({taken}),
     marked AS (SELECT *, coalesce(lag(hit) OVER (PARTITION BY word ORDER BY pos), false) AS eaten FROM taken)
     SELECT word, pos, CASE WHEN hit THEN out_tok ELSE tok END AS tok, best IS NOT NULL AS live
     FROM marked WHERE NOT eaten)
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE NOT live GROUP BY word
"""
#: One pair a step, the leftmost of the lowest rank.
_ONE = _STEP.format(index="", rank="m.rank * 65536 + p.pos", taken="SELECT *, coalesce(own = best, false) AS hit FROM ranked")
#: All places of the pair of the lowest rank a step, from the left; in a run of overlapping places every other one.
_EVERY = _STEP.format(
    index=", row_number() OVER w AS idx", rank="m.rank",
    taken="""SELECT *, coalesce(own = best, false) AND (idx - max(CASE WHEN own = best THEN 0 ELSE idx END)
        OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING)) % 2 = 1 AS hit FROM ranked""",
)

_TEXTS = """
SELECT row, unhex(string_agg(spelled, '' ORDER BY pos)) AS raw
FROM (SELECT row, unnest(ids) AS tok, generate_subscripts(ids, 1) AS pos FROM given) JOIN vocabulary USING (tok) GROUP BY row
"""


class DuckMerges:
    """The merge table of a vocabulary file in an in-memory DuckDB, and the recursive query over it."""

    def __init__(self, folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
        import duckdb

        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        spelled = byte_letters()
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        raw = [tuple(bytes(map(spelled.__getitem__, x)) for x in p) for p in pairs]
        merge_table = pa.table(
            {
                "l": pa.array([ranks[a] for a, _ in raw], pa.int32()),
                "r": pa.array([ranks[b] for _, b in raw], pa.int32()),
                "out_tok": pa.array([ranks[a + b] for a, b in raw], pa.int32()),
                "rank": pa.array(range(len(raw)), pa.int64()),
            }
        )
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self.db.register("given", merge_table)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")
        self._long = None
        self.ranks = ranks

    def long_word(self, word: str) -> list[int]:
        if self._long is None:
            import tiktoken

            self._long = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})
        return self._long.encode_ordinary(word)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        raw = [w.encode("utf-8", "replace") for w in words]
        short = []
        for k, b in enumerate(raw):
            if len(b) == 1:
                out[k] = [int(self.byte_ids[b[0]])]
            elif len(b) > LONG_WORD:
                out[k] = self.long_word(words[k])
            else:
                short.append(k)
        few = [k for k in short if len(raw[k]) <= MANY_PAIRS]
        many = [k for k in short if len(raw[k]) > MANY_PAIRS]
        for words_at, step in ((few, _ONE), (many, _EVERY)):
            upto = np.concatenate([[0], np.cumsum([len(raw[k]) for k in words_at], dtype=np.int64)])
            a = 0
            while a < len(words_at):  # at most 20,000 words or 400,000 bytes at once
                z = max(a + 1, min(a + 20_000, int(np.searchsorted(upto, upto[a] + 400_000, "right")) - 1))
                self._contract(words_at[a:z], raw, step, out)
                a = z
        return out

    def _contract(self, part: list[int], raw: list[bytes], step: str, out: list[list[int]]) -> None:
        sizes = np.fromiter((len(raw[k]) for k in part), np.int64, len(part))
        data = np.frombuffer(b"".join(raw[k] for k in part), np.uint8)
        ends = np.cumsum(sizes)
        symbols = pa.table(
            {
                "word": np.repeat(np.array(part, np.int32), sizes),
                "pos": (np.arange(len(data)) - np.repeat(ends - sizes, sizes)).astype(np.int32),
                "tok": self.byte_ids[data],
            }
        )
        self.db.register("symbols", symbols)
        got = self.db.sql(step).to_arrow_table()
        self.db.unregister("symbols")
        for k, ids in zip(got["word"].to_pylist(), got["ids"].to_pylist(), strict=True):
            out[k] = ids


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level spelling: printable Latin-1 stands for itself, the rest for 256 upwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def tiktoken_words(folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """Encoder of words through the library, for operators that only need sizes."""
    import tiktoken

    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}), ranks


_WORKER: dict[tuple, UnitEncoder] = {}


def worker_encoder(kind: str, folder: str, name: str, describe=None) -> UnitEncoder:
    """One encoder per Python worker process, kept between its tasks."""
    key = (kind, folder, name, describe and describe.__name__)
    if key not in _WORKER:
        if kind == "duckdb":
            _WORKER[key] = UnitEncoder(DuckMerges(folder, name).encode_words, describe)
        else:
            enc, ranks = tiktoken_words(folder, name)
            _WORKER[key] = UnitEncoder(lambda ws: [enc.encode_ordinary(w) for w in ws], describe)
            _WORKER[key].ranks = ranks
    return _WORKER[key]


def chunks(batch: pa.RecordBatch, text_at: int, most: int = MOST_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``most`` bytes or list entries, or of one row, so that working arrays stay small."""
    column = batch.column(text_at)
    size = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    lengths = pc.fill_null(size(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS
) -> DataFrame:
    """(``id_col``, ids array<int>) of every row; other columns are neither read nor kept."""
    src = docs.select(F.col(id_col), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder("duckdb", folder, name)
        for whole in batches:
            # Many texts are learned from at once, as the recursion takes its steps anew for each lot of words; fewer are put together at once.
            for lot in chunks(whole, 1, 8 * MOST_CHARS):
                units, sizes = enc.numbered(lot.column(1).to_pylist())
                ends, at = np.cumsum(sizes), 0
                for b in chunks(lot, 1):
                    to = at + b.num_rows
                    first, some = int(ends[at - 1]) if at else 0, units[int(ends[at - 1]) if at else 0 : int(ends[to - 1])]
                    ids = enc.gather(some)
                    upto = np.concatenate([[0], np.cumsum(enc.counts[some])])
                    offsets = upto[np.concatenate([[0], ends[at:to] - first])].astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([b.column(0), lists], [id_col, "ids"])
                    at = to

    schema = T.StructType([src.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(run, schema)


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(``id_col``, text) of every row; other columns are neither read nor kept."""
    src = encoded.select(F.col(id_col), F.col(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = vocabulary_db(folder, name)
        for whole in batches:
            for b in chunks(whole, 1, 400_000):
                ids = b.column(1)
                given = pa.table({"row": pa.array(range(b.num_rows), pa.int64()), "ids": ids})
                db.register("given", given)
                got = db.sql(_TEXTS).to_arrow_table()
                db.unregister("given")
                texts = [""] * b.num_rows
                for row, raw in zip(got["row"].to_pylist(), got["raw"].to_pylist(), strict=True):
                    texts[row] = raw.decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return src.mapInArrow(run, T.StructType([src.schema[0], T.StructField("text", T.StringType())]))


_VOCABULARY: dict[tuple, object] = {}


def vocabulary_db(folder: str, name: str):
    """The spelled tokens in an in-memory DuckDB, one per Python worker."""
    if (folder, name) not in _VOCABULARY:
        import duckdb

        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            ranks = {int(b): base64.b64decode(a).hex() for a, b in map(bytes.split, f)}
        db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        db.register("given", pa.table({"tok": pa.array(ranks.keys(), pa.int32()), "spelled": pa.array(ranks.values())}))
        db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        db.unregister("given")
        _VOCABULARY[folder, name] = db
    return _VOCABULARY[folder, name]
