"""Fills containers of fixed capacity with whole documents.

Sizes are vectors: tokens, one segment, and loss-bearing tokens (those with a letter or digit; layout blanks and
punctuation bear no loss). A container is filled by the dot-product heuristic: of the examples that fit in every
dimension, the one whose demand has the largest dot product with what is left of the container goes in next,
both as shares of the capacity. Examples are dealt by id into shares of about ``ITEMS`` and each share is packed
by one task, so room is lost only in the last container of each share.

Defined results: a document larger than a container is cut into full pieces and a rest, each an example of its own;
no other is cut. A full piece has a container to itself. An example over the loss limit by itself goes alone and
is marked. Null
and empty texts need no room: their ``container_id`` is null. Each row is one example with its place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.encode import TOKENIZERS, chunks, worker_encoder

ITEMS = 8_000
_ITEM = "limit_tokens int, doc_id bigint, piece_no int, start_token int, n_tokens int, n_loss int"


@dataclass(frozen=True)
class Capacity:
    tokens: int
    segments: int
    loss: int

    @staticmethod
    def usual(tokens: int, tokens_a_segment: int = 16, loss_share: float = 31 / 32) -> Capacity:
        """The limits that go with a number of tokens, where the data name none: a segment for every 16 tokens, and 31/32 of the tokens with loss."""
        return Capacity(tokens, max(1, tokens // tokens_a_segment), int(tokens * loss_share))


def examples(docs: DataFrame, limits: list[int], name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """The examples of every document for each container size; one pass over the texts for all sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder("tiktoken", folder, name)
        bears = np.zeros(max(enc.ranks.values()) + 1, np.int64)
        for token, k in enc.ranks.items():
            bears[k] = any(ch.isalnum() for ch in token.decode("utf-8", "ignore"))
        for whole in batches:
            for b in chunks(whole, 1):
                units, sizes = enc.numbered(b.column(1).to_pylist())
                loss = np.concatenate([[0], np.cumsum(bears[enc.gather(units)])])
                upto = np.concatenate([[0], np.cumsum(enc.counts[units])])[np.concatenate([[0], np.cumsum(sizes)])]
                first, total = upto[:-1], np.diff(upto)
                ids = b.column(0).to_numpy(zero_copy_only=False)
                for limit in limits:
                    pieces = np.maximum(1, -(-total // limit))
                    row = np.repeat(np.arange(len(total)), pieces)
                    no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    start = no * limit
                    n = np.minimum(limit, total[row] - start)
                    at = first[row] + start
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), limit), pa.int32()), pa.array(ids[row], pa.int64()), pa.array(no, pa.int32()),
                            pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(loss[at + n] - loss[at], pa.int32()),
                        ],
                        ["limit_tokens", "doc_id", "piece_no", "start_token", "n_tokens", "n_loss"],
                    )

    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return src.mapInArrow(run, _ITEM)


def fill(tokens: np.ndarray, loss: np.ndarray, cap: Capacity) -> np.ndarray:
    """Container number of each example, -1 for those without tokens."""
    out = np.full(len(tokens), -1, np.int64)
    alone = (tokens >= cap.tokens) | (loss > cap.loss)
    out[alone] = np.arange(alone.sum())
    made = int(alone.sum())
    at = np.flatnonzero(~alone & (tokens > 0))
    at = at[np.lexsort((at, -loss[at], -tokens[at]))]
    t, w = tokens[at].astype(np.int64), loss[at].astype(np.int64)
    dt, dw, ds = t / cap.tokens, w / cap.loss, 1.0 / cap.segments
    live, n_live = np.ones(len(at), bool), len(at)
    while n_live:
        if n_live * 2 < len(at):
            at, t, w, dt, dw = at[live], t[live], w[live], dt[live], dw[live]
            live = np.ones(len(at), bool)
        rt, rs, rw = cap.tokens, cap.segments, cap.loss
        while rs and n_live:
            score = dt * (rt / cap.tokens) + dw * (rw / cap.loss) + ds * (rs / cap.segments)
            score[~live | (t > rt) | (w > rw)] = -1.0
            k = int(score.argmax())
            if score[k] < 0:
                break
            out[at[k]] = made
            live[k] = False
            n_live -= 1
            rt, rs, rw = rt - t[k], rs - 1, rw - w[k]
        made += 1
    return out


def pack(
    docs: DataFrame, limits: list[int], name: str = "byte_bpe_50k", folder: str = TOKENIZERS, items: int = ITEMS, capacity: Callable[[int], Capacity] = Capacity.usual
) -> DataFrame:
    """(limit_tokens, container_id, doc_id, piece_no, start_token, n_tokens, n_loss, over_loss) of every example.

    ``capacity`` gives all limits of a container from its tokens. ``over_loss`` marks an example that alone is over the loss limit.
    """
    caps = {n: capacity(n) for n in limits}
    shares = max(1, -(-docs.count() // items))
    dealt = examples(docs, limits, name, folder).withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece_no"], ignore_index=True)
        box = fill(rows.n_tokens.to_numpy(), rows.n_loss.to_numpy(), caps[int(key[0])])
        name = np.where(box < 0, None, [f"{key[0]}-{key[1]}-{k}" for k in box])
        return pd.DataFrame({"limit_tokens": rows.limit_tokens, "container_id": name, **{c: rows[c] for c in _KEPT}, "over_loss": rows.n_loss > caps[int(key[0])].loss})

    schema = "limit_tokens int, container_id string, doc_id bigint, piece_no int, start_token int, n_tokens int, n_loss int, over_loss boolean"
    return dealt.groupBy("limit_tokens", "share").applyInPandas(run, schema)


_KEPT = ["doc_id", "piece_no", "start_token", "n_tokens", "n_loss"]
