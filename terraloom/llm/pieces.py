"""Cuts oversized documents into pieces at the boundaries of the page and of its topics.

Lines are the units of cohesion: for each gap between lines, the word counts of the ``BLOCK`` lines on either side
are compared by cosine, and a gap's depth is how far its similarity lies below the highest ones within ``REACH``
gaps to the left and right. A piece ends at the deepest valley between ``FILL`` of the limit and the limit: among
breaks of the page itself (blank lines, form feeds) if the window holds any, else among line ends, else at the last
word end, and inside a word only where a single run of characters fills the window. The next piece starts
``overlap`` tokens before that. Words are numbered and counted exactly. In a document without lines sentences are the
units, and in one without those either, runs of ``WORDS`` units.

Defined results: documents of at most the limit give no piece, nor do null and empty texts; every token is in a
piece; consecutive pieces share exactly ``overlap`` tokens; ``text`` is the characters of the tokens, and a character whose
bytes a cut divides is in both pieces. ``ends_at`` says at what a piece ends: page, line, sentence, word, token or end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.encode import TOKENIZERS, chunks, worker_encoder
from terraloom.llm.units import UnitEncoder

BLOCK, REACH, FILL, WORDS = 6, 10, 0.5, 12
#: First character of the scripts that are written without blanks between words.
UNSPACED = 0x2E80
_LINE, _PAGE, _FEED, _SENTENCE = 1, 2, 4, 8
#: Numbers of the words in the memory of this worker's encoder; emptied with it.
_WORDS: dict[str, int] = {}


def forget_words() -> None:
    _WORDS.clear()


def describe(units: list[str]) -> np.ndarray:
    """Bits 0-3: holds a line end, is a break of the page, starts with a form feed, ends a sentence; above: number of the word from 1, 0 for none."""
    out = np.zeros(len(units), np.int64)
    for k, u in enumerate(units):
        word = "".join(filter(str.isalnum, u)).casefold()
        # Short words of alphabets are mostly particles; scripts without blanks between words have none that are too short to count.
        term = _WORDS.setdefault(word, len(_WORDS) + 1) if len(word) > 3 or (word and ord(max(word)) >= UNSPACED) else 0
        flags = _LINE * ("\n" in u) | _PAGE * (u.count("\n") > 1 or (u.isspace() and "\x0c" in u)) | _FEED * (u[0] == "\x0c")
        flags |= _SENTENCE * u.rstrip("\"')]").endswith((".", "!", "?", chr(0x3002)))
        out[k] = term << 4 | flags
    return out


def likeness(terms: np.ndarray, line: np.ndarray, n_lines: int) -> np.ndarray:
    """Cosine of the exact word counts of the blocks on either side of each gap, from the products of nearby lines."""
    width = n_lines + 2 * BLOCK
    keys, n = np.unique(terms * width + line, return_counts=True)
    at = keys % width
    same = np.zeros((2 * BLOCK, n_lines + 2 * BLOCK), np.int64)  # same[k, BLOCK + i]: product of lines i and i + k
    for k in range(2 * BLOCK if len(keys) else 0):
        to = np.minimum(np.searchsorted(keys, keys + k), len(keys) - 1)
        hit = keys[to] == keys + k
        np.add.at(same[k], BLOCK + at[hit], n[hit] * n[to[hit]])
    size = n_lines + BLOCK
    norm = np.zeros(size, np.int64)  # of the block that starts at line i - BLOCK
    for i in range(BLOCK):
        for j in range(i, BLOCK):
            norm += same[j - i, i : i + size] * (1 if i == j else 2)
    gap = np.arange(1, n_lines)
    both = np.zeros(len(gap), np.int64)
    for a in range(1, BLOCK + 1):
        both += same[a : a + BLOCK, BLOCK + gap - a].sum(axis=0)
    return both / np.maximum(np.sqrt(norm[gap].astype(float) * norm[gap + BLOCK]), 1e-9)


def depths(notes: np.ndarray, line: np.ndarray, n_lines: int) -> np.ndarray:
    """Depth of the valley at each gap between consecutive lines."""
    terms = notes >> 4
    has = terms > 0
    alike = likeness(terms[has], line[has], n_lines)
    padded = np.concatenate([np.full(REACH, -1.0), alike, np.full(REACH, -1.0)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, REACH + 1)
    peak_left, peak_right = windows[: len(alike)].max(axis=1), windows[REACH:].max(axis=1)
    return peak_left + peak_right - 2 * alike


class Page:
    """One document as units, with its gaps between lines."""

    def __init__(self, enc: UnitEncoder, units: np.ndarray):
        self.enc, self.units = enc, units
        self.tokens = np.concatenate([[0], np.cumsum(enc.counts[units])])
        self.chars = np.concatenate([[0], np.cumsum(enc.nchars[units])])
        notes = enc.notes[units]
        ends = (notes & _LINE) > 0
        is_gap = ends[:-1] & ~ends[1:] if len(units) > 1 else np.zeros(0, bool)
        at, self.kind = np.flatnonzero(is_gap) + 1, "line"  # units before which a line starts
        if not len(at):
            at, self.kind = np.flatnonzero((notes[:-1] & _SENTENCE) > 0) + 1, "sentence"
        if not len(at):
            at, self.kind = np.arange(WORDS, len(units), WORDS), "word"
        line = np.zeros(len(units), np.int64)
        line[at] = 1
        line = np.cumsum(line)
        before = np.maximum(at - 2, 0)
        self.hard = ((notes[at - 1] & _PAGE) > 0) | ((notes[at] & _FEED) > 0) | (ends[before] & (at > 1))
        self.depth = depths(notes, line, len(at) + 1) if len(at) else np.zeros(0)
        self.at = self.tokens[at]

    def cuts(self, limit: int, overlap: int) -> Iterator[tuple[int, int, str]]:
        """(first token, end token, what it ends at) of each piece."""
        start, total = 0, int(self.tokens[-1])
        while total - start > limit:
            lo, hi = start + max(int(FILL * limit), overlap + 1), start + limit
            i, j = np.searchsorted(self.at, lo, "left"), np.searchsorted(self.at, hi, "right")
            if i < j:
                pick, kind = np.arange(i, j), self.kind
                if self.hard[i:j].any():
                    pick, kind = pick[self.hard[i:j]], "page"
                depth = self.depth[pick]
                end = int(self.at[pick[len(pick) - 1 - int(depth[::-1].argmax())]])
            else:
                k = int(np.searchsorted(self.tokens, hi, "right")) - 1
                end, kind = (int(self.tokens[k]), "word") if self.tokens[k] >= lo else (hi, "token")
            yield start, end, kind
            start = end - overlap
        yield start, total, "end"

    def char_at(self, text: str, token: int, up: bool, lengths: np.ndarray) -> int:
        """Place in ``text`` where a token starts; inside a character, its start or (``up``) its end."""
        k = int(np.searchsorted(self.tokens, token, "right")) - 1
        base, inner = int(self.chars[k]), token - int(self.tokens[k])
        if not inner:
            return base
        unit = int(self.units[k])
        first = int(self.enc.starts[unit])
        n = int(lengths[self.enc.flat[first : first + inner]].sum())
        raw = text[base : int(self.chars[k + 1])].encode("utf-8", "replace")
        whole = len(raw[:n].decode("utf-8", "ignore"))
        split = n < len(raw) and raw[n] & 0xC0 == 0x80
        return base + whole + (up and split)


def split_oversized(docs: DataFrame, limits: list[tuple[int, int]], name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(limit_tokens, doc_id, piece_no, start_token, n_tokens, ends_at, start_char, text) for each (limit, overlap) of ``limits``.

    ``start_char`` counts the characters before the piece.
    """
    for limit, overlap in limits:
        if overlap < 0 or limit <= 2 * overlap:
            raise ValueError(f"an overlap of {overlap} leaves no progress in pieces of {limit}")
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string()]
    names = ["limit_tokens", "doc_id", "piece_no", "start_token", "n_tokens", "ends_at", "start_char", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder("tiktoken", folder, name, describe)
        lengths = np.zeros(max(enc.ranks.values()) + 1, np.int64)
        for token, k in enc.ranks.items():
            lengths[k] = len(token)
        least = min(limit for limit, _ in limits)
        for whole in batches:
            for b in chunks(whole, 1):
                texts = b.column(1).to_pylist()
                if enc.chars > enc.most_chars:  # it starts afresh with these texts
                    forget_words()
                units, sizes = enc.numbered(texts)
                ends = np.cumsum(sizes)
                rows = []
                for doc_id, text, a, z in zip(b.column(0).to_pylist(), texts, ends - sizes, ends, strict=True):
                    if int(enc.counts[units[a:z]].sum()) <= least:
                        continue
                    page = Page(enc, units[a:z])
                    for limit, overlap in limits:
                        if page.tokens[-1] <= limit:
                            continue
                        for no, (s, e, kind) in enumerate(page.cuts(limit, overlap)):
                            first = page.char_at(text, s, False, lengths)
                            rows.append((limit, doc_id, no, s, e - s, kind, first, text[first : page.char_at(text, e, True, lengths)]))
                if rows:
                    cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    schema = "limit_tokens int, doc_id bigint, piece_no int, start_token int, n_tokens int, ends_at string, start_char int, text string"
    return src.mapInArrow(run, schema)
