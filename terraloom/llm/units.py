"""Fast split of text into units that byte-level BPE encodes independently of each other.

The public byte-level pattern never joins characters across these cuts: before a single space that a
non-blank follows, and on both sides of a line feed within a run of at most two blanks. Texts with a longer
run of blanks, or with two at the end, are cut by one expression instead. A unit that was seen before costs
one dictionary look-up; only new units are split further and encoded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex

from terraloom.common import BLANKS as _WS

_LONG_RUN = re.compile(rf"[{_WS}]{{3}}|[{_WS}]{{2}}\Z|\x00")
_SAFE = re.compile(rf"(?<=[^{_WS}]) (?=[^{_WS}])")
#: Unit numbers held as a list before they become an array.
MOST_LISTED = 1_000_000
_GENERAL = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
#: Fixed value: the pre-tokenization of the public byte-level vocabulary, blanks spelled out.
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)


def safe_parts(text: str, most: int = 1_000_000) -> Iterator[str]:
    """The text in parts of about ``most`` characters, cut before single spaces between non-blanks only."""
    at = 0
    while len(text) - at > most and (m := _SAFE.search(text, at + most)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def split_units(text: str) -> list[str]:
    if _LONG_RUN.search(text):
        return _GENERAL.findall(text)
    return [u for u in text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if u]


class _Numbers(dict):
    """unit -> running number; unseen units get the next one."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = len(self)
        self[unit] = n
        self.new.append(unit)
        return n


class UnitEncoder:
    """Texts to token ids through a memory of units.

    ``encode_words`` gets distinct pretokens and returns their id lists. The memory starts afresh once it
    holds ``most_chars`` characters, so that it is bounded whatever the corpus holds. ``describe`` gives a
    number for each new unit, which ``notes`` keeps beside it.
    """

    def __init__(
        self, encode_words: Callable[[list[str]], list[list[int]]], describe: Callable[[list[str]], np.ndarray] | None = None,
        most_chars: int = 6_000_000,
    ):
        self.encode_words, self.describe, self.most_chars = encode_words, describe, most_chars
        self._reset()

    def _reset(self) -> None:
        self.numbers = _Numbers()
        self.chars = 0
        self.words: dict[str, list[int]] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.counts = np.zeros(1 << 14, np.int64)
        self.nchars = np.zeros(1 << 14, np.int64)
        self.notes = np.zeros(1 << 14, np.int64)
        self.used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(len(a), n - len(a)), a.dtype)])

    def _learn(self) -> None:
        new = self.numbers.new
        if not new:
            return
        split = [PRETOKEN.findall(u) for u in new]
        unseen = list({w for ws in split for w in ws} - self.words.keys())
        if unseen:
            self.words.update(zip(unseen, self.encode_words(unseen), strict=True))
        first = len(self.numbers) - len(new)
        for name in ("starts", "counts", "nchars", "notes"):
            setattr(self, name, self._room(getattr(self, name), len(self.numbers)))
        words = self.words
        ids: list[int] = []
        at = self.used
        for k, ws in enumerate(split, first):
            before = len(ids)
            for w in ws:
                ids += words[w]
            self.starts[k] = at + before
            self.counts[k] = len(ids) - before
        self.nchars[first : first + len(new)] = np.fromiter(map(len, new), np.int64, len(new))
        if self.describe:
            self.notes[first : first + len(new)] = self.describe(new)
        self.flat = self._room(self.flat, at + len(ids))
        self.flat[at : at + len(ids)] = ids
        self.used = at + len(ids)
        self.chars += int(self.nchars[first : first + len(new)].sum())
        self.numbers.new = []

    def numbered(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Unit numbers of all texts in a row, and the number of units of each text (0 for null)."""
        if self.chars > self.most_chars:
            self._reset()
        get = self.numbers.__getitem__
        blocks: list[np.ndarray] = []
        flat: list[int] = []
        sizes: list[int] = []
        for t in texts:
            n = 0
            for part in safe_parts(t) if t else ():
                before = len(flat)
                flat.extend(map(get, split_units(part)))
                n += len(flat) - before
                if len(flat) > MOST_LISTED:
                    blocks.append(np.array(flat, np.int64))
                    flat = []
            sizes.append(n)
        blocks.append(np.array(flat, np.int64))
        self._learn()
        return np.concatenate(blocks), np.array(sizes, np.int64)

    def gather(self, units: np.ndarray) -> np.ndarray:
        """Token ids of the units one after the other."""
        counts = self.counts[units]
        total = int(counts.sum())
        ends = np.cumsum(counts)
        at = np.arange(total, dtype=np.int64) + np.repeat(self.starts[units] - (ends - counts), counts)
        return self.flat[at]
