"""Several values packed in one field, one row per value.

The field is read by a parsing expression grammar whose alternatives are tried in this order::

    field   <- gap (value? sep)* value? end
    value   <- (quoted / known / loose / bracketed / bare) &(gap (sep / end))
    quoted  <- '"' ('""' / [^"])* '"'  /  "'" ("''" / [^'])* "'"
    known   <- a name of the given vocabulary, any case, any run of blanks inside
    loose   <- a quote, then anything up to the first same quote that a separator or the end follows
    bracketed <- '[' [^]]* ']'  /  '{' [^}]* '}'
    bare    <- (known / any character but a separator)+
    sep     <- [;,|] / full-width semicolon / line feed / carriage return / tab / '/' between blanks

A quoted alternative that turns out not to be followed by a separator is given up and the next one is tried
from the same place; such values carry an error flag (``loose_quote``, ``open_quote``).

Defined results: null, empty and all-blank fields give no row; blank values take no position; a quoted value is
unquoted, its doubled quotes stand for one, and blanks of any kind around the value go; everything else stays
as written. Rows with the same key and text count once; so do rows without key, by text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.common import BLANKS, squeeze

#: Most names a vocabulary may hold; it is sent to every worker.
MOST_NAMES = 10_000
_B = f"[{BLANKS}]"
_GAP = rf"(?:(?![\n\r\t]){_B})*+"
_SEP = rf"[;,|\n\r\t{chr(0xFF1B)}]|(?:(?<={_B})|\A)/(?={_B}|\Z)"
_PROTECTS = re.compile(rf"[;,|/\n\r\t{chr(0xFF1B)}]")


class PackedGrammar:
    def __init__(self, names: list[str]):
        cutting = sorted({n for n in names if _PROTECTS.search(n)}, key=lambda n: (-len(n), n))
        spelled = "|".join(rf"{_B}+".join(map(re.escape, n.split())) for n in cutting)
        known = rf"(?<!\w)(?:{spelled})(?!\w)" if cutting else r"(?!)"
        follow = rf"(?={_GAP}(?:{_SEP}|\Z))"
        c = lambda p: re.compile(p, re.I | re.S)
        self.gap, self.sep = c(_GAP), c(_SEP)
        self.alternatives = [
            ("quoted", None, c(rf'"((?:""|[^"])*+)"{follow}')),
            ("quoted", None, c(rf"'((?:''|[^'])*+)'{follow}")),
            ("known", None, c(rf"({known}){follow}")),
            ("quoted", "loose_quote", c(rf'"(.*?)"{follow}')),
            ("quoted", "loose_quote", c(rf"'(.*?)'{follow}")),
            ("bracketed", None, c(rf"(\[[^]]*+\]|\{{[^}}]*+\}}){follow}")),
            ("bare", None, c(rf"((?:{known}|(?!{_SEP}).)++)")),
        ]

    def parse(self, text: str) -> list[tuple[int, str, str, str | None]]:
        """(position from 1, value, kind, error flag) of every value that is not blank."""
        out: list[tuple[int, str, str, str | None]] = []
        at, end = self.gap.match(text).end(), len(text)
        while at < end:
            if m := self.sep.match(text, at):
                at = self.gap.match(text, m.end()).end()
                continue
            for kind, flag, rule in self.alternatives:
                if not (m := rule.match(text, at)):
                    continue
                value = m[1]
                if kind == "quoted":
                    value = value.replace(text[at] * 2, text[at])
                elif kind == "bare" and value[0] in "\"'":
                    flag = "open_quote"
                if value := value.strip():
                    out.append((len(out) + 1, value, kind, flag))
                at = self.gap.match(text, m.end()).end()
                break
        return out


def vocabulary(names: DataFrame, col: str) -> list[str]:
    """Distinct names that hold a separator. Raises beyond ``MOST_NAMES``: then this isn't a value list."""
    found = (
        names.select(squeeze(col).alias("n"))
        .where(F.col("n").rlike(_PROTECTS.pattern))
        .select(F.lower("n").alias("n"))
        .distinct()
        .limit(MOST_NAMES + 1)
        .collect()
    )
    if len(found) > MOST_NAMES:
        raise ValueError(f"{col} holds more than {MOST_NAMES} names with separators")
    return [r.n for r in found]


def split_packed(df: DataFrame, key: str, field: str, names: list[str]) -> DataFrame:
    """(row_key, field, pos, val, kind, flag), one row for each value of ``field``."""
    src = (
        df.select(F.col(key).cast("bigint").alias("row_key"), F.col(field).alias("packed"))
        .where(F.col("packed").isNotNull())
        .dropDuplicates(["row_key", "packed"])
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = PackedGrammar(names)
        for b in batches:
            parsed = {t: grammar.parse(t) for t in b.packed.unique()}
            rows = [(k, field, *v) for k, t in zip(b.row_key, b.packed, strict=True) for v in parsed[t]]
            yield pd.DataFrame(rows, columns=["row_key", "field", "pos", "val", "kind", "flag"])

    return src.mapInPandas(run, "row_key bigint, field string, pos int, val string, kind string, flag string")
