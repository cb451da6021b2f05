"""Text expressions: regex dialect, extraction, accent folding, tags, casts."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters of the Unicode property White_Space.
WHITESPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
COMBINING_MARKS = "[\u0300-\u036f]"

# Name, pattern of the parts of an address "City, 91000, 19 Street".
ADDRESS_PARTS = (
    ("N", r"^[^,]+,\s*\d{5},\s*(\d+)"),
    ("Nom_Rue", r"^[^,]+,\s*\d{5},\s*\d+\s+(\S.*?)\s*$"),
    ("Code_Postal", r"^[^,]+,\s*(\d{5}),\s*\d+"),
)


def java_regex(pattern: str) -> str:
    """A pattern whose classes are Unicode-aware and whose final `$` means the very end."""
    body = pattern
    if body.endswith("$") and (len(body) - len(body[:-1].rstrip("\\"))) % 2 == 1:
        body = body[:-1] + r"\z"
    return "(?U)" + body


def literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def finds(column: Column, pattern: str) -> Column:
    """True where `pattern` occurs in the value; null stays null."""
    return column.cast("string").rlike(java_regex(pattern))


def replace_literal(column: Column, pattern: str, replacement: str) -> Column:
    """Replace each match by the text itself; `$` and backslash have no meaning in it."""
    return F.regexp_replace(column, java_regex(pattern), literal_replacement(replacement))


def extract(column: Column, pattern: str) -> Column:
    """First capture group, or the whole match if the pattern has none; null without a match."""
    group = 1 if re.compile(pattern).groups else 0
    java = F.lit(java_regex(pattern))
    # regexp_extract gives '' both for "no match" and for an empty group: tell them apart.
    found = F.regexp_extract(column, java_regex(pattern), group)
    return F.when((found != "") | F.regexp_like(column, java), found)


def _accent_table() -> tuple[str, str]:
    # Latin letters (U+00C0..U+024F, U+1E00..U+1EFF) that decompose into one base letter plus marks.
    plain, folded = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = re.sub(COMBINING_MARKS, "", unicodedata.normalize("NFKD", letter))
        if base != letter and len(base) == 1:
            plain.append(letter)
            folded.append(base)
    return "".join(plain), "".join(folded)


_ACCENTED, _BASE = _accent_table()


def fold_accents(column: Column) -> Column:
    """Drop accents of Latin letters inside Catalyst; other scripts pass through."""
    return F.regexp_replace(F.translate(column, _ACCENTED, _BASE), COMBINING_MARKS, "")


@F.pandas_udf(T.StringType())
def fold_accents_any_script(values: pd.Series) -> pd.Series:
    """NFKD without combining marks for any script; Arrow-batched, use where Latin is not enough."""
    return values.str.normalize("NFKD").str.replace(COMBINING_MARKS, "", regex=True)


@dataclass(frozen=True)
class Expansion:
    """What to read out of a text: a pattern and perhaps a type per new column. Checked when built."""

    patterns: tuple[tuple[str, str], ...]
    types: Mapping[str, str | T.DataType] = field(default_factory=dict)

    def __post_init__(self) -> None:
        times = Counter(name for name, _ in self.patterns)
        faults = {
            "repeated column names": [n for n in times if times[n] > 1],
            "types for columns that are not extracted": [n for n in self.types if n not in times],
        }
        if said := "; ".join(f"{fault}: {names}" for fault, names in faults.items() if names):
            raise ValueError(said)

    def columns(self, text: Column, finish: Callable[[Column], Column]) -> dict[str, Column]:
        """The new columns by name; `finish` is applied to what a pattern finds, before the cast."""
        found = {name: finish(extract(text, pattern)) for name, pattern in self.patterns}
        return found | {name: found[name].cast(target) for name, target in self.types.items()}


def expand_column(
    df: DataFrame,
    column: str,
    extractions: Sequence[tuple[str, str]],
    replacements: Sequence[tuple[str, str]] = (),
    normalize: bool = True,
    types: Mapping[str, str | T.DataType] | None = None,
    fold: Callable[[Column], Column] = fold_accents,
) -> DataFrame:
    """Add one column per (name, pattern), taken from the text of `column`.

    `replacements` (pattern, literal text) are applied first. `normalize` upper-cases and folds
    accents. `types` casts results; under ANSI a value that does not fit raises.
    """
    wanted = Expansion(tuple(extractions), types or {})
    text = reduce(lambda so_far, change: replace_literal(so_far, *change), replacements, F.col(column))
    return df.withColumns(wanted.columns(text, (lambda v: fold(F.upper(v))) if normalize else (lambda v: v)))


def cast_columns(
    columns: Sequence[str], target: str | T.DataType, replacement: tuple[str, str] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A transform that casts `columns`, on text after replacing a pattern."""

    def cleaned(kind: T.DataType, value: Column) -> Column:
        return replace_literal(value, *replacement) if replacement and isinstance(kind, T.StringType) else value

    return lambda df: df.withColumns({c: cleaned(df.schema[c].dataType, F.col(c)).cast(target) for c in columns})


def compact(column: Column, limit: int = 64) -> Column:
    """Text for equality only: values of more than `limit` bytes give way to their SHA-256.

    Keeps long texts out of shuffles. No short value can equal a digest, which is longer.
    """
    digest = F.concat(F.lit("sha256:"), F.sha2(column, 256))
    return F.when(F.octet_length(column) > limit, digest).otherwise(column)


def compact_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` with its text columns among `columns` made compact."""
    texts = [c for c in dict.fromkeys(columns) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: compact(F.col(c)) for c in texts}) if texts else df


def strip(column: Column) -> Column:
    """Strip every Unicode blank at both ends (`trim` knows the space only)."""
    return F.btrim(column, F.lit(WHITESPACE))


def without_blanks(column: Column) -> Column:
    """Remove every Unicode blank, also inside."""
    return F.translate(column, WHITESPACE, "")


def tags(column: Column) -> Column:
    """Array of the distinct non-empty `/`-separated parts, lower-cased and stripped."""
    parts = F.transform(F.split(F.lower(column), "/"), strip)
    return F.array_distinct(F.filter(parts, lambda tag: tag != ""))
