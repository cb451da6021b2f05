"""License scans: one Aho-Corasick automaton over the words of a text finds identifier tags and notice phrases,
and a shunting-yard parser evaluates the and/or/with expressions behind the tags.

Words are runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z; a phrase is found where its
words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_words, map_batches

# Phrases as words, and the label of each.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "mit license": "mit",
    "apache license": "apache",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons attribution": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "without express written permission": "reserved",
    "no part of this publication may be reproduced": "reserved",
    "for personal use only": "noncommercial",
    "non commercial use only": "noncommercial",
    "boost software license": "bsl",
    "artistic license": "artistic",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "isc license": "isc",
    "zlib license": "zlib",
    "sil open font license": "ofl",
    "free and unencumbered software released into the public domain": "unlicense",
    "open database license": "odbl",
    "gnu free documentation license": "gfdl",
    "microsoft public license": "ms-pl",
    "python software foundation license": "psf",
    "postgresql license": "postgresql",
    "academic free license": "afl",
    "open software license": "osl",
    "attribution sharealike": "cc-by-sa",
    "attribution noncommercial": "cc-by-nc",
    "attribution noderivatives": "cc-by-nd",
}
TAGS = ("spdx license identifier", "license expression", "license identifier")
# How much a license restricts reuse, 0 (free) to 1 (reserved).
RESTRICTION = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "0bsd": 0.0, "wtfpl": 0.0, "pddl": 0.0, "mit": 0.1, "isc": 0.1,
    "bsd": 0.1, "zlib": 0.1, "bsl": 0.1, "x11": 0.1, "ncsa": 0.1, "upl": 0.1, "curl": 0.1, "libpng": 0.1, "ntp": 0.1,
    "hpnd": 0.1, "psf": 0.1, "python": 0.1, "postgresql": 0.1, "ruby": 0.1, "unicode": 0.1, "blueoak": 0.1, "mulanpsl": 0.1,
    "apache": 0.15, "ecl": 0.15, "afl": 0.15, "artistic": 0.2, "openssl": 0.2, "php": 0.2, "zpl": 0.2, "cc-by": 0.2,
    "odc-by": 0.2, "ofl": 0.3, "ms-pl": 0.3, "mpl": 0.4, "lgpl": 0.5, "epl": 0.5, "cddl": 0.5, "cpl": 0.5, "ms-rl": 0.5,
    "cecill": 0.6, "eupl": 0.6, "osl": 0.6, "odbl": 0.5, "cc-by-sa": 0.5, "gfdl": 0.6, "gpl": 0.7, "cc-by-nd": 0.7,
    "agpl": 0.8, "sspl": 0.9, "busl": 0.9, "cc-by-nc": 0.9, "cc-by-nc-sa": 0.9, "cc-by-nc-nd": 0.95, "noncommercial": 0.9,
    "reserved": 1.0,
}
UNKNOWN = 0.6  # a tagged license that is not in the table
EXCEPTION = 0.5  # `with` an exception halves the restriction
_OPERATORS = {"or": 1, "and": 2, "with": 3}
# A tag's expression ends with its line; the words and brackets in it are its tokens.
_EXPRESSION = re.compile(r"(?:licen[sc]e[- ](?:identifier|expression))\s*:\s*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")
# What no table names is a license only if it says so itself, or has a version.
_OWN_NAME = re.compile(r"licenseref-[a-z0-9.-]+|[a-z][a-z0-9.]*(?:-[a-z][a-z0-9.]*)*-v?\d+(?:\.\d+)*(?:-[a-z0-9.]+)*")


def family(name: str) -> str:
    """`GPL-2.0-or-later` -> gpl, `GPLv3+` -> gpl, `CC-BY-SA-4.0` -> cc-by-sa; unknown names lose just their version."""
    low = re.sub(r"^([a-z]+)v(?=\d)", r"\1-", name.lower().rstrip("+."))
    if low.startswith("licenseref-"):
        return low
    known = [k for k in RESTRICTION if low == k or low.startswith(k + "-")]
    return max(known, key=len) if known else re.sub(r"-?\d[\d.]*.*$", "", low) or low


def is_license(name: str) -> bool:
    """A name of the table in any version, a reference to an own license, or a name with a version."""
    return family(name) in RESTRICTION or bool(_OWN_NAME.fullmatch(name.lower().rstrip("+.")))


@dataclass(frozen=True)
class Evaluated:
    """The licenses of an expression and how much the whole restricts reuse."""

    restriction: float
    names: frozenset[str] = field(default_factory=frozenset)


def evaluate(expression: str) -> Evaluated | None:
    """Value of an and/or/with expression: `or` lets one choose, `and` binds to both, `with` relaxes.

    `with` binds tighter than `and`, `and` tighter than `or`. Reading stops at the first word that can't
    follow or is no license (`is_license`; behind `with`, any word with "exception" in it will do); null if no
    license stands at the start. Brackets left open are closed at the end.
    """
    output: list[Evaluated] = []
    pending: list[str] = []

    def reduce_top() -> None:
        operator, right, left = pending.pop(), output.pop(), output.pop()
        if operator == "with":
            output.append(Evaluated(left.restriction * EXCEPTION, left.names))
        else:
            choose = min if operator == "or" else max
            output.append(Evaluated(choose(left.restriction, right.restriction), left.names | right.names))

    operand = True  # is a license, and not an operator, due?
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if operand and token == "(":
            pending.append(token)
        elif operand and low not in _OPERATORS and token != ")" and (
            is_license(low) or (pending[-1:] == ["with"] and "exception" in low)
        ):
            own = family(low)
            output.append(Evaluated(RESTRICTION.get(own, UNKNOWN), frozenset([own])))
            operand = False
        elif not operand and low in _OPERATORS:
            while pending and pending[-1] != "(" and _OPERATORS[pending[-1]] >= _OPERATORS[low]:
                reduce_top()
            pending.append(low)
            operand = True
        elif not operand and token == ")" and "(" in pending:
            while pending[-1] != "(":
                reduce_top()
            pending.pop()
        else:
            break
    while operand and pending:  # operators and brackets that nothing follows
        pending.pop()
        operand = bool(pending) and len(output) < 1 + sum(p != "(" for p in pending)
    while pending:
        if pending[-1] == "(":
            pending.pop()
        else:
            reduce_top()
    return output[-1] if output else None


class LicenseScanner:
    """An automaton over the phrases; `scan` reads one text."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str]) -> None:
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, str, int]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", dict.fromkeys(TAGS, ""))):
            for phrase, label in phrases.items():
                words = [w.decode() for w in ascii_words(phrase)]
                entries.setdefault(f" {' '.join(words)} ", []).append((kind, label, len(words)))
        for key, found in entries.items():
            self.automaton.add_word(key, found)
        self.automaton.make_automaton()

    def scan(self, text: str | None):
        """(n_words, n_base, first, last, base labels, labels, score); see `scan_licenses`."""
        words = ascii_words(text)
        joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        starts, base, labels, tagged = [], set(), set(), False
        blanks, counted = 0, 0  # blanks up to the place `counted`; matches come by their ends, so none is counted twice
        for end, found in self.automaton.iter(joined):
            blanks += joined.count(" ", counted, end + 1)
            counted = end + 1
            for kind, label, n in found:
                if kind == "base":
                    starts.append(blanks - n - 1)  # the phrase has a blank before each word and one at its end
                    base.add(label)
                elif kind == "notice":
                    labels.add(label)
                else:
                    tagged = True
        restriction = max((RESTRICTION.get(label, UNKNOWN) for label in base | labels), default=0.0)
        expressions = []
        if tagged:  # the words of a tag stand in the text: read what follows its colons
            for match in _EXPRESSION.finditer(text):
                value = evaluate(match[1])
                if value:
                    expressions.append(match[1].strip())
                    labels |= value.names
                    restriction = max(restriction, value.restriction)
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), restriction, expressions,
        )


def scan_licenses(
    documents: DataFrame, base: Mapping[str, str] = BASE_PHRASES, notices: Mapping[str, str] = NOTICE_PHRASES
) -> DataFrame:
    """What each whole text says about its license, one row per row of `documents`.

    doc_id; n_words; n_base: places of `base` phrases, overlapping ones too; first_word and last_word: their
    smallest and largest start in words from 0, null if none; base_labels, labels (with those of notices and tag
    expressions): distinct, sorted, comma-joined; score: restriction of the strictest, 0 if nothing is found;
    expressions: those behind tags. A null text counts as empty.
    """

    def start():
        scan = LicenseScanner(base, notices).scan

        def work(ids, texts):
            return [ids, *([*c] for c in zip(*map(scan, texts)))] if ids else [[] for _ in range(9)]

        return work

    return map_batches(
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, expressions array<string>",
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
            ("score", pa.float64()), ("expressions", pa.list_(pa.string())),
        ],
        start,
    )
