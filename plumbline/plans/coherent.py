"""Repair of coherence: leave out columns that break statistical rules, unless tables are joined by them.

Which columns are used is read from the rulebook: keys, references and the parts that are extracted for them tie columns
of tables together. A column that breaks rules and that nothing uses is dropped. One that is used cannot be dropped
without breaking what joins on it: its source is invalid, and so is every source whose keys are unique only over a union
with it, or that refers to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.operators.coherence import incoherent_columns
from plumbline.plans.assessment import ExpandedReference, Rulebook


def used_columns(rules: Rulebook) -> dict[str, set[str]]:
    """Per source, the columns that keys and references need."""
    used: dict[str, set[str]] = {}
    for key in rules.keys:
        for source in key.sources:
            used.setdefault(source, set()).update(key.columns)
    for rule in rules.references:
        left, right = used.setdefault(rule.left, set()), used.setdefault(rule.right, set())
        if isinstance(rule, ExpandedReference):
            left.add(rule.column)
            right.update(rule.keys)
        else:
            left.update(a for a, _ in rule.pairs)
            right.update(b for _, b in rule.pairs)
    return used


def dependents(rules: Rulebook) -> dict[str, set[str]]:
    """Per source, the sources that cannot be trusted without it: those that refer to it, or share a key with it."""
    found: dict[str, set[str]] = {}
    for key in rules.keys:
        for source in key.sources:
            found.setdefault(source, set()).update(set(key.sources) - {source})
    for rule in rules.references:
        found.setdefault(rule.right, set()).add(rule.left)
    return found


def closure(start: Iterable[str], edges: Mapping[str, set[str]]) -> set[str]:
    """All that can be reached."""
    found, pending = set(), list(start)
    while pending:
        source = pending.pop()
        if source not in found:
            found.add(source)
            pending += edges.get(source, ())
    return found


@dataclass(frozen=True)
class Projection:
    """The tables that stay, what was dropped from them, and why other sources are invalid."""

    tables: dict[str, DataFrame]
    dropped: dict[str, list[str]]
    broken: dict[str, list[str]]  # source -> columns in use that break rules
    invalid: set[str]


def coherent_projection(
    tables: Mapping[str, DataFrame], rules: Rulebook, analysis: DataFrame, spread: bool = True
) -> Projection:
    """`tables` without the columns that break a candidate rule of `analysis` (x, y, M1 .. M3, source) and are not in use.

    A source with such a column in use is left out, and with `spread` so is what depends on it. Only names reach the
    driver. Columns and sources that `tables` lacks are ignored.
    """
    rows = incoherent_columns(analysis).select("source", "column_name").distinct().collect()
    used = used_columns(rules)
    dropped: dict[str, list[str]] = {}
    broken: dict[str, list[str]] = {}
    for source, column in sorted(map(tuple, rows)):
        if source in tables and column in tables[source].columns:
            (broken if column in used.get(source, ()) else dropped).setdefault(source, []).append(column)
    invalid = (closure(broken, dependents(rules)) if spread else set(broken)) & set(tables)
    stay = {name: df.drop(*dropped.get(name, ())) for name, df in tables.items() if name not in invalid}
    return Projection(stay, {s: c for s, c in dropped.items() if s in stay}, broken, invalid)
