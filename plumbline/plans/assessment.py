"""Assessment of a set of tables against a rulebook: metric tables and failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import checks, coherence, dispersion, references
from plumbline.operators.checks import RowCheck, run_timestamp
from plumbline.session import checkpoint
from plumbline.sources.registry import MetricStore, ViolationStore
from plumbline.sources.unions import require_unique, union_all, union_sources


@dataclass(frozen=True)
class KeyRule:
    """`columns` should be unique over the union of `sources`."""

    sources: tuple[str, ...]
    columns: tuple[str, ...]

    @property
    def label(self) -> str:
        return "+".join(self.sources)


@dataclass(frozen=True)
class Reference:
    """Column pairs of `left` that should occur in `right`, exactly or as a contained tag."""

    left: str
    right: str
    pairs: tuple[tuple[str, str], ...]
    fuzzy: bool = False


@dataclass(frozen=True)
class ExpandedReference:
    """Parts extracted from a text column of `left` that should occur together in `right`."""

    left: str
    right: str
    column: str
    extractions: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    replacements: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Rulebook:
    row_checks: Mapping[str, Sequence[RowCheck]] = field(default_factory=dict)
    keys: Sequence[KeyRule] = ()
    references: Sequence[Reference | ExpandedReference] = ()
    variations: Mapping[str, Sequence[str]] = field(default_factory=dict)
    # (source 1, column 1, source 2, column 2)
    dispersions: Sequence[tuple[str, str, str, str]] = ()
    # source -> (min, mean, max, lowest, highest)
    ratios: Mapping[str, Sequence[tuple[str, str, str, float, float]]] = field(default_factory=dict)
    # source -> least completeness of a column
    coherence: Mapping[str, float] = field(default_factory=dict)


PERCENT_NAMES = {
    checks.COMPLETENESS: "completeness_percent",
    checks.FORMAT: "format_percent",
    checks.LABELS: "labels_percent",
}


def _key_tables(tables: Mapping[str, DataFrame], rules: Rulebook, timestamp) -> list[DataFrame]:
    by_sources: dict[tuple[str, ...], list[KeyRule]] = {}
    for rule in rules.keys:
        by_sources.setdefault(rule.sources, []).append(rule)
    parts = []
    for sources, group in by_sources.items():
        wanted = sorted({c for rule in group for c in rule.columns})
        rows = union_sources(sources, tables, "vertical_relaxed", wanted)
        parts.append(checks.uniqueness(rows, [r.columns for r in group], group[0].label, timestamp))
    return parts


def _reference_table(tables: Mapping[str, DataFrame], rule, timestamp) -> DataFrame:
    left, right, names = tables[rule.left], tables[rule.right], (rule.left, rule.right)
    if isinstance(rule, ExpandedReference):
        return references.expanded_foreign_key(
            left, right, rule.column, rule.extractions, rule.replacements, rule.keys, names, timestamp
        )
    measure = references.fuzzy_foreign_key if rule.fuzzy else references.foreign_key
    return measure(left, right, rule.pairs, names, timestamp)


def metric_tables(fused: DataFrame, metrics: set[str]) -> dict[str, DataFrame]:
    """Scores of row checks in one shape, as a table per metric."""
    out = {
        metric: fused.where(F.col("metric") == metric).select(
            "source", F.col("rule").alias("column_name"), F.col("score").alias(PERCENT_NAMES[metric]), "timestamp"
        )
        for metric in sorted(metrics & set(PERCENT_NAMES))
    }
    if checks.INTERVAL in metrics:
        out["interval"] = fused.where(F.col("metric") == checks.INTERVAL).select(
            "source",
            *(F.col("columns")[i].alias(f"column_name_{n}") for i, n in enumerate(("min", "target", "max"))),
            F.col("score").alias("interval_percent"), "timestamp",
        )
    return out


def assess(
    tables: Mapping[str, DataFrame], rules: Rulebook, at: datetime | str | None = None
) -> dict[str, DataFrame]:
    """Metric name -> metric table of this run. All share one timestamp.

    All row checks of a table are one aggregation; its few result rows are kept, so that the
    metric tables split from them cause no further scan.
    """
    timestamp = run_timestamp(at)
    out: dict[str, DataFrame] = {}
    if rules.row_checks:
        fused = checkpoint(
            union_all(
                [checks.score_checks(tables[s], list(cs), s, timestamp) for s, cs in rules.row_checks.items()]
            )
        )
        out |= metric_tables(fused, {c.metric for cs in rules.row_checks.values() for c in cs})
    if rules.keys:
        out["uniqueness"] = union_all(_key_tables(tables, rules, timestamp)).drop("columns")
    if rules.references:
        out["foreign_key"] = union_all([_reference_table(tables, r, timestamp) for r in rules.references])
    if rules.variations:
        out["variation"] = union_all(
            [dispersion.variation_table(tables[s], cs, s, timestamp) for s, cs in rules.variations.items()]
        )
    if rules.dispersions:
        out["dispersion"] = union_all(
            [
                dispersion.dispersion(tables[s1], c1, tables[s2], c2, (s1, s2), timestamp)
                for s1, c1, s2, c2 in rules.dispersions
            ]
        )
    if rules.ratios:
        out["position_ratio"] = union_all(
            [dispersion.position_ratio_table(tables[s], ts, s, timestamp) for s, ts in rules.ratios.items()]
        )
    if rules.coherence:
        out["coherence"] = union_all(
            [
                coherence.candidate_rules(coherence.analyze(tables[s], share), s, timestamp)
                for s, share in rules.coherence.items()
            ]
        )
    return out


def violations(
    tables: Mapping[str, DataFrame], rules: Rulebook, row_ids: Mapping[str, str]
) -> DataFrame:
    """(source, rule, metric, column_name, detail, row_id) of all failing rows.

    `row_ids` names the unique integer column of each source; for a key rule over several sources
    it must be unique over their union (`union_row_ids` makes it so), and is refused if it is not.
    """
    def shaped(rows: DataFrame, metric, source, column_name, detail, row_id: str) -> DataFrame:
        return rows.select(
            source.alias("source"),
            F.concat_ws(": ", metric, column_name).alias("rule"),
            metric.alias("metric"),
            column_name.alias("column_name"),
            detail.alias("detail"),
            F.col(row_id).cast("bigint").alias("row_id"),
        )

    nothing = F.lit(None).cast("string")
    column_name = F.col("column_name")
    parts = []
    for name, row_checks in rules.row_checks.items():
        rows = checks.list_violations(tables[name], list(row_checks), name, [row_ids[name]])
        parts.append(shaped(rows, F.col("metric"), F.col("source"), column_name, F.col("detail"), row_ids[name]))
    for rule in rules.keys:
        row_id = row_ids[rule.label if rule.label in row_ids else rule.sources[0]]
        rows = union_sources(rule.sources, tables, "vertical_relaxed", [*dict.fromkeys([*rule.columns, row_id])])
        if len(rule.sources) > 1:
            require_unique(rows, row_id)
        failing = checks.uniqueness_violations(rows, rule.columns, rule.label, [row_id])
        parts.append(shaped(failing, F.lit(checks.UNIQUENESS), F.col("source"), column_name, nothing, row_id))
    for rule in rules.references:
        left, right, names = tables[rule.left], tables[rule.right], (rule.left, rule.right)
        row_id = row_ids[rule.left]
        if isinstance(rule, ExpandedReference):
            failing = references.expanded_foreign_key_violations(
                left, right, rule.column, rule.extractions, rule.replacements, rule.keys, names, [row_id]
            )
        else:
            listing = (
                references.fuzzy_foreign_key_violations if rule.fuzzy else references.foreign_key_violations
            )
            failing = listing(left, right, rule.pairs, names, [row_id])
        pair = F.concat_ws(" -> ", "source_1", "source_2")
        parts.append(shaped(failing, F.lit("foreign_key"), pair, column_name, nothing, row_id))
    return union_all(parts)


def checked_rules(rules: Rulebook) -> set[tuple[str, str]]:
    """The (source, rule) pairs a run of `violations` replaces in the store."""
    pairs = {(s, f"{c.metric}: {c.rule}") for s, cs in rules.row_checks.items() for c in cs}
    pairs |= {(r.label, f"{checks.UNIQUENESS}: {checks.key_label(r.columns)}") for r in rules.keys}
    for r in rules.references:
        labels = (
            [", ".join(r.keys)] if isinstance(r, ExpandedReference) else [f"{a}, {b}" for a, b in r.pairs]
        )
        pairs |= {(f"{r.left} -> {r.right}", f"foreign_key: {label}") for label in labels}
    return pairs


def run_assessment(
    tables: Mapping[str, DataFrame],
    rules: Rulebook,
    row_ids: Mapping[str, str],
    metrics: MetricStore,
    failing: ViolationStore,
    at: datetime | str | None = None,
) -> None:
    """Measure, append the metrics to their history, replace the failing rows of what was checked."""
    for name, rows in assess(tables, rules, at).items():
        metrics.append(name, rows)
    failing.replace(violations(tables, rules, row_ids), checked_rules(rules))
