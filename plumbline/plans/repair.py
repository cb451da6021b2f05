"""Repairs in their order: conformity and heterogeneity, then uniqueness, coherence and completeness.

Every repair writes a new version of the table, never over what it reads, and promotes nothing
unless told to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.operators.conform import Step, format_repair, interval_repair
from plumbline.operators.dedup import DedupResult, deduplicate
from plumbline.operators.dependencies import EPSILON, MAX_LHS
from plumbline.operators.impute import impute
from plumbline.operators.rescale import (
    MIN_R2,
    MIN_REPAIRED,
    NO_CORRECTION,
    Triplet,
    repair_dispersion,
    repair_position_ratio,
)
from plumbline.session import Checkpoints
from plumbline.sources.tables import VersionedTable, stamp_row_id
from plumbline.sources.unions import require_unique, union_sources


@dataclass(frozen=True)
class Outcome:
    """What a repair proposes, and whether it was written."""

    frame: DataFrame
    method: str
    written: bool
    repaired: int | None = None
    total: int | None = None


def _settle(frame: DataFrame, method: str, target: VersionedTable | None, apply: bool, **counts) -> Outcome:
    written = apply and target is not None and method != NO_CORRECTION
    if written:
        target.write(frame)
    return Outcome(frame, method, written, **counts)


def repair_scale(
    left: DataFrame, right: DataFrame, column: str, known_factors: Sequence[float], closeness: float,
    min_r2: float = MIN_R2, target: VersionedTable | None = None, apply: bool = False,
) -> Outcome:
    """Bring `left` to the scale of `right`. A dry run unless `apply`; the target is `left`'s own table."""
    frame, method = repair_dispersion(left, right, column, known_factors, closeness, min_r2)
    return _settle(frame, method, target, apply)


def repair_ratio(
    df: DataFrame, triplet: Triplet, column: str, factors: Sequence[float],
    min_repaired: float = MIN_REPAIRED, target: VersionedTable | None = None, apply: bool = False,
) -> Outcome:
    frame, method, repaired, total = repair_position_ratio(df, triplet, column, factors, min_repaired)
    return _settle(frame, method, target, apply, repaired=repaired, total=total)


@dataclass(frozen=True)
class DedupSettings:
    epsilon: float = EPSILON
    max_lhs: int = MAX_LHS
    row_id: str = "row_id"
    only_flagged: bool = True
    order_by: str | None = None
    descending: bool = True


def deduplicate_sources(
    sources: Sequence[str],
    catalog: Mapping[str, DataFrame],
    errors: DataFrame,
    settings: DedupSettings = DedupSettings(),
    prepare: Sequence[Callable[[DataFrame], DataFrame] | None] = (),
    target: VersionedTable | None = None,
) -> DedupResult:
    """Deduplicate the union of `sources` as the source "a+b", each prepared first (casts, renames).

    Written if anything was removed, whether through a key or a dependency. Ids that repeat over the union are
    refused: they would name rows that the registry does not mean (see `union_row_ids`).
    """
    frames = dict(catalog)
    for name, transform in zip(sources, prepare):
        if transform is not None:
            frames[name] = transform(frames[name])
    union = union_sources(list(sources), frames)
    if settings.row_id not in union.columns:
        union = stamp_row_id(Checkpoints(union.sparkSession).write(union), settings.row_id)
    else:
        require_unique(union, settings.row_id)
    result = deduplicate(
        union, errors, "+".join(sources), settings.row_id, settings.epsilon, settings.max_lhs,
        settings.only_flagged, settings.order_by, settings.descending,
    )
    if target is not None and not result.clusters.isEmpty():
        target.write(result.deduped)
    return result


def complete(
    df: DataFrame, columns: Sequence[str], target: VersionedTable | None = None
) -> DataFrame:
    filled = impute(df, columns)
    if target is not None:
        target.write(filled)
    return filled


@dataclass(frozen=True)
class FormatRule:
    """Columns, the pattern they should match, and the program that brings them there."""

    columns: tuple[str, ...]
    pattern: str
    program: tuple[Step, ...]


@dataclass(frozen=True)
class OrderRule:
    """Columns, the operators between neighbours, and how far values may move."""

    columns: tuple[str, ...]
    operators: tuple[str, ...]
    threshold: float
    step: float = 1.0


def repair_conformity(df: DataFrame, formats: Sequence[FormatRule] = (), orders: Sequence[OrderRule] = ()) -> DataFrame:
    """Texts brought to their formats, then numbers to their order; what cannot be mended stays or becomes null."""
    for rule in formats:
        df = format_repair(df, rule.columns, rule.pattern, rule.program)
    for rule in orders:
        df = interval_repair(df, rule.columns, rule.operators, rule.threshold, rule.step, "__repair").drop("__repair")
    return df


def repair_table(
    df: DataFrame,
    source: str,
    errors: DataFrame | Callable[[DataFrame], DataFrame],
    settings: DedupSettings = DedupSettings(),
    ratio: tuple[Triplet, str, Sequence[float]] | None = None,
    impute_columns: Sequence[str] = (),
    formats: Sequence[FormatRule] = (),
    orders: Sequence[OrderRule] = (),
    incoherent: Sequence[str] = (),
    regression: str = "bayesian_ridge",
) -> DataFrame:
    """All repairs of one table in order; stable row ids keep the registry valid throughout.

    `errors` may be a function of the table as it is before deduplication: two spellings of one key are repeated
    only once they are alike. `incoherent` columns (see `coherent_projection`) are left out before gaps are filled.
    """
    df = repair_conformity(df, formats, orders)
    if ratio is not None:
        df = repair_ratio(df, *ratio).frame
    if callable(errors):
        df = Checkpoints(df.sparkSession).write(df)
        errors = errors(df)
    df = deduplicate(
        df, errors, source, settings.row_id, settings.epsilon, settings.max_lhs,
        settings.only_flagged, settings.order_by, settings.descending,
    ).deduped.drop(*incoherent)
    return impute(df, impute_columns, regression=regression) if impute_columns else df
