"""Row-level checks and key checks: completeness, formats, labels, intervals, uniqueness.

A row check is one boolean column "this row fails"; null means "does not fail". Scores and lists
of failing rows both come from it, and any number of checks on a table share one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import number
from plumbline.functions.text import compact_texts, finds
from plumbline.operators.skew import COUNT, any_of, count_by, spread_join

NullPolicy = Literal["ignore", "fail"]

COMPLETENESS = "completeness"
UNIQUENESS = "uniqueness"
FORMAT = "format"
LABELS = "labels"
INTERVAL = "interval"
GROUPED_COLUMNS = 60  # grouping_id() is a 64-bit number


def run_timestamp(at: datetime | str | None = None) -> Column:
    """The one instant of a run, UTC, as a literal shared by all its metrics."""
    if at is None:
        at = datetime.now(timezone.utc)
    if isinstance(at, datetime):
        if at.tzinfo is not None:
            at = at.astimezone(timezone.utc)
        at = at.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(at).cast("timestamp_ntz")


@dataclass(frozen=True)
class RowCheck:
    """A metric name, a rule label, the columns involved, and the failure flag."""

    metric: str
    rule: str
    columns: tuple[str, ...]
    flag: Callable[[DataFrame], Column]
    detail: str | None = None

    def failed(self, df: DataFrame) -> Column:
        return F.coalesce(self.flag(df), F.lit(False))


def _with_null_policy(failed: Column, column: str, nulls: NullPolicy) -> Column:
    if nulls not in ("ignore", "fail"):
        raise ValueError(f"nulls must be ignore or fail, not {nulls!r}")
    return failed | F.col(column).isNull() if nulls == "fail" else failed


def not_null(column: str) -> RowCheck:
    return RowCheck(COMPLETENESS, column, (column,), lambda df: F.col(column).isNull())


def matches(column: str, pattern: str, nulls: NullPolicy = "ignore") -> RowCheck:
    """The value, as text, must contain a match of `pattern`."""
    return RowCheck(
        FORMAT,
        column,
        (column,),
        lambda df: _with_null_policy(~finds(F.col(column), pattern), column, nulls),
        pattern,
    )


def one_of(column: str, labels: Sequence, nulls: NullPolicy = "ignore") -> RowCheck:
    """The value must be among `labels`; text and numbers are compared as text."""
    labels = list(labels)

    def flag(df: DataFrame) -> Column:
        if not labels:
            return _with_null_policy(F.col(column).isNotNull(), column, nulls)
        is_text = isinstance(df.schema[column].dataType, T.StringType)
        texts = sum(isinstance(label, str) for label in labels)
        if texts == (len(labels) if is_text else 0):
            found = F.col(column).isin(labels)
        else:
            found = F.col(column).cast("string").isin([str(label) for label in labels])
        return _with_null_policy(~found, column, nulls)

    return RowCheck(LABELS, column, (column,), flag)


def ordered(low: str, target: str, high: str) -> RowCheck:
    """low <= target <= high, blanks inside numbers allowed; a known violated half fails alone."""

    def flag(df: DataFrame) -> Column:
        a, b, c = (number(df, name) for name in (low, target, high))
        return ~((a <= b) & (b <= c))

    return RowCheck(INTERVAL, f"{low}, {target}, {high}", (low, target, high), flag)


def score(failures: Column, total: Column) -> Column:
    """Share of rows that do not fail; null for an empty table."""
    return F.lit(1.0) - F.try_divide(failures.cast("double"), total.cast("double"))


def score_checks(
    df: DataFrame, checks: Sequence[RowCheck], source: str, timestamp: Column | datetime | str
) -> DataFrame:
    """One row per check: (source, metric, rule, failed_rows, total_rows, score, timestamp).

    All checks are conditional counts of a single aggregation, reshaped to long form afterwards.
    """
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(check.failed(df)).alias(f"f{i}") for i, check in enumerate(checks)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(check.metric).alias("metric"),
                F.lit(check.rule).alias("rule"),
                F.array(*(F.lit(c) for c in check.columns)).alias("columns"),
                F.lit(check.detail).cast("string").alias("detail"),
                F.col(f"f{i}").alias("failed_rows"),
            )
            for i, check in enumerate(checks)
        )
    )
    return counted.select("total", F.explode(rows).alias("r")).select(
        F.lit(source).alias("source"),
        "r.metric",
        "r.rule",
        "r.columns",
        "r.detail",
        "r.failed_rows",
        F.col("total").alias("total_rows"),
        score(F.col("r.failed_rows"), F.col("total")).alias("score"),
        timestamp.alias("timestamp"),
    )


def list_violations(
    df: DataFrame, checks: Sequence[RowCheck], source: str, row_key: Sequence[str]
) -> DataFrame:
    """One row per failing (row, check): (source, metric, column_name, detail, row key).

    One scan, no shuffle: each row unfolds into the checks it fails.
    """
    failing = F.filter(
        F.array(
            *(
                F.when(
                    check.failed(df),
                    F.struct(
                        F.lit(check.metric).alias("metric"),
                        F.lit(check.rule).alias("column_name"),
                        F.lit(check.detail).cast("string").alias("detail"),
                    ),
                )
                for check in checks
            )
        ),
        lambda entry: entry.isNotNull(),
    )
    # Rows without any failure are dropped before the array is built.
    bad = df.where(any_of([check.failed(df) for check in checks]))
    return bad.select(*row_key, F.explode(failing).alias("v")).select(
        F.lit(source).alias("source"), "v.metric", "v.column_name", "v.detail", *row_key
    )


def completeness(df: DataFrame, columns: Sequence[str], source: str, timestamp) -> DataFrame:
    """(source, column_name, completeness_percent, timestamp); NaN counts as a value."""
    return score_checks(df, [not_null(c) for c in columns], source, timestamp).select(
        "source",
        F.col("rule").alias("column_name"),
        F.col("score").alias("completeness_percent"),
        "timestamp",
    )


def text_format(
    df: DataFrame, columns: Sequence[str], pattern: str, source: str, timestamp,
    nulls: NullPolicy = "ignore",
) -> DataFrame:
    """(source, column_name, format_percent, timestamp)."""
    checks = [matches(c, pattern, nulls) for c in columns]
    if not checks:
        return df.limit(0).select(
            F.lit(source).alias("source"), F.lit("").alias("column_name"),
            F.lit(0.0).alias("format_percent"), run_timestamp("1970-01-01").alias("timestamp"),
        )
    return score_checks(df, checks, source, timestamp).select(
        "source", F.col("rule").alias("column_name"), F.col("score").alias("format_percent"), "timestamp"
    )


def allowed_labels(
    df: DataFrame, columns: Sequence[str], labels: Sequence, source: str, timestamp,
    nulls: NullPolicy = "ignore",
) -> DataFrame:
    """(source, column_name, labels_percent, timestamp)."""
    return score_checks(df, [one_of(c, labels, nulls) for c in columns], source, timestamp).select(
        "source", F.col("rule").alias("column_name"), F.col("score").alias("labels_percent"), "timestamp"
    )


def interval_validity(
    df: DataFrame, triplets: Sequence[tuple[str, str, str]], source: str, timestamp
) -> DataFrame:
    """(source, column_name_min, column_name_target, column_name_max, interval_percent, timestamp)."""
    return score_checks(df, [ordered(*t) for t in triplets], source, timestamp).select(
        "source",
        F.col("columns")[0].alias("column_name_min"),
        F.col("columns")[1].alias("column_name_target"),
        F.col("columns")[2].alias("column_name_max"),
        F.col("score").alias("interval_percent"),
        "timestamp",
    )


def key_label(columns: Sequence[str]) -> str:
    return ", ".join(sorted(columns))


def _key_batches(key_sets: Sequence[list[str]]) -> list[list[list[str]]]:
    """The key sets in order, cut where together they would have too many columns for one grouping id."""
    batches: list[list[list[str]]] = []
    columns: set[str] = set()
    for keys in key_sets:
        if not batches or len(columns | set(keys)) > GROUPED_COLUMNS:
            batches.append([])
            columns = set()
        batches[-1].append(keys)
        columns |= set(keys)
    return batches


def uniqueness(
    df: DataFrame, key_sets: Sequence[Sequence[str]], source: str, timestamp
) -> DataFrame:
    """(source, column_name, columns, uniqueness_percent, timestamp), one row per key set.

    Every member of a repeated key fails; null is an ordinary value. All key sets are grouped in
    one pass over the table (one per `GROUPED_COLUMNS` different columns): only (key, count) pairs are shuffled.
    """
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    key_sets = [sorted(keys) for keys in key_sets]
    labels = [key_label(keys) for keys in key_sets]
    if len(set(labels)) != len(labels):
        raise ValueError(f"repeated key sets: {labels}")
    return reduce(
        DataFrame.unionByName, [_uniqueness_of(df, batch, source, timestamp) for batch in _key_batches(key_sets)]
    )


def _uniqueness_of(
    df: DataFrame, key_sets: Sequence[list[str]], source: str, timestamp: Column
) -> DataFrame:
    labels = [key_label(keys) for keys in key_sets]
    every = sorted({c for keys in key_sets for c in keys})
    rows_of = compact_texts(df.select(*every), every)
    if len(key_sets) == 1:  # any number of columns
        grouped = rows_of.groupBy(*every).agg(F.lit(0).cast("bigint").alias("gid"), F.count(F.lit(1)).alias(COUNT))
    else:
        grouped = rows_of.groupingSets([[F.col(c) for c in keys] for keys in key_sets], *every).agg(
            F.grouping_id().alias("gid"), F.count(F.lit(1)).alias(COUNT)
        )
    per_set = grouped.groupBy("gid").agg(
        F.sum(COUNT).alias("total"),
        F.sum(F.when(F.col(COUNT) > 1, F.col(COUNT)).otherwise(0)).alias("failed"),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(grouping_bits(every, keys)).alias("gid"),
                F.lit(label).alias("column_name"),
                F.array(*(F.lit(c) for c in keys)).alias("columns"),
            )
            for keys, label in zip(key_sets, labels)
        )
    )
    # The rules come from a one-row aggregate, so that an empty table still yields a row per rule.
    rules = per_set.agg(F.collect_list(F.struct("gid", "total", "failed")).alias("counted")).select(
        "counted", F.explode(rows).alias("r")
    )
    mine = F.element_at(
        F.concat(
            F.filter("counted", lambda c: c["gid"] == F.col("r.gid")),
            F.array(
                F.struct(
                    F.lit(0).cast("bigint").alias("gid"),
                    F.lit(0).cast("bigint").alias("total"),
                    F.lit(0).cast("bigint").alias("failed"),
                )
            ),
        ),
        1,
    )
    return rules.select(
        F.lit(source).alias("source"),
        "r.column_name",
        "r.columns",
        score(mine["failed"], mine["total"]).alias("uniqueness_percent"),
        timestamp.alias("timestamp"),
    )


def grouping_bits(every: Sequence[str], kept: Sequence[str]) -> int:
    """The value of grouping_id() for a grouping set: one bit per column, set where rolled up."""
    return sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in kept)


def uniqueness_violations(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    row_key: Sequence[str],
) -> DataFrame:
    """(source, column_name, row key) of every row whose key occurs more than once."""
    keys = sorted(keys)
    slots = [f"k{i}" for i in range(len(keys))]
    # Copies of the key columns, so that a row key among them keeps its value.
    needed = compact_texts(
        df.select(*row_key, *(F.col(c).alias(slot) for c, slot in zip(keys, slots))), slots
    )
    counts = count_by(needed, slots)
    repeated = counts.where(F.col(COUNT) > 1).select(*slots)
    failing = spread_join(needed, repeated, slots, "left_semi")
    return failing.select(
        F.lit(source).alias("source"), F.lit(key_label(keys)).alias("column_name"), *row_key
    )
