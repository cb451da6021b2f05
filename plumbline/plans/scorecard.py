"""The BI layer: latest measures, one scorecard over all metrics, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.coherence import coherence_score
from plumbline.operators.skew import all_of
from plumbline.session import checkpoint
from plumbline.sources.unions import union_all

# Metric table -> the columns that name a rule in it.
RULE_KEYS = {
    "completeness": ["source", "column_name"],
    "uniqueness": ["source", "column_name"],
    "format": ["source", "column_name"],
    "labels": ["source", "column_name"],
    "interval": ["source", "column_name_min", "column_name_target", "column_name_max"],
    "foreign_key": ["source_1", "source_2", "column_name_1", "column_name_2"],
    "dispersion": ["source_1", "source_2", "column_name_1", "column_name_2"],
    "position_ratio": ["source", "column_name_min", "column_name_mean", "column_name_max"],
    "coherence": ["source", "x", "y"],
}

DIMENSIONS = {
    "completeness": ("Completeness", "Non-null values"),
    "uniqueness": ("Uniqueness", "No duplicates"),
    "format": ("Conformity", "Format"),
    "labels": ("Conformity", "Allowed values"),
    "interval": ("Conformity", "Interval"),
    "foreign_key": ("Conformity", "Foreign key"),
    "dispersion": ("Heterogeneity", "Dispersion between sources"),
    "position_ratio": ("Heterogeneity", "Position of the mean"),
    "coherence": ("Coherence", "Candidate rules respected"),
}


def latest(history: DataFrame, keys: Sequence[str], timestamp: str = "timestamp") -> DataFrame:
    """All rows of each rule at its last timestamp; ties are kept, and null is an ordinary value of a key.

    One maximum per rule, then a join on rule and timestamp: unlike a window over the rule, this
    brings the old runs of a long-lived rule to no common task.
    """
    return with_latest_flag(history, keys, timestamp, "__latest").where("__latest").drop("__latest")


def with_latest_flag(
    history: DataFrame, keys: Sequence[str], timestamp: str = "timestamp", name: str = "is_latest"
) -> DataFrame:
    last = history.groupBy(*keys).agg(F.max(timestamp).alias("__last"))
    renamed = last.select(*(F.col(k).alias(f"__{k}") for k in keys), "__last")
    same = all_of([F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    joined = history.join(renamed, same & (F.col(timestamp) == F.col("__last")), "left")
    return joined.select(*history.columns, F.col("__last").isNotNull().alias(name))


def _normalised(metric: str, rows: DataFrame) -> DataFrame:
    """(dimension, metric, source, rule, score, timestamp) of one metric table."""

    def chained(separator: str, *columns: str) -> Column:
        return F.concat_ws(separator, *columns)

    if metric == "coherence":
        rows = coherence_score(rows)
    source, rule, score = {
        "completeness": ("source", "column_name", "completeness_percent"),
        "uniqueness": ("source", "column_name", "uniqueness_percent"),
        "format": ("source", "column_name", "format_percent"),
        "labels": ("source", "column_name", "labels_percent"),
        "interval": (
            "source",
            chained(" ≤ ", "column_name_min", "column_name_target", "column_name_max"),
            "interval_percent",
        ),
        "foreign_key": (
            chained(" -> ", "source_1", "source_2"),
            chained(" -> ", "column_name_1", "column_name_2"),
            "fk_percent",
        ),
        "dispersion": (chained(" vs ", "source_1", "source_2"), "column_name_1", "dispersion_score"),
        "position_ratio": (
            "source",
            chained(" / ", "column_name_min", "column_name_mean", "column_name_max"),
            "ratio_score",
        ),
        "coherence": ("source", F.lit("all pairs (x, y)"), "coherence_score"),
    }[metric]
    dimension, label = DIMENSIONS[metric]
    return rows.select(
        F.lit(dimension).alias("dimension"),
        F.lit(label).alias("metric"),
        (F.col(source) if isinstance(source, str) else source).alias("source"),
        (F.col(rule) if isinstance(rule, str) else rule).alias("rule"),
        F.col(score).alias("score"),
        F.col("timestamp"),
    )


RULE = ["dimension", "metric", "source", "rule"]


def city_label(source: Column, cities: Mapping[str, Sequence[str]], default: str) -> Column:
    label = F.lit(default)
    for city, names in cities.items():
        label = F.when(source.isin(list(names)), F.lit(city)).otherwise(label)
    return label


def scorecard(
    metrics: Mapping[str, DataFrame],
    cities: Mapping[str, Sequence[str]] | None = None,
    default_city: str = "Common",
) -> DataFrame:
    """All metric histories in one shape, with `is_latest` per rule and the city of the source.

    The rows, one per rule and run, are read twice below: they are kept, so that histories computed
    on the way are computed once, all of them in one job.
    """
    everything = checkpoint(union_all([_normalised(name, rows) for name, rows in metrics.items()]))
    flagged = with_latest_flag(everything, RULE)
    return flagged.withColumn("city", city_label(F.col("source"), cities or {}, default_city))


LEVELS = (
    ("metric_source_rule", ("dimension", "metric", "source", "rule")),
    ("metric_source", ("dimension", "metric", "source")),
    ("metric", ("dimension", "metric")),
    ("dimension", ("dimension",)),
    ("city", ("city",)),
)


def roll_up(card: DataFrame) -> DataFrame:
    """Mean score of the latest measures per level; every rule counts once, in one aggregation."""
    names = ["dimension", "metric", "source", "rule", "city"]
    rows = card.where("is_latest")
    grouped = rows.groupingSets([[F.col(c) for c in keys] for _, keys in LEVELS], *names).agg(
        F.grouping_id().alias("gid"), F.avg("score").alias("score"), F.count("score").alias("rules")
    )
    level = F.lit(None).cast("string")
    for label, keys in LEVELS:
        bits = sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in keys)
        level = F.when(F.col("gid") == bits, F.lit(label)).otherwise(level)
    return grouped.select(level.alias("level"), *names, "score", "rules")


def daily_scores(card: DataFrame) -> DataFrame:
    """Mean score per dimension, metric and day over the whole history."""
    return card.groupBy("dimension", "metric", F.to_date("timestamp").alias("day")).agg(
        F.avg("score").alias("score"), F.count("score").alias("rules")
    )
