"""Scale heterogeneity: coefficient of variation, dispersion between sources, position ratio."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import number
from plumbline.operators.checks import run_timestamp

DISPERSION_LIMIT = math.log(5)
LOWEST_RATIO, HIGHEST_RATIO = 0.1, 0.9


def variation(column: str) -> Column:
    """Sample standard deviation over the absolute mean; null where it is undefined."""
    mean = F.avg(column)
    return F.when(mean != 0, F.try_divide(F.stddev_samp(column), F.abs(mean)))


def variation_table(df: DataFrame, columns: Sequence[str], source: str, timestamp) -> DataFrame:
    """(source, column_name, cv, timestamp), all columns in one aggregation."""
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    wide = df.agg(*(variation(c).alias(f"v{i}") for i, c in enumerate(columns)))
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("cv"))
            for i, c in enumerate(columns)
        )
    )
    return wide.select(F.explode(rows).alias("r")).select(
        F.lit(source).alias("source"), "r.column_name", "r.cv", timestamp.alias("timestamp")
    )


def coefficient_of_variation(df: DataFrame, column: str) -> float:
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    value = df.agg(variation(column).alias("cv")).first()["cv"]
    if value is None:
        raise ValueError(f"coefficient of variation of {column!r} is undefined")
    return value


def dispersion_difference(cv_1: float, cv_2: float) -> float:
    if cv_1 <= 0 or cv_2 <= 0:
        raise ValueError("coefficients of variation must be positive")
    return abs(math.log(cv_2 / cv_1))


def dispersion_score(difference: float, limit: float = DISPERSION_LIMIT) -> float:
    """1 if the scales agree, else 0."""
    return 1.0 if difference <= limit else 0.0


def dispersion(
    left: DataFrame, column_1: str, right: DataFrame, column_2: str,
    sources: tuple[str, str], timestamp, limit: float = DISPERSION_LIMIT,
) -> DataFrame:
    """One row: dispersion_difference |ln(cv2/cv1)| and dispersion_score; null where undefined."""
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    other = right.agg(variation(column_2).alias("cv_2")).scalar()
    both = left.agg(variation(column_1).alias("cv_1")).select("cv_1", other.alias("cv_2"))
    difference = F.when(
        (F.col("cv_1") > 0) & (F.col("cv_2") > 0), F.abs(F.log(F.col("cv_2") / F.col("cv_1")))
    )
    return both.select(difference.alias("dispersion_difference")).select(
        F.lit(sources[0]).alias("source_1"),
        F.lit(sources[1]).alias("source_2"),
        F.lit(column_1).alias("column_name_1"),
        F.lit(column_2).alias("column_name_2"),
        "dispersion_difference",
        F.when(F.col("dispersion_difference") <= limit, 1.0)
        .when(F.col("dispersion_difference").isNotNull(), 0.0)
        .alias("dispersion_score"),
        timestamp.alias("timestamp"),
    )


def check_bounds(lowest: float, highest: float) -> None:
    if not 0 <= lowest < highest <= 1:
        raise ValueError("ratio bounds must satisfy 0 <= lowest < highest <= 1")


def is_ordered(low: Column, mean: Column, high: Column) -> Column:
    return (low <= mean) & (mean <= high) & (low < high)


def position(low: Column, mean: Column, high: Column) -> Column:
    return F.try_divide(mean - low, high - low)


def position_counts(
    df: DataFrame, triplets: Sequence[tuple[str, str, str, float, float]]
) -> DataFrame:
    """Per triplet: total, complete, invalid (badly ordered) and atypical rows, in one aggregation.

    A triplet is (min column, mean column, max column, lowest ratio, highest ratio).
    """
    counts, rows = [F.count(F.lit(1)).alias("total")], []
    names = list(dict.fromkeys(name for triplet in triplets for name in triplet[:3]))
    slots = {name: f"__v{i}" for i, name in enumerate(names)}
    # Parsed in a projection of its own, so that each value is parsed once.
    parsed = df.select(*(number(df, name).alias(slot) for name, slot in slots.items()))
    for i, (low_name, mean_name, high_name, lowest, highest) in enumerate(triplets):
        check_bounds(lowest, highest)
        low, mean, high = (F.col(slots[c]) for c in (low_name, mean_name, high_name))
        complete = low.isNotNull() & mean.isNotNull() & high.isNotNull()
        ordered = is_ordered(low, mean, high)
        ratio = position(low, mean, high)
        counts += [
            F.count_if(complete).alias(f"c{i}"),
            F.count_if(complete & ~ordered).alias(f"i{i}"),
            F.count_if(complete & ordered & ((ratio < lowest) | (ratio > highest))).alias(f"a{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(low_name).alias("column_name_min"),
                F.lit(mean_name).alias("column_name_mean"),
                F.lit(high_name).alias("column_name_max"),
                F.col(f"c{i}").alias("complete_rows"),
                F.col(f"i{i}").alias("invalid_rows"),
                F.col(f"a{i}").alias("atypical_rows"),
            )
        )
    return parsed.agg(*counts).select("total", F.explode(F.array(*rows)).alias("r")).select(
        F.col("total").alias("total_rows"), "r.*"
    )


def position_ratio_table(
    df: DataFrame, triplets: Sequence[tuple[str, str, str, float, float]], source: str, timestamp
) -> DataFrame:
    """(source, three columns, ratio_position, ratio_score, timestamp); null if a row is badly ordered."""
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    ratio = F.when(
        F.col("invalid_rows") == 0,
        F.try_divide(F.col("atypical_rows").cast("double"), F.col("complete_rows").cast("double")),
    )
    return position_counts(df, triplets).select(
        F.lit(source).alias("source"),
        "column_name_min",
        "column_name_mean",
        "column_name_max",
        ratio.alias("ratio_position"),
        (1.0 - ratio).alias("ratio_score"),
        timestamp.alias("timestamp"),
    )


def position_ratio(
    df: DataFrame, low: str, mean: str, high: str,
    lowest: float = LOWEST_RATIO, highest: float = HIGHEST_RATIO,
) -> float:
    """Share of rows whose mean lies outside [lowest, highest] of the way from min to max."""
    check_bounds(lowest, highest)
    if missing := [c for c in (low, mean, high) if c not in df.columns]:
        raise ValueError(f"no columns {missing}")
    counts = position_counts(df, [(low, mean, high, lowest, highest)]).first()
    if counts["total_rows"] == 0:
        raise ValueError("the table is empty")
    if counts["complete_rows"] == 0:
        raise ValueError("no row has all three values")
    if counts["invalid_rows"] > 0:
        raise ValueError(f"{counts['invalid_rows']} rows are not ordered min <= mean <= max")
    return counts["atypical_rows"] / counts["complete_rows"]


def position_score(ratio: float) -> float:
    return 1.0 - ratio
