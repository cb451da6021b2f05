"""Joins on keys of which one may hold a large share of all rows.

AQE splits a skewed partition only where a join reads a plain shuffle on both sides. An aggregation on
the join key leaves its rows placed by that key, so no such shuffle follows and a hot key stays in one
task. `spread_join` joins on a hash of the key beside the key itself. No side is placed by that pair, so
Spark shuffles both anew, and AQE splits any partition that turns out too large: no list of hot keys, no
fan and no bound on either.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "n_rows"


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; null is an ordinary key value."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))


def spread_join(rows: DataFrame, keyed: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join `rows` to `keyed` on `on` (nulls equal); a partition of `rows` that a hot key fills is split.

    `how` is inner, left, left_semi or left_anti: the joins in which the left side may be split.
    """
    on = list(on)
    right_keys = [f"__k{i}" for i in range(len(on))]
    payload = [c for c in keyed.columns if c not in on]
    left = rows.withColumn("__digest", F.xxhash64(*on))
    right = keyed.select(
        *(F.col(c).alias(k) for c, k in zip(on, right_keys)), F.xxhash64(*on).alias("__kdigest"), *payload
    )
    condition = all_of(
        [F.col("__digest") == F.col("__kdigest")]
        + [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(on, right_keys)]
    )
    return left.join(right, condition, how).drop("__digest", "__kdigest", *right_keys)
