"""Exact quantiles without sorting the table, and the Theil-Sen line between two sources.

`percentile` keeps every distinct value in one buffer. Here a sketch first brackets each wanted
quantile, rows outside the brackets are only counted, and just the few inside are ranked.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from fractions import Fraction
from itertools import accumulate
from math import inf, isqrt, nextafter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numbers import is_finite

PERCENTS = tuple(f"{i / 100:.2f}" for i in range(1, 100))
ACCURACY = 10_000  # rank error of the sketch: rows / ACCURACY
MAX_RANKED = 10_000_000  # rows of a bracket that one task may sort; larger ones are split further
SPLITS = 64


def _bucket(value: Column, bounds: Sequence[float]) -> Column:
    """Number of boundaries below `value`: first the group of boundaries, then the place in it."""
    width = max(8, isqrt(len(bounds)))
    groups = [list(bounds[i : i + width]) for i in range(0, len(bounds), width)]
    coarse = F.lit(0)
    for group in groups[1:]:
        coarse = coarse + F.when(value > group[0], 1).otherwise(0)
    # One SQL text instead of hundreds of literal calls into the JVM; repr() keeps every digit.
    table = F.expr(f"array({', '.join('array(' + ', '.join(f'{b!r}D' for b in g) + ')' for g in groups)})")
    fine = F.size(F.filter(F.element_at(table, coarse + 1), lambda b: b < value))
    return coarse * width + fine


def _picks(
    probabilities: Sequence[str | float], n: int, ends: Sequence[int]
) -> dict[int, list[tuple[float, int, float]]]:
    """Bucket -> (probability, place in the bucket, weight) of the order statistics to be read.

    Rank h = (n - 1) p lies between two of them, weighted by its fraction.
    """
    picks: dict[int, list[tuple[float, int, float]]] = {}
    for name in probabilities:
        rank = (n - 1) * Fraction(str(name))
        low = int(rank)
        weight = float(rank - low)
        for place, share in ((low, 1.0 - weight), (low + 1, weight)):
            if share:
                bucket = bisect_right(ends, place)
                before = ends[bucket - 1] if bucket else 0
                picks.setdefault(bucket, []).append((float(name), place - before, share))
    return picks


def _single(bounds: Sequence[float], bucket: int) -> bool:
    """Can the bracket hold only one value? It reaches from above the bound before it up to its own."""
    return 0 < bucket < len(bounds) and nextafter(bounds[bucket - 1], inf) >= bounds[bucket]


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[str | float] = PERCENTS,
    accuracy: int = ACCURACY,
    max_ranked: int = MAX_RANKED,
) -> DataFrame:
    """(probability, quantile), linearly interpolated, over the finite non-null values.

    Driver round trips fetch bounded lists only: bracket bounds and one count per bracket. While a
    wanted bracket holds more than `max_ranked` rows and more than one value, it is split by another
    sketch of its own. The last pass ranks the rows inside the brackets.
    """
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & is_finite(F.col("v"))
    )
    margin = 2.0 / accuracy
    around = sorted(
        {min(1.0, max(0.0, float(p) + step)) for p in probabilities for step in (-margin, margin)}
    )
    sketch = values.agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("v", around, accuracy).alias("bounds")
    ).first()
    n = sketch["n"]
    if n < 2:
        raise ValueError(f"{column!r} has fewer than two finite values")
    bounds = sorted(set(sketch["bounds"]))

    while True:
        bucketed = values.withColumn("bucket", _bucket(F.col("v"), bounds))
        counted = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {r["bucket"]: r["n"] for r in counted}
        ends = list(accumulate(sizes.get(i, 0) for i in range(len(bounds) + 1)))
        picks = _picks(probabilities, n, ends)
        crowded = [b for b in picks if sizes[b] > max_ranked and not _single(bounds, b)]
        if not crowded:
            break
        cuts = [i / SPLITS for i in range(1, SPLITS)]
        split = (
            bucketed.where(F.col("bucket").isin(crowded))
            .groupBy("bucket")
            .agg(F.percentile_approx("v", cuts, accuracy).alias("cuts"))
            .collect()
        )
        # A bound on either side of each cut gives a value held by many rows a bracket of its own.
        cuts_found = {c for r in split for c in r["cuts"]}
        finer = sorted(cuts_found.union(bounds, (nextafter(c, -inf) for c in cuts_found)))
        if finer == bounds:
            break
        bounds = finer

    lookup = F.expr(
        "map("
        + ", ".join(
            f"{bucket}, array("
            + ", ".join(
                f"named_struct('p', {p}D, 'place', {place}L, 'share', {share!r}D)" for p, place, share in entries
            )
            + ")"
            for bucket, entries in sorted(picks.items())
        )
        + ")"
    )
    # A value held by many rows is one record here, so no bracket can outgrow its task.
    ranked = (
        bucketed.where(F.col("bucket").isin(sorted(picks)))
        .groupBy("bucket", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("bucket").orderBy("v")))
    )
    chosen = ranked.select(
        "v",
        F.explode(
            F.filter(
                F.element_at(lookup, F.col("bucket")),
                lambda e: (e["place"] < F.col("upto")) & (e["place"] >= F.col("upto") - F.col("n")),
            )
        ).alias("e"),
    )
    return chosen.groupBy(F.col("e.p").alias("probability")).agg(
        F.sum(F.col("v") * F.col("e.share")).alias("quantile")
    )


def _median(values: Column) -> Column:
    ordered = F.array_sort(values)
    size = F.size(ordered)
    upper = F.floor(size / 2).cast("int")
    lower = F.floor((size - 1) / 2).cast("int")
    return (F.element_at(ordered, lower + 1) + F.element_at(ordered, upper + 1)) / 2.0


def theil_sen(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """One row (slope, intercept, r2) of the line from the 99 percentiles of `left` to `right`.

    Slope: median over all pairs of percentiles; intercept: median residual. Null if the left
    percentiles are constant.
    """
    q1 = exact_quantiles(left, column).withColumnRenamed("quantile", "x")
    q2 = exact_quantiles(right, column).withColumnRenamed("quantile", "y")
    # 99 percentiles, a fixed number: they fit into one row.
    pairs = q1.join(q2, "probability").agg(F.collect_list(F.struct("x", "y")).alias("q"))
    slopes = F.filter(
        F.flatten(
            F.transform(
                "q",
                lambda a: F.transform(
                    "q", lambda b: F.when(b["x"] > a["x"], (b["y"] - a["y"]) / (b["x"] - a["x"]))
                ),
            )
        ),
        lambda s: s.isNotNull(),
    )
    fitted = pairs.select("q", slopes.alias("slopes")).select(
        "q", F.when(F.size("slopes") > 0, _median(F.col("slopes"))).alias("slope")
    )
    fitted = fitted.withColumn(
        "intercept", _median(F.transform("q", lambda p: p["y"] - F.col("slope") * p["x"]))
    )

    def total(f) -> Column:
        return F.aggregate("q", F.lit(0.0), lambda acc, p: acc + f(p))

    mean = total(lambda p: p["y"]) / F.size("q")
    fitted = fitted.withColumn("mean", mean)
    residual = total(lambda p: F.pow(p["y"] - F.col("slope") * p["x"] - F.col("intercept"), F.lit(2)))
    spread = total(lambda p: F.pow(p["y"] - F.col("mean"), F.lit(2)))
    r2 = F.when(spread > 0, 1.0 - residual / spread).when(residual == 0, 1.0).otherwise(0.0)
    return fitted.select("slope", "intercept", r2.alias("r2"))
