"""Imputation by chained equations, from one aggregation of the table.

In round-robin regression every imputed value is a linear function of the observed values of its
row, and which function depends only on which columns are missing. So sums of products per missing
pattern are all that is needed, and the table is read once for them. Of few columns the at most
2^columns small matrices are collected, every round is matrix algebra on the driver, and one
projection fills the gaps; of many columns they stay distributed and every step adds them up.

Regression: Bayesian ridge (MacKay 1992, Tipping 2001) or least squares, from sums of products as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import number
from plumbline.session import Checkpoints

ROUNDS = 10
FEW_COLUMNS = 12  # at most 4096 missing patterns, which fit on the driver
FILLED = "__filled"


def bayesian_ridge(
    xx: np.ndarray, xy: np.ndarray, yy: float, n: float, iterations: int = 300, tolerance: float = 1e-3
) -> np.ndarray:
    """Coefficients from centred sums of products; both precisions are estimated from the data."""
    weak = 1e-6  # shape and rate of the gamma priors
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    rotated = vectors.T @ xy
    noise = 1.0 / (yy / n + np.finfo(float).eps)
    weight = 1.0

    def solve() -> np.ndarray:
        return vectors @ (rotated / (values + weight / noise))

    previous = None
    for _ in range(iterations):
        coefficients = solve()
        residual = max(yy - 2 * coefficients @ xy + coefficients @ xx @ coefficients, 0.0)
        effective = np.sum(noise * values / (weight + noise * values))
        weight = (effective + 2 * weak) / (coefficients @ coefficients + 2 * weak)
        noise = (n - effective + 2 * weak) / (residual + 2 * weak)
        if previous is not None and np.abs(previous - coefficients).sum() < tolerance:
            break
        previous = coefficients
    return solve()


def least_squares(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Coefficients from centred sums of products; the shortest ones where columns depend on each other."""
    return np.linalg.pinv(xx, hermitian=True) @ xy


REGRESSIONS = {"bayesian_ridge": bayesian_ridge, "least_squares": least_squares}
Solver = Callable[[np.ndarray, np.ndarray, float, float], np.ndarray]
Step = tuple[int, np.ndarray, float]  # the column imputed, its slopes on all columns, its intercept


def _pattern(values: Sequence[Column]) -> Column:
    """Bit i is set where column i is missing."""
    bits = [F.when(v.isNull(), 1 << i).otherwise(0) for i, v in enumerate(values)]
    return sum(bits[1:], bits[0])


def _marks(values: Sequence[Column]) -> Column:
    """As `_pattern` for any number of columns: one character each, 1 where the value is missing."""
    return F.concat(*(F.when(v.isNull(), "1").otherwise("0") for v in values))


def _pattern_sums(df: DataFrame, pattern: Column, standard: Sequence[Column]) -> DataFrame:
    """(pattern, sums): sums of products of (1, standardised values), missing ones as 0, row by row of the upper half."""
    known = [F.coalesce(v, F.lit(0.0)).alias(f"z{i}") for i, v in enumerate(standard)]
    data = df.select(pattern.alias("pattern"), F.lit(1.0).alias("one"), *known)
    names = ["one", *(f"z{i}" for i in range(len(standard)))]
    products = [
        F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(names) for b in names[i:]
    ]
    summed = data.groupBy("pattern").agg(*products)
    return summed.select("pattern", F.array(*(c for c in summed.columns if c != "pattern")).alias("sums"))


def _square(sums: Sequence[float], d: int) -> np.ndarray:
    upper = np.zeros((d + 1, d + 1))
    upper[np.triu_indices(d + 1)] = sums
    return upper + np.triu(upper, 1).T


def _line(known: np.ndarray, j: int, scale: np.ndarray, solve: Solver) -> Step:
    """The regression of column j on the others, from the sums of products of the rows that know it."""
    d = len(scale)
    n, means = known[0, 0], known[0, 1:] / known[0, 0]
    covariance = (known[1:, 1:] - n * np.outer(means, means)) * np.outer(scale, scale)
    others = [k for k in range(d) if k != j]
    raw = solve(covariance[np.ix_(others, others)], covariance[others, j], covariance[j, j], n)
    slopes = np.zeros(d)
    slopes[others] = raw * scale[others] / scale[j]
    return j, slopes, means[j] - slopes @ means


def _start(missing: Sequence[bool]) -> np.ndarray:
    # Missing entries start at the mean, which is 0 after standardising.
    return np.diag([1.0] + [0.0 if gone else 1.0 for gone in missing])


def _advance(matrix: np.ndarray, step: Step) -> None:
    j, slopes, intercept = step
    matrix[j + 1] = slopes @ matrix[1:]
    matrix[j + 1, 0] += intercept


def _chain(
    patterns: dict[int, np.ndarray], order: Sequence[int], scale: np.ndarray, rounds: int, solve: Solver
) -> dict[int, np.ndarray]:
    """Per pattern the matrix taking (1, observed values) to (1, all values)."""
    maps = {p: _start([p >> i & 1 for i in range(len(scale))]) for p in patterns}
    for _ in range(rounds):
        for j in order:
            known = sum(maps[p] @ gram @ maps[p].T for p, gram in patterns.items() if not p >> j & 1)
            step = _line(known, j, scale, solve)
            for p in patterns:
                if p >> j & 1:
                    _advance(maps[p], step)
    return maps


def _known_sums(table: DataFrame, steps: Sequence[Step], j: int, d: int) -> np.ndarray:
    """Sums of products over the rows that know column j, all gaps filled by the steps so far.

    One matrix a task, added up by an aggregation; the patterns stay in Spark however many there are.
    """
    steps = list(steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1))
        for batch in batches:
            for marks, sums in zip(*(c.to_pylist() for c in batch.columns)):
                if marks[j] == "1":
                    continue
                matrix = _start([m == "1" for m in marks])
                for step in steps:
                    if marks[step[0]] == "1":
                        _advance(matrix, step)
                total += matrix @ _square(sums, d) @ matrix.T
        flat = total[np.triu_indices(d + 1)].tolist()
        yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.float64()))], names=["sums"])

    places = table.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "part"))
    added = places.groupBy("at").agg(F.sum("part").alias("all")).collect()
    return _square([r["all"] for r in sorted(added, key=lambda r: r["at"])], d)


def _filled_by_steps(standard: Sequence[Column], steps: Sequence[Step]) -> Column:
    """All standardised values of a row as an array, gaps filled by taking the steps in turn."""
    steps = list(steps)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def fill(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return rows
        values = np.array([np.asarray(row, dtype=float) for row in rows])
        missing = np.isnan(values)
        values[missing] = 0.0
        for j, slopes, intercept in steps:
            gaps = missing[:, j]
            values[gaps, j] = values[gaps] @ slopes + intercept
        return pd.Series(list(values))

    return fill(F.array(*standard))


def impute(
    df: DataFrame, columns: Sequence[str], rounds: int = ROUNDS, regression: str = "bayesian_ridge"
) -> DataFrame:
    """Fill the nulls of the numeric `columns` from the others; known values and types stay.

    Text columns such as "16 800" serve as predictors only. Integer columns are rounded. `regression` is
    bayesian_ridge or least_squares. Up to `FEW_COLUMNS` columns the whole chain is one aggregation; with
    more, the missing patterns may be as many as the rows, so they stay in Spark and every step is an aggregation
    over them. Both give the same values.
    """
    columns = list(columns)
    if regression not in REGRESSIONS:
        raise ValueError(f"regression must be one of {sorted(REGRESSIONS)}, not {regression!r}")
    solve, d = REGRESSIONS[regression], len(columns)
    values = [number(df, c) for c in columns]
    stats = df.agg(
        *(F.avg(v).alias(f"m{i}") for i, v in enumerate(values)),
        *(F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)),
        *(F.count_if(v.isNull()).alias(f"n{i}") for i, v in enumerate(values)),
    ).first()
    if empty := [c for i, c in enumerate(columns) if stats[f"m{i}"] is None]:
        raise ValueError(f"columns without any value: {empty}")
    center = [float(stats[f"m{i}"]) for i in range(d)]
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(d)])
    missing = [stats[f"n{i}"] for i in range(d)]
    order = [int(i) for i in np.argsort(missing, kind="stable") if missing[i]]
    if not order:
        return df
    standard = [(v - center[i]) / float(scale[i]) for i, v in enumerate(values)]

    if d <= FEW_COLUMNS:
        sums = _pattern_sums(df, _pattern(values), standard).collect()
        maps = _chain({r["pattern"]: _square(r["sums"], d) for r in sums}, order, scale, rounds, solve)

        def guess(j: int) -> Column:
            table = F.create_map(
                *(
                    x for p, matrix in maps.items() if p >> j & 1
                    for x in (F.lit(p), F.array(*(F.lit(float(v)) for v in matrix[j + 1])))
                )
            )
            row = F.element_at(table, _pattern(values))
            terms = [F.element_at(row, i + 2) * F.coalesce(z, F.lit(0.0)) for i, z in enumerate(standard)]
            return sum(terms, F.element_at(row, 1))
    else:
        kept = Checkpoints(df.sparkSession)
        table = kept.write(_pattern_sums(df, _marks(values), standard))
        steps: list[Step] = []
        for _ in range(rounds):
            for j in order:
                steps.append(_line(_known_sums(table, steps, j, d), j, scale, solve))
        kept.drop(table)
        df = df.withColumn(FILLED, _filled_by_steps(standard, steps))

        def guess(j: int) -> Column:
            return F.col(FILLED)[j]

    filled = {}
    for j in sorted(order):
        data_type = df.schema[columns[j]].dataType
        if not isinstance(data_type, T.NumericType):
            continue
        value = guess(j) * float(scale[j]) + center[j]
        if isinstance(data_type, T.IntegralType):
            value = F.round(value)
        own = F.col(columns[j])
        filled[columns[j]] = F.when(own.isNotNull(), own).otherwise(value.cast(data_type))
    return df.withColumns(filled).drop(FILLED)
