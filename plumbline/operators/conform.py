"""Repairs of conformity: values brought to a format by a program of operations, and to an order by swap or rounding."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import extract, finds, fold_accents, replace_literal
from plumbline.operators.skew import all_of, spread_join

MAX_ORDERED = 6  # columns of one order: the sets that rounding looks at double with each
KINDS = ("kept", "swapped", "rounded", "nulled")

OPERATIONS: dict[str, Callable[..., Column]] = {
    "trim": lambda v: replace_literal(v, r"^\s+|\s+$", ""),
    "collapse": lambda v: replace_literal(v, r"\s+", " "),
    "upper": F.upper,
    "lower": F.lower,
    "fold": fold_accents,
    "replace": replace_literal,  # pattern, text
    "extract": lambda v, pattern: F.coalesce(extract(v, pattern), v),
    "prefix": lambda v, text: F.when(F.startswith(v, F.lit(text)), v).otherwise(F.concat(F.lit(text), v)),
    "suffix": lambda v, text: F.when(F.endswith(v, F.lit(text)), v).otherwise(F.concat(v, F.lit(text))),
    "pad": lambda v, width, fill: F.when(F.length(v) < width, F.lpad(v, width, fill)).otherwise(v),
}


@dataclass(frozen=True)
class Step:
    """One operation of a program and its arguments: data, so that programs can be stored and compared."""

    operation: str
    arguments: tuple = ()

    def apply(self, value: Column) -> Column:
        if self.operation not in OPERATIONS:
            raise ValueError(f"unknown operation {self.operation!r}")
        return OPERATIONS[self.operation](value, *self.arguments)


def _step_column(column: str) -> str:
    return f"__step_{column}"


def _run_program(
    df: DataFrame, columns: Sequence[str], pattern: str, program: Sequence[Step],
    failing: DataFrame | None, key: str | None,
) -> DataFrame:
    """`df` with its columns repaired and, beside each, the step that did it: 0 as it was, -1 none did."""
    names = df.columns
    if failing is not None:
        registry = failing.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__fails", F.lit(True))
        df = spread_join(df, registry, [key], "left")
    asked = F.col("__fails").isNotNull() if failing is not None else F.lit(True)
    steps = {}
    for c in columns:
        value, done, at = F.col(c), f"__done_{c}", f"__value_{c}"
        fails = asked & value.isNotNull() & ~finds(value, pattern)
        df = df.withColumns({at: value.cast("string"), done: F.when(~fails, F.lit(0))})
        # One projection a step, so that no expression is spelled out again in the next.
        for i, step in enumerate(program, 1):
            df = df.withColumn(at, F.when(F.col(done).isNull(), step.apply(F.col(at))).otherwise(F.col(at)))
            df = df.withColumn(
                done, F.when(F.col(done).isNull() & finds(F.col(at), pattern), F.lit(i)).otherwise(F.col(done))
            )
        steps[c] = F.when(F.col(done) > 0, F.col(at)).otherwise(value.cast("string"))
    out = [steps[c].alias(c) if c in steps else F.col(c) for c in names]
    return df.select(*out, *(F.coalesce(F.col(f"__done_{c}"), F.lit(-1)).alias(_step_column(c)) for c in columns))


def format_repair(
    df: DataFrame, columns: Sequence[str], pattern: str, program: Sequence[Step],
    failing: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """`df` with the text columns brought to `pattern`: each step works on what still fails after those before it.

    With `failing`, a registry of failing rows by `key`, all other rows are left as they are. Values that match
    or are null stay; one that fails after the last step stays as it was.
    """
    repaired = _run_program(df, columns, pattern, program, failing, key)
    return repaired.select(*df.columns)


def format_report(
    df: DataFrame, columns: Sequence[str], pattern: str, program: Sequence[Step],
    failing: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """(column_name, step, operation, n_values): how many values each step repaired; step -1 is none, 0 not touched."""
    steps = _run_program(df, columns, pattern, program, failing, key)
    pairs = F.inline(F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.col(_step_column(c)).alias("step")) for c in columns
    )))
    names = F.when(F.col("step") == -1, "still failing").when(F.col("step") == 0, "untouched")
    for i, step in enumerate(program, 1):
        names = names.when(F.col("step") == i, step.operation)
    counted = steps.select(pairs).groupBy("column_name", "step").agg(F.count(F.lit(1)).alias("n_values"))
    return counted.select("column_name", "step", names.alias("operation"), "n_values")


_HOLDS = {
    "<=": lambda a, b: a <= b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
}


def _holds(values: Sequence[Column], operators: Sequence[str]) -> Column:
    return all_of([_HOLDS[o](a, b) for o, a, b in zip(operators, values, values[1:])])


def _closed(operators: Sequence[str], up: bool) -> list[frozenset[int]]:
    """The sets of places that hold, with each place, all that must be greater (or smaller) than it."""
    n = len(operators) + 1
    edges = [(i, i + 1) if o.startswith("<") else (i + 1, i) for i, o in enumerate(operators)]
    found = []
    for size in range(1, n + 1):
        for own in map(frozenset, combinations(range(n), size)):
            if all((b in own or a not in own) if up else (a in own or b not in own) for a, b in edges):
                found.append(own)
    return found


def _fitted(values: Sequence[Column], operators: Sequence[str]) -> list[Column]:
    """The nearest values, by squares, that follow the order: at each place the greatest, over upper sets that hold it,
    of the least mean over what they share with a lower set that holds it."""
    uppers, lowers = _closed(operators, True), _closed(operators, False)

    def mean(places: frozenset[int]) -> Column:
        picked = [values[i] for i in sorted(places)]
        return reduce(lambda a, b: a + b, picked) / len(picked)

    def extreme(pick: Callable[..., Column], parts: list[Column]) -> Column:
        return parts[0] if len(parts) == 1 else pick(*parts)

    fitted = []
    for i in range(len(values)):
        shared = [
            sorted({u & low for low in lowers if i in low}, key=sorted) for u in uppers if i in u
        ]
        fitted.append(extreme(F.greatest, [extreme(F.least, [mean(s) for s in sets]) for sets in shared]))
    return fitted


def interval_repair(
    df: DataFrame, columns: Sequence[str], operators: Sequence[str], threshold: float, step: float = 1.0,
    kind: str = "repair",
) -> DataFrame:
    """`df` with the columns brought to the order that `operators` state between neighbours, and how (`kind`).

    A row that breaks it gets the first swap of two values that mends it; else the nearest values that follow it (by
    least squares), if none moves by more than `threshold` times the larger of its old and new size; else nulls.
    Strict operators ask for a distance of `step` when rounding. Rows with a null among the columns are kept.
    """
    if not 2 <= len(columns) <= MAX_ORDERED or len(operators) != len(columns) - 1 or set(operators) - set(_HOLDS):
        raise ValueError(f"2 to {MAX_ORDERED} columns, and between neighbours one of {sorted(_HOLDS)}")
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold lies between 0 and 1")
    types = dict(df.dtypes)
    whole = {c: types[c] in ("tinyint", "smallint", "int", "bigint") for c in columns}
    if len({types[c] for c in columns}) > 1:
        raise ValueError("columns of one order must have one type, so that their values can be swapped")
    if kind in df.columns:
        raise ValueError(f"{kind!r} is a column already")
    own = [F.col(c) for c in columns]
    broken = all_of([v.isNotNull() for v in own]) & ~_holds(own, operators)

    swaps = []
    for i, j in combinations(range(len(own)), 2):
        order = list(range(len(own)))
        order[i], order[j] = j, i
        swaps.append(F.struct(*(own[k].alias(f"v{p}") for p, k in enumerate(order))))
    fields = [f"v{p}" for p in range(len(own))]
    swapped = F.get(F.filter(F.array(*swaps), lambda s: _holds([s[f] for f in fields], operators)), F.lit(0))

    # A strict operator becomes a plain one between values less what must lie between them.
    apart, at = [0.0], 0.0
    for o in operators:
        at += {"<": step, ">": -step}.get(o, 0.0)
        apart.append(at)
    level = [v.cast("double") - d for v, d in zip(own, apart)]
    fitted = [
        (F.round(v) if whole[c] else v) + d for v, d, c in zip(_fitted(level, operators), apart, columns)
    ]
    numbers = all(t in ("float", "double") or t.startswith("decimal") or whole[c] for c, t in ((c, types[c]) for c in columns))

    marked = df.withColumn("__broken", F.coalesce(broken, F.lit(False)))
    marked = marked.withColumn("__swapped", F.when(F.col("__broken"), swapped))
    asked = F.col("__broken") & F.col("__swapped").isNull()
    if numbers:
        marked = marked.withColumn("__fitted", F.when(asked, F.array(*fitted)))
        new = [F.col("__fitted")[i] for i in range(len(own))]
        near = all_of([
            F.abs(n - v.cast("double")) <= threshold * F.greatest(F.abs(n), F.abs(v.cast("double")))
            for n, v in zip(new, own)
        ])
        rounded = asked & near & _holds([n.cast(types[c]) for n, c in zip(new, columns)], operators)
    else:
        new, rounded = [F.lit(None)] * len(own), F.lit(False)
    marked = marked.withColumn(
        kind,
        F.when(~F.col("__broken"), "kept").when(F.col("__swapped").isNotNull(), "swapped")
        .when(rounded, "rounded").otherwise("nulled"),
    )
    repaired = {
        c: F.when(F.col(kind) == "kept", v).when(F.col(kind) == "swapped", F.col("__swapped")[f])
        .when(F.col(kind) == "rounded", n.cast(types[c])).alias(c)
        for c, v, f, n in zip(columns, own, fields, new)
    }
    return marked.select(*(repaired.get(c, F.col(c)) for c in df.columns), kind)
