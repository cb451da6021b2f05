"""Foreign-key checks: exact, by contained tag, and on parts extracted from a text column.

Scores never touch single rows: the left side is first reduced to (key, rows per key), so a hot key
is one record, and only then compared with the distinct keys of the right side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import compact, expand_column
from plumbline.operators.checks import run_timestamp
from plumbline.operators.contains import has_match, value_key
from plumbline.operators.skew import COUNT, all_of, count_by, spread_join
from plumbline.sources.unions import union_all


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _as_key(df: DataFrame, column: str, as_text: bool) -> Column:
    key = F.col(column).cast("string") if as_text else F.col(column)
    return compact(key) if as_text or _is_text(df, column) else key


def _single_keys(
    left: DataFrame, right: DataFrame, c1: str, c2: str
) -> tuple[Column, DataFrame]:
    """The left key column, and the distinct non-null right keys as `k0`; text if only one is text."""
    as_text = _is_text(left, c1) != _is_text(right, c2)
    keys = right.select(_as_key(right, c2, as_text).alias("k0")).where("k0 is not null").distinct()
    return _as_key(left, c1, as_text), keys


def _hit_share(counts: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """(matched, total) rows: `counts` holds rows per left key, `keys` the distinct right keys."""
    marked = counts.join(keys.withColumn("__hit", F.lit(True)), list(on), "left")
    return marked.agg(
        F.sum(F.when(F.col("__hit"), F.col(COUNT)).otherwise(0)).alias("matched"),
        F.sum(COUNT).alias("total"),
    )


def _metric(share: DataFrame, sources, label_1: str | Column, label_2: str | Column, timestamp) -> DataFrame:
    label_1, label_2 = (F.lit(n) if isinstance(n, str) else n for n in (label_1, label_2))
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    return share.select(
        F.lit(sources[0]).alias("source_1"),
        F.lit(sources[1]).alias("source_2"),
        label_1.alias("column_name_1"),
        label_2.alias("column_name_2"),
        F.try_divide(F.col("matched").cast("double"), F.col("total").cast("double")).alias(
            "fk_percent"
        ),
        timestamp.alias("timestamp"),
    )


def _failing(rows: DataFrame, sources, label: str, row_key: Sequence[str]) -> DataFrame:
    return rows.select(
        F.lit(sources[0]).alias("source_1"),
        F.lit(sources[1]).alias("source_2"),
        F.lit(label).alias("column_name"),
        *row_key,
    )


def foreign_key(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
    sources: tuple[str, str], timestamp,
) -> DataFrame:
    """(source_1, source_2, column_name_1, column_name_2, fk_percent, timestamp) per column pair.

    A null on the left fails; nulls on the right match nothing. Both tables are read once for all pairs
    whose columns have the same types.
    """
    alike: dict[tuple[str, str], list[tuple[str, str, Column, Column]]] = {}
    for c1, c2 in pairs:
        as_text = _is_text(left, c1) != _is_text(right, c2)
        own, other = _as_key(left, c1, as_text), _as_key(right, c2, as_text)
        types = tuple(df.select(k.alias("k")).dtypes[0][1] for df, k in ((left, own), (right, other)))
        alike.setdefault(types, []).append((c1, c2, own, other))
    return union_all([_fused_metric(left, right, group, sources, timestamp) for group in alike.values()])


def _fused_metric(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str, Column, Column]], sources, timestamp
) -> DataFrame:
    """The metric of pairs of one type: every row unfolds into (pair, key), and one join serves them all."""
    columns = {c2: other for _, c2, _, other in pairs}
    place = {c2: j for j, c2 in enumerate(columns)}
    entries = [
        F.struct(F.lit(i).alias("pair"), F.lit(place[c2]).alias("j"), own.alias("k0"))
        for i, (_, c2, own, _) in enumerate(pairs)
    ]
    counts = count_by(left.select(F.inline(F.array(*entries))), ["pair", "j", "k0"])
    others = [F.struct(F.lit(place[c2]).alias("j"), key.alias("k0")) for c2, key in columns.items()]
    keys = right.select(F.inline(F.array(*others))).where("k0 is not null").distinct()
    marked = counts.join(keys.withColumn("__hit", F.lit(True)), ["j", "k0"], "left")

    def total(i: int, n: Column) -> Column:
        return F.sum(F.when(F.col("pair") == i, n))  # null without rows

    sums = marked.agg(F.array(*(
        F.struct(
            F.lit(c1).alias("column_name_1"), F.lit(c2).alias("column_name_2"),
            total(i, F.when(F.col("__hit"), F.col(COUNT)).otherwise(0)).alias("matched"), total(i, F.col(COUNT)).alias("total"),
        )
        for i, (c1, c2, _, _) in enumerate(pairs)
    )).alias("rows")).select(F.inline("rows"))
    return _metric(sums, sources, F.col("column_name_1"), F.col("column_name_2"), timestamp)


def foreign_key_violations(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
    sources: tuple[str, str], row_key: Sequence[str],
) -> DataFrame:
    """(source_1, source_2, column_name, row key) of rows without a partner."""
    parts = []
    for c1, c2 in pairs:
        key, keys = _single_keys(left, right, c1, c2)
        rows = left.select(*row_key, key.alias("k0"))
        parts.append(
            _failing(_rows_without(rows, keys, ["k0"]), sources, f"{c1}, {c2}", row_key)
        )
    return union_all(parts)


def _rows_without(rows, keys, on) -> DataFrame:
    counts = count_by(rows, on)
    missing = counts.join(keys, list(on), "left_anti").select(*on)
    return spread_join(rows, missing, on, "left_semi")


def fuzzy_foreign_key(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
    sources: tuple[str, str], timestamp,
) -> DataFrame:
    """As `foreign_key`, but a left value fits if one of its tags lies inside a right value."""
    parts = []
    for c1, c2 in pairs:
        counts = count_by(left.select(value_key(c1).alias("k0")), ["k0"])
        matched = has_match(left, right, c1, c2).withColumnRenamed("__key", "k0")
        parts.append(_metric(_hit_share(counts, matched, ["k0"]), sources, c1, c2, timestamp))
    return union_all(parts)


def fuzzy_foreign_key_violations(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
    sources: tuple[str, str], row_key: Sequence[str],
) -> DataFrame:
    parts = []
    for c1, c2 in pairs:
        rows = left.select(*row_key, value_key(c1).alias("k0"))
        matched = has_match(left, right, c1, c2).withColumnRenamed("__key", "k0")
        parts.append(
            _failing(
                _rows_without(rows, matched, ["k0"]),
                sources, f"{c1}, {c2}", row_key,
            )
        )
    return union_all(parts)


def _expanded(left, right, column, extractions, replacements, keys):
    parts = expand_column(
        left, column, extractions, replacements,
        types={k: right.schema[k].dataType for k in keys},
    )
    wanted = right.select(*keys).where(all_of([F.col(k).isNotNull() for k in keys])).distinct()
    return parts, wanted


def expanded_foreign_key(
    left: DataFrame, right: DataFrame, column: str, extractions: Sequence[tuple[str, str]],
    replacements: Sequence[tuple[str, str]], keys: Sequence[str],
    sources: tuple[str, str], timestamp,
) -> DataFrame:
    """Share of rows whose extracted `keys` occur together in `right`; key types come from `right`."""
    parts, wanted = _expanded(left, right, column, extractions, replacements, keys)
    share = _hit_share(count_by(parts, keys), wanted, keys)
    return _metric(share, sources, column, ", ".join(keys), timestamp)


def expanded_foreign_key_violations(
    left: DataFrame, right: DataFrame, column: str, extractions: Sequence[tuple[str, str]],
    replacements: Sequence[tuple[str, str]], keys: Sequence[str],
    sources: tuple[str, str], row_key: Sequence[str],
) -> DataFrame:
    parts, wanted = _expanded(left, right, column, extractions, replacements, keys)
    rows = parts.select(*dict.fromkeys([*row_key, *keys]))
    failing = _rows_without(rows, wanted, keys)
    return _failing(failing, sources, ", ".join(keys), row_key)
