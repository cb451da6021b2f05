"""Unions: strict, widening, with missing columns, and by materialised stand-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "__union__"

Mode = Literal["vertical", "vertical_relaxed", "diagonal", "diagonal_relaxed"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _widened(own: T.DataType, types: Sequence[T.DataType]) -> T.DataType | None:
    """The type to cast to before a union of `types`: text if any is text, a number for a boolean among numbers.

    None where nothing is to be done: Spark widens numbers by itself.
    """
    if len({t.simpleString() for t in types}) == 1:
        return None
    if any(isinstance(t, T.StringType) for t in types):
        return T.StringType()
    if isinstance(own, T.BooleanType) and any(isinstance(t, T.NumericType) for t in types):
        return T.ByteType()
    return None


def union_frames(frames: Sequence[DataFrame], how: Mode = "vertical") -> DataFrame:
    """Union ALL of `frames`.

    vertical: same columns and types. vertical_relaxed: same columns, types widened (number and
    text become text, boolean and number a number). diagonal: missing columns become null. diagonal_relaxed: both.
    """
    frames = list(frames)
    if how not in ("vertical", "vertical_relaxed", "diagonal", "diagonal_relaxed"):
        raise ValueError(f"unknown union mode {how!r}")
    if how.startswith("vertical") and any(f.columns != frames[0].columns for f in frames[1:]):
        raise ValueError(f"columns differ: {[f.columns for f in frames]}")
    by_column: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            by_column.setdefault(field.name, []).append(field.dataType)
    if not how.endswith("relaxed"):
        mixed = {
            c: [t.simpleString() for t in types]
            for c, types in by_column.items()
            if len({t.simpleString() for t in types}) > 1
        }
        if mixed:
            raise ValueError(f"types differ: {mixed}")
    else:
        frames = [
            f.withColumns(
                {g.name: F.col(g.name).cast(t) for g in f.schema if (t := _widened(g.dataType, by_column[g.name]))}
            )
            for f in frames
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stand_in_name(names: Sequence[str]) -> str:
    return SEPARATOR.join(names)


def resolve_stand_ins(names: Sequence[str], available: Sequence[str]) -> list[str]:
    """Replace runs of source names by the stored union of exactly that run.

    Read left to right; at each place the longest stored union that fits wins, and a source is
    covered at most once.
    """
    runs = sorted(
        (parts for name in available if len(parts := name.split(SEPARATOR)) > 1),
        key=len,
        reverse=True,
    )
    resolved: list[str] = []
    rest = list(names)
    while rest:
        run = next((r for r in runs if rest[: len(r)] == r), rest[:1])
        resolved.append(stand_in_name(run))
        rest = rest[len(run):]
    return resolved


def union_sources(
    names: Sequence[str], catalog: Mapping[str, DataFrame], how: Mode = "vertical",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Union of the named tables of `catalog`, using its stored unions where they fit."""
    frames = [catalog[name] for name in resolve_stand_ins(names, list(catalog))]
    if columns is not None:
        frames = [frame.select(*columns) for frame in frames]
    return union_frames(frames, how)


def union_row_ids(
    sources: Sequence[str], tables: Mapping[str, DataFrame], row_id: str
) -> dict[str, DataFrame]:
    """`tables` with ids of `sources` that are unique over their union, if each is unique in its own table.

    Ingestion numbers every source from 0. The id n of the i-th of k sources becomes n * k + i, so
    the registry written for the union and a later deduplication of it name the same rows.
    """
    k = len(sources)
    numbered = {
        name: tables[name].withColumn(row_id, F.col(row_id).cast("bigint") * k + i) for i, name in enumerate(sources)
    }
    return {**tables, **numbered}


def require_unique(rows: DataFrame, row_id: str) -> None:
    """Raise if an id is null or names two rows."""
    repeated = rows.groupBy(row_id).count().where((F.col("count") > 1) | F.col(row_id).isNull())
    if not repeated.isEmpty():
        raise ValueError(f"{row_id!r} does not name rows: it repeats or is null")
