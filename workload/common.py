"""Registration, table access, and the tables with gaps that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN_1, RUN_2 = "2026-01-05 06:00:00", "2026-02-05 06:00:00"


class Tables:
    """Attribute access to the Parquet tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def register(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with its DuckDB twin."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def gap(key: str, every: int, column: str):
    """`column`, null where `key` is a multiple of `every`: the tables have no nulls of their own."""
    return F.when(F.col(key) % every != 0, F.col(column))


def sql_gap(key: str, every: int, column: str) -> str:
    return f"CASE WHEN {key} % {every} <> 0 THEN {column} END"


def blanked(n):
    """An integer as text with a blank before the last three digits: 16800 -> "16 800"."""
    n = n.cast("bigint")
    return F.concat(F.floor(n / 1000).cast("string"), F.lit(" "), F.lpad((n % 1000).cast("string"), 3, "0"))


def sql_blanked(n: str) -> str:
    return f"(CAST(({n}) // 1000 AS VARCHAR) || ' ' || lpad(CAST(({n}) % 1000 AS VARCHAR), 3, '0'))"


def orders(t: Tables, every: int = 11) -> DataFrame:
    """All orders with gaps, and a (low, mid, high) triplet written like salaries."""
    return t.orders.select(
        "o_orderkey",
        gap("o_orderkey", every, "o_custkey").alias("o_custkey"),
        "o_orderstatus",
        gap("o_orderkey", every + 2, "o_totalprice").alias("o_totalprice"),
        "o_orderdate",
        gap("o_orderkey", every + 4, "o_orderpriority").alias("o_orderpriority"),
        blanked(F.col("o_custkey") * 100).alias("low"),
        F.when(
            F.col("o_orderkey") % (every + 6) != 0, blanked(F.floor("o_totalprice"))
        ).alias("mid"),
        blanked(F.col("o_custkey") * 900 + 60000).alias("high"),
    )


def sql_orders(every: int = 11) -> str:
    return f"""(SELECT o_orderkey, {sql_gap('o_orderkey', every, 'o_custkey')} AS o_custkey,
    o_orderstatus, {sql_gap('o_orderkey', every + 2, 'o_totalprice')} AS o_totalprice, o_orderdate,
    {sql_gap('o_orderkey', every + 4, 'o_orderpriority')} AS o_orderpriority,
    {sql_blanked('o_custkey * 100')} AS low,
    CASE WHEN o_orderkey % {every + 6} <> 0
         THEN {sql_blanked('CAST(floor(o_totalprice) AS BIGINT)')} END AS mid,
    {sql_blanked('o_custkey * 900 + 60000')} AS high
    FROM orders)"""


def sql_number(column: str) -> str:
    return f"CAST(regexp_replace({column}, '\\s+', '', 'g') AS DOUBLE)"
