"""Dispersion, position ratios, quantiles, regression between sources, and their repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.numbers import rescale
from plumbline.operators import dispersion as d
from plumbline.operators.impute import impute
from plumbline.operators.quantiles import exact_quantiles, theil_sen
from plumbline.operators.rescale import (
    Triplet,
    atypical_ratios,
    choose_transform,
    factor_table,
    repair_dispersion,
    repair_position_ratio,
)
from workload.common import RUN_1, Tables, gap, orders, register, rounded, sql_gap, sql_number, sql_orders

AT_1 = f"TIMESTAMP '{RUN_1}'"
CV = "stddev_samp({0}) / abs(avg({0}))"


@register(
    "cv",
    " UNION ALL ".join(
        f"""SELECT 'lineitem' AS source, '{c}' AS column_name, round({CV.format(c)}, 9) AS cv,
        {AT_1} AS "timestamp" FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def _cv(t: Tables):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(d.variation_table(t.lineitem, columns, "lineitem", RUN_1), 9, "cv")


def dispersion(t: Tables, every: int, at: str):
    table = d.dispersion(orders(t, every), "o_totalprice", t.lineitem, "l_quantity", ("orders", "lineitem"), at)
    return rounded(table, 9, "dispersion_difference")


def sql_dispersion(every: int, at: str) -> str:
    return f"""SELECT 'orders' AS source_1, 'lineitem' AS source_2, 'o_totalprice' AS column_name_1,
    'l_quantity' AS column_name_2, round(difference, 9) AS dispersion_difference,
    CASE WHEN difference <= ln(5) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dispersion_score,
    TIMESTAMP '{at}' AS "timestamp"
    FROM (SELECT abs(ln((SELECT {CV.format('l_quantity')} FROM lineitem) /
      (SELECT {CV.format('o_totalprice')} FROM {sql_orders(every)}))) AS difference)"""


register("dispersion", sql_dispersion(11, RUN_1))(lambda t: dispersion(t, 11, RUN_1))


def position_ratio(t: Tables, every: int, at: str):
    """Quantity between the price per part of an order line and its price: always ordered."""
    data = _triplets(t, every)
    table = d.position_ratio_table(data, [("low", "mean", "high", 0.1, 0.9)], "lineitem", at)
    return rounded(table, 9, "ratio_position", "ratio_score")


def _triplets(t: Tables, every: int):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        (price * 0.5).alias("low"),
        (price * (0.5 + F.col("l_discount") * 8 + F.col("l_tax"))).alias("mean"),
        gap("l_orderkey", every, "l_extendedprice").alias("high0"),
    ).select("low", "mean", (F.col("high0") * 1.5).alias("high"))


def sql_position_ratio(every: int, at: str) -> str:
    return f"""SELECT 'lineitem' AS source, 'low' AS column_name_min, 'mean' AS column_name_mean,
    'high' AS column_name_max, round(r, 9) AS ratio_position, round(1 - r, 9) AS ratio_score,
    TIMESTAMP '{at}' AS "timestamp"
    FROM (SELECT avg(CASE WHEN (mean - low) / (high - low) < 0.1 OR (mean - low) / (high - low) > 0.9
      THEN 1.0 ELSE 0.0 END) AS r
      FROM (SELECT l_extendedprice * 0.5 AS low,
        l_extendedprice * (0.5::DOUBLE + l_discount * 8 + l_tax) AS mean,
        {sql_gap('l_orderkey', every, 'l_extendedprice')} * 1.5 AS high FROM lineitem)
      WHERE high IS NOT NULL)"""


register("position_ratio", sql_position_ratio(11, RUN_1))(lambda t: position_ratio(t, 11, RUN_1))

PERCENTS = "[" + ", ".join(f"{i / 100:.2f}" for i in range(1, 100)) + "]"


def _sql_quantiles(column: str, table: str) -> str:
    return f"""SELECT unnest({PERCENTS})::DOUBLE AS probability,
    unnest(quantile_cont({column}::DOUBLE, {PERCENTS})) AS quantile FROM {table}"""


@register(
    "quantiles_99",
    f"SELECT probability, round(quantile, 6) AS quantile FROM ({_sql_quantiles('l_extendedprice', 'lineitem')})",
)
def _quantiles(t: Tables):
    return rounded(exact_quantiles(t.lineitem, "l_extendedprice"), 6, "quantile")


@register(
    "quantiles_tied",
    f"SELECT probability, round(quantile, 6) AS quantile FROM ({_sql_quantiles('l_quantity', 'lineitem')})",
)
def _quantiles_tied(t: Tables):
    return rounded(exact_quantiles(t.lineitem, "l_quantity"), 6, "quantile")


def _prices(t: Tables):
    return (
        t.orders.select(F.col("o_totalprice").alias("price")),
        t.lineitem.select((F.col("l_extendedprice") * 10 + 500).alias("price")),
    )


SQL_LINE = f"""
WITH q AS (SELECT a.probability, a.quantile AS x, b.quantile AS y
  FROM ({_sql_quantiles('o_totalprice', 'orders')}) a
  JOIN ({_sql_quantiles('(l_extendedprice * 10 + 500)', 'lineitem')}) b USING (probability)),
s AS (SELECT median((b.y - a.y) / (b.x - a.x)) AS slope FROM q a JOIN q b ON b.x > a.x),
i AS (SELECT slope, median(y - slope * x) AS intercept FROM q, s GROUP BY slope),
r AS (SELECT slope, intercept, 1 - sum((y - slope * x - intercept) ** 2)
        / sum((y - (SELECT avg(y) FROM q)) ** 2) AS r2 FROM q, i GROUP BY slope, intercept)
"""


@register(
    "theil_sen",
    SQL_LINE + "SELECT round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r2, 6) AS r2 FROM r",
)
def _theil_sen(t: Tables):
    line = theil_sen(*_prices(t), "price")
    return rounded(rounded(line, 6, "slope", "r2"), 4, "intercept")


@register(
    "repair_dispersion",
    SQL_LINE
    + """SELECT o_orderkey, round(o_totalprice * slope + intercept, 2) AS price, 'theil_sen' AS method
    FROM orders, r WHERE r2 >= 0.95""",
)
def _repair_dispersion(t: Tables):
    """No known factor is near, the line is good: all prices are mapped by it."""
    left = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"))
    fixed, method = repair_dispersion(left, _prices(t)[1], "price", [1000.0], 0.05)
    return rounded(fixed.withColumn("method", F.lit(method)), 2, "price")


@register(
    "rescale",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity * 12.0::DOUBLE + 1.5::DOUBLE AS l_quantity FROM lineitem",
)
def _rescale(t: Tables):
    factor, offset, _ = choose_transform(12.2, 1.0, 0.99, [10.0, 12.0], 0.05)
    return rescale(
        t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"), "l_quantity", factor, offset + 1.5
    )


# Position ratios of orders, with salaries as text; where o_orderkey is a multiple of 4 the
# highest value is yearly instead of monthly.


def salaries(t: Tables):
    high = F.col("o_totalprice") * F.when(F.col("o_orderkey") % 4 == 0, 24.0).otherwise(2.0)

    def text(value):
        return F.concat(F.lit(" "), F.floor(value).cast("string"), F.lit(" "))

    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 != 0, text(F.col("o_totalprice") * 0.6)).alias("low"),
        text(F.col("o_totalprice")).alias("mean"),
        F.when(F.col("o_orderkey") % 31 == 0, F.lit("unknown")).otherwise(text(high)).alias("high"),
    )


def _sql_text(value: str) -> str:
    return f"' ' || CAST(CAST(floor({value}) AS BIGINT) AS VARCHAR) || ' '"


def _sql_try(column: str) -> str:
    return sql_number(column).replace("CAST(", "TRY_CAST(", 1)


SQL_SALARIES = f"""(SELECT o_orderkey,
  CASE WHEN o_orderkey % 9 <> 0 THEN {_sql_text('o_totalprice * 0.6::DOUBLE')} END AS low,
  {_sql_text('o_totalprice')} AS mean,
  CASE WHEN o_orderkey % 31 = 0 THEN 'unknown' ELSE
    {_sql_text('o_totalprice * CASE WHEN o_orderkey % 4 = 0 THEN 24.0::DOUBLE ELSE 2.0::DOUBLE END')} END AS high
  FROM orders)"""
SQL_NUMBERS = f"""(SELECT *, {_sql_try('low')} AS l, {_sql_try('mean')} AS m, {_sql_try('high')} AS h
  FROM {SQL_SALARIES})"""
SQL_ATYPICAL = """coalesce(l <= m AND m <= h AND l < h
  AND ((m - l) / (h - l) < 0.1 OR (m - l) / (h - l) > 0.9), false)"""
SALARY = Triplet("low", "mean", "high")
FACTORS = [12.0, 10.0, 30.0]


def _sql_repairs(high: str) -> str:
    return f"""coalesce(l <= m AND m <= {high} AND l < {high}
      AND (m - l) / ({high} - l) BETWEEN 0.1 AND 0.9, false)"""


@register(
    "atypical_ratios",
    f"SELECT o_orderkey, round((m - l) / (h - l), 9) AS ratio FROM {SQL_NUMBERS} WHERE {SQL_ATYPICAL}",
)
def _atypical(t: Tables):
    return rounded(atypical_ratios(salaries(t), SALARY, ["o_orderkey"]), 9, "ratio")


@register(
    "ratio_factors",
    " UNION ALL ".join(
        f"""SELECT {2 * i + j} AS seq, {f}::DOUBLE AS factor, '{op}' AS operation,
        count(*) FILTER ({_sql_repairs(f'(h {sign} {f}::DOUBLE)')}) AS repaired, count(*) AS total
        FROM {SQL_NUMBERS} WHERE {SQL_ATYPICAL}"""
        for i, f in enumerate(FACTORS)
        for j, (op, sign) in enumerate((("multiply", "*"), ("divide", "/")))
    ),
)
def _factors(t: Tables):
    return factor_table(salaries(t), SALARY, "high", FACTORS)


@register(
    "ratio_repair",
    f"""SELECT o_orderkey, low, mean, CASE WHEN {SQL_ATYPICAL} AND {_sql_repairs('(h / 12.0::DOUBLE)')}
    THEN round(h / 12.0::DOUBLE, 6) ELSE h END AS high, 'divide_by_12' AS method FROM {SQL_NUMBERS}""",
)
def _ratio_repair(t: Tables):
    fixed, method, _, _ = repair_position_ratio(salaries(t), SALARY, "high", FACTORS)
    return rounded(fixed.withColumn("method", F.lit(method)), 6, "high")


@register("mice")
def _mice(t: Tables):
    """Three columns with gaps of their own; about 2^3 missing patterns."""
    data = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        gap("l_orderkey", 7, "l_quantity").alias("quantity"),
        gap("l_partkey", 11, "l_extendedprice").alias("price"),
        F.when(F.col("l_suppkey") % 13 != 0, F.floor(F.col("l_extendedprice") * F.col("l_tax"))).alias("tax"),
    )
    filled = impute(data, ["quantity", "price", "tax"])
    return filled.groupBy("l_linenumber").agg(
        F.count("quantity").alias("quantities"),
        F.count("price").alias("prices"),
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.sum("tax").alias("tax"),
    )


SQL_GAPPED_PRICES = f"""(SELECT l_orderkey, l_linenumber, l_quantity,
    {sql_gap('(l_orderkey + l_partkey)', 7, 'l_extendedprice')} AS price FROM lineitem)"""


@register(
    "impute_line",
    f"""WITH d AS {SQL_GAPPED_PRICES}, line AS (
      SELECT regr_slope(price, l_quantity) AS slope, regr_intercept(price, l_quantity) AS base FROM d)
    SELECT l_linenumber, count(*) AS n, round(avg(coalesce(price, base + slope * l_quantity)), 4) AS mean_price,
      round(min(coalesce(price, base + slope * l_quantity)), 4) AS least,
      round(max(CASE WHEN price IS NULL THEN base + slope * l_quantity END), 4) AS greatest_filled
    FROM d, line GROUP BY l_linenumber""",
)
def _impute_line(t: Tables):
    """One column with gaps: whatever the number of rounds, its regression line on the other column."""
    known = F.when((F.col("l_orderkey") + F.col("l_partkey")) % 7 != 0, F.col("l_extendedprice"))
    data = t.lineitem.select("l_linenumber", "l_quantity", known.alias("price"), known.isNull().alias("gap"))
    filled = impute(data, ["l_quantity", "price"], regression="least_squares")
    return filled.groupBy("l_linenumber").agg(
        F.count("price").alias("n"),
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.round(F.min("price"), 4).alias("least"),
        F.round(F.max(F.when(F.col("gap"), F.col("price"))), 4).alias("greatest_filled"),
    )
