"""Repairs of conformity and joins of what is only similar."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators.checks import list_violations, matches
from plumbline.operators.conform import Step, format_repair, format_report, interval_repair
from plumbline.operators.similarity import similarity_join
from workload.common import Tables, register, rounded

# Names of parts, and how they were typed: a letter lost, one too many, two wrong.
SQL_TITLES = "(SELECT p_partkey AS part, p_name || ' ' || p_brand || ' ' || p_type AS title FROM part)"
SQL_TYPED = f"""(SELECT part AS note, CASE part % 4 WHEN 0 THEN title[1:4] || title[6:] WHEN 1 THEN title || 's'
    WHEN 2 THEN 'Q' || title[2:6] || 'q' || title[8:] ELSE title END AS typed FROM {SQL_TITLES} WHERE part % 3 = 0)"""


def _titles(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("part"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title")
    )


def _typed(t: Tables):
    own = F.col("title")
    rest = F.length(own)
    typed = (
        F.when(F.col("part") % 4 == 0, F.concat(F.substring(own, 1, 4), F.substring(own, F.lit(6), rest)))
        .when(F.col("part") % 4 == 1, F.concat(own, F.lit("s")))
        .when(
            F.col("part") % 4 == 2,
            F.concat(F.lit("Q"), F.substring(own, 2, 5), F.lit("q"), F.substring(own, F.lit(8), rest)),
        )
        .otherwise(own)
    )
    return _titles(t).where("part % 3 = 0").select(F.col("part").alias("note"), typed.alias("typed"))


@register(
    "similarity_join",
    f"""SELECT note, part, round(1 - levenshtein(typed, title)::DOUBLE / greatest(length(typed), length(title)), 9)
      AS similarity
    FROM {SQL_TYPED} JOIN {SQL_TITLES}
      ON levenshtein(typed, title) * 100 <= greatest(length(typed), length(title)) * 7""",
)
def _similar(t: Tables):
    found = similarity_join(_typed(t), _titles(t), "typed", "title", 0.93)
    return rounded(found.select("note", "part", "similarity"), 9, "similarity")





@register(
    "similarity_join_names",
    """SELECT a.c_custkey AS customer, b.c_custkey AS other FROM customer a JOIN customer b
      ON levenshtein(a.c_name, b.c_name) <= 1""",
)
def _similar_names(t: Tables):
    """Names that share their whole beginning: what is common generates no candidates."""
    own = t.customer.select(F.col("c_custkey").alias("customer"), F.col("c_name").alias("a"))
    other = t.customer.select(F.col("c_custkey").alias("other"), F.col("c_name").alias("b"))
    return similarity_join(own, other, "a", "b", "0.94").select("customer", "other")


@register(
    "similarity_words",
    f"""WITH a AS (SELECT note, list_distinct(string_split(typed, ' ')) AS ws FROM {SQL_TYPED}),
    b AS (SELECT part, list_distinct(string_split(title, ' ')) AS ws FROM {SQL_TITLES})
    SELECT note, part, round(len(list_intersect(a.ws, b.ws))::DOUBLE / len(list_distinct(a.ws || b.ws)), 9) AS similarity
    FROM a JOIN b ON len(list_intersect(a.ws, b.ws)) * 10 >= len(list_distinct(a.ws || b.ws)) * 6""",
)
def _similar_words(t: Tables):
    found = similarity_join(_typed(t), _titles(t), "typed", "title", 0.6, "words")
    return rounded(found.select("note", "part", "similarity"), 9, "similarity")


# Priorities as clerks write them, and the program that brings them to their format.
PRIORITY = r"^\d-[A-Z ]+$"
PROGRAM = [Step("trim"), Step("upper"), Step("replace", (r"^PRIO ", "")), Step("replace", (r"(?<=^\d) ", "-"))]
SQL_PRIORITIES = """(SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN lower(o_orderpriority)
    WHEN 1 THEN ' ' || o_orderpriority || ' ' WHEN 2 THEN 'prio ' || replace(o_orderpriority, '-', ' ')
    WHEN 3 THEN '?' || o_orderpriority WHEN 4 THEN NULL ELSE o_orderpriority END AS priority FROM orders)"""
SQL_PROGRAM = f"""(SELECT o_orderkey, priority, v0, v1, v2, v3, v4, CASE WHEN v0 IS NULL OR regexp_matches(v0, '{PRIORITY}')
      OR o_orderkey % 5 = 0 THEN 0 WHEN regexp_matches(v1, '{PRIORITY}') THEN 1 WHEN regexp_matches(v2, '{PRIORITY}') THEN 2
      WHEN regexp_matches(v3, '{PRIORITY}') THEN 3 WHEN regexp_matches(v4, '{PRIORITY}') THEN 4 ELSE -1 END AS step
    FROM (SELECT *, regexp_replace(v3, '^([0-9]) ', '\\1-') AS v4 FROM
      (SELECT *, regexp_replace(v2, '^PRIO ', '') AS v3 FROM (SELECT *, upper(v1) AS v2 FROM
        (SELECT *, priority AS v0, trim(priority) AS v1 FROM {SQL_PRIORITIES})))))"""


def _priorities(t: Tables):
    own, key = F.col("o_orderpriority"), F.col("o_orderkey")
    written = (
        F.when(key % 6 == 0, F.lower(own)).when(key % 6 == 1, F.concat(F.lit(" "), own, F.lit(" ")))
        .when(key % 6 == 2, F.concat(F.lit("prio "), F.replace(own, F.lit("-"), F.lit(" "))))
        .when(key % 6 == 3, F.concat(F.lit("?"), own)).when(key % 6 == 4, F.lit(None)).otherwise(own)
    )
    return t.orders.select("o_orderkey", written.alias("priority"))


def _failing(t: Tables):
    """The registry of failing rows, without every fifth order: those are not to be touched."""
    failing = list_violations(_priorities(t), [matches("priority", PRIORITY)], "orders", ["o_orderkey"])
    return failing.where("o_orderkey % 5 <> 0")


@register(
    "format_repair",
    f"SELECT o_orderkey, CASE step WHEN 1 THEN v1 WHEN 2 THEN v2 WHEN 3 THEN v3 WHEN 4 THEN v4 ELSE v0 END AS priority FROM {SQL_PROGRAM}",
)
def _format(t: Tables):
    return format_repair(_priorities(t), ["priority"], PRIORITY, PROGRAM, _failing(t), "o_orderkey")


@register(
    "format_report",
    f"""SELECT 'priority' AS column_name, CAST(step AS INTEGER) AS step,
    CASE step WHEN -1 THEN 'still failing' WHEN 0 THEN 'untouched' WHEN 1 THEN 'trim' WHEN 2 THEN 'upper' ELSE 'replace' END
      AS operation, count(*) AS n_values FROM {SQL_PROGRAM} GROUP BY step""",
)
def _report(t: Tables):
    return format_report(_priorities(t), ["priority"], PRIORITY, PROGRAM, _failing(t), "o_orderkey")


# Bounds around a price, of which some are in each other's place, a little off, or far off.
SQL_BOUNDS = """(SELECT l_orderkey, l_linenumber,
    CASE l_orderkey % 10 WHEN 1 THEN l_extendedprice * 1.1::DOUBLE WHEN 2 THEN l_extendedprice WHEN 3 THEN l_extendedprice
      WHEN 4 THEN NULL ELSE l_extendedprice * 0.9::DOUBLE END AS low,
    CASE l_orderkey % 10 WHEN 2 THEN l_extendedprice * 1.01::DOUBLE WHEN 3 THEN l_extendedprice * 2 ELSE l_extendedprice END AS mid,
    CASE l_orderkey % 10 WHEN 1 THEN l_extendedprice * 0.9::DOUBLE WHEN 2 THEN l_extendedprice * 0.99::DOUBLE
      WHEN 3 THEN l_extendedprice * 0.5::DOUBLE ELSE l_extendedprice * 1.1::DOUBLE END AS high FROM lineitem)"""
_THREE = "(low + mid + high) / 3"
SQL_FITTED = f"""(SELECT *, low <= mid AND mid <= high AS fits, mid <= low AND low <= high AS swap_01,
    high <= mid AND mid <= low AS swap_02, low <= high AND high <= mid AS swap_12,
    least(low, (low + mid) / 2, {_THREE}) AS f0,
    greatest(least(mid, (mid + high) / 2), least((low + mid) / 2, {_THREE})) AS f1,
    greatest(high, (mid + high) / 2, {_THREE}) AS f2 FROM {SQL_BOUNDS})"""
SQL_KINDS = f"""(SELECT *, CASE WHEN coalesce(fits, true) THEN 'kept' WHEN swap_01 OR swap_02 OR swap_12 THEN 'swapped'
    WHEN abs(f0 - low) <= 0.05::DOUBLE * greatest(f0, low) AND abs(f1 - mid) <= 0.05::DOUBLE * greatest(f1, mid)
      AND abs(f2 - high) <= 0.05::DOUBLE * greatest(f2, high) THEN 'rounded' ELSE 'nulled' END AS repair FROM {SQL_FITTED})"""


@register(
    "interval_repair",
    f"""SELECT l_orderkey, l_linenumber, repair,
    round(CASE repair WHEN 'kept' THEN low WHEN 'swapped' THEN CASE WHEN swap_01 THEN mid WHEN swap_02 THEN high ELSE low END
      WHEN 'rounded' THEN f0 END, 4) AS low,
    round(CASE repair WHEN 'kept' THEN mid WHEN 'swapped' THEN CASE WHEN swap_01 THEN low WHEN swap_02 THEN mid ELSE high END
      WHEN 'rounded' THEN f1 END, 4) AS mid,
    round(CASE repair WHEN 'kept' THEN high WHEN 'swapped' THEN CASE WHEN swap_01 THEN high WHEN swap_02 THEN low ELSE mid END
      WHEN 'rounded' THEN f2 END, 4) AS high FROM {SQL_KINDS}""",
)
def _intervals(t: Tables):
    return rounded(_repaired_bounds(t), 4, "low", "mid", "high")


def _repaired_bounds(t: Tables):
    price, case = F.col("l_extendedprice"), F.col("l_orderkey") % 10
    bounds = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(case == 1, price * 1.1).when((case == 2) | (case == 3), price).when(case != 4, price * 0.9).alias("low"),
        F.when(case == 2, price * 1.01).when(case == 3, price * 2).otherwise(price).alias("mid"),
        F.when(case == 1, price * 0.9).when(case == 2, price * 0.99).when(case == 3, price * 0.5)
        .otherwise(price * 1.1).alias("high"),
    )
    return interval_repair(bounds, ["low", "mid", "high"], ["<=", "<="], 0.05)


@register("interval_kinds", f"SELECT repair, count(*) AS n_rows FROM {SQL_KINDS} GROUP BY repair")
def _kinds(t: Tables):
    return _repaired_bounds(t).groupBy("repair").agg(F.count(F.lit(1)).alias("n_rows"))
