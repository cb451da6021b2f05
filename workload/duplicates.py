"""Functional dependencies, duplicate groups, clusters, survivors."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.operators.checks import uniqueness_violations
from plumbline.operators.components import connected_components
from plumbline.operators.dedup import (
    choose_survivors,
    deduplicate,
    exact_groups,
    with_flags,
)
from plumbline.operators.dependencies import g3_errors, search_dependencies, violating_groups
from workload.common import Tables, gap, register, rounded


def sql_g3(table: str, lhs: list[str], rhs: str) -> str:
    """One row (n, g3): rows with a null left out, the most frequent rhs per lhs kept."""
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*lhs, rhs])
    by_lhs = f"GROUP BY {', '.join(lhs)}" if lhs else ""
    names = "".join(f"{c}, " for c in lhs)
    return f"""SELECT coalesce(sum(n), 0) AS n, coalesce((sum(n) - sum(kept))::DOUBLE / sum(n), 0.0) AS g3
    FROM (SELECT max(c) AS kept, sum(c) AS n FROM (SELECT {names}count(*) AS c FROM {table} WHERE {known}
      GROUP BY {', '.join([*lhs, rhs])}) {by_lhs})"""


def sql_list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]::VARCHAR[]"


CANDIDATES = [
    (["p_name"], "p_brand"),
    ([], "p_type"),
    (["p_brand", "p_name"], "p_type"),
    (["p_brand", "p_name", "p_size"], "p_type"),
    (["p_partkey"], "p_name"),
    (["p_size"], "p_retailprice"),
]
SQL_GAPPED = "(SELECT * REPLACE (CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS p_type) FROM part)"


@register(
    "g3_scores",
    " UNION ALL ".join(
        f"""SELECT '{', '.join(sorted(lhs))}' AS lhs, '{rhs}' AS rhs, n::BIGINT AS n_rows, round(g3, 9) AS g3
        FROM ({sql_g3(SQL_GAPPED, lhs, rhs)})"""
        for lhs, rhs in CANDIDATES
    ),
)
def _g3(t: Tables):
    data = t.part.withColumn("p_type", gap("p_partkey", 9, "p_type"))
    scores = g3_errors(data, CANDIDATES).withColumn("lhs", F.array_join("lhs", ", "))
    return rounded(scores, 9, "g3")


KEY = ["p_brand", "p_name", "p_size", "p_type"]
EPSILON = 0.3


def _sql_found() -> str:
    """Every dependency inside KEY with at most three columns left of it, if minimal and good enough."""
    tests = [
        (list(lhs), rhs)
        for rhs in KEY
        for size in range(4)
        for lhs in combinations([c for c in KEY if c != rhs], size)
    ]
    every = " UNION ALL ".join(
        f"SELECT {sql_list(lhs)} AS lhs, '{rhs}' AS rhs, g3 FROM ({sql_g3('part', lhs, rhs)})" for lhs, rhs in tests
    )
    return f"""(WITH e AS ({every}), ok AS (SELECT * FROM e WHERE g3 <= {EPSILON})
    SELECT * FROM ok a WHERE NOT EXISTS (SELECT 1 FROM ok b WHERE a.rhs = b.rhs AND len(b.lhs) < len(a.lhs)
      AND list_has_all(a.lhs, b.lhs)))"""


@register(
    "fd_search",
    f"SELECT array_to_string(lhs, ', ') AS lhs, rhs, round(g3, 9) AS g3 FROM {_sql_found()}",
)
def _fd_search(t: Tables):
    found = search_dependencies(t.part, [KEY], EPSILON)
    rows = [(", ".join(sorted(d.lhs)), d.rhs, round(d.error, 9)) for d in found]
    return t.spark.createDataFrame(rows, "lhs string, rhs string, g3 double")


def _text_registry(t: Tables):
    failing = uniqueness_violations(t.documents, ["text"], "documents", ["doc_id"])
    return failing.withColumnRenamed("doc_id", "row_id")


@register(
    "exact_groups",
    """SELECT doc_id AS row_id, first_row FROM (SELECT doc_id, min(doc_id) OVER w AS first_row, count(*) OVER w AS n
    FROM documents WINDOW w AS (PARTITION BY text)) WHERE n > 1""",
)
def _exact_groups(t: Tables):
    work = with_flags(t.documents, _text_registry(t), "doc_id", "documents")
    return exact_groups(work, ["text"], ["text"], "doc_id")


@register(
    "violating_groups",
    """SELECT p_brand, p_name, p_size, count(*) AS n_rows, min(p_partkey) AS first_row FROM part
    GROUP BY p_brand, p_name, p_size HAVING count(DISTINCT p_type) > 1""",
)
def _violating(t: Tables):
    return violating_groups(t.part, ["p_name", "p_brand", "p_size"], "p_type", "p_partkey")


# Customers k and k + 1 are tied where k's nation is below 20: chains, whose components are runs.
SQL_RUNS = """(SELECT c_custkey AS node, min(c_custkey) OVER (PARTITION BY run) AS component,
    count(*) OVER (PARTITION BY run) AS n FROM (SELECT c_custkey, sum(CASE WHEN tied THEN 0 ELSE 1 END)
      OVER (ORDER BY c_custkey) AS run FROM (SELECT c_custkey,
        coalesce(lag(c_nationkey) OVER (ORDER BY c_custkey) < 20, false) AS tied FROM customer)))"""


@register("connected_components", f"SELECT node, component FROM {SQL_RUNS} WHERE n > 1")
def _components(t: Tables):
    left = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("a"))
    known = t.customer.select((F.col("c_custkey") - 1).alias("a"))
    edges = left.join(known, "a", "left_semi").select("a", (F.col("a") + 1).alias("b"))
    return connected_components(edges, "a", "b")


@register(
    "survivors",
    f"""SELECT node AS row_id, survivor_id, node = survivor_id AS is_survivor FROM (SELECT node,
      first_value(node) OVER (PARTITION BY component ORDER BY balance DESC NULLS LAST,
        (balance IS NULL)::INTEGER + (segment IS NULL)::INTEGER, node) AS survivor_id
      FROM {SQL_RUNS} JOIN (SELECT c_custkey,
        CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance,
        CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment FROM customer) ON node = c_custkey
      WHERE n > 1)""",
)
def _survivors(t: Tables):
    data = t.customer.select(
        "c_custkey", gap("c_custkey", 3, "c_acctbal").alias("balance"), gap("c_custkey", 5, "c_mktsegment").alias("segment")
    )
    return choose_survivors(data, _components(t), "c_custkey", order_by="balance")


@register(
    "dedup_documents",
    "SELECT min(doc_id) AS doc_id, any_value(n_chars) AS n_chars FROM documents GROUP BY text",
)
def _dedup_documents(t: Tables):
    result = deduplicate(t.documents, _text_registry(t), "documents", "doc_id")
    return result.deduped.select("doc_id", "n_chars")


# Part rows tied by an equal key, or by a dependency violation around a flagged row.


def _sql_ties() -> str:
    key = ", ".join(KEY)
    flagged = f"(SELECT *, count(*) OVER (PARTITION BY {key}) > 1 AS flagged FROM part)"
    exact = f"""SELECT p_partkey AS a, min(p_partkey) OVER (PARTITION BY {key}) AS b FROM {flagged} WHERE flagged"""
    parts = [exact]
    for rhs in KEY:
        others = [c for c in KEY if c != rhs]
        for size in (1, 2, 3):
            for lhs in combinations(others, size):
                by = ", ".join(lhs)
                parts.append(
                    f"""SELECT a, b FROM (SELECT p_partkey AS a, min(p_partkey) OVER w AS b,
                    min({rhs}) OVER w <> max({rhs}) OVER w AND bool_or(flagged) OVER w AS hit FROM {flagged}
                    WINDOW w AS (PARTITION BY {by})) WHERE hit AND EXISTS (SELECT 1 FROM found
                      WHERE lhs = {sql_list(lhs)} AND rhs = '{rhs}')"""
                )
    return " UNION ".join(parts)


SQL_CLUSTERS = f"""WITH RECURSIVE found AS MATERIALIZED (SELECT * FROM {_sql_found()}),
ties AS MATERIALIZED ({_sql_ties()}),
linked AS MATERIALIZED (SELECT a, b FROM ties UNION SELECT b, a FROM ties),
reach AS (SELECT a AS node, a AS seen FROM linked UNION SELECT r.node, e.b FROM reach r JOIN linked e ON r.seen = e.a),
clusters AS (SELECT node, min(seen) AS component, count(*) AS n FROM reach GROUP BY node),
chosen AS (SELECT node, first_value(node) OVER (PARTITION BY component
  ORDER BY p_retailprice DESC NULLS LAST, node) AS survivor_id FROM clusters JOIN part ON node = p_partkey)
"""


def _dedup_parts(t: Tables):
    registry = uniqueness_violations(t.part, KEY, "part", ["p_partkey"]).withColumnRenamed("p_partkey", "row_id")
    return deduplicate(t.part, registry, "part", "p_partkey", EPSILON, order_by="p_retailprice")


@register(
    "duplicate_clusters",
    SQL_CLUSTERS + "SELECT node AS row_id, survivor_id, node = survivor_id AS is_survivor FROM chosen",
)
def _clusters(t: Tables):
    return _dedup_parts(t).clusters


@register(
    "dedup_parts",
    SQL_CLUSTERS
    + "SELECT * FROM part WHERE p_partkey NOT IN (SELECT node FROM chosen WHERE node <> survivor_id)",
)
def _deduped(t: Tables):
    return _dedup_parts(t).deduped
