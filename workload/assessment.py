"""A whole rulebook over several tables at once, and a deduplication over a union of sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import checks
from plumbline.plans.assessment import KeyRule, Reference, Rulebook, assess, violations
from plumbline.plans.incremental import IncrementalAssessment
from plumbline.plans.repair import DedupSettings, deduplicate_sources
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources.files import Folder
from plumbline.sources.unions import union_all, union_row_ids
from workload.common import RUN_1, Tables, gap, orders, register, rounded, sql_gap, sql_orders
from workload.conformity import ORDER_CHECKS, SQL_ORDER_CHECKS

SEGMENTS = ["BUILDING", "MACHINERY"]
RULES = Rulebook(
    row_checks={
        "orders": ORDER_CHECKS,
        "customer": [checks.not_null("c_acctbal"), checks.one_of("c_mktsegment", SEGMENTS)],
        "lineitem": [checks.not_null("l_quantity"), checks.one_of("l_returnflag", ["N", "R"])],
    },
    keys=[
        KeyRule(("orders",), ("o_custkey", "o_orderdate")),
        KeyRule(("orders",), ("o_custkey", "o_orderpriority")),
        KeyRule(("lineitem",), ("l_orderkey", "l_partkey")),
    ],
    references=[
        Reference("orders", "customer", (("o_custkey", "c_custkey"),)),
        Reference("orders", "supplier", (("o_custkey", "s_suppkey"),)),
        Reference("lineitem", "orders", (("l_orderkey", "o_orderkey"), ("l_partkey", "o_orderkey"))),
    ],
)
ROW_IDS = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_id"}


def _tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "orders": orders(t),
        "customer": t.customer.withColumn("c_acctbal", gap("c_custkey", 9, "c_acctbal")),
        "supplier": t.supplier,
        "lineitem": t.lineitem.withColumns(
            {
                "l_id": F.col("l_orderkey") * 100 + F.col("l_linenumber"),
                "l_quantity": gap("l_partkey", 17, "l_quantity"),
            }
        ),
    }


SQL_TABLES = {
    "orders": sql_orders(),
    "customer": f"(SELECT * REPLACE ({sql_gap('c_custkey', 9, 'c_acctbal')} AS c_acctbal) FROM customer)",
    "supplier": "supplier",
    "lineitem": f"""(SELECT * REPLACE ({sql_gap('l_partkey', 17, 'l_quantity')} AS l_quantity),
      l_orderkey * 100 + l_linenumber AS l_id FROM lineitem)""",
}
SQL_CHECKS = [
    *(("orders", *check) for check in SQL_ORDER_CHECKS),
    ("customer", "completeness", "c_acctbal", "c_acctbal IS NULL", None),
    ("customer", "labels", "c_mktsegment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", None),
    ("lineitem", "completeness", "l_quantity", "l_quantity IS NULL", None),
    ("lineitem", "labels", "l_returnflag", "l_returnflag NOT IN ('N', 'R')", None),
]
SQL_PAIRS = [(r.left, r.right, a, b) for r in RULES.references for a, b in r.pairs]


def _sql_scores() -> str:
    parts = [
        f"""SELECT '{metric}' AS metric, '{table}' AS source, '{rule}' AS rule,
        1 - count(*) FILTER ({fails})::DOUBLE / count(*) AS score FROM {SQL_TABLES[table]}"""
        for table, metric, rule, fails, _ in SQL_CHECKS
    ]
    parts += [
        f"""SELECT 'uniqueness', '{rule.label}', '{checks.key_label(rule.columns)}',
        1 - sum(CASE WHEN n > 1 THEN n ELSE 0 END)::DOUBLE / sum(n)
        FROM (SELECT count(*) AS n FROM {SQL_TABLES[rule.label]} GROUP BY {', '.join(rule.columns)})"""
        for rule in RULES.keys
    ]
    parts += [
        f"""SELECT 'foreign_key', '{left} -> {right}', '{a}, {b}', count(*) FILTER (
          {a} IN (SELECT {b} FROM {SQL_TABLES[right]} WHERE {b} IS NOT NULL))::DOUBLE / count(*) FROM {SQL_TABLES[left]}"""
        for left, right, a, b in SQL_PAIRS
    ]
    return f"""SELECT metric, source, rule, round(score, 9) AS score, TIMESTAMP '{RUN_1}' AS "timestamp"
    FROM ({' UNION ALL '.join(parts)})"""


@register("assess_scores", _sql_scores())
def _assess_scores(t: Tables):
    """All metrics of one run, in one shape."""
    return _one_shape(assess(_tables(t), RULES, RUN_1))


def _one_shape(found: dict[str, DataFrame]) -> DataFrame:
    def flat(metric: str, rows: DataFrame) -> DataFrame:
        starting = lambda start: [c for c in rows.columns if c.startswith(start)]
        score = next(c for c in rows.columns if c.endswith("_percent"))
        return rows.select(
            F.lit(metric).alias("metric"),
            F.concat_ws(" -> ", *starting("source")).alias("source"),
            F.concat_ws(", ", *starting("column_name")).alias("rule"),
            F.col(score).alias("score"),
            "timestamp",
        )

    return rounded(union_all([flat(m, rows) for m, rows in found.items()]), 9, "score")


@register("incremental_scores", f"SELECT * FROM ({_sql_scores()}) WHERE metric <> 'foreign_key'")
def _incremental(t: Tables):
    """Files come one by one, one is replaced and one goes; scores are those of what lies there in the end."""
    folder = f"{ensure_checkpoint_dir(t.spark)}/incremental-{uuid.uuid4().hex}"
    run = IncrementalAssessment(t.spark, f"{folder}/states", RULES)
    files = Folder(t.spark, folder)
    for source in ("orders", "customer", "lineitem"):
        rows = _tables(t)[source]
        part = F.pmod(F.xxhash64(*rows.columns[:2]), F.lit(3))
        for i in range(3):
            rows.where(part == i).write.mode("append").parquet(f"{folder}/{source}")
            if i == 1:  # a part that comes too early, and is gone again at the next run
                early = set(Folder(t.spark, f"{folder}/{source}").names())
                rows.where(part == 2).write.mode("append").parquet(f"{folder}/{source}")
                run.update(source, f"{folder}/{source}")
                for name in set(Folder(t.spark, f"{folder}/{source}").names()) - early:
                    files.remove(f"{source}/{name}")
        run.update(source, f"{folder}/{source}")
    return _one_shape(run.scores(RUN_1))


def _sql_failing() -> str:
    def failing(source: str, metric: str, rule: str, detail: str | None, row_id: str, rows: str) -> str:
        text = f"'{detail}'" if detail else "CAST(NULL AS VARCHAR)"
        return f"""SELECT '{source}' AS source, '{metric}: {rule}' AS rule, '{metric}' AS metric,
        '{rule}' AS column_name, {text} AS detail, CAST({row_id} AS BIGINT) AS row_id FROM {rows}"""

    parts = [
        failing(table, metric, rule, detail, ROW_IDS[table], f"{SQL_TABLES[table]} WHERE {fails}")
        for table, metric, rule, fails, detail in SQL_CHECKS
    ]
    parts += [
        failing(
            rule.label, "uniqueness", checks.key_label(rule.columns), None, ROW_IDS[rule.label],
            f"{SQL_TABLES[rule.label]} QUALIFY count(*) OVER (PARTITION BY {', '.join(rule.columns)}) > 1",
        )
        for rule in RULES.keys
    ]
    parts += [
        failing(
            f"{left} -> {right}", "foreign_key", f"{a}, {b}", None, ROW_IDS[left],
            f"{SQL_TABLES[left]} l WHERE NOT EXISTS (SELECT 1 FROM {SQL_TABLES[right]} r WHERE l.{a} = r.{b})",
        )
        for left, right, a, b in SQL_PAIRS
    ]
    return " UNION ALL ".join(parts)


@register("assess_violations", _sql_failing())
def _assess_violations(t: Tables):
    return violations(_tables(t), RULES, ROW_IDS)


# Customers and suppliers, each numbered from 0, are the same party if nation and balance band agree.
PARTIES = ("customer", "supplier")


def _parties(t: Tables) -> dict[str, DataFrame]:
    def party(rows: DataFrame, prefix: str, key: str) -> DataFrame:
        band = F.floor(F.col(f"{prefix}_acctbal") / 250).cast("bigint")
        return rows.select(
            (F.col(key) - 1).alias("row_id"),
            F.concat_ws(":", F.col(f"{prefix}_nationkey"), band).alias("party"),
            F.col(f"{prefix}_acctbal").alias("balance"),
        )

    return {"customer": party(t.customer, "c", "c_custkey"), "supplier": party(t.supplier, "s", "s_suppkey")}


SQL_PARTIES = " UNION ALL ".join(
    f"""SELECT ({key} - 1) * 2 + {place} AS row_id,
    {p}_nationkey || ':' || CAST(floor({p}_acctbal / 250) AS BIGINT) AS party, {p}_acctbal AS balance FROM {table}"""
    for place, (table, p, key) in enumerate([("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey")])
)


@register(
    "dedup_union",
    f"""SELECT row_id, party, balance FROM ({SQL_PARTIES})
    QUALIFY row_number() OVER (PARTITION BY party ORDER BY balance DESC, row_id) = 1""",
)
def _dedup_union(t: Tables):
    """Ids made unique over the union, the failing rows listed, then the duplicates removed."""
    catalog = union_row_ids(PARTIES, _parties(t), "row_id")
    rule = Rulebook(keys=[KeyRule(PARTIES, ("party",))])
    registry = violations(catalog, rule, {name: "row_id" for name in PARTIES})
    return deduplicate_sources(PARTIES, catalog, registry, DedupSettings(order_by="balance")).deduped
