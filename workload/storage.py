"""Formats, stores and versioned tables: written to the checkpoint folder, read back, compared as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.conform import Step
from plumbline.operators.rescale import Triplet
from plumbline.plans.assessment import KeyRule, Rulebook, run_assessment, violations
from plumbline.plans.repair import DedupSettings, FormatRule, OrderRule, repair_scale, repair_table
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources.registry import MetricStore, ViolationStore
from plumbline.sources.tables import TableSink, TableSource, VersionedTable, ingest, run_transform
from workload.assessment import ROW_IDS, RULES, _sql_failing, _sql_scores, _tables
from workload.common import RUN_1, RUN_2, Tables, register, rounded


def _folder(t: Tables, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


SQL_TEXTS = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def _round_trip(kind: str) -> None:
    def build(t: Tables) -> DataFrame:
        rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
        sink = TableSink(_folder(t, kind), kind)
        sink.write(rows)
        source = sink.as_source()
        return source.read(t.spark).select(*(F.col(f.name).cast(f.dataType) for f in rows.schema))

    register(f"round_trip_{kind}", SQL_TEXTS)(build)


for _kind in ("csv", "ndjson", "parquet"):
    _round_trip(_kind)


@register(
    "ingest_ids",
    """SELECT count(*) AS n, 0 AS least, count(*) - 1 AS greatest, count(*) AS ids,
    count(DISTINCT c_mktsegment) AS segments FROM customer""",
)
def _ingest(t: Tables):
    """A copy with dense ids from 0, through a transform that shuffles."""
    sink = TableSink(_folder(t, "ingest"), "parquet")
    source = TableSource(f"{t.folder}/customer.parquet", "parquet")
    ingest(t.spark, source, sink, lambda df: df.repartition("c_mktsegment"))
    return sink.as_source().read(t.spark).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("row_id").alias("least"),
        F.max("row_id").alias("greatest"),
        F.count_distinct("row_id").alias("ids"),
        F.count_distinct("c_mktsegment").alias("segments"),
    )


@register(
    "transform_of_two",
    "SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name",
)
def _transform(t: Tables):
    sink = TableSink(_folder(t, "transform"), "parquet")
    sources = [TableSource(f"{t.folder}/{name}.parquet") for name in ("nation", "customer")]

    def counted(nations: DataFrame, customers: DataFrame) -> DataFrame:
        both = nations.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        return both.groupBy("n_name").agg(F.count("c_custkey").alias("customers"))

    run_transform(t.spark, sources, counted, sink)
    return sink.as_source().read(t.spark)


@register(
    "versioned_upsert",
    """SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey < 10 THEN c_acctbal + 1 ELSE c_acctbal END AS balance
    FROM customer""",
)
def _versioned(t: Tables):
    """Customers of some nations come a second time with another balance, as a new version."""
    table = VersionedTable(_folder(t, "versions"))
    rows = t.customer.select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("balance"), "c_nationkey")
    table.write(rows.drop("c_nationkey"))
    changed = rows.where("c_nationkey < 10").withColumn("balance", F.col("balance") + 1).drop("c_nationkey")
    table.upsert(changed, ["c_custkey"], "last")
    return table.read(t.spark)


@register(
    "stored_violations",
    f"SELECT * FROM ({_sql_failing()}) WHERE rule <> 'labels: o_custkey'",
)
def _stored_violations(t: Tables):
    """Stored twice: the second run replaces what it checks and finds one rule without failing rows."""
    store = ViolationStore(_folder(t, "violations"))
    failing = violations(_tables(t), RULES, ROW_IDS)
    store.replace(failing, [])
    gone = ("orders", "labels: o_custkey")
    store.replace(failing.where("rule <> 'labels: o_custkey'"), [gone])
    return store.read(t.spark).select("source", "rule", "metric", "column_name", "detail", "row_id")


SQL_RUNS = " UNION ALL ".join(
    f"""SELECT source, rule AS column_name, score AS uniqueness_percent, TIMESTAMP '{at}' AS "timestamp"
    FROM ({_sql_scores()}) WHERE metric = 'uniqueness'"""
    for at in (RUN_1, RUN_2)
)


@register("stored_metrics", SQL_RUNS)
def _stored_metrics(t: Tables):
    """Two assessments appended to one history, read through its view."""
    folder = _folder(t, "runs")
    metrics, failing = MetricStore(f"{folder}/metrics"), ViolationStore(f"{folder}/failing")
    keys = Rulebook(keys=RULES.keys)
    for at in (RUN_1, RUN_2):
        run_assessment(_tables(t), keys, ROW_IDS, metrics, failing, at)
    prefix = f"m{uuid.uuid4().hex}_"
    metrics.views(t.spark, ["uniqueness"], prefix)
    return rounded(t.spark.table(f"{prefix}uniqueness"), 9, "uniqueness_percent")


@register(
    "repair_scale_applied",
    "SELECT s_suppkey, round(s_acctbal * 10, 6) AS s_acctbal FROM supplier",
)
def _repair_scale(t: Tables):
    """The balances of one source are a tenth of the other's: corrected, written, read back."""
    target = VersionedTable(_folder(t, "scale"))
    suppliers = t.supplier.select("s_suppkey", "s_acctbal")
    tenfold = suppliers.withColumn("s_acctbal", F.col("s_acctbal") * 10)
    dry = repair_scale(suppliers, tenfold, "s_acctbal", [10.0, 100.0], 0.05, target=target)
    if dry.written or target.exists(t.spark):
        raise AssertionError("a dry run must not write")
    repair_scale(suppliers, tenfold, "s_acctbal", [10.0, 100.0], 0.05, target=target, apply=True)
    return rounded(target.read(t.spark), 6, "s_acctbal")


# Every ninth mean is given for a month instead of a year, and each person twice.
SQL_PAY = """SELECT o_orderkey AS row_id, 'p' || (o_orderkey // 2) AS person, o_custkey::DOUBLE AS low,
    o_custkey * 1500.0::DOUBLE AS mid, o_custkey * 3000.0::DOUBLE AS high FROM orders"""


@register(
    "repair_in_order",
    f"""SELECT row_id, person, low, round(mid, 4) AS mid, high FROM ({SQL_PAY})
    QUALIFY row_number() OVER (PARTITION BY person ORDER BY row_id) = 1""",
)
def _repair(t: Tables):
    """Scale first, then duplicates; the ids keep the registry valid throughout."""
    custkey = F.col("o_custkey").cast("double")
    rows = t.orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit("p"), F.floor(F.col("o_orderkey") / 2).cast("bigint")).alias("person"),
        custkey.alias("low"),
        (custkey * F.when(F.col("o_custkey") % 9 == 0, 125.0).otherwise(1500.0)).alias("mid"),
        (custkey * 3000.0).alias("high"),
    )
    rule = Rulebook(keys=[KeyRule(("pay",), ("person",))])
    registry = violations({"pay": rows}, rule, {"pay": "row_id"})
    triplet = Triplet("low", "mid", "high")
    repaired = repair_table(rows, "pay", registry, DedupSettings(), (triplet, "mid", [60.0, 12.0]))
    return rounded(repaired, 4, "mid")


# The same people, written in two ways, bounds in each other's place, a column that says nothing, and gaps in the pay.
SQL_STAFF = """(SELECT o_orderkey AS row_id, 'p' || (o_orderkey // 2) AS person, o_custkey::DOUBLE AS low,
    o_custkey * 3.0::DOUBLE AS high, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS pay FROM orders)"""
SQL_ONE_EACH = f"(SELECT * FROM {SQL_STAFF} QUALIFY row_number() OVER (PARTITION BY person ORDER BY pay IS NULL, row_id) = 1)"


@register(
    "repair_whole_order",
    f"""WITH one AS {SQL_ONE_EACH}, line AS (
      SELECT regr_slope(pay, low) AS slope, regr_intercept(pay, low) AS base FROM one)
    SELECT row_id, person, low, high, round(coalesce(pay, base + slope * low), 4) AS pay FROM one, line""",
)
def _repair_whole(t: Tables):
    """Formats and bounds first, then duplicates among what is written alike now, then columns, then gaps."""
    key = F.col("o_orderkey")
    name = F.concat(F.lit("p"), F.floor(key / 2).cast("bigint"))
    low, high = F.col("o_custkey").cast("double"), F.col("o_custkey") * 3.0
    rows = t.orders.select(
        key.alias("row_id"),
        F.when(key % 2 == 1, F.concat(F.lit("  "), F.upper(name))).otherwise(name).alias("person"),
        F.when(key % 4 == 3, high).otherwise(low).alias("low"),
        F.when(key % 4 == 3, low).otherwise(high).alias("high"),
        F.when(key % 6 != 0, F.col("o_totalprice")).alias("pay"),
        F.col("o_orderstatus").alias("noise"),
    )
    rule = Rulebook(keys=[KeyRule(("staff",), ("person",))])
    repaired = repair_table(
        rows, "staff", lambda df: violations({"staff": df}, rule, {"staff": "row_id"}),
        formats=[FormatRule(("person",), r"^p\d+$", (Step("trim"), Step("lower")))],
        orders=[OrderRule(("low", "high"), ("<=",), 0.1)],
        incoherent=["noise"], impute_columns=["low", "pay"], regression="least_squares",
    )
    return rounded(repaired.select("row_id", "person", "low", "high", "pay"), 4, "pay")


SQL_DIFFICULT = """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 11 = 0 THEN NULL
      ELSE replace(replace(text, 'e', '"'), '. ', chr(10)) || ',"' END AS text, lang FROM documents"""


@register("round_trip_csv_texts", f"SELECT doc_id, sha256(text) AS digest, lang FROM ({SQL_DIFFICULT})")
def _difficult_texts(t: Tables):
    """Texts with quotes, separators and line breaks, and empty ones beside nulls, written as CSV and read back."""
    broken = F.replace(F.replace("text", F.lit("e"), F.lit('"')), F.lit(". "), F.lit("\n"))
    rows = t.documents.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 11 != 0, F.concat(broken, F.lit(',"'))).alias("text"),
        "lang",
    )
    sink = TableSink(_folder(t, "difficult"), "csv")
    sink.write(rows)
    return sink.as_source().read(t.spark).select(F.col("doc_id").cast("bigint"), F.sha2("text", 256).alias("digest"), "lang")
