"""Completeness, uniqueness, formats, labels, intervals and references, with their failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import (
    ADDRESS_PARTS,
    cast_columns,
    expand_column,
    fold_accents,
    tags,
)
from plumbline.operators import checks, references
from plumbline.operators.contains import contains_join
from plumbline.sources.unions import union_frames
from workload.common import (
    RUN_1,
    Tables,
    blanked,
    orders,
    register,
    rounded,
    sql_blanked,
    sql_number,
    sql_orders,
)

O = sql_orders()
AT_1 = f"TIMESTAMP '{RUN_1}'"

# Each metric as a pair: Spark over (tables, gap, run), SQL over (gap, run).


def completeness(t: Tables, every: int, at: str, columns=("o_custkey", "o_totalprice", "o_orderpriority")):
    return rounded(checks.completeness(orders(t, every), columns, "orders", at), 9, "completeness_percent")


def sql_completeness(every: int, at: str, columns=("o_custkey", "o_totalprice", "o_orderpriority")) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'orders' AS source, '{c}' AS column_name,
        round(count({c})::DOUBLE / count(*), 9) AS completeness_percent,
        TIMESTAMP '{at}' AS "timestamp" FROM {sql_orders(every)}"""
        for c in columns
    )


def uniqueness(t: Tables, every: int, at: str):
    keys = [("o_custkey", "o_orderdate"), ("o_custkey", "o_orderpriority", "o_orderstatus")]
    return rounded(
        checks.uniqueness(orders(t, every), keys, "orders", at).drop("columns"), 9, "uniqueness_percent"
    )


def sql_unique(table: str, columns: str, source: str, at: str) -> str:
    label = ", ".join(sorted(c.strip() for c in columns.split(",")))
    return f"""SELECT '{source}' AS source, '{label}' AS column_name,
    round(1 - sum(CASE WHEN n > 1 THEN n ELSE 0 END)::DOUBLE / sum(n), 9) AS uniqueness_percent,
    TIMESTAMP '{at}' AS "timestamp"
    FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns})"""


def sql_uniqueness(every: int, at: str) -> str:
    table = sql_orders(every)
    return (
        sql_unique(table, "o_custkey, o_orderdate", "orders", at)
        + " UNION ALL "
        + sql_unique(table, "o_custkey, o_orderpriority, o_orderstatus", "orders", at)
    )


PRIORITY = r"^\d-[A-Z]+$"


def text_format(t: Tables, every: int, at: str):
    return rounded(
        checks.text_format(orders(t, every), ["o_orderpriority"], PRIORITY, "orders", at), 9, "format_percent"
    )


def sql_format(every: int, at: str) -> str:
    return f"""SELECT 'orders' AS source, 'o_orderpriority' AS column_name,
    round(1 - count(*) FILTER (NOT regexp_matches(o_orderpriority, '{PRIORITY}'))::DOUBLE / count(*), 9)
      AS format_percent, TIMESTAMP '{at}' AS "timestamp" FROM {sql_orders(every)}"""


def labels(t: Tables, every: int, at: str):
    data = orders(t, every)
    parts = [
        checks.allowed_labels(data, ["o_orderstatus"], ["O", "F"], "orders", at),
        checks.allowed_labels(data, ["o_orderpriority"], ["1-URGENT", "2-HIGH"], "orders", at),
    ]
    return rounded(union_frames(parts), 9, "labels_percent")


def sql_labels(every: int, at: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'orders' AS source, '{c}' AS column_name,
        round(1 - count(*) FILTER ({c} NOT IN ({values}))::DOUBLE / count(*), 9) AS labels_percent,
        TIMESTAMP '{at}' AS "timestamp" FROM {sql_orders(every)}"""
        for c, values in (("o_orderstatus", "'O','F'"), ("o_orderpriority", "'1-URGENT','2-HIGH'"))
    )


def interval(t: Tables, every: int, at: str):
    return rounded(
        checks.interval_validity(orders(t, every), [("low", "mid", "high")], "orders", at), 9, "interval_percent"
    )


FAILS_INTERVAL = (
    f"NOT ({sql_number('low')} <= {sql_number('mid')} AND {sql_number('mid')} <= {sql_number('high')})"
)


def sql_interval(every: int, at: str) -> str:
    return f"""SELECT 'orders' AS source, 'low' AS column_name_min, 'mid' AS column_name_target,
    'high' AS column_name_max,
    round(1 - count(*) FILTER ({FAILS_INTERVAL})::DOUBLE / count(*), 9) AS interval_percent,
    TIMESTAMP '{at}' AS "timestamp" FROM {sql_orders(every)}"""


def customers(t: Tables):
    """Customers in credit: a real subset, so that some orders have no partner."""
    return t.customer.where("c_acctbal > 0").withColumn("c_text", F.col("c_custkey").cast("string"))


SQL_CUSTOMERS = "(SELECT *, CAST(c_custkey AS VARCHAR) AS c_text FROM customer WHERE c_acctbal > 0)"


def foreign_key(t: Tables, every: int, at: str):
    pairs = [("o_custkey", "c_custkey"), ("o_custkey", "c_text")]
    return rounded(
        references.foreign_key(orders(t, every), customers(t), pairs, ("orders", "customer"), at), 9, "fk_percent"
    )


def sql_foreign_key(every: int, at: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'orders' AS source_1, 'customer' AS source_2, 'o_custkey' AS column_name_1,
        '{c}' AS column_name_2,
        round(count(*) FILTER (o.o_custkey IN (SELECT c_custkey FROM {SQL_CUSTOMERS}))::DOUBLE
              / count(*), 9) AS fk_percent, TIMESTAMP '{at}' AS "timestamp" FROM {sql_orders(every)} o"""
        for c in ("c_custkey", "c_text")
    )


register("completeness", sql_completeness(11, RUN_1))(lambda t: completeness(t, 11, RUN_1))
register("uniqueness", sql_uniqueness(11, RUN_1))(lambda t: uniqueness(t, 11, RUN_1))
register("format", sql_format(11, RUN_1))(lambda t: text_format(t, 11, RUN_1))
register("labels", sql_labels(11, RUN_1))(lambda t: labels(t, 11, RUN_1))
register("interval", sql_interval(11, RUN_1))(lambda t: interval(t, 11, RUN_1))
register("fk_exact", sql_foreign_key(11, RUN_1))(lambda t: foreign_key(t, 11, RUN_1))


@register(
    "null_policy",
    f"""SELECT 'orders' AS source, 'o_orderpriority' AS column_name,
    round(count(*) FILTER (regexp_matches(o_orderpriority, '{PRIORITY}'))::DOUBLE / count(*), 9)
      AS format_percent, {AT_1} AS "timestamp" FROM {O}""",
)
def _null_policy(t: Tables):
    scores = checks.text_format(orders(t), ["o_orderpriority"], PRIORITY, "orders", RUN_1, nulls="fail")
    return rounded(scores, 9, "format_percent")


ORDER_CHECKS = [
    checks.not_null("o_custkey"),
    checks.not_null("o_totalprice"),
    checks.matches("o_orderpriority", PRIORITY),
    checks.one_of("o_orderstatus", ["O", "F"]),
    checks.one_of("o_custkey", [1, 2, "3"]),
    checks.ordered("low", "mid", "high"),
]
SQL_ORDER_CHECKS = (
    ("completeness", "o_custkey", "o_custkey IS NULL", None),
    ("completeness", "o_totalprice", "o_totalprice IS NULL", None),
    ("format", "o_orderpriority", f"NOT regexp_matches(o_orderpriority, '{PRIORITY}')", PRIORITY),
    ("labels", "o_orderstatus", "o_orderstatus NOT IN ('O','F')", None),
    ("labels", "o_custkey", "o_custkey NOT IN (1, 2, 3)", None),
    ("interval", "low, mid, high", FAILS_INTERVAL, None),
)


@register(
    "row_checks",
    " UNION ALL ".join(
        f"""SELECT 'orders' AS source, '{metric}' AS metric, '{rule}' AS rule,
        count(*) FILTER ({fails}) AS failed_rows, count(*) AS total_rows,
        round(1 - count(*) FILTER ({fails})::DOUBLE / count(*), 9) AS score, {AT_1} AS "timestamp"
        FROM {O}"""
        for metric, rule, fails, _ in SQL_ORDER_CHECKS
    ),
)
def _row_checks(t: Tables):
    """Six checks, one scan, one aggregation."""
    scores = checks.score_checks(orders(t), ORDER_CHECKS, "orders", RUN_1)
    return rounded(scores.drop("columns", "detail"), 9, "score")


@register(
    "row_violations",
    " UNION ALL ".join(
        f"""SELECT 'orders' AS source, '{metric}' AS metric, '{rule}' AS column_name,
        {f"'{detail}'" if detail else 'CAST(NULL AS VARCHAR)'} AS detail, o_orderkey
        FROM {O} WHERE {fails}"""
        for metric, rule, fails, detail in SQL_ORDER_CHECKS
    ),
)
def _row_violations(t: Tables):
    return checks.list_violations(orders(t), ORDER_CHECKS, "orders", ["o_orderkey"])


def _violations(metric: str, index: list[int]):
    def build(t: Tables):
        picked = [ORDER_CHECKS[i] for i in index]
        return checks.list_violations(orders(t), picked, "orders", ["o_orderkey"]).drop("metric", "detail")

    sql = " UNION ALL ".join(
        f"SELECT 'orders' AS source, '{SQL_ORDER_CHECKS[i][1]}' AS column_name, o_orderkey "
        f"FROM {O} WHERE {SQL_ORDER_CHECKS[i][2]}"
        for i in index
    )
    register(f"{metric}_violations", sql)(build)


_violations("completeness", [0, 1])
_violations("format", [2])
_violations("labels", [3, 4])
_violations("interval", [5])


@register(
    "uniqueness_violations",
    f"""SELECT 'orders' AS source, 'o_custkey, o_orderdate' AS column_name, o_orderkey
    FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM {O}) WHERE n > 1""",
)
def _uniqueness_violations(t: Tables):
    return checks.uniqueness_violations(orders(t), ["o_custkey", "o_orderdate"], "orders", ["o_orderkey"])


@register(
    "uniqueness_lineitem",
    sql_unique("lineitem", "l_orderkey, l_linenumber", "lineitem", RUN_1)
    + " UNION ALL "
    + sql_unique("lineitem", "l_orderkey, l_partkey, l_suppkey", "lineitem", RUN_1),
)
def _uniqueness_lineitem(t: Tables):
    keys = [("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey", "l_suppkey")]
    scores = checks.uniqueness(t.lineitem, keys, "lineitem", RUN_1).drop("columns")
    return rounded(scores, 9, "uniqueness_percent")


@register("uniqueness_texts", sql_unique("documents", "text", "documents", RUN_1))
def _uniqueness_texts(t: Tables):
    scores = checks.uniqueness(t.documents, [["text"]], "documents", RUN_1).drop("columns")
    return rounded(scores, 9, "uniqueness_percent")


SQL_PARTIES = """(SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier)"""


@register("uniqueness_union", sql_unique(SQL_PARTIES, "nation, balance", "customer+supplier", RUN_1))
def _uniqueness_union(t: Tables):
    both = union_frames(
        [
            t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
            t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
        ]
    )
    scores = checks.uniqueness(both, [["nation", "balance"]], "customer+supplier", RUN_1).drop("columns")
    return rounded(scores, 9, "uniqueness_percent")


@register(
    "fk_violations",
    f"""SELECT 'orders' AS source_1, 'customer' AS source_2, 'o_custkey, c_custkey' AS column_name, o_orderkey
    FROM {O} o WHERE NOT EXISTS (SELECT 1 FROM {SQL_CUSTOMERS} c WHERE c.c_custkey = o.o_custkey)""",
)
def _fk_violations(t: Tables):
    return references.foreign_key_violations(
        orders(t), customers(t), [("o_custkey", "c_custkey")], ("orders", "customer"), ["o_orderkey"]
    )


# Fuzzy reference: the customer number, as text, somewhere inside a customer's name.


def _order_tags(t: Tables):
    number = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), F.col("o_custkey"))).otherwise(
        F.concat(F.lit(" "), F.col("o_custkey"), F.lit("7/Nobody "))
    )
    return t.orders.select("o_orderkey", number.alias("tag"))


SQL_ORDER_TAGS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'x' || o_custkey
    ELSE ' ' || o_custkey || '7/Nobody ' END AS tag FROM orders)"""
SQL_TAG_HIT = f"""EXISTS (SELECT 1 FROM (SELECT unnest(string_split(lower(v.tag), '/')) AS one) x
    JOIN {SQL_CUSTOMERS} c ON contains(trim(lower(c.c_name)), trim(x.one)) WHERE trim(x.one) <> '')"""
SQL_TAG_VALUES = f"(SELECT tag, {SQL_TAG_HIT} AS hit FROM (SELECT DISTINCT tag FROM {SQL_ORDER_TAGS}) v)"


@register(
    "fk_fuzzy",
    f"""SELECT 'orders' AS source_1, 'customer' AS source_2, 'tag' AS column_name_1,
    'c_name' AS column_name_2, round(count(*) FILTER (hit)::DOUBLE / count(*), 9) AS fk_percent,
    {AT_1} AS "timestamp" FROM {SQL_ORDER_TAGS} JOIN {SQL_TAG_VALUES} USING (tag)""",
)
def _fk_fuzzy(t: Tables):
    scores = references.fuzzy_foreign_key(
        _order_tags(t), customers(t), [("tag", "c_name")], ("orders", "customer"), RUN_1
    )
    return rounded(scores, 9, "fk_percent")


@register(
    "fk_fuzzy_violations",
    f"""SELECT 'orders' AS source_1, 'customer' AS source_2, 'tag, c_name' AS column_name, o_orderkey
    FROM {SQL_ORDER_TAGS} JOIN {SQL_TAG_VALUES} USING (tag) WHERE NOT hit""",
)
def _fk_fuzzy_violations(t: Tables):
    return references.fuzzy_foreign_key_violations(
        _order_tags(t), customers(t), [("tag", "c_name")], ("orders", "customer"), ["o_orderkey"]
    )


# Addresses: "Évry, 00012, 45 Allée Building"; a tenth of them malformed.


def addresses(t: Tables):
    code = F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
    house = (F.col("c_custkey") % 100).cast("string")
    street = F.concat(F.lit("Allée "), F.initcap("c_mktsegment"), F.lit(" d'été "))
    good = F.concat(F.lit("Évry, "), code, F.lit(", "), house, F.lit(" "), street)
    bad = F.concat(F.lit("Évry "), code, F.lit(" "), house)
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 10 == 3, bad).otherwise(good).alias("address"))


SQL_ADDRESSES = """(SELECT c_custkey, CASE WHEN c_custkey % 10 = 3
    THEN 'Évry ' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || ' ' || (c_custkey % 100)
    ELSE 'Évry, ' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || ', ' || (c_custkey % 100)
      || ' Allée ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' d''été ' END AS address
    FROM customer)"""


def _sql_part(pattern: str) -> str:
    return f"upper(strip_accents(nullif(regexp_extract(address, '{pattern}', 1), '')))"


PARTS = dict(ADDRESS_PARTS)
SQL_PARTS = f"""(SELECT c_custkey, CAST({_sql_part(PARTS['N'])} AS BIGINT) AS "N",
    {_sql_part(PARTS['Nom_Rue'])} AS "Nom_Rue", {_sql_part(PARTS['Code_Postal'])} AS "Code_Postal"
    FROM {SQL_ADDRESSES})"""


@register("expand_columns", f"SELECT * FROM {SQL_PARTS}")
def _expand_columns(t: Tables):
    return expand_column(addresses(t), "address", ADDRESS_PARTS, types={"N": "bigint"}).drop("address")


def _places(t: Tables):
    return t.supplier.select(
        F.col("s_suppkey").alias("N"), F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("Code_Postal")
    )


SQL_PLACES = """(SELECT DISTINCT s_suppkey AS "N", lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS "Code_Postal"
    FROM supplier)"""
KEYS = ["N", "Code_Postal"]


@register(
    "fk_expanded",
    f"""SELECT 'customer' AS source_1, 'supplier' AS source_2, 'address' AS column_name_1,
    'N, Code_Postal' AS column_name_2, round(count(s."N")::DOUBLE / count(*), 9) AS fk_percent,
    {AT_1} AS "timestamp" FROM {SQL_PARTS} p LEFT JOIN {SQL_PLACES} s USING ("N", "Code_Postal")""",
)
def _fk_expanded(t: Tables):
    scores = references.expanded_foreign_key(
        addresses(t), _places(t), "address", ADDRESS_PARTS, [], KEYS, ("customer", "supplier"), RUN_1
    )
    return rounded(scores, 9, "fk_percent")


@register(
    "fk_expanded_violations",
    f"""SELECT 'customer' AS source_1, 'supplier' AS source_2, 'N, Code_Postal' AS column_name, c_custkey
    FROM {SQL_PARTS} p ANTI JOIN {SQL_PLACES} s USING ("N", "Code_Postal")""",
)
def _fk_expanded_violations(t: Tables):
    return references.expanded_foreign_key_violations(
        addresses(t), _places(t), "address", ADDRESS_PARTS, [], KEYS, ("customer", "supplier"), ["c_custkey"]
    )


@register("fold_accents", "SELECT doc_id, md5(strip_accents(text)) AS folded FROM documents")
def _fold_accents(t: Tables):
    return t.documents.select("doc_id", F.md5(fold_accents(F.col("text"))).alias("folded"))


@register(
    "cast_columns",
    f"SELECT o_orderkey, CAST(replace({sql_blanked('CAST(floor(o_totalprice) AS BIGINT)')}, ' ', '') AS BIGINT) AS price FROM orders",
)
def _cast_columns(t: Tables):
    text = t.orders.select("o_orderkey", blanked(F.floor("o_totalprice")).alias("price"))
    return text.transform(cast_columns(["price"], "bigint", (r"\s+", "")))


@register(
    "tag_split",
    """SELECT DISTINCT doc_id, tag FROM (SELECT doc_id, trim(unnest(string_split(lower(source || ' / ' || lang
    || '//' || upper(lang)), '/'))) AS tag FROM documents) WHERE tag <> ''""",
)
def _tag_split(t: Tables):
    text = F.concat("source", F.lit(" / "), "lang", F.lit("//"), F.upper("lang"))
    return t.documents.select("doc_id", F.explode(tags(text)).alias("tag"))


# Substring joins


def nations(t: Tables):
    tag = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("zz"), "n_name")).otherwise(
        F.concat(F.lower("n_name"), F.lit("/ none"))
    )
    return t.nation.select("n_nationkey", tag.alias("tag"))


def sellers(t: Tables):
    text = F.concat("s_name", F.lit(" of nation_"), F.col("s_nationkey"), F.lit("."))
    return t.supplier.select("s_suppkey", text.alias("ref"))


SQL_NATIONS = """(SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'zz' || n_name
    ELSE lower(n_name) || '/ none' END AS tag FROM nation)"""
SQL_SELLERS = "(SELECT s_suppkey, s_name || ' of nation_' || s_nationkey || '.' AS ref FROM supplier)"
SQL_PAIRS = f"""(SELECT DISTINCT n_nationkey, s_suppkey FROM (SELECT n_nationkey,
    trim(unnest(string_split(lower(tag), '/'))) AS one FROM {SQL_NATIONS}) JOIN {SQL_SELLERS}
    ON contains(trim(lower(ref)), one) WHERE one <> '')"""


@register(
    "contains_inner",
    f"SELECT n_nationkey, tag, s_suppkey, ref FROM {SQL_PAIRS} JOIN {SQL_NATIONS} USING (n_nationkey) JOIN {SQL_SELLERS} USING (s_suppkey)",
)
def _contains_inner(t: Tables):
    return contains_join(nations(t), sellers(t), "tag", "ref", how="inner")


@register(
    "contains_left",
    f"SELECT n_nationkey, tag, s_suppkey, ref FROM {SQL_NATIONS} LEFT JOIN {SQL_PAIRS} USING (n_nationkey) LEFT JOIN {SQL_SELLERS} USING (s_suppkey)",
)
def _contains_left(t: Tables):
    return contains_join(nations(t), sellers(t), "tag", "ref", how="left")


@register(
    "contains_right",
    f"SELECT s_suppkey, ref, n_nationkey, tag FROM {SQL_NATIONS} LEFT JOIN {SQL_PAIRS} USING (n_nationkey) LEFT JOIN {SQL_SELLERS} USING (s_suppkey)",
)
def _contains_right(t: Tables):
    """Tags on the right side, whose rows are all kept."""
    return contains_join(sellers(t), nations(t), "ref", "tag", included="right", how="right")


@register(
    "contains_texts",
    """WITH tags AS (SELECT DISTINCT item_id, trim(t, E' \\n\\t\\r') AS one FROM (SELECT item_id,
      unnest(string_split(lower(text), '/')) AS t FROM benchmark) WHERE trim(t, E' \\n\\t\\r') <> '')
    SELECT DISTINCT item_id, doc_id FROM tags JOIN documents
    ON contains(trim(lower(documents.text), E' \\n\\t\\r'), one)""",
)
def _contains_texts(t: Tables):
    """Which whole documents hold a passage, literally."""
    passages = t.benchmark.select("item_id", F.col("text").alias("passage"))
    return contains_join(passages, t.documents.select("doc_id", "text"), "passage", "text", how="inner").select(
        "item_id", "doc_id"
    )
