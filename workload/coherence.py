"""Statistical coherence between columns."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from plumbline.operators import coherence as c
from plumbline.plans.assessment import KeyRule, Reference, Rulebook
from plumbline.plans.coherent import coherent_projection
from plumbline.session import checkpoint
from plumbline.sources.unions import union_all
from workload.common import RUN_1, Tables, gap, orders, register, rounded, sql_orders

AT_1 = f"TIMESTAMP '{RUN_1}'"
DIGITS = 5
MS = ("M1", "M2", "M3")


def sql_measures(x: str, y: str, groups: str, rows: str, total_var: str) -> str:
    """M1..M3 from a relation of groups (n, var, dist)."""
    return f"""SELECT '{x}' AS x, '{y}' AS y,
    round((tv - within) / (tv + 1e-11), {DIGITS}) AS "M1",
    round(worst / (within + 1e-11), {DIGITS}) AS "M2",
    round(farthest / (sqrt(tv) + 1e-11), {DIGITS}) AS "M3"
    FROM (SELECT sum(n * var) / ({rows}) AS within, max(var) AS worst, max(sqrt(n) * dist) AS farthest,
      ({total_var}) AS tv FROM ({groups}) WHERE n > 0)"""


def sql_numeric_pair(x: str, x_expr: str, y: str, y_expr: str, table: str) -> str:
    groups = f"""SELECT count({x_expr}) AS n, var_pop({x_expr}) AS var,
    abs(avg({x_expr}) - (SELECT avg({x_expr}) FROM {table})) AS dist FROM {table} GROUP BY {y_expr}"""
    return sql_measures(
        x, y, groups, f"SELECT count(*) FROM {table}", f"SELECT var_pop({x_expr}) FROM {table}"
    )


NUMERIC = {
    "o_custkey": "o_custkey::DOUBLE",
    "o_totalprice": "o_totalprice",
    "is_big": "(o_totalprice > 250000)::INTEGER",
    "day": "date_diff('day', DATE '1970-01-01', o_orderdate::DATE)",
}
GROUPED = {"o_custkey": "o_custkey", "o_totalprice": "o_totalprice", "is_big": "o_totalprice > 250000",
           "day": "o_orderdate::DATE"}


def numeric_pairs(t: Tables, every: int = 11):
    data = orders(t, every).select(
        "o_orderkey",  # a key: left out by the filter
        F.lit("EUR").alias("currency"),  # a constant: left out too
        "o_custkey",
        "o_totalprice",
        (F.col("o_totalprice") > 250000).alias("is_big"),
        F.to_date("o_orderdate").alias("day"),
        gap("o_orderkey", 2, "o_custkey").alias("sparse"),  # half empty: left out
    )
    return c.analyze(data)


def sql_numeric_pairs(every: int = 11) -> str:
    table = sql_orders(every)
    return " UNION ALL ".join(
        sql_numeric_pair(x, NUMERIC[x], y, GROUPED[y], table) for x, y in permutations(NUMERIC, 2)
    )


@register("coherence_numeric", sql_numeric_pairs())
def _numeric(t: Tables):
    return rounded(numeric_pairs(t), DIGITS, *MS)


@register(
    "candidate_rules",
    f"""SELECT *, {AT_1} AS "timestamp", 'orders' AS source FROM ({sql_numeric_pairs()}) WHERE "M1" > 0.5""",
)
def _rules(t: Tables):
    return rounded(c.candidate_rules(numeric_pairs(t), "orders", RUN_1), DIGITS, *MS)


@register(
    "coherence_score",
    f"""SELECT 'orders' AS source, {AT_1} AS "timestamp", count(*) AS detected_rules,
    round(avg(CASE WHEN "M2" <= 5 AND "M3" <= 10 THEN 1.0 ELSE 0.0 END), 9) AS coherence_score
    FROM ({sql_numeric_pairs()}) WHERE "M1" > 0.5""",
)
def _score(t: Tables):
    rules = c.candidate_rules(numeric_pairs(t), "orders", RUN_1)
    return rounded(c.coherence_score(rules), 9, "coherence_score")


SQL_DIMS = """(SELECT vec_id, label, i, embedding[i]::DOUBLE AS v
    FROM embeddings, (SELECT unnest(range(1, 65)) AS i))"""


@register(
    "coherence_vectors",
    sql_measures(
        "embedding",
        "label",
        f"""SELECT any_value(n) AS n, sum(var) AS var, sqrt(sum((mu - gmu) ** 2)) AS dist
        FROM (SELECT label, i, count(*) AS n, avg(v) AS mu, var_pop(v) AS var FROM {SQL_DIMS} GROUP BY label, i)
        JOIN (SELECT i, avg(v) AS gmu FROM {SQL_DIMS} GROUP BY i) USING (i) GROUP BY label""",
        "SELECT count(*) FROM embeddings",
        f"SELECT sum(var) FROM (SELECT var_pop(v) AS var FROM {SQL_DIMS} GROUP BY i)",
    )
    + " UNION ALL "
    + sql_numeric_pair("label", "label::DOUBLE", "embedding", "embedding", "embeddings"),
)
def _vectors(t: Tables):
    return rounded(c.analyze(t.embeddings.select("embedding", "label"), None), DIGITS, *MS)


# Text by trigrams: the same vectors in SQL


def sql_text_pair(x: str, y: str, table: str) -> str:
    vectors = f"""(SELECT label, dim, n / sqrt(sum(n * n) OVER (PARTITION BY label)) AS w FROM
      (SELECT label, dim, count(*)::DOUBLE AS n FROM
        (SELECT label, (unicode(s[i]) * 961 + unicode(s[i + 1]) * 31 + unicode(s[i + 2])) % 4096 AS dim FROM
          (SELECT label, '  ' || label || '  ' AS s, unnest(range(1, length(label) + 3)) AS i
           FROM (SELECT DISTINCT {x} AS label FROM {table} WHERE {x} IS NOT NULL)))
       GROUP BY label, dim))"""
    mu = f"""(SELECT dim, sum(w) / (SELECT count({x}) FROM {table}) AS mu
      FROM {table} JOIN {vectors} ON {x} = label GROUP BY dim)"""
    groups = f"""SELECT n, CASE WHEN 1 - sq < 1e-12 THEN 0 ELSE 1 - sq END AS var,
      sqrt(CASE WHEN sq - 2 * dot + gsq < 1e-12 THEN 0 ELSE sq - 2 * dot + gsq END) AS dist
      FROM (SELECT g.g, any_value(g.n) AS n, sum((s.w / g.n) ** 2) AS sq, sum(s.w / g.n * mu.mu) AS dot,
          (SELECT sum(mu * mu) FROM {mu}) AS gsq
        FROM (SELECT {y} AS g, count({x}) AS n FROM {table} GROUP BY {y}) g
        JOIN (SELECT {y} AS g, dim, sum(w) AS w FROM {table} JOIN {vectors} ON {x} = label GROUP BY {y}, dim) s
          ON g.g IS NOT DISTINCT FROM s.g
        JOIN {mu} mu ON mu.dim = s.dim GROUP BY g.g)"""
    return sql_measures(
        x, y, groups, f"SELECT count(*) FROM {table}",
        f"SELECT CASE WHEN 1 - sum(mu * mu) < 1e-12 THEN 0 ELSE 1 - sum(mu * mu) END FROM {mu}",
    )


SQL_PARTS = """(SELECT p_name, p_brand, CASE WHEN p_partkey % 12 <> 0 THEN p_type END AS p_type,
    p_brand[1:7] AS series FROM part)"""


def _parts(t: Tables):
    return t.part.select(
        "p_name", "p_brand", gap("p_partkey", 12, "p_type").alias("p_type"),
        F.substring("p_brand", 1, 7).alias("series"),
    )


@register(
    "coherence_text",
    " UNION ALL ".join(
        sql_text_pair(x, y, SQL_PARTS) for x, y in permutations(["p_name", "p_brand", "p_type", "series"], 2)
    ),
)
def _text(t: Tables):
    return rounded(c.analyze(_parts(t)), DIGITS, *MS)


def sql_edit_pair(x: str, y: str, table: str) -> str:
    d2 = f"""(SELECT a.l AS a, b.l AS b, (levenshtein(a.l, b.l)::DOUBLE / greatest(length(a.l), length(b.l))) ** 2 AS d
      FROM (SELECT DISTINCT {x} AS l FROM {table} WHERE {x} IS NOT NULL) a,
           (SELECT DISTINCT {x} AS l FROM {table} WHERE {x} IS NOT NULL) b)"""
    counted = f"(SELECT {y} AS g, {x} AS l, count(*)::DOUBLE AS w FROM {table} WHERE {x} IS NOT NULL GROUP BY ALL)"
    whole = f"(SELECT {x} AS l, count(*)::DOUBLE AS w FROM {table} WHERE {x} IS NOT NULL GROUP BY {x})"
    size = f"(SELECT count({x}) FROM {table})"
    total = f"""SELECT sum(a.w * b.w * d) / (2 * {size} * {size}) FROM {whole} a JOIN {d2} ON a.l = a
      JOIN {whole} b ON b.l = b"""
    groups = f"""SELECT n, var, sqrt(greatest(out - var - ({total}), 0)) AS dist FROM (
      SELECT g.n, q.q / (2 * g.n * g.n) AS var, o.o / (g.n * {size}) AS out
      FROM (SELECT g, sum(w) AS n FROM {counted} GROUP BY g) g
      JOIN (SELECT a.g, sum(a.w * b.w * d) AS q FROM {counted} a JOIN {counted} b
            ON a.g IS NOT DISTINCT FROM b.g JOIN {d2} t ON t.a = a.l AND t.b = b.l GROUP BY a.g) q
        ON g.g IS NOT DISTINCT FROM q.g
      JOIN (SELECT a.g, sum(a.w * b.w * d) AS o FROM {counted} a JOIN {d2} t ON t.a = a.l
            JOIN {whole} b ON t.b = b.l GROUP BY a.g) o ON g.g IS NOT DISTINCT FROM o.g)"""
    return sql_measures(x, y, groups, f"SELECT count(*) FROM {table}", total)


@register(
    "coherence_edit_distance",
    " UNION ALL ".join(
        sql_edit_pair(x, y, SQL_PARTS) for x, y in permutations(["p_brand", "p_type", "series"], 2)
    ),
)
def _edit(t: Tables):
    return rounded(c.analyze(_parts(t).drop("p_name"), text="edit"), DIGITS, *MS)

def sql_pivot_pairs(xs: list[str], table: str, pivots: int) -> str:
    """Farthest-point pivots one after the other, vectors of the distances to them, then the measures by dimension."""
    parts, selects = [], []
    for x in xs:
        parts.append(f"{x}_0 AS MATERIALIZED (SELECT DISTINCT {x} AS l, CAST(2 AS DOUBLE) AS gap FROM {table} WHERE {x} IS NOT NULL)")
        for k in range(1, pivots + 1):
            last = f"{x}_{k - 1}"
            edits = "CASE WHEN greatest(length(l), length(p)) = 0 THEN 0 ELSE levenshtein(l, p)::DOUBLE / greatest(length(l), length(p)) END"
            old = "".join(f"d{j}, " for j in range(1, k))
            parts.append(f"""{x}_{k} AS MATERIALIZED (SELECT l, {old}least(gap, {edits}) AS gap, {edits} AS d{k}
              FROM {last}, (SELECT l AS p FROM {last} ORDER BY gap DESC, l LIMIT 1))""")
        dims = " UNION ALL ".join(f"SELECT l, {k} AS i, d{k} / sqrt({pivots}) AS v FROM {x}_{pivots}" for k in range(1, pivots + 1))
        parts.append(f"{x}_v AS MATERIALIZED ({dims})")
    for x, y in permutations(xs, 2):
        rows = f"(SELECT {y} AS g, i, v FROM {table} JOIN {x}_v ON {x} = l)"
        selects.append(sql_measures(
            x, y,
            f"""SELECT any_value(n) AS n, sum(var) AS var, sqrt(sum((mu - gmu) ** 2)) AS dist
            FROM (SELECT g, i, count(*) AS n, avg(v) AS mu, var_pop(v) AS var FROM {rows} GROUP BY g, i)
            JOIN (SELECT i, avg(v) AS gmu FROM {rows} GROUP BY i) USING (i) GROUP BY g""",
            f"SELECT count(*) FROM {table}",
            f"SELECT sum(var) FROM (SELECT var_pop(v) AS var FROM {rows} GROUP BY i)",
        ))
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(selects)


PIVOT_TABLE = """(SELECT p_name, p_brand, p_name || ' ' || p_brand || ' ' || p_size AS title,
    CASE WHEN p_partkey % 12 <> 0 THEN p_type END AS p_type FROM part)"""


@register("coherence_pivots", sql_pivot_pairs(["p_name", "p_brand", "title", "p_type"], PIVOT_TABLE, 6))
def _pivots(t: Tables):
    """Columns of any number of labels by edit distance: title has nearly as many as the table has rows."""
    data = t.part.select(
        "p_name", "p_brand", F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("title"),
        gap("p_partkey", 12, "p_type").alias("p_type"),
    )
    return rounded(c.analyze(data, None, text="pivots", pivots=6), DIGITS, *MS)


@register(
    "encoded_labels",
    "SELECT s_suppkey, CASE WHEN n_regionkey <> 2 THEN n_regionkey::DOUBLE END AS place_1, CASE WHEN n_regionkey <> 2 THEN n_nationkey::DOUBLE / 25 END AS place_2 FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def _encoded(t: Tables):
    """A table of label vectors replaces the labels; one region has none."""
    vectors = t.nation.where("n_regionkey <> 2").select(
        F.col("n_name").alias("label"),
        F.array(F.col("n_regionkey").cast("double"), F.col("n_nationkey").cast("double") / 25).alias("embedding"),
    )
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("place")
    )
    return c.encode_labels(named, "place", vectors).select(
        "s_suppkey", F.col("place")[0].alias("place_1"), F.col("place")[1].alias("place_2")
    )


@register(
    "representative_columns",
    f"""SELECT column_name, total_rows, distinct_values + (null_rows > 0)::INTEGER AS distinct_values, null_rows,
    distinct_values + (null_rows > 0)::INTEGER <> total_rows AND distinct_values >= 2
      AND (total_rows - null_rows)::DOUBLE / total_rows >= 0.8 AS representative FROM ("""
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(*) AS total_rows, count(DISTINCT {expr}) AS distinct_values,
        count(*) - count({expr}) AS null_rows FROM {sql_orders()}"""
        for name, expr in (
            ("o_orderkey", "o_orderkey"), ("o_custkey", "o_custkey"), ("o_orderstatus", "o_orderstatus"),
            ("o_totalprice", "o_totalprice"), ("o_orderdate", "o_orderdate"),
            ("o_orderpriority", "o_orderpriority"), ("mid", "mid"), ("currency", "'EUR'"),
            ("sparse", "CASE WHEN o_orderkey % 2 <> 0 THEN o_custkey END"),
        )
    )
    + ")",
)
def _profile(t: Tables):
    data = orders(t).drop("low", "high").withColumns(
        {"currency": F.lit("EUR"), "sparse": gap("o_orderkey", 2, "o_custkey")}
    )
    return c.column_profile(data)


@register(
    "label_distances",
    """WITH l AS (SELECT DISTINCT unnest([p_type, p_brand, p_name]) AS label FROM part)
    SELECT a.label AS label_1, b.label AS label_2,
    round(levenshtein(a.label, b.label)::DOUBLE / greatest(length(a.label), length(b.label)), 9) AS distance
    FROM l a JOIN l b ON a.label < b.label""",
)
def _distances(t: Tables):
    labels = t.part.select(F.explode(F.array("p_type", "p_brand", "p_name")).alias("label"))
    return rounded(c.label_distances(labels, "label"), 9, "distance")


SQL_ORDER_COLUMNS = " UNION ALL ".join(
    f"SELECT 'orders' AS source, '{c}' AS column_name, count({e}) AS n_values FROM {sql_orders()}"
    for c, e in (("o_orderkey", "o_orderkey"), *GROUPED.items())
)
SQL_CUSTOMER_COLUMNS = " UNION ALL ".join(
    f"SELECT 'customer' AS source, '{c}' AS column_name, count({c}) AS n_values FROM customer" for c in ("c_custkey", "c_name")
)


@register(
    "coherent_projection",
    f"""WITH broken AS (SELECT DISTINCT x FROM ({sql_numeric_pairs()}) WHERE "M1" > 0.5 AND NOT ("M2" <= 5 AND "M3" <= 10)),
    own AS ({SQL_ORDER_COLUMNS}), other AS ({SQL_CUSTOMER_COLUMNS})
    SELECT 'by key' AS joined, * FROM own WHERE column_name NOT IN (SELECT x FROM broken)
    UNION ALL SELECT 'by key', * FROM other
    UNION ALL SELECT 'by customer', * FROM own
      WHERE column_name NOT IN (SELECT x FROM broken) AND 'o_custkey' NOT IN (SELECT x FROM broken)
    UNION ALL SELECT 'by customer', * FROM other""",
)
def _projection(t: Tables):
    """What is left of orders and customers: if orders are joined by a column that breaks rules, nothing of orders."""
    rows = orders(t).select(
        "o_orderkey", "o_custkey", "o_totalprice", (F.col("o_totalprice") > 250000).alias("is_big"),
        F.to_date("o_orderdate").alias("day"),
    )
    tables = {"orders": rows, "customer": t.customer.select("c_custkey", "c_name")}
    rules = checkpoint(c.candidate_rules(numeric_pairs(t), "orders", RUN_1))
    key = KeyRule(("orders",), ("o_orderkey",))
    to_customer = Reference("orders", "customer", (("o_custkey", "c_custkey"),))
    parts = []
    for joined, book in (
        ("by key", Rulebook(keys=[key])), ("by customer", Rulebook(keys=[key], references=[to_customer])),
    ):
        for source, df in coherent_projection(tables, book, rules).tables.items():
            counts = F.array(*(
                F.struct(F.lit(n).alias("column_name"), F.count(n).alias("n_values")) for n in df.columns
            ))
            parts.append(df.agg(counts.alias("c")).select(
                F.lit(joined).alias("joined"), F.lit(source).alias("source"), F.inline("c")))
    return union_all(parts)
