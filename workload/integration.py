"""The integration queries and unions, on tables given the shape of the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.text import cast_columns
from plumbline.plans import integration as plans
from plumbline.sources.tables import query, upsert_frames
from plumbline.sources.unions import union_frames, union_sources
from workload.common import Tables, register, rounded


def _paris(t: Tables):
    consumption = t.customer.select(
        F.col("c_mktsegment").alias("Nom_Rue"),
        (F.col("c_nationkey") + 74990).alias("Code_Postal"),
        F.col("c_acctbal").alias("NB_KW_Jour"),
    )
    districts = t.customer.select(
        F.col("c_mktsegment").alias("ID_Rue"),
        F.when(F.col("c_nationkey") >= 10, F.lit("Paris"))
        .otherwise((F.col("c_nationkey") + 74990).cast("string"))
        .alias("ID_Ville"),
        F.concat(F.substring("c_mktsegment", 1, 1), (F.col("c_nationkey") % 7).cast("string")).alias("ID_Iris"),
    ).distinct()
    return consumption, districts


@register(
    "map_join_avg",
    """WITH c AS (SELECT c_mktsegment AS street, c_nationkey + 74990 AS code, c_acctbal AS kw FROM customer),
    d AS (SELECT DISTINCT c_mktsegment AS street,
      CASE WHEN c_nationkey >= 10 THEN 'Paris' ELSE CAST(c_nationkey + 74990 AS VARCHAR) END AS city,
      c_mktsegment[1] || CAST(c_nationkey % 7 AS VARCHAR) AS district FROM customer)
    SELECT district AS "ID_Iris", round(avg(kw * 365), 6) AS "Conso_moyenne_annuelle"
    FROM c JOIN d ON c.street = d.street
      AND d.city = CASE WHEN code BETWEEN 75000 AND 75999 THEN 'Paris' ELSE CAST(code AS VARCHAR) END
    GROUP BY district""",
)
def _map_join_avg(t: Tables):
    return rounded(plans.consumption_by_district_paris(*_paris(t)), 6, "Conso_moyenne_annuelle")


@register(
    "fuzzy_join_avg",
    """WITH c AS (SELECT upper(p_name) AS street, p_retailprice AS kw FROM part),
    d AS (SELECT DISTINCT word, length(word) AS district
      FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part))
    SELECT district::INTEGER AS "ID_Iris", round(avg(kw * 365), 6) AS "Conso_moyenne_annuelle"
    FROM c JOIN d ON contains(lower(street), word) GROUP BY district""",
)
def _fuzzy_join_avg(t: Tables):
    consumption = t.part.select(F.upper("p_name").alias("Nom_Rue"), F.col("p_retailprice").alias("NB_KW_Jour"))
    districts = (
        t.part.select(F.explode(F.split("p_name", " ")).alias("ID_Rue"))
        .distinct()
        .withColumn("ID_Iris", F.length("ID_Rue"))
    )
    return rounded(plans.consumption_by_district_evry(consumption, districts), 6, "Conso_moyenne_annuelle")


def _people(t: Tables):
    house = (F.col("c_custkey") % 50).cast("string")
    people_1 = t.customer.select(
        F.concat(F.lit("Paris, "), house, F.lit(" rue "), F.initcap("c_mktsegment")).alias("Adresse"),
        F.when(F.col("c_nationkey") > 20, F.lit("none"))
        .otherwise(F.concat(F.lower(F.substring("c_mktsegment", 1, 5)), F.lit(" / zz")))
        .alias("CSP"),
    )
    code = F.lpad(F.col("c_nationkey").cast("string"), 5, "0")
    people_2 = t.customer.select(
        F.concat(F.lit("Evry, "), code, F.lit(", "), house, F.lit(" "), F.initcap("c_mktsegment")).alias("Adresse"),
        (F.col("c_nationkey") % 6).cast("bigint").alias("CSP"),
    )
    used_1 = t.customer.select(
        (F.col("c_custkey") % 50).alias("N"),
        F.col("c_mktsegment").alias("Nom_Rue"),
    ).distinct().withColumn("NB_KW_Jour", F.col("N") * 1.5 + F.length("Nom_Rue"))
    used_2 = t.customer.select(
        (F.col("c_custkey") % 50).alias("N"), F.col("c_mktsegment").alias("Nom_Rue"), code.alias("Code_Postal")
    ).distinct().withColumn("NB_KW_Jour", F.col("N") * 0.5 + F.col("Code_Postal").cast("int"))
    categories = t.customer.select(F.col("c_mktsegment").alias("Desc")).distinct().select(
        (F.length("Desc") - 7).cast("bigint").alias("ID_CSP"),
        F.concat(F.lit("Les "), "Desc").alias("Desc"),
        (F.length("Desc") * 1000.0 + F.ascii("Desc")).alias("Salaire_Moyen"),
    )
    return people_1, used_1, people_2, used_2, categories


@register(
    "two_branch_avg",
    """WITH p AS (SELECT c_custkey % 50 AS n, c_mktsegment AS street, c_nationkey,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS code,
        CASE WHEN c_nationkey > 20 THEN NULL ELSE lower(c_mktsegment[1:5]) END AS tag FROM customer),
    u1 AS (SELECT DISTINCT n, street, n * 1.5::DOUBLE + length(street) AS kw FROM p),
    u2 AS (SELECT DISTINCT n, street, code, n * 0.5::DOUBLE + CAST(code AS INTEGER) AS kw FROM p),
    k AS (SELECT DISTINCT length(c_mktsegment) - 7 AS id, 'les ' || lower(c_mktsegment) AS text,
        length(c_mktsegment) * 1000.0::DOUBLE + ascii(c_mktsegment) AS pay FROM customer),
    b AS (SELECT k.id, k.pay, u1.kw FROM p JOIN u1 ON p.n = u1.n AND p.street = u1.street
          LEFT JOIN k ON contains(k.text, p.tag)
        UNION ALL
        SELECT k.id, k.pay, u2.kw FROM p JOIN u2 ON p.n = u2.n AND p.street = u2.street AND p.code = u2.code
          JOIN k ON k.id = p.c_nationkey % 6)
    SELECT id AS "ID_CSP", pay AS "Salaire_Moyen", round(avg(kw * 365), 6) AS "Conso_moyenne_annuelle"
    FROM b GROUP BY id, pay""",
)
def _two_branch_avg(t: Tables):
    return rounded(plans.consumption_by_category(*_people(t)), 6, "Conso_moyenne_annuelle")


# Unions and upserts


def _parties(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")
    )
    return customers, suppliers


SQL_C = "SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS balance, c_nationkey AS nation"
SQL_S = "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_acctbal AS balance, s_nationkey AS nation"


@register("union_relaxed", f"{SQL_C} FROM customer UNION ALL {SQL_S} FROM supplier")
def _union_relaxed(t: Tables):
    """Text and number under one name: text wins."""
    return union_frames(_parties(t), "vertical_relaxed")


@register(
    "union_diagonal",
    """SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _union_diagonal(t: Tables):
    return union_frames(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
        ],
        "diagonal",
    )


@register(
    "union_stand_in",
    """SELECT c_custkey AS id, c_nationkey AS nation FROM customer
    UNION ALL SELECT DISTINCT s_suppkey, s_nationkey FROM supplier
    UNION ALL SELECT p_partkey, p_size FROM part""",
)
def _union_stand_in(t: Tables):
    """The stored union of customer and supplier stands in for both; part is read as it is."""
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    catalog = {
        "customer": customers,
        "supplier": suppliers,
        "part": t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("nation")),
        "customer__union__supplier": customers.unionByName(suppliers.distinct()),
    }
    return union_sources(["customer", "supplier", "part"], catalog)


def _sql_upsert(pick: str) -> str:
    return f"""WITH b AS (SELECT 0 AS load, o_custkey AS id, o_orderkey AS event, o_totalprice AS v FROM orders
      UNION ALL SELECT 1, l_suppkey, l_orderkey, l_extendedprice FROM lineitem) {pick}"""


def _loads(t: Tables):
    first = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("event"), F.col("o_totalprice").alias("v")
    )
    second = t.lineitem.select(
        F.col("l_suppkey").alias("id"), F.col("l_orderkey").alias("event"), F.col("l_extendedprice").alias("v")
    )
    return first, second


@register(
    "upsert_keep_last",
    _sql_upsert(
        """SELECT id, event, v FROM (SELECT *, row_number() OVER (PARTITION BY id
        ORDER BY load DESC, event DESC, v DESC) AS r FROM b) WHERE r = 1"""
    ),
)
def _upsert_last(t: Tables):
    return upsert_frames(*_loads(t), ["id"], "last", order_by=["event"])


@register(
    "upsert_keep_first",
    _sql_upsert(
        """SELECT id, event, v FROM (SELECT *, row_number() OVER (PARTITION BY id
        ORDER BY load, event, v) AS r FROM b) WHERE r = 1"""
    ),
)
def _upsert_first(t: Tables):
    return upsert_frames(*_loads(t), ["id"], "first", order_by=["event"])


@register(
    "upsert_keep_none",
    _sql_upsert(
        "SELECT id, event, v FROM (SELECT *, count(*) OVER (PARTITION BY id, event) AS n FROM b) WHERE n = 1"
    ),
)
def _upsert_none(t: Tables):
    return upsert_frames(*_loads(t), ["id", "event"], "none")


@register(
    "sql_on_frame",
    """SELECT l_returnflag, round(avg(l_quantity * 365), 6) AS yearly FROM lineitem GROUP BY l_returnflag""",
)
def _sql_on_frame(t: Tables):
    return query(t.lineitem, "SELECT l_returnflag, round(avg(l_quantity * 365), 6) AS yearly FROM self GROUP BY ALL")


@register(
    "cast_and_rename",
    'SELECT CAST(n_nationkey AS VARCHAR) AS "ID_Iris", n_name AS "ID_Ville" FROM nation',
)
def _cast_and_rename(t: Tables):
    renamed = t.nation.select(F.col("n_nationkey").alias("ID_IRIS"), F.col("n_name").alias("ID_Ville"))
    return renamed.withColumnRenamed("ID_IRIS", "ID_Iris").transform(cast_columns(["ID_Iris"], "string"))
