"""The BI layer over a history of two runs, both measured on the tables themselves.

In the second run other rows have gaps, so scores change; completeness measures one column less,
so that rule keeps its first measure as the latest.
"""

from __future__ import annotations

from plumbline.operators.coherence import candidate_rules, coherence_score, incoherent_columns
from plumbline.plans.scorecard import RULE_KEYS, daily_scores, latest, roll_up, scorecard
from plumbline.session import checkpoint
from plumbline.sources.unions import union_all
from workload import conformity, heterogeneity
from workload.coherence import DIGITS, MS, numeric_pairs, sql_numeric_pairs
from workload.common import RUN_1, RUN_2, Tables, register, rounded

RUNS = ((11, RUN_1), (13, RUN_2))
FEWER = ("o_custkey", "o_totalprice")


def _completeness(t: Tables, every: int, at: str):
    columns = FEWER if at == RUN_2 else (*FEWER, "o_orderpriority")
    return conformity.completeness(t, every, at, columns)


def _sql_completeness(every: int, at: str) -> str:
    columns = FEWER if at == RUN_2 else (*FEWER, "o_orderpriority")
    return conformity.sql_completeness(every, at, columns)


def _coherence(t: Tables, every: int, at: str):
    return rounded(candidate_rules(numeric_pairs(t, every), "orders", at), DIGITS, *MS)


def _sql_coherence(every: int, at: str) -> str:
    return f"""SELECT *, TIMESTAMP '{at}' AS "timestamp", 'orders' AS source
    FROM ({sql_numeric_pairs(every)}) WHERE "M1" > 0.5"""


METRICS = {
    "completeness": (_completeness, _sql_completeness),
    "uniqueness": (conformity.uniqueness, conformity.sql_uniqueness),
    "format": (conformity.text_format, conformity.sql_format),
    "labels": (conformity.labels, conformity.sql_labels),
    "interval": (conformity.interval, conformity.sql_interval),
    "foreign_key": (conformity.foreign_key, conformity.sql_foreign_key),
    "dispersion": (heterogeneity.dispersion, heterogeneity.sql_dispersion),
    "position_ratio": (heterogeneity.position_ratio, heterogeneity.sql_position_ratio),
    "coherence": (_coherence, _sql_coherence),
}


def runs(t: Tables, metric: str):
    measure, _ = METRICS[metric]
    return union_all([measure(t, every, at) for every, at in RUNS])


def history(t: Tables, metric: str):
    """Both runs, stored once as the metric tables are."""
    return checkpoint(runs(t, metric))


def sql_history(metric: str) -> str:
    _, sql = METRICS[metric]
    return "(" + " UNION ALL ".join(f"(SELECT * FROM ({sql(every, at)}))" for every, at in RUNS) + ")"


def _register_latest(metric: str) -> None:
    keys = RULE_KEYS[metric]
    by = ", ".join(keys)
    sql = f"""SELECT * EXCLUDE (newest) FROM (SELECT *, max("timestamp") OVER (PARTITION BY {by}) AS newest
    FROM {sql_history(metric)}) WHERE "timestamp" = newest"""
    register(f"latest_{metric}", sql)(lambda t: latest(history(t, metric), keys))


for _metric in METRICS:
    _register_latest(_metric)


@register(
    "latest_coherence_score",
    f"""SELECT source, "timestamp", count(*) AS detected_rules,
    round(avg(CASE WHEN "M2" <= 5 AND "M3" <= 10 THEN 1.0 ELSE 0.0 END), 9) AS coherence_score
    FROM {sql_history('coherence')} WHERE "M1" > 0.5 GROUP BY source, "timestamp\"""",
)
def _scores(t: Tables):
    return rounded(coherence_score(runs(t, "coherence")), 9, "coherence_score")


# Metric table -> dimension, metric, source, rule and score in SQL
SHAPES = {
    "completeness": ("Completeness", "Non-null values", "source", "column_name", "completeness_percent"),
    "uniqueness": ("Uniqueness", "No duplicates", "source", "column_name", "uniqueness_percent"),
    "format": ("Conformity", "Format", "source", "column_name", "format_percent"),
    "labels": ("Conformity", "Allowed values", "source", "column_name", "labels_percent"),
    "interval": (
        "Conformity", "Interval", "source",
        "column_name_min || ' ≤ ' || column_name_target || ' ≤ ' || column_name_max", "interval_percent",
    ),
    "foreign_key": (
        "Conformity", "Foreign key", "source_1 || ' -> ' || source_2",
        "column_name_1 || ' -> ' || column_name_2", "fk_percent",
    ),
    "dispersion": (
        "Heterogeneity", "Dispersion between sources", "source_1 || ' vs ' || source_2", "column_name_1",
        "dispersion_score",
    ),
    "position_ratio": (
        "Heterogeneity", "Position of the mean", "source",
        "column_name_min || ' / ' || column_name_mean || ' / ' || column_name_max", "ratio_score",
    ),
}
SQL_ALL = " UNION ALL ".join(
    f"""SELECT '{dimension}' AS dimension, '{label}' AS metric, {source} AS source, {rule} AS rule,
    {score} AS score, "timestamp" FROM {sql_history(metric)}"""
    for metric, (dimension, label, source, rule, score) in SHAPES.items()
) + f""" UNION ALL SELECT 'Coherence', 'Candidate rules respected', source, 'all pairs (x, y)',
    avg(CASE WHEN "M2" <= 5 AND "M3" <= 10 THEN 1.0 ELSE 0.0 END), "timestamp"
    FROM {sql_history('coherence')} WHERE "M1" > 0.5 GROUP BY source, "timestamp\""""
SQL_CARD = f"""(SELECT dimension, metric, source, rule, round(score, 9) AS score, "timestamp",
    "timestamp" = max("timestamp") OVER (PARTITION BY dimension, metric, source, rule) AS is_latest,
    CASE WHEN source IN ('orders') THEN 'Paris' WHEN source IN ('lineitem') THEN 'Évry' ELSE 'Common' END AS city
    FROM ({SQL_ALL}))"""


def card(t: Tables):
    tables = {metric: runs(t, metric) for metric in METRICS}
    return rounded(scorecard(tables, {"Paris": ["orders"], "Évry": ["lineitem"]}), 9, "score")


register("scorecard", f"SELECT * FROM {SQL_CARD}")(card)

LEVELS = {
    "metric_source_rule": ["dimension", "metric", "source", "rule"],
    "metric_source": ["dimension", "metric", "source"],
    "metric": ["dimension", "metric"],
    "dimension": ["dimension"],
    "city": ["city"],
}
NAMES = ["dimension", "metric", "source", "rule", "city"]


@register(
    "rollup_levels",
    f"WITH card AS MATERIALIZED {SQL_CARD} "
    + " UNION ALL ".join(
        f"SELECT '{level}' AS level, "
        + ", ".join(f"{c if c in keys else 'CAST(NULL AS VARCHAR)'} AS {c}" for c in NAMES)
        + f", round(avg(score), 6) AS score, count(score) AS rules FROM card WHERE is_latest GROUP BY {', '.join(keys)}"
        for level, keys in LEVELS.items()
    ),
)
def _rollup(t: Tables):
    return rounded(roll_up(card(t)), 6, "score")


@register(
    "rollup_days",
    f"""SELECT dimension, metric, CAST("timestamp" AS DATE) AS day, round(avg(score), 6) AS score,
    count(score) AS rules FROM {SQL_CARD} GROUP BY ALL""",
)
def _days(t: Tables):
    return rounded(daily_scores(card(t)), 6, "score")


@register(
    "incoherent_columns",
    f"""SELECT source, "timestamp", x AS column_name, count(*) AS broken_rules FROM {sql_history('coherence')}
    WHERE "M1" > 0.5 AND NOT ("M2" <= 5 AND "M3" <= 10) GROUP BY ALL""",
)
def _incoherent(t: Tables):
    return incoherent_columns(runs(t, "coherence"))
