import pytest
from pyspark.sql import functions as F

from plumbline.operators import checks

AT = "2026-03-01 12:00:00"


def scores(df, rule, score):
    return {r[rule]: r[score] for r in df.collect()}


def test_completeness_counts_nulls_only(frame):
    df = frame([(1, "x", 1.0), (None, "y", float("nan")), (3, None, 2.0), (4, "z", 0.0)], "a int, b string, c double")
    found = scores(checks.completeness(df, ["a", "b", "c"], "s", AT), "column_name", "completeness_percent")
    assert found == {"a": 0.75, "b": 0.75, "c": 1.0}


def test_completeness_violations_name_row_and_column(frame, values):
    df = frame([(7, None, None), (8, 1, None), (9, 1, "x")], "id int, a int, b string")
    out = checks.list_violations(df, [checks.not_null("a"), checks.not_null("b")], "s", ["id"])
    assert values(out, "source", "column_name", "id") == [("s", "a", 7), ("s", "b", 7), ("s", "b", 8)]


def test_empty_table_scores_null(frame):
    empty = frame([], "a int, b string")
    assert checks.completeness(empty, ["a"], "s", AT).first()["completeness_percent"] is None
    assert checks.uniqueness(empty, [["a", "b"]], "s", AT).first()["uniqueness_percent"] is None
    assert checks.text_format(empty, ["b"], "x", "s", AT).first()["format_percent"] is None


def test_uniqueness_fails_every_member_of_a_repeated_key(frame, values):
    rows = [("Ann", "Lee"), ("Ann", "Lee"), ("Bo", "Lee"), ("Cy", None), ("Cy", None)]
    df = frame([(i, *r) for i, r in enumerate(rows)], "id int, first string, last string")
    out = checks.uniqueness(df, [["last", "first"], ["id"], ["last"]], "s", AT)
    found = {k: round(v, 9) for k, v in scores(out, "column_name", "uniqueness_percent").items()}
    assert found == {"first, last": 0.2, "id": 1.0, "last": 0.0}
    bad = checks.uniqueness_violations(df, ["last", "first"], "s", ["id"])
    assert values(bad, "column_name", "id") == [("first, last", i) for i in (0, 1, 3, 4)]


def test_uniqueness_violations_with_a_hot_key(spark):
    # One key holds half of the rows.
    df = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 150).alias("k"))
    keys = [0 if i % 2 == 0 else i % 150 for i in range(400)]
    found = checks.uniqueness_violations(df, ["k"], "s", ["id"]).collect()
    assert sorted(r["id"] for r in found) == [i for i in range(400) if keys.count(keys[i]) > 1]


def test_long_texts_are_told_apart_by_digest(frame):
    long = "x" * 500
    df = frame([(1, long), (2, long + "y"), (3, long), (4, "short")], "id int, t string")
    assert sorted(r["id"] for r in checks.uniqueness_violations(df, ["t"], "s", ["id"]).collect()) == [1, 3]


def test_format_is_a_search_and_the_end_is_the_very_end(frame):
    rows = [("12345",), ("1234",), ("12345\n",), ("a12345",), (None,)]
    df = frame(rows, "code string")
    anchored = checks.text_format(df, ["code"], r"^\d{5}$", "s", AT).first()["format_percent"]
    assert anchored == pytest.approx(2 / 5)  # the null is not counted as failing
    strict = checks.text_format(df, ["code"], r"^\d{5}$", "s", AT, nulls="fail").first()["format_percent"]
    assert strict == pytest.approx(1 / 5)
    loose = checks.text_format(df, ["code"], r"\d{5}", "s", AT).first()["format_percent"]
    assert loose == pytest.approx(4 / 5)


def test_format_without_columns_has_no_rows(frame):
    assert checks.text_format(frame([("a",)], "c string"), [], "x", "s", AT).count() == 0


@pytest.mark.parametrize(
    ("labels", "expected"), [(["a", "b", "c"], 1.0), (["z"], 0.25), (["a", "b"], 0.75), ([], 0.25)]
)
def test_labels(frame, labels, expected):
    df = frame([("a",), ("b",), ("c",), (None,)], "v string")
    assert checks.allowed_labels(df, ["v"], labels, "s", AT).first()["labels_percent"] == expected


def test_labels_of_other_types_compare_as_text(frame):
    df = frame([(1,), (2,), (3,)], "v bigint")
    assert checks.allowed_labels(df, ["v"], ["1", "91000a"], "s", AT).first()["labels_percent"] == pytest.approx(1 / 3)


def test_interval_parses_blanks_and_follows_three_valued_logic(frame, values):
    rows = [
        (0, "1 000", "1 500", "2 000"),
        (1, "5", "5", "5"),
        (2, "-3", "-9", "0"),
        (3, None, "9", "3"),  # the known half fails: the row fails
        (4, None, "2", "3"),  # undecided: the row passes
        (5, "1", None, "0"),
    ]
    df = frame(rows, "id int, a string, b string, c string")
    out = checks.interval_validity(df, [("a", "b", "c")], "s", AT).first()
    assert out["interval_percent"] == pytest.approx(4 / 6)
    assert (out["column_name_min"], out["column_name_target"], out["column_name_max"]) == ("a", "b", "c")
    bad = checks.list_violations(df, [checks.ordered("a", "b", "c")], "s", ["id"])
    assert values(bad, "column_name", "id") == [("a, b, c", 2), ("a, b, c", 3)]


def test_all_row_checks_share_one_scan(frame):
    df = frame([(1, "a")], "x int, y string")
    plan = checks.score_checks(
        df, [checks.not_null("x"), checks.matches("y", "a"), checks.one_of("y", ["a"])], "s", AT
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_timestamp_is_shared_and_utc(frame):
    from datetime import datetime, timedelta, timezone

    at = datetime(2026, 3, 1, 14, tzinfo=timezone(timedelta(hours=2)))
    row = checks.completeness(frame([(1,)], "a int"), ["a"], "s", at).first()
    assert row["timestamp"] == datetime(2026, 3, 1, 12)


def test_uniqueness_over_any_number_of_columns(frame):
    names = [f"c{i:03}" for i in range(130)]
    rows = [tuple(i if j == 129 else i // 2 for j in range(130)) for i in range(4)]
    df = frame(rows, ", ".join(f"{n} int" for n in names))
    sets = [[n] for n in names] + [names, names[:129]]
    found = {r["column_name"]: r["uniqueness_percent"] for r in checks.uniqueness(df, sets, "s", AT).collect()}
    assert len(found) == 132
    assert found[", ".join(names)] == found["c129"] == 1.0
    assert found[", ".join(names[:129])] == found["c000"] == 0.0
