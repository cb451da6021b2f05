"""Format programs and interval repairs against plain Python by rows."""

import random
import re
from itertools import combinations, pairwise

import pytest
from pyspark.sql import functions as F

from plumbline.operators import conform
from plumbline.operators.conform import Step

HOLDS = {"<=": lambda a, b: a <= b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, ">": lambda a, b: a > b}
PHONE = r"^\+\d{2}-\d{4}$"
PROGRAM = [Step("trim"), Step("replace", (r"[ .]", "-")), Step("extract", (r"\d{2}-\d{4}",)), Step("prefix", ("+",))]
PHONES = ["+33-1234", " +33-1234 ", "+33 1234", "33.1234", "tel 33 1234 x", "none", "", None, "12-3", "+33-1234"]


def plain_program(value):
    if value is None or re.search(PHONE, value):
        return value, 0
    now = value
    steps = [
        lambda v: v.strip(), lambda v: re.sub(r"[ .]", "-", v),
        lambda v: m[0] if (m := re.search(r"\d{2}-\d{4}", v)) else v, lambda v: v if v.startswith("+") else "+" + v,
    ]
    for i, step in enumerate(steps, 1):
        now = step(now)
        if re.search(PHONE, now):
            return now, i
    return value, -1


def test_format_program_against_rows(frame):
    rows = [(i, p, p) for i, p in enumerate(PHONES)]
    df = frame(rows, "id int, phone string, fax string")
    got = conform.format_repair(df, ["phone"], PHONE, PROGRAM).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(i, plain_program(p)[0], p) for i, p, _ in rows]
    report = {(r["column_name"], r["step"]): r["n_values"] for r in conform.format_report(df, ["phone", "fax"], PHONE, PROGRAM).collect()}
    steps = [plain_program(p)[1] for p in PHONES]
    assert report == {(c, s): steps.count(s) for c in ("phone", "fax") for s in set(steps)}
    assert conform.format_repair(df.limit(0), ["phone"], PHONE, PROGRAM).count() == 0


def test_only_rows_of_the_registry_are_touched(frame):
    df = frame([(1, " +33-1234"), (2, " +33-1234"), (2, "+33 1234"), (None, " +33-1234")], "id int, phone string")
    failing = frame([(2, "r"), (2, "s"), (7, "r"), (None, "r")], "id int, rule string")
    got = conform.format_repair(df, ["phone"], PHONE, PROGRAM, failing, "id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(1, " +33-1234"), (2, "+33-1234"), (2, "+33-1234"), (None, " +33-1234")], key=repr)
    with pytest.raises(ValueError, match="unknown"):
        conform.format_repair(df, ["phone"], PHONE, [Step("guess")])


@pytest.mark.parametrize("step, value, want", [
    (Step("collapse"), "a  b\t c", "a b c"), (Step("upper"), "é", "É"), (Step("lower"), "AÉ", "aé"),
    (Step("fold"), "éà", "ea"), (Step("suffix", (".0",)), "7", "7.0"), (Step("pad", (5, "0")), "42", "00042"),
    (Step("pad", (2, "0")), "4242", "4242"), (Step("replace", ("a", "$1")), "banana", "b$1n$1n$1"),
])
def test_operations(frame, step, value, want):
    df = frame([(value,)], "v string").select(step.apply(F.col("v")))
    assert df.first()[0] == want


def follows(values, operators):
    return all(HOLDS[o](a, b) for o, (a, b) in zip(operators, pairwise(values)))


def plain_fit(values, operators):
    """The nearest ordered values by pooling: of all ways to cut the order into tied runs, the best that holds."""
    n = len(values)
    plain = [{"<": "<=", ">": ">="}.get(o, o) for o in operators]
    best = None
    for cuts in range(1 << (n - 1)):
        runs, run = [], [0]
        for i in range(1, n):
            if cuts >> (i - 1) & 1:
                runs.append(run)
                run = []
            run.append(i)
        runs.append(run)
        fit = [0.0] * n
        for own in runs:
            mean = sum(values[i] for i in own) / len(own)
            for i in own:
                fit[i] = mean
        if follows([round(v, 9) for v in fit], plain):
            cost = sum((a - b) ** 2 for a, b in zip(fit, values))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, fit)
    return best[1]


def plain_repair(values, operators, threshold, step):
    if None in values or follows(values, operators):
        return list(values), "kept"
    for i, j in combinations(range(len(values)), 2):
        other = list(values)
        other[i], other[j] = other[j], other[i]
        if follows(other, operators):
            return other, "swapped"
    apart = [0.0]
    for o in operators:
        apart.append(apart[-1] + {"<": step, ">": -step}.get(o, 0.0))
    fit = [v + d for v, d in zip(plain_fit([v - d for v, d in zip(values, apart)], operators), apart)]
    if all(abs(n - v) <= threshold * max(abs(n), abs(v)) + 1e-12 for n, v in zip(fit, values)):
        return fit, "rounded"
    return [None] * len(values), "nulled"


@pytest.mark.parametrize("operators", [["<="], ["<", "<="], [">=", ">"], ["<=", ">="], [">", "<", "<="], ["<=", "<=", "<=", "<="]])
def test_interval_repair_against_rows(frame, operators):
    rng = random.Random(len(operators))
    n = len(operators) + 1
    names = [f"v{i}" for i in range(n)]
    rows = [[float(rng.choice([1, 2, 3, 50, 51, 52, 53, 54, 55])) for _ in range(n)] for _ in range(150)]
    rows += [[None] + [1.0] * (n - 1), [2.0] * n, [-1.0] * n, [0.0] * n]
    df = frame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"{v} double" for v in names))
    got = conform.interval_repair(df, names, operators, 0.03, 1.0).orderBy("id").collect()
    kinds = set()
    for r, values in zip(got, rows):
        want, kind = plain_repair(values, operators, 0.03, 1.0)
        assert r["repair"] == kind, (values, operators)
        assert list(r)[1:-1] == (pytest.approx(want) if None not in want else want)
        if kind == "rounded":
            assert follows(list(r)[1:-1], operators)
        kinds.add(kind)
    # Some orders without a strict operator are always mended by a swap.
    assert kinds == ({"kept", "swapped"} if operators in (["<="], ["<=", ">="]) else set(conform.KINDS))


def test_whole_numbers_and_dates(frame):
    df = frame([(10, 12, 11), (100, 101, 99), (100, 99, 99), (5, 1, 9)], "a int, b int, c int")
    got = conform.interval_repair(df, ["a", "b", "c"], ["<=", "<"], 0.05).collect()
    assert [tuple(r) for r in got] == [
        (10, 11, 12, "swapped"), (100, 100, 101, "rounded"), (99, 99, 100, "swapped"), (1, 5, 9, "swapped")]
    days = frame([("2026-01-02", "2026-01-01")], "a string, b string").selectExpr("date(a) AS a", "date(b) AS b")
    assert conform.interval_repair(days, ["a", "b"], ["<="], 1.0).first()["repair"] == "swapped"
    with pytest.raises(ValueError, match="one type"):
        conform.interval_repair(df.withColumn("a", df.a.cast("double")), ["a", "b"], ["<="], 1.0)
    with pytest.raises(ValueError, match="between neighbours"):
        conform.interval_repair(df, ["a", "b"], ["<=", "<="], 1.0)
