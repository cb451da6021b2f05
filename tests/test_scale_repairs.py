import math

import numpy as np
import pytest

from plumbline.operators import dispersion as d
from plumbline.operators import impute as imputation
from plumbline.operators import rescale as r
from plumbline.operators.impute import bayesian_ridge, impute
from plumbline.operators.quantiles import exact_quantiles, theil_sen

AT = "2026-03-01 12:00:00"


def column(frame, numbers, name="v"):
    return frame([(None if n is None else float(n),) for n in numbers], f"{name} double")


def test_coefficient_of_variation(frame):
    assert d.coefficient_of_variation(column(frame, [4, 8, 12]), "v") == pytest.approx(0.5)
    for bad in ([5], [-1, 1], [None, None]):
        with pytest.raises(ValueError):
            d.coefficient_of_variation(column(frame, bad), "v")
    with pytest.raises(ValueError):
        d.coefficient_of_variation(column(frame, [1]), "w")


def test_dispersion(frame):
    assert d.dispersion_difference(0.3, 0.3) == 0
    assert d.dispersion_difference(0.8, 0.4) == pytest.approx(math.log(2))
    assert (d.dispersion_score(math.log(5)), d.dispersion_score(2.0)) == (1.0, 0.0)
    with pytest.raises(ValueError):
        d.dispersion_difference(0, 1)
    row = d.dispersion(column(frame, [4, 8, 12]), "v", column(frame, [1, 8, 60]), "v", ("a", "b"), AT).first()
    cv = np.std([1, 8, 60], ddof=1) / 23
    assert row["dispersion_difference"] == pytest.approx(math.log(cv / 0.5))
    assert row["dispersion_score"] == 1.0


def test_position_ratio(frame):
    rows = [("1 000", "1 500", "2 000"), ("1", "1", "20"), (None, "1", "2"), ("1", "19,", "20")]
    good = frame(rows[:3], "a string, b string, c string")
    assert d.position_ratio(good, "a", "b", "c") == 0.5
    assert d.position_score(0.25) == 0.75
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        d.position_ratio(frame(rows, "a string, b string, c string"), "a", "b", "c")
    for bad in ([], [(None, 1.0, 2.0)], [(3.0, 2.0, 4.0)], [(1.0, 1.0, 1.0)]):
        with pytest.raises(ValueError):
            d.position_ratio(frame(bad, "a double, b double, c double"), "a", "b", "c")
    with pytest.raises(ValueError):
        d.position_ratio(good, "a", "b", "c", 0.9, 0.1)


@pytest.mark.parametrize(
    "numbers",
    [
        [3, 1, 2, 5, 4],
        [1, 1, 1, 1, 1, 9],
        list(np.random.default_rng(1).lognormal(3, 2, 700)),
        [7] * 500 + list(range(60)) + [float("nan"), None, float("inf")],
    ],
)
def test_quantiles_equal_numpy(frame, numbers):
    found = {row["probability"]: row["quantile"] for row in exact_quantiles(column(frame, numbers), "v").collect()}
    kept = [n for n in numbers if n is not None and np.isfinite(n)]
    expected = np.quantile(kept, np.arange(1, 100) / 100)
    assert [found[i / 100] for i in range(1, 100)] == pytest.approx(list(expected))


def test_quantiles_are_exact_whatever_the_sketch_says(frame):
    numbers = list(np.random.default_rng(2).normal(size=900))
    found = {x["probability"]: x["quantile"] for x in exact_quantiles(column(frame, numbers), "v", accuracy=7).collect()}
    assert found[0.5] == pytest.approx(np.median(numbers))
    assert found[0.99] == pytest.approx(np.quantile(numbers, 0.99))


def test_crowded_brackets_are_split(frame):
    numbers = list(np.random.default_rng(6).normal(size=3000)) + [0.25] * 2000
    rows = exact_quantiles(column(frame, numbers), "v", ["0.25", "0.5", "0.9"], accuracy=5, max_ranked=40).collect()
    found = {x["probability"]: x["quantile"] for x in rows}
    assert [found[p] for p in (0.25, 0.5, 0.9)] == pytest.approx(list(np.quantile(numbers, [0.25, 0.5, 0.9])))


def test_quantiles_need_two_values(frame):
    with pytest.raises(ValueError):
        exact_quantiles(column(frame, [1, None]), "v")


def test_theil_sen(frame):
    left, right = column(frame, [3, 6, 9, 12, 15]), column(frame, [25, 49, 73, 97, 121])
    line = theil_sen(left, right, "v").first()
    assert (line["slope"], line["intercept"], line["r2"]) == pytest.approx((8, 1, 1))
    assert theil_sen(column(frame, [2, 2, 2]), right, "v").first()["slope"] is None


def test_choose_transform():
    assert r.choose_transform(9.8, 3.0, 0.1, [8.0, 10.0], 0.05) == (10.0, 0.0, "known_factor")
    assert r.choose_transform(9.0, 3.0, 0.95, [10.0], 0.05) == (9.0, 3.0, "theil_sen")
    assert r.choose_transform(9.0, 3.0, 0.9, [], 0.05) == (1.0, 0.0, "no_correction")
    for bad in ((1, 0, 1, [], 2), (float("nan"), 0, 1, [], 0.1), (1, 0, 1, [-1.0], 0.1)):
        with pytest.raises(ValueError):
            r.choose_transform(*bad)


def test_repair_dispersion(frame):
    left, right = column(frame, [3, 6, 9, 12, 15]), column(frame, [36, 72, 108, 144, 180])
    fixed, method = r.repair_dispersion(left, right, "v", [12.0], 0.05)
    assert method == "known_factor"
    assert [x["v"] for x in fixed.collect()] == [36, 72, 108, 144, 180]
    with pytest.raises(ValueError):
        r.repair_dispersion(column(frame, [1, 1]), right, "v", [], 0.05)


TRIPLET = r.Triplet("low", "mid", "high")


@pytest.fixture
def pay(frame):
    rows = [(0, 900, 1000, 18000), (1, 900, 1100, 24000), (2, 900, 1500, 2000), (3, None, 1, 2), (4, 9, 8, 7)]
    return frame(rows, "id int, low bigint, mid bigint, high bigint")


def test_atypical_ratios(pay):
    found = {x["id"]: x["ratio"] for x in r.atypical_ratios(pay, TRIPLET, ["id"]).collect()}
    assert found == pytest.approx({0: 100 / 17100, 1: 200 / 23100})


def test_factor_choice_and_repair(pay):
    assert r.choose_factor(pay, TRIPLET, "high", [12, 10, 30]) == (12.0, "divide", 2, 2)
    # Ten repairs as many: the first wins.
    assert r.choose_factor(pay, TRIPLET, "high", [10, 12])[:2] == (10.0, "divide")
    fixed, method, repaired, total = r.repair_position_ratio(pay, TRIPLET, "high", [12])
    assert (method, repaired, total) == ("divide_by_12", 2, 2)
    assert [x["high"] for x in fixed.orderBy("id").collect()] == [1500.0, 2000.0, 2000.0, 2.0, 7.0]
    assert fixed.columns == pay.columns


def test_a_repair_of_too_few_rows_is_refused(frame):
    data = frame([(900, 1000, 18000), (900, 1000, 180000), (900, 1000, 190000)], "low bigint, mid bigint, high bigint")
    fixed, method, repaired, total = r.repair_position_ratio(data, TRIPLET, "high", [12])
    assert (method, repaired, total) == ("no_correction", 1, 3)
    assert fixed is data


def test_nothing_atypical(frame):
    data = frame([(1, 2, 3)], "low bigint, mid bigint, high bigint")
    assert r.choose_factor(data, TRIPLET, "high", [12]) == (None, None, 0, 0)


def test_rescale_arguments(pay):
    for bad in (
        lambda: r.Triplet("a", "b", "c", 0.9, 0.1),
        lambda: r.choose_factor(pay, TRIPLET, "other", [12]),
        lambda: r.choose_factor(pay, TRIPLET, "high", []),
        lambda: r.choose_factor(pay, TRIPLET, "high", [12], 0),
        lambda: r.would_repair(TRIPLET, "high", 12, "add"),
    ):
        with pytest.raises(ValueError):
            bad()


# Imputation


def test_imputation_fills_between_and_keeps_the_rest(frame):
    rows = [(25000, "17 000", "36 500"), (40000, "28 100", "60 000"), (24600, "17 300", "36 900"), (None, "16 900", "36 200")]
    df = frame(rows, "mid bigint, low string, high string")
    out = impute(df, ["mid", "low", "high"])
    assert out.schema.simpleString() == df.schema.simpleString()
    got = [tuple(x) for x in out.collect()]
    assert got[:3] == rows[:3] and got[3][1:] == rows[3][1:]
    assert 16900 <= got[3][0] <= 36200


def by_rows(x, rounds):
    """The same procedure row by row, on a matrix with NaN."""
    missing = np.isnan(x)
    filled = np.where(missing, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        for j in np.argsort(missing.sum(0), kind="stable"):
            if not missing[:, j].any():
                continue
            others = [k for k in range(x.shape[1]) if k != j]
            train = ~missing[:, j]
            a, b = filled[train][:, others], filled[train, j]
            ac, bc = a - a.mean(0), b - b.mean()
            w = bayesian_ridge(ac.T @ ac, ac.T @ bc, bc @ bc, train.sum())
            filled[~train, j] = (filled[~train][:, others] - a.mean(0)) @ w + b.mean()
    return filled


def test_imputation_from_sums_equals_imputation_by_rows(spark, frame):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 1))
    x = np.hstack([base, 3 * base + 10, -2 * base + 100]) + rng.normal(scale=[0.2, 1, 5], size=(300, 3))
    x[rng.random(x.shape) < [0.1, 0.25, 0.2]] = np.nan
    rows = [(i, *(None if np.isnan(v) else float(v) for v in row)) for i, row in enumerate(x)]
    out = impute(frame(rows, "id int, a double, b double, c double"), ["a", "b", "c"]).orderBy("id")
    got = np.array([tuple(row)[1:] for row in out.collect()])
    assert got == pytest.approx(by_rows(x, 10), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("few", [0, 12])
def test_imputation_of_many_columns_equals_row_by_row(frame, monkeypatch, few):
    rng = np.random.default_rng(5)
    d = 4 if few else 14
    x = rng.normal(size=(120, 3)) @ rng.normal(size=(3, d)) + rng.normal(scale=0.3, size=(120, d))
    x[rng.random((120, d)) < 0.05] = np.nan
    x[:, 0] = np.arange(120.0)
    x[0] = np.nan_to_num(x[0], nan=0.5)
    names = [f"c{i}" for i in range(d)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in x]
    if few:  # the way for many columns gives the same on few
        monkeypatch.setattr(imputation, "FEW_COLUMNS", 1)
    out = impute(frame(rows, ", ".join(f"{n} double" for n in names)), names, rounds=2).orderBy("c0")
    got = np.array([tuple(row) for row in out.collect()])
    assert out.columns == names
    assert got == pytest.approx(by_rows(x, 2), rel=1e-6, abs=1e-6)


def test_imputation_by_least_squares(frame):
    rows = [(1.0, 3.0), (2.0, 5.0), (3.0, None), (4.0, 9.0)]
    out = impute(frame(rows, "a double, b double"), ["a", "b"], regression="least_squares").orderBy("a")
    assert out.collect()[2]["b"] == pytest.approx(7.0)
    with pytest.raises(ValueError, match="regression"):
        impute(frame(rows, "a double, b double"), ["a", "b"], regression="none")


def test_imputation_edges(frame):
    full = frame([(1, 2.0)], "a int, b double")
    assert impute(full, ["a", "b"]) is full
    with pytest.raises(ValueError, match="without any value"):
        impute(frame([(1, None)], "a int, b double"), ["a", "b"])
