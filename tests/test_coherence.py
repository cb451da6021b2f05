import datetime as dt
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import coherence as c


def measures(df, **options):
    return {(r["x"], r["y"]): (r["M1"], r["M2"], r["M3"]) for r in c.analyze(df, **options).collect()}


@pytest.mark.parametrize(
    ("rows", "share", "kept"),
    [
        ([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0), (4, "b", None)], 0.75, ["s", "v"]),
        ([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0), (4, "b", None)], 0.76, ["s"]),
        ([(1, "a", 1.0), (1, "a", 1.0), (2, "a", None)], 0.0, ["k"]),  # constants, also beside null
        ([], 0.5, []),
    ],
)
def test_representative_columns(frame, rows, share, kept):
    df = frame(rows, "k int, s string, v double")
    assert c.representative_columns(df, share).columns == kept


@pytest.mark.parametrize("share", [-0.1, 1.1, float("nan")])
def test_invalid_threshold(frame, share):
    with pytest.raises(ValueError):
        c.representative_columns(frame([(1,)], "a int"), share)


def test_profile_of_many_columns(spark):
    df = spark.range(6).select(*((F.col("id") % (i % 5 + 1)).alias(f"c{i}") for i in range(70)))
    profile = {r["column_name"]: r["distinct_values"] for r in c.column_profile(df).collect()}
    assert profile == {f"c{i}": i % 5 + 1 for i in range(70)}


def test_label_distances(frame):
    labels = frame([("kitten",), ("sitting",), ("",), ("Kitten",), (None,), ("kitten",)], "l string")
    found = {(r["label_1"], r["label_2"]): r["distance"] for r in c.label_distances(labels, "l").collect()}
    assert len(found) == 6
    assert found["kitten", "sitting"] == pytest.approx(3 / 7)
    assert found["", "kitten"] == 1.0
    assert found["Kitten", "kitten"] == pytest.approx(1 / 6)
    every = frame([(str(i * 7919),) for i in range(40)], "l string")
    assert c.label_distances(every, "l", blocks=5).count() == 40 * 39 // 2


def by_rows(x, groups):
    """M1..M3 of vectors x (n, d) under group labels, NaN rows left out."""
    known = ~np.isnan(x).any(axis=1)
    total, mu = x[known].var(axis=0).sum(), x[known].mean(axis=0)
    within = worst = far = 0.0
    for g in set(groups):
        part = x[known & np.array([k == g for k in groups])]
        if len(part):
            var = part.var(axis=0).sum()
            within += len(part) / len(x) * var
            worst = max(worst, var)
            far = max(far, np.sqrt(len(part)) * np.linalg.norm(part.mean(axis=0) - mu))
    return (total - within) / (total + 1e-11), worst / (within + 1e-11), far / (np.sqrt(total) + 1e-11)


def trigram_vector(label):
    v = np.zeros(c.TRIGRAM_DIMENSIONS)
    s = f"  {label}  "
    for i in range(len(s) - 2):
        v[(ord(s[i]) * 961 + ord(s[i + 1]) * 31 + ord(s[i + 2])) % len(v)] += 1
    return v / np.linalg.norm(v)


@pytest.fixture
def mixed(frame):
    rng = random.Random(4)
    rows = []
    for i in range(80):
        kind = rng.choice(["café", "thé", "x" * 150, ""])
        price = None if i % 9 == 0 else {"café": 2.0, "thé": 1.0, "": 5.0}.get(kind, 9.0) + rng.random()
        day = dt.date(2026, 1, 1 + rng.randrange(5))
        place = None if i % 11 == 0 else [float(len(kind)), rng.random()]
        rows.append((kind if i % 13 else None, price, rng.random() < 0.5, day, place))
    return rows, frame(rows, "kind string, price double, paid boolean, day date, place array<double>")


def test_measures_equal_a_computation_by_rows(mixed):
    rows, df = mixed
    found = measures(df, min_completeness=None)
    names = ["kind", "price", "paid", "day", "place"]
    nan = float("nan")
    encode = {
        "kind": lambda v: trigram_vector(v) if v is not None else np.full(c.TRIGRAM_DIMENSIONS, nan),
        "price": lambda v: [nan if v is None else v],
        "paid": lambda v: [float(v)],
        "day": lambda v: [(v - dt.date(1970, 1, 1)).days],
        "place": lambda v: [nan, nan] if v is None else v,
    }
    assert set(found) == set(permutations(names, 2))
    for x, y in found:
        i, j = names.index(x), names.index(y)
        data = np.array([encode[x](row[i]) for row in rows], dtype=float)
        groups = [tuple(row[j]) if isinstance(row[j], list) else row[j] for row in rows]
        assert found[x, y] == pytest.approx(by_rows(data, groups), rel=1e-6, abs=1e-5), (x, y)


@pytest.mark.parametrize("text", ["trigrams", "edit", "pivots"])
def test_rules_stand_out_from_controls(frame, text):
    rng = random.Random(8)
    seasons = {1: "winter", 4: "spring", 7: "summer", 10: "autumn"}
    rows = [(m := rng.choice(list(seasons)), seasons[m], rng.choice(["Dr Li", "Dr Roy", "Dr Kim"])) for _ in range(60)]
    found = measures(frame(rows, "month int, season string, doctor string"), text=text)
    for pair in (("season", "month"), ("month", "season")):
        assert found[pair][0] == pytest.approx(1.0) and found[pair][1] == pytest.approx(0.0, abs=1e-3)
    for pair in (("season", "doctor"), ("doctor", "season"), ("month", "doctor")):
        assert found[pair][0] < 0.5
    for m1, m2, m3 in found.values():
        assert -1e-9 <= m1 <= 1 + 1e-9 and (m2 < 1e-3 or m2 >= 1 - 1e-6) and m3 >= 0


def test_edit_distance_refuses_too_many_labels(spark):
    df = spark.range(40).select((F.col("id") % 20).cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    with pytest.raises(ValueError, match="trigrams"):
        c.analyze(df, text="edit", max_labels=19)


def test_pivots_are_far_from_each_other(frame):
    labels = ["kitten", "sitting", "mitten", "", "zzzzzz", "kitchen", "Sitting", "aé"]
    df = frame([(v,) for v in labels * 2 + [None]], "a string")

    def gap(a, b):
        rows = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, rows[0] = rows[0], i
            for j, y in enumerate(b, 1):
                last, rows[j] = rows[j], min(rows[j] + 1, rows[j - 1] + 1, last + (x != y))
        return rows[-1] / max(len(a), len(b), 1)

    want = [min(labels)]
    while len(want) < 5:
        want.append(min(labels, key=lambda v: (-min(gap(v, p) for p in want), v.encode())))
    assert c.pivot_labels(df, "a", 5) == want
    assert sorted(c.pivot_labels(df, "a", 50)) == sorted(labels)
    assert c.pivot_labels(df.where("a is null"), "a") == []
    vectors = {r["a"]: r["v"] for r in df.distinct().withColumn("v", c.pivot_vector(F.col("a"), want)).collect()}
    assert vectors.pop(None) is None
    for label, vector in vectors.items():
        assert vector == pytest.approx([gap(label, p) / 5**0.5 for p in want])
    for a in labels:  # by the triangle inequality of edits, labels that are close have close vectors
        assert np.linalg.norm(np.subtract(vectors[a], vectors[a])) == 0


def test_pivots_take_any_number_of_labels(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("item "), F.col("id") % 1500).alias("a"), (F.col("id") % 1500 % 7).alias("b"))
    found = measures(df, text="pivots")
    assert set(found) == {("a", "b"), ("b", "a")} and found["b", "a"][0] == pytest.approx(1.0)


def test_timestamps_only_group(frame):
    at = dt.datetime(2026, 1, 1)
    df = frame([(at, 1.0), (at, 1.0), (at + dt.timedelta(1), 2.0), (at + dt.timedelta(1), 2.0)], "t timestamp_ntz, v double")
    assert set(measures(df)) == {("v", "t")}


def test_one_column_has_no_pair(frame):
    assert c.analyze(frame([(1,), (1,), (2,)], "a int")).count() == 0


def test_encoder_by_a_table_of_vectors(frame):
    df = frame([("a", 1), ("a", 1), ("b", 2), ("b", 3), ("z", 3), (None, 1)], "l string, v int")
    table = frame([("a", [0.0, 1.0]), ("b", [1.0, 0.0])], "label string, embedding array<double>")
    encoded = c.encode_labels(df, "l", table)
    assert encoded.columns == ["l", "v"]
    assert encoded.where("l is null").count() == 2
    found = measures(df, min_completeness=None, encoder=lambda d: c.encode_labels(d, "l", table))
    vectors = np.array([[0, 1], [0, 1], [1, 0], [1, 0], [np.nan] * 2, [np.nan] * 2], dtype=float)
    assert found["l", "v"] == pytest.approx(by_rows(vectors, [1, 1, 2, 3, 3, 1]), abs=1e-6)


def test_rules_and_score(frame):
    rows = [("a", "b", 0.9, 1.0, 2.0), ("a", "c", 0.8, 6.0, 2.0), ("b", "c", 0.5, 1.0, 1.0)]
    rules = c.candidate_rules(frame(rows, "x string, y string, M1 double, M2 double, M3 double"), "s", "2026-03-01")
    assert rules.count() == 2
    row = c.coherence_score(rules).first()
    assert (row["detected_rules"], row["coherence_score"]) == (2, 0.5)
    assert [r["column_name"] for r in c.incoherent_columns(rules).collect()] == ["a"]


def test_sketches_decide_as_exact_counts_do(frame, monkeypatch):
    rng = random.Random(6)
    n = 400
    rows = [(
        i, i if i else None, i if i > 1 else 2, 7, None, rng.randrange(3), None if i % 2 else 1, i % 390, "x" if i else "y",
        None if i % 5 == 0 else i % 7, [float(i % 4)], 1 if i else None, i / 3,
    ) for i in range(n)]
    schema = ("key int, nullkey int, almost int, one int, none int, few int, half int, most int, text string, fifth int, "
              "list array<double>, single int, real double")
    df = frame(rows, schema)
    for share in (0.0, 0.5, 0.8, 1.0):
        exact = c.column_profile(df, share).where("representative").select("column_name").collect()
        want = [x for x in df.columns if x in {r[0] for r in exact}]
        assert c.representative_names(df, share) == want and want
    assert {"almost", "most"} <= set(c.representative_names(df)) and "key" not in c.representative_names(df)
    counted = []
    profile = c.column_profile
    monkeypatch.setattr(c, "column_profile", lambda d, share: counted.extend(d.columns) or profile(d, share))
    c.representative_names(df)
    assert set(counted) == {"key", "nullkey", "almost", "most", "real"}
    assert c.representative_names(df.limit(0)) == []
    with pytest.raises(ValueError):
        c.representative_names(df, float("nan"))
