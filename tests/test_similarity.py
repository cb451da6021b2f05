"""Similarity joins against every pair."""

import itertools
import random

import pytest

from plumbline.operators import similarity as s


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            text.insert(at, rng.choice(letters))
        elif text and kind == 1:
            del text[min(at, len(text) - 1)]
        elif text:
            text[min(at, len(text) - 1)] = rng.choice(letters)
    return "".join(text)


def texts(seed, n, letters="abcd"):
    rng = random.Random(seed)
    own = ["", "a", "ab", "b", "é中𝄞", "é中x"]
    own += ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 9, 14, 22]))) for _ in range(n)]
    own += ["Customer#0000" + t for t in own[6:30]]
    other = [edited(rng, t, rng.randrange(5), letters) for t in own for _ in range(2)] + own[:10]
    return own, other


@pytest.mark.parametrize("threshold", ["0.55", 0.7, 0.9, 1])
def test_edit_similarity_against_every_pair(frame, threshold):
    own, other = texts(3, 60)
    num, den = s._parts(threshold)
    want = {
        (a, b) for a in set(own) for b in set(other)
        if distance(a, b) * den <= max(len(a), len(b)) * (den - num)
    }
    left = frame([(t,) for t in [*own, None, own[7]]], "a string")
    right = frame([(t,) for t in [*other, None, other[3]]], "b string")
    got = s.similar_values(left, right, "a", "b", threshold).collect()
    assert len(got) == len(want) and {(r["own"], r["other"]) for r in got} == want
    for r in got:
        longest = max(len(r["own"]), len(r["other"]))
        assert r["similarity"] == pytest.approx(1 - distance(r["own"], r["other"]) / longest if longest else 1)


@pytest.mark.parametrize("measure", ["words", "trigrams"])
@pytest.mark.parametrize("threshold", [0.3, 0.8])
def test_set_similarity_against_every_pair(frame, measure, threshold):
    rng = random.Random(4)
    words = ["the", "of", "rare", "x", "yy", "zzz", "common", "é"]
    own, other = (
        [" ".join(rng.choice(words[: rng.randrange(1, 9)]) for _ in range(rng.randrange(7))) for _ in range(60)]
        for _ in range(2)
    )

    def tokens(t):
        return set(t.split()) if measure == "words" else {t[i : i + 3] for i in range(len(t) - 2)}

    num, den = s._parts(threshold)
    want = {
        (a, b) for a in set(own) for b in set(other)
        if tokens(a) and len(tokens(a) & tokens(b)) * den >= len(tokens(a) | tokens(b)) * num
    }
    got = s.similar_values(
        frame([(t,) for t in [*own, None]], "a string"), frame([(t,) for t in [*other, None]], "b string"), "a", "b", threshold, measure
    ).collect()
    assert len(got) == len(want) and {(r["own"], r["other"]) for r in got} == want


def test_rows_join_by_several_columns(frame):
    left = frame([(1, "anna", "smith"), (2, "anna", "smith"), (3, None, "smith"), (4, "bob", "jones")], "id int, f string, l string")
    right = frame([("ana smith", 7), ("ana smith", 8), ("bob jonas", 9), (None, 10)], "name string, key int")
    got = s.similarity_join(left, right, ["f", "l"], "name", 0.85)
    assert got.columns == ["id", "f", "l", "name", "key", "similarity"]
    assert sorted((r["id"], r["key"]) for r in got.collect()) == [(1, 7), (1, 8), (2, 7), (2, 8), (4, 9)]
    assert s.similarity_join(left.limit(0), right, ["f", "l"], "name", 0.85).collect() == []
    with pytest.raises(ValueError, match="clash"):
        s.similarity_join(left, left, "f", "f", 0.9)
    with pytest.raises(ValueError, match="one half"):
        s.similar_values(left, right, "f", "name", 0.5)
    with pytest.raises(ValueError, match="threshold"):
        s.similar_values(left, right, "f", "name", 0)


def test_common_beginnings_are_no_candidates(frame):
    """Pieces that all texts share are not indexed while rarer ones are."""
    texts = frame([(f"Customer#{i * 999_983 % 10**9:09d}",) for i in range(1000)], "other string")
    most = s._index(texts, 94, 100).groupBy("n", "i", "piece").count().agg({"count": "max"}).first()[0]
    assert most <= 100


@pytest.mark.parametrize("common", [0, 3, 10_000])
def test_counts_of_common_pieces_travel_apart(frame, monkeypatch, common):
    monkeypatch.setattr(s, "COMMON", common)
    names = [f"Customer#{i:04d}" for i in range(60)]
    table = frame([(n,) for n in names], "b string")
    index = s._index(table.select(s.F.col("b").alias("other")), 9, 10)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan  # rows are neither broadcast nor dealt by bytes
    found = s.similar_values(table.withColumnRenamed("b", "a"), table, "a", "b", "0.9")
    close = {(a, b) for a in names for b in names if sum(x != y for x, y in zip(a, b)) <= 1}
    assert {(r["own"], r["other"]) for r in found.collect()} == close


def test_names_join_reads_every_customer(frame, tmp_path):
    """Customers of any key, also repeated or null, are held against all others, and the twin asks the same."""
    import duckdb

    from workload import ORACLES, QUERIES

    names = [f"Customer#{i:09d}" for i in (*range(25), 100, 199, 1199, 987_654_321)] + ["Customer#00000001", "Customer#0000000011", None]
    rows = list(enumerate(names, 1)) + [(3, names[2]), (None, names[4]), (50, names[7]), (77, names[7])]
    table = frame(rows, "c_custkey bigint, c_name string")
    table.write.parquet(f"{tmp_path}/customer.parquet")
    want = sorted(((a, b) for a, x in rows for b, y in rows if x and y and distance(x, y) <= 1), key=repr)
    got = sorted((tuple(r) for r in QUERIES["similarity_join_names"](table.sparkSession, str(tmp_path)).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == want
    assert sorted(con.execute(ORACLES["similarity_join_names"]).fetchall(), key=repr) == want


@pytest.mark.parametrize("threshold", [0.7, "0.8", 0.99])
def test_one_edit_between_all_short_texts(frame, threshold):
    """Texts of two letters are full of runs: each pair comes once, whichever character is lost, added or changed."""
    texts = ["".join(t) for n in range(7) for t in itertools.product("a𝄞", repeat=n)]
    num, den = s._parts(threshold)
    left, right = frame([(t,) for t in texts], "a string"), frame([(t,) for t in texts if t.count("a") != 3], "b string")
    want = sorted(
        (a, b) for a in texts for b in texts
        if b.count("a") != 3 and distance(a, b) * den <= max(len(a), len(b)) * (den - num)
    )
    assert sorted((r["own"], r["other"]) for r in s.similar_values(left, right, "a", "b", threshold).collect()) == want


def test_numbered_texts_meet_few_others(frame):
    """Names numbered without gaps share pieces with a thousand others, and a rest only with those around them."""
    names = frame([(f"Customer#{i:09d}",) for i in range(5000)], "other string")
    rests = s._less_one(names, "other", 94, 100)
    assert rests.groupBy("key").count().agg({"count": "max"}).first()[0] <= 40
    assert rests.count() <= 5000 * 19
    near = s._near(names.toDF("own"), names, 94, 100)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY_NUM" in plan
