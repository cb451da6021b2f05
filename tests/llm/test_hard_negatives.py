"""Hard negatives against scores row by row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import hard_negatives, queries


def plain(rows, is_anchor, positives=5, negatives=3):
    """Sorted result for rows (vec_id, label, embedding), by comparing every anchor with every row."""
    own = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        own.append((vec_id, label, [math.floor(256 * v) for v in vector]))
    out = []
    for i, (anchor, label, a) in enumerate(own):
        if not is_anchor(anchor):
            continue
        near = [
            (sum(x * y for x, y in zip(a, c)), vec_id, other)
            for j, (vec_id, other, c) in enumerate(own) if j != i and len(c) == len(a)
        ]
        order = sorted(near, key=lambda n: (-n[0], n[1]))
        for score, positive, _ in [n for n in order if n[2] == label][:positives]:
            hard = [n for n in order if n[2] != label and 50 * score <= 100 * n[0] <= 95 * score][:negatives]
            out += [(anchor, positive, k, n[1], score, n[0]) for k, n in enumerate(hard, 1)]
    return sorted(out)


def made(seed, n, dim, labels=3, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        own = centres[rng.randrange(labels)]
        rows.append((i, label, [round(c + rng.gauss(0, spread), rng.choice([0, 2])) for c in own]))
    return rows


SCHEMA = "vec_id bigint, label int, embedding array<double>"


@pytest.mark.parametrize("low, high", [(-3, 3), (-200, 90), (0, 60_000), (-70_000, 5), (-(2**40), 2**40)])
def test_packed_products_are_exact(low, high):
    rng = np.random.default_rng(abs(low))
    for n, m, dim in ((1, 1, 1), (7, 3, 5), (50, 20, 64), (0, 2, 3), (3, 2, 0)):
        rows, anchors = rng.integers(low, high + 1, (n, dim)), rng.integers(low, high + 1, (m, dim))
        want = anchors.astype(object) @ rows.astype(object).T if n and dim else np.zeros((m, n), object)
        want = np.clip(want, -(2**63), 2**63 - 1)
        got = np.zeros((m, n), object)
        for at, score in hard_negatives.scores(anchors, rows):
            got[at : at + len(score)] = score
        assert (got == want).all()


def test_limits_are_those_of_the_inequality():
    for score in range(-50, 400):
        low, high = hard_negatives.limits(score)
        inside = [n for n in range(-100, 500) if 50 * score <= 100 * n <= 95 * score]
        assert inside == list(range(low, high + 1))


def test_mining_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    monkeypatch.setattr(hard_negatives, "BROADCAST", 4_000)
    monkeypatch.setattr(hard_negatives, "_AT_ONCE", 100)
    rows = made(1, 300, 6)
    rows += [(1_000 + i, r[1], r[2]) for i, r in enumerate(rows[:40])]  # equal vectors, other ids
    rows += [(2_000 + i, i % 3, [1.0, 0.0]) for i in range(12)]  # another length
    rows += [(3_000, 1, []), (3_005, 1, []), (3_010, 2, [])]
    rows += [(None, 1, rows[0][2]), (4_000, None, rows[0][2]), (4_005, 1, None), (4_010, 1, [1.0, None]),
             (4_015, 1, [math.nan] * 6), (4_020, 1, [math.inf] * 6), (4_025, 1, [0.0] * 6)]
    docs = frame(rows, SCHEMA).withColumn("parts", F.lit("x")).withColumn("key", F.lit(1))
    got = hard_negatives.mine(docs, F.col("vec_id") % 5 == 0)
    want = plain(rows, lambda i: i % 5 == 0)
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == want
    monkeypatch.setattr(hard_negatives, "_PENDING", 10)
    again = hard_negatives.mine(docs, F.col("vec_id") % 5 == 0, positives=2, negatives=7)
    assert sorted(map(tuple, again.collect())) == plain(rows, lambda i: i % 5 == 0, 2, 7)


def test_repeated_rows_huge_components_and_empty_tables(frame):
    rows = [(5, 1, [1.0, 2.0])] * 3 + [(6, 2, [1.0, 1.5]), (6, 2, [1.0, 1.5]), (7, 1, [1.0, 2.0])]
    got = hard_negatives.mine(frame(rows, SCHEMA), F.col("vec_id") == 5)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i == 5)
    huge = [(5, 1, [1e300, 1.0]), (6, 1, [1e200, 2.0]), (7, 2, [1.0, 1.0]), (8, 1, [2.0, 1.0])]
    assert hard_negatives.mine(frame(huge, SCHEMA), F.col("vec_id") % 5 == 0).collect() == []
    assert hard_negatives.mine(frame([], SCHEMA), F.col("vec_id") % 5 == 0).collect() == []
    assert hard_negatives.mine(frame(rows, SCHEMA), F.lit(False)).collect() == []


def test_query_follows_the_contract(spark, frame, tmp_path):
    rows = made(2, 400, 8, labels=10)
    frame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<float>")).write.parquet(
        f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op13_hard_negatives"](spark, str(tmp_path))
    assert got.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint")]
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, [float(np.float32(v)) for v in vector])
             for i, label, vector in rows]
    want = plain(moved, lambda i: i % 50 == 0)
    assert want and sorted(map(tuple, got.collect())) == want
