import random

import pytest

from plumbline.operators import references
from plumbline.operators.contains import contains_join, matching_values
from plumbline.operators.skew import count_by, spread_join

AT = "2026-03-01 12:00:00"


def pairs(df, a="x", b="y"):
    return sorted(((r[a], r[b]) for r in df.collect()), key=repr)


@pytest.fixture
def tags(frame):
    return frame([("pear/fig", 1), ("nut", 2), (None, 3), (" / ", 4), ("PEAR / pear", 5)], "tags string, x int")


@pytest.fixture
def refs(frame):
    rows = [("ripe Pear", "A"), ("a fig, a pear", "B"), ("plum", "C"), (None, "D"), ("", "E")]
    return frame(rows, "ref string, y string")


def test_inner_gives_each_matching_pair_once(tags, refs):
    out = contains_join(tags, refs, "tags", "ref", how="inner")
    assert pairs(out) == [(1, "A"), (1, "B"), (5, "A"), (5, "B")]
    assert out.columns == ["tags", "x", "ref", "y"]


def test_left_and_right_keep_unmatched_rows(tags, refs):
    left = contains_join(tags, refs, "tags", "ref")
    assert [p for p in pairs(left) if p[1] is None] == [(2, None), (3, None), (4, None)]
    right = contains_join(tags, refs, "tags", "ref", how="right")
    assert [p for p in pairs(right) if p[0] is None] == [(None, "C"), (None, "D"), (None, "E")]


def test_roles_can_be_swapped(tags, refs):
    out = contains_join(refs, tags, "ref", "tags", included="right", how="inner")
    assert pairs(out, "x", "y") == [(1, "A"), (1, "B"), (5, "A"), (5, "B")]


def test_tags_are_literal(frame):
    tags = frame([("a.c", 1), ("a*b", 2), ("%", 3)], "t string, x int")
    refs = frame([("xa.c", "dot"), ("abc", "any"), ("xa*b", "star"), ("aab", "rep")], "r string, y string")
    assert pairs(contains_join(tags, refs, "t", "r", how="inner")) == [(1, "dot"), (2, "star")]


def test_repeated_rows_all_appear(frame):
    tags = frame([("ab", 1), ("ab", 2)], "t string, x int")
    refs = frame([("cab", "A"), ("cab", "B")], "r string, y string")
    assert len(pairs(contains_join(tags, refs, "t", "r", how="inner"))) == 4


def test_empty_sides(frame):
    tags, none = frame([("ab", 1)], "t string, x int"), frame([], "r string, y string")
    assert pairs(contains_join(tags, none, "t", "r")) == [(1, None)]
    assert contains_join(tags.limit(0), frame([("ab", "A")], "r string, y string"), "t", "r").count() == 0


@pytest.mark.parametrize("max_broadcast", [0, 1_000_000])
def test_lookup_equals_brute_force_on_either_path(frame, max_broadcast):
    rng = random.Random(5)
    word = lambda a, b: "".join(rng.choice("abé") for _ in range(rng.randint(a, b)))
    left = [(word(1, 4) + "/" + word(2, 15),) for _ in range(60)] + [("abab" * 4,), ("abab" * 4,)]
    right = [(word(0, 60),) for _ in range(60)] + [("xx" + "abab" * 5,), ("b" * 70_000 + "ab" * 9,)]
    expected = {
        (l, r) for (l,) in left for (r,) in right if any(t.strip() and t.strip() in r.strip() for t in l.split("/"))
    }
    from plumbline.operators.contains import _digest

    tags, refs = frame(left, "t string").distinct(), frame(right, "r string").distinct()
    found = (
        matching_values(tags, "t", refs, "r", max_broadcast=max_broadcast)
        .join(tags.withColumn("__tag_digest", _digest("t")), "__tag_digest")
        .join(refs.withColumn("__ref_digest", _digest("r")), "__ref_digest")
        .select("t", "r")
        .collect()
    )
    assert len(found) == len(expected)
    assert {(r["t"], r["r"]) for r in found} == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_a_plain_join(spark, how):
    from pyspark.sql import functions as F

    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 40).alias("k"))
    keyed = spark.range(20).select((F.col("id") * 2).alias("k"), (F.col("id") + 100).alias("v")).unionByName(
        spark.range(1).select(F.lit(None).cast("bigint").alias("k"), F.lit(7).cast("bigint").alias("v"))
    )
    got = spread_join(rows, keyed, ["k"], how)
    same = rows["k"].eqNullSafe(keyed["k"])
    want = rows.join(keyed, same, how).select(rows["id"], rows["k"], *([] if "semi" in how or "anti" in how else ["v"]))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr
    )


def test_foreign_key_nulls_and_duplicates(frame):
    left = frame([("a", 1), ("a", 2), (None, 3), ("z", 4)], "k string, id int")
    right = frame([("a",), ("a",), (None,), ("b",)], "k2 string")
    out = references.foreign_key(left, right, [("k", "k2")], ("l", "r"), AT).first()
    assert (out["fk_percent"], out["column_name_1"], out["column_name_2"]) == (0.5, "k", "k2")
    bad = references.foreign_key_violations(left, right, [("k", "k2")], ("l", "r"), ["id"])
    assert sorted((r["column_name"], r["id"]) for r in bad.collect()) == [("k, k2", 3), ("k, k2", 4)]


def test_foreign_key_to_an_empty_table_and_across_types(frame):
    left = frame([(1, 1.5), (2, 2.5)], "k bigint, d double")
    assert references.foreign_key(left, frame([], "k2 bigint"), [("k", "k2")], ("l", "r"), AT).first()["fk_percent"] == 0.0
    text = frame([("1",), ("91000a",)], "k2 string")
    assert references.foreign_key(left, text, [("k", "k2")], ("l", "r"), AT).first()["fk_percent"] == 0.5


def test_fuzzy_foreign_key_counts_a_row_once(frame):
    left = frame([("pear", 1), ("fig/zzz", 2), ("zzz", 3), (None, 4)], "k string, id int")
    right = frame([("a pear",), ("two pears",), ("fig",)], "k2 string")
    out = references.fuzzy_foreign_key(left, right, [("k", "k2")], ("l", "r"), AT).first()
    assert out["fk_percent"] == 0.5
    bad = references.fuzzy_foreign_key_violations(left, right, [("k", "k2")], ("l", "r"), ["id"])
    assert sorted(r["id"] for r in bad.collect()) == [3, 4]


def test_expanded_foreign_key_needs_all_keys_together(frame):
    rows = [("Lyon, 69001, 4 Rue É", 1), ("Lyon, 69002, 4 Rue É", 2), ("Lyon", 3), ("Lyon, 69001, 5 Rue É", 4)]
    left = frame(rows, "address string, id int")
    right = frame([(4, "RUE E", "69001"), (5, "OTHER", "69001"), (4, "RUE E", None)], "N bigint, Nom_Rue string, Code_Postal string")
    from plumbline.functions.text import ADDRESS_PARTS

    keys = ["N", "Nom_Rue", "Code_Postal"]
    out = references.expanded_foreign_key(left, right, "address", ADDRESS_PARTS, [], keys, ("l", "r"), AT).first()
    assert (out["fk_percent"], out["column_name_2"]) == (0.25, "N, Nom_Rue, Code_Postal")
    bad = references.expanded_foreign_key_violations(
        left, right, "address", ADDRESS_PARTS, [], keys, ("l", "r"), ["id"]
    )
    assert sorted(r["id"] for r in bad.collect()) == [2, 3, 4]


@pytest.mark.parametrize("how", ["left", "right"])
def test_outer_substring_join_has_no_outer_join(tags, refs, how):
    """Spark cannot split the other side of an outer join where a tag is hot."""
    joined = contains_join(tags, refs, "tags", "ref", how=how)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftOuter" not in plan and "RightOuter" not in plan


def test_many_short_tags_meet_no_text(frame, monkeypatch):
    from plumbline.operators import contains

    random.seed(3)
    letters = ["a", "b", "\u00e9", "1"]
    word = lambda n: "".join(random.choices(letters, k=n))
    refs = [word(random.randint(1, 30)) for _ in range(60)] + ["", None]
    values = [f"{word(random.randint(1, 4))}/ {word(random.randint(1, 9))}" for _ in range(60)] + [None, "/"]
    values += [refs[0][:12].upper(), f"nothing/{refs[1][:13]}", refs[2] + "x" * 70]
    inside = {v for v in values if v and any(t and any(t in r for r in refs if r) for t in (x.strip().lower() for x in v.split("/")))}
    left = frame([(i, v) for i, v in enumerate(values)], "id int, v string")
    right = frame([(r,) for r in refs], "r string")
    for most in (0, 10_000):
        found = contains.has_match(left, right, "v", "r", max_broadcast=most)
        keyed = left.select("v", contains.value_key("v").alias("__key")).join(found, "__key")
        assert {r["v"] for r in keyed.collect()} == inside
    short = left.where("length(v) < 12")
    plan = contains.has_match(short, right, "v", "r", max_broadcast=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" not in plan and "sha2" not in plan.split("__ref")[-1]  # no pair of a tag and a text
    monkeypatch.setattr(references, "has_match", lambda *a: contains.has_match(*a, max_broadcast=0))
    failing = references.fuzzy_foreign_key_violations(left, right, [("v", "r")], ("a", "b"), ["id"])
    assert {r["id"] for r in failing.collect()} == {i for i, v in enumerate(values) if v not in inside}
    score = references.fuzzy_foreign_key(left, right, [("v", "r")], ("a", "b"), "2026-01-01").first()
    assert score["fk_percent"] == sum(v in inside for v in values) / len(values)
