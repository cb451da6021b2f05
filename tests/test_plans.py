import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.plans import integration, repair, scorecard
from plumbline.operators.rescale import Triplet
from plumbline.sources.tables import VersionedTable

DISTRICTS = "ID_Rue string, ID_Ville string, ID_Iris string"


def test_paris(frame):
    consumption = frame([("BAC", 75007, 2.0), ("BAC", 75001, 4.0), ("BAC", 91000, 50.0), ("LYS", 75001, 1.0)],
                        "Nom_Rue string, Code_Postal int, NB_KW_Jour double")
    districts = frame([("BAC", "Paris", "i1"), ("BAC", "91000", "i2"), ("LYS", "Evry", "i3")], DISTRICTS)
    out = integration.consumption_by_district_paris(consumption, districts).collect()
    assert sorted(map(tuple, out)) == [("i1", 3 * 365.0), ("i2", 50 * 365.0)]


def test_evry(frame):
    consumption = frame([("RUE DU LAC", 2.0), ("PLACE DU LAC", 4.0), ("X", 9.0)], "Nom_Rue string, NB_KW_Jour double")
    districts = frame([("Lac", "Evry", "i1"), ("RUE DU", "Evry", "i2")], DISTRICTS)
    out = integration.consumption_by_district_evry(consumption, districts).collect()
    assert sorted(map(tuple, out)) == [("i1", 3 * 365.0), ("i2", 2 * 365.0)]


def test_categories(frame):
    people_1 = frame([("Paris, 4 rue Bac", "cadre"), ("Paris, 5 rue Bac", "nobody")], "Adresse string, CSP string")
    used_1 = frame([(4, "BAC", 2.0), (5, "BAC", 6.0)], "N bigint, Nom_Rue string, NB_KW_Jour double")
    people_2 = frame([("Evry, 91000, 7 Allée Été", 3)], "Adresse string, CSP bigint")
    used_2 = frame([(7, "ALLEE ETE", "91000", 10.0)], "N bigint, Nom_Rue string, Code_Postal string, NB_KW_Jour double")
    categories = frame([(3, "Cadres et professions", 40.0)], "ID_CSP bigint, Desc string, Salaire_Moyen double")
    tables = (people_1, used_1, people_2, used_2, categories)
    out = {r["ID_CSP"]: r["Conso_moyenne_annuelle"] for r in integration.consumption_by_category(*tables).collect()}
    assert out == {3: 6 * 365.0, None: 6 * 365.0}
    inner = integration.consumption_by_category(*tables, how="inner").collect()
    assert [r["ID_CSP"] for r in inner] == [3]


HISTORY = [
    ("s", "a", 0.5, dt.datetime(2026, 1, 1)),
    ("s", "a", 0.7, dt.datetime(2026, 2, 1)),
    ("s", "a", 0.8, dt.datetime(2026, 2, 1)),  # a tie
    ("s", "b", 0.9, dt.datetime(2026, 1, 1)),  # missing in the second run
]
METRIC = "source string, column_name string, completeness_percent double, timestamp timestamp_ntz"


def test_latest_keeps_ties_and_rules_missing_later(frame):
    out = scorecard.latest(frame(HISTORY, METRIC), ["source", "column_name"])
    assert sorted(r["completeness_percent"] for r in out.collect()) == [0.7, 0.8, 0.9]


def test_scorecard_and_roll_up(frame):
    ratio = frame(
        [("t", "lo", "mid", "hi", 0.25, 0.75, dt.datetime(2026, 2, 1))],
        "source string, column_name_min string, column_name_mean string, column_name_max string, "
        "ratio_position double, ratio_score double, timestamp timestamp_ntz",
    )
    pairs = frame(
        [("x", "y", 0.9, 9.0, 1.0, dt.datetime(2026, 2, 1), "s"), ("y", "x", 0.9, 1.0, 1.0, dt.datetime(2026, 2, 1), "s")],
        "x string, y string, M1 double, M2 double, M3 double, timestamp timestamp_ntz, source string",
    )
    card = scorecard.scorecard(
        {"completeness": frame(HISTORY, METRIC), "position_ratio": ratio, "coherence": pairs}, {"Paris": ["s"]}
    )
    rows = card.collect()
    assert len(rows) == 6 and sum(r["is_latest"] for r in rows) == 5
    assert {r["rule"] for r in rows} == {"a", "b", "lo / mid / hi", "all pairs (x, y)"}
    assert {r["city"] for r in rows} == {"Paris", "Common"}
    top = {(r["level"], r["metric"]): (r["score"], r["rules"]) for r in scorecard.roll_up(card).collect()}
    assert top["metric", "Non-null values"] == (pytest.approx(0.8), 3)
    assert top["metric", "Candidate rules respected"] == (0.5, 1)
    assert scorecard.daily_scores(card).count() == 4


def test_repairs_write_only_when_told(spark, frame, tmp_path):
    data = frame([(1, 900, 1000, 18000), (2, 900, 1100, 24000)], "row_id bigint, low bigint, mid bigint, high bigint")
    target = VersionedTable(str(tmp_path / "pay"))
    triplet = Triplet("low", "mid", "high")
    dry = repair.repair_ratio(data, triplet, "high", [12], target=target)
    assert (dry.method, dry.written, target.exists(spark)) == ("divide_by_12", False, False)
    assert repair.repair_ratio(data, triplet, "high", [12], target=target, apply=True).written
    assert sorted(r["high"] for r in target.read(spark).collect()) == [1500.0, 2000.0]
    refused = repair.repair_ratio(data, triplet, "high", [1.0], target=target, apply=True)
    assert (refused.method, refused.written) == ("no_correction", False)
    left, right = frame([(float(i),) for i in range(9)], "v double"), frame([(10.0 * i,) for i in range(9)], "v double")
    scaled = repair.repair_scale(left, right, "v", [10.0], 0.05, target=VersionedTable(str(tmp_path / "v")), apply=True)
    assert (scaled.method, scaled.written) == ("known_factor", True)


def test_deduplicate_a_union_of_prepared_sources(spark, frame, tmp_path):
    a = frame([("1", "Ann", "x")], "id string, name string, csp string")
    b = frame([(1, "Ann", 3), (2, "Bo", 4)], "id bigint, name string, csp bigint")
    text = lambda df: df.selectExpr("cast(id as string) id", "name", "cast(csp as string) csp")
    ids = frame([(i, "a+b", "name") for i in range(3)], "row_id bigint, source string, column_name string")
    target = VersionedTable(str(tmp_path / "ab"))
    result = repair.deduplicate_sources(["a", "b"], {"a": a, "b": b}, ids, prepare=[None, text], target=target)
    assert sorted(r["name"] for r in result.deduped.collect()) == ["Ann", "Bo"]
    assert target.read(spark).count() == 2


def test_union_of_sources_that_both_count_from_zero(spark, frame):
    from plumbline.plans.assessment import KeyRule, Rulebook, violations
    from plumbline.sources.unions import union_row_ids

    a = frame([(0, "Ann"), (1, "Cy"), (2, "Di"), (3, "Ed")], "row_id bigint, name string")
    b = frame([(0, "Bo"), (1, "Flo"), (2, "Ann"), (3, "Gus")], "row_id bigint, name string")
    rules = Rulebook(keys=[KeyRule(("a", "b"), ("name",))])
    with pytest.raises(ValueError):
        violations({"a": a, "b": b}, rules, {"a": "row_id", "b": "row_id"})
    tables = union_row_ids(["a", "b"], {"a": a, "b": b}, "row_id")
    failing = violations(tables, rules, {"a": "row_id", "b": "row_id"})
    errors = failing.select("row_id", "source", "column_name")
    with pytest.raises(ValueError):
        repair.deduplicate_sources(["a", "b"], {"a": a, "b": b}, errors)
    result = repair.deduplicate_sources(["a", "b"], tables, errors)
    assert sorted(r["name"] for r in result.deduped.collect()) == ["Ann", "Bo", "Cy", "Di", "Ed", "Flo", "Gus"]


def test_all_repairs_of_a_table_in_order(frame):
    rows = [(0, "u", 900, 1000, 18000.0), (1, "u", 900, 1000, 18000.0), (2, "v", 900, 1100, None), (3, "w", 950, 1200, 2000.0)]
    data = frame(rows, "row_id bigint, name string, low bigint, mid bigint, high double")
    errors = frame([(0, "s", "name")], "row_id bigint, source string, column_name string")
    out = repair.repair_table(
        data, "s", errors, ratio=(Triplet("low", "mid", "high"), "high", [12]), impute_columns=["low", "mid", "high"]
    ).orderBy("row_id").collect()
    assert [r["row_id"] for r in out] == [0, 2, 3]
    assert out[0]["high"] == 1500.0 and out[1]["high"] is not None
    assert repair.complete(data, ["mid", "high"]).where("high is null").count() == 0


def test_latest_takes_null_for_an_ordinary_key(frame):
    rows = [("a", None, 1), ("a", None, 2), ("b", "c", 1)]
    history = frame(rows, "source string, column_name string, timestamp int")
    found = {tuple(r) for r in scorecard.latest(history, ["source", "column_name"]).collect()}
    assert found == {("a", None, 2), ("b", "c", 1)}


def test_columns_in_use_invalidate_their_sources(frame):
    from plumbline.plans.assessment import ExpandedReference, KeyRule, Reference, Rulebook
    from plumbline.plans.coherent import coherent_projection, used_columns

    rules = Rulebook(
        keys=[KeyRule(("a", "b"), ("id",))],
        references=[
            Reference("c", "a", (("a_id", "id"),)), ExpandedReference("d", "c", "note", (("n", r"\d+"),), ("num",)),
            Reference("e", "f", (("x", "y"),)),
        ],
    )
    assert used_columns(rules) == {
        "a": {"id"}, "b": {"id"}, "c": {"a_id", "num"}, "d": {"note"}, "e": {"x"}, "f": {"y"}}
    tables = {n: frame([(1, 2, 3)], "id int, a_id int, extra int") for n in "abcdef"}

    def projected(*broken, spread=True):
        rows = [(x, "y", 0.9, 9.0, 1.0, s, "2026-01-01") for s, x in broken] + [("a_id", "y", 0.9, 1.0, 1.0, "f", "2026-01-01")]
        analysis = frame(rows, "x string, y string, M1 double, M2 double, M3 double, source string, timestamp string")
        return coherent_projection(tables, rules, analysis, spread)

    kept = projected(("a", "extra"), ("f", "extra"), ("f", "gone"), ("z", "extra"))
    assert kept.dropped == {"a": ["extra"], "f": ["extra"]} and not kept.invalid and set(kept.tables) == set("abcdef")
    assert kept.tables["a"].columns == ["id", "a_id"] and kept.tables["b"].columns == ["id", "a_id", "extra"]
    lost = projected(("a", "id"), ("c", "extra"))
    assert lost.broken == {"a": ["id"]} and lost.invalid == set("abcd") and set(lost.tables) == {"e", "f"}
    assert projected(("a", "id"), spread=False).invalid == {"a"}
    assert not projected().dropped


def test_incremental_scores_equal_a_full_run(spark, frame, tmp_path):
    from plumbline.operators import checks
    from plumbline.plans.assessment import KeyRule, Rulebook, assess
    from plumbline.plans.incremental import IncrementalAssessment

    rules = Rulebook(
        row_checks={"a": [checks.not_null("x"), checks.one_of("t", ["u"]), checks.matches("t", "^u")], "b": [checks.not_null("x")]},
        keys=[KeyRule(("a", "b"), ("x",)), KeyRule(("a",), ("x", "t"))],
    )
    schema = "x int, t string"
    runs = {s: tmp_path / s for s in "ab"}
    state = IncrementalAssessment(spark, str(tmp_path / "states"), rules)

    def put(source, name, rows):
        frame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "new"))
        runs[source].mkdir(exist_ok=True)
        part = next((tmp_path / "new").glob("part-*.parquet"))
        (runs[source] / name).write_bytes(part.read_bytes())

    def same():
        full = assess({s: spark.read.schema(schema).parquet(str(p)) for s, p in runs.items()}, rules, "2026-01-01")
        own = state.scores("2026-01-01")
        assert set(own) == set(full)
        for metric in full:
            assert sorted(map(tuple, own[metric].select(*full[metric].columns).collect()), key=repr) == sorted(
                map(tuple, full[metric].collect()), key=repr), metric

    put("a", "1.parquet", [(1, "u"), (2, None), (None, "v"), (None, "v")])
    put("b", "1 é.parquet", [(1, "u"), (5, "u")])
    assert state.update("a", str(runs["a"])).scanned == ["1.parquet"]
    assert state.update("b", str(runs["b"])).scanned == ["1 é.parquet"]
    same()
    put("a", "2.parquet", [(2, "u"), (3, "w")])
    put("a", "3.parquet", [(3, "w")])
    assert state.update("a", str(runs["a"])).scanned == ["2.parquet", "3.parquet"]
    same()
    assert state.update("a", str(runs["a"])).scanned == []
    put("a", "2.parquet", [(9, "u"), (9, None), (9, "u")])  # written anew
    (runs["a"] / "3.parquet").unlink()
    change = state.update("a", str(runs["a"]))
    assert (change.scanned, change.taken_back) == (["2.parquet"], ["2.parquet", "3.parquet"])
    same()
    # States of a run that broke off before its manifest do not count, and the next run goes on behind them.
    lost = spark.read.parquet(str(tmp_path / "states" / "rows")).withColumn("batch", F.lit(99).cast("bigint"))
    lost.write.mode("append").parquet(str(tmp_path / "states" / "rows"))
    same()
    put("a", "4.parquet", [(1, "u")])
    state.update("a", str(runs["a"]))
    same()


def test_states_of_files_taken_back_are_neither_copied_nor_counted(spark, frame, tmp_path):
    from plumbline.plans.assessment import KeyRule, Rulebook
    from plumbline.plans.incremental import IncrementalAssessment

    rules = Rulebook(keys=[KeyRule(("a",), ("x",))])
    state = IncrementalAssessment(spark, str(tmp_path / "states"), rules)
    (tmp_path / "a").mkdir()

    def put(name, values):
        frame([(v,) for v in values], "x int").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "new"))
        (tmp_path / "a" / name).write_bytes(next((tmp_path / "new").glob("part-*.parquet")).read_bytes())

    def score():
        return state.scores("2026-01-01")["uniqueness"].first()["uniqueness_percent"]

    put("1.parquet", [1, 1, 2])
    put("2.parquet", [2, 3])
    state.update("a", str(tmp_path / "a"))
    assert score() == pytest.approx(1 / 5)
    (tmp_path / "a" / "2.parquet").unlink()
    assert state.update("a", str(tmp_path / "a")).taken_back == ["2.parquet"]
    assert score() == pytest.approx(1 / 3)
    keys = spark.read.parquet(str(tmp_path / "states" / "key_counts"))
    assert keys.count() == 4 and {len(r["key"]) for r in keys.collect()} == {16}
    # Key states of a run that broke off before its manifest do not count, also without any row check.
    keys.where("batch = 1").withColumn("batch", F.lit(7).cast("bigint")).write.mode("append").parquet(
        str(tmp_path / "states" / "key_counts"))
    put("2.parquet", [2, 2])
    state.update("a", str(tmp_path / "a"))
    assert score() == 0.0 and spark.read.parquet(str(tmp_path / "states" / "manifest")).agg(F.max("batch")).first()[0] == 8
    (tmp_path / "old" / "keys").mkdir(parents=True)
    with pytest.raises(ValueError):
        IncrementalAssessment(spark, str(tmp_path / "old"), rules)
