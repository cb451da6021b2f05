import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.plans.assessment import (
    ExpandedReference,
    KeyRule,
    Reference,
    Rulebook,
    assess,
    checked_rules,
    run_assessment,
    violations,
)
from plumbline.operators import checks
from plumbline.sources import tables as tb
from plumbline.sources.registry import MetricStore, ViolationStore
from plumbline.sources.unions import resolve_stand_ins, union_frames, union_sources

CSV = "id;when;v;n\n1;2026-01-02;a;1.5\n2;2026-01-03;NA;-\n3;2026-01-04;'c;d';3.5\n"


@pytest.mark.parametrize(
    ("name", "kind"),
    [("x/t.pq", "parquet"), ("a.JSONL", "ndjson"), (".csv", "csv"), ("json", "json"), ("delta", "delta"), ("t.avro", "avro")],
)
def test_formats(name, kind):
    assert tb.resolve_format(name) == kind


def test_formats_spark_cannot_read():
    with pytest.raises(NotImplementedError):
        tb.resolve_format("book.xlsx")
    with pytest.raises(ValueError):
        tb.resolve_format("notes.txt")


def test_csv_keeps_dates_as_text_and_knows_null_markers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(CSV)
    source = tb.TableSource(str(path), separator=";", quote="'", null_values=("NA", "-"))
    df = source.read(spark)
    assert dict(df.dtypes)["when"] == "string"
    got = sorted(map(tuple, df.collect()))
    assert got[1][2:] == (None, None) and got[2][2] == "c;d"
    typed = tb.TableSource(str(path), separator=";", quote="'", null_values=("NA", "-"), parse_dates=True,
                           schema="id int, when date, v string, n double", columns=["n", "when"], limit=2).read(spark)
    assert typed.columns == ["n", "when"] and typed.count() == 2
    assert typed.schema["when"].dataType.simpleString() == "date"
    dated = tb.TableSource(str(path), separator=";", parse_dates=True, columns=["when"]).read(spark)
    assert sorted(r["when"] for r in dated.collect())[0] == dt.date(2026, 1, 2)


def test_csv_skips_leading_lines_of_each_file(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"part{i}.csv").write_text(f"made by {i}\n\n# note\nid,v\n{i}1,a\n{i}2,b\n")
    for rows, header, expected in ((3, True, [1, 2, 11, 12]),):
        # Spark drops blank lines of text files no earlier than the parser, so they count.
        source = tb.TableSource(str(tmp_path), "csv", skip_rows=rows, header=header, schema="id int, v string")
        assert sorted(r["id"] for r in source.read(spark).collect()) == expected


@pytest.mark.parametrize("kind", ["csv", "parquet", "ndjson"])
def test_round_trip(spark, frame, tmp_path, kind):
    df = frame([(1, "é;", 1.5), (2, None, None)], "a int, b string, c double")
    sink = tb.TableSink(str(tmp_path / "out" / f"t.{kind}"), separator=";", null_value="NULL", compression="gzip")
    sink.write(df)
    back = sink.as_source()
    got = tb.TableSource(**{**back.__dict__, "schema": df.schema}).read(spark)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    sink.append(df)
    assert sink.as_source().read(spark).count() == 4


def test_json_array_document(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert sorted(r["a"] for r in tb.TableSource(str(tmp_path / "t.json")).read(spark).collect()) == [1, 2]


def test_upsert(frame):
    old = frame([(1, "x", 1), (2, "x", 2), (None, "n", 3)], "k int, s string, v int")
    new = frame([(1, "y", 9), (3, "y", 4), (None, "m", 5)], "k int, s string, v int")
    rows = lambda keep: sorted((tuple(r) for r in tb.upsert_frames(old, new, ["k"], keep).collect()), key=repr)
    assert rows("last") == [(1, "y", 9), (2, "x", 2), (3, "y", 4), (None, "m", 5)]
    assert rows("first") == [(1, "x", 1), (2, "x", 2), (3, "y", 4), (None, "n", 3)]
    assert rows("none") == [(2, "x", 2), (3, "y", 4)]
    assert len(rows("any")) == 4
    assert tb.upsert_frames(old, new).count() == 6
    with pytest.raises(ValueError):
        tb.upsert_frames(old, new, ["k"], "some")


def test_versioned_table_can_be_rewritten_from_itself(spark, frame, tmp_path):
    table = tb.VersionedTable(str(tmp_path / "t"))
    assert not table.exists(spark)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.upsert(frame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    table.upsert(frame([(2, "B"), (3, "c")], "k int, v string"), ["k"])
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    (tmp_path / "t" / "v00000009").mkdir()  # a write that never finished
    assert table.read(spark).count() == 3


def test_unions(frame):
    numbers, texts = frame([(1,)], "a bigint"), frame([("91000a",)], "a string")
    assert sorted(r["a"] for r in union_frames([numbers, texts], "vertical_relaxed").collect()) == ["1", "91000a"]
    wide = frame([(1, 2)], "a bigint, b int")
    assert [tuple(r) for r in union_frames([numbers, wide], "diagonal").collect()] == [(1, None), (1, 2)]
    for how, frames in (("vertical", [numbers, texts]), ("vertical", [numbers, wide]), ("diagonal", [texts, wide])):
        with pytest.raises(ValueError):
            union_frames(frames, how)
    assert union_frames([texts, wide], "diagonal_relaxed").count() == 2


def test_stand_ins():
    stored = ["a__union__b", "a__union__b__union__c", "b__union__c", "c__union__a"]
    assert resolve_stand_ins(["a", "b", "c", "d"], stored) == ["a__union__b__union__c", "d"]
    assert resolve_stand_ins(["b", "a", "b"], stored) == ["b", "a__union__b"]
    assert resolve_stand_ins(["c", "a", "b", "c"], stored) == ["c__union__a", "b__union__c"]
    assert resolve_stand_ins(["b", "a"], stored) == ["b", "a"]


def test_union_sources_projects_after_the_union(frame):
    catalog = {"a": frame([(1, 2)], "x int, y int"), "b": frame([(3, 4)], "x int, y int")}
    catalog["a__union__b"] = frame([(9, 9)], "x int, y int")
    assert [tuple(r) for r in union_sources(["a", "b"], catalog, columns=["y"]).collect()] == [(9,)]


def test_ingest_stamps_dense_ids(spark, frame, tmp_path):
    spark.range(500).repartition(7).write.parquet(str(tmp_path / "raw.parquet"))
    source, sink = tb.TableSource(str(tmp_path / "raw.parquet")), tb.TableSink(str(tmp_path / "t.parquet"))
    tb.ingest(spark, source, sink, lambda df: df.withColumn("t", F.col("id") * 2))
    out = spark.read.parquet(sink.path)
    assert sorted(r["row_id"] for r in out.collect()) == list(range(500))
    assert out.columns == ["row_id", "id", "t"]
    with pytest.raises(FileNotFoundError):
        tb.ingest(spark, tb.TableSource(str(tmp_path / "no.parquet")), sink)


def test_run_transform_and_query(spark, frame, tmp_path):
    frame([(1,), (2,)], "a int").write.parquet(str(tmp_path / "a.parquet"))
    source = tb.TableSource(str(tmp_path / "a.parquet"))
    sink = tb.TableSink(str(tmp_path / "b.parquet"))
    tb.run_transform(spark, [source, source], lambda x, y: tb.query(x.union(y), "SELECT sum(a) AS s FROM self"), sink)
    assert spark.read.parquet(sink.path).first()["s"] == 6
    tb.preview(spark.read.parquet(sink.path), 1)


# Stores and the assessment


@pytest.fixture
def shop(frame):
    orders = [(1, 10, "A-1", "5", "6", "9"), (2, None, "A-2", "5", "4", "9"), (3, 11, "b", "1", "2", "3"), (4, 10, "A-1", "1", "2", "3")]
    return {
        "orders": frame(orders, "id bigint, customer bigint, code string, low string, mid string, high string"),
        "customers": frame([(10, "Ann A-1"), (12, "Bo")], "customer bigint, name string"),
    }


RULES = Rulebook(
    row_checks={
        "orders": [
            checks.not_null("customer"),
            checks.matches("code", r"^A-\d$"),
            checks.one_of("code", ["A-1", "A-2"]),
            checks.ordered("low", "mid", "high"),
        ]
    },
    keys=[KeyRule(("orders",), ("code",)), KeyRule(("orders",), ("customer", "code"))],
    references=[
        Reference("orders", "customers", (("customer", "customer"),)),
        Reference("orders", "customers", (("code", "name"),), fuzzy=True),
        ExpandedReference("orders", "customers", "mid", (("customer", r"(\d)"),), ("customer",)),
    ],
    dispersions=[("orders", "customer", "customers", "customer")],
    variations={"orders": ["customer"]},
)


def test_assess(shop):
    out = assess(shop, RULES, "2026-03-01")
    assert set(out) == {"completeness", "format", "labels", "interval", "uniqueness", "foreign_key", "variation", "dispersion"}
    assert out["completeness"].first()["completeness_percent"] == 0.75
    assert out["interval"].first()["interval_percent"] == 0.75
    shares = {r["column_name_1"]: r["fk_percent"] for r in out["foreign_key"].collect()}
    assert shares == {"customer": 0.5, "code": 0.75, "mid": 0.0}
    unique = {r["column_name"]: r["uniqueness_percent"] for r in out["uniqueness"].collect()}
    assert unique == {"code": 0.5, "code, customer": 0.5}
    stamps = {r["timestamp"] for df in out.values() for r in df.collect()}
    assert stamps == {dt.datetime(2026, 3, 1)}


def test_violations_cover_every_rule(shop):
    found = violations(shop, RULES, {"orders": "id"})
    by_rule = {}
    for r in found.collect():
        by_rule.setdefault((r["source"], r["rule"]), set()).add(r["row_id"])
    assert by_rule["orders", "completeness: customer"] == {2}
    assert by_rule["orders", "uniqueness: code, customer"] == {1, 4}
    assert by_rule["orders -> customers", "foreign_key: customer, customer"] == {2, 3}
    assert set(by_rule) <= checked_rules(RULES)


def test_a_second_run_replaces_failing_rows_and_appends_metrics(spark, shop, tmp_path):
    metrics, store = MetricStore(str(tmp_path / "m")), ViolationStore(str(tmp_path / "v"))
    rules = Rulebook(row_checks={"orders": RULES.row_checks["orders"][:2]}, keys=RULES.keys)
    run_assessment(shop, rules, {"orders": "id"}, metrics, store, "2026-03-01")
    first = store.read(spark).collect()
    assert {r["rule"] for r in first} == {
        "completeness: customer", "format: code", "uniqueness: code", "uniqueness: code, customer",
    }
    # Repaired: no customer is missing any more, which must empty that rule and no other.
    shop["orders"] = shop["orders"].fillna(12, ["customer"])
    run_assessment(shop, rules, {"orders": "id"}, metrics, store, "2026-04-01")
    spark.catalog.clearCache()
    after = ViolationStore(str(tmp_path / "v")).read(spark).collect()
    assert {r["rule"] for r in after} == {"format: code", "uniqueness: code", "uniqueness: code, customer"}
    assert len(after) == len(first) - 1
    history = metrics.read(spark, "completeness")
    assert sorted(r["completeness_percent"] for r in history.collect()) == [0.75, 1.0]
    metrics.views(spark, ["completeness"], "v_")
    assert spark.sql("SELECT max(timestamp) AS t FROM v_completeness").first()["t"] == dt.datetime(2026, 4, 1)


@pytest.mark.parametrize("skip", [0, 2])
def test_a_misfit_far_down_is_text_or_an_error(spark, tmp_path, skip):
    path = tmp_path / "codes.csv"
    path.write_text("note\n" * skip + "code\n" + "\n".join(str(91000 + i) for i in range(150)) + "\n91000a\n")
    read = tb.TableSource(str(path), skip_rows=skip).read(spark)
    assert dict(read.dtypes) == {"code": "string"}
    assert read.where("code = '91000a'").count() == 1 and read.where("code is null").count() == 0
    for source in (
        tb.TableSource(str(path), skip_rows=skip, schema="code int"),
        tb.TableSource(str(path), skip_rows=skip, sample_lines=100),
    ):
        with pytest.raises(Exception, match="MALFORMED|91000a|FAILFAST"):
            source.read(spark).collect()
    lenient = tb.TableSource(str(path), skip_rows=skip, schema="code int", options={"mode": "PERMISSIVE"})
    assert lenient.read(spark).where("code is null").count() == 1


def test_relaxed_union_of_booleans_and_numbers(frame):
    flags, numbers = frame([(True,), (None,)], "a boolean"), frame([(7,)], "a bigint")
    out = union_frames([flags, numbers], "vertical_relaxed")
    assert [r["a"] for r in out.collect()] == [1, None, 7]
    assert [r["a"] for r in union_frames([flags, frame([("x",)], "a string")], "vertical_relaxed").collect()] == [
        "true", None, "x",
    ]
    assert union_frames([flags, flags], "vertical_relaxed").schema["a"].dataType.simpleString() == "boolean"


def test_failing_rows_are_written_without_a_sort(spark, frame, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (seen.append(spark.conf.get(key)), write(w, *a, **k))[1])
    before = spark.conf.get(key, None)
    rows = [("s", f"r{i % 150}", i) for i in range(1500)]  # more rules than files are open at a time
    store = ViolationStore(str(tmp_path / "v"))
    store.replace(frame(rows, "source string, rule string, row_id bigint"), [])
    assert int(seen[0]) > 1 and spark.conf.get(key, None) == before
    assert sorted((r["source"], r["rule"], r["row_id"]) for r in store.read(spark).collect()) == sorted(rows)
