"""Delimited records against Python's csv module, with blocks so small that records cross them."""

import csv
import io
import random

import pytest

from plumbline.sources import tables as tb
from plumbline.sources.records import Records, ends_inside

TEXTS = ['plain', 'say ""hi"", ok'.replace('""', '"'), "two\nlines", "a\r\nb", ",", '"', '""', '\n', "", " padded ", "é x",
         'end"', "x" * 300 + "\n" + "y" * 300, 'q"\n"q', "\t", "NULL?", "#", "\\", 'back\\"slash', "last\n"]


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("line, outside, inside", [
    ("a,b", False, True), ('"a"', False, False), ('a,"b', True, False), ('"a""', True, False), ('"a""b"', False, True),
    ('5" pipe,x', False, False), ('b",c', False, False), ('b",c,"d', True, True), ('""', False, True), (',"",', False, True), ("", False, True), ('"""', True, False),
    ('a"b"', False, False), ('"', True, False),
])
def test_how_a_line_ends(line, outside, inside):
    assert ends_inside(line, False, ",", '"') == outside
    # Within quotes: the line behind an opening quote, as a reader of one line would see it.
    assert ends_inside(line, True, ",", '"') == ends_inside('"' + line, False, ",", '"')


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_the_file(spark, tmp_path, small_blocks, end):
    rng = random.Random(5)
    want = []
    for part in range(3):
        rows = [(f"{part}-{i}", rng.choice(TEXTS) or "-", rng.choice(TEXTS) or "-", str(i)) for i in range(80)]
        write(tmp_path / f"{part}.csv", [("id", "a", "b", "n"), *rows], end)
        want += rows
    records = Records(spark, str(tmp_path))
    assert records.lines.rdd.getNumPartitions() > 12 and records.may_span_lines()
    assert len(records._inside()) > 3
    got = tb.TableSource(str(tmp_path), "csv").read(spark)
    assert got.dtypes == [("id", "string"), ("a", "string"), ("b", "string"), ("n", "int")]
    assert sorted((r["id"], r["a"], r["b"], str(r["n"])) for r in got.collect()) == sorted(want)


def test_empty_texts_are_not_null_and_quoted_numbers_are_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,s,n\n"1","",""\n"2",,"7"\n3,NA,\n"4","x\ny","8"\n')
    got = tb.TableSource(str(tmp_path / "t.csv"), null_values=("NA",)).read(spark)
    assert got.dtypes == [("id", "int"), ("s", "string"), ("n", "int")]
    assert sorted(map(tuple, got.collect())) == [(1, "", None), (2, None, 7), (3, None, None), (4, "x\ny", 8)]
    bad = tb.TableSource(str(tmp_path / "t.csv"), schema="id int, s int, n int").read(spark)
    with pytest.raises(Exception, match="not a int"):
        bad.collect()


def test_skipped_lines_and_no_header(spark, tmp_path, small_blocks):
    for i in range(2):
        (tmp_path / f"{i}.csv").write_text(f'made "by {i}\n\n{i}1,"a\nb"\n{i}2,"c ""d"""\n' + f"{i}3,{'z' * 200}\n")
    source = tb.TableSource(str(tmp_path), "csv", skip_rows=2, header=False, schema="id int, v string")
    want = [(i * 10 + j, v) for i in range(2) for j, v in ((1, "a\nb"), (2, 'c "d"'), (3, "z" * 200))]
    assert sorted(map(tuple, source.read(spark).collect())) == want
    one = tb.TableSource(str(tmp_path), "csv", skip_rows=2, header=False, sample_lines=2).read(spark)
    assert one.dtypes == [("_c0", "int"), ("_c1", "string")] and one.count() == 6


@pytest.mark.parametrize("separator, quote", [(",", '"'), (";", "'"), ("\t", '"')])
def test_what_is_written_is_read_back_and_by_others(spark, frame, tmp_path, separator, quote):
    rows = [(i, t, None if i % 4 == 0 else TEXTS[-i - 1]) for i, t in enumerate(TEXTS)]
    df = frame(rows, "id int, a string, b string")
    sink = tb.TableSink(str(tmp_path / "t"), "csv", separator=separator, quote=quote)
    sink.write(df)
    back = sink.as_source().read(spark)
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    others = []
    for part in sorted((tmp_path / "t").glob("part-*")):
        others += list(csv.reader(io.StringIO(part.read_bytes().decode(), newline=""), delimiter=separator, quotechar=quote))[1:]
    assert sorted(others) == sorted([str(i), a, b or ""] for i, a, b in rows)


def test_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,"a\nb"\n')
    assert tb.TableSource(str(tmp_path / "t.csv")).read(spark).count() == 0
