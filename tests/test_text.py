import unicodedata

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as tx
from plumbline.functions.numbers import number, parse_number, rescale


def one(frame, value, expression):
    return frame([(value,)], "v string").select(expression.alias("o")).first()["o"]


def test_extract_uses_the_group_or_the_whole_match(frame):
    assert one(frame, "ab12", tx.extract(F.col("v"), r"(\d+)")) == "12"
    assert one(frame, "ab12", tx.extract(F.col("v"), r"\d")) == "1"
    assert one(frame, "ab", tx.extract(F.col("v"), r"(\d+)")) is None
    assert one(frame, "ab", tx.extract(F.col("v"), r"b(\d*)")) == ""
    assert one(frame, None, tx.extract(F.col("v"), r"(\d*)")) is None


def test_replacements_are_literal(frame):
    assert one(frame, "a1b", tx.replace_literal(F.col("v"), r"\d", r"$0\x")) == r"a$0\xb"


def test_final_dollar_means_the_end(frame):
    assert one(frame, "abc\n", tx.finds(F.col("v"), "^[a-z]+$")) is False
    assert one(frame, r"a$", tx.finds(F.col("v"), r"a\$")) is True
    assert one(frame, "é", tx.finds(F.col("v"), r"^\w$")) is True


def test_accents(frame):
    letters = "".join(chr(c) for c in range(0xC0, 0x250) if unicodedata.category(chr(c)).startswith("L"))
    single = [c for c in letters if len(unicodedata.normalize("NFKD", c).rstrip("".join(map(chr, range(0x300, 0x370))))) == 1]
    plain = "".join(single)
    expected = "".join(x for x in unicodedata.normalize("NFKD", plain) if not 0x300 <= ord(x) <= 0x36F)
    assert one(frame, plain, tx.fold_accents(F.col("v"))) == expected
    assert one(frame, "Κύπρος ﬁ", tx.fold_accents_any_script(F.col("v"))) == "Κυπρος fi"
    assert one(frame, "éte", tx.fold_accents(F.col("v"))) == "ete"


def test_expand_column(frame):
    df = frame([("Évry, 91000, 19 Allée du Lac ",), ("nowhere",)], "a string")
    out = tx.expand_column(df, "a", tx.ADDRESS_PARTS, types={"N": "bigint"}).collect()
    assert tuple(out[0])[1:] == (19, "ALLEE DU LAC", "91000")
    assert tuple(out[1])[1:] == (None, None, None)
    paris = frame([("Paris, 20 rue Du Bac",)], "a string")
    out = tx.expand_column(paris, "a", tx.ADDRESS_PARTS[:-1], [(r"^Paris,\s*", "Paris, 75000, "), ("(?i)rue", "")])
    assert tuple(out.first())[1:] == ("20", "DU BAC")


def test_expand_column_checks_its_arguments(frame):
    df = frame([("x",)], "a string")
    with pytest.raises(ValueError, match="repeated"):
        tx.expand_column(df, "a", [("n", "x"), ("n", "y")])
    with pytest.raises(ValueError, match="not extracted"):
        tx.expand_column(df, "a", [("n", "x")], types={"m": "int"})


def test_cast_columns(frame):
    df = frame([("16 800", 2.0)], "a string, b double")
    out = df.transform(tx.cast_columns(["a", "b"], "bigint", (r"\s+", "")))
    assert tuple(out.first()) == (16800, 2)


def test_tags(frame):
    assert one(frame, " A / b// c /a", tx.tags(F.col("v"))) == ["a", "b", "c"]


def test_numbers(frame):
    assert one(frame, "16 800 ", parse_number(F.col("v"))) == 16800.0
    df = frame([("x",)], "v string")
    assert df.select(number(df, "v", strict=False).alias("o")).first()["o"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(number(df, "v")).collect()


def test_rescale(frame):
    df = frame([(10,), (None,)], "v int")
    assert [r["v"] for r in rescale(df, "v", 2.5, 1).collect()] == [26.0, None]
    for bad in (lambda: rescale(df, "w", 1), lambda: rescale(df, "v", float("inf"))):
        with pytest.raises(ValueError):
            bad()


def test_compact_keeps_equality(frame):
    rows = [("a" * n + s,) for n in (1, 63, 64, 65, 200) for s in ("", "b")]
    df = frame(rows, "v string")
    assert df.select(tx.compact(F.col("v"))).distinct().count() == len(set(rows))
    assert df.select(F.max(F.length(tx.compact(F.col("v")))).alias("m")).first()["m"] <= 71
