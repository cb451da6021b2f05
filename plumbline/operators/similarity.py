"""Similarity joins with a threshold: all pairs of texts of two tables that are alike enough, without a cross join.

*Edit similarity* is 1 - distance / length of the longer text. A text of the right side is cut into pieces at fixed places,
more of them than the most edits any partner may be away. An edit spoils one piece, so of any `edits + 1`
pieces one stands unchanged in the partner, shifted by no more than the edits allow. Of each text only its `edits + 1`
rarest pieces are indexed; pieces that many texts share, such as a common beginning, generate no candidates. The
left side looks up what it has at each possible length, piece and shift. Where the longer of two texts allows one edit
only, they meet on what is left of them without one character instead: texts that are numbered without gaps share most
of their pieces, but meet so only those they are alike to.

*Set similarity* (words, trigrams) is Jaccard's. Tokens are ordered by how rare they are over both sides; two sets that
are alike share one of their first few tokens.

Both compare distinct texts, candidates meet in plain shuffles that AQE splits where one key is hot, and every
candidate is verified. Thresholds are taken as the decimal they are written as, and compared in integers.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.skew import spread_join

PIECE = 3  # characters that a piece has at least, unless more pieces are needed
COMMON = 10_000  # texts with a piece at one place, beyond which its count is broadcast and its rows are not shuffled
MEASURES = ("edit", "words", "trigrams")


def _parts(threshold: float | str) -> tuple[int, int]:
    exact = Fraction(str(threshold))
    if not 0 < exact <= 1:
        raise ValueError("a threshold lies above 0 and is at most 1")
    return exact.numerator, exact.denominator


def _div(a: Column, b: Column | int) -> Column:
    """Whole part of a / b for small non-negative integers."""
    return F.floor(a / b).cast("int")


def _edits(n: Column, num: int, den: int) -> Column:
    """Edits allowed between two texts of which the longer one has `n` characters."""
    return _div(n * (den - num), den)


def _between(first: Column, last: Column) -> Column:
    """The integers from `first` to `last`; none if there are none (sequence() would count down)."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


class _Cut:
    """How a text of `n` characters is cut, given the threshold: a function of its length alone."""

    def __init__(self, n: Column, num: int, den: int) -> None:
        self.n = n
        longest = _div(n * den, num)  # the longest partner
        self.budget = _edits(longest, num, den)  # edits to any partner
        self.pieces = F.greatest(self.budget + 1, _div(n, PIECE), F.lit(1))

    def piece(self, i: Column) -> tuple[Column, Column]:
        """(start from 0, length) of piece i: the last ones are a character longer."""
        base, rest = _div(self.n, self.pieces), self.n % self.pieces
        longer = self.pieces - rest
        return i * base + F.greatest(F.lit(0), i - longer), base + F.when(i >= longer, 1).otherwise(0)


def _tasks(df: DataFrame) -> int:
    """By number: by bytes, AQE would put many rows that are all alike into one sort."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _index(texts: DataFrame, num: int, den: int) -> DataFrame:
    """(other, n, i, piece): the rarest pieces of each text, as many as the edits plus one."""
    cut = _Cut(F.col("n"), num, den)

    def piece(i: Column) -> Column:
        start, size = cut.piece(i)
        return F.struct(i.alias("i"), F.substring("other", start + 1, size).alias("piece"))

    pieces = texts.withColumn("n", F.length("other")).select(
        "other", "n", cut.budget.alias("budget"),
        F.inline(F.transform(F.sequence(F.lit(0), cut.pieces - 1), piece)),
    )
    keys = ["n", "i", "piece"]
    often = pieces.groupBy(*keys).agg(F.count(F.lit(1)).alias("often"))
    # Of a million rows there are at most a hundred common pieces. What is left has no hot key; it is merged, because
    # unfolded pieces are many times the bytes by which Spark would take them for small enough to broadcast.
    marked = pieces.join(F.broadcast(often.where(F.col("often") > COMMON)), keys, "left")
    rare = marked.where("often is null").drop("often").hint("merge").join(often.where(F.col("often") <= COMMON), keys)
    counted = marked.where("often is not null").unionByName(rare)
    order = Window.partitionBy("other").orderBy("often", "i")  # no more rows than the text has pieces
    tasks = _tasks(texts)
    return (
        counted.repartition(tasks, "other")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.col("budget") + 1)
        .select("other", "n", "i", "piece")
    )


def _probes(texts: DataFrame, num: int, den: int) -> DataFrame:
    """(own, n, i, piece): what an indexed text of n characters would share with `own` if it were alike."""
    m = F.col("m")

    def at_length(n: Column) -> Column:
        cut = _Cut(n, num, den)
        edits = _edits(F.greatest(n, m), num, den)
        shift = m - n

        def at_piece(i: Column) -> Column:
            start, size = cut.piece(i)
            # Edits before the piece shift it, those behind make up the difference in length.
            first = F.greatest(start - _div(edits - shift, 2), F.lit(0))
            last = F.least(start + _div(edits + shift, 2), m - size)
            return F.transform(
                _between(first, last),
                lambda at: F.struct(n.alias("n"), i.alias("i"), F.substring("own", at + 1, size).alias("piece")),
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), cut.pieces - 1), at_piece))

    lengths = _between(F.ceil(m * num / den).cast("int"), _div(m * den, num))
    lengths = F.filter(lengths, lambda n: _edits(F.greatest(n, m), num, den) > 1)
    found = F.array_distinct(F.flatten(F.transform(lengths, at_length)))
    return texts.withColumn("m", F.length("own")).select("own", F.inline(found))


def _without(text: Column, at: Column) -> Column:
    """The text without its character `at`, from 0; the whole text if `at` is below."""
    rest = F.concat(F.substring(text, F.lit(1), at), F.substring(text, at + 2, F.length(text)))
    return F.when(at < 0, text).otherwise(rest)


def _less_one(texts: DataFrame, name: str, num: int, den: int) -> DataFrame:
    """(key, `name`, first, last): texts of at most one edit, whole (first is -1) and without each of their characters.

    The characters of a run leave the same rest: those from `first` to `last` are one row. The key is a hash of the rest.
    """
    text, at, n = F.col(name), F.col("at"), F.length(name)
    edits = _edits(n, num, den)
    rows = texts.where(edits <= 1).select(
        name, F.explode(F.sequence(F.lit(-1), F.when(edits == 1, n - 1).otherwise(-1))).alias("at")
    )
    letter, tail = F.substring(text, at + 1, F.lit(1)), F.substring(text, at + 1, n)
    return rows.where((at < 1) | (letter != F.substring(text, at, F.lit(1)))).select(
        F.xxhash64(_without(text, at)).alias("key"), name, at.alias(f"{name}_first"),
        F.when(at < 0, n).otherwise(n - 1 - F.length(F.ltrim(tail, letter))).alias(f"{name}_last"),
    )


def _near(own: DataFrame, other: DataFrame, num: int, den: int) -> DataFrame:
    """(own, other, distance): the pairs of which the longer text allows no more than one edit, each once.

    Two texts are an edit apart if one is a rest of the other, or both leave the same rest without a character at the same
    place; no two such texts have more than one rest in common.
    """
    # As in _index, rows that are many times their bytes in a shuffle are not to be broadcast.
    tasks = _tasks(own)
    lefts, rights = (_less_one(side, c, num, den).repartition(tasks, "key") for side, c in ((own, "own"), (other, "other")))
    met = lefts.hint("merge").join(rights, "key")
    a, b, a_first, b_first = (F.col(c) for c in ("own", "other", "own_first", "other_first"))
    at_one_place = (a_first <= F.col("other_last")) & (b_first <= F.col("own_last"))
    edited = (a != b) & (_without(a, a_first) == _without(b, b_first))
    same = (a == b) & (a_first < 0) & (b_first < 0)
    return met.where(at_one_place & (edited | same)).select("own", "other", F.when(a == b, 0).otherwise(1).alias("distance"))


def _edit_pairs(own: DataFrame, other: DataFrame, num: int, den: int) -> DataFrame:
    if 2 * num <= den:
        raise ValueError("by edit distance, thresholds must lie above one half")
    longest = F.greatest(F.length("own"), F.length("other"))
    far = [side.where(_Cut(F.length(c), num, den).budget > 1) for side, c in ((own, "own"), (other, "other"))]
    met = _probes(far[0], num, den).join(_index(far[1], num, den), ["n", "i", "piece"])
    close = met.select("own", "other", F.levenshtein("own", "other").alias("distance")).where(
        F.col("distance") * den <= longest * (den - num)
    )
    pairs = close.distinct().unionByName(_near(own, other, num, den))
    similarity = F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.col("distance") / longest)
    return pairs.select("own", "other", similarity.alias("similarity"))


def tokens(text: Column, measure: str) -> Column:
    """The distinct words between blanks, or the distinct runs of three characters."""
    if measure == "words":
        return F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    places = _between(F.lit(1), F.length(text) - 2)
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, F.lit(3))))


def _set_pairs(own: DataFrame, other: DataFrame, measure: str, num: int, den: int) -> DataFrame:
    both = own.select(F.lit(True).alias("left"), F.col("own").alias("text")).unionByName(
        other.select(F.lit(False).alias("left"), F.col("other").alias("text"))
    )
    listed = both.select("left", "text", F.explode(tokens(F.col("text"), measure)).alias("token"))
    often = listed.groupBy("token").agg(F.count(F.lit(1)).alias("often"))
    sets = (
        spread_join(listed, often, ["token"])
        .groupBy("left", "text")
        .agg(F.sort_array(F.collect_list(F.struct("often", "token")))["token"].alias("all"))
        .withColumn("size", F.size("all"))
        .withColumn("head", F.slice("all", 1, F.col("size") - F.ceil(F.col("size") * num / den).cast("int") + 1))
        .withColumn("token", F.explode("head"))
    )
    a, b = sets.where("left").alias("a"), sets.where("not left").alias("b")
    first = F.element_at(F.array_intersect("a.head", "b.head"), 1)  # the sets meet at each token their heads share
    met = a.join(b, F.col("a.token") == F.col("b.token")).where(
        (F.col("a.size") * num <= F.col("b.size") * den) & (F.col("b.size") * num <= F.col("a.size") * den)
        & (F.col("a.token") == first)
    )
    shared = F.size(F.array_intersect("a.all", "b.all"))
    counted = met.select(
        F.col("a.text").alias("own"), F.col("b.text").alias("other"), shared.alias("shared"),
        (F.col("a.size") + F.col("b.size") - shared).alias("either"),
    )
    return counted.where(F.col("shared") * den >= F.col("either") * num).select(
        "own", "other", (F.col("shared") / F.col("either")).alias("similarity")
    )


def _text(on: str | Sequence[str]) -> Column:
    """One column, or several as one text with blanks in between; null if any is null."""
    names = [on] if isinstance(on, str) else list(on)
    return F.concat(*(part for i, n in enumerate(names) for part in ([F.lit(" ")] if i else []) + [F.col(n).cast("string")]))


def similar_values(
    left: DataFrame, right: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str],
    threshold: float | str, measure: str = "edit",
) -> DataFrame:
    """(own, other, similarity): the distinct texts of both sides that are at least `threshold` alike.

    Nulls are alike to nothing. By edit distance two empty texts are equal, and work grows with the cube of the
    allowed edits: it is meant for names, and thresholds above one half. Sets without tokens are alike to nothing.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    num, den = _parts(threshold)
    own = left.select(_text(left_on).alias("own")).where("own is not null").distinct()
    other = right.select(_text(right_on).alias("other")).where("other is not null").distinct()
    if measure == "edit":
        return _edit_pairs(own, other, num, den)
    return _set_pairs(own, other, measure, num, den)


def similarity_join(
    left: DataFrame, right: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str],
    threshold: float | str, measure: str = "edit",
) -> DataFrame:
    """The pairs of rows whose texts are at least `threshold` alike: both rows' columns and their similarity.

    Rows are matched to the similar texts by their own text, so copies of a text cost no comparison.
    """
    taken = set(left.columns) & set(right.columns) | {"similarity"} & {*left.columns, *right.columns}
    if taken:
        raise ValueError(f"rename columns that clash: {sorted(taken)}")
    pairs = similar_values(left, right, left_on, right_on, threshold, measure).toDF("__own", "__other", "similarity")
    lefts = spread_join(left.withColumn("__own", _text(left_on)), pairs, ["__own"])
    rights = right.withColumn("__other", _text(right_on))
    return spread_join(lefts, rights, ["__other"]).select(*left.columns, *right.columns, "similarity")
