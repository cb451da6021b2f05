"""Joins on "a `/`-tag of one side is a literal substring of the other side".

The condition is no equality, so Spark alone would compare every pair of rows. Instead:

* results are kept per distinct value, by digest, so hot values and long texts stay out of shuffles;
* each reference text is cut into grams of bytes, each tag is looked up by the gram of it that is
  rarest among the references, and only the (tag, reference) pairs sharing that gram are verified.

A tag inside a text has all its grams inside that text, so the lookup loses nothing; choosing the
rarest gram keeps prefixes common to all tags ("customer#") from pairing everything.

Where it only matters which values match, not what, many short tags are looked up as grams of their own length:
they meet the distinct grams and no text, so no pair is made at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import compact, strip, tags
from plumbline.operators.skew import COUNT, spread_join
from plumbline.session import checkpoint

GRAM_LENGTHS = (1, 3, 6, 12)  # bytes; a tag is looked up by the longest of these that fits into it
MAX_BROADCAST_GRAMS = 1_000_000  # checked by a count; beyond it the lookup is a shuffle join
WHOLE = 12  # bytes; shorter tags are looked up as a whole where only they are asked for
BLOCK = 65_536  # positions of a text that are unfolded at a time

LEFT, RIGHT = "__left_digest", "__right_digest"


def _digest(column: str) -> Column:
    return F.unhex(F.sha2(F.col(column).cast("string"), 256))


def _gram_length(tag: Column) -> Column:
    fitting = [F.when(F.octet_length(tag) >= n, n) for n in sorted(GRAM_LENGTHS, reverse=True)]
    return F.coalesce(*fitting)


def _with_grams(df: DataFrame, text: str, lengths: Sequence[int], hashed: bool = True) -> DataFrame:
    """`df` unfolded to one row per gram of `text`: `__gram`, its first byte `__at`, its length `__size`.

    Grams are hashed, unless their bytes are asked for; equal hashes are verified on the texts later. Positions are unfolded, not
    strings, and grams are taken from bytes, where substring() need not walk over characters: the
    text itself is never copied and everything stays in generated code.
    """
    size = F.octet_length(text)
    blocks = F.sequence(F.lit(0), size - 1, F.lit(BLOCK))
    placed = df.where(size > 0).select(*df.columns, F.explode(blocks).alias("__from"))
    at = F.sequence(F.col("__from") + 1, F.least(F.col("__from") + BLOCK, size))
    placed = placed.select(*df.columns, F.explode(at).alias("__at"))
    placed = placed.select(*df.columns, "__at", F.explode(F.array(*(F.lit(n) for n in lengths))).alias("__size"))
    gram = F.substring(F.col(text).cast("binary"), F.col("__at"), F.col("__size"))
    fits = F.col("__at") + F.col("__size") <= size + 1
    gram = F.xxhash64(gram) if hashed else gram
    return placed.where(fits).select(*df.columns, "__at", "__size", gram.alias("__gram"))


def _rarest(tag_grams: DataFrame, frequency: DataFrame) -> DataFrame:
    """(tag, gram, place in the tag): the gram seen least in the references; unseen ones drop their tag."""
    rank = F.struct(F.coalesce(F.col(COUNT), F.lit(0)).alias("n"), F.col("__gram"), F.col("__place"))
    return (
        tag_grams.join(frequency, "__gram", "left")
        .groupBy("__tag")
        .agg(F.min(rank).alias("m"))
        .where("m.n > 0")
        .select("__tag", F.col("m.__gram").alias("__gram"), F.col("m.__place").alias("__place"))
    )


def _matches_of_few_tags(
    refs: DataFrame, tag_grams: DataFrame, lengths: Sequence[int], out: Sequence[str]
) -> DataFrame:
    """The tags travel to the references: texts are cut, looked up and verified where they are read."""
    wanted = F.broadcast(tag_grams.select("__gram").distinct())
    seen = _with_grams(refs.select("__ref"), "__ref", lengths).join(wanted, "__gram", "left_semi")
    frequency = seen.groupBy("__gram").agg(F.count(F.lit(1)).alias(COUNT))
    lookup = F.broadcast(_rarest(tag_grams, frequency))
    found = _with_grams(refs, "__ref", lengths).join(lookup, "__gram")
    # The gram fixes where the tag would have to start: compare just there, not over the whole text.
    start = F.col("__at") - F.col("__place") + 1
    there = F.substring(F.col("__ref").cast("binary"), start, F.octet_length("__tag"))
    same = (start >= 1) & (there == F.col("__tag").cast("binary"))
    return found.where(same).select(*out).distinct()


def _matches_of_many_tags(
    refs: DataFrame, tag_grams: DataFrame, lengths: Sequence[int], out: Sequence[str]
) -> DataFrame:
    """Both sides meet on the gram in a shuffle; each distinct text is then verified by its digest."""
    refs = refs.distinct()
    wanted = tag_grams.select("__gram").distinct()
    ref_grams = (
        _with_grams(refs, "__ref", lengths)
        .select("__ref_digest", "__gram")
        .join(wanted, "__gram", "left_semi")
        .distinct()
    )
    frequency = ref_grams.groupBy("__gram").agg(F.count(F.lit(1)).alias(COUNT))
    candidates = spread_join(
        ref_grams, _rarest(tag_grams, frequency), ["__gram"]
    ).select("__tag", "__ref_digest")
    return (
        candidates.join(refs, "__ref_digest")
        .where(F.contains(F.col("__ref"), F.col("__tag")))
        .select(*out)
        .distinct()
    )


def _short_tags_inside(refs: DataFrame, tag_set: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The tags of `lengths` bytes that lie inside some text: both sides are distinct, so no key is hot."""
    seen = _with_grams(refs.select("__ref"), "__ref", lengths, hashed=False).select("__gram").distinct()
    short = tag_set.where(F.octet_length("__tag") <= WHOLE).select("__tag", F.col("__tag").cast("binary").alias("__gram"))
    return short.join(seen, "__gram", "left_semi").select("__tag")


def _value_tags(tag_side: DataFrame, tag_column: str, key: Column) -> DataFrame:
    """(`__key`, `__tag`) of the distinct values: a value and its tags travel as one row."""
    value = F.col(tag_column).cast("string")
    distinct = tag_side.select(key.alias("__key"), tags(value).alias("__tags")).distinct()
    return distinct.select("__key", F.explode("__tags").alias("__tag"))


def _matched_tags(
    tag_side: DataFrame,
    tag_column: str,
    ref_side: DataFrame,
    ref_column: str,
    out: Sequence[str],
    max_broadcast: int,
) -> DataFrame:
    """The columns `out` (`__tag`, perhaps `__ref_digest`) of the tags that lie inside a reference.

    One action on the tag side finds the gram lengths in use and how many grams there are; that
    number decides whether the tags can be broadcast.
    """
    refs = ref_side.select(
        _digest(ref_column).alias("__ref_digest"),
        strip(F.lower(F.col(ref_column).cast("string"))).alias("__ref"),
    )

    listed = tag_side.select(F.explode(tags(F.col(tag_column).cast("string"))).alias("__tag"))
    tag_set = listed.distinct().withColumn("__len", _gram_length(F.col("__tag")))
    # Only the grams of the length chosen for the tag.
    tag_grams = (
        _with_grams(tag_set, "__tag", GRAM_LENGTHS)
        .where(F.col("__size") == F.col("__len"))
        .groupBy("__tag", "__len", "__gram")
        .agg(F.min("__at").alias("__place"))
    )

    size = F.octet_length("__tag")
    used = tag_grams.agg(
        F.collect_set("__len").alias("lengths"), F.count(F.lit(1)).alias("grams"),
        F.collect_set(F.when(size <= WHOLE, size)).alias("short"), F.max(size).alias("longest"),
    ).first()
    lengths = sorted(used["lengths"]) or [GRAM_LENGTHS[0]]
    tag_grams = tag_grams.drop("__len")
    if used["grams"] <= max_broadcast:
        return _matches_of_few_tags(refs, tag_grams, lengths, out)
    if list(out) != ["__tag"]:
        return _matches_of_many_tags(refs, tag_grams, lengths, out)
    parts = []
    if used["short"]:
        parts.append(_short_tags_inside(refs, tag_set, sorted(used["short"])))
    if used["longest"] > WHOLE:
        long_ones = tag_grams.where(size > WHOLE)
        parts.append(_matches_of_many_tags(refs, long_ones, [n for n in lengths if n == max(GRAM_LENGTHS)], out))
    return reduce(DataFrame.unionByName, parts)


def matching_values(
    tag_side: DataFrame,
    tag_column: str,
    ref_side: DataFrame,
    ref_column: str,
    max_broadcast: int = MAX_BROADCAST_GRAMS,
) -> DataFrame:
    """Distinct (`__tag_digest`, `__ref_digest`) of values where some tag is inside the reference."""
    matched = _matched_tags(
        tag_side, tag_column, ref_side, ref_column, ["__tag", "__ref_digest"], max_broadcast
    )
    value_tags = _value_tags(tag_side, tag_column, _digest(tag_column))
    return value_tags.join(matched, "__tag").select(F.col("__key").alias("__tag_digest"), "__ref_digest").distinct()


def contains_join(
    left: DataFrame,
    right: DataFrame,
    left_column: str,
    right_column: str,
    included: Literal["left", "right"] = "left",
    how: Literal["left", "right", "inner"] = "left",
) -> DataFrame:
    """All pairs of rows where a tag of the `included` side lies inside the other side's value.

    Tags are the `/`-separated parts, compared without case and outer blanks, as literal text.
    Each pair appears once, however many tags match. `left`/`right` keep unmatched rows of that
    side with nulls for the other. Columns are those of `left`, then those of `right`, a name that
    both have ending in `_right`.
    """
    if included not in ("left", "right"):
        raise ValueError(f"included must be left or right, not {included!r}")
    if how not in ("left", "right", "inner"):
        raise ValueError(f"how must be left, right or inner, not {how!r}")
    if included == "left":
        pairs = matching_values(left, left_column, right, right_column).select(
            F.col("__tag_digest").alias(LEFT), F.col("__ref_digest").alias(RIGHT)
        )
    else:
        pairs = matching_values(right, right_column, left, left_column).select(
            F.col("__ref_digest").alias(LEFT), F.col("__tag_digest").alias(RIGHT)
        )
    # A digest fixes the raw value and pairs are distinct, hence no row pair can come out twice. Both joins are
    # inner joins of plain shuffles, whose two sides AQE splits where a value is hot. An outer join could
    # not split the side of the pairs, so rows without a partner are added by an anti join.
    left_rows = _renamed(left, "__l", _digest(left_column).alias(LEFT))
    right_rows = _renamed(right, "__r", _digest(right_column).alias(RIGHT))
    if how != "inner":
        pairs = checkpoint(pairs)  # read twice
    joined = left_rows.join(pairs, LEFT).join(right_rows, RIGHT)
    if how != "inner":
        preserved, digest = (left_rows, LEFT) if how == "left" else (right_rows, RIGHT)
        alone = preserved.join(pairs.select(digest).distinct(), digest, "left_anti")
        joined = joined.unionByName(alone, allowMissingColumns=True)
    return joined.select(
        *(F.col(f"__l{i}").alias(c) for i, c in enumerate(left.columns)),
        *(
            F.col(f"__r{i}").alias(f"{c}_right" if c in left.columns else c)
            for i, c in enumerate(right.columns)
        ),
    )


def _renamed(df: DataFrame, prefix: str, digest: Column) -> DataFrame:
    return df.select(digest, *(F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(df.columns)))


def has_match(
    left: DataFrame,
    right: DataFrame,
    left_column: str,
    right_column: str,
    max_broadcast: int = MAX_BROADCAST_GRAMS,
) -> DataFrame:
    """`__key` (see `value_key`) of the `left` values of which a tag lies inside some `right` value.

    Only tags leave the lookup, so a short tag found everywhere is one record and not one per text.
    """
    matched = _matched_tags(left, left_column, right, right_column, ["__tag"], max_broadcast)
    value_tags = _value_tags(left, left_column, value_key(left_column))
    return spread_join(value_tags, matched, ["__tag"], "left_semi").select("__key").distinct()


def value_key(column: str) -> Column:
    """A value as `has_match` names it: its text, or the digest of a long one."""
    return compact(F.col(column).cast("string"))
