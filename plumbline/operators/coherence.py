"""Statistical coherence: how well one column's groups explain another column.

For every ordered pair (x, y), with the rows grouped by y:

    M1 = (var - var_intra) / (var + eps)      share of x's variance explained by y
    M2 = max_g var_g / (var_intra + eps)      the worst group
    M3 = max_g sqrt(N_g) |mu_g - mu| / (sd + eps)

Numbers, booleans and dates are taken as numbers, arrays as vectors, text as unit vectors of its
character trigrams. One pass over the table serves all y at once (GROUPING SETS); what is shuffled
are groups, not rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import numeric_view
from plumbline.functions.text import compact, compact_texts
from plumbline.operators.checks import grouping_bits, run_timestamp
from plumbline.operators.skew import COUNT, spread_join
from plumbline.session import Checkpoints
from plumbline.sources.unions import union_all

EPSILON = 1e-11
MIN_COMPLETENESS = 0.8
DETECTED = 0.5  # M1 above this makes (x, y) a candidate rule
MAX_M2, MAX_M3 = 5.0, 10.0  # a candidate rule within both limits is respected
TRIGRAM_DIMENSIONS = 4_096
CHUNK = 64
PIVOTS = 8
SKETCH, KEY_SHARE = 12, 0.8  # a sketch of 2^12 registers errs by 1.6 % (standard deviation)
MAX_GROUPING_COLUMNS = 32  # grouping_id() is a 64-bit number


# Which columns take part


def column_profile(df: DataFrame, min_completeness: float = MIN_COMPLETENESS) -> DataFrame:
    """(column_name, total_rows, distinct_values, null_rows, representative) per column.

    Null is one distinct value. Representative: no key, at least two distinct non-null values, and
    (rows - nulls) / rows >= min_completeness. Exact: the table is grouped by each column in turn,
    in one pass, and only distinct values are shuffled.
    """
    if not 0.0 <= min_completeness <= 1.0:  # NaN fails as well
        raise ValueError(f"min_completeness must be in [0, 1], not {min_completeness}")
    parts = [
        _profile(compact_texts(df, df.columns).select(*df.columns[i : i + MAX_GROUPING_COLUMNS]))
        for i in range(0, len(df.columns), MAX_GROUPING_COLUMNS)
    ]
    filled = (F.col("total_rows") - F.col("null_rows")) / F.col("total_rows")
    representative = (
        (F.col("distinct_values") != F.col("total_rows"))
        & (F.col("distinct_values") - F.when(F.col("null_rows") > 0, 1).otherwise(0) >= 2)
        & (filled >= min_completeness)
    )
    return union_all(parts).withColumn("representative", representative)


def _profile(df: DataFrame) -> DataFrame:
    columns = df.columns
    groups = df.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias(COUNT)
    )
    is_null = F.lit(False)
    name = F.lit(None).cast("string")
    for c in columns:
        mine = F.col("gid") == grouping_bits(columns, [c])
        is_null = F.when(mine, F.col(c).isNull()).otherwise(is_null)
        name = F.when(mine, F.lit(c)).otherwise(name)
    return (
        groups.select(name.alias("column_name"), is_null.alias("is_null"), COUNT)
        .groupBy("column_name")
        .agg(
            F.sum(COUNT).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_values"),
            F.sum(F.when(F.col("is_null"), F.col(COUNT)).otherwise(0)).alias("null_rows"),
        )
    )


def representative_names(df: DataFrame, min_completeness: float = MIN_COMPLETENESS) -> list[str]:
    """The columns that `column_profile` calls representative, from sketches wherever they decide.

    One pass counts nulls and keeps the least and greatest hash and a HyperLogLog sketch per column; no value is
    shuffled. Only a column that may be a key, as its estimate reaches KEY_SHARE of the rows (many times the
    sketch's error below all of them), is counted exactly.
    """
    if not 0.0 <= min_completeness <= 1.0:  # NaN fails as well
        raise ValueError(f"min_completeness must be in [0, 1], not {min_completeness}")
    names = df.columns
    if not names:
        return []
    hashes = df.select(*(
        F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(f"`{c}`")).alias(f"h{i}") for i, c in enumerate(names)
    ))
    counted = hashes.agg(
        F.count(F.lit(1)).alias("total"),
        *(part for i in range(len(names)) for part in (
            F.count(f"h{i}").alias(f"n{i}"), F.min(f"h{i}").alias(f"min{i}"), F.max(f"h{i}").alias(f"max{i}"),
            F.hll_sketch_estimate(F.hll_sketch_agg(f"h{i}", SKETCH)).alias(f"d{i}"),
        )),
    ).first()
    total, decided, open_columns = counted["total"], [], []
    for i, c in enumerate(names):
        filled, several = counted[f"n{i}"], counted[f"min{i}"] != counted[f"max{i}"]
        if total and several and filled / total >= min_completeness:
            distinct = (counted[f"d{i}"] or 0) + (filled < total)
            (decided if distinct < KEY_SHARE * total else open_columns).append(c)
    if open_columns:
        rows = column_profile(df.select(*(F.col(f"`{c}`") for c in open_columns)), min_completeness)
        decided += [r["column_name"] for r in rows.where("representative").select("column_name").collect()]
    return [c for c in names if c in set(decided)]


def representative_columns(
    df: DataFrame, min_completeness: float = MIN_COMPLETENESS
) -> DataFrame:
    """`df` without keys, constants and sparse columns; the order of columns is kept."""
    return df.select(*(F.col(f"`{c}`") for c in representative_names(df, min_completeness)))


# Label distances


def label_distances(labels: DataFrame, column: str, blocks: int = 16) -> DataFrame:
    """(label_1, label_2, distance) for label_1 < label_2: edit distance over the longer length.

    The result itself is quadratic in the distinct labels. Labels are dealt into blocks and each
    pair of blocks is one join key, so the work is spread evenly whatever the labels are.
    """
    distinct = labels.select(F.col(column).alias("label")).where("label is not null").distinct()
    block = F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    cell = distinct.select("label", block.alias("b"), F.explode(others).alias("o"))
    cell = cell.select(
        "label", "b", F.least("b", "o").alias("low"), F.greatest("b", "o").alias("high")
    )
    left = cell.select("low", "high", F.col("label").alias("label_1"), F.col("b").alias("b1"))
    right = cell.select("low", "high", F.col("label").alias("label_2"), F.col("b").alias("b2"))
    # Two labels of different blocks meet in exactly the cell of those blocks.
    in_cell = (F.col("low") == F.col("high")) | (F.col("b1") != F.col("b2"))
    pairs = left.join(right, ["low", "high"]).where(in_cell & (F.col("label_1") < F.col("label_2")))
    longer = F.greatest(F.length("label_1"), F.length("label_2"))
    distance = F.coalesce(
        F.try_divide(F.levenshtein("label_1", "label_2").cast("double"), longer.cast("double")),
        F.lit(0.0),
    )
    return pairs.select("label_1", "label_2", distance.alias("distance"))


def distance(a: Column, b: Column, vectors: bool = False) -> Column:
    """Euclidean between arrays, absolute difference between numbers."""
    if not vectors:
        return F.abs(a - b)
    squares = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


# Grouped distributions: each function yields (y, x, n, var, dist, total_var) per group


def _group_sets(ys: Sequence[str]) -> list[list[Column]]:
    return [[F.col(f"__y{i}")] for i in range(len(ys))]


def _group_columns(df: DataFrame, ys: Sequence[str]) -> list[Column]:
    return [
        (compact(F.col(y)) if isinstance(df.schema[y].dataType, T.StringType) else F.col(y)).alias(f"__y{i}")
        for i, y in enumerate(ys)
    ]


def _y_name(ys: Sequence[str]) -> Column:
    """The y a group belongs to; grouping columns kept in every set add no bit."""
    every = [f"__y{i}" for i in range(len(ys))]
    name = F.lit(None).cast("string")
    for own, y in zip(every, ys):
        name = F.when(F.col("gid") == grouping_bits(every, [own]), F.lit(y)).otherwise(name)
    return name


def _numeric_groups(df: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """All numeric x by all y in one aggregation."""
    slots = {x: f"__x{i}" for i, x in enumerate(xs)}
    data = df.select(
        *(numeric_view(x, df.schema[x].dataType).alias(slot) for x, slot in slots.items()),
        *_group_columns(df, ys),
    )
    overall = data.agg(
        *(F.avg(s).alias(f"m{s}") for s in slots.values()),
        *(F.var_pop(s).alias(f"v{s}") for s in slots.values()),
    )
    globals_ = overall.select(F.struct("*").alias("g")).scalar()
    every = [f"__y{i}" for i in range(len(ys))]
    groups = data.groupingSets(_group_sets(ys), *every).agg(
        F.grouping_id().alias("gid"),
        *(F.count(s).alias(f"n{s}") for s in slots.values()),
        *(F.avg(s).alias(f"m{s}") for s in slots.values()),
        *(F.var_pop(s).alias(f"v{s}") for s in slots.values()),
    )
    with_globals = groups.withColumn("g", globals_)
    return with_globals.select(
        _y_name(ys).alias("y"),
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(x).alias("x"),
                        F.col(f"n{s}").alias("n"),
                        F.col(f"v{s}").alias("var"),
                        F.abs(F.col(f"m{s}") - F.col(f"g.m{s}")).alias("dist"),
                        F.col(f"g.v{s}").alias("total_var"),
                    )
                    for x, s in slots.items()
                )
            )
        ).alias("r"),
    ).select("y", "r.*")


def _vector_groups(df: DataFrame, x: str, ys: Sequence[str]) -> DataFrame:
    """Mean vector and summed variance per group, in one buffer per group instead of a row per dimension."""
    data = df.where(F.col(x).isNotNull()).select(
        array_to_vector(F.col(x).cast("array<double>")).alias("v"),
        *_group_columns(df, ys),
    )
    stats = Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")

    def unpacked(frame: DataFrame, *keep: Column) -> DataFrame:
        n = F.col("s.count").cast("double")
        # The summarizer divides by n - 1.
        spread = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda t, v: t + v)
        return frame.select(
            *keep,
            F.col("s.count").alias("n"),
            vector_to_array("s.mean").alias("mean"),
            (spread * (n - 1.0) / n).alias("var"),
        )

    overall = unpacked(data.agg(stats)).select(F.struct("mean", "var").alias("g")).scalar()
    every = [f"__y{i}" for i in range(len(ys))]
    groups = data.groupingSets(_group_sets(ys), *every).agg(F.grouping_id().alias("gid"), stats)
    return (
        unpacked(groups, _y_name(ys).alias("y"))
        .withColumn("g", overall)
        .select(
            "y",
            F.lit(x).alias("x"),
            "n",
            "var",
            distance(F.col("mean"), F.col("g.mean"), vectors=True).alias("dist"),
            F.col("g.var").alias("total_var"),
        )
    )


def _trigram_dimension(text: str, at: str, dimensions: int) -> Column:
    """The dimension of the trigram starting at a position, from its three code points."""
    codes = [F.ascii(F.substring(F.col(text), F.col(at) + i, F.lit(1))) for i in range(3)]
    return F.pmod(codes[0] * 961 + codes[1] * 31 + codes[2], F.lit(dimensions))


def trigram_vectors(
    df: DataFrame, column: str, dimensions: int = TRIGRAM_DIMENSIONS
) -> DataFrame:
    """(label_id, vector) per distinct non-null label: unit vector of its trigram counts, sparse.

    The label is padded by two blanks at both ends. A vector is an array of (dim, w) with at most
    `dimensions` entries, plus the entry (-1, 1.0) that later sums up to the number of rows.
    """
    labels = df.where(F.col(column).isNotNull()).select(
        _label_id(column), F.concat(F.lit("  "), F.col(column), F.lit("  ")).alias("text")
    ).distinct()
    # Long labels are cut, with two characters of overlap: substring() walks from the start.
    starts = F.sequence(F.lit(1), F.length("text") - 2, F.lit(CHUNK))
    chunks = labels.select(
        "label_id",
        F.explode(F.transform(starts, lambda at: F.substring("text", at, F.lit(CHUNK + 2)))).alias("chunk"),
    )
    places = F.explode(F.sequence(F.lit(1), F.length("chunk") - 2)).alias("at")
    counted = (
        chunks.select("label_id", "chunk", places)
        .select("label_id", _trigram_dimension("chunk", "at", dimensions).alias("dim"))
        .groupBy("label_id", "dim")
        .agg(F.count(F.lit(1)).cast("double").alias("c"))
    )
    lists = counted.groupBy("label_id").agg(
        F.collect_list(F.struct("dim", "c")).alias("l"), F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm")
    )
    entries = F.transform(
        "l", lambda e: F.struct(e["dim"].alias("dim"), (e["c"] / F.col("norm")).alias("w"))
    )
    marker = F.array(F.struct(F.lit(-1).alias("dim"), F.lit(1.0).alias("w")))
    return lists.select("label_id", F.concat(marker, entries).alias("vector"))


def _label_id(column: str) -> Column:
    return F.unhex(F.sha2(F.col(column), 256)).alias("label_id")


def _no_noise(square: Column) -> Column:
    """Squared lengths of unit vectors: what is below 1e-12 is rounding."""
    return F.when(square < 1e-12, 0.0).otherwise(square)


def _text_groups(df: DataFrame, x: str, ys: Sequence[str], dimensions: int) -> DataFrame:
    """Unit trigram vectors kept sparse: var_g = 1 - |mu_g|^2, distances from dot products.

    Rows are reduced to (group, label, count) first, so the work follows distinct combinations.
    """
    every = [f"__y{i}" for i in range(len(ys))]
    vectors = trigram_vectors(df, x, dimensions)
    data = df.where(F.col(x).isNotNull()).select(
        _label_id(x), *_group_columns(df, ys)
    )
    labels = data.groupBy("label_id").agg(F.count(F.lit(1)).alias("n"))
    sums = (
        labels.join(vectors, "label_id")
        .select("n", F.explode("vector").alias("e"))
        .groupBy(F.col("e.dim").alias("dim"))
        .agg(F.sum(F.col("n") * F.col("e.w")).alias("s"))
    )
    # At most `dimensions` + 1 rows, whatever the table holds.
    total = F.col("total")
    means = sums.withColumn("total", sums.where("dim = -1").agg(F.max("s")).scalar()).select(
        "dim", (F.col("s") / total).alias("mu")
    )
    overall = means.where("dim >= 0").agg(F.sum(F.col("mu") * F.col("mu"))).scalar()

    counted = data.groupingSets([[F.col("label_id"), *s] for s in _group_sets(ys)], "label_id", *every).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n")
    )
    entries = (
        spread_join(counted, vectors, ["label_id"])
        .select("gid", *every, "n", F.explode("vector").alias("e"))
        .groupBy("gid", *every, F.col("e.dim").alias("dim"))
        .agg(F.sum(F.col("n") * F.col("e.w")).alias("s"))
        .join(F.broadcast(means), "dim")
    )
    real = F.col("dim") >= 0
    groups = entries.groupBy("gid", *every).agg(
        F.sum(F.when(~real, F.col("s"))).alias("n"),
        F.sum(F.when(real, F.col("s") * F.col("s"))).alias("square"),
        F.sum(F.when(real, F.col("s") * F.col("mu"))).alias("dot"),
    )
    mean_square = F.col("square") / (F.col("n") * F.col("n"))
    return groups.withColumn("g", overall).select(
        _y_name(ys).alias("y"),
        F.lit(x).alias("x"),
        F.col("n").cast("bigint").alias("n"),
        _no_noise(1.0 - mean_square).alias("var"),
        F.sqrt(_no_noise(mean_square - 2.0 * F.col("dot") / F.col("n") + F.col("g"))).alias("dist"),
        _no_noise(1.0 - F.col("g")).alias("total_var"),
    )


def _edit_groups(df: DataFrame, x: str, ys: Sequence[str], max_labels: int) -> DataFrame:
    """Variances and mean distances from squared edit distances alone (Anderson 2001).

    var_g = sum w_i w_j d_ij^2 / 2 n^2;  |mu_g - mu|^2 = mean d^2(g, all) - var_g - var. Edit
    distance is not Euclidean, so negative squares are set to 0.
    """
    labels = df.where(F.col(x).isNotNull()).select(F.col(x).alias("label"))
    found = labels.distinct().limit(max_labels + 1).count()
    if found > max_labels:
        raise ValueError(f"{x!r} has more than {max_labels} labels: use text='trigrams'")

    def square(a: Column, b: Column) -> Column:
        longer = F.greatest(F.length(a), F.length(b))
        return F.coalesce(
            F.pow(F.try_divide(F.levenshtein(a, b).cast("double"), longer.cast("double")), F.lit(2)),
            F.lit(0.0),
        )

    # One row of at most max_labels^2 numbers.
    matrix = (
        labels.groupBy("label").agg(F.count(F.lit(1)).alias("w"))
        .agg(F.sort_array(F.collect_list(F.struct("label", "w"))).alias("l"))
        .select(
            F.col("l.label").alias("labels"),
            F.col("l.w").alias("weights"),
            F.transform("l", lambda a: F.transform("l", lambda b: square(a["label"], b["label"]))).alias("d"),
        )
        .withColumn("n", F.aggregate("weights", F.lit(0).cast("bigint"), lambda t, w: t + w))
        .withColumn(
            "mean",
            F.transform(
                "d",
                lambda row: F.aggregate(
                    F.zip_with(row, "weights", lambda d, w: d * w), F.lit(0.0), lambda t, v: t + v
                ) / F.col("n"),
            ),
        )
        .withColumn(
            "var",
            F.aggregate(
                F.zip_with("mean", "weights", lambda m, w: m * w), F.lit(0.0), lambda t, v: t + v
            ) / (2.0 * F.col("n")),
        )
    )
    every = [f"__y{i}" for i in range(len(ys))]
    data = df.where(F.col(x).isNotNull()).select(
        F.col(x).alias("label"), *_group_columns(df, ys)
    )
    counted = data.groupingSets([[F.col("label"), *s] for s in _group_sets(ys)], "label", *every).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("w")
    )
    # A group holds at most max_labels entries.
    groups = counted.groupBy("gid", *every).agg(
        F.collect_list(F.struct("label", "w")).alias("entries"), F.sum("w").alias("n")
    )
    placed = groups.withColumn("m", matrix.select(F.struct("*")).scalar()).withColumn(
        "entries",
        F.transform(
            "entries",
            lambda e: F.struct(F.array_position("m.labels", e["label"]).cast("int").alias("i"), e["w"].alias("w")),
        ),
    )
    inner = F.aggregate(
        "entries",
        F.lit(0.0),
        lambda total, a: total
        + a["w"]
        * F.aggregate(
            "entries",
            F.lit(0.0),
            lambda part, b: part + b["w"] * F.element_at(F.element_at(F.col("m.d"), a["i"]), b["i"]),
        ),
    )
    outer = F.aggregate(
        "entries", F.lit(0.0), lambda total, e: total + e["w"] * F.element_at(F.col("m.mean"), e["i"])
    )
    n = F.col("n").cast("double")
    return (
        placed.withColumn("var", inner / (2.0 * n * n))
        .withColumn("square", outer / n - F.col("var") - F.col("m.var"))
        .select(
            _y_name(ys).alias("y"),
            F.lit(x).alias("x"),
            "n",
            "var",
            F.sqrt(F.greatest(F.col("square"), F.lit(0.0))).alias("dist"),
            F.col("m.var").alias("total_var"),
        )
    )


def _relative_edits(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 between empty labels."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 0.0).otherwise(F.levenshtein(a, b) / longer)


def pivot_labels(df: DataFrame, column: str, pivots: int = PIVOTS) -> list[str]:
    """Labels that are far from each other: the least one, then always the label farthest from those chosen.

    Ties go to the lesser label. One pass over the distinct labels each; fewer than `pivots` if all others are
    among them. Only the chosen labels reach the driver.
    """
    labels = Checkpoints(df.sparkSession).write(df.select(F.col(column).alias("label")).where("label is not null").distinct())
    first = labels.agg(F.min("label")).first()[0]
    chosen = [] if first is None else [first]
    while chosen and len(chosen) < pivots:
        gaps = [_relative_edits(F.col("label"), F.lit(p)) for p in chosen]
        nearest = gaps[0] if len(gaps) == 1 else F.least(*gaps)
        gap, label = labels.agg(F.min(F.struct((-nearest).alias("gap"), "label"))).first()[0]
        if gap == 0:
            break
        chosen.append(label)
    return chosen


def pivot_vector(column: Column, chosen: Sequence[str]) -> Column:
    """A label's relative edit distances to the pivots, scaled so that two labels' vectors lie no farther apart than
    the largest difference of any of these distances."""
    scale = len(chosen) ** -0.5
    return F.when(column.isNotNull(), F.array(*(_relative_edits(column, F.lit(p)) * scale for p in chosen)))


def encode_labels(df: DataFrame, column: str, embeddings: DataFrame) -> DataFrame:
    """Replace the labels of `column` by their vectors from (label, embedding); null without one."""
    table = embeddings.select(F.col("label").alias("__label"), F.col("embedding").alias("__vector"))
    joined = df.join(table, F.col(column) == F.col("__label"), "left")
    return joined.select(*(F.col("__vector").alias(c) if c == column else F.col(c) for c in df.columns))


def analyze(
    df: DataFrame,
    min_completeness: float | None = MIN_COMPLETENESS,
    encoder: Callable[[DataFrame], DataFrame] | None = None,
    text: Literal["trigrams", "edit", "pivots"] = "trigrams",
    dimensions: int = TRIGRAM_DIMENSIONS,
    max_labels: int = 200,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(x, y, M1, M2, M3) for every ordered pair of representative columns.

    `encoder` may replace text columns by vectors beforehand. Remaining text is compared by
    trigrams, by edit distances to some pivots, or by all edit distances for columns of few labels. A null y is a
    group of its own; groups without a value of x are skipped; the weight of a group is N_g over all rows.
    `min_completeness=None` takes all columns as they are.
    """
    if text not in ("trigrams", "edit", "pivots"):
        raise ValueError(f"text must be trigrams, edit or pivots, not {text!r}")
    if min_completeness is not None:
        df = representative_columns(df, min_completeness)
    if encoder is not None:
        df = encoder(df)
    names = df.columns
    numbers = [c for c in names if numeric_view(c, df.schema[c].dataType) is not None]
    vectors = [c for c in names if isinstance(df.schema[c].dataType, T.ArrayType)]
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    batches = [names[i : i + MAX_GROUPING_COLUMNS] for i in range(0, len(names), MAX_GROUPING_COLUMNS)]
    placed = {}
    if text == "pivots":
        for x in texts:
            if chosen := pivot_labels(df, x, pivots):
                placed[x] = df.withColumn(x, pivot_vector(F.col(x), chosen))

    parts = []
    for ys in batches:
        if numbers:
            parts.append(_numeric_groups(df, numbers, ys))
        for x in vectors:
            if others := [y for y in ys if y != x]:
                parts.append(_vector_groups(df, x, others))
        for x in texts:
            others = [y for y in ys if y != x]
            if others and text == "pivots":
                if x in placed:
                    parts.append(_vector_groups(placed[x], x, others))
            elif others:
                parts.append(
                    _text_groups(df, x, others, dimensions)
                    if text == "trigrams"
                    else _edit_groups(df, x, others, max_labels)
                )
    if len(names) < 2 or not parts:
        return df.sparkSession.createDataFrame([], "x string, y string, M1 double, M2 double, M3 double")

    rows = df.agg(F.count(F.lit(1))).scalar()
    pairs = (
        union_all(parts)
        .where((F.col("n") > 0) & (F.col("x") != F.col("y")))
        .groupBy("x", "y")
        .agg(
            F.sum(F.col("n") * F.col("var")).alias("weighted"),
            F.max("var").alias("worst"),
            F.max(F.sqrt("n") * F.col("dist")).alias("farthest"),
            F.max("total_var").alias("total_var"),
        )
        .withColumn("within", F.col("weighted") / rows)
    )
    return pairs.select(
        "x",
        "y",
        ((F.col("total_var") - F.col("within")) / (F.col("total_var") + EPSILON)).alias("M1"),
        (F.col("worst") / (F.col("within") + EPSILON)).alias("M2"),
        (F.col("farthest") / (F.sqrt("total_var") + EPSILON)).alias("M3"),
    )


def candidate_rules(analysis: DataFrame, source: str, timestamp, detected: float = DETECTED) -> DataFrame:
    """The pairs with M1 above `detected`, tagged by source and run."""
    if not isinstance(timestamp, Column):
        timestamp = run_timestamp(timestamp)
    return analysis.where(F.col("M1") > detected).select(
        "x", "y", "M1", "M2", "M3", timestamp.alias("timestamp"), F.lit(source).alias("source")
    )


def coherence_score(rules: DataFrame) -> DataFrame:
    """(source, timestamp, detected_rules, coherence_score): share of candidate rules respected."""
    respected = (F.col("M2") <= MAX_M2) & (F.col("M3") <= MAX_M3)
    return (
        rules.where(F.col("M1") > DETECTED)
        .groupBy("source", "timestamp")
        .agg(
            F.count(F.lit(1)).alias("detected_rules"),
            F.avg(F.when(respected, 1.0).otherwise(0.0)).alias("coherence_score"),
        )
    )


def incoherent_columns(rules: DataFrame) -> DataFrame:
    """Columns x that break a candidate rule: (source, timestamp, column_name, broken_rules)."""
    respected = (F.col("M2") <= MAX_M2) & (F.col("M3") <= MAX_M3)
    return (
        rules.where((F.col("M1") > DETECTED) & ~respected)
        .groupBy("source", "timestamp", F.col("x").alias("column_name"))
        .agg(F.count(F.lit(1)).alias("broken_rules"))
    )
