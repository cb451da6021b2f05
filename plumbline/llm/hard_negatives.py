"""Hard negatives by exact integer scores, many candidates per multiplication.

Candidates lie in blocks. The j-th components of all rows of a block, biased to be non-negative, are fields of one wide
integer; an anchor multiplies each of these by one component of its own and adds them up, and the fields of the sum
are the biased scores of the whole block. Fields are wide enough for the largest possible sum, so nothing carries over
and unpacked scores are exact.

The anchors are a stated set of queries that is compared with all rows, in blocks: they come by broadcast, about
BROADCAST bytes a pass, and the candidates are read once a pass and not shuffled. A task keeps a few best rows per
anchor of the pass, whatever the number of blocks it reads. The first round finds the positives, the second the
negatives between the limits that follow from them.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import Checkpoints

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
BLOCK = 32_768  # rows of a block
GROUP = 1_024  # anchors that are compared with a block at a time
BROADCAST = 32 << 20
_AT_ONCE = 1 << 21  # scores held at a time
_PENDING = 1 << 18  # found rows of a task before only the best are kept
_LARGEST = float(2**62)  # components beyond it saturate
_LONG = np.iinfo(np.int64)
_ROW_BITS, _LENGTH_BITS = 24, 16  # of a key: the row within its block, the block within its partition

_BLOCKS = pa.schema([
    ("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("parts", pa.binary()),
    ("width", pa.int32()), ("anchors", pa.binary()),
])
_FOUND = pa.schema([(n, pa.int64()) for n in ("key", "limit", "score", "vec_id", "row")])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def field_width(dim: int, low: int, high: int) -> int:
    """Bytes that hold a sum of `dim` products of two entries between `low` and `high`, each less `low`."""
    bits = (dim * (high - low) ** 2).bit_length()
    return 4 if bits <= 32 else 8 if bits <= 63 else -(-bits // 8)


def pack_columns(rows: np.ndarray, low: int, width: int) -> list[int]:
    """One integer per column of the matrix: its field k, of `width` bytes, holds row k's entry less `low`."""
    if width > 8:
        return [
            int.from_bytes(b"".join((v - low).to_bytes(width, "little") for v in column), "little")
            for column in rows.T.tolist()
        ]
    return [int.from_bytes(f.tobytes(), "little") for f in (rows - low).T.astype(f"<u{width}", order="C")]


def unpack(total: int, n: int, width: int) -> np.ndarray:
    data = total.to_bytes(n * width, "little")
    if width <= 8:
        return np.frombuffer(data, f"<u{width}").astype(np.int64)
    return np.array([int.from_bytes(data[i : i + width], "little") for i in range(0, len(data), width)], object)


def scores(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor, inner products of some anchors with all rows); exact, saturated where 64 bits do not do."""
    n, dim = rows.shape
    step = max(1, _AT_ONCE // max(n, 1))
    if not n or not dim:
        for at in range(0, len(anchors), step):
            yield at, np.zeros((len(anchors[at : at + step]), n), np.int64)
        return
    low, high = int(min(rows.min(), anchors.min())), int(max(rows.max(), anchors.max()))
    width = field_width(dim, low, high)
    packed = pack_columns(rows, low, width)
    sums = rows.astype(np.int64 if width <= 8 else object).sum(axis=1)
    for at in range(0, len(anchors), step):
        found = []
        for anchor in anchors[at : at + step].tolist():
            fields = unpack(sum(map(operator.mul, [v - low for v in anchor], packed)), n, width)
            # The sum of (a - low)(c - low) is the score less low (sum of a + sum of c), plus dim low^2.
            score = fields + low * sums + (low * sum(anchor) - dim * low * low)
            found.append(np.clip(score, _LONG.min, _LONG.max).astype(np.int64))
        yield at, np.stack(found)


def _first(key: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first `most` of their run of equal keys."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key)))) < most


def highest(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the `most` highest allowed scores of each row, ties by smaller id."""
    if score.shape[1] > 4 * most:  # what lies below the `most`-th highest is out before anything is sorted
        floor = np.partition(np.where(allowed, score, _LONG.min), -most, axis=1)[:, -most]
        allowed = allowed & (score >= floor[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, ids[column], ~score[row, column], row))
    row, column = row[order], column[order]
    best = _first(row, most)
    return row[best], column[best]


def highest_within(
    score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, limits: list[list[tuple[int, int]]], most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, limit, column): for each (low, high) of a row, its `most` highest allowed scores from low to high."""
    flat = [(r, k, low, high) for r, own in enumerate(limits) for k, (low, high) in enumerate(own) if low <= high]
    if not flat:
        return (np.zeros(0, np.int64),) * 3
    rows, places, lows, highs = (np.array(c, np.int64) for c in zip(*flat))
    least, most_high = np.full(len(score), _LONG.max), np.full(len(score), _LONG.min)
    np.minimum.at(least, rows, lows)
    np.maximum.at(most_high, rows, highs)
    row, column = np.nonzero(allowed & (score >= least[:, None]) & (score <= most_high[:, None]))
    if not len(row):
        return (np.zeros(0, np.int64),) * 3
    value = score[row, column]
    known, rank = np.unique(value, return_inverse=True)
    key = row * (len(known) + 1) + len(known) - rank  # per row, the highest score first
    order = np.lexsort((column, ids[column], key))
    row, column, key, value = row[order], column[order], key[order], value[order]
    above = len(known) + 1 - np.searchsorted(known, highs, "right")
    picked = np.searchsorted(key, rows * (len(known) + 1) + above)[:, None] + np.arange(most)
    inside, picked = picked < len(row), np.minimum(picked, len(row) - 1)
    inside &= (row[picked] == rows[:, None]) & (value[picked] >= lows[:, None])
    at = np.nonzero(inside)[0]
    return rows[at], places[at], column[picked[inside]]


def prepared(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """(vec_id, label, parts, is_anchor) of the rows that take part; parts are floor(SCALE x), x as double."""
    entry = F.col("embedding").cast("array<double>")
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall(entry, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )

    def part(v: Column) -> Column:
        return F.floor(F.least(F.greatest(F.lit(float(SCALE)) * v, F.lit(-_LARGEST)), F.lit(_LARGEST))).cast("bigint")

    return vectors.where(sound).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(entry, part).alias("parts"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )


def _numbers(data: bytes, width: int = 8) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").astype(np.int64)


def blocks_of(rows: DataFrame, kept: Checkpoints) -> DataFrame:
    """Blocks of rows of one length, sorted by id, as a table: one per partition and length."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _LENGTH_BITS
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        lists = table["parts"].combine_chunks()
        lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
        begins = np.append(0, np.cumsum(lengths))
        ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        flags = table["is_anchor"].to_numpy()
        for place, dim in enumerate(np.unique(lengths).tolist()):
            own = np.flatnonzero(lengths == dim)
            own = own[np.argsort(ids[own], kind="stable")]
            parts = flat[begins[own][:, None] + np.arange(dim)]
            width = 8 if dim and max(-int(parts.min()), int(parts.max())) > 32_767 else 2
            values = [
                number + place, dim, ids[own].tobytes(), labels[own].tobytes(), parts.astype(f"<i{width}").tobytes(),
                width, np.flatnonzero(flags[own]).astype(np.int64).tobytes(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCKS)], schema=_BLOCKS)

    # Round robin: no key decides where a row goes. From here on the blocks are read from their table.
    return kept.write(rows.repartition(tasks).mapInArrow(run, _ddl(_BLOCKS)))


def anchors_of(blocks: DataFrame) -> DataFrame:
    """(key, anchor_id, label, dim, parts, width) of every anchor; the key names its block and row."""
    out = pa.schema([
        ("key", pa.int64()), ("anchor_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()),
        ("parts", pa.binary()), ("width", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                own, size = _numbers(row["anchors"]), row["dim"] * row["width"]
                yield pa.RecordBatch.from_arrays([
                    pa.array((row["block"] << _ROW_BITS) + own), pa.array(_numbers(row["ids"])[own]),
                    pa.array(_numbers(row["labels"])[own]), pa.array([row["dim"]] * len(own), pa.int32()),
                    pa.array([row["parts"][i * size : (i + 1) * size] for i in own.tolist()], pa.binary()),
                    pa.array([row["width"]] * len(own), pa.int32()),
                ], schema=out)

    return blocks.mapInArrow(run, _ddl(out))


class _Best:
    """The best rows per key and limit that a task has seen: no more than the anchors of a pass ask for."""

    def __init__(self, most: int) -> None:
        self.most, self.pending, self.held, self.new = most, [], 0, 0

    def add(self, *columns: np.ndarray) -> None:
        self.pending.append(columns)
        self.new += len(columns[0])
        if self.new > max(_PENDING, self.held):
            self.pending = [self.reduce()]
            self.held, self.new = len(self.pending[0][0]), 0

    def reduce(self) -> tuple[np.ndarray, ...]:
        if not self.pending:
            return (np.zeros(0, np.int64),) * len(_FOUND)
        key, limit, score, vec_id, row = (np.concatenate(c) for c in zip(*self.pending))
        order = np.lexsort((row, vec_id, ~score, limit, key))
        best = order[_first(np.stack([key[order], limit[order]], axis=1).view("i8,i8").ravel(), self.most)]
        return key[best], limit[best], score[best], vec_id[best], row[best]


def _meet(
    blocks: DataFrame, anchors: DataFrame, most: int,
    compare: Callable[[dict, list[dict]], Iterator[tuple[np.ndarray, ...]]],
) -> DataFrame:
    """(key, limit, score, vec_id, row, rank): the best `most` of what `compare` finds in all blocks, by key and limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(most)
        for batch in batches:
            for at in range(batch.num_rows):
                pair = batch.slice(at, 1).to_pylist()[0]
                for found in compare(pair["rows"], pair["wanted"]):
                    best.add(*found)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.reduce()], schema=_FOUND)

    size = anchors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("parts") + 200), F.lit(0))).first()
    groups, passes = max(1, -(-size[0] // GROUP)), max(1, -(-size[1] // BROADCAST))
    held = anchors.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    rows = blocks.select("dim", F.struct(*[n for n in blocks.columns if n != "anchors"]).alias("rows"))
    found = None
    for turn in range(passes):
        own = held.where(F.col("group") % passes == turn)
        wanted = own.groupBy("dim", "group").agg(
            F.collect_list(F.struct(*[n for n in anchors.columns if n != "dim"])).alias("wanted")
        )
        # Every block meets all groups of its length that this pass holds.
        part = rows.join(F.broadcast(wanted), "dim").select("rows", "wanted").mapInArrow(run, _ddl(_FOUND))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("key", "limit").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _matrices(block: dict, wanted: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = _numbers(block["ids"])
    rows = _numbers(block["parts"], block["width"]).reshape(len(ids), block["dim"])
    anchors = np.stack([_numbers(w["parts"], w["width"]) for w in wanted])
    keys = (block["block"] << _ROW_BITS) + np.arange(len(ids))
    return ids, keys, rows, anchors


def _same_label(most: int):
    """The highest scores of other rows with the anchor's label."""

    def compare(block: dict, wanted: list[dict]) -> Iterator[tuple[np.ndarray, ...]]:
        ids, keys, rows, anchors = _matrices(block, wanted)
        labels, own = _numbers(block["labels"]), np.array([w["label"] for w in wanted])
        names = np.array([w["key"] for w in wanted])
        for label in np.intersect1d(own, labels).tolist():
            at, who = np.flatnonzero(labels == label), np.flatnonzero(own == label)
            for first, score in scores(anchors[who], rows[at]):
                name = names[who[first : first + len(score)]]
                row, column = highest(score, keys[at] != name[:, None], ids[at], most)
                yield name[row], np.zeros(len(row), np.int64), score[row, column], ids[at[column]], keys[at[column]]

    return compare


def limits(score: int) -> tuple[int, int]:
    """The least and the greatest integer n with LOW score <= 100 n <= HIGH score."""
    return -(-LOW * score // 100), HIGH * score // 100


def _between(most: int):
    """For each positive, the highest scores of rows with another label that lie within its limits."""

    def compare(block: dict, wanted: list[dict]) -> Iterator[tuple[np.ndarray, ...]]:
        ids, keys, rows, anchors = _matrices(block, wanted)
        labels, own = _numbers(block["labels"]), np.array([w["label"] for w in wanted])
        names = np.array([w["key"] for w in wanted])
        bounds = [[limits(s) for s in w["positives"]] for w in wanted]
        for first, score in scores(anchors, rows):
            part = slice(first, first + len(score))
            row, limit, column = highest_within(score, labels != own[part][:, None], ids, bounds[part], most)
            yield names[part][row], limit, score[row, column], ids[column], keys[column]

    return compare


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for `vectors` (vec_id, label, embedding).

    An anchor's positives are the `positives` other rows of its label with the highest scores; for each, the
    `negatives` rows of another label with the highest scores between LOW and HIGH per cent of the positive's. Scores
    are inner products of floor(SCALE x); ties go to the smaller id. Rows with a null id or label, a null vector or a null
    or non-finite component take no part. Only vectors of one length are compared; vectors without components
    have score 0. A repeated row is a row of its own, as anchor, positive and negative. Components beyond 2^62 and
    scores beyond 64 bits saturate. Other columns are not read; an empty table gives no rows.
    """
    kept = Checkpoints(vectors.sparkSession)
    blocks = blocks_of(prepared(vectors, is_anchor), kept)
    anchors = kept.write(anchors_of(blocks))
    near = kept.write(_meet(blocks, anchors, positives, _same_label(positives)))
    owned = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    asked = kept.write(anchors.join(owned, "key").withColumn("positives", F.col("found.score")))
    hard = _meet(blocks, asked.drop("found", "anchor_id"), negatives, _between(negatives))
    pairs = asked.select("key", "anchor_id", F.posexplode("found").alias("limit", "positive"))
    return hard.select("key", "limit", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        pairs.withColumn("limit", F.col("limit").cast("bigint")), ["key", "limit"]
    ).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        "negative_id", F.col("positive.score").alias("positive_score"), "negative_score",
    )
