"""Near-duplicate vectors by an inverted multi-index (Babenko and Lempitsky, CVPR 2012).

The two halves of a vector have a codebook each; pairs of codes are the cells of a product grid. Every distinct
vector enters the cells nearest to it, in the order of the multi-sequence traversal (sum of the two halves'
distances), and vectors that share a cell are compared exactly. How many cells a vector enters follows from a target recall,
measured on sampled vectors and partners at exactly the least cosine that counts, the hardest links there are.
The grid grows with the number of vectors, so cells keep their size.

Equal vectors are one row with a count from the start. A cell with more than `BLOCK` vectors is cut into blocks
by hash, and each pair of blocks is a group of its own, so no group grows with the data. Groups give counts and
the ties of a spanning forest, never pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches
from plumbline.operators.components import connected_components
from plumbline.operators.skew import spread_join
from plumbline.session import Checkpoints

MIN_COSINE = 0.9
RECALL = 0.95  # of links at exactly the least cosine; nearer ones are found more surely
SAMPLE = 20_000  # distinct vectors that the codebooks and the number of cells are learnt from
CELL = 64  # distinct vectors per cell that the size of the grid aims at
BLOCK = 1_024  # vectors of one cell that are compared as one side


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances from rows to centers."""
    return (x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)[None, :]


def _codebook(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    centers = x[rng.choice(len(x), size, replace=False)]
    for _ in range(12):
        own = _nearest(x, centers).argmin(1)
        count = np.bincount(own, minlength=size)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centers)
    return centers


@dataclass
class MultiIndex:
    """Codebooks of both halves, and how many cells a vector enters."""

    first: np.ndarray
    second: np.ndarray
    cells: int

    def nearest_cells(self, x: np.ndarray, cells: int | None = None) -> np.ndarray:
        """The `cells` nearest cells of each row of unit vectors, nearest first.

        The traversal can only reach the pair of the i-th and j-th nearest codes (from 0) after the (i+1)(j+1) - 1
        pairs that dominate it; so the front never leaves the pairs with (i+1)(j+1) <= cells.
        """
        cells = cells or self.cells
        half = len(self.first[0])
        a, b = _nearest(x[:, :half], self.first), _nearest(x[:, half:], self.second)
        front = [
            (i, j)
            for i in range(min(cells, len(self.first)))
            for j in range(min(cells // (i + 1), len(self.second)))
        ]
        i, j = np.array(front).T
        near_a, near_b = a.argsort(1, kind="stable"), b.argsort(1, kind="stable")
        line = np.arange(len(x))[:, None]
        sums = a[line, near_a[:, i]] + b[line, near_b[:, j]]
        order = sums.argsort(1, kind="stable")[:, :cells]
        return near_a[line, i[order]] * len(self.second) + near_b[line, j[order]]


def fit_index(sample: np.ndarray, rows: int, recall: float = RECALL, min_cosine: float = MIN_COSINE) -> MultiIndex:
    """Codebooks from unit vectors, for `rows` of them; cells are added until the recall is reached."""
    rng = np.random.default_rng(3)
    half = sample.shape[1] // 2
    # A code needs a few sampled vectors; beyond that many rows the cells grow, and are cut into blocks.
    size = max(1, min(int(np.sqrt(rows / CELL)), len(sample) // 8))
    index = MultiIndex(_codebook(sample[:, :half], size, rng), _codebook(sample[:, half:], size, rng), 1)
    x = sample[rng.choice(len(sample), min(2_000, len(sample)), replace=False)]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True).clip(1e-300)
    partner = min_cosine * x + np.sqrt(1 - min_cosine**2) * aside
    while index.cells < size * size:
        mine, theirs = index.nearest_cells(x), index.nearest_cells(partner)
        if (mine[:, :, None] == theirs[:, None, :]).any(axis=(1, 2)).mean() >= recall:
            break
        index.cells += 1
    return index


def _unit(vectors: list, size: int) -> np.ndarray:
    x = np.array(vectors, np.float64).reshape(-1, size)
    scale = np.abs(x).max(1, initial=0, keepdims=True)  # first to at most 1: squares neither overflow nor vanish
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def compare(left: pd.DataFrame, right: pd.DataFrame | None, cell: int, min_cosine: float) -> pd.DataFrame:
    """(gid, n_links, root) of the vectors of a block, or of two different blocks, of one cell.

    A pair counts in the smallest cell that it shares only; `root` ties a vector to the least of those
    that it reaches here.
    """
    rows = left if right is None else pd.concat([left, right], ignore_index=True)
    x = _unit(rows["embedding"].tolist(), len(rows["embedding"].iloc[0]))
    if right is None:
        a, b = np.nonzero(np.triu(x @ x.T >= min_cosine, 1))
    else:
        a, b = np.nonzero(x[: len(left)] @ x[len(left) :].T >= min_cosine)
        b += len(left)
    names, copies = rows["gid"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
    links = np.zeros(len(rows), np.int64)
    cells = np.array(rows["cells"].tolist(), np.int64)
    for at in range(0, len(a), 65_536):
        i, j = a[at : at + 65_536], b[at : at + 65_536]
        shared = np.where((cells[i][:, :, None] == cells[j][:, None, :]).any(2), cells[i], np.iinfo(np.int64).max)
        here = shared.min(1) == cell
        np.add.at(links, i[here], copies[j[here]])
        np.add.at(links, j[here], copies[i[here]])
    root = names.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        if (new == root).all():
            break
        root = new
    out = pd.DataFrame({"gid": names, "n_links": links, "root": root})
    return out[np.isin(np.arange(len(rows)), np.concatenate([a, b]))]


def link_vectors(
    vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors` (vec_id, embedding).

    Two vectors of one length link if their cosine in double precision is at least `min_cosine`. Vectors that are null,
    empty or zero, or hold null or non-finite components link with nothing, and neither do rows without a vec_id (their
    component is null and they aren't kept). Repeated rows count as vectors of their own; rows of one vec_id with
    different vectors are different vectors.
    """
    kept = Checkpoints(vectors.sparkSession)
    entry = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull()
        & F.exists(entry, lambda v: v != 0)
        & F.forall(entry, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.when(sound, F.size(entry)).alias("length"),
    )
    usable = F.col("length").isNotNull()
    lengths = rows.where(usable).groupBy("length").count()
    # An index for each length that has more vectors than are compared at once anyway.
    indexes = {}
    for length, count in lengths.where(F.col("count") > BLOCK).orderBy("length").collect():
        own = rows.where(F.col("length") == length).select("embedding")
        drawn = own.orderBy(F.xxhash64("embedding"), "embedding").limit(sample).collect()
        known = np.unique(np.array([r[0] for r in drawn], np.float64), axis=0)
        indexes[length] = fit_index(_unit(known, length), count, recall, min_cosine)
    digests = [F.xxhash64(F.lit(i), "embedding").alias(f"digest_{i}") for i in (0, 1)]
    distinct = rows.where(usable).groupBy("length", "embedding").agg(
        F.min("vec_id").alias("name"), F.count(F.lit(1)).alias("copies")
    )

    def start():
        def work(own, names, copies, embeddings, *digest):
            cells = [[0]] * len(own)
            of = np.array(own, np.int64)
            for length in set(own) & set(indexes):
                at = np.flatnonzero(of == length).tolist()
                found = indexes[length].nearest_cells(_unit([embeddings[i] for i in at], length)).tolist()
                for i, c in zip(at, found):
                    cells[i] = c
            return [own, names, copies, embeddings, *digest, cells]

        return work

    # Vectors are single precision where they came so; the comparison is in double either way.
    number = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    placed = kept.write(
        map_batches(
            distinct.select("length", "name", "copies", F.col("embedding").cast(f"array<{number}>"), *digests),
            f"length int, name bigint, copies bigint, embedding array<{number}>, digest_0 bigint, digest_1 bigint, "
            "cells array<int>",
            [
                ("length", pa.int32()), ("name", pa.int64()), ("copies", pa.int64()),
                ("embedding", pa.list_(pa.float32() if number == "float" else pa.float64())),
                ("digest_0", pa.int64()), ("digest_1", pa.int64()), ("cells", pa.list_(pa.int32())),
            ],
            start,
        ).withColumn("gid", F.monotonically_increasing_id())  # names each distinct vector, in a table from here on
    )
    crowded = (
        placed.select("length", F.explode("cells").alias("cell")).groupBy("length", "cell")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
        .select("length", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    entered = spread_join(
        placed.select("length", "gid", "copies", "embedding", "cells", F.explode("cells").alias("cell")),
        crowded, ["length", "cell"], "left",
    )
    own = F.pmod(F.xxhash64("gid"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = entered.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    )
    sides = dealt.select(
        "length", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "gid", "copies", "embedding", "cells",
    )

    def meet(key, group: pd.DataFrame) -> pd.DataFrame:
        _, cell, low, high = key
        # In a fixed order: the result must not depend on how rows came in.
        group = group.sort_values("gid", kind="stable")
        if low == high:
            return compare(group.reset_index(drop=True), None, cell, min_cosine)
        left, right = (group[group["own"] == v].reset_index(drop=True) for v in (low, high))
        if not (len(left) and len(right)):
            return pd.DataFrame({"gid": [], "n_links": [], "root": []}, dtype="int64")
        return compare(left, right, cell, min_cosine)

    met = kept.write(
        sides.groupBy("length", "cell", "low", "high").applyInPandas(meet, "gid bigint, n_links bigint, root bigint")
    )
    links = met.groupBy("gid").agg(F.sum("n_links").alias("n_links"))
    components = connected_components(met, "gid", "root").withColumnRenamed("node", "gid")
    judged = kept.write(
        placed.select("gid", "name", "copies", "digest_0", "digest_1")
        .join(links, "gid", "left")
        .join(components, "gid", "left")
        .select(
            "digest_0", "digest_1", "name", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "gid").alias("component"),
        )
    )
    least = judged.groupBy("component").agg(F.min("name").alias("component_id"))
    judged = judged.join(least, "component").select("digest_0", "digest_1", "n_links", "component_id")
    own_rows = rows.select("vec_id", *(F.when(usable, d).alias(f"digest_{i}") for i, d in enumerate(digests)))
    out = spread_join(own_rows, judged, ["digest_0", "digest_1"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
