"""What several operators share: words, Arrow batches, and bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = bytes(
    c if c in b"0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)
SPACES = "[^\\x09-\\x0D\\x20]+"  # a word as runs of anything but ASCII white space
SLICE = 4 << 20  # bytes of a batch that are Python objects at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_words(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the column as text modulo `modulus`; a null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def slices(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `most` bytes, or single rows: batches are cut by rows, texts differ in length."""
    if batch.num_rows < 2 or batch.nbytes <= most:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


def map_batches(
    df: DataFrame, schema: str, fields: list[tuple[str, pa.DataType]],
    start: Callable[[], Callable[..., list]],
) -> DataFrame:
    """Map slices of the Arrow batches of `df`: `start()` once a task gives a function of the columns as lists.

    It returns one list per output field. Nothing is kept from one slice to the next but what that
    function keeps itself, and memory that Arrow holds free goes back with every batch.
    """
    out = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch):
                columns = work(*(c.to_pylist() for c in part.columns))
                arrays = [pa.array(c, f.type) for c, f in zip(columns, out)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, column: str, start: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of `df`, all columns as they are, for which the function of `column`'s values says so."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = start()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)


def labelled(labels: DataFrame, label: str, modulus: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, y) of at most `most` labelled documents outside the held-out remainder, per label value.

    The bound is a parameter of the fit alone. Documents are taken in the order of a hash, so the
    sample is the same in every run. Labels other than 0 and 1 don't count, and documents
    with two different labels are left out.
    """
    own = (
        labels.where(F.col(label).isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("other"))
        .where("y = other and doc_id is not null")
        .select("doc_id", "y", F.xxhash64("doc_id").alias("place"))
    )
    parts = [own.where(F.col("y") == y).orderBy("place", "doc_id").limit(most) for y in (0, 1)]
    return parts[0].unionByName(parts[1]).select("doc_id", "y")


def shares(labels: DataFrame, label: str, modulus: int, held_out: int) -> dict[int, int]:
    """Rows of each label value outside the held-out remainder."""
    rows = (
        labels.where(F.col(label).isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held_out))
        .groupBy(label).count().collect()
    )
    return {0: 0, 1: 0} | {r[0]: r["count"] for r in rows}
