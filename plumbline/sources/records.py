"""Records of delimited text that may go on over line breaks inside quotes, cut in many tasks.

Where a line of a file ends, a quoted field is open or not; which of the two, given how the line began, is a function
on two states. Every block of a file (a split of the scan) reports the composition of its lines' functions; composing
these over the blocks of a file tells how each block begins. With that, a block cuts its own records. Only the
pieces of records that cross a border between blocks are brought together; no other line is moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, TAIL, MIDDLE, HEAD = "record", "tail", "middle", "head"


def ends_inside(line: str, inside: bool, separator: str, quote: str) -> bool:
    """Is a quoted field open at the end of the line? A quote opens one only where a field begins."""
    if quote not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):  # a doubled quote stands for itself
                at += 2
                continue
            inside, at = False, at + 1
        if at == 0 and line.startswith(quote):
            inside, at = True, 1
            continue
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)
        if line.startswith(quote, at):
            inside, at = True, at + 1
        elif at >= n:
            return False


def _in_order(batches: Iterator[pa.RecordBatch], skip_lines: int) -> Iterator[tuple[str, int, str]]:
    """Lines with file and block, without those skipped; they come in the order of the block."""
    current, skipped = None, 0
    for batch in batches:
        for value, file, start in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != current:
                current, skipped = (file, start), 0
            if start == 0 and skipped < skip_lines:
                skipped += 1
                continue
            yield file, start, value


class Records:
    """The records of the files at `path`: `value`, `file`, `start` of their block and `number` within it."""

    def __init__(
        self, spark: SparkSession, path: str, separator: str = ",", quote: str = '"', encoding: str = "utf-8",
        skip_lines: int = 0,
    ) -> None:
        self.separator, self.quote, self.skip_lines = separator, quote, skip_lines
        self.lines = (
            spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        )

    def may_span_lines(self) -> bool:
        """Is there a line with an odd number of quotes, or with one in the middle of a field? If not, records are lines."""
        value, quote = F.col("value"), self.quote
        odd = F.length(F.replace(value, F.lit(quote), F.lit(""))) - F.length(value)
        others = f"[^{_escaped(self.separator)}{_escaped(quote)}]"
        stray = value.rlike(f"{others}{_escaped(quote)}{others}")
        return not self.lines.where((odd % 2 != 0) | stray).isEmpty()

    def _inside(self) -> set[tuple[str, int]]:
        """The blocks that begin within a quoted field."""
        separator, quote, skip_lines = self.separator, self.quote, self.skip_lines

        def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[str, int], list[bool]] = {}
            for file, start, line in _in_order(batches, skip_lines):
                now = found.setdefault((file, start), [False, True])
                if quote in line:
                    now[:] = [ends_inside(line, state, separator, quote) for state in now]
            yield pa.RecordBatch.from_pylist(
                [{"file": f, "start": s, "outside": o, "inside": i} for (f, s), (o, i) in found.items()],
                schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())]),
            )

        def states(blocks: pd.DataFrame) -> pd.DataFrame:
            now, out = False, []
            for row in blocks.sort_values("start").itertuples():
                if now:
                    out.append((row.file, row.start))
                now = row.inside if now else row.outside
            return pd.DataFrame(out, columns=["file", "start"])

        composed = self.lines.mapInArrow(compose, "file string, start bigint, outside boolean, inside boolean")
        begun = composed.groupBy("file").applyInPandas(states, "file string, start bigint")  # blocks of a file: few
        return {(r["file"], r["start"]) for r in begun.collect()}

    def read(self) -> DataFrame:
        separator, quote, skip_lines, begun = self.separator, self.quote, self.skip_lines, self._inside()
        schema = pa.schema([
            ("value", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("kind", pa.string()),
        ])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, inside, held, kind, number, out = None, False, [], RECORD, 0, []

            def close(last: str) -> None:
                nonlocal kind, number
                if held:
                    out.append(("\n".join(held), *current, number, last))
                    held.clear()
                    number += 1
                kind = RECORD

            for file, start, line in _in_order(batches, skip_lines):
                if (file, start) != current:
                    close(MIDDLE if kind == HEAD else TAIL)  # what is still open goes on in the next block
                    current, number = (file, start), 0
                    inside = current in begun
                    kind = HEAD if inside else RECORD
                held.append(line)
                inside = ends_inside(line, inside, separator, quote)
                if not inside:
                    close(kind)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            close(MIDDLE if kind == HEAD else TAIL)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        cuts = self.lines.mapInArrow(cut, "value string, file string, start bigint, number bigint, kind string")
        whole = cuts.where(F.col("kind") == RECORD)
        pieces = cuts.where(F.col("kind") != RECORD)
        before = Window.partitionBy("file").orderBy("start", "number")
        owned = pieces.withColumn("owner", F.count(F.when(F.col("kind") == TAIL, 1)).over(before))
        joined = owned.groupBy("file", "owner").agg(
            F.sort_array(F.collect_list(F.struct("start", "number", "value"))).alias("parts")
        ).select(
            F.concat_ws("\n", "parts.value").alias("value"), "file", F.col("parts")[0]["start"].alias("start"),
            F.col("parts")[0]["number"].alias("number"),
        )
        found = whole.drop("kind").unionByName(joined)
        return found.withColumn("value", F.regexp_replace("value", r"\r\z", "")).where(F.length("value") > 0)


def _escaped(text: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)
