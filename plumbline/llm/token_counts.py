"""Token counts by source, language and tokenizer, kept up to date by signed deltas.

A ledger is a folder of three tables: `state` with the counts of each document that a batch changed, `deltas`
with the batch's signed change of each total, and `commits` with the batches that are valid. A commit reads the
last valid state of just the documents in the batch, writes state and deltas into the batch's own
partitions, and makes them valid by one last row. A batch that is delivered again finds that row and changes
nothing; one that broke off before it overwrites its own partitions. Totals are sums of deltas, so they
never read a document twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Patterns whose matches are tokens; both read the same in Java and RE2.
TOKENIZERS = {
    "words-1": r"[^\x09-\x0D\x20]+",
    "pieces-2": r"[A-Za-z]+|[0-9]|[^A-Za-z0-9\x09-\x0D\x20]",
}
GROUP = ["source", "lang", "tokenizer"]
_STATE = "doc_id bigint, tokenizer string, source string, lang string, n_tokens bigint, live boolean, batch bigint"
_DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, batch bigint"


def count_tokens(text: Column, tokenizers: Mapping[str, str] = TOKENIZERS) -> Column:
    """array<struct<tokenizer, n_tokens>> of a whole text; a null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.array(*(
        F.struct(
            F.lit(name).alias("tokenizer"),
            F.regexp_count(whole, F.lit(pattern)).cast("bigint").alias("n_tokens"),
        )
        for name, pattern in tokenizers.items()
    ))


def counted(documents: DataFrame, tokenizers: Mapping[str, str] = TOKENIZERS) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, op='upsert'): a batch that inserts or revises documents."""
    return documents.select(
        "doc_id", "source", "lang", F.explode(count_tokens(F.col("text"), tokenizers)).alias("c")
    ).select("doc_id", "source", "lang", "c.tokenizer", "c.n_tokens", F.lit("upsert").alias("op"))


def deleted(documents: DataFrame, tokenizers: Mapping[str, str] = TOKENIZERS) -> DataFrame:
    """A batch that deletes the documents with these ids."""
    names = F.array(*(F.lit(n) for n in tokenizers))
    return documents.select(
        "doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.explode(names).alias("tokenizer"), F.lit(None).cast("bigint").alias("n_tokens"), F.lit("delete").alias("op"),
    )


class TokenLedger:
    """Totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def create(self) -> TokenLedger:
        """An empty ledger; does nothing where there is one."""
        for name, schema in (("commits", "batch bigint"), ("state", _STATE), ("deltas", _DELTAS)):
            empty = self.spark.createDataFrame([], schema)
            # The batch is a folder in `state` and `deltas`, so that a repeated write replaces its own rows alone.
            writer = empty.write.mode("ignore")
            (writer if name == "commits" else writer.partitionBy("batch")).parquet(f"{self.folder}/{name}")
        return self

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def batches(self) -> list[int]:
        """The committed batches."""
        return sorted(r["batch"] for r in self._read("commits", "batch bigint").distinct().collect())

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch; False, and nothing changes, if it was applied before.

        `changes` has doc_id, source, lang, tokenizer, n_tokens and op: `upsert` inserts a document or revises its
        counts, source or language; `delete` takes it out. Rows with a null doc_id or tokenizer, or another op, are
        left out; a null count is 0; null sources and languages are groups of their own. Of several rows of one
        document and tokenizer a delete wins, then the largest (n_tokens, source, lang). Deleting what is not
        there changes nothing. Batch numbers must grow from commit to commit.
        """
        done = self.batches()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after {done[-1]}")
        rank = F.struct(
            (F.col("op") == "delete").alias("gone"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "source", "lang"
        )
        new = (
            changes.where(F.col("op").isin("upsert", "delete"))
            .where("doc_id is not null and tokenizer is not null")
            .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"), "tokenizer")
            .agg(F.max(rank).alias("new"))
            .select(
                "doc_id", "tokenizer", "new.source", "new.lang", "new.n_tokens",
                (~F.col("new.gone")).alias("live"), F.lit(batch).cast("bigint").alias("batch"),
            )
        )
        self._write("state", new)  # texts are read once; without the commit's row nobody sees it
        state = self._read("state", _STATE).where(F.col("batch") == batch)
        keys = ["doc_id", "tokenizer"]
        old = (
            self._state(done)
            .join(state.select(*keys), keys, "left_semi")
            .groupBy(*keys)
            .agg(F.max(F.struct("batch", "live", "n_tokens", "source", "lang")).alias("old"))
            .where("old.live")
        )
        gained = state.where("live").select(*GROUP, F.lit(1).alias("d"), F.col("n_tokens").alias("t"))
        lost = old.select(
            F.col("old.source").alias("source"), F.col("old.lang").alias("lang"), "tokenizer",
            F.lit(-1).alias("d"), (-F.col("old.n_tokens")).alias("t"),
        )
        self._write("deltas", gained.unionByName(lost).groupBy(*GROUP).agg(
            F.sum("d").cast("bigint").alias("n_docs"), F.sum("t").alias("n_tokens"),
            F.lit(batch).cast("bigint").alias("batch"),
        ))
        row = self.spark.createDataFrame([(batch,)], "batch bigint")
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def _write(self, name: str, rows: DataFrame) -> None:
        """Replace the batch's partition of a table."""
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
        writer.parquet(f"{self.folder}/{name}")

    def _state(self, done: list[int]) -> DataFrame:
        state = self._read("state", _STATE)
        return state.where(F.col("batch").isin(done)) if done else state.limit(0)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches; groups without documents are gone."""
        valid = self._read("deltas", _DELTAS).join(
            self._read("commits", "batch bigint").distinct(), "batch", "left_semi"
        )
        return valid.groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        ).where("n_docs <> 0")
