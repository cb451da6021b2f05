"""Stores of failing rows and of metric history."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.files import Folder

PARTITIONS = ("source", "rule")
WRITERS = 64  # files that a task has open at a time; only with more rules than that in one task are rows sorted


def _folder_name(value: str) -> str:
    """A partition value as Spark escapes it in folder names."""
    kept = " !$&()+,-.;<>@_`|~"
    return "".join(c if c.isalnum() or c in kept or ord(c) > 127 else quote(c, safe="") for c in value)


@dataclass(frozen=True)
class ViolationStore:
    """Failing rows, partitioned by source and rule; a run replaces what it checked.

    Partitioning by rule too keeps two rules on one source from erasing each other.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def replace(self, violations: DataFrame, checked: Iterable[tuple[str, str]]) -> None:
        """Store `violations` (with columns source and rule) for the (source, rule) pairs `checked`.

        Dynamic overwrite replaces the partitions that have new rows. A checked rule without any
        failing row would keep its old partition, so those are removed after the write succeeded.
        """
        spark = violations.sparkSession
        seen = Observation()
        observed = violations.observe(seen, F.collect_set(F.struct(*PARTITIONS)).alias("pairs"))
        # One or a few files per rule instead of one per rule and task; AQE splits what is large.
        observed = observed.hint("rebalance", *(F.col(c) for c in PARTITIONS))
        # Failing rows are all alike but for their id and shrink to a thirtieth in a shuffle, so that a sort by rule would
        # need many times the bytes by which AQE sizes its tasks.
        key = "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(key, None)
        spark.conf.set(key, WRITERS)
        try:
            observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *PARTITIONS
            ).parquet(self.path)
        finally:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        written = {(r["source"], r["rule"]) for r in seen.get["pairs"]}
        folder = Folder(spark, self.path)
        for source, rule in set(checked) - written:
            folder.remove(f"source={_folder_name(source)}/rule={_folder_name(rule)}")


@dataclass(frozen=True)
class MetricStore:
    """Append-only metric tables, one folder per metric; the timestamp is the version."""

    path: str

    def append(self, metric: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{metric}")

    def read(self, spark: SparkSession, metric: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{metric}")

    def views(self, spark: SparkSession, metrics: Sequence[str], prefix: str = "") -> None:
        for metric in metrics:
            self.read(spark, metric).createOrReplaceTempView(prefix + metric)
