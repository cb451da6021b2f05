"""Session options and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.sources.files import Folder

CHECKPOINT_DIR = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites in error messages cost several JVM calls per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the options the operators are written for; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
    context.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and cut its lineage; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Checkpoints:
    """Intermediate tables in the checkpoint folder that can be dropped again, each by its own name.

    The tables are Parquet files in shared storage, so they outlive executors, and reading them starts a
    new lineage. `drop` removes one as soon as a later one stands in for it: a loop holds two at a time.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
        self.names: dict[int, str] = {}
        self.tables: list[DataFrame] = []

    def write(self, df: DataFrame) -> DataFrame:
        name = f"{len(self.tables):06d}"
        df.write.parquet(f"{self.folder}/{name}")
        table = self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")
        self.names[id(table)] = name
        self.tables.append(table)  # keeps ids unique
        return table

    def drop(self, table: DataFrame) -> None:
        Folder(self.spark, self.folder).remove(self.names.pop(id(table)))
