"""Assessment that scans new files only: what the rules measure is kept per file and adds up.

A row check's state is how many rows of a file there are and fail, a key rule's how often each key value occurs in
the file, by digest. The manifest tells which scan of a file counts: taking a file back that is gone or was written
anew is one row there, and its states are read no more. Scores are sums over states; the files are not read for them.

A batch of states counts once its row in the manifest is written, so a run that breaks off leaves nothing behind, and
doing it again is harmless. There must be one writer at a time for a folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import checks
from plumbline.operators.checks import run_timestamp, score
from plumbline.plans.assessment import Rulebook, metric_tables
from plumbline.sources.files import Folder
from plumbline.sources.unions import union_all

_ROWS = "batch bigint, source string, file string, metric string, rule string, columns array<string>, detail string, failed bigint, total bigint"
_KEYS = "batch bigint, source string, file string, label string, key binary, n bigint"
_MANIFEST = "batch bigint, source string, file string, stamp string, sign int"


@dataclass(frozen=True)
class Change:
    """File names that a run scanned, and those whose states it took back."""

    scanned: list[str]
    taken_back: list[str]


class IncrementalAssessment:
    """Row checks and key rules of a rulebook over folders of files.

    `read` makes a DataFrame of file paths (Parquet if not given), `prepare` may add columns; rows must come from
    one file each. Key values are compared as text, as a union of sources does; null is an ordinary value.
    """

    def __init__(
        self, spark: SparkSession, folder: str, rules: Rulebook,
        read: Callable[[SparkSession, list[str]], DataFrame] | None = None,
        prepare: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> None:
        self.spark, self.folder, self.rules = spark, folder, rules
        self.read = read or (lambda session, paths: session.read.parquet(*paths))
        self.prepare = prepare or (lambda source, df: df)
        if Folder(spark, folder).exists("keys"):
            raise ValueError(f"{folder} holds states of an older layout: start in another folder")

    def _stored(self, name: str, schema: str) -> DataFrame:
        if not Folder(self.spark, self.folder).exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def _manifest(self) -> DataFrame:
        return self._stored("manifest", _MANIFEST)

    def _live(self, name: str, schema: str) -> DataFrame:
        """States of the last finished scan of each file that is there."""
        scan = F.max(F.when(F.col("sign") > 0, F.col("batch"))).alias("batch")
        files = self._manifest().groupBy("source", "file").agg(scan, F.sum("sign").alias("n")).where("n > 0").drop("n")
        return self._stored(name, schema).join(F.broadcast(files), ["batch", "source", "file"], "left_semi")

    def known(self, source: str) -> dict[str, str]:
        """The files whose states count, and what told them apart from later versions."""
        rows = self._manifest().where(F.col("source") == source).groupBy("file", "stamp").agg(F.sum("sign").alias("n"))
        return {r["file"]: r["stamp"] for r in rows.where("n > 0").collect()}

    def update(self, source: str, path: str) -> Change:
        """Bring the states of `source` up to the files that lie in `path` now; only new or changed ones are scanned."""
        now, known = Folder(self.spark, path).files(), self.known(source)
        scanned = sorted(f for f, stamp in now.items() if known.get(f) != stamp)
        back = sorted(f for f, stamp in known.items() if now.get(f) != stamp)
        if not scanned and not back:
            return Change([], [])
        last = self._stored("manifest", _MANIFEST).agg(F.max("batch")).first()[0]
        # Of a run that broke off, too.
        started = [self._stored(*stored).agg(F.max("batch")).first()[0] for stored in (("rows", _ROWS), ("key_counts", _KEYS))]
        batch = 1 + max(n or 0 for n in (last, *started))
        rows, keys = [], []
        if scanned:
            own = self.read(self.spark, [f"{path}/{f}" for f in scanned])
            own = self.prepare(source, own.withColumn("__file", F.element_at(F.split(F.input_file_name(), "/"), -1)))
            file = F.url_decode(F.col("__file")).alias("file")
            rows += self._row_states(source, own, file)
            keys += self._key_states(source, own, file)
        for name, parts, schema in (("rows", rows, _ROWS), ("key_counts", keys, _KEYS)):
            if parts:
                states = union_all([p.withColumn("batch", F.lit(batch).cast("bigint")) for p in parts])
                states.select(*(c.split()[0] for c in schema.split(", "))).write.mode("append").parquet(f"{self.folder}/{name}")
        entries = [(batch, source, f, known[f], -1) for f in back] + [(batch, source, f, now[f], 1) for f in scanned]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        return Change(scanned, back)

    def _row_states(self, source: str, df: DataFrame, file) -> list[DataFrame]:
        own = list(self.rules.row_checks.get(source, ()))
        if not own:
            return []
        counted = df.groupBy(file).agg(
            F.count(F.lit(1)).alias("total"), *(F.count_if(c.failed(df)).alias(f"f{i}") for i, c in enumerate(own))
        )
        unfolded = F.inline(F.array(*(
            F.struct(
                F.lit(c.metric).alias("metric"), F.lit(c.rule).alias("rule"), F.array(*map(F.lit, c.columns)).alias("columns"),
                F.lit(c.detail).cast("string").alias("detail"), F.col(f"f{i}").alias("failed"),
            )
            for i, c in enumerate(own)
        )))
        return [counted.select(F.lit(source).alias("source"), "file", "total", unfolded)]

    def _key_states(self, source: str, df: DataFrame, file) -> list[DataFrame]:
        parts = []
        for rule in self.rules.keys:
            if source in rule.sources:
                columns = [F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(sorted(rule.columns))]
                digest = F.sha2(F.to_json(F.struct(*columns)), 256)  # a null has no entry there
                key = F.unhex(F.left(digest, F.lit(32))).alias("key")  # 128 bits tell any number of values apart
                label = F.lit(f"{rule.label}: {checks.key_label(rule.columns)}").alias("label")
                counted = df.groupBy(file, key).agg(F.count(F.lit(1)).alias("n"))
                parts.append(counted.select(F.lit(source).alias("source"), "file", label, "key", "n"))
        return parts

    def scores(self, at: datetime | str | None = None) -> dict[str, DataFrame]:
        """The metric tables that `assess` would give for all files together."""
        timestamp = run_timestamp(at)
        out = {}
        if self.rules.row_checks:
            asked = [
                (s, c.metric, c.rule, list(c.columns), c.detail) for s, cs in self.rules.row_checks.items() for c in cs
            ]
            wanted = self.spark.createDataFrame(
                asked, "source string, metric string, rule string, columns array<string>, detail string")
            sums = self._live("rows", _ROWS).groupBy("source", "metric", "rule", "columns", "detail").agg(
                F.sum("failed").alias("failed_rows"), F.sum("total").alias("total_rows")
            ).withColumnsRenamed({n: f"__{n}" for n in ("source", "metric", "rule", "columns", "detail")})
            same = [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in ("source", "metric", "rule", "columns", "detail")]
            fused = wanted.join(sums, same, "left").select(
                *wanted.columns, F.coalesce("failed_rows", F.lit(0)).alias("failed_rows"),
                F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
            ).withColumns({"score": score(F.col("failed_rows"), F.col("total_rows")), "timestamp": timestamp})
            out |= metric_tables(fused, {c.metric for cs in self.rules.row_checks.values() for c in cs})
        if self.rules.keys:
            # Over all sources of a rule.
            counts = self._live("key_counts", _KEYS).groupBy("label", "key").agg(F.sum("n").alias("n"))
            sums = counts.groupBy("label").agg(
                F.sum("n").alias("total"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("failed")
            )
            wanted = self.spark.createDataFrame(
                [(f"{r.label}: {checks.key_label(r.columns)}", r.label, checks.key_label(r.columns)) for r in self.rules.keys],
                "label string, source string, column_name string",
            )
            out["uniqueness"] = wanted.join(sums, "label", "left").select(
                "source", "column_name",
                score(F.coalesce("failed", F.lit(0)), F.coalesce("total", F.lit(0))).alias("uniqueness_percent"),
                timestamp.alias("timestamp"),
            )
        return out
