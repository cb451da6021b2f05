"""Table sources and sinks over Spark's readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import PurePosixPath
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import Checkpoints
from plumbline.sources.files import Folder
from plumbline.sources.records import Records
from plumbline.sources.unions import Mode, union_frames

# File extension -> Spark format.
FORMATS = {
    "csv": "csv",
    "parquet": "parquet",
    "pq": "parquet",
    "json": "json",
    "ndjson": "ndjson",
    "jsonl": "ndjson",
    "avro": "avro",
    "delta": "delta",
}
# Formats without a distributed reader in Spark.
SINGLE_MACHINE = ("xlsx", "xls", "excel", "feather", "ipc", "arrow")


def resolve_format(path_or_name: str) -> str:
    """Spark format of a file name, an extension with or without dot, or a format name."""
    text = str(path_or_name)
    name = (PurePosixPath(text).suffix or text).lower().lstrip(".")
    if name in SINGLE_MACHINE:
        raise NotImplementedError(f"{name} has no Spark reader: convert it to Parquet first")
    if name not in FORMATS:
        raise ValueError(f"unknown file type {path_or_name!r}")
    return FORMATS[name]


_EMPTY = "\ue000empty\ue000"  # stands for a quoted empty value between Spark's parser and `_typed`


@dataclass(frozen=True)
class TableSource:
    """Where a table lies and how to read it. `read` is lazy; columns and limits reach the scan."""

    path: str
    format: str | None = None
    columns: Sequence[str] | None = None
    limit: int | None = None
    schema: T.StructType | str | None = None
    # CSV
    header: bool = True
    separator: str = ","
    quote: str = '"'
    encoding: str = "utf-8"
    skip_rows: int = 0
    null_values: Sequence[str] = ()
    parse_dates: bool = False
    multi_line: bool = True  # quoted fields may hold line breaks; files without any are read line by line all the same
    sample_lines: int | None = None  # types from so many first lines instead of all; a misfit below them raises
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def resolved(self) -> str:
        return resolve_format(self.format or self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        kind = self.resolved
        if kind == "csv":
            df = self._read_csv(spark)
        else:
            reader = spark.read.options(**self.options)
            if self.schema is not None:
                reader = reader.schema(self.schema)
            if kind == "json":
                df = reader.option("multiLine", True).json(self.path)  # one array per document
            elif kind == "ndjson":
                df = reader.json(self.path)
            else:
                df = reader.format(kind).load(self.path)
        if self.columns is not None:
            df = df.select(*self.columns)
        return df if self.limit is None else df.limit(self.limit)

    def _csv_options(self) -> dict[str, str]:
        options = {
            "sep": self.separator,
            "quote": self.quote,
            "escape": self.quote,  # a quote within quotes is doubled
            "emptyValue": _EMPTY,  # "" is an empty text, nothing at all is null
            "encoding": self.encoding,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
            "mode": "FAILFAST",  # a value that does not fit its type is an error, never a silent null
        }
        if self.null_values:
            options["nullValue"] = self.null_values[0]
        return options | dict(self.options)

    def _inferring(self) -> dict[str, str]:
        return self._csv_options() | {"inferSchema": "true", "emptyValue": ""}  # a quoted empty value has no type

    def _sampled_schema(self, spark: SparkSession) -> T.StructType:
        """Types from all lines, or the first `sample_lines`; dates stay text unless asked for."""
        if self.sample_lines is None and not self.skip_rows:
            sample = self.path
        elif self.sample_lines is None:
            lines = self._body(spark, self.skip_rows)
            header = spark.read.option("encoding", self.encoding).text(self.path).limit(self.skip_rows + 1).collect()
            names = header[-1][0] if self.header and len(header) > self.skip_rows else None
            # Lines in any order: the header is only used for its names.
            inferred = spark.read.options(**self._inferring())
            body = lines.where(F.col("value") != names) if names is not None else lines
            schema = inferred.option("header", False).csv(body.rdd.map(lambda r: r[0])).schema
            if names is not None:
                named = spark.read.options(**self._csv_options()).option("header", True)
                labels = named.csv(spark.sparkContext.parallelize([names], 1)).columns
                schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(labels, schema)])
            return self._without_dates(schema)
        else:
            lines = spark.read.option("encoding", self.encoding).text(self.path)
            head = lines.limit(self.skip_rows + 1 + self.sample_lines).collect()
            sample = spark.sparkContext.parallelize([r[0] for r in head[self.skip_rows :]], 1)
        reader = spark.read.options(**self._inferring())
        return self._without_dates(reader.option("header", self.header).csv(sample).schema)

    def _without_dates(self, schema: T.StructType) -> T.StructType:
        if self.parse_dates:
            return schema
        temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
        return T.StructType(
            [T.StructField(f.name, T.StringType() if isinstance(f.dataType, temporal) else f.dataType)
             for f in schema]
        )

    def _read_csv(self, spark: SparkSession) -> DataFrame:
        if self.multi_line and self.quote:
            records = Records(spark, self.path, self.separator, self.quote, self.encoding, self.skip_rows)
            if records.may_span_lines():
                return self._read_records(spark, records.read())
        schema = self.schema if self.schema is not None else self._sampled_schema(spark)
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        raw = self._raw(schema)
        if self.skip_rows:
            df = self._parsed(self._body(spark, self.skip_rows + (1 if self.header else 0)), raw)
        else:
            reader = spark.read.schema(raw).options(**self._csv_options())
            df = reader.option("header", self.header).csv(self.path)
        return self._typed(df, schema)

    def _raw(self, schema: T.StructType) -> T.StructType:
        """Columns are read as text and cast afterwards, so that each knows all null markers and quoted empty values.

        Types with a format of their own among the options are left to the parser.
        """
        if {"dateFormat", "timestampFormat", "timestampNTZFormat"} & set(self.options):
            return schema
        return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])

    def _typed(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Null markers are null, a quoted empty value is an empty text or no number, and a misfit is an error."""
        out, strict = [], self._csv_options()["mode"].upper() == "FAILFAST"
        for f in schema:
            value, text = F.col(f"`{f.name}`"), isinstance(f.dataType, T.StringType)
            if isinstance(df.schema[f.name].dataType, T.StringType):
                markers = [*self.null_values, *([] if text else [_EMPTY])]
                value = F.when(~value.isin(markers), value) if markers else value
                cast = F.when(value == _EMPTY, "").otherwise(value) if text else value.try_cast(f.dataType)
                if not text and strict:
                    told = F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), value)
                    cast = F.when(value.isNotNull() & cast.isNull(), F.raise_error(told).cast(f.dataType)).otherwise(cast)
                value = cast
            out.append(value.alias(f.name))
        return df.select(*out)

    def _parsed(self, records: DataFrame, schema: T.StructType) -> DataFrame:
        """One row per record (`value`); line breaks inside quotes stay as they are."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        options = self._csv_options() | {"multiLine": "true"}
        # A generator: no filter on parsed columns is moved below it, to lines that are no records.
        return records.select(F.inline(F.array(F.from_csv("value", ddl, options))))

    def _read_records(self, spark: SparkSession, records: DataFrame) -> DataFrame:
        """Records that span lines; types from all of them, or the first `sample_lines` of a file."""
        records = Checkpoints(spark).write(records)
        top = Window.partitionBy("file").orderBy("start", "number")
        wanted = int(self.header) + (self.sample_lines or 0)
        first = records.withColumn("place", F.row_number().over(top)).where(F.col("place") <= wanted)  # cut in each task
        if self.header:
            header = first.where("place = 1")
            names = header.orderBy("file").first()
            if names is None:
                return spark.createDataFrame([], self.schema or "value string")
            body = records.join(header.select("file", "start", "number"), ["file", "start", "number"], "left_anti")
        else:
            body = records
        schema = self.schema
        if schema is None:
            sample = body
            if self.sample_lines is not None:
                sample = first.where(F.col("place") > int(self.header))
            inferred = spark.read.options(**self._inferring()).option("multiLine", True).option("header", False)
            schema = self._without_dates(inferred.csv(sample.select("value").rdd.map(lambda r: r[0])).schema)
            if self.header:
                reader = spark.read.options(**self._csv_options()).option("multiLine", True).option("header", True)
                labels = reader.csv(spark.sparkContext.parallelize([names["value"]], 1)).columns
                types = [f.dataType for f in schema] or [T.StringType()] * len(labels)  # no record, no type
                schema = T.StructType([T.StructField(n, t) for n, t in zip(labels, types)])
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return self._typed(self._parsed(body, self._raw(schema)), schema)

    def _body(self, spark: SparkSession, skipped: int) -> DataFrame:
        """The lines (`value`) after the first `skipped` of each file."""
        lines = (
            spark.read.option("encoding", self.encoding)
            .text(self.path)
            .select(
                "value",
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("id"),
            )
        )
        # Ids are consecutive within a block, so a line's place follows from the file's first id.
        first = lines.where("start = 0").groupBy("file").agg(F.min("id").alias("first"))
        return lines.join(first, "file").where(
            (F.col("start") > 0) | (F.col("id") - F.col("first") >= skipped)
        ).select("value")


@dataclass(frozen=True)
class TableSink:
    """Where a table goes. Parent folders are created by Spark."""

    path: str
    format: str | None = None
    header: bool = True
    separator: str = ","
    quote: str = '"'
    null_value: str | None = None
    compression: str | None = None
    row_group_bytes: int | None = None
    partition_by: Sequence[str] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, mode: Literal["overwrite", "append", "error"] = "overwrite") -> None:
        kind = resolve_format(self.format or self.path)
        options = dict(self.options)
        if kind == "csv":
            options = {
                "header": str(self.header).lower(), "sep": self.separator, "quote": self.quote, "escape": self.quote,
                "emptyValue": self.quote * 2,
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            } | options
            if self.null_value is not None:
                options["nullValue"] = self.null_value
        if self.compression is not None:
            options["compression"] = self.compression
        if self.row_group_bytes is not None:
            options["parquet.block.size"] = str(self.row_group_bytes)
        writer = df.write.mode(mode).options(**options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.format("json" if kind == "ndjson" else kind).save(self.path)

    def append(self, df: DataFrame) -> None:
        self.write(df, "append")

    def as_source(self) -> TableSource:
        return TableSource(
            self.path,
            self.format,
            header=self.header,
            separator=self.separator,
            quote=self.quote,
            null_values=() if self.null_value is None else (self.null_value,),
        )


Keep = Literal["first", "last", "any", "none"]


def upsert_frames(
    existing: DataFrame,
    incoming: DataFrame,
    unique_on: Sequence[str] | None = None,
    keep: Keep = "last",
    how: Mode = "vertical_relaxed",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Union of both, keeping one row per `unique_on`: from the first or last load, any, or none.

    Within a load `order_by` decides, then the row itself, so the result does not depend on
    partitioning. `none` keeps only rows whose key is not repeated. Null is an ordinary key value.
    """
    if keep not in ("first", "last", "any", "none"):
        raise ValueError(f"keep must be first, last, any or none, not {keep!r}")
    marked = [f.withColumn("__load", F.lit(i)) for i, f in enumerate((existing, incoming))]
    both = union_frames(marked, how)
    columns = [c for c in both.columns if c != "__load"]
    if unique_on is None:
        return both.select(*columns)
    # One maximum per key, combined on the map side: no window over a hot key.
    ranked = F.struct("__load", *order_by, F.struct(*columns).alias("__row"))
    best = F.min(ranked) if keep == "first" else F.max(ranked)
    chosen = both.groupBy(*unique_on).agg(best.alias("b"), F.count(F.lit(1)).alias("n"))
    if keep == "none":
        chosen = chosen.where("n = 1")
    return chosen.select("b.__row.*")


@dataclass(frozen=True)
class VersionedTable:
    """A Parquet table whose every rewrite is a new folder; readers see the last finished one.

    Spark cannot overwrite what it is reading. A version counts once its success marker exists, so a
    failed or half-written one is never read.
    """

    path: str

    def _versions(self, spark: SparkSession) -> list[str]:
        folder = Folder(spark, self.path)
        return [n for n in folder.names() if n.startswith("v") and folder.exists(f"{n}/_SUCCESS")]

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._versions(spark))

    def current(self, spark: SparkSession) -> str:
        versions = self._versions(spark)
        if not versions:
            raise FileNotFoundError(f"no finished version in {self.path}")
        return f"{self.path}/{versions[-1]}"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.current(spark))

    def write(self, df: DataFrame) -> str:
        spark = df.sparkSession
        taken = [int(n[1:]) for n in Folder(spark, self.path).names() if n[1:].isdigit()]
        target = f"{self.path}/v{max(taken, default=0) + 1:08d}"
        df.write.mode("errorifexists").parquet(target)
        return target

    def upsert(
        self, df: DataFrame, unique_on: Sequence[str] | None = None, keep: Keep = "last",
        how: Mode = "vertical_relaxed", order_by: Sequence[str] = (),
    ) -> str:
        spark = df.sparkSession
        if not self.exists(spark):
            return self.write(df)
        return self.write(upsert_frames(self.read(spark), df, unique_on, keep, how, order_by))


def stamp_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Dense 0-based ids in scan order, without collecting or sorting the table.

    Two scans: rows per partition first, their running sums as offsets second. Apply to a plain
    scan of written files (as `ingest` does), whose partitions are the same in both; store the result.
    """
    from pyspark.sql import Window

    placed = df.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    )
    sizes = df.groupBy(F.spark_partition_id().alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the scan, so the unpartitioned window and the broadcast stay small.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"))
    return placed.join(F.broadcast(offsets), "__pid").select(
        (F.col("__from") + F.col("__at")).alias(name), *df.columns
    )


def ingest(
    spark: SparkSession,
    source: TableSource,
    sink: TableSink,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    row_id: str | None = "row_id",
) -> None:
    """Copy a source to a sink; fails if the source is missing. `row_id=None` stamps no ids.

    Ids are stamped on rows that are written already: two evaluations of a plan that shuffles need not place
    its rows alike.
    """
    if not Folder(spark, source.path).exists():
        raise FileNotFoundError(source.path)
    df = source.read(spark)
    if transform is not None:
        df = transform(df)
    if row_id is None:
        sink.write(df)
        return
    kept = Checkpoints(spark)
    written = kept.write(df)
    sink.write(stamp_row_id(written, row_id))
    kept.drop(written)


def run_transform(
    spark: SparkSession,
    sources: Sequence[TableSource],
    func: Callable[..., DataFrame],
    sink: TableSink,
) -> None:
    """Read the sources, apply `func` to the frames, write its result: one plan, one write."""
    sink.write(func(*(source.read(spark) for source in sources)))


def query(df: DataFrame, sql: str, name: str = "self") -> DataFrame:
    """Run SQL on one frame, visible in it under `name`."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql)


def preview(df: DataFrame, rows: int = 15) -> None:
    df.show(rows)
