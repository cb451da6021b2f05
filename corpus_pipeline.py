"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; in between, rows are
written as Parquet and read again. The stages that filter return the columns of `documents` as they are; the
last returns one row per piece of a document, with its place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, packing, quality, simhash, toxicity
from plumbline.llm.common import keep_rows
from plumbline.session import Checkpoints

ORACLE_SQL = None  # trained models, fingerprints, edit distances and tokenizers are beyond SQL
_KEEP, _PRINT = "__keep_by_quality", "__fingerprint"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; empty and null texts are scored like any other."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    columns = docs.columns
    stats = {f"{_KEEP}_{n}": c for n, c in quality.statistics(F.col("text")).items()}
    score = model.column({n: F.col(f"{_KEEP}_{n}") for n in quality.NAMES})
    judged = docs.withColumns(stats).select(*columns, (score >= quality.THRESHOLD).alias(_KEEP))
    # A filter would be moved below the projection and compute the statistics anew for every rule, but not below
    # a generator: one row in, one row out.
    judged = judged.select(F.inline(F.array(F.struct(*judged.columns))))
    return judged.where(F.coalesce(F.col(_KEEP), F.lit(False))).select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def start():
        score = model.scorer()
        return lambda texts: [s < toxicity.THRESHOLD for s in score(texts)]

    return keep_rows(docs, "text", start)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints, the one with the smallest id.

    Of repeated rows of that document one stays. Texts without words have one fingerprint and are one group. Rows
    without an id belong to no group and stay. Where ids repeat, a row is told by its id and fingerprint.
    """
    found = Checkpoints(spark).write(simhash.near_duplicates(docs.where("doc_id is not null")))
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        removed = found.where("doc_id <> component_id").select("doc_id")
        return docs.join(removed, "doc_id", "left_anti").select(*docs.columns)
    stay = found.groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("row")).select(
        "row.doc_id", F.col("row.fp").alias(_PRINT)
    )
    printed = simhash.with_fingerprints(docs.where("doc_id is not null"), _PRINT)
    kept = printed.join(stay, ["doc_id", _PRINT], "left_semi").dropDuplicates(["doc_id", _PRINT])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no stretch of which is a benchmark item up to the allowed edits."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in the sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; what a stage keeps lies in the checkpoint folder."""
    kept = Checkpoints(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
