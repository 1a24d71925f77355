"""From raw documents to token shards: five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared
folder and rereads it as the next stage's ``docs``. All stages but the last return the columns of
``documents``. An empty table passes through all of them.

A stage's result reads tables that the stage staged, so it must be written before the next stage is called:
that deletes what the stage before it staged, but for what its own ``docs`` read. ``run`` also deletes each
stage's output once the next one is written, and leaves the last one alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from scenlens.llm import decontamination, mixing, near_dup, quality_rules, token_ids
from scenlens.llm.common import settings
from scenlens.sources.shared import delete_scope, new_folder, scope

SHINGLE = 5
BATCH = 2000  # rows that a task hands to Python at once; workers go on from stage to stage
STAGED, OUTPUTS = "pipeline stage", "pipeline outputs"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(stage: Stage) -> Stage:
    """The stage, after what earlier stages staged is deleted."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scope(spark, STAGED, but_for=[docs])
        with scope(STAGED), settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH}):
            return stage(spark, docs, sf_dir)

    return run


@apart
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands of their language accept."""
    return quality_rules.filtered(docs)


@apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar five-word shingles."""
    return near_dup.deduplicate(docs, SHINGLE)


@apart
def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


@apart
def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards and index of the mix, read back: a row for each copy of a document."""
    return token_ids.write_and_index(docs).select("doc_id", "copy", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_overlaps),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

ORACLE_SQL = None  # no SQL for tokenizers and sketches; tests/llm/test_pipeline.py holds it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        with scope(OUTPUTS):
            folder = new_folder(spark, f"pipeline-{name}")
        result.write.parquet(folder)
        docs = spark.read.parquet(folder)
        delete_scope(spark, OUTPUTS, but_for=[docs])
    delete_scope(spark, STAGED)
    return docs
