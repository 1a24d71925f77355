"""The registered queries of this subpackage; their SQL stands in ``oracles``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scenlens.llm import (
    classifier,
    conversations,
    decontamination,
    licenses,
    line_dedup,
    mixing,
    near_dup,
    personal_data,
    quality_rules,
    sharding,
    spelling,
    token_ids,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "pages"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.deduplicate(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_mix_prefix_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op7_ids_perfect_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_ids.write_and_index(_table(spark, sf_dir, "documents"))
    return written.select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_fast_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.label(_table(spark, sf_dir, "documents"))


def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_checked_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(_table(spark, sf_dir, "documents"))


def op13_prefix_suffix_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_bounded_ring,
        op2_spaced_seeds,
        op3_site_lines,
        op4_warc_revisits,
        op5_mix_prefix_cut,
        op6_token_fertility,
        op7_ids_perfect_hash,
        op8_fast_sketches,
        op9_license_diagonals,
        op10_neighbour_votes,
        op11_branch_and_bound,
        op12_checked_patterns,
        op13_prefix_suffix_tiles,
        pipeline,
    )
}
