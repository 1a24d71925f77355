"""Mix sources to target weights: hash-random keys, a range sort, prefix sums and exact cuts.

Every document gets a random key from a hash of its id. All rows are range-sorted by source and key;
distributed prefix sums of their word counts give each row's start within its source. A source whose
budget is ``k`` times its size plus a rest takes each document ``k`` times, and once more what starts
within the rest; the document at the cut counts with the words up to it, so budgets are met to the word.

Targets: the sources, by code point with null last, weigh 5, 2, 1, repeating, and share ``SHARE`` times all
words. A target stops at ``REPEATS`` times its source's size; the excess goes to the others by weight until
none is above. That is the level L at which the sum of min(REPEATS x size, L x weight) is the share: with
the sources ordered by the ratio of cap to weight, L is the largest of (share - caps before) / (weights
from here on).

Defined results: a null text has 0 words; a null source is a source of its own; a source without words has
target 0. Rows with equal ids are ordered by size and then taken as they come, which changes no total.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from scenlens.llm.common import numbered, word_count
from scenlens.operators.joins import left_join
from scenlens.sources.shared import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix"


def random_key(column: str):
    """A uniform 60-bit number from the MD5 of the id."""
    text = F.concat(F.coalesce(F.col(column).cast("string"), F.lit("null")), F.lit(SEED))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, target). One row per source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(everything) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * REPEATS)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * SHARE - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(after)
    leveled = capped.withColumn("level", level)
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.max("level").over(all_rows) * F.col("weight")).alias("target"),
    )


def mix(documents: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of each document, and the column ``row`` if named."""
    own = [row] if row else []
    size, key = word_count(F.col("text")).alias("size"), random_key("doc_id").alias("key")
    facts = staged(documents.select("doc_id", "source", size, key, *own), "mix_facts")
    placed = numbered(facts, ["source", "key", "doc_id", "size", *own], {"before": "size"})
    sizes = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    starts = placed.groupBy("source").agg(F.min("before").alias("source_start"))
    per_source = left_join(staged(targets(sizes), "mix_targets"), starts, "source", null_keys=True)
    rows = left_join(placed, per_source, "source", null_keys=True, spread=True)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    start = F.col("before") - F.col("source_start")
    once_more = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    taken = (epochs * F.col("size") + once_more).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *own)


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they are.

    Documents are whole: one that the cut divides is there if at least half of it is taken.
    """
    row = "__mix_row"
    rows = staged(documents.withColumn(row, F.monotonically_increasing_id()), "mix_rows")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("__times")
    taken = mix(rows, row).filter(F.col("size") > 0).select(row, times).filter("__times > 0")
    joined = rows.join(taken, row).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return joined.select(*[F.col(f"`{c}`") for c in documents.columns])
