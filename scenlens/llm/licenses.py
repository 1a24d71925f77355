"""License scan by diagonal voting.

All rolling two-word grams of a text are joined, by hash and then by their words, to the positions of the
templates' grams; a template of ``LONG`` words or more also asks for the third word. A hit votes for the
diagonal text position - template position. The votes are aggregated per diagonal, and each diagonal is
merged with the ones up to ``SLACK`` above it, so a few words put in or left out don't break a span.

Hits only propose spans. To verify one, it is extended to both ends of the template, and each word of the
template is compared with the text's word on the span's diagonals. The share of the template's words that
stand there is the span's score; from ``COVERAGE`` on it is a find. One changed word leaves every template a
gram and a share above that. Only the words by which a notice names its license must stand, else the span is
of another license and has no score: "released under the X license" is a find with mit for X alone.

Beside that stand the base phrases, found wherever their words follow each other.

The templates are a fixed list, broadcast. Hits are few and grouped by document.

Defined results: a null text is empty; a text without words has no places, null first and last word and
score 0. Rows with the same id and text get the same result each; rows with the same id and other texts
are scanned on their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from scenlens.llm.common import bounded_table
from scenlens.llm.license_texts import NOTICES, TEXTS
from scenlens.operators.joins import left_join
from scenlens.sources.shared import staged

LONG = 6  # words of a template whose grams have three words
SLACK = 4
COVERAGE = 0.75

# Base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = WORD.replace("^", "")


def words(text: Column) -> Column:
    """Lower-cases A-Z; words are runs of ASCII letters, digits and non-ASCII characters."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)  # extracting words costs several times as much
    return F.array_remove(parts, "")  # at an end that is no word


def template_words(text: str) -> list[str]:
    lower = text.translate(str.maketrans(UPPER, LOWER))
    return re.findall(WORD, lower)


#: (label, words, naming words) of all templates.
TEMPLATES = [(label, template_words(text), naming.split()) for label, text, naming in [*NOTICES, *((*t, "") for t in TEXTS)]]


def template_positions(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """One row for each gram of each template; ``third`` is null where two words are enough."""
    rows = []
    for number, (_, w, _) in enumerate(templates):
        k = 3 if len(w) >= LONG else 2
        rows += [{"template": number, "at": i, "tgram": f"{w[i]} {w[i + 1]}", "third": w[i + 2] if k == 3 else None} for i in range(len(w) - k + 1)]
    return bounded_table(spark, rows, "template int, at int, tgram string, third string").withColumn("hash", F.xxhash64("tgram"))


def hits(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, key, words) to each place where a gram of a template stands."""
    w = F.col("words")
    starts = F.when(F.size(w) > 1, F.sequence(F.lit(0), F.size(w) - 2)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)).alias("gram"), F.get(w, i + 2).alias("next")))
    rolled = rows.select("doc_id", "key", F.posexplode(grams).alias("pos", "found")).select("doc_id", "key", "pos", "found.gram", "found.next")
    joined = rolled.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(templates), "hash")  # the templates are fixed
    return joined.filter((F.col("gram") == F.col("tgram")) & (F.col("third").isNull() | (F.col("third") == F.col("next"))))


def proposals(found: DataFrame) -> DataFrame:
    """Hits to (doc_id, key, spans): for each diagonal of a template, the diagonals merged with it."""
    diagonals = found.select("doc_id", "key", "template", (F.col("pos") - F.col("at")).alias("diagonal")).distinct()
    by = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal").rangeBetween(0, SLACK)
    merged = diagonals.select("doc_id", "key", F.struct("template", F.collect_list("diagonal").over(by).alias("diagonals")).alias("span"))
    return merged.groupBy("doc_id", "key").agg(F.collect_list("span").alias("spans"))


def coverage(span: Column, words: Column, templates=TEMPLATES) -> Column:
    """The share of the template's words that stand on one of the span's diagonals; 0 if a naming word doesn't."""
    texts = F.array(*[F.split(F.lit(" ".join(w)), " ") for _, w, _ in templates])
    naming = F.array(*[F.array(*[F.lit(x) for x in names]).cast("array<string>") for _, _, names in templates])
    template = F.get(texts, span["template"])
    places = F.sequence(F.lit(0), F.size(template) - 1)
    held = F.filter(places, lambda t: F.exists(span["diagonals"], lambda d: F.coalesce(F.get(words, t + d) == F.get(template, t), F.lit(False))))
    standing = F.transform(held, lambda t: F.get(template, t))
    named = F.forall(F.get(naming, span["template"]), lambda x: F.array_contains(standing, x))
    return F.when(named, F.size(held) / F.size(template)).otherwise(F.lit(0.0))


def verified(proposed: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, key, method_labels, best) of the documents with proposed spans; their texts are compared word by word."""
    texts = rows.select("doc_id", "key", "text").join(proposed.select("key").distinct(), "key", "left_semi")
    once = texts.groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    known = left_join(proposed, once, ["doc_id", "key"], null_keys=True).withColumn("words", words(F.col("text")))
    labels = F.array(*[F.lit(label) for label, *_ in TEMPLATES])
    scored = F.transform("spans", lambda s: F.struct(F.get(labels, s["template"]).alias("label"), coverage(s, F.col("words")).alias("score")))
    good = F.transform(F.filter("scored", lambda s: s["score"] >= COVERAGE), lambda s: s["label"])
    return known.withColumn("scored", scored).select(
        "doc_id", "key", F.array_distinct(good).alias("method_labels"), F.array_max(F.col("scored.score")).alias("best")
    )


def phrase_places(w: Column) -> dict[str, Column]:
    """For each label the start positions of its phrase."""
    out = {}
    for phrase, label in PHRASES.items():
        places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), _stands(w, phrase.split()))
        out[label] = F.when(F.array_contains(w, phrase.split()[0]), places).otherwise(F.array().cast("array<int>"))
    return out


def _stands(w: Column, phrase: list[str]):
    """A test of a position: do the words of ``phrase`` stand there?"""

    def test(i: Column) -> Column:
        found = F.lit(True)
        for j, word in enumerate(phrase):
            found = found & F.coalesce(F.get(w, i + j) == word, F.lit(False))
        return found

    return test


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, base places and labels, method labels and score of each document."""
    spark = documents.sparkSession
    keyed = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    rows = keyed.withColumn("words", words(F.col("text"))).drop("text")
    found = staged(hits(rows, template_positions(spark)).select("doc_id", "key", "pos", "at", "template"), "license_hits")
    per_document = verified(staged(proposals(found), "license_spans"), keyed)
    places = phrase_places(F.col("words"))
    base = (
        rows.withColumns({f"p_{k}": v for k, v in places.items()})
        .withColumn("places", F.concat(*[F.col(f"`p_{k}`") for k in places]))
        .withColumn(
            "base",
            F.filter(
                F.array(*[F.when(F.size(F.col(f"`p_{k}`")) > 0, F.lit(k)) for k in places]), lambda x: x.isNotNull()
            ),
        )
        .select(
            "doc_id",
            "key",
            F.size("words").cast("long").alias("n_words"),
            F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"),
            F.array_max("places").cast("long").alias("last_word"),
            "base",
        )
    )
    base = staged(base, "license_words")
    found = per_document.withColumnRenamed("doc_id", "found_id").withColumnRenamed("key", "found_key")
    same = (base["key"] == found["found_key"]) & base["doc_id"].eqNullSafe(found["found_id"])
    joined = base.join(found, same, "left")
    both = F.array_distinct(F.concat("base", F.coalesce("method_labels", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
