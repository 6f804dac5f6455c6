"""Licence scan with ordered signature rules, as DataFrame expressions only.

A text becomes its words in lower case, each with a blank on either side (``" mit  license "``), so that a pattern can only
match whole words and neighbouring matches share no blank. Only rules whose keyword is among the words are tried. Detections
that lie within one of higher priority, or within a longer one of the same, are suppressed; ties go to the earlier rule.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import whole_text
from .license_rules import CONFIDENCE, Rule, rules

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RULE = "array<struct<number:int,label:string,keyword:string,pattern:string,priority:int,base:boolean>>"


def spaced(pattern: str) -> str:
    """A pattern over single blanks, for words that have a blank on either side each."""
    return " " + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def normal_words(text: Column) -> Column:
    """The words, single blanks between. ``lower`` also lowers other alphabets, which no word border depends on."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def detections(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """One row per match: ``doc_id, text_hash, number, label, priority, base, start, end, suppressed``; words from 0, end exclusive.

    Rows that are alike in ``doc_id`` and text are scanned once. Null and empty texts, and texts without a keyword, give no
    rows. A null ``doc_id`` is a value like others.
    """
    signatures = rules() if signatures is None else signatures
    table = json.dumps([rule._asdict() | {"pattern": spaced(rule.pattern)} for rule in signatures])
    keywords = F.array(*[F.lit(word) for word in sorted({rule.keyword for rule in signatures})])
    words = F.split(F.col("words"), " ")
    gated = (
        whole_text(docs)
        .select("doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("words"))
        .where(F.arrays_overlap(words, keywords))
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", F.array_intersect(words, keywords).alias("found"), F.concat(F.lit(" "), F.replace("words", F.lit(" "), F.lit("  ")), F.lit(" ")).alias("words"))
    )
    tried = gated.select(
        "doc_id", "text_hash", "words", F.explode(F.filter(F.from_json(F.lit(table), _RULE), lambda rule: F.array_contains("found", rule["keyword"]))).alias("rule")
    ).where(F.rlike("words", F.col("rule.pattern")))
    # text between matches, and the matches: blanks are two a word
    parts = F.transform(
        F.arrays_zip(F.split("words", F.col("rule.pattern"), -1).alias("gap"), F.regexp_extract_all("words", F.col("rule.pattern"), F.lit(0)).alias("hit")),
        lambda part: F.struct((_blanks(part["gap"]) / 2).cast("long").alias("gap"), (_blanks(part["hit"]) / 2).cast("long").alias("hit")),
    )
    places = tried.select("doc_id", "text_hash", "rule.*", F.posexplode(parts).alias("at", "part")).where("part.hit IS NOT NULL")
    run = Window.partitionBy("doc_id", "text_hash", "number").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = places.withColumn("end", F.sum(F.col("part.gap") + F.col("part.hit")).over(run)).withColumn("start", F.col("end") - F.col("part.hit"))
    before = (
        Window.partitionBy("doc_id", "text_hash")
        .orderBy("start", F.desc("end"), F.desc("priority"), "number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = None
    for level in sorted(CONFIDENCE):
        covered = F.max(F.when(F.col("priority") >= level, F.col("end"))).over(before)
        reach = F.when(F.col("priority") == level, covered) if reach is None else reach.when(F.col("priority") == level, covered)
    return placed.withColumn("reach", reach).select(
        "doc_id", "text_hash", "number", "label", "priority", "base", "start", "end", (F.coalesce("reach", F.lit(-1)) >= F.col("end")).alias("suppressed")
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: number of words, places of the base phrases, labels and a score.

    Base phrases count at all their places, suppressed or not, and their labels always stay. The score is the confidence of
    the best detection left, 0 without any. Null and empty texts have no words, no labels and score 0.
    """
    label, kept = F.col("label"), ~F.col("suppressed")
    confidence = F.lit(0.0)
    for priority, value in CONFIDENCE.items():
        confidence = F.when(F.col("priority") == priority, value).otherwise(confidence)
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    found = (
        detections(docs)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
            F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
            joined(F.collect_set(F.when(F.col("base"), label))).alias("base_labels"),
            joined(F.collect_set(F.when(F.col("base") | kept, label))).alias("labels"),
            F.max(F.when(kept, confidence)).alias("score"),
        )
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
    own = whole_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("words"))
    counted = own.select("doc_id", "text_hash", F.when(F.col("words") == "", 0).otherwise(_blanks(F.col("words")) + 1).cast("long").alias("n_words"))
    return counted.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
