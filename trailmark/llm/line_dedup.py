"""Repeated runs of lines, by a suffix array over line numbers and distributed prefix doubling; DataFrame expressions only.

Every line that occurs twice gets its rank among the distinct repeated lines; a suffix is the sequence of ranks from a line to
the end of its document. Doubling: the rank of a suffix by its first 2h lines is the rank of the pair (rank by h lines here,
rank by h lines h lines further on) among all distinct pairs. Suffixes of one rank are one interval of the suffix array whose
longest common prefix is at least that long; suffixes alone in their interval leave the search. Distinct pairs are counted
before they are sorted, so a line that makes up a third of all rows is one row there.

What goes: in an interval of long enough runs, all occurrences but the first in corpus order. Overlapping runs join, so
maximal repeated runs disappear as a whole. Runs whose length is no power of two are two overlapping windows of the largest
power of two below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import whole_text

RUN_LINES = 4
LINE_WORDS = 6

_KEY = ["doc_id", "text_hash"]


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\f\v"))


def _place() -> Column:
    """Corpus order as one number: document, then (for unlike rows of one ``doc_id``) hash of the text, then line."""
    wide = lambda c: c.cast("decimal(38,0)")
    billion = 1_000_000_000
    return wide(F.coalesce("doc_id", F.lit(-(2**63)))) * F.lit(10**18).cast("decimal(19,0)") + wide(
        F.pmod("text_hash", F.lit(billion)) * billion + F.col("seq")
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Every line, blank ones aside, that occurs at more than one place: ``doc_id, text_hash, seq, at, words, place, first, rank``.

    ``seq`` counts a document's lines without blank ones; ``at`` is the suffix so far, an array of ``(seq, line)`` with lines
    from 1. Lines are compared without the white space around them, by 128 bits of hash. Rows alike in ``doc_id`` and text are
    taken once: their lines have one place.
    """
    bare = F.transform(_split(F.col("text")), lambda x, i: F.struct((i + 1).alias("line"), _bare(x).alias("bare")))
    lines = (
        whole_text(docs)
        .withColumn("text_hash", F.xxhash64("text"))
        .dropDuplicates(_KEY)
        .select(*_KEY, F.posexplode(F.filter(bare, lambda x: x["bare"] != "")).alias("seq", "x"))
        .select(
            *_KEY,
            "seq",
            "x.line",
            (F.regexp_count("x.bare", F.lit(r"\s+")) + 1).alias("words"),
            F.xxhash64("x.bare").alias("k1"),
            F.xxhash64(F.lit(7), "x.bare").alias("k2"),
        )
        .withColumn("place", _place())
    )
    ranked = _ranked(materialize(lines, "lines"), ["k1", "k2"], "repeated_lines")
    return ranked.select("*", F.array(F.struct("seq", "line")).alias("at")).drop("line")


def _ranked(suffixes: DataFrame, by: list[str], name: str) -> DataFrame:
    """The suffixes whose ``by`` occurs more than once, with its ``rank`` (in the order of ``by``) and ``first`` place."""
    ranks = materialize(
        suffixes.groupBy(*by)
        .agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .where("n > 1")
        .orderBy(*by)
        .select(*by, "first", F.monotonically_increasing_id().alias("rank")),
        f"{name}_ranks",
    )
    return materialize(suffixes.join(ranks, by).drop(*by), name)


def _widened(suffixes: DataFrame, length: int, by: int) -> DataFrame:
    """Suffixes ranked by ``length`` lines, ranked by up to ``length`` more; no rank there means no repeated run that long."""
    ahead = Window.partitionBy(*_KEY).orderBy("seq").rangeBetween(by, by)
    pairs = (
        suffixes.withColumn("beyond", F.max("rank").over(ahead))
        .withColumn("at", F.concat("at", F.max("at").over(ahead)))
        .where("beyond IS NOT NULL")
    )
    return _ranked(pairs.drop("first").withColumnRenamed("rank", "here"), ["here", "beyond"], f"runs_{length + by}")


def removed_lines(docs: DataFrame, run_lines: int = RUN_LINES, line_words: int = LINE_WORDS) -> DataFrame:
    """``doc_id, text_hash, lost``: the lines to delete as ``(seq, line)`` in order, for documents that have any."""
    ranked = repeated_lines(docs)
    later = F.col("place") > F.col("first")
    gone = ranked.where(later & (F.col("words") >= line_words)).select(*_KEY, F.explode("at").alias("lost"))
    length = 1
    while length < run_lines:
        by = min(length, run_lines - length)
        ranked, length = _widened(ranked, length, by), length + by
    runs = ranked.where(later).select(*_KEY, F.explode("at").alias("lost"))
    return gone.unionByName(runs).groupBy(*_KEY).agg(F.sort_array(F.collect_set("lost")).alias("lost"))


def dedup_lines(docs: DataFrame, run_lines: int = RUN_LINES, line_words: int = LINE_WORDS) -> DataFrame:
    """Every row of ``docs`` with later copies of repeated runs deleted from its text; all its columns stay.

    A run is deleted if it has at least ``run_lines`` lines, and a line by itself if it has at least ``line_words`` words. Adds
    ``n_lines`` (blank ones not counted), ``n_removed`` and ``n_runs`` (maximal deleted runs); columns of those names are
    replaced. Rows alike in ``doc_id`` and text are one document and come out alike; unlike rows of one ``doc_id`` are ordered
    by hash; a null ``doc_id`` comes first. Null texts stay null, blank lines and white space are never deleted, and a text
    that loses all its lines becomes empty (or blank).
    """
    gone = removed_lines(docs, run_lines, line_words).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), F.col("lost")
    )
    added = ("n_lines", "n_removed", "n_runs")
    own = docs.select(
        F.struct(*[c for c in docs.columns if c not in ("text", *added)]).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_hash"),
        F.col("text").alias("own_text"),
        _split(F.col("text")).alias("lines"),
    )
    joined = own.join(gone, F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_hash") == F.col("gone_hash")), "left")
    left = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.transform("lost", lambda x: x["line"]))
    kept = F.array_join(F.transform(left, lambda i: F.element_at("lines", i)), "\n")
    runs = F.size(F.array_except(F.transform("lost", lambda x: x["seq"]), F.transform("lost", lambda x: x["seq"] + 1)))
    none, count = F.col("lost").isNull(), lambda c: c.cast("long")
    return joined.select(
        *[
            F.when(none, F.col("own_text")).otherwise(kept).alias("text") if c == "text" else F.col("row")[c].alias(c)
            for c in docs.columns
            if c not in added
        ],
        count(F.when(F.col("own_text").isNull(), 0).otherwise(F.size(F.filter("lines", lambda line: _bare(line) != "")))).alias("n_lines"),
        count(F.when(none, 0).otherwise(F.size("lost"))).alias("n_removed"),
        count(F.when(none, 0).otherwise(runs)).alias("n_runs"),
    )
