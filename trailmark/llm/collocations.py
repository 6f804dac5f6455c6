"""Collocations: phrases of two to five words that stand together more often than their parts let expect.

Suffixes are pointers to word positions, cut off after five words and at the end of a piece. Tasks first bring their own equal
suffixes together, chunk by chunk. Suffixes are then routed by language and leading words, all of a leading pair to one place;
leading words with very many suffixes are routed by one word more, and by yet another where that is still too many. There a
multikey three-way quicksort parts the pointers word by word: the pointers equal to the pivot are one phrase, their number is its
count, and a part with fewer occurrences than asked for is abandoned together with all that it would have been parted into.

Two passes before leave out what cannot matter: a suffix is only taken where its leading pair, and goes only as far as all its
pairs, can be frequent. Pairs are counted by a hash for that, and which words and pairs can be frequent reaches the tasks as a
bitmap of hashes of at most 32 MB. A hash or a bit that two share costs work, and never changes a result: all phrases are counted by
their words in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import ASCII_UPPER

LEAST = 100
LONGEST = 5
TOP = 2000
CHUNK_BYTES = 6 << 20
SORT_ROWS = 1 << 18
LEAST_WIDE = 64
MAX_BITS = 28

_FROM = ASCII_UPPER + ".,;:!?\x0b\x0c\r\t"
_TO = ASCII_UPPER.lower() + "\n" * 9 + " "
_TABLE = bytes.maketrans(_FROM.encode(), _TO.encode())


# -- words of a chunk ---------------------------------------------------------------------------------------------


class Words:
    """The words of some texts: ``ids`` into ``names``, the piece that each belongs to, and a hash of each name."""

    def __init__(self, lang: str, texts: list[str]):
        data = np.frombuffer(b"\n".join([text.encode().translate(_TABLE) for text in texts]) + b"\n", np.uint8)
        ends_piece = data == 10
        in_word = ~(ends_piece | (data == 32))
        edges = np.flatnonzero(np.diff(in_word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        shown = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[in_word].tobytes())])
        coded = shown.dictionary_encode()
        self.names, self.ids = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
        self.piece = np.searchsorted(np.flatnonzero(ends_piece), starts)
        self.hashes = hashes(lang, self.names)

    def pairs(self, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that begin a pair of allowed words within a piece, and the hashes of these pairs."""
        fits = allowed[self.ids]
        at = np.flatnonzero(fits[:-1] & fits[1:] & (self.piece[:-1] == self.piece[1:]))
        return at, pair_hashes(self.hashes[self.ids[at]], self.hashes[self.ids[at + 1]])

    def phrases(self, rows: np.ndarray) -> pa.Array:
        """Rows of word ids, filled up with -1, as text."""
        held = rows >= 0
        offsets = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
        words = self.names.take(pa.array(rows[held]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), " ")


def hashes(lang: str, names: pa.Array) -> np.ndarray:
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(name, seed) for name in names.cast(pa.binary()).to_pylist()], np.uint64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + second
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def allowed(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; a bitmap has a power of two bits, in 64-bit words."""
    place = values & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, a bounded number of bytes at a time; a longer text comes whole."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size >= CHUNK_BYTES:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def _rows(lang: str, phrases: pa.Array, n: np.ndarray, step: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(phrases), step):
        part = phrases.slice(i, step)
        yield pa.record_batch({"lang": pa.array([lang] * len(part), pa.string()), "phrase": part, "n": pa.array(n[i : i + step].astype(np.int64))})


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _texts(batches):
        words = Words(lang, texts)
        yield from _rows(lang, words.names, np.bincount(words.ids, minlength=len(words.names)))


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        own = np.zeros(batch.num_rows, np.uint64)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            here = langs.indices.to_numpy() == code
            own[here] = hashes(lang, batch.column("phrase").filter(pa.array(here)))
        yield pa.record_batch({"hash": pa.array(own.view(np.int64))})


def _pair_rows(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    for lang, texts in _texts(batches):
        words = Words(lang, texts)
        _, own = words.pairs(allowed(frequent.value, words.hashes))
        distinct, n = np.unique(own, return_counts=True)
        for i in range(0, len(distinct), 1 << 16):
            j = i + (1 << 16)
            yield pa.record_batch({"hash": pa.array(distinct[i:j].view(np.int64)), "n": pa.array(n[i:j].astype(np.int64))})


def suffixes(words: Words, begins: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of at least two words and how often each occurs; ``begins`` are the positions of frequent pairs."""
    runs = np.zeros(len(words.ids) + longest, bool)
    runs[begins] = True
    at = begins
    rows = np.full((len(at), longest), -1, np.int64)
    rows[:, 0] = words.ids[at]
    goes_on = np.ones(len(at), bool)
    for k in range(1, longest):
        goes_on &= runs[at + k - 1]
        rows[goes_on, k] = words.ids[at[goes_on] + k]
    width = len(words.names) + 1
    keys = [rows[:, k] + 1 if k + 1 == longest else (rows[:, k] + 1) * width + rows[:, k + 1] + 1 for k in range(0, longest, 2)]
    order = np.lexsort(keys[::-1])
    rows = rows[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    heads = np.flatnonzero(first)
    return rows[heads], np.diff(np.append(heads, len(rows)))


def _suffix_rows(batches: Iterator[pa.RecordBatch], words_bits, pair_bits, longest: int) -> Iterator[pa.RecordBatch]:
    for lang, texts in _texts(batches):
        words = Words(lang, texts)
        at, own = words.pairs(allowed(words_bits.value, words.hashes))
        rows, n = suffixes(words, at[allowed(pair_bits.value, own)], longest)
        for i in range(0, len(rows), 1 << 16):
            yield from _rows(lang, words.phrases(rows[i : i + (1 << 16)]), n[i : i + (1 << 16)])


# -- sorting ------------------------------------------------------------------------------------------------------


def frequent_prefixes(columns: list[np.ndarray], weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of pointers to rows of ``columns`` (-1: the row has ended).

    Gives (a pointer, depth, count) of each prefix that occurs ``least`` times or more. Only parts that can hold such a prefix
    are sorted on.
    """
    waiting = [(np.arange(len(weight)), 0)]
    while waiting:
        part, depth = waiting.pop()
        if weight[part].sum() < least:
            continue
        keys = columns[depth][part]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        equal = part[keys == pivot]
        if len(equal) < len(part):
            waiting += [(part[keys < pivot], depth), (part[keys > pivot], depth)]
        if pivot >= 0 and (count := int(weight[equal].sum())) >= least:
            yield int(equal[0]), depth + 1, count
            if depth + 1 < len(columns):
                waiting.append((equal, depth + 1))


def sort_counts(table: pa.Table, least: int, longest: int) -> pa.RecordBatch:
    """``lang, phrase, n`` of the frequent prefixes of suffixes (``lang, depth, phrase, n``), of ``depth`` words or more."""
    langs, phrases, counts = [], [], []
    for depth in pc.unique(table.column("depth")).to_pylist():
        some = table.filter(pc.equal(table.column("depth"), depth)).combine_chunks()
        split = pc.split_pattern(some.column("phrase").combine_chunks(), " ")
        ids = split.flatten().dictionary_encode().indices.to_numpy()
        begins, sizes = split.offsets.to_numpy()[:-1], pc.list_value_length(split).to_numpy()
        begins = begins - begins[:1]
        columns = [some.column("lang").combine_chunks().dictionary_encode().indices.to_numpy()]
        for k in range(longest):
            column = np.full(len(some), -1, np.int64)
            column[sizes > k] = ids[begins[sizes > k] + k]
            columns.append(column)
        lang, text = some.column("lang"), some.column("phrase")
        for row, words, count in frequent_prefixes(columns, some.column("n").to_numpy(), least):
            if words > depth:  # the language is a word too
                langs.append(lang[row].as_py())
                phrases.append(" ".join(text[row].as_py().split(" ")[: words - 1]))
                counts.append(count)
    return pa.record_batch({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "n": pa.array(counts, pa.int64())})


def _sorted_parts(batches: Iterator[pa.RecordBatch], least: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Counts out of a partition whose rows are sorted by (depth, route); whole routes, some at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < SORT_ROWS:
            continue
        table = pa.Table.from_batches(held)
        route = [table.column(c) for c in ("lang", "depth", "route")]
        same = np.ones(len(table), bool)
        for column in route:
            same &= pc.equal(column, column[len(table) - 1]).to_numpy()
        until = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if until:
            yield sort_counts(table.slice(0, until), least, longest)
            held = table.slice(until).to_batches()
    if held:
        yield sort_counts(pa.Table.from_batches(held), least, longest)


# -- the operator -------------------------------------------------------------------------------------------------


def _bitmap(table: DataFrame):
    """The hashes of a table as a broadcast bitmap: 16 bits or more for each, up to 2^28 bits."""
    rows = table.count()
    width = 1 << min(MAX_BITS, max(10, (16 * rows).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(width - 1))
    words = table.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(hash & 63 AS int))")).alias("bits"))
    found = words.toArrow()  # at most 2^22 rows
    bits = np.zeros(width // 64, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table.sparkSession.sparkContext.broadcast(bits)


def _first_words(count: int | Column) -> Column:
    return F.substring_index("phrase", " ", count) if isinstance(count, int) else F.call_function("substring_index", "phrase", F.lit(" "), count)


def _size(phrase: str = "phrase") -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1


def _long_phrases(found: DataFrame, least: int, longest: int, least_wide: int = LEAST_WIDE) -> DataFrame:
    """Frequent phrases of two words and more, from distinct suffixes of chunks (``lang, phrase, n``, stored).

    The suffixes of one leading pair go to one place, unless they are very many: a 2,000th of all, or 262,144. These are told by
    a count before, which gives the counts of their leading words too.
    """
    limit = max(least_wide, min(SORT_ROWS, found.count() // 2000))
    routed, known = found.withColumn("depth", F.lit(2)), []
    rest = found
    for k in range(2, longest + 1):
        groups = rest.where(_size() >= k).groupBy("lang", _first_words(k).alias("route")).agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
        wide = materialize(groups.where(F.col("rows") > limit).select("lang", "route", "n"), "wide")
        if wide.isEmpty():
            break
        known.append(wide.where(F.col("n") >= least).select("lang", F.col("route").alias("phrase"), "n"))
        marks = wide.select("lang", "route", F.lit(k).alias("at"))
        deeper = F.when((F.col("depth") == k) & F.col("at").isNotNull(), k + 1).otherwise(F.col("depth")).alias("depth")
        routed = routed.withColumn("route", _first_words(k)).join(marks, ["lang", "route"], "left").select("lang", "phrase", "n", deeper)
        rest = rest.withColumn("route", _first_words(k)).join(wide.select("lang", "route"), ["lang", "route"], "left_semi").drop("route")
    by_route = (
        routed.where((F.col("depth") <= longest) & (_size() >= F.col("depth")))
        .withColumn("route", _first_words(F.col("depth")))
        .repartition("lang", "depth", "route")
        .sortWithinPartitions("lang", "depth", "route")
    )
    counted = by_route.mapInArrow(lambda batches: _sorted_parts(batches, least, longest), "lang string, phrase string, n long")
    for some in known:
        counted = counted.unionByName(some)
    return counted.where(_size() >= 2)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: ``lang, phrase, n`` of all phrases of up to ``longest`` words that occur ``least`` times or more
    (one word: all), and ``lang, n``, the words of a language."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shape = "lang string, phrase string, n long"
    total = F.sum("n").alias("n")
    words = materialize(texts.mapInArrow(_word_rows, shape).groupBy("lang", "phrase").agg(total), "words")
    sizes = words.groupBy("lang").agg(total)
    words = words.where(F.col("n") >= least)
    word_bits = _bitmap(words.mapInArrow(_word_hashes, "hash long"))
    pairs = texts.mapInArrow(lambda b: _pair_rows(b, word_bits), "hash long, n long").groupBy("hash").agg(total)
    pair_bits = _bitmap(materialize(pairs.where(F.col("n") >= least).select("hash"), "pairs"))
    found = materialize(texts.mapInArrow(lambda b: _suffix_rows(b, word_bits, pair_bits, longest), shape), "suffixes")
    every = materialize(words.unionByName(_long_phrases(found, least, longest)), "phrases")
    for spread in (word_bits, pair_bits):
        spread.destroy()
    return every, sizes


def score() -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    return F.expr("cast(1000 * a AS decimal(22, 0)) * cast(n AS decimal(16, 0)) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0)))")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` collocations of each language of ``docs``.

    Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and these into words at blanks and tabs; a
    null ``lang`` counts as ``und``. A phrase of two to ``longest`` words that occurs ``a >= least`` times is a candidate; of
    its cuts into ``l`` and ``r`` occurrences the one with the lowest floor(1000 a n / (l r)) counts, ties to the shorter first
    part. Candidates inside a longer one as frequent as they are go. Repeated rows count each; null and empty texts have no
    words; other columns don't matter; no rows give no rows.
    """
    every, sizes = phrase_counts(docs, least, longest)
    candidates = every.withColumn("words", _size()).where("words >= 2").withColumnRenamed("n", "a")
    # a longer candidate that is as frequent has one of one word more between, which is so too
    shorter = F.explode(F.array(_first_words(F.col("words") - 1), F.call_function("substring_index", "phrase", F.lit(" "), 1 - F.col("words"))))
    inside = candidates.where("words >= 3").select("lang", shorter.alias("phrase"), "a").distinct()
    kept = candidates.join(inside, ["lang", "phrase", "a"], "left_anti")
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {"first": _first_words(F.col("k")), "rest": F.call_function("substring_index", "phrase", F.lit(" "), F.col("k") - F.col("words"))}
    )
    left, right = (every.select("lang", F.col("phrase").alias(name), F.col("n").alias(count)) for name, count in (("first", "l"), ("rest", "r")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("lowest")
    scored = (
        cut.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .join(sizes, "lang")
        .withColumn("score", score())
        .groupBy("lang", "phrase", "a", "n")
        .agg(lowest)
        .select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
