"""Date-partitioned CSV exports whose headers may differ from file to file.

Spark applies one header to all files of a read, which would shift the columns of the others. So the headers are
looked up first (one small read per file, spread over the executors), files are grouped by header, each group is
read with its own schema, and the groups are unioned by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import CANONICAL, blank_to_null, squeeze
from . import split_csv

_HEADER_CHUNK = 1 << 16
_LISTED = "path string, length long, modified timestamp"
_BASE_NAME = r"([^/]+)$"
_FOLDER_NAME = r"(?:[^/=]+=)?([^/]+)/[^/]+$"
# file systems that the executors can open without Spark, by URI scheme
_DIRECT = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def source_of(path: Column, lineage: str) -> Column:
    """The source that a file belongs to: its own name, or with lineage ``folder`` that of its folder."""
    pattern = {"file": _BASE_NAME, "folder": _FOLDER_NAME}[lineage]
    return F.regexp_extract(path, pattern, 1)


def _plain_path(uri: Column) -> Column:
    """The listed form of a path that the scan metadata show URI-encoded."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _peek(files: DataFrame) -> DataFrame:
    """First record of each file; only as much is read as it takes to complete it.

    The functions are local so that they travel to the executors by value; they need not have this package.
    """
    schemes, size = dict(_DIRECT), _HEADER_CHUNK

    def first_record(stream) -> str:
        import codecs

        decode, text = codecs.getincrementaldecoder("utf-8-sig")("replace").decode, ""
        while chunk := stream.read(size):
            at = len(text)
            text += decode(chunk)
            while (at := text.find("\n", at)) >= 0:
                at += 1
                if text.count('"', 0, at) % 2 == 0:
                    return text[:at]
        return text

    def first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        from pyarrow import fs

        for batch in batches:
            headers = []
            for path in batch["path"]:
                scheme, rest = path.split(":", 1)
                if scheme == "file":
                    system, inner = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    system, inner = fs.FileSystem.from_uri(f"{schemes[scheme]}:{rest}")
                with system.open_input_stream(inner, compression="detect") as stream:
                    head = first_record(stream)
                csv.field_size_limit(max(csv.field_size_limit(), len(head)))
                headers.append(next(csv.reader(io.StringIO(head)), []))
            yield batch.assign(header=headers)

    return files.mapInPandas(first_records, f"{_LISTED}, header array<string>")


def _scan(files: DataFrame, pattern: str | list[str]) -> DataFrame:
    """First line of each file by a text scan, for file systems that only Spark can open."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        for batch in batches:
            headers = [next(csv.reader([(line or "").lstrip("\ufeff")]), []) for line in batch["line"]]
            yield batch.drop(columns="line").assign(header=headers)

    lines = files.sparkSession.read.option("recursiveFileLookup", True).text(pattern)
    first = (
        lines.select(
            _plain_path(F.col("_metadata.file_path")).alias("path"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
            "value",
        )
        .groupBy("path")
        .agg(F.min_by("value", "place").alias("line"))
    )
    return files.join(first, "path", "left").mapInPandas(split, f"{_LISTED}, header array<string>")


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, length, modified`` of every file that the pattern matches; no file is opened. No match at all raises."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def header_catalog(spark: SparkSession, pattern: str, lineage: str = "file", direct: bool | None = None) -> DataFrame:
    """One row per file: path, length, modified, source_file, header (as written) and columns (trimmed, lower case).

    ``lineage`` names the source after the file or, where a day is a folder of part files, after the folder.
    Every file that the pattern matches counts as CSV, compressed or not as its ending says. Only the listing and the first
    record of each file are read, unless the file system needs a scan by Spark (``direct`` overrides the choice). An empty
    listing raises.
    """
    return headers_of(listing(spark, pattern), pattern, lineage, direct)


def headers_of(files: DataFrame, pattern: str | list[str], lineage: str = "file", direct: bool | None = None) -> DataFrame:
    """``header_catalog`` of listed files; ``pattern`` is what a scan by Spark reads to see their first lines."""
    if direct is None:
        any_path = files.head()
        direct = any_path is None or any_path["path"].split(":", 1)[0] in _DIRECT
    headers = _peek(files) if direct else _scan(files, pattern)
    return headers.select(
        "path",
        "length",
        "modified",
        source_of(F.col("path"), lineage).alias("source_file"),
        "header",
        F.transform("header", lambda name: F.lower(F.trim(name))).alias("columns"),
    )


def file_schemas(catalog: DataFrame) -> DataFrame:
    """One row per source: the columns seen in it and whether ``referrer`` is among them."""
    return (
        catalog.select("source_file", F.explode_outer("columns").alias("column"))
        .groupBy("source_file")
        .agg(F.array_sort(F.collect_set("column")).alias("columns"))
        .withColumn("has_referrer", F.array_contains("columns", "referrer"))
    )


def _canonical_columns(header: list[str]) -> dict[str, Column]:
    """Canonical name -> first non-missing value among the columns spelled like it."""
    raw = [blank_to_null(F.col(f"c{position}")) for position in range(len(header))]
    found: dict[str, list[Column]] = {}
    for position, name in enumerate(header):
        clean = name.strip().lower()
        found.setdefault(CANONICAL.get(squeeze(clean), clean), []).append(raw[position])
    return {name: F.coalesce(*columns) for name, columns in found.items() if name}


def read_header_group(
    spark: SparkSession, paths: list[str], header: list[str], lineage: str = "file", multiline: bool = True
) -> DataFrame:
    """All files with one header: canonical names, every column text, plus lineage."""
    places = [f"c{position}" for position in range(len(header))]
    # Spark warns about each file whose header differs from the schema, so the header's names are used if they can be
    usable = all(header) and len({name.lower() for name in header}) == len(header)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (header if usable else places)])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(paths)
    )
    placed = rows.select(_plain_path(F.col("_metadata.file_path")), "*").toDF("path", *places)
    return _named(placed, header, lineage)


def read_large_group(spark: SparkSession, paths: list[str], header: list[str], lineage: str = "file", first: int = 0) -> DataFrame:
    """As ``read_header_group``, for files that are much larger than a split: each is read by many tasks, line breaks or not.

    ``_place`` numbers the rows in the order of the files, from number ``first`` on, and of their rows.
    """
    schema = ", ".join(f"c{position} string" for position in range(len(header)))
    found = split_csv.records(spark, paths, _plain_path(F.col("_metadata.file_path")), first)
    rows = found.select("path", F.col("place").alias("_place"), F.from_csv("text", schema, {"escape": '"'}).alias("row"))
    return _named(rows.select("path", "row.*", "_place"), header, lineage, "_place")


def _named(rows: DataFrame, header: list[str], lineage: str, *others: str) -> DataFrame:
    """Columns ``c0, c1, ...`` under their canonical names, with the lineage of ``path``."""
    seen = [name.strip().lower() for name in header]
    return rows.select(
        source_of(F.col("path"), lineage).alias("source_file"),
        *[column.alias(name) for name, column in _canonical_columns(header).items()],
        F.lit("referrer" not in seen).alias("source_file_referrer_missing"),
        *others,
    )


def union_by_header(groups: list[DataFrame]) -> DataFrame:
    """Union by name; a canonical column that no group has becomes NULL."""
    if not groups:
        raise FileNotFoundError("no event files with a header")
    union = groups[0]
    for group in groups[1:]:
        union = union.unionByName(group, allowMissingColumns=True)
    absent = {name: F.lit(None).cast("string") for name in CANONICAL.values() if name not in union.columns}
    # numbered after the union, so that numbers are unique; rows of a file keep their order
    number = F.monotonically_increasing_id()
    if "_place" in union.columns:  # such rows are below all others
        number = F.coalesce(F.col("_place") - F.lit(1 << 62), number)
    return union.withColumns({**absent, "row_seq": number}).drop("_place")


def files_with_broken_records(spark: SparkSession, paths: list[str]) -> set[str]:
    """The files in which a quoted text holds a line break: some line of theirs has an odd number of quotes.

    A pass over the lines, split as Spark likes; quotes inside quoted texts are doubled, so they don't change the parity.
    """
    lines = spark.read.text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    found = lines.where(quotes % 2 == 1).select(_plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
    return {row["path"] for row in found.collect()}  # at most as many rows as files


def read_events(
    spark: SparkSession,
    pattern: str,
    lineage: str = "file",
    multiline: bool | None = None,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Raw events of all files, whatever their headers.

    Files of up to one split are read as a whole by one task, line breaks in quoted texts included, several small ones by the
    same task. Larger ones are read by many tasks (see ``split_csv``), unless they are compressed. ``multiline`` says that all
    files are to be read as a whole, or that no quoted text holds a line break. ``row_seq`` follows the order within each file.
    ``catalog`` is a stored ``header_catalog`` of the same pattern.
    """
    catalog = header_catalog(spark, pattern, lineage) if catalog is None else catalog
    large = F.lit(False)
    if multiline is None:
        packed = F.lower("path").rlike(r"\.(" + "|".join(ending[1:] for ending in split_csv.COMPRESSED) + ")$")
        large = (F.col("length") > split_csv.split_size(spark)) & ~packed
    # as many rows as distinct headers, twice
    by_header = catalog.where(F.size("header") > 0).groupBy("header", large.alias("large")).agg(F.sort_array(F.collect_list("path")).alias("paths"))
    parts, n_large = [], 0
    for row in sorted(by_header.collect(), key=lambda row: (row["header"], row["large"])):
        if row["large"]:
            parts.append(read_large_group(spark, row["paths"], row["header"], lineage, n_large))
            n_large += len(row["paths"])
        else:
            parts.append(read_header_group(spark, row["paths"], row["header"], lineage, multiline is not False))
    return union_by_header(parts)
