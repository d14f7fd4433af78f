"""Readers. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the line that separates texts in a corpus file
CORPUS_MARK = "<<<<<<<<<<NEW>>>>>>>>>>"

# fixed values: field names of the side files
SEGMENT_SCHEMA = "speech_segments array<struct<start_time: double, end_time: double>>"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan_csv(
    spark: SparkSession, path: str, schema: str, sep: str = ",", null: str = "", header: bool = True,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited text with a declared schema; ``null`` is the text that means missing."""
    reader = spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    return reader.csv(path, sep=sep, header=header, nullValue=null, encoding=encoding, escape='"')


def scan_headerless(spark: SparkSession, path: str, width: int, positions: Mapping[int, str], sep: str = ",") -> DataFrame:
    """Columns of a file without header by 0-based position, as text, renamed."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    raw = spark.read.csv(path, schema=schema, sep=sep, escape='"')
    return raw.select(*[F.col(f"_c{i}").alias(n) for i, n in positions.items()])


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines, blank ones dropped: (file, block, row, line).

    (block, row) orders the lines of a file: the place of the split they were read
    from, then the number inside it. Splits are read in parallel.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("line"),
    )
    return raw.where(F.length("line") > 0)


def scan_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Word boxes of scanned pages, blank-separated: file, block, row, page, x0, y0, x1, y1, word.

    Empty files give no rows; short lines are dropped.
    """
    parts = F.split("line", r"\s+")
    numbers = [parts[i].try_cast("double").alias(n) for i, n in enumerate(["page", "x0", "y0", "x1", "y1"])]
    rows = scan_lines(spark, path).where(F.size(parts) >= 6)
    return rows.select("file", "block", "row", *numbers, parts[5].alias("word"))


def split_corpus(
    spark: SparkSession, path: str, mark: str = CORPUS_MARK, label_pattern: str = r"([^/]+)\.txt$"
) -> DataFrame:
    """Texts of corpus files split at the marker: (label, text), label from the file path.

    The marker is the line separator of the scan, so one large file is split
    between tasks like any text file.
    """
    raw = spark.read.option("lineSep", mark).option("recursiveFileLookup", True).text(path)
    label = F.regexp_extract("_metadata.file_path", label_pattern, 1)
    return raw.select(label.alias("label"), F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("text"))


def json_segments(spark: SparkSession, path: str, id_pattern: str = r"([^/]+)\.json$") -> DataFrame:
    """Segments of JSON side files: (file_id, start, end) in seconds, file_id from the file path."""
    raw = spark.read.schema(SEGMENT_SCHEMA).option("recursiveFileLookup", True).json(path, multiLine=True)
    stem = F.regexp_extract("_metadata.file_path", id_pattern, 1)
    return raw.select(stem.alias("file_id"), F.inline("speech_segments")).toDF("file_id", "start", "end")


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Stems of the files with a suffix, found without reading their content: (stem, path, length)."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)
    stem = F.regexp_extract("path", r"([^/]+)" + suffix.replace(".", r"\.") + "$", 1)
    return listed.select(stem.alias("stem"), "path", "length")


def labelled_images(spark: SparkSession, path: str) -> DataFrame:
    """Images of ``<path>/<label>/*`` with their label; unreadable files are skipped."""
    images = spark.read.format("image").option("dropInvalid", True).load(f"{path}/*")
    return images.select(F.element_at(F.split("image.origin", "/"), -2).alias("label"), "image")
