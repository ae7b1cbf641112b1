"""JSON lines with their file and line number, and files as whole values."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import map_rows

LINES = "src_file string, line_no long, raw string"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """src_file, line_no, raw of the non-blank lines of every *.jsonl (or part-*.txt of a sink) below path, for files of session size.

    A file is one value, so that line numbers are exact; a blank line keeps its number.
    """
    files = spark.read.option("pathGlobFilter", "*.{jsonl,txt}").option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("src_file"), "value")
    each = files.select("src_file", F.posexplode(F.split("value", "\r?\n")).alias("at", "raw"))
    return each.where(F.trim("raw") != "").select("src_file", (F.col("at") + 1).cast("long").alias("line_no"), "raw")


def read_large_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """As read_lines, for files of any size: files are split over tasks.

    line_no grows with a line's place in its file but counts no lines: tasks are
    dealt the blocks of a file in order, and ids grow within a task.
    """
    rows = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path, lineSep="\n")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # A block of a file has more bytes than lines, so that its first byte's place leaves room for all its lines.
    spot = F.col("_metadata.file_block_start") + within
    return rows.select(F.col("_metadata.file_path").alias("src_file"), spot.alias("line_no"), F.col("value").alias("raw")).where(F.trim("raw") != "")


def checked(lines: DataFrame) -> DataFrame:
    """lines; one that is not JSON fails the query when it is read."""
    bad = F.raise_error(F.concat(F.lit("not JSON: "), "src_file", F.lit(":"), F.col("line_no").cast("string")))
    return lines.withColumn("raw", F.when(F.try_parse_json("raw").isNotNull(), F.col("raw")).otherwise(bad))


def whole_files(spark: SparkSession, roots: list[str], glob: str) -> DataFrame:
    """path and content (binary) of each file below roots whose name fits."""
    found = [r for r in roots if "://" in r or os.path.isdir(r)]
    if not found:
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(found).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")


def parsed(files: DataFrame, make, opened=None) -> DataFrame:
    """src_file, line_no, raw of the conversations (JSON texts) that make(path, content) yields for each file; a file that cannot be read yields none.

    The content is the column of that name or, where it is set, opened(row): files
    that are made from rows need not pass from one Python worker to another.
    """

    def one(r: dict) -> list[dict]:
        content = opened(r) if opened else r["content"]
        try:
            return [{"src_file": r["path"], "line_no": i, "raw": raw} for i, raw in enumerate(make(r["path"], content), 1)]
        except Exception:  # noqa: BLE001 - one broken log must not end the scan of the others
            return []

    return map_rows(files if opened else files.select("path", "content"), one, LINES)
