"""Text files in any file system that Spark reaches: lines, small reports, digests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a file that is digested as one value.
LARGE = 1 << 30


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def write_lines(rows: DataFrame, path: str, order: list[str], mode: str = "error") -> None:
    """Lines (column value) in the given order, as part files whose names follow it; ready or not there at all (the commit protocol's marker)."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode(mode).text(path)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    where, fs = _path(spark, path)
    fs.create(where, True).close()


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """A small report as one JSON file, put in place by a rename."""
    where, fs = _path(spark, path)
    half, _ = _path(spark, path + ".part")
    with_bytes = fs.create(half, True)
    with_bytes.write(bytearray((json.dumps(report, ensure_ascii=False, indent=2) + "\n").encode()))
    with_bytes.close()
    fs.delete(where, False)
    if not fs.rename(half, where):
        raise OSError(f"cannot put {path} in place")


def read_report(spark: SparkSession, path: str) -> dict:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def digests(spark: SparkSession, path: str) -> dict[str, dict]:
    """sha256, bytes and rows of each file below path.

    Texts stay on the executors; a file of more than `LARGE` bytes, which is too
    large for one value, is read by the driver as a stream.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    lines = F.length("content") - F.length(F.replace(F.col("content").cast("string"), F.lit("\n"), F.lit("")).cast("binary"))
    large = [r[0] for r in files.where(F.col("length") > LARGE).select("path").collect()]
    rows = files.where(F.col("length") <= LARGE).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), lines.cast("long").alias("rows")).orderBy("name").collect()
    out = {r["name"]: {"sha256": r["sha256"], "bytes": r["bytes"], "rows": r["rows"]} for r in rows}
    for name in large:
        where, fs = _path(spark, name)
        stream = fs.open(where)
        try:
            digest = spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
        out[name.rpartition("/")[2]] = {"sha256": digest, "bytes": fs.getFileStatus(where).getLen(), "rows": spark.read.text(name).count()}
    return dict(sorted(out.items()))
