"""Tables in the folder that driver and executors share: they cut lineage and outlive a lost executor."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_TABLES: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or "file://" + os.path.join(tempfile.gettempdir(), "loomspan-tables")).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _TABLES:
        atexit.register(drop)
    _TABLES.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop() -> None:
    """Delete the tables that stored() has written; results that still read them must be written before."""
    while _TABLES:
        spark, path = _TABLES.pop()
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may have ended; the folder is scratch space
            return
