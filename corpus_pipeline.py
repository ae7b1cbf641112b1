"""A pipeline over documents: toxicity, near-duplicates, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it
kept and returns the columns of documents, but for the last, which returns the
ids.  run() writes what a stage returns as Parquet in the shared folder and
rereads it for the next one.

Defined results: documents that are rejected go, all others stay as they are,
except that secrets in a text are replaced by a mark and n_chars follows; a null
text stays null and is clean; rows that repeat a doc_id and its text are copies
of each other, of which one stays; rows that share a doc_id with different texts
are documents of their own; rows without a doc_id are judged by text
alone and none of them is another's copy; an empty table passes as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import bpe, decontaminate, neardup, secret_scan, toxicity
from loomspan.llm.common import stored, table


def _rows(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(spark, sf_dir, docs)
    return _rows(toxicity.score(docs, model).where(F.col("score") < toxicity.CUT))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 of their shingles of five words, the one of the smallest doc_id."""
    rows = docs.where("doc_id is not null").select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    named, names = neardup.named(rows)
    if names is not None:
        named = stored(named, "named")
    groups = neardup.near_duplicates(named.select(F.col("node").alias("doc_id"), "text"), width=5, similar=(80, 100))
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("node")).distinct()
    return _rows(named.join(kept, "node", "left_semi").dropDuplicates(["node"])).unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a whole window of a benchmark item go, however long they are, and those that an item's few words make up to a twentieth."""
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"))
    return _rows(found.where(~(decontaminate.contaminated() | (F.size("hits") >= decontaminate.WINDOW))))


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(docs, secret_scan.default_forest(spark), path="source")
    text = F.when(F.col("_row.text").isNotNull(), F.col("redacted"))
    changed = {"text": text, "n_chars": F.when(F.size("secrets") > 0, F.length("redacted")).otherwise(F.col("_row.n_chars")).cast("long")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = bpe.round_trip(docs, keep=True)
    return rows.select("_row.doc_id", "_row.lang", "_row.source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mark_secrets),
    ("byte_bpe", encode_ids),
]
#: SQL has no words for the classifier, the forest and the tokenizer; tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
