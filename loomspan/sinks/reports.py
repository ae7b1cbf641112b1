"""Manifest, dataset card, and train/eval datasets with receipts."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..fixed import SCHEMA_VERSION
from ..operators.corpus import bad_split_rows, split
from ..sources.lines import read_large_lines
from .files import digests, exists, read_report, write_report

EXPORTS = {"messages": "messages.jsonl", "sharegpt": "sharegpt.jsonl"}
FIELDS = {"messages": ("messages", "array<struct<role:string,content:string>>"), "sharegpt": ("conversations", "array<struct<from:string,value:string>>")}
RECEIPT = "SPLIT_RECEIPT.json"


def manifest(spark: SparkSession, root: str, extracted: dict[str, int], redaction: dict, summaries: dict[str, dict], config: dict) -> dict:
    """Write MANIFEST.json below root: counts of each source, what exports kept and why not, and digests of files."""
    got = lambda variant, key, empty: summaries.get(variant, {}).get(key, empty)
    summary = {
        "messages_rows": got("messages", "rows", 0), "messages_dropped_no_assistant": got("messages", "dropped_no_assistant", 0), "messages_dropped_by_reason": got("messages", "dropped_by_reason", {}),
        "sharegpt_pairs": got("sharegpt", "pairs", 0), "sharegpt_dropped_trailing_user": got("sharegpt", "dropped_trailing_user", 0), "sharegpt_dropped_by_reason": got("sharegpt", "dropped_by_reason", {}),
    }
    for variant, key in (("messages", "messages_by_source"), ("sharegpt", "sharegpt_pairs_by_source")):
        if got(variant, "by_source", {}):
            summary[key] = got(variant, "by_source", {})
    files = {}
    for name in EXPORTS.values():
        if exists(spark, f"{root}/export/{name}"):
            files |= {f"export/{name}/{part}": d for part, d in digests(spark, f"{root}/export/{name}").items()}
    out = {
        "created_at": datetime.now(timezone.utc).isoformat(), "tool_version": __version__, "metadata_schema_version": SCHEMA_VERSION, "config": config,
        "sources": {s: {"raw_records": n, "redaction_counts": redaction.get("per_source", {}).get(s, {})} for s, n in extracted.items()}, "export_summary": summary, "files": files,
    }
    write_report(spark, f"{root}/MANIFEST.json", out)
    return out


def card(manifest_: dict, name: str, license_name: str = "mit") -> str:
    """A dataset card in Markdown: what the manifest counts, by source."""
    summary, sources = manifest_.get("export_summary", {}), manifest_.get("sources", {})
    chats, pairs = summary.get("messages_by_source", {}), summary.get("sharegpt_pairs_by_source", {})
    rows = "\n".join(f"| {s} | {sources.get(s, {}).get('raw_records', 0)} | {chats.get(s, 0)} | {pairs.get(s, 0)} |" for s in sorted({*sources, *chats, *pairs}))
    head = {"license": license_name, "task_categories": ["text-generation"], "language": ["en"], "tags": ["code", "distillation", "agent-traces"], "size_categories": ["1K<n<10K"]}
    front = "\n".join(f"{k}: {v}" if isinstance(v, str) else f"{k}:\n" + "\n".join(f"  - {x}" for x in v) for k, v in head.items())
    return (
        f"---\n{front}\n---\n\n# {name}\n\nCoding-agent conversations in two training formats (metadata schema {manifest_.get('metadata_schema_version', 'unknown')}).\n\n"
        f"## Sources\n\n| Source | Raw records | Conversations | ShareGPT pairs |\n|---|---:|---:|---:|\n{rows}\n\n"
        f"**Totals:** {summary.get('messages_rows', 0)} conversations / {summary.get('sharegpt_pairs', 0)} instruction pairs.\n\n"
        f"## Redaction\n\n```json\n{json.dumps(manifest_.get('config', {}), indent=2)}\n```\n\nLook at a sample before use.\n"
    )


def _digest(spark: SparkSession, path: str) -> str:
    return hashlib.sha256("".join(f"{n}:{d['sha256']}\n" for n, d in sorted(digests(spark, path).items())).encode()).hexdigest()


def train_eval(spark: SparkSession, export: str, out: str, variant: str, fraction: float, seed: int) -> dict:
    """Parquet with partitions split=train and split=eval of an export, by whole conversations, and its receipt."""
    if variant not in EXPORTS:
        raise ValueError("variant must be 'messages' or 'sharegpt'")
    source = f"{export}/{EXPORTS[variant]}"
    if not exists(spark, source):
        raise FileNotFoundError(f"export not found: {source}")
    if exists(spark, out):
        raise FileExistsError(f"output already exists: {out}")
    lines = _lines_of(spark, source)
    bad = bad_split_rows(lines, variant).orderBy("src_file", "line_no").first()
    if bad:
        raise ValueError(f"{bad['src_file']}:{bad['line_no']}: {bad['problem']}")
    if not lines.limit(1).count():
        raise ValueError(f"{source} contains no usable rows")
    before = _digest(spark, source)
    field, kind = FIELDS[variant]
    rows = lines.select(F.get_json_object("raw", "$.metadata.trace_id").alias("trace_id"), F.from_json("raw", f"{field} {kind}")[field].alias(field))
    parts = split(rows, "trace_id", fraction, seed).withColumn("split", F.when(F.col("is_eval"), "eval").otherwise("train"))
    half = f"{out}.part"
    parts.select(field, "split").write.mode("overwrite").partitionBy("split").parquet(half)
    if _digest(spark, source) != before:
        raise RuntimeError("source export changed while building the dataset")
    sizes = {r["split"]: (r["n"], r["groups"]) for r in parts.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("trace_id").alias("groups")).collect()}
    receipt = {
        "schema_version": 1, "tool_version": __version__, "created_at": datetime.now(timezone.utc).isoformat(), "variant": variant, "source": source, "source_sha256": before, "seed": seed, "eval_fraction": fraction,
        "train_rows": sizes["train"][0], "eval_rows": sizes["eval"][0], "train_conversations": sizes["train"][1], "eval_conversations": sizes["eval"][1], "output": out,
    }
    write_report(spark, f"{half}/{RECEIPT}", receipt)
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(half), jvm.org.apache.hadoop.fs.Path(out)
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"cannot put {out} in place")
    return receipt


def _lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an export (a folder of part files, or of *.jsonl), with places in the order of lines."""
    return read_large_lines(spark, path, "*")


def verify_train_eval(spark: SparkSession, out: str) -> dict:
    """The receipt of a dataset; an error if rows, columns or the source's digest do not agree with it."""
    receipt = read_report(spark, f"{out}/{RECEIPT}")
    if receipt.get("variant") not in EXPORTS:
        raise ValueError(f"unsupported receipt variant: {receipt.get('variant')!r}")
    data = spark.read.option("pathGlobFilter", "*.parquet").parquet(out)
    sizes = {r["split"]: r["count"] for r in data.groupBy("split").count().collect()}
    for part in ("train", "eval"):
        if part not in sizes:
            raise ValueError(f"dataset split is missing: {part}")
        if sizes[part] != receipt.get(f"{part}_rows", -1):
            raise ValueError(f"{part} row count does not match receipt")
    if data.drop("split").columns != [FIELDS[receipt["variant"]][0]]:
        raise ValueError(f"columns do not match variant {receipt['variant']!r}")
    if exists(spark, receipt["source"]) and _digest(spark, receipt["source"]) != receipt["source_sha256"]:
        raise ValueError("source export hash does not match receipt")
    return receipt


def publish(spark: SparkSession, export: str, name: str, upload=None) -> str:
    """Write the dataset card next to an export; upload(folder, name) does the rest and returns an address (none: the card's path)."""
    root = export.rstrip("/").rpartition("/")[0]
    made = read_report(spark, f"{root}/MANIFEST.json") if exists(spark, f"{root}/MANIFEST.json") else {}
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{export}/README.md")
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(card(made, name).encode()))
    stream.close()
    return upload(export, name) if upload else f"{export}/README.md"

