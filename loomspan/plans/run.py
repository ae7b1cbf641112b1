"""The whole way from logs to training data, stage by stage, each with its own output."""

from __future__ import annotations

import secrets
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExportConfig, RedactorConfig
from ..functions.records import traces
from ..operators.export import judged, messages_json, sharegpt_json, summary
from ..operators import layers
from ..operators.identity import private_terms
from ..operators.redact import redact
from ..scratch import stored
from ..sinks.files import touch, write_lines, write_report
from ..sinks.reports import EXPORTS, manifest
from ..sources.installs import chosen, extract
from ..sources.lines import checked


def _save_by_source(rows: DataFrame, out: str) -> None:
    """Conversations by source, in file order, as JSON lines below source=..."""
    rows.repartitionByRange("source_key", "src_file", "line_no").sortWithinPartitions("source_key", "src_file", "line_no").select("source_key", F.col("raw").alias("value")).write.mode("overwrite").partitionBy("source_key").text(out)


def run_extract(spark: SparkSession, root: str, out: str, sources: list[str] | None = None, system: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    names = chosen(sources)
    rows = stored(extract(spark, root, names, system), "extracted")
    _save_by_source(rows, f"{out}/raw_extracted")
    seen = {r["source_key"]: r["count"] for r in rows.groupBy("source_key").count().collect()}
    for n in names:
        if n not in seen:
            touch(spark, f"{out}/raw_extracted/source_key={n}/part-00000.txt")
    return rows, {n: seen.get(n, 0) for n in names}


def _layered(lines: DataFrame, config: RedactorConfig, score: Callable | None, ask: Callable | None) -> tuple[DataFrame, dict]:
    """Lines after the layers that are set, in this order, and what each did; a layer that is set and cannot run is an error or is reported as skipped."""
    told: dict[str, dict] = {}
    missing = {"available": False, "status": "skipped", "reason": "gitleaks binary not found"}
    if config.privacy_filter:
        if score is None:
            raise RuntimeError("privacy_filter is set, but no model was given that scores texts")
        lines = stored(layers.privacy_filter(lines, score, batch=config.privacy_filter_batch_size), "filtered")
        told["privacy_filter"] = {"marks": lines.where(F.col("raw").contains("[PII_MODEL:")).count()}
    if config.gitleaks_fix:
        told["gitleaks_fix"] = missing
        if layers.available():
            lines, told["gitleaks_fix"] = layers.scrub_rounds(lines, layers.outside_scan)
    if config.llm_residue_url:
        lines = stored(layers.residue(lines, layers.RESIDUE_CUES, ask or layers.service(config.llm_residue_url)), "residue")
        told["llm_residue"] = {"lines": lines.where(F.col("raw").contains("[LLM_PII:")).count()}
    if config.gitleaks:
        told["gitleaks"] = missing
        if layers.available():
            n = layers.outside_scan(lines).count()
            told["gitleaks"] = {"available": True, "status": "findings_or_error" if n else "clean", "findings": n}
    return lines, told


def run_redact(spark: SparkSession, rows: DataFrame, out: str, config: RedactorConfig, home: str = "~", found: tuple[str, ...] | None = None, score: Callable | None = None, ask: Callable | None = None) -> tuple[DataFrame, dict]:
    """Redacted rows and the report; order and counts go by source key, then file and line.

    found: private terms beside those of the settings (None: those of this
    machine); score and ask: the models of two optional layers.
    """
    found = private_terms(config.home_dir or home, config.user_name) if found is None else found
    keyed = rows.select(F.concat_ws("\0", "source_key", "src_file").alias("src_file"), "line_no", "raw")
    clean, counts = redact(keyed, config, home, found)
    clean, told = _layered(clean, config, score, ask)
    key = F.split("src_file", "\0")
    clean = stored(clean.select(F.element_at(key, 1).alias("source_key"), F.element_at(key, 2).alias("src_file"), "line_no", "raw"), "clean")
    _save_by_source(clean, f"{out}/redacted")
    per: dict[str, dict[str, int]] = {}
    for r in counts.groupBy(F.element_at(key, 1).alias("source"), "rule").agg(F.sum("n").alias("n")).orderBy("source", "rule").collect():
        per.setdefault(r["source"], {})[r["rule"]] = r["n"]
    total: dict[str, int] = {}
    for c in per.values():
        for k, n in c.items():
            total[k] = total.get(k, 0) + n
    shown = {k: v for k, v in asdict(config).items() if k in ("allow_public_urls", "allowed_domains", "private_domains", "privacy_filter", "gitleaks", "gitleaks_fix")} | {"llm_residue": bool(config.llm_residue_url)}
    report = {"counts": total, "per_source": per, "layers": told, "config": shown}
    write_report(spark, f"{out}/REDACTION_REPORT.json", report)
    return clean, report


def run_export(spark: SparkSession, rows: DataFrame, out: str, config: ExportConfig) -> dict[str, dict]:
    """Write the formats that config.variant names below out/export; their summaries."""
    key = config.metadata_key or secrets.token_hex(32)  # once, on the driver: all tasks share it
    ordered = rows.select(F.concat_ws("\0", "source_key", "src_file").alias("src_file"), "line_no", "raw") if "source_key" in rows.columns else rows
    told = stored(judged(traces(checked(ordered), key), config), "traces")
    out_ = {}
    for variant, name in EXPORTS.items():
        if config.variant in (variant, "both"):
            made = messages_json(told) if variant == "messages" else sharegpt_json(told)
            write_lines(made, f"{out}/export/{name}", [c for c in made.columns if c != "value"], "overwrite")
            out_[variant] = summary(told, variant)
    return out_


def run(spark: SparkSession, root: str, out: str, redaction: RedactorConfig = RedactorConfig(), export: ExportConfig = ExportConfig(), sources: list[str] | None = None, system: str | None = None) -> dict:
    """extract, redact, export and manifest; the manifest."""
    rows, counts = run_extract(spark, root, out, sources, system)
    clean, report = run_redact(spark, rows, out, redaction, root)
    summaries = run_export(spark, clean, out, export)
    shown = {k: v for k, v in asdict(export).items() if k not in ("variant", "metadata_key")}
    return manifest(spark, out, counts, report, summaries, {"variant": export.variant, "redaction": report["config"], "export": shown})
