"""Where logs are on this machine, and the scan of each kind of log."""

from __future__ import annotations

import os
import platform
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import INSTALL_PLACES, SOURCE_KEYS
from ..functions.records import map_rows
from . import databases, sessions
from .lines import LINES, parsed, whole_files


def find_installs(source: str, root: str, system: str | None = None) -> list[str]:
    """Existing installation folders of a source under a home folder; a folder that two names lead to counts once."""
    spec = INSTALL_PLACES[source]
    folders = spec.get(system or platform.system(), (".config", ""))
    found = [os.path.realpath(p) for f in folders for n in spec["names"] if os.path.exists(p := os.path.join(root, f, n))]
    return list(dict.fromkeys(found))


def _only(files: DataFrame, *patterns: str) -> DataFrame:
    """Files whose path fits one of the patterns (SQL LIKE)."""
    keep = F.lit(False)
    for p in patterns:
        keep = keep | F.col("path").like(p)
    return files.where(keep)


def _opencode_cli(files: DataFrame) -> DataFrame:
    """Sessions, messages and parts are files of their own: messages take their parts and their session by left joins on the ids in paths."""
    files = files.withColumn("text", F.col("content").cast("string"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.json$", "")
    parent = F.element_at(F.split("path", "/"), -2)
    install = F.regexp_extract("path", r"^(.*?)/storage/", 1)
    good = files.where(F.try_parse_json("text").isNotNull()).select(install.alias("install"), parent.alias("parent"), name.alias("name"), "text", "path")
    message = good.where("path like '%/storage/message/ses\\_%/msg\\_%.json'").withColumn("id", F.get_json_object("text", "$.id"))
    part = good.where("path like '%/storage/part/%/prt\\_%.json'").groupBy("install", F.col("parent").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("name", "text"))), lambda x: x["text"]).alias("parts"))
    meta = good.where("path like '%/storage/session/global/%.json'").select("install", F.col("name").alias("session"), F.col("text").alias("meta"))
    told = message.join(part, ["install", "id"], "left").groupBy("install", F.col("parent").alias("session")).agg(F.sort_array(F.collect_list(F.struct("name", "text", "parts"))).alias("messages"))

    def one(r: dict) -> list[dict]:
        import json

        def whole(text):
            value = json.loads(text)
            return value if isinstance(value, dict) else {}

        try:
            pairs = [(whole(m["text"]), [whole(p) for p in m["parts"] or []]) for m in r["messages"]]
            raw = sessions.opencode_session(r["session"], pairs, whole(r["meta"]) if r["meta"] else None, r["install"])
        except Exception:  # noqa: BLE001 - one broken session must not end the scan of the others
            return []
        return [{"src_file": f"{r['install']}/storage/message/{r['session']}", "line_no": 1, "raw": raw}] if raw else []

    return map_rows(told.join(meta, ["install", "session"], "left").select("install", "session", "messages", "meta"), one, LINES)


def scan(spark: SparkSession, source: str, roots: list[str]) -> DataFrame:
    """src_file, line_no, raw of the conversations of a source's installations."""
    return scan_files(source, lambda glob: whole_files(spark, roots, glob))


def scan_files(source: str, named: Callable[[str], DataFrame], opened: Callable[[dict], bytes] | None = None) -> DataFrame:
    """As scan, of files (path, content); named gives those whose names fit a glob, opened the content of databases and stores where it is no column."""
    files = lambda glob, *paths: _only(named(glob), *paths)
    if source == "claude_code":
        return parsed(named("*.jsonl").where(~F.element_at(F.split("path", "/"), -1).startswith("agent-")), sessions.claude_code)
    if source == "codex":
        return parsed(files("*.jsonl", "%/sessions/%/rollout-%.jsonl", "%/sessions/rollout-%.jsonl", "%/projects/%.jsonl"), sessions.codex)
    if source == "continue":
        return parsed(files("*.json", "%/sessions/%.json").where(~F.col("path").like("%/sessions/sessions.json")), sessions.continue_)
    if source == "gemini":
        return parsed(files("session-*.json", "%/tmp/%/chats/session-%.json"), sessions.gemini)
    if source in ("cursor", "windsurf"):
        return parsed(files("state.vscdb", "%/User/workspaceStorage/%/state.vscdb", "%/User/globalStorage/state.vscdb"), getattr(databases, source), opened)
    if source == "trae":
        return parsed(files("*.jsonl", "%/projects/%.jsonl", "%/sessions/%.jsonl"), sessions.trae_jsonl).unionByName(parsed(named("*.{db,vscdb}"), databases.trae, opened))
    if source == "opencode":
        return _opencode_cli(named("*.json")).unionByName(parsed(named("*.dat"), sessions.opencode_store, opened))
    raise ValueError(f"unknown source: {source}")


def chosen(names: list[str] | None) -> list[str]:
    unknown = [n for n in names or [] if n not in SOURCE_KEYS]
    if unknown:
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return list(names or SOURCE_KEYS)


def extract(spark: SparkSession, root: str, sources: list[str] | None = None, system: str | None = None) -> DataFrame:
    """source_key, src_file, line_no, raw of all conversations of the chosen sources under a home folder."""
    parts = [scan(spark, s, found).select(F.lit(s).alias("source_key"), "src_file", "line_no", "raw") for s in chosen(sources) if (found := find_installs(s, root, system))]
    out = spark.createDataFrame([], "source_key string, src_file string, line_no long, raw string")
    for p in parts:
        out = out.unionByName(p)
    return out

