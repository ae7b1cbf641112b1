"""Optional layers after the rules: a model of personal data, an outside secret scanner, a language model's residue.

Each takes what finds spans as a function, so that the model or service is the
caller's; nothing here needs a network.
"""

from __future__ import annotations

import json
import re
import shutil
import subprocess
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import map_rows
from ..scratch import stored
from .verify import string_values

MOST_CHARS, LEAST_SCORE, BATCH = 12_000, 0.65, 64
#: A text is worth a model's time if it holds one of these.
CUES = r"(?i)@|\+?\d[\d ().-]{7,}\d|\b(?:name|phone|address|email|born|passport|account|patient|customer)\b"
#: Code points of a line that a language model is asked about.
LINE_CHARS = 6_000


def mark_entities(text: str, entities: list[dict], least: float = LEAST_SCORE) -> tuple[str, dict[str, int]]:
    """text with each entity marked; entities that touch or overlap become one, under the first one's label."""
    spans: list[list] = []
    for e in sorted((e for e in entities if e.get("start") is not None and e.get("end") is not None and e.get("score", 0) >= least and e["start"] < e["end"]), key=lambda e: (e["start"], e["end"])):
        label = str(e.get("entity_group") or e.get("entity") or "PII").upper()
        if spans and e["start"] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e["end"])
        else:
            spans.append([e["start"], e["end"], label])
    out, at, counts = [], 0, {}
    for a, b, label in spans:
        out += [text[at:a], f"[PII_MODEL:{label}]"]
        at, counts[label] = b, counts.get(label, 0) + 1
    return "".join([*out, text[at:]]), counts


def _replace_strings(value, known: dict[str, str]):
    if isinstance(value, str):
        return known.get(value, value)
    if isinstance(value, list):
        return [_replace_strings(v, known) for v in value]
    if isinstance(value, dict):
        return {k: _replace_strings(v, known) for k, v in value.items()}
    return value


def privacy_filter(lines: DataFrame, score: Callable[[list[str]], list[list[dict]]], cues: str = CUES, most: int = MOST_CHARS, batch: int = BATCH) -> DataFrame:
    """Lines whose string values (not keys) are marked by a model; each distinct value of the run is scored once.

    Values beyond `most` code points, or without a cue, are left as they are:
    these bounds are part of the layer's definition.
    """
    worth = string_values(lines).where((F.length("text") <= most) & F.col("text").rlike(cues)).select("src_file", "line_no", "text")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, batch):
                texts = b.column(0).slice(k, batch).to_pylist()
                done = [mark_entities(t, found)[0] for t, found in zip(texts, score(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(done, pa.string())], ["text", "marked"])

    marks = stored(worth.select("text").distinct().mapInArrow(marked, "text string, marked string").where("text <> marked"), "marked")
    per = worth.distinct().join(marks, "text").groupBy("src_file", "line_no").agg(F.collect_list(F.struct("text", "marked")).alias("found"))

    def one(r: dict) -> list[dict]:
        known = {x["text"]: x["marked"] for x in r["found"] or []}
        raw = json.dumps(_replace_strings(json.loads(r["raw"]), known), ensure_ascii=False) if known else r["raw"]
        return [{"src_file": r["src_file"], "line_no": r["line_no"], "raw": raw}]

    return map_rows(lines.join(per, ["src_file", "line_no"], "left").select("src_file", "line_no", "raw", "found"), one, "src_file string, line_no long, raw string")


def available(binary: str = "gitleaks") -> bool:
    return shutil.which(binary) is not None


def outside_scan(lines: DataFrame, binary: str = "gitleaks") -> DataFrame:
    """src_file, line_no, rule and secret that an outside scanner reports; each task pipes its lines through it."""
    if not available(binary):
        raise RuntimeError(f"{binary} is not installed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = "".join(r.replace("\n", " ") + "\n" for r in b.column(2).to_pylist())
            told = subprocess.run([binary, "stdin", "--no-banner", "--report-format", "json", "--report-path", "-", "--exit-code", "0"], input=text.encode(), check=True, capture_output=True).stdout
            found = json.loads(told or b"[]") or []
            at = pa.array([x["StartLine"] - 1 for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([x["RuleID"] for x in found], pa.string()), pa.array([x["Secret"] for x in found], pa.string())], ["src_file", "line_no", "rule", "secret"])

    return lines.select("src_file", "line_no", "raw").mapInArrow(run, "src_file string, line_no long, rule string, secret string")


def scrub(lines: DataFrame, findings: DataFrame) -> DataFrame:
    """Lines with each found secret replaced by its rule's mark, longest first; a line in which it cannot be replaced whole becomes a tombstone."""
    per = findings.groupBy("src_file", "line_no").agg(F.collect_set(F.struct("rule", "secret")).alias("found"))

    def one(r: dict) -> list[dict]:
        raw = r["raw"]
        for f in sorted(r["found"] or [], key=lambda f: (-len(f["secret"]), f["secret"])):
            mark = "[SECRET:GITLEAKS_" + "".join(c if c.isalnum() else "_" for c in f["rule"].upper()) + "]"
            done = raw.replace(json.dumps(f["secret"], ensure_ascii=False)[1:-1], mark) if f["secret"] else raw
            if done == raw and mark not in raw or f["secret"] and f["secret"] in done:
                try:
                    kind = json.loads(raw).get("type", "redacted_record")
                except (ValueError, AttributeError):
                    kind = "redacted_record"
                raw = json.dumps({"type": kind, "redacted": True, "redaction_reason": "gitleaks_" + f["rule"]}, separators=(",", ":"))
                break
            raw = done
        return [{"src_file": r["src_file"], "line_no": r["line_no"], "raw": raw}]

    return map_rows(lines.join(per, ["src_file", "line_no"], "left").select("src_file", "line_no", "raw", "found"), one, "src_file string, line_no long, raw string")


def scrub_rounds(lines: DataFrame, scan: Callable[[DataFrame], DataFrame], most: int = 3) -> tuple[DataFrame, dict]:
    """Lines after scanning and scrubbing by turns until a scan finds nothing, `most` times at most; what each round found."""
    rounds = []
    for k in range(1, most + 1):
        findings = stored(scan(lines), "findings")
        by_rule = {r["rule"]: r["count"] for r in findings.groupBy("rule").count().collect()}
        rounds.append({"round": k, "findings": sum(by_rule.values()), "by_rule": by_rule})
        if not by_rule:
            return lines, {"available": True, "rounds": rounds, "status": "clean"}
        lines = stored(scrub(lines, findings), "scrubbed")
    return lines, {"available": True, "rounds": rounds, "status": "max_rounds_reached"}


#: Lines that a language model is asked about: they hold a word before a name, number or address.
RESIDUE_CUES = r"(?i)\b(?:my name is|i am|i'm|live[sd]? (?:in|at)|call(?:ed)?|contact|born|address|phone|mail|passport|account)\b"
_ASK = "List personal or secret text in the following line as a JSON array of objects with the keys text (an exact quotation) and category. Answer with the array alone.\n\n"


def service(url: str) -> Callable[[str], list[dict]]:
    """What a language model behind an address with the usual chat interface names in a line."""

    def ask(line: str) -> list[dict]:
        body = json.dumps({"messages": [{"role": "user", "content": _ASK + line}], "temperature": 0}).encode()
        with urllib.request.urlopen(urllib.request.Request(url.rstrip("/") + "/v1/chat/completions", body, {"Content-Type": "application/json"}), timeout=120) as reply:
            said = json.load(reply)["choices"][0]["message"]["content"]
        named = json.loads(said[said.find("[") : said.rfind("]") + 1] or "[]")
        return [x for x in named if isinstance(x, dict)]

    return ask


def residue(lines: DataFrame, candidates: str, ask: Callable[[str], list[dict]]) -> DataFrame:
    """Lines in which what a language model names (text, category) is marked, file by file, longest first.

    Only lines that the candidate pattern finds are asked about, and of those
    their first `LINE_CHARS` code points (the service's bound); a named text
    counts if it stands in them, has three characters or more and no brackets.
    """

    def asked(r: dict) -> list[dict]:
        shown = r["raw"][:LINE_CHARS]
        named = [(str(x.get("text", "")).strip(), re.sub(r"[^A-Z0-9_]", "_", str(x.get("category", "OTHER")).upper()) or "OTHER") for x in ask(shown)]
        return [{"src_file": r["src_file"], "text": t, "mark": f"[LLM_PII:{c}]"} for t, c in named if len(t) >= 3 and t in shown and not re.search(r"[\[\]]", t)]

    found = map_rows(lines.where(F.col("raw").rlike(candidates)).select("src_file", "raw"), asked, "src_file string, text string, mark string")
    per = found.groupBy("src_file", "text").agg(F.min("mark").alias("mark")).groupBy("src_file").agg(F.sort_array(F.collect_list(F.struct((-F.length("text")).alias("size"), "text", "mark"))).alias("found"))
    joined = lines.join(per, "src_file", "left")
    done = F.aggregate(F.coalesce("found", F.array().cast("array<struct<size:int,text:string,mark:string>>")), F.col("raw"), lambda a, x: F.replace(a, x["text"], x["mark"]))
    return joined.select("src_file", "line_no", done.alias("raw"))
