"""Flattening, metadata, filters, dedup, pairing and the two formats."""

import hashlib
import hmac
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspan.config import ExportConfig
from loomspan.functions.records import TRACE, arrow_schema, flatten_message, map_rows, trace_of, traces, traces_of_turns
from loomspan.functions.text import glob_regex, hmac_sha256, parse_bound, stable_rank
from loomspan.operators import export

KEY = "test-key"
LINES = "src_file string, line_no long, raw string"


def lines(spark, convs):
    return spark.createDataFrame([("a.jsonl", i, json.dumps(c, ensure_ascii=False)) for i, c in enumerate(convs, 1)], LINES)


def chat(*roles, **more):
    return {"messages": [{"role": r, "content": f"{r} {i}"} for i, r in enumerate(roles)], "source": "claude_code", **more}


DEMO = {
    "messages": [
        {"role": "user", "content": "Add a function to [PATH]"},
        {"role": "assistant", "content": "Done.", "tool_use": {"name": "write_file", "input": {"path": "x.py", "content": 'return f"Hello, {é}!"\n'}}},
        {"role": "user", "content": "Run it."}, {"role": "assistant", "content": "Fine"},
    ],
    "source": "claude_code", "session_id": "demo-001", "project_path": "/p",
}


def test_flatten():
    assert flatten_message({"role": "user", "content": "hi"}) == "hi"
    tool = flatten_message(DEMO["messages"][1])
    assert tool == 'Done.\n\n<tool_use name="write_file">\n{"content": "return f\\"Hello, {é}!\\"\\n", "path": "x.py"}\n</tool_use>'
    assert flatten_message({"tool_results": [{"type": "text", "text": "a"}, {"output": 1}]}) == '<tool_result type="text">\na\n</tool_result>\n\n<tool_result>\n{"output": 1}\n</tool_result>'
    assert flatten_message({"code_context": [{"path": "f", "code": "c"}], "suggested_diffs": [{"file": "g", "diff": "d"}], "diff_histories": [{"b": 1, "a": None}]}) == (
        '<code_context file="f">\nc\n</code_context>\n\n<suggested_diff file="g">\nd\n</suggested_diff>\n\n<diff_history>\n{"a": null, "b": 1}\n</diff_history>')
    assert flatten_message({"content": "", "zeta": None, "alpha": [1, "é"], "model": "m"}) == '<field name="alpha">\n[1, "é"]\n</field>\n\n<field name="zeta">\nnull\n</field>'


def test_lines_of_both_formats(spark):
    rows = export.judged(traces(lines(spark, [DEMO]), KEY), ExportConfig())
    identity = lambda v: hmac.new(KEY.encode(), json.dumps(v, separators=(",", ":")).encode(), hashlib.sha256).hexdigest()[:24]
    meta = {"schema_version": "1.0", "trace_id": "ts_" + identity(["claude_code", "demo-001"]), "source": "claude_code", "session": {}, "project": {"id": "tp_" + identity("/p")}, "models": [],
            "counts": {"messages": 4, "roles": {"user": 2, "assistant": 2}, "assistant_chars": 9, "tool_calls": 1, "tool_results": 0, "diffs": 0}}
    flat = [{"role": m["role"], "content": flatten_message(m)} for m in DEMO["messages"]]
    assert [r["value"] for r in export.messages_json(rows).collect()] == [json.dumps({"messages": flat, "metadata": meta}, ensure_ascii=False)]
    want = [json.dumps({"conversations": [{"from": "human", "value": flat[2 * i]["content"]}, {"from": "gpt", "value": flat[2 * i + 1]["content"]}], "metadata": meta | {"pair": {"index": i, "count": 2}}}, ensure_ascii=False) for i in (0, 1)]
    assert [r["value"] for r in export.sharegpt_json(rows).orderBy("pair_index").collect()] == want


def test_metadata_counts_days_and_tokens():
    conv = chat("user", "assistant", created_at="2026-07-10T23:59:59-06:00", updated_at=1_783_000_000_000, status="completed", token_usage={"input": 10, "cached_input": 12, "odd": 1, "total": True}, model="m1", tool_call_count=2)
    conv["messages"][1] |= {"tool_calls": [1, 2], "tool_result": {}, "diffs": [{}], "model": "m2"}
    t = trace_of(conv, b"k")
    meta = json.loads(t["metadata"])
    assert meta["session"] == {"created_at": "2026-07-11", "updated_at": "2026-07-02", "status": "completed"}
    assert (t["tool_calls"], t["tool_results"], t["diffs"], t["models"]) == (4, 1, 1, ["m1", "m2"]) and meta["token_usage"] == {"input": 10, "cached_input": 12}
    assert t["trace_id"] != trace_of(chat("user", "assistant"), b"k")["trace_id"] and t["dedup_key"].startswith("h:")
    assert trace_of({"messages": None, "source": None}, b"k")["source"] == "unknown"


RICH = chat("user", "assistant", "user", "assistant", project_path="/Work/App", model="GPT-x", status="completed", created_at="2026-01-05T00:00:00Z", session_id="s")


@pytest.mark.parametrize("config, reason", [
    (ExportConfig(), None), (ExportConfig(include_sources=("codex*",)), "source_not_included"), (ExportConfig(drop_sources=("CLAUDE_*",)), "source_dropped"), (ExportConfig(projects=("/other/*",)), "project_not_included"),
    (ExportConfig(projects=("/work/*",)), None), (ExportConfig(models=("claude*",)), "model_not_included"), (ExportConfig(models=("gpt-?",)), None), (ExportConfig(statuses=("aborted",)), "status_not_included"),
    (ExportConfig(since="2026-01-06"), "before_since"), (ExportConfig(until="2026-01-04"), "after_until"), (ExportConfig(min_turns=5), "below_min_messages"), (ExportConfig(max_turns=3), "above_max_messages"),
    (ExportConfig(min_assistant_chars=1000), "below_min_assistant_chars"), (ExportConfig(require_tools=True), "tools_required"), (ExportConfig(require_diffs=True), "diffs_required"), (ExportConfig(min_turns=9, require_tools=True), "below_min_messages"),
])
def test_first_reason(spark, config, reason):
    assert export.judged(traces(lines(spark, [RICH]), KEY), config).first()["reason"] == reason


def test_bounds_are_checked_first():
    with pytest.raises(ValueError, match="since"):
        export.reason(ExportConfig(since="yesterday"))
    assert parse_bound("since", "1970-01-02") == 86400


def test_dedup_keeps_the_first_in_file_order(spark):
    convs = [chat("user", "assistant", session_id="a"), chat("user"), chat("user", "assistant", session_id="a"), chat("user"), chat("user", session_id="b"), chat("user", "assistant", session_id="b")]
    rows = export.judged(traces(lines(spark, convs), KEY), ExportConfig(dedup=True)).cache()
    assert [r["repeat"] for r in rows.orderBy("line_no").collect()] == [False, False, True, True, False, True]
    # A conversation without an answer still holds its key.
    s = export.summary(rows, "messages")
    assert (s["rows"], s["dropped_dedup"], s["dropped_no_assistant"]) == (1, 3, 2)
    assert export.summary(rows, "sharegpt") == {"pairs": 1, "dropped_no_assistant": 0, "dropped_filter": 0, "dropped_dedup": 3, "dropped_by_reason": {}, "by_source": {"claude_code": 1}, "dropped_trailing_user": 2}


def folded(roles):
    """Pairs, by a plain loop."""
    out, pending = [], None
    for i, r in enumerate(roles):
        if r in ("user", "tool"):
            pending = i
        elif r == "assistant" and pending is not None:
            out.append((pending, i))
            pending = None
    return out


def test_pairing_is_the_fold(spark):
    rng = random.Random(1)
    every = [[rng.choice(["user", "assistant", "tool", "system", "developer", "other"]) for _ in range(rng.randrange(12))] for _ in range(300)]
    rows = spark.createDataFrame([(i, [(r, str(k)) for k, r in enumerate(roles)]) for i, roles in enumerate(every)], "i long, messages array<struct<role:string,content:string>>")
    for r in rows.select("i", export.pairs_of(F.col("messages")).alias("p"), export.trailing_user(F.col("messages")).alias("t")).collect():
        roles = every[r["i"]]
        assert [(int(p["human"]["content"]), int(p["gpt"]["content"])) for p in r["p"]] == folded(roles)
        assert r["t"] == ([x for x in roles if x not in ("system", "developer")] or [""])[-1].startswith("user")


def test_system_goes_before_the_first_pair(spark):
    conv = chat("system", "user", "user", "developer", "assistant", "user", "assistant", "user")
    got = export.sharegpt_rows(export.judged(traces(lines(spark, [conv]), KEY), ExportConfig())).orderBy("pair_index").collect()
    assert [[(m["from"], m["value"]) for m in r["conversations"]] for r in got] == [[("system", "system 0"), ("system", "developer 3"), ("human", "user 2"), ("gpt", "assistant 4")], [("human", "user 5"), ("gpt", "assistant 6")]]


def test_turns_and_records_agree(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "bé"), (2, 0, "assistant", None), (3, 0, "", "x")], "conv_id long, turn long, role string, text string")
    native = {r["line_no"]: r for r in traces_of_turns(turns, KEY).collect()}
    for i, messages in {1: [("user", "a"), ("assistant", "bé")], 2: [("assistant", "")], 3: [("", "x")]}.items():
        want = trace_of({"messages": [{"role": r, "content": t} for r, t in messages], "source": "table", "session_id": str(i)}, KEY.encode())
        assert all(native[i][k] == want[k] for k in ("trace_id", "dedup_key", "n_messages", "assistant_chars", "has_assistant")) and native[i]["roles"] == dict(want["roles"])
    assert traces_of_turns(turns.limit(0), KEY).collect() == [] and traces(lines(spark, []), KEY).collect() == []
    assert len(TRACE.split(", ")) == len(traces(lines(spark, []), KEY).columns)


def test_scalar_functions(spark):
    row = spark.range(1).select(hmac_sha256(b"k" * 70, F.lit("é")).alias("h"), stable_rank(17, F.lit("g")).alias("r")).first()
    assert row["h"] == hmac.new(b"k" * 70, "é".encode(), hashlib.sha256).hexdigest() and row["r"] == hashlib.sha256(b"17\x00g").hexdigest()
    for pattern, yes, no in (("a*[!x].py", "ab/c.py", "ab/x.py"), ("?[ab]", "zb", "zc"), ("a.b", "a.b", "axb"), ("[", "[", "x")):
        got = spark.range(1).select(F.lit(yes).rlike(glob_regex(pattern)), F.lit(no).rlike(glob_regex(pattern))).first()
        assert tuple(got) == (True, False), pattern


def test_map_rows_holds_few_large_rows_at_a_time():
    class Frame:
        columns = ["k", "text"]

        def mapInArrow(self, run, kinds):
            return run

    run = map_rows(Frame(), lambda r: [r], "k long, text string")
    for length, most in ((1 << 20, 2), (10, 256)):
        batch = pa.RecordBatch.from_pylist([{"k": k, "text": "x" * length} for k in range(300 if length == 10 else 12)], arrow_schema("k long, text string"))
        made = list(run(iter([batch, batch.slice(0, 0)])))
        assert max(b.num_rows for b in made) <= most and pa.Table.from_batches(made).to_pylist() == batch.to_pylist()
