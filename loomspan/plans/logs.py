"""Queries over logs: the turns of `conversations` written as each kind of log has them, scanned again, beside the same in SQL.

Files are rows (path, content) that go through the scans as files of a folder
do, with files among them that a scan must leave aside.  Databases and stores
are rows (path, turns) whose bytes are made where they are parsed.
"""

from __future__ import annotations

import json
import re
import sqlite3
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.installs import scan_files
from ..sources.published import converted_files

#: A character at which lines of text may end, but records do not.
BREAK = "\u2028"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    said = F.concat(F.lit("#"), F.col("turn"), F.lit(" "), F.coalesce("text", F.lit("")), F.when(F.col("turn") % 5 == 2, BREAK).otherwise(""), F.lit("."))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), said.alias("text"))


def _at(turn: Column | str = "turn") -> Column:
    return F.concat(F.lit("2024-03-01T"), F.lpad(F.col(turn).cast("string") if isinstance(turn, str) else turn, 6, "0"))


def _json(**fields: Column) -> Column:
    """An object of the fields that are not null."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _is(role: str) -> Column:
    return F.col("role") == role


def _files(rows: DataFrame, path: Column, line: Column, before: Column | None = None, after: Column | None = None, between: str = "\n") -> DataFrame:
    """One file of each conversation: a line of each turn, in order."""
    lines = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), between).alias("body"))
    return lines.select(path.alias("path"), F.encode(F.concat(*[x for x in (before, F.col("body"), after) if x is not None]), "UTF-8").alias("content"))


def _named(files: DataFrame):
    """Files whose names fit a glob, as a scan asks for them."""

    def of(glob: str) -> DataFrame:
        wild = re.sub(r"\\\{(.*)\\\}", lambda m: "(?:" + m[1].replace(",", "|") + ")", re.escape(glob)).replace(r"\*", ".*")
        return files.where(F.element_at(F.split("path", "/"), -1).rlike(f"^{wild}$"))

    return of


def _scanned(source: str, files: DataFrame, kinds: str, opened=None) -> DataFrame:
    """The conversations of a scan, as r by their schema."""
    schema = f"messages array<struct<role:string,content:string,{kinds}>>, session_id string, created_at string, updated_at string, project_path string, model string, status string, title string, tool_call_count long, tool_result_count long, diff_count long, token_usage map<string,double>, source string"
    return scan_files(source, _named(files), opened).select("src_file", F.from_json("raw", schema).alias("r"))


def _said() -> Column:
    """A digest of who said what."""
    return F.sha2(F.array_join(F.transform("r.messages", lambda m: F.concat(m["role"], F.lit("\n"), m["content"], F.lit("\n"))), ""), 256).alias("said_sha256")


def _sum(of) -> Column:
    return F.aggregate("r.messages", F.lit(0), lambda a, m: a + F.coalesce(of(m).cast("int"), F.lit(0))).cast("long")


def _tokens(name: str) -> Column:
    return F.coalesce(F.col("r.token_usage").getItem(name), F.lit(0.0)).cast("long").alias(f"tokens_{name}")


def _conv() -> Column:
    return F.regexp_extract("r.session_id", r"(\d+)$", 1).cast("long").alias("conv_id")


def scan_claude(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    blocks = F.concat(F.lit('[{"type":"text","text":'), _quoted("text"), F.lit('},{"type":"tool_result","tool_use_id":"c","content":"r"}]'))
    user = _json(type=F.lit("user"), uuid=F.concat(F.lit("u"), "turn"), timestamp=_at(), cwd=F.concat(F.lit("/w/"), F.col("conv_id") % 5, F.lit("/"), "turn"), message=F.struct(F.col("text").alias("content")))
    user_blocks = F.concat(F.lit('{"type":"user","cwd":"/b/'), "turn", F.lit('","timestamp":"'), _at(), F.lit('","message":{"content":'), blocks, F.lit("}}"))
    model = F.when(F.col("conv_id") % 11 == 3, "<synthetic>").otherwise(F.concat(F.lit("model-"), F.col("turn") % 3))
    content = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("string").alias("name")), F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("run").alias("name")))
    usage = F.struct(F.length("text").alias("input_tokens"), F.col("turn").alias("output_tokens"))
    said = F.struct(F.concat(F.lit("m"), F.floor(F.col("turn") / 4)).alias("id"), model.alias("model"), content.alias("content"), usage.alias("usage"))
    line = F.when(_is("user"), F.when(F.col("turn") % 4 == 0, user_blocks).otherwise(user)).when(_is("assistant"), _json(type=F.lit("assistant"), timestamp=_at(), message=said)).otherwise(_json(type=F.lit("tool_result"), timestamp=_at(), toolResult=F.struct(F.col("turn").alias("n"))))
    line = F.when(F.col("turn") % 6 == 1, F.concat(line, F.lit("\n{not json"))).otherwise(line)
    path = lambda name: F.concat(F.lit("/h/.claude/projects/p"), F.col("conv_id") % 7, F.lit(f"/{name}"), "conv_id", F.lit(".jsonl"))
    files = _files(turns, path("s"), line).unionByName(_files(turns.where("conv_id % 5 = 0"), path("agent-"), line))
    rows = _scanned("claude_code", files, "tool_results array<string>, tool_uses array<string>")
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said(), _sum(lambda m: F.size(m["tool_results"])).alias("n_results"), _sum(lambda m: F.size(m["tool_uses"])).alias("n_uses"),
                       _tokens("input"), _tokens("output"), F.col("r.created_at").alias("created_at"), F.col("r.updated_at").alias("updated_at"), F.col("r.project_path").alias("project_path"))


def _quoted(text: str) -> Column:
    """A string as JSON."""
    whole = F.to_json(F.array(F.col(text)))
    return F.substr(whole, F.lit(2), F.length(whole) - 2)


def scan_codex(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    event = lambda payload: _json(type=F.lit("event_msg"), timestamp=_at(), payload=payload)
    item = lambda payload: _json(type=F.lit("response_item"), timestamp=_at(), payload=payload)
    told = lambda kind: event(F.struct(F.lit(kind).alias("type"), F.col("text").alias("message")))
    spoken = item(F.struct(F.lit("message").alias("type"), F.col("role"), F.array(F.struct(F.lit("output_text").alias("type"), F.col("text").alias("text"))).alias("content")))
    patch = F.when(F.col("turn") % 4 == 1, event(F.struct(F.lit("patch_apply_end").alias("type"), F.create_map(F.lit("f"), F.lit(1)).alias("changes")))).when(F.col("turn") % 4 == 3, event(F.struct(F.lit("patch_apply_end").alias("type"), F.create_map().cast("map<string,int>").alias("changes"))))
    context = _json(type=F.lit("turn_context"), payload=F.struct(F.concat(F.lit("gpt-"), F.col("turn") % 3).alias("model")))
    total = event(F.struct(F.lit("token_count").alias("type"), F.struct(F.struct((F.col("turn") * 10).alias("input_tokens")).alias("total_token_usage")).alias("info")))
    call = event(F.struct(F.lit("tool_use").alias("type"), F.concat(F.lit("c"), F.col("turn") % 2).alias("call_id"), F.lit("t").alias("tool")))
    many = F.when(_is("user"), F.concat_ws("\n", F.when(F.col("turn") % 3 == 0, told("user_message")), told("user_message"), spoken, patch)).when(_is("assistant"), F.concat_ws("\n", context, spoken, told("agent_message"), total)).otherwise(F.concat_ws("\n", call, call, item(F.struct(F.lit("function_call_output").alias("type")))))
    head = F.concat(F.lit('{"type":"session_meta","payload":{"id":"s'), "conv_id", F.lit('","cwd":"/w/'), F.col("conv_id") % 3, F.lit('","timestamp":"2024-02-01"}}\n'))
    end = F.when(F.col("conv_id") % 3 == 0, '\n{"type":"event_msg","payload":{"type":"task_complete"}}').when(F.col("conv_id") % 3 == 1, '\n{"type":"event_msg","payload":{"type":"turn_aborted"}}').otherwise("")
    files = _files(turns, F.concat(F.lit("/h/.codex/sessions/2024/rollout-"), "conv_id", F.lit(".jsonl")), many, head, end)
    files = files.unionByName(files.withColumn("path", F.replace("path", F.lit("rollout-"), F.lit("other-"))))
    rows = _scanned("codex", files, "model string")
    zero = lambda c: F.coalesce(F.col(f"r.{c}"), F.lit(0)).cast("long").alias(c)
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said(), zero("tool_call_count"), zero("tool_result_count"), zero("diff_count"), _tokens("input"),
                       F.coalesce("r.status", F.lit("none")).alias("status"), F.coalesce("r.model", F.lit("none")).alias("model"), F.col("r.project_path").alias("project_path"), F.coalesce("r.updated_at", F.lit("none")).alias("updated_at"))


def scan_continue(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    blocks = F.concat(F.lit('[{"type":"text","text":'), _quoted("text"), F.lit('},{"type":"image"}]'))
    said = F.concat(F.lit('{"message":{"role":"'), "role", F.lit('","content":'), F.when(F.col("turn") % 2 == 0, blocks).otherwise(_quoted("text")), F.lit("}"))
    thought = F.when(F.col("turn") % 4 == 0, ',"reasoning":{"text":"why"}').otherwise("")
    calls = F.when(_is("assistant"), ',"toolCallStates":[{"status":"done","output":"o","tool":{"function":{"name":"f"}}},{"status":"pending"}]').otherwise("")
    head = F.concat(F.lit('{"sessionId":"s'), "conv_id", F.lit('","title":"t'), "conv_id", F.lit('","workspaceDirectory":"/w","history":[{"no":"message"},'))
    files = _files(turns, F.concat(F.lit("/h/.continue/sessions/"), "conv_id", F.lit(".json")), F.concat(said, thought, calls, F.lit("}")), head, F.lit("]}"), ",")
    files = files.unionByName(files.withColumn("path", F.lit("/h/.continue/sessions/sessions.json")))
    rows = _scanned("continue", files, "reasoning string, tool_results array<string>")
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said(), _sum(lambda m: m["reasoning"] == "why").alias("n_thoughts"), _sum(lambda m: F.size(m["tool_results"])).alias("n_results"), F.col("r.title").alias("title"))


def scan_gemini(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    kind = F.when(_is("user"), "user").when(_is("assistant"), "gemini").otherwise("info")
    call = lambda k, result: F.struct(F.lit(k).alias("id"), F.lit("n").alias("name"), F.lit("ok").alias("status"), F.lit(result).cast("string").alias("result"))
    tokens = F.struct(F.length("text").alias("input"), F.col("turn").alias("output"), F.lit(3).alias("cached"))
    line = _json(type=kind, content=F.col("text"), tokens=F.when(_is("assistant"), tokens), toolCalls=F.when(_is("assistant"), F.array(call("1", "r"), call("2", None))))
    head = F.concat(F.lit('{"sessionId":"s'), "conv_id", F.lit('","startTime":"a","lastUpdated":"b","messages":['))
    files = _files(turns, F.concat(F.lit("/h/.gemini/tmp/x/chats/session-"), "conv_id", F.lit(".json")), line, head, F.lit("]}"), ",")
    rows = _scanned("gemini", files, "tool_calls array<string>, tool_results array<string>")
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said(), _sum(lambda m: F.size(m["tool_calls"])).alias("n_calls"), _sum(lambda m: F.size(m["tool_results"])).alias("n_results"),
                       _tokens("input"), _tokens("output"), _tokens("cached_input"), F.col("r.created_at").alias("created_at"))


def scan_opencode(spark, sf_dir):
    """Sessions, messages and parts are files; every third session has no record of its own, and every message with turn % 7 = 6 has no parts."""
    turns = _turns(spark, sf_dir)
    root = "/h/.local/share/opencode/storage/"
    name = F.concat(F.lit("msg_"), "conv_id", F.lit("_"), F.lpad(F.col("turn").cast("string"), 6, "0"))
    at = lambda *parts: F.concat(F.lit(root), *parts, F.lit(".json")).alias("path")
    binary = lambda c: F.encode(c, "UTF-8").alias("content")
    tokens = F.struct(F.length("text").alias("input"), F.struct(F.lit(2).alias("read")).alias("cache"))
    message = turns.select(at(F.lit("message/ses_"), "conv_id", F.lit("/"), name), binary(_json(id=name, role=F.col("role"), time=F.struct(F.col("turn").alias("created")), tokens=tokens)))
    parts = turns.where("turn % 7 <> 6")
    part = lambda k, c, rows=parts: rows.select(at(F.lit("part/"), name, F.lit(f"/prt_{k}")), binary(c))
    text, code = _json(type=F.lit("text"), text=F.col("text")), _json(type=F.lit("code"), language=F.lit("py"), text=F.lit("x = 1"))
    tool = F.lit('{"type":"tool","tool":"run","callID":"c","state":{"status":"completed","output":"o","input":{}}}')
    meta = turns.where("conv_id % 3 <> 0").select("conv_id").distinct().select(at(F.lit("session/global/ses_"), "conv_id"), binary(_json(title=F.concat(F.lit("t"), "conv_id"), directory=F.lit("/d"), time=F.struct(F.lit(5).alias("created"), F.lit(9).alias("updated")))))
    files = message.unionByName(part(1, text)).unionByName(part(2, code, parts.where("turn % 4 = 1"))).unionByName(part(3, tool, parts.where("role = 'assistant'"))).unionByName(meta)
    rows = _scanned("opencode", files, "tool_calls array<string>, tool_results array<string>")
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said(), _sum(lambda m: F.size(m["tool_calls"])).alias("n_calls"), _sum(lambda m: F.size(m["tool_results"])).alias("n_results"), _tokens("input"), _tokens("cached_input"),
                       F.coalesce("r.title", F.lit("none")).alias("title"), F.col("r.created_at").cast("long").alias("created_at"), F.col("r.updated_at").cast("long").alias("updated_at"), F.coalesce("r.project_path", F.lit("none")).alias("project_path"))


def _chats(spark, sf_dir) -> DataFrame:
    """conv_id and its turns as an array, for files that hold a conversation in one value."""
    return _turns(spark, sf_dir).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def _no() -> Column:
    """conv_id in a path; one that is null still has a file."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("None"))


def _stores(spark, sf_dir, *paths: Column) -> DataFrame:
    """A file of each path for each conversation, whose turns come in place of its content."""
    path = paths[0] if len(paths) == 1 else F.explode(F.array(*paths))
    return _chats(spark, sf_dir).select(path.alias("path"), F.lit(None).cast("binary").alias("content"), "conv_id", "turns")


def scan_opencode_store(spark, sf_dir):
    def store(r: dict) -> bytes:
        entries = [(f"k{r['conv_id']}", {"session_id": f"s{r['conv_id']}", "title": "t", "messages": [{"role": t["role"], "content": t["text"]} for t in r["turns"]]}), ("other", {"no": 1}), ("text", "x")]
        data = b"".join(struct.pack("<I", len(k)) + k.encode() + struct.pack("<I", len(v)) + v for k, v in ((k, json.dumps(v).encode()) for k, v in entries))
        return data + struct.pack("<I", 50_000) + b"rest"

    rows = _scanned("opencode", _stores(spark, sf_dir, F.concat(F.lit("/h/ai.opencode.app/"), _no(), F.lit(".dat"))), "x string", store)
    return rows.select(_conv(), F.size("r.messages").cast("long").alias("n_messages"), _said())


def _database(tables: dict[str, list[tuple[str, object]]]) -> bytes:
    """The bytes of a state database with these tables of keys and JSON values."""
    db = sqlite3.connect(":memory:")
    for name, rows in tables.items():
        db.execute(f"CREATE TABLE {name} (key TEXT, value TEXT)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in rows])
    db.commit()
    return db.serialize()


def _bubble(t: dict) -> dict:
    return {"type": {"user": 1, "assistant": 2}.get(t["role"], 7), "text": t["text"]} | ({"suggestedCodeBlocks": [1]} if t["turn"] % 2 else {})


def scan_cursor(spark, sf_dir):
    """Four layouts: prompts and answers by place, composers and chat tabs of a workspace, and composers of the global store, with bubbles inline or apart."""

    def state(r: dict) -> bytes:
        c, turns = r["conv_id"], r["turns"]
        if "/globalStorage/" in r["path"]:
            composer = {"composerId": f"s{c}", "status": "done", "createdAt": 3} | ({"conversation": [_bubble(t) for t in turns]} if c % 2 == 0 else {"conversation": []})
            return _database({"cursorDiskKV": [(f"composerData:s{c}", composer), ("composerData:bad", "{"), *((f"bubbleId:s{c}:b{t['turn']:06}", _bubble(t)) for t in turns), ("bubbleId:zz:b1", {"type": 1, "text": "of nobody"})]})
        asked, answered = ([t for t in turns if t["role"] == role] for role in ("user", "assistant"))
        return _database({"ItemTable": [
            ("aiService.prompts", [{"text": t["text"], "commandType": 4} for t in asked]), ("aiService.generations", [{"text": t["text"], "model": "g"} for t in answered]),
            ("composer.composerData", {"allComposers": [{"composerId": f"s{c}", "name": "n", "modelConfig": {"modelName": "m"}, "conversation": [_bubble(t) for t in turns]}]}),
            ("workbench.panel.aichat.view.aichat.chatdata", {"tabs": [{"tabId": f"s{c}", "chatTitle": "t", "bubbles": [{"type": "user" if t["role"] == "user" else "ai", "rawText": t["text"]} for t in turns]}, {"bubbles": []}]})]})

    at = lambda *place: F.concat(F.lit("/h/"), _no(), F.lit("/Cursor/User/"), *place, F.lit("/state.vscdb"))
    files = _stores(spark, sf_dir, at(F.lit("workspaceStorage/w"), _no()), at(F.lit("globalStorage")), at(F.lit("workspaceStorage/ext-dev")))
    rows = scan_files("cursor", _named(files), state).select("src_file", F.from_json("raw", "source string, messages array<struct<role:string,content:string>>, has_diffs boolean, storage_type string").alias("r"))
    conv = F.regexp_extract("src_file", r"^/h/(\d+)/", 1).cast("long").alias("conv_id")
    told = rows.select(conv, F.col("r.source").alias("source"), F.col("r.messages").alias("m"), F.coalesce("r.has_diffs", F.lit(False)).alias("diffs"), F.coalesce("r.storage_type", F.lit("none")).alias("storage"))
    return told.groupBy("conv_id", "source", "storage").agg(F.count("*").alias("conversations"), F.sum(F.size("m")).alias("n_messages"), F.sum(F.aggregate("m", F.lit(0), lambda a, x: a + F.length(x["content"]))).alias("chars"),
                                                 F.sum(F.size(F.filter("m", lambda x: x["role"] == "user"))).alias("n_user"), F.max("diffs").alias("has_diffs"))


def scan_trae(spark, sf_dir):
    def store(r: dict) -> bytes:
        said = [{"role": t["role"], "content": t["text"]} for t in r["turns"]]
        table = {"ItemTable": [("a.chat.x", {"messages": said, "session_id": f"d{r['conv_id']}"}), ("b.agent", {"conversation": [*said, {"no": "role"}], "session_id": f"e{r['conv_id']}"}), ("other", {"messages": said}), ("c.chat", "not json")]}
        return _database(table)

    turns = _turns(spark, sf_dir)
    kind = F.when(_is("user"), "user_message").when(_is("assistant"), "agent").otherwise("note")
    head = F.concat(F.lit('{"type":"metadata","data":{"session_id":"s'), "conv_id", F.lit('"}}\n'))
    logs = _files(turns, F.concat(F.lit("/h/.trae/projects/"), "conv_id", F.lit(".jsonl")), _json(type=kind, message=F.col("text")), head)
    stores = _stores(spark, sf_dir, F.concat(F.lit("/h/.trae/"), _no(), F.lit(".vscdb")))
    rows = _scanned("trae", logs.unionByName(stores, allowMissingColumns=True), "x string", store)
    return rows.select(_conv(), F.substring("r.session_id", 1, 1).alias("kind"), F.size("r.messages").cast("long").alias("n_messages"), _said())


def scan_windsurf(spark, sf_dir):
    def state(r: dict) -> bytes:
        c, turns = r["conv_id"], r["turns"]
        tabs = {"tabs": [{"tabId": f"s{c}", "bubbles": [{"type": "user" if t["role"] == "user" else "ai", "text": t["text"]} for t in turns]}]}
        key = ("aiChat.chatdata", "cascade.chatdata")[c % 2]
        agent = {"conversation": [{"role": t["role"], "text": t["text"]} for t in turns], "name": f"s{c}"}
        if "/globalStorage/" in r["path"]:
            return _database({"ItemTable": [("x.cascade.y", agent)], "cursorDiskKV": [("flowData:1", agent), ("none:1", agent)]})
        return _database({"ItemTable": [(key, tabs), ("chat.data" if c % 2 == 0 else "zz", {"tabs": []})]})

    at = lambda *place: F.concat(F.lit("/h/"), _no(), F.lit("/Windsurf/User/"), *place, F.lit("/state.vscdb"))
    rows = scan_files("windsurf", _named(_stores(spark, sf_dir, at(F.lit("workspaceStorage/w"), _no()), at(F.lit("globalStorage")))), state).select("src_file", F.from_json("raw", "source string, messages array<struct<role:string,content:string>>").alias("r"))
    told = rows.select(F.regexp_extract("src_file", r"^/h/(\d+)/", 1).cast("long").alias("conv_id"), F.col("r.source").alias("source"), F.size("r.messages").cast("long").alias("n_messages"), _said())
    return told.groupBy("conv_id", "source", "n_messages", "said_sha256").agg(F.count("*").alias("conversations"))


def import_published(spark, sf_dir):
    turns = _turns(spark, sf_dir)
    blocks = F.concat(F.lit('[{"type":"thinking","thinking":"hm"},{"type":"text","text":'), _quoted("text"), F.lit('},{"type":"tool_use","name":"f"}]'))
    results = F.concat(F.lit('[{"type":"tool_result","tool_use_id":"c","content":[{"type":"text","text":"r"}]},{"type":"text","text":'), _quoted("text"), F.lit("}]"))
    usage = F.concat(F.lit(',"usage":{"input_tokens":'), F.length("text"), F.lit("}"))
    record = lambda kind, content, more=F.lit(""): F.concat(F.lit(f'{{"type":"{kind}","timestamp":"'), _at(), F.lit('","cwd":"/w/'), "turn", F.lit('","message":{"id":"m","content":'), content, more, F.lit("}}"))
    opening = F.lit('"[init] session start of it"')
    user = F.when(F.col("turn") % 4 == 0, record("user", results)).when(F.col("turn") % 4 == 3, record("user", opening)).otherwise(record("user", _quoted("text")))
    line = F.when(_is("user"), user).when(_is("assistant"), record("assistant", blocks, usage)).otherwise(F.concat(F.lit('{"type":"user","isSidechain":true,"message":{"content":'), _quoted("text"), F.lit("}}\n{bad")))
    files = _files(turns, F.concat(F.lit("/x/y/"), "conv_id", F.lit(".jsonl")), line).unionByName(_files(turns.where("conv_id % 6 = 1"), F.concat(F.lit("/x/broken/"), "conv_id", F.lit(".jsonl")), F.lit('{"type":"user","message":7}')))
    rows = converted_files(files, "/x", "pub")
    kinds = "messages array<struct<role:string,content:string,tool_uses:array<string>>>, session_id string, created_at string, updated_at string, project_path string, token_usage map<string,double>"
    rows = rows.select(F.regexp_extract("relative", r"(\d+)\.jsonl$", 1).cast("long").alias("conv_id"), F.col("relative").startswith("broken/").alias("broken"), "bad_lines", F.col("error").isNotNull().alias("failed"), F.from_json("raw", kinds).alias("r"))
    return rows.select("conv_id", "broken", "bad_lines", "failed", F.coalesce(F.size("r.messages"), F.lit(0)).cast("long").alias("n_messages"), F.coalesce(_said(), F.lit("none")).alias("said_sha256"), _tokens("input"), F.coalesce("r.project_path", F.lit("none")).alias("project_path"), F.coalesce("r.updated_at", F.lit("none")).alias("updated_at"))


QUERIES = {f.__name__: f for f in (scan_claude, scan_codex, scan_continue, scan_gemini, scan_opencode, scan_opencode_store, scan_cursor, scan_trae, scan_windsurf, import_published)}

# --- the same in SQL ---
_T = f"t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, '#' || turn || ' ' || coalesce(text, '') || CASE WHEN turn % 5 = 2 THEN chr({ord(BREAK)}) ELSE '' END || '.' AS text, '2024-03-01T' || lpad(CAST(turn AS VARCHAR), 6, '0') AS stamp FROM conversations)"


def _digest(order: str = "turn, k", where: str = "") -> str:
    return f"sha256(coalesce(string_agg(role || chr(10) || said || chr(10), '' ORDER BY {order}){where}, ''))"


ORACLE_SQL = {
    "scan_claude": f"""WITH {_T},
      m AS (SELECT conv_id, turn, 0 AS k, role, text AS said FROM t WHERE role IN ('user', 'assistant') UNION ALL SELECT conv_id, turn, 1, 'tool', '' FROM t WHERE role = 'user' AND turn % 4 = 0),
      f AS (SELECT conv_id, min(turn) AS first FROM m GROUP BY conv_id),
      u AS (SELECT conv_id, sum(i) AS tokens_input, sum(o) AS tokens_output FROM (SELECT conv_id, turn // 4 AS id, max(length(text)) AS i, max(turn) AS o FROM t WHERE role = 'assistant' GROUP BY 1, 2) GROUP BY conv_id),
      r AS (SELECT t.conv_id, count(*) FILTER (role = 'user' AND turn % 4 = 0 OR role NOT IN ('user', 'assistant') AND turn > first) AS n_results, count(*) FILTER (role = 'assistant') AS n_uses, min(stamp) AS created_at, max(stamp) AS updated_at,
        arg_max(CASE WHEN turn % 4 = 0 THEN '/b/' || turn ELSE '/w/' || t.conv_id % 5 || '/' || turn END, turn) FILTER (role = 'user') AS project_path FROM t JOIN f ON f.conv_id = t.conv_id GROUP BY t.conv_id)
      SELECT m.conv_id, count(*) AS n_messages, {_digest()} AS said_sha256, any_value(n_results) AS n_results, any_value(n_uses) AS n_uses, CAST(coalesce(any_value(tokens_input), 0) AS BIGINT) AS tokens_input, CAST(coalesce(any_value(tokens_output), 0) AS BIGINT) AS tokens_output,
        any_value(created_at) AS created_at, any_value(updated_at) AS updated_at, any_value(project_path) AS project_path
      FROM m JOIN r ON r.conv_id = m.conv_id LEFT JOIN u ON u.conv_id = m.conv_id WHERE NOT (m.conv_id % 11 = 3 AND n_uses > 0) GROUP BY m.conv_id""",
    "scan_codex": f"""WITH {_T},
      m AS (SELECT conv_id, turn, unnest(range(CASE WHEN role = 'user' AND turn % 3 = 0 THEN 2 ELSE 1 END)) AS k, role, text AS said FROM t WHERE role IN ('user', 'assistant')),
      r AS (SELECT conv_id, CAST(count(DISTINCT turn % 2) FILTER (role NOT IN ('user', 'assistant')) AS BIGINT) AS tool_call_count, count(*) FILTER (role NOT IN ('user', 'assistant')) AS tool_result_count, count(*) FILTER (role = 'user' AND turn % 4 = 1) AS diff_count,
        coalesce(max(turn * 10) FILTER (role = 'assistant'), 0) AS tokens_input, coalesce('gpt-' || arg_max(turn % 3, turn) FILTER (role = 'assistant'), 'none') AS model, max(stamp) AS updated_at FROM t GROUP BY conv_id)
      SELECT m.conv_id, count(*) AS n_messages, {_digest()} AS said_sha256, any_value(tool_call_count) AS tool_call_count, any_value(tool_result_count) AS tool_result_count, any_value(diff_count) AS diff_count, any_value(tokens_input) AS tokens_input,
        CASE m.conv_id % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'aborted' ELSE 'none' END AS status, any_value(model) AS model, '/w/' || m.conv_id % 3 AS project_path, any_value(updated_at) AS updated_at FROM m JOIN r ON r.conv_id = m.conv_id GROUP BY m.conv_id""",
    "scan_continue": f"""WITH {_T}, m AS (SELECT *, 0 AS k, text AS said FROM t) SELECT conv_id, count(*) AS n_messages, {_digest()} AS said_sha256, count(*) FILTER (turn % 4 = 0) AS n_thoughts, count(*) FILTER (role = 'assistant') AS n_results, 't' || conv_id AS title FROM m GROUP BY conv_id""",
    "scan_gemini": f"""WITH {_T}, m AS (SELECT *, 0 AS k, text AS said FROM t WHERE role IN ('user', 'assistant'))
      SELECT conv_id, count(*) AS n_messages, {_digest()} AS said_sha256, 2 * count(*) FILTER (role = 'assistant') AS n_calls, count(*) FILTER (role = 'assistant') AS n_results, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS tokens_input,
        CAST(coalesce(sum(turn) FILTER (role = 'assistant'), 0) AS BIGINT) AS tokens_output, 3 * count(*) FILTER (role = 'assistant') AS tokens_cached_input, 'a' AS created_at FROM m GROUP BY conv_id""",
    "scan_opencode": f"""WITH {_T}, m AS (SELECT *, 0 AS k, CASE WHEN turn % 7 = 6 THEN '' ELSE text || CASE WHEN turn % 4 = 1 THEN chr(10) || '```py' || chr(10) || 'x = 1' || chr(10) || '```' ELSE '' END END AS said FROM t)
      SELECT conv_id, count(*) AS n_messages, {_digest()} AS said_sha256, count(*) FILTER (role = 'assistant' AND turn % 7 <> 6) AS n_calls, count(*) FILTER (role = 'assistant' AND turn % 7 <> 6) AS n_results, CAST(sum(length(text)) AS BIGINT) AS tokens_input, 2 * count(*) AS tokens_cached_input,
        CASE WHEN conv_id % 3 <> 0 THEN 't' || conv_id ELSE 'none' END AS title, CASE WHEN conv_id % 3 <> 0 THEN 5 ELSE min(turn) FILTER (turn > 0) END AS created_at, CASE WHEN conv_id % 3 <> 0 THEN 9 ELSE max(turn) FILTER (turn > 0) END AS updated_at, CASE WHEN conv_id % 3 <> 0 THEN '/d' ELSE 'none' END AS project_path FROM m GROUP BY conv_id""",
    "scan_opencode_store": f"""WITH {_T}, m AS (SELECT *, 0 AS k, text AS said FROM t) SELECT conv_id, count(*) AS n_messages, {_digest()} AS said_sha256 FROM m GROUP BY conv_id""",
    "scan_cursor": f"""WITH {_T},
      s AS (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'user') AS u, count(*) FILTER (role = 'assistant') AS a, sum(length(text)) AS c, coalesce(sum(length(text)) FILTER (role IN ('user', 'assistant')), 0) AS ca, coalesce(max(turn % 2) FILTER (role = 'assistant'), 0) = 1 AS d FROM t GROUP BY conv_id)
      SELECT conv_id, 'cursor-aiservice' AS source, 'none' AS storage, greatest(u, a) AS conversations, CAST(u + a AS BIGINT) AS n_messages, CAST(ca AS BIGINT) AS chars, CAST(u AS BIGINT) AS n_user, false AS has_diffs FROM s WHERE u + a > 0
      UNION ALL SELECT conv_id, 'cursor-workspace-composer', 'none', 1, CAST(u + a AS BIGINT), CAST(ca AS BIGINT), CAST(u AS BIGINT), d FROM s WHERE u + a > 0
      UNION ALL SELECT conv_id, 'cursor-chat', 'none', 1, CAST(n AS BIGINT), CAST(c AS BIGINT), CAST(u AS BIGINT), false FROM s
      UNION ALL SELECT conv_id, 'cursor-global-composer', 'inline', 1, CAST(u + a AS BIGINT), CAST(ca AS BIGINT), CAST(u AS BIGINT), d FROM s WHERE conv_id % 2 = 0 AND u + a > 0
      UNION ALL SELECT conv_id, 'cursor-global-composer', 'separate', 1, CAST(n AS BIGINT), CAST(c AS BIGINT), CAST(u AS BIGINT), d FROM s WHERE conv_id % 2 = 1""",
    "scan_trae": f"""WITH {_T}, m AS (SELECT *, 0 AS k, text AS said FROM t)
      SELECT conv_id, kind, count(*) AS n_messages, {_digest()} AS said_sha256 FROM (SELECT m.*, 'd' AS kind FROM m UNION ALL SELECT m.*, 'e' FROM m UNION ALL SELECT m.*, 's' FROM m WHERE role IN ('user', 'assistant')) GROUP BY conv_id, kind""",
    "scan_windsurf": f"""WITH {_T}, m AS (SELECT conv_id, turn, 0 AS k, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text AS said FROM t), a AS (SELECT *, 0 AS k, text AS said FROM t WHERE role IN ('user', 'assistant'))
      SELECT conv_id, 'windsurf-chat' AS source, count(*) AS n_messages, {_digest()} AS said_sha256, CAST(1 AS BIGINT) AS conversations FROM m GROUP BY conv_id
      UNION ALL SELECT conv_id, 'windsurf-agent', count(*), {_digest()}, 2 FROM a GROUP BY conv_id""",
    "import_published": f"""WITH {_T},
      m AS (SELECT conv_id, turn, 0 AS k, role, CASE WHEN role = 'assistant' THEN '<reasoning_summary>hm</reasoning_summary>' || chr(10) || text WHEN turn % 4 = 0 THEN text || chr(10) || '<tool_result id="c">r</tool_result>' ELSE text END AS said, length(text) AS size
        FROM t WHERE role = 'assistant' OR role = 'user' AND turn % 4 <> 3),
      l AS (SELECT conv_id, max(turn) AS last FROM m WHERE role = 'assistant' GROUP BY conv_id),
      c AS (SELECT m.conv_id, count(*) AS n_messages, {_digest()} AS said_sha256 FROM m JOIN l ON l.conv_id = m.conv_id AND m.turn <= l.last GROUP BY m.conv_id HAVING count(*) >= 2),
      r AS (SELECT conv_id, count(*) FILTER (role NOT IN ('user', 'assistant')) AS bad_lines, max(stamp) FILTER (role IN ('user', 'assistant')) AS updated_at, '/w/' || max(turn) FILTER (role IN ('user', 'assistant')) AS project_path, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS tokens FROM t GROUP BY conv_id)
      SELECT r.conv_id, false AS broken, bad_lines, false AS failed, coalesce(n_messages, 0) AS n_messages, coalesce(said_sha256, 'none') AS said_sha256, CASE WHEN n_messages IS NULL THEN 0 ELSE CAST(tokens AS BIGINT) END AS tokens_input,
        CASE WHEN n_messages IS NULL THEN 'none' ELSE project_path END AS project_path, CASE WHEN n_messages IS NULL THEN 'none' ELSE updated_at END AS updated_at FROM r LEFT JOIN c ON c.conv_id = r.conv_id
      UNION ALL SELECT DISTINCT conv_id, true, 0, true, 0, 'none', 0, 'none', 'none' FROM t WHERE conv_id % 6 = 1""",
}
