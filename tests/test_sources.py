"""Each kind of log, from files as the agents leave them."""

import json
import os
import sqlite3
import struct

import pytest

from loomspan.sources import installs
from loomspan.sources.lines import checked, read_large_lines, read_lines
from loomspan.sources.published import import_published


def put(path, *records, text=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text if text is not None else "".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def state(path, **tables):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with sqlite3.connect(path) as db:
        for name, rows in tables.items():
            db.execute(f"CREATE TABLE {name} (key TEXT, value TEXT)")
            db.executemany(f"INSERT INTO {name} VALUES (?, ?)", [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in rows])


def scan(spark, root, source):
    rows = installs.extract(spark, str(root), [source], "Linux").collect()
    return [json.loads(r["raw"]) for r in sorted(rows, key=lambda r: (r["src_file"], r["line_no"]))]


def said(conv):
    return [(m["role"], m["content"]) for m in conv["messages"]]


def claude(kind, content, n, **more):
    return {"type": kind, "timestamp": f"2026-01-0{n}", "message": {"role": kind, "content": content, **more.pop("message", {})}, **more}


def test_claude_code(spark, tmp_path):
    usage = lambda i, o: {"usage": {"input_tokens": i, "output_tokens": o}}
    base = f"{tmp_path}/.claude/projects/demo"
    put(f"{base}/s1.jsonl", claude("user", "hi", 2, cwd="/w", uuid="u1"), "{broken", claude("assistant", [{"type": "text", "text": "yo"}, {"type": "tool_use", "id": "t", "name": "ls", "input": {}}], 1, message={"id": "m1", "model": "c", **usage(3, 1)}),
        claude("assistant", "more", 3, message={"id": "m1", **usage(5, 2)}), claude("assistant", "anon", 3, message=usage(7, 4)), {"type": "tool_result", "toolResult": {"x": 1}},
        claude("user", [{"type": "tool_result", "tool_use_id": "t", "content": "out", "is_error": True}], 4), {"type": "ai-title", "version": "9"})
    put(f"{base}/agent-x.jsonl", claude("user", "no", 1))
    put(f"{base}/synth.jsonl", claude("user", "q", 1), claude("assistant", "a", 1, message={"model": "<synthetic>"}))
    put(f"{base}/side.jsonl", claude("user", "q", 1), claude("assistant", "a", 1), *({"type": t} for t in ("attachment", "queue-operation", "last-prompt")))
    (c,) = scan(spark, tmp_path, "claude_code")
    assert said(c) == [("user", "hi"), ("assistant", "yo"), ("assistant", "more"), ("assistant", "anon"), ("tool", "")]
    assert c["token_usage"] == {"input": 12, "output": 6} and (c["session_id"], c["project_path"], c["project_name"], c["version"]) == ("s1", "/w", "demo", "9")
    assert (c["created_at"], c["updated_at"]) == ("2026-01-01", "2026-01-04") and c["messages"][3]["tool_results"] == [{"x": 1}]
    assert c["messages"][4]["tool_results"] == [{"tool_call_id": "t", "status": "error", "output": "out"}] and c["installation"] == f"{tmp_path}/.claude"


def test_codex(spark, tmp_path):
    event = lambda kind, n=1, **p: {"type": "event_msg", "timestamp": f"t{n}", "payload": {"type": kind, **p}}
    item = lambda kind, **p: {"type": "response_item", "timestamp": "t5", "payload": {"type": kind, **p}}
    message = lambda role, text: item("message", role=role, content=[{"type": "input_text", "text": text}])
    put(f"{tmp_path}/.codex/sessions/2026/01/rollout-1.jsonl",
        {"type": "session_meta", "payload": {"id": "s", "cwd": "/w", "timestamp": "t0", "cli_version": "1"}}, {"type": "turn_context", "payload": {"model": "g"}}, message("developer", "memory"), event("user_message", message="yes"), message("user", "yes"),
        event("agent_message", message="done"), message("assistant", "done"), event("user_message", message="yes"), message("user", "yes"), item("function_call", call_id="a"), event("tool_use", call_id="a", tool="x"), item("web_search_call"),
        item("function_call_output", call_id="a"), event("tool_result", call_id="a", output=1), event("patch_apply_end", changes={"f": 1}), event("patch_apply_end", changes={}), event("diff", id="d", file="f"), event("diff", id="d", file="f"),
        event("token_count", info={"total_token_usage": {"input_tokens": 4, "total_tokens": 9}}), event("task_complete", 8))
    put(f"{tmp_path}/.codex/sessions/other.jsonl", message("user", "not a rollout"))
    (c,) = scan(spark, tmp_path, "codex")
    assert said(c) == [("developer", "memory"), ("user", "yes"), ("assistant", "done"), ("user", "yes")]
    assert (c["tool_call_count"], c["tool_result_count"], c["diff_count"]) == (2, 1, 2) and len(c["tool_results"]) == 4
    assert c["token_usage"] == {"input": 4, "total": 9} and (c["model"], c["status"], c["updated_at"], c["version"]) == ("g", "completed", "t8", "1") and c["messages"][2]["model"] == "g"


def test_continue_and_gemini(spark, tmp_path):
    history = [{"message": {"role": "user", "content": [{"type": "text", "text": "q"}]}, "contextItems": [1]},
               {"message": {"role": "assistant", "content": "a", "toolCalls": [{}]}, "reasoning": {"text": "r"}, "toolCallStates": [{"status": "done", "output": 5, "tool": {"function": {"name": "f"}}}, {"status": "run"}]}]
    put(f"{tmp_path}/.continue/sessions/x.json", {"sessionId": "i", "title": "T", "workspaceDirectory": "/w", "history": history})
    put(f"{tmp_path}/.continue/sessions/sessions.json", {"history": history})
    put(f"{tmp_path}/.continue/sessions/bad.json", text="{")
    (c,) = scan(spark, tmp_path, "continue")
    assert c["messages"][0] == {"role": "user", "content": "q", "context_items": [1]} and c["messages"][1]["tool_results"] == [{"tool": "f", "output": 5}] and c["messages"][1]["reasoning"] == "r" and c["project_path"] == "/w"
    turn = {"type": "gemini", "content": "a", "id": "2", "model": "g", "thoughts": ["t"], "tokens": {"input": 1, "cached": 2, "thoughts": 0}, "toolCalls": [{"id": "c", "name": "n", "args": 1, "result": 2, "status": "ok"}, "odd"]}
    put(f"{tmp_path}/.gemini/tmp/h/chats/session-1.json", {"sessionId": "s", "projectHash": "h", "startTime": "t", "messages": [{"type": "user", "content": "q"}, turn, {"type": "info"}, turn]})
    (g,) = scan(spark, tmp_path, "gemini")
    assert g["source"] == "gemini-cli" and said(g) == [("user", "q"), ("assistant", "a"), ("assistant", "a")] and g["token_usage"] == {"input": 2, "cached_input": 4}
    assert g["messages"][1]["tool_calls"] == [{"id": "c", "name": "n", "status": "ok", "input": 1}] and g["messages"][1]["tool_results"][0]["output"] == 2


def test_cursor(spark, tmp_path):
    user = "%s/.config/Cursor/User" % tmp_path
    pick = [{"uri": {"fsPath": "/f"}, "text": "c", "range": 1}, {}]
    state(f"{user}/workspaceStorage/w1/state.vscdb", ItemTable=[
        ("aiService.prompts", [{"text": "p1", "commandType": 4}]), ("aiService.generations", [{"text": "g1", "modelId": "m"}, {"message": "g2"}]),
        ("composer.composerData", {"allComposers": [{"composerId": "c", "conversation": [{"type": 1, "text": "q", "context": {"selections": pick}}, {"type": 2, "text": "a", "modelId": "x", "codeBlocks": [1]}, {"type": 3}]}, {"composerId": "e"}]}),
        ("workbench.panel.aichat.view.aichat.chatdata", {"tabs": [{"tabId": "t", "bubbles": [{"type": "user", "rawText": "r", "selections": pick}, {"type": "ai", "text": "b", "suggestedDiffs": [1]}]}]})])
    state(f"{user}/workspaceStorage/ext-dev/state.vscdb", ItemTable=[("aiService.prompts", [{"text": "no"}])])
    state(f"{user}/globalStorage/state.vscdb", cursorDiskKV=[
        ("composerData:in", {"conversation": [{"type": 1, "text": "i"}], "modelConfig": {"modelName": "M"}}), ("composerData:out", {"composerId": "out", "createdAt": 5}), ("bubbleId:out:b1", {"type": 1, "text": "s", "selections": pick}),
        ("bubbleId:out:b2", {"type": 2, "text": "t", "toolResults": [1], "model": "lost"}), ("bubbleId:out:b3", "{"), ("composerData:none", "")])
    got = {(c["source"], c.get("composer_id") or c["messages"][0]["content"]): c for c in scan(spark, tmp_path, "cursor")}
    assert set(got) == {("cursor-aiservice", "p1"), ("cursor-aiservice", "g2"), ("cursor-workspace-composer", "c"), ("cursor-chat", "r"), ("cursor-global-composer", "in"), ("cursor-global-composer", "out")}
    assert got[("cursor-aiservice", "p1")]["model"] == "m" and got[("cursor-aiservice", "p1")]["messages"][0]["command_type"] == 4
    w = got[("cursor-workspace-composer", "c")]
    assert w["messages"][0]["code_context"] == [{"file": "/f", "code": "c", "range": 1}] and w["messages"][1]["model"] is None and w["has_code_context"] and not w["has_diffs"]
    out = got[("cursor-global-composer", "out")]
    assert [m["bubble_id"] for m in out["messages"]] == ["b1", "b2"] and out["messages"][1] == {"role": "assistant", "content": "t", "model": None, "tool_results": [1], "bubble_id": "b2"} and out["storage_type"] == "separate"


def test_opencode(spark, tmp_path):
    base = f"{tmp_path}/.local/share/opencode/storage"
    put(f"{base}/message/ses_1/msg_1.json", {"id": "msg_1", "role": "user", "time": {"created": 5}, "path": {"cwd": "/w"}})
    put(f"{base}/message/ses_1/msg_2.json", {"id": "msg_2", "time": {"created": 9}, "modelID": "m", "tokens": {"input": 1, "cache": {"read": 2}}, "cost": 1})
    put(f"{base}/message/ses_2/msg_3.json", {"id": "msg_3", "role": "user"})
    put(f"{base}/message/ses_1/msg_4.json", text="{")
    put(f"{base}/part/msg_1/prt_1.json", {"type": "text", "text": "q"})
    for n, p in enumerate([{"type": "text", "text": "a"}, {"type": "code", "text": "x", "language": "py"}, {"type": "reasoning", "text": "r"}, {"type": "tool", "callID": "c", "tool": "t", "state": {"status": "completed", "input": 1, "output": 2}}, {"type": "tool-result", "toolCallID": "d", "output": 3}]):
        put(f"{base}/part/msg_2/prt_{n}.json", p)
    put(f"{base}/session/global/ses_1.json", {"title": "T", "time": {"created": 1, "updated": 2}, "directory": None, "projectID": "P", "parentID": "x"})
    blob = b"".join(struct.pack("<I", len(k)) + k + struct.pack("<I", len(v)) + v for k, v in ((b"session:1", json.dumps({"history": [{"role": "user", "content": "d"}], "title": "D"}).encode()), (b"x", b"{}"), (b"bad", b"{"))) + struct.pack("<I", 99999)
    os.makedirs(f"{tmp_path}/.local/share/ai.opencode.app")
    with open(f"{tmp_path}/.local/share/ai.opencode.app/store.dat", "wb") as f:
        f.write(blob)
    desktop, one, two = sorted(scan(spark, tmp_path, "opencode"), key=lambda c: (c["source"] == "opencode-cli", c.get("session_id", "")))
    assert desktop["source"] == "opencode-desktop" and desktop["store_key"] == "session:1" and desktop["title"] == "D"
    assert said(one) == [("user", "q"), ("assistant", "a\n```py\nx\n```")] and one["token_usage"] == {"input": 1, "cached_input": 2}
    assert (one["title"], one["created_at"], one["project_path"], one["parent_session_id"]) == ("T", 1, "/w", "x") and one["messages"][1]["reasoning"] == "r"
    assert one["messages"][1]["tool_calls"] == [{"id": "c", "name": "t", "input": 1}] and [x["output"] for x in one["messages"][1]["tool_results"]] == [2, 3]
    assert two["session_id"] == "ses_2" and two["messages"][0]["content"] == "" and two["project_path"] is None


def test_trae_and_windsurf(spark, tmp_path):
    put(f"{tmp_path}/.trae/projects/p/a.jsonl", {"type": "user", "message": "q", "files": [1]}, {"role": "agent", "content": "a", "edits": [2]}, {"type": "metadata", "data": {"source": "mine", "k": 1}})
    put(f"{tmp_path}/.trae/elsewhere/b.jsonl", {"type": "user", "message": "no"})
    state(f"{tmp_path}/.trae/x.db", ItemTable=[("my.chat", {"conversation": [{"role": "user", "content": "d"}, {"x": 1}], "z": 1}), ("other", {"messages": [1]})])
    a, b = sorted(scan(spark, tmp_path, "trae"), key=lambda c: c["source"])
    assert a["source"] == "mine" and a["k"] == 1 and a["messages"][0]["files"] == [1] and a["messages"][1]["edits"] == [2]
    assert said(b) == [("user", "d")] and b["z"] == 1
    user = f"{tmp_path}/.config/Windsurf/User"
    state(f"{user}/workspaceStorage/w/state.vscdb", ItemTable=[("chat.data", {"tabs": [{"bubbles": [{"type": "user", "text": "q"}, {"rawText": "a", "suggestedDiffs": []}]}]}), ("cascade.chatdata", {"tabs": []})])
    state(f"{user}/globalStorage/state.vscdb", cursorDiskKV=[("agentData:1", {"conversation": [{"type": 1, "text": "g"}, {"role": "assistant", "text": "h", "suggestedCodeBlocks": []}], "name": "N"})], ItemTable=[("a.flow.b", {"conversation": [{"role": "user", "text": "f"}]}), ("z", {})])
    got = sorted(scan(spark, tmp_path, "windsurf"), key=lambda c: said(c)[0][1])
    assert [said(c) for c in got] == [[("user", "f")], [("user", "g"), ("assistant", "h")], [("user", "q"), ("assistant", "a")]] and got[1]["messages"][1]["suggested_code_blocks"] == [] and got[2]["messages"][1]["suggested_diffs"] == []


def test_choice_of_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        installs.chosen(["nothing"])
    assert installs.extract(spark, str(tmp_path), None, "Linux").collect() == [] and installs.find_installs("codex", str(tmp_path), "Linux") == []
    os.makedirs(tmp_path / ".codex")
    os.symlink(tmp_path / ".codex", tmp_path / "codex")
    assert installs.find_installs("codex", str(tmp_path), "Linux") == [os.path.realpath(tmp_path / ".codex")]


def test_import_with_receipt(spark, tmp_path):
    source = f"{tmp_path}/in"
    put(f"{source}/d/good.jsonl", {"type": "user", "message": {"content": "[init] session start"}}, {"type": "user", "isSidechain": True, "message": {"content": "side"}}, {"type": "custom-title", "customTitle": "Name"},
        claude("user", [{"type": "text", "text": "q"}, {"type": "tool_result", "tool_use_id": "t", "content": [{"type": "text", "text": "o"}]}], 2, cwd="/w"), "{cut",
        claude("assistant", [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "a"}], 1, message={"id": "m", "usage": {"input_tokens": 2}}), claude("assistant", "b", 3, message={"id": "m", "usage": {"input_tokens": 2}}), claude("user", "late", 4))
    put(f"{source}/bad.jsonl", "{", )
    put(f"{source}/odd.jsonl", {"type": "user", "message": [1]})
    put(f"{source}/lone.jsonl", claude("assistant", "a", 1))
    receipt = import_published(spark, source, "pub-1", f"{tmp_path}/raw/pub-1")
    assert [receipt[k] for k in ("files_scanned", "files_failed", "files_skipped", "lines_failed", "conversations")] == [4, 1, 2, 2, 1] and receipt["failures"][0]["path"] == "odd.jsonl" and len(receipt["source_manifest_sha256"]) == 64
    (row,) = read_lines(spark, f"{tmp_path}/raw/pub-1").collect()
    c = json.loads(row["raw"])
    assert said(c) == [("user", 'q\n<tool_result id="t">o</tool_result>'), ("assistant", "<reasoning_summary>hm</reasoning_summary>\na"), ("assistant", "b")]
    assert c["token_usage"] == {"input": 4} and (c["name"], c["session_id"], c["source_file"], c["project_path"]) == ("Name", "d/good", "d/good.jsonl", "/w")
    for bad in ("..", "a/b"):
        with pytest.raises(ValueError):
            import_published(spark, source, bad, f"{tmp_path}/other")
    with pytest.raises(FileExistsError):
        import_published(spark, source, "pub-1", f"{tmp_path}/raw/pub-1")
    with pytest.raises(FileNotFoundError):
        import_published(spark, f"{tmp_path}/absent", "x", f"{tmp_path}/other")


def test_lines(spark, tmp_path):
    put(f"{tmp_path}/in/a.jsonl", text='{"a": 1}\n\n  \n{"a": 2}\n{"a"')
    rows = read_lines(spark, f"{tmp_path}/in")
    assert [(r["line_no"], r["raw"]) for r in rows.orderBy("line_no").collect()] == [(1, '{"a": 1}'), (4, '{"a": 2}'), (5, '{"a"')]
    with pytest.raises(Exception, match="not JSON"):
        checked(rows).collect()
    put(f"{tmp_path}/big/b.jsonl", text="".join(f'{{"n": {i}}}\n' for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = read_large_lines(spark, f"{tmp_path}/big").orderBy("src_file", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r["raw"])["n"] for r in got] == list(range(2000))
