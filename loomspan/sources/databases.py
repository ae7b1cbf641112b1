"""Editor state databases (SQLite files, read as bytes and opened in memory) as normalized conversations."""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator

from ..fixed import CHAT_KEYS


class State:
    """Key-value tables of a state database; nothing is ever written to the file."""

    def __init__(self, content: bytes):
        data = bytearray(content)
        if data[18:20] == b"\x02\x02":  # a write-ahead journal, which an in-memory copy cannot have
            data[18:20] = b"\x01\x01"
        self.db = sqlite3.connect(":memory:")
        self.db.deserialize(bytes(data))
        self.db.text_factory = lambda b: b.decode("utf-8", "replace")
        self.tables = {r[0] for r in self.db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}

    def item(self, key: str):
        row = self.db.execute("SELECT value FROM ItemTable WHERE key = ?", (key,)).fetchone() if "ItemTable" in self.tables else None
        return json.loads(row[0]) if row else None

    def like(self, table: str, *patterns: str) -> Iterator[tuple[str, object]]:
        """Keys that fit a pattern and their values, in the order of the table; values that are not JSON are passed over."""
        if table in self.tables:
            where = " OR ".join(["key LIKE ?"] * len(patterns))
            for key, value in self.db.execute(f"SELECT key, value FROM {table} WHERE {where} ORDER BY rowid", patterns).fetchall():
                try:
                    yield key, json.loads(value) if value else None
                except ValueError:
                    continue


def _quiet(make) -> list[dict]:
    """What make yields until it breaks off on data of another shape."""
    out: list[dict] = []
    try:
        for x in make:
            out.append(x)
    except Exception:  # noqa: BLE001 - a layout that is not there must not hide the others
        pass
    return out


def _selections(found) -> list[dict]:
    return [{"file": s["uri"]["fsPath"], "code": s.get("text", s.get("rawText", "")), "range": s.get("range")} for s in found or [] if "fsPath" in s.get("uri", {})]


def _model_of(bubble: dict) -> dict:
    return next(({"model": bubble[k]} for k in ("modelId", "model", "modelName") if k in bubble), {})


_BLOCKS = {"codeBlocks": "code_blocks", "suggestedCodeBlocks": "suggested_code_blocks", "diffHistories": "diff_histories"}


def _user(bubble: dict, found) -> dict:
    out = {"role": "user", "content": bubble.get("text", "")}
    ctx = _selections(found)
    return out | ({"code_context": ctx} if ctx else {})


def _assistant(bubble: dict, blocks: dict[str, str] = _BLOCKS) -> dict:
    return {"role": "assistant", "content": bubble.get("text", ""), **_model_of(bubble), **{ours: bubble[k] for k, ours in blocks.items() if bubble.get(k)}}


def _composed(bubbles) -> list[dict]:
    """Messages of inline bubbles: type 1 is the user, type 2 the assistant, others are left out."""
    out = []
    for b in bubbles:
        if b.get("type") == 1:
            out.append(_user(b, (b.get("context") or {}).get("selections")))
        elif b.get("type") == 2:
            out.append(_assistant(b))
    return out


def _flags(messages: list[dict]) -> dict:
    return {"has_code_context": any(m.get("code_context") for m in messages), "has_diffs": any(m.get("suggested_code_blocks") or m.get("diff_histories") for m in messages)}


def _with_model(messages: list[dict], model) -> list[dict]:
    """The composer's model stands for that of each of its answers, known or not."""
    return [m | {"model": model} if m["role"] == "assistant" else m for m in messages]


def _prompts(state: State, workspace: str) -> Iterator[dict]:
    asked, answered = state.item("aiService.prompts") or [], state.item("aiService.generations") or []
    for i in range(max(len(asked), len(answered))):
        messages, model = [], None
        if i < len(asked):
            messages.append({"role": "user", "content": asked[i].get("text", ""), "command_type": asked[i].get("commandType")})
        if i < len(answered):
            g = answered[i]
            model = g.get("model") or g.get("modelId") or g.get("modelName")
            messages.append({"role": "assistant", "content": g.get("text", g.get("message", "")), "model": model})
        yield {"messages": messages, "source": "cursor-aiservice", "workspace_id": workspace, **({"model": model} if model else {})}


def _workspace_composers(state: State, workspace: str) -> Iterator[dict]:
    data = state.item("composer.composerData")
    every = data.get("allComposers") if isinstance(data, dict) else None
    for c in every if isinstance(every, list) else []:
        messages = _composed(c.get("conversation", [])) if isinstance(c, dict) else []
        if messages:
            model = c.get("modelConfig", {}).get("modelName")
            yield {"messages": _with_model(messages, model), "source": "cursor-workspace-composer", "composer_id": c.get("composerId"), "name": c.get("name", "Untitled"), "workspace_id": workspace, "model": model, **_flags(messages)}


def _tabs(data, workspace: str, source: str, diffs_always: bool) -> Iterator[dict]:
    for tab in data.get("tabs", []) if data else []:
        messages = []
        for b in tab.get("bubbles", []):
            m = {"role": "user" if b.get("type") == "user" else "assistant", "content": b.get("rawText", b.get("text", ""))}
            ctx = _selections(b.get("selections"))
            if ctx:
                m["code_context"] = ctx
            if "suggestedDiffs" in b and (diffs_always or b["suggestedDiffs"]):
                m["suggested_diffs"] = b["suggestedDiffs"]
            messages.append(m)
        if messages:
            out = {"messages": messages, "source": source, "chat_title": tab.get("chatTitle"), "tab_id": tab.get("tabId"), "workspace_id": workspace, "has_code_context": any("code_context" in m for m in messages)}
            yield out if diffs_always else out | {"has_diffs": any(m.get("suggested_diffs") for m in messages)}


def _global_composers(state: State) -> Iterator[dict]:
    apart: dict[str, list[tuple[str, dict]]] = {}
    for key, b in state.like("cursorDiskKV", "bubbleId:%"):
        parts = key.split(":")
        if b and len(parts) > 2:
            apart.setdefault(parts[1], []).append((parts[2], b))
    for key, c in state.like("cursorDiskKV", "composerData:%"):
        if not isinstance(c, dict):
            continue
        name = c.get("composerId", key.split(":")[1])
        inline = c.get("conversation", [])
        messages = _composed(inline)
        if not inline:
            for bubble, b in apart.get(name, []):
                made = _assistant(b, _BLOCKS | {"toolResults": "tool_results"}) if b.get("type") == 2 else _user(b, b.get("selections") if b.get("type") == 1 else None)
                messages.append(made | {"bubble_id": bubble, "role": "user" if b.get("type") == 1 else "assistant"})
        if messages:
            model = c.get("modelConfig", {}).get("modelName")
            yield {"messages": _with_model(messages, model), "source": "cursor-global-composer", "composer_id": name, "name": c.get("name", "Untitled"), "status": c.get("status"), "unified_mode": c.get("unifiedMode"),
                   "created_at": c.get("createdAt"), "updated_at": c.get("lastUpdatedAt"), "model": model, **_flags(messages), "storage_type": "inline" if inline else "separate"}


def _place(path: str) -> tuple[str, str, str]:
    """installation, kind of storage and workspace of a state database."""
    head, _, tail = path.partition("/User/")
    parts = tail.split("/")
    return head, parts[0], parts[1] if len(parts) > 2 else ""


def cursor(path: str, content: bytes) -> Iterator[str]:
    install, kind, workspace = _place(path)
    if kind == "workspaceStorage" and workspace and workspace != "ext-dev":
        state = State(content)
        found = [*_quiet(_prompts(state, workspace)), *_quiet(_workspace_composers(state, workspace)), *_quiet(_tabs(state.item(CHAT_KEYS[0]), workspace, "cursor-chat", False))]
    elif kind == "globalStorage":
        found = [c | {"installation": install} for c in _quiet(_global_composers(State(content)))]
    else:
        return
    yield from (json.dumps(c, ensure_ascii=False) for c in found)


def _agent(data) -> dict | None:
    messages = []
    for b in data["conversation"] if isinstance(data, dict) and isinstance(data.get("conversation"), list) else []:
        if b.get("type") == 1 or b.get("role") == "user":
            messages.append(_user(b, (b.get("context") or {}).get("selections")))
        elif b.get("type") == 2 or b.get("role") == "assistant":
            messages.append({"role": "assistant", "content": b.get("text", ""), **{ours: b[k] for k, ours in (("suggestedCodeBlocks", "suggested_code_blocks"), ("diffHistories", "diff_histories")) if k in b}})
    if not messages:
        return None
    return {"messages": messages, "source": "windsurf-agent", "name": data.get("name", "Untitled"), "status": data.get("status"), "created_at": data.get("createdAt"), "updated_at": data.get("lastUpdatedAt")}


def windsurf(path: str, content: bytes) -> Iterator[str]:
    install, kind, workspace = _place(path)
    state = State(content)
    found: list[dict] = []
    if kind == "workspaceStorage" and workspace:
        for key in CHAT_KEYS:
            try:
                data = state.item(key)
            except ValueError:
                continue
            if data is not None:
                found = _quiet(_tabs(data, workspace, "windsurf-chat", True))
                break
    elif kind == "globalStorage":
        rows = [*state.like("cursorDiskKV", "composerData:%", "agentData:%", "flowData:%"), *state.like("ItemTable", "%agent%", "%flow%", "%cascade%")]
        found = [c | {"installation": install} for _, v in rows for c in _quiet(x for x in [_agent(v)] if x)]
    yield from (json.dumps(c, ensure_ascii=False) for c in found)


def trae(path: str, content: bytes) -> Iterator[str]:
    for _, data in State(content).like("ItemTable", "%chat%", "%conversation%", "%agent%"):
        if not isinstance(data, dict):
            continue
        said = data["conversation"] if isinstance(data.get("conversation"), list) else []
        messages = data["messages"] if "messages" in data else [x for x in said if isinstance(x, dict) and "role" in x]
        if messages:
            yield json.dumps({"messages": messages, "source": "trae", "source_file": path, **{k: v for k, v in data.items() if k not in ("messages", "conversation")}, "installation": os.path.dirname(path)}, ensure_ascii=False)
