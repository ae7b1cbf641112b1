"""Statistics, samples, splits and windows."""

import hashlib
import json
import random

import pytest

from loomspan.functions.rank import numbered
from loomspan.operators import corpus

LINES = "src_file string, line_no long, raw string"


def lines(spark, rows):
    return spark.createDataFrame([(f, i, json.dumps(r)) for f, i, r in rows], LINES)


def meta(trace, source="s", messages=2, chars=5, tools=0, models=("m",), usage=None, diffs=0):
    m = {"trace_id": trace, "source": source, "models": list(models), "counts": {"messages": messages, "roles": {"assistant": 1}, "assistant_chars": chars, "tool_calls": tools, "tool_results": 0, "diffs": diffs}}
    return {"messages": [], "metadata": m | ({"token_usage": usage} if usage else {})}


def test_report(spark):
    rows = [("m.jsonl", 1, meta("a", tools=3, models=("m", "n"), usage={"input": 10, "cached_input": 12})), ("s.jsonl", 1, meta("a", tools=3)), ("s.jsonl", 2, meta("b", "t", 4, 7, models=(), diffs=1)),
            ("s.jsonl", 3, {"source": "old", "messages": [{"role": "assistant", "content": "xyz"}, {"role": "user", "content": "q"}, {"role": "tool"}]}), ("d/name.jsonl", 1, {"messages": None})]
    got = corpus.report(lines(spark, rows))
    assert got["conversations_by_source"] == {"s": 1, "t": 1, "old": 1, "name": 1} and got["total_rows"] == 5 and got["total_conversations"] == 4
    assert got["conversations_by_model"] == {"m": 1, "n": 1, "unknown": 1} and got["model_metrics"]["m"]["tool_calls_per_assistant_message"] == 3.0 and got["model_metrics"]["unknown"]["zero_tool_conversations"] == 1
    assert (got["turn_count_min"], got["turn_count_max"], got["turn_count_mean"]) == (0, 4, 9 / 4) and got["total_assistant_chars"] == 15 and got["total_assistant_messages"] == 3
    assert (got["traces_with_tools"], got["zero_tool_conversations"], got["traces_with_diffs"], got["total_tool_calls"]) == (1, 3, 1, 3)
    assert got["token_usage"] == {"input": 10, "cached_input": 12} and got["reported_cache_hit_ratio"] == 1.2 and got["token_usage_anomalies"] == {"cached_input_exceeds_input": 1}
    empty = corpus.report(lines(spark, []))
    assert empty["total_conversations"] == 0 and empty["turn_count_mean"] == 0 and empty["reported_cache_hit_ratio"] is None


def test_sample_is_the_seeded_draw(spark):
    rows = lines(spark, [("b", i, {"n": i}) for i in range(1, 11)] + [("a", i, {"n": 100 + i}) for i in range(1, 11)]).repartition(5)
    every = [100 + i for i in range(1, 11)] + list(range(1, 11))
    for n in (5, 50, 0):
        got = [json.loads(r["raw"])["n"] for r in corpus.sample(rows, n, 42).orderBy("draw").collect()]
        assert got == random.Random(42).sample(every, min(n, 20))


def test_numbering_over_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc") if rng.random() < 0.9 else None, i) for i in range(500)]
    got = numbered(spark.createDataFrame(rows, "g string, x long").repartition(7), ["x"], ["g"], "n").collect()
    for g in ("a", "b", "c", None):
        assert [r["n"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["x"])] == list(range(1, 1 + sum(a == g for a, _ in rows)))


def test_split_takes_whole_conversations(spark):
    rows = spark.createDataFrame([(str(t), i) for i, t in enumerate([0, "a", "a", "b"])], "t string, i long")
    rank = lambda g: (hashlib.sha256(f"17\0{g}".encode()).hexdigest(), g)
    first = min(["0", "a", "b"], key=rank)
    for fraction in (0.2, 0.5):
        assert {r["t"] for r in corpus.split(rows, "t", fraction, 17).where("is_eval").collect()} == {first}
    for bad in (0.0, 1.0):
        with pytest.raises(ValueError):
            corpus.split(rows, "t", bad, 1)
    with pytest.raises(ValueError):
        corpus.split(rows.where("t = 'a'"), "t", 0.5, 1)
    bad = corpus.bad_split_rows(lines(spark, [("a", 1, {"messages": []}), ("a", 2, {"x": 1}), ("a", 3, {"messages": [1], "metadata": {"trace_id": ""}}), ("a", 4, {"messages": [1], "metadata": {"trace_id": 0}})]), "messages")
    assert [(r["line_no"], r["problem"].split(" ")[2]) for r in bad.orderBy("line_no").collect()] == [(1, "an"), (2, "missing"), (3, "missing")]


def test_windows(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["w", "xx", "```", "<tool_use"]) for _ in range(n))
    chats = {f"t{k}": [(rng.choice(["user", "user", "assistant", "system"]), text(rng.randrange(0, 30))) for _ in range(rng.randrange(1, 12))] for k in range(25)}
    rows = spark.createDataFrame([(t, "s", ["m"], m) for t, m in chats.items()], "trace_id string, source string, models array<string>, messages array<struct<role:string,content:string>>")
    want = {}
    for t, messages in chats.items():
        users = []
        for i, (role, content) in enumerate(messages):
            if role == "user":
                users.append(content)
            if role != "assistant":
                continue
            words = "\n".join(users[-3:]).split()[-6:]
            context = "<previous_context>\n" + " ".join(words) if users else "<previous_context>conversation start</previous_context>"
            tokens, users = content.split(), []
            for c, at in enumerate(range(0, len(tokens), 10)):
                if c == 0 or len(tokens) - at >= 4:
                    target = " ".join(tokens[at : at + 10])
                    want[f"{t}:{i}:{c}"] = (context, target, 1 + 4 * ("<tool_use" in target) + 3 * ("```" in target))
    made = corpus.windows(rows, 17, 10, 6, 4).cache()
    assert {r["session_id"]: (r["context"], r["target"], r["score"]) for r in made.collect()} == want
    rank = lambda key: hashlib.sha256(f"17\0{key}".encode()).hexdigest()
    best = {t: sorted((k for k in want if k.startswith(t + ":")), key=lambda k: (-want[k][2], rank(k)))[:3] for t in chats}
    top = corpus.best_windows(made).cache()
    assert {r["session_id"] for r in top.collect()} == {k for v in best.values() for k in v}
    queues = sorted((sorted(v, key=rank) for v in best.values() if v), key=lambda q: rank(q[0]))
    mixed = [q[i] for i in range(3) for q in queues if len(q) > i][:20]
    assert [r["session_id"] for r in corpus.round_robin(top, 20).collect()] == mixed
    base = spark.createDataFrame([(f"b{i}",) for i in range(30)], "session_id string")
    full = [r["row"] for r in corpus.filled(corpus.round_robin(top, 5), base, "session_id", 12).collect()]
    assert len(full) == 12 and set(mixed[:5]) <= set(full)
    with pytest.raises(ValueError):
        corpus.filled(top, base, "session_id", 1)
