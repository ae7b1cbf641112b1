"""From logs to training data by the command line; streams; named queries against SQL."""

import glob
import hashlib
import json
import os

import pytest

import __spark_entry__
from loomspan import cli
from loomspan.functions.records import traces
from loomspan.plans import logs as log_queries
from loomspan.plans import queries, rich
from loomspan.sinks.reports import card
from loomspan.streaming import ingest

SF = "/root/testdata/sf0.001"


def logs(root):
    for n in range(4):
        path = f"{root}/.claude/projects/p/s{n}.jsonl"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            for k in range(2):
                f.write(json.dumps({"type": "user", "cwd": "/home/me/x", "message": {"content": f"mail a{n}@b.co about /home/me/x/{k}"}}) + "\n")
                f.write(json.dumps({"type": "assistant", "message": {"content": f"ok {k}", "model": "m"}}) + "\n")


def run(spark, *argv):
    return cli.main(list(argv), spark)


def text_of(folder):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{folder}/**/part-*", recursive=True)))


def test_from_logs_to_a_split(spark, tmp_path, capsys, monkeypatch):
    import platform

    monkeypatch.setattr(platform, "system", lambda: "Linux")
    logs(f"{tmp_path}/home")
    out = f"{tmp_path}/out"
    assert run(spark, "run", "--root", f"{tmp_path}/home", "--out", out, "--user", "zed", "--home", "/home/zed") == 0
    manifest = json.load(open(f"{out}/MANIFEST.json"))
    assert manifest["sources"]["claude_code"]["raw_records"] == 4 and manifest["sources"]["codex"]["raw_records"] == 0
    assert manifest["export_summary"]["messages_rows"] == 4 and manifest["export_summary"]["sharegpt_pairs"] == 8 and manifest["export_summary"]["messages_by_source"] == {"claude_code": 4}
    assert sum(f["rows"] for n, f in manifest["files"].items() if "sharegpt" in n) == 8
    lines = [json.loads(x) for x in text_of(f"{out}/export/messages.jsonl").splitlines()]
    assert len(lines) == 4 and "@b.co" not in json.dumps(lines) and "/home/me" not in json.dumps(lines) and "[EMAIL:0004:" in json.dumps(lines)
    assert json.load(open(f"{out}/REDACTION_REPORT.json"))["per_source"]["claude_code"]["email"] == 8
    assert run(spark, "verify", "--in", f"{out}/redacted") == 0
    capsys.readouterr()
    assert run(spark, "stats", "--in", f"{out}/export/messages.jsonl") == 0
    stats = json.loads(capsys.readouterr().out)
    assert stats["total_conversations"] == 4 and stats["conversations_by_model"] == {"m": 4}
    assert run(spark, "export", "--in", f"{out}/redacted", "--out", f"{tmp_path}/again", "--variant", "sharegpt", "--min-turns", "9") == 0
    assert text_of(f"{tmp_path}/again/export/sharegpt.jsonl") == ""
    assert run(spark, "sample", "--in", f"{out}/export/messages.jsonl", "--out", f"{tmp_path}/sample", "--n", "2") == 0 and len(text_of(f"{tmp_path}/sample").splitlines()) == 2
    assert run(spark, "split", "--in", f"{out}/export", "--out", f"{tmp_path}/split", "--variant", "sharegpt", "--eval-fraction", "0.3") == 0
    receipt = json.load(open(f"{tmp_path}/split/SPLIT_RECEIPT.json"))
    assert (receipt["eval_conversations"], receipt["train_conversations"], receipt["eval_rows"]) == (1, 3, 2)
    assert run(spark, "verify-split", "--in", f"{tmp_path}/split") == 0
    assert run(spark, "split", "--in", f"{out}/export", "--out", f"{tmp_path}/split") == 2
    assert run(spark, "publish", "--in", f"{out}/export", "--repo", "me/x") == 0 and "| claude_code | 4 | 4 | 8 |" in open(f"{out}/export/README.md").read()
    with open(f"{out}/export/sharegpt.jsonl/part-more.txt", "w") as f:
        f.write("\n")
    assert run(spark, "verify-split", "--in", f"{tmp_path}/split") == 2


def test_card_lists_all_sources():
    text = card({"sources": {"gemini": {"raw_records": 3}}, "export_summary": {"messages_by_source": {"gemini-cli": 2}}}, "n")
    assert "| gemini | 3 | 0 | 0 |\n| gemini-cli | 0 | 2 | 0 |" in text


def test_streams(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    for n in range(3):
        with open(f"{tmp_path}/in/f{n}.jsonl", "w") as f:
            f.write(json.dumps({"messages": [{"role": "user", "content": "q"}], "session_id": n % 2, "source": "s", "created_at": "2026-01-01T00:00:00Z"}) + "\n")
    stream = ingest.stream_traces(ingest.read_stream(spark, f"{tmp_path}/in"), "k")
    stream.select("trace_id", "n_messages").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    events = spark.readStream.schema(spark.read.parquet(f"{SF}/events.parquet").schema).parquet(os.path.dirname(f"{SF}/events.parquet"), pathGlobFilter="events.parquet")
    ingest.activity(events, "ts", "event_type", "1 day").writeStream.format("memory").queryName("activity").outputMode("complete").trigger(availableNow=True).start().awaitTermination(120)
    assert spark.sql("SELECT sum(n) FROM activity").first()[0] == spark.read.parquet(f"{SF}/events.parquet").count()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


OWN = {name: (query, m.ORACLE_SQL) for m in (queries, log_queries, rich) for name, query in m.QUERIES.items()}


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    query, sql = OWN[name]
    df = query(spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    if name in sql:
        r = duck.execute(sql[name])
        names = [c[0] for c in r.description]
        assert sorted(names) == cols
        assert got == sorted(tuple(str(x[names.index(c)]) for c in cols) for x in r.fetchall())
    else:
        assert got


def test_filled_order_keeps_all_extras_of_a_larger_table(spark, tmp_path):
    for n in (395, 450):  # 40 and 45 of them, where 40 rows are asked for
        spark.range(n).selectExpr("id AS conv_id", "0 AS turn", "'user' AS role", "'x' AS text").write.parquet(f"{tmp_path}/{n}/conversations.parquet")
        got = [(r["draw"], r["row"]) for r in rich.filled_order(spark, f"{tmp_path}/{n}").collect()]
        assert got == sorted((hashlib.sha256(f"18\0{c}".encode()).hexdigest(), str(c)) for c in range(0, n, 10))


@pytest.mark.parametrize("name, steps", [("scan_trae", 2), ("scan_opencode_store", 2), ("scan_cursor", 1), ("scan_windsurf", 1)])
def test_files_are_made_where_they_are_parsed(spark, name, steps):
    """A Python step for each kind of file, and none that feeds another: their workers would run, and hold batches of whole files, side by side."""
    plan = log_queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == steps


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_records_of_a_run_share_one_key(spark):
    line = spark.createDataFrame([("a", i, '{"session_id": "s", "messages": []}') for i in range(20)], "src_file string, line_no long, raw string").repartition(4)
    assert traces(line, "k").select("trace_id").distinct().count() == 1
