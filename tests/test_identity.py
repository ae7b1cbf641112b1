"""Private terms of a machine, and settings of a redaction run that change what comes out."""

import json

import pytest

from loomspan import cli
from loomspan.config import RedactorConfig
from loomspan.operators import identity
from loomspan.plans.run import run_redact


def home_with(tmp_path):
    home = tmp_path / "zedhome"
    (home / ".pi/agent/sessions/--home-zedhome-secretlab--").mkdir(parents=True)
    (home / ".ssh").mkdir()
    (home / ".ssh/config").write_text("Host boxone *.wild\n  HostName 10.0.0.1\nhost boxtwo\nMatch all\n")
    return home


def test_private_terms(tmp_path):
    git = {"user.name": "Ada de Lovelace", "user.email": "ada.l@lovelace.org"}
    found = identity.private_terms(str(home_with(tmp_path)), "zed", {"USER": "root", "LOGNAME": "zed"}, "quark.local", lambda k: git.get(k, ""))
    assert set(found) == {"zed", "zedhome", "quark", "Ada de Lovelace", "Ada", "Lovelace", "AdaLovelace", "ada.l", "lovelace.org", "secretlab", "boxone", "boxtwo"}
    assert list(found) == sorted(found, key=lambda t: (-len(t), t.lower()))
    assert identity.private_terms(str(tmp_path / "dev"), None, {}, "localhost", lambda k: "") == ()


def lines(spark, *records):
    return spark.createDataFrame([("claude_code", "a", i, json.dumps(r)) for i, r in enumerate(records)], "source_key string, src_file string, line_no long, raw string")


def texts(rows):
    return [json.loads(r["raw"])["t"] for r in rows.orderBy("line_no").collect()]


def test_terms_of_the_machine_are_redacted(spark, tmp_path):
    rows = lines(spark, {"t": "ask boxone about secretlab, says quark"})
    config = RedactorConfig("zed", str(home_with(tmp_path)))
    assert texts(run_redact(spark, rows, str(tmp_path / "a"), config)[0]) == ["ask [PRIVATE_TERM] about [PRIVATE_TERM], says quark"]
    assert texts(run_redact(spark, rows, str(tmp_path / "b"), config, found=("quark",))[0]) == ["ask boxone about secretlab, says [PRIVATE_TERM]"]


def test_layers_run_when_they_are_set(spark, tmp_path, monkeypatch):
    rows = lines(spark, {"t": "my name is Alice"}, {"t": "phone Alice, contact Bob"})
    score = lambda ts: [[{"start": t.find("Alice"), "end": t.find("Alice") + 5, "score": 0.9, "entity_group": "person"}] if "Alice" in t else [] for t in ts]
    with pytest.raises(RuntimeError):
        run_redact(spark, rows, str(tmp_path / "a"), RedactorConfig("zed", "/h", privacy_filter=True), found=())
    config = RedactorConfig("zed", "/h", privacy_filter=True, gitleaks=True, gitleaks_fix=True, llm_residue_url="http://nowhere")
    clean, report = run_redact(spark, rows, str(tmp_path / "b"), config, found=(), score=score, ask=lambda line: [{"text": "Bob", "category": "name"}])
    assert texts(clean) == ["my name is [PII_MODEL:PERSON]", "phone [PII_MODEL:PERSON], contact [LLM_PII:NAME]"]
    assert report["layers"]["privacy_filter"] == {"marks": 2} and report["layers"]["llm_residue"] == {"lines": 1} and report["layers"]["gitleaks"]["status"] == "skipped"
    assert json.load(open(tmp_path / "b/REDACTION_REPORT.json"))["layers"] == report["layers"]


def test_options_of_the_command_line():
    a = cli._parser().parse_args(["run", "--user", "u", "--gitleaks", "--llm-residue", "http://x", "--private-terms", "a,b", "--min-turns", "3", "--dedup", "--variant", "messages"])
    assert cli._redaction(a) == RedactorConfig("u", None, False, (), ("a", "b"), (), False, "auto", 64, True, False, "http://x")
    assert (cli._export(a).min_turns, cli._export(a).dedup, cli._export(a).variant) == (3, True, "messages")


def test_a_command_with_a_layer_that_cannot_run_says_so(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/claude_code.jsonl").write_text(json.dumps({"t": "x"}) + "\n")
    assert cli.main(["redact", "--in", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--privacy-filter"], spark) == 2
