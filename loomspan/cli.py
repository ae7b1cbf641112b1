"""Command line: python -m loomspan.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .config import ExportConfig, RedactorConfig
from .fixed import SOURCE_KEYS


def _names(text: str | None) -> tuple[str, ...]:
    return tuple(x for x in (text or "").split(",") if x)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspan", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, *options):
        c = sub.add_parser(name)
        for o, kw in options:
            c.add_argument(o, **kw)
        return c

    opt = lambda name, **kw: (f"--{name}", kw)
    flag = lambda name: (f"--{name}", {"action": "store_true"})
    place = [opt("sources", help=f"comma-separated, of {', '.join(SOURCE_KEYS)}"), opt("root", default="~"), opt("out", default="output")]
    redaction = [opt("user"), opt("home"), flag("allow-public-urls"), opt("allowed-domains"), opt("private-terms"), opt("private-domains"),
                 flag("privacy-filter"), opt("privacy-filter-device", default="auto"), flag("gitleaks"), flag("gitleaks-fix"), opt("llm-residue", help="address of a language model with the usual chat interface")]
    filters = [opt("variant", default="both", choices=["messages", "sharegpt", "both"]), *(opt(n, type=int) for n in ("min-turns", "max-turns", "min-assistant-chars")),
               *(opt(n) for n in ("include-sources", "drop-sources", "projects", "models", "statuses", "since", "until", "metadata-key")), flag("require-tools"), flag("require-diffs"), flag("dedup")]
    io = [opt("in", dest="input", required=True), opt("out", required=True)]
    command("extract", *place)
    command("import-claude", *io, opt("source", required=True))
    command("redact", *io, *redaction)
    command("export", *io, *filters)
    command("verify", opt("in", dest="input", required=True))
    command("stats", opt("in", dest="input", required=True))
    command("sample", *io, opt("n", type=int, default=10), opt("seed", type=int, default=0))
    command("split", *io, opt("variant", default="messages", choices=["messages", "sharegpt"]), opt("eval-fraction", type=float, default=0.2), opt("seed", type=int, default=17))
    command("verify-split", opt("in", dest="input", required=True))
    command("publish", opt("in", dest="input", required=True), opt("repo", required=True))
    command("run", *place, *redaction, *filters)
    return p


def _redaction(a) -> RedactorConfig:
    return RedactorConfig(a.user, a.home, a.allow_public_urls, _names(a.allowed_domains), _names(a.private_terms), _names(a.private_domains), a.privacy_filter, a.privacy_filter_device, 64, a.gitleaks, a.gitleaks_fix, a.llm_residue)


def _export(a) -> ExportConfig:
    return ExportConfig(a.variant, a.min_turns, a.max_turns, a.min_assistant_chars, _names(a.include_sources), _names(a.drop_sources), _names(a.projects), _names(a.models), _names(a.statuses), a.since, a.until, a.require_tools, a.require_diffs, a.dedup, a.metadata_key)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from pyspark.sql import functions as F

    from .operators import corpus, verify
    from .plans import run as stages
    from .sinks import reports
    from .sinks.files import write_lines, write_report
    from .sources.lines import read_lines
    from .sources.published import import_published

    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("loomspan").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    say = lambda x: print(json.dumps(x, ensure_ascii=False, indent=2, default=str))
    keyed = lambda path: read_lines(spark, path).withColumn("source_key", F.coalesce(F.nullif(F.regexp_extract("src_file", "source_key=([^/]+)", 1), F.lit("")), F.regexp_extract("src_file", r"([^/]*?)\.jsonl$", 1)))
    try:
        if a.command == "extract":
            say(stages.run_extract(spark, os.path.expanduser(a.root), a.out, list(_names(a.sources)) or None)[1])
        elif a.command == "import-claude":
            receipt = import_published(spark, a.input, a.source, f"{a.out}/raw_extracted/{a.source}")
            write_report(spark, f"{a.out}/{a.source}.IMPORT_RECEIPT.json", receipt)
            say(receipt)
        elif a.command == "redact":
            say(stages.run_redact(spark, keyed(a.input), a.out, _redaction(a), os.path.expanduser("~"))[1])
        elif a.command == "export":
            say(stages.run_export(spark, keyed(a.input), a.out, _export(a)))
        elif a.command == "verify":
            found = verify.scan_records(read_lines(spark, a.input)).orderBy("src_file", "line_no", "category")
            n = found.count()
            say({"leftovers": n, "first": [r.asDict() for r in found.limit(20).collect()]})
            return int(n > 0)
        elif a.command == "stats":
            say(corpus.report(read_lines(spark, a.input)))
        elif a.command == "sample":
            write_lines(corpus.sample(read_lines(spark, a.input), a.n, a.seed).select("draw", F.col("raw").alias("value")), a.out, ["draw"])
        elif a.command == "split":
            say(reports.train_eval(spark, a.input, a.out, a.variant, a.eval_fraction, a.seed))
        elif a.command == "verify-split":
            say(reports.verify_train_eval(spark, a.input))
        elif a.command == "publish":
            print(reports.publish(spark, a.input, a.repo))
        else:
            say(stages.run(spark, os.path.expanduser(a.root), a.out, _redaction(a), _export(a), list(_names(a.sources)) or None))
    except (ValueError, FileNotFoundError, FileExistsError, RuntimeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
