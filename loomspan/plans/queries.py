"""Named queries over a folder of tables, and the same results in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExportConfig
from ..functions.records import traces, traces_of_turns
from ..functions.text import hmac_sha256, matches_any, stable_rank
from ..operators import corpus, export, verify
from ..operators.redact import Identity, host_allowed, redact, redact_text, stable_text
from ..config import RedactorConfig

KEY = "loomspan-queries"
SEED = 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a table of turns: a sorted pass over each conversation, which spills, rather than an array of it."""
    turns = _turns(spark, sf_dir).where("role in ('user', 'tool', 'assistant')")
    w = "OVER (PARTITION BY conv_id ORDER BY turn)"
    last = turns.select("conv_id", "turn", "role", F.col("text").alias("gpt"), F.expr(f"lag(role) {w}").alias("before"), F.expr(f"lag(text) {w}").alias("human"))
    pairs = last.where("role = 'assistant' and before in ('user', 'tool')")
    return pairs.select("conv_id", "turn", F.expr(f"row_number() {w} - 1").cast("long").alias("pair_index"), F.expr("count(*) OVER (PARTITION BY conv_id)").alias("pair_count"), "human", "gpt")


def sharegpt_pairs(spark, sf_dir):
    lead = _turns(spark, sf_dir).where("role in ('system', 'developer')").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("lead"))
    return _paired(spark, sf_dir).join(lead, "conv_id", "left").select("conv_id", "pair_index", "pair_count", F.when(F.col("pair_index") == 0, F.col("lead")).alias("system"), "human", "gpt")


def pair_counts(spark, sf_dir):
    return _paired(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("pairs"), F.sum(F.length("gpt")).alias("gpt_chars"))


def trailing_user_drops(spark, sf_dir):
    last = _turns(spark, sf_dir).where("role not in ('system', 'developer')").groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"))
    return last.select("conv_id", (F.col("last_role") == "user").alias("trailing_user"))


def _traces(spark, sf_dir):
    return traces_of_turns(_turns(spark, sf_dir), KEY)


def messages_export(spark, sf_dir):
    rows = export.messages_rows(export.judged(_traces(spark, sf_dir), ExportConfig()))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["content"])), "\n")
    return rows.select(F.col("line_no").alias("conv_id"), "n_messages", F.sha2(said, 256).alias("messages_sha256"))


def sharegpt_rows(spark, sf_dir):
    """The export's own pairing, within rows, as digests."""
    rows = export.sharegpt_rows(export.judged(_traces(spark, sf_dir), ExportConfig()))
    said = F.array_join(F.transform("conversations", lambda m: F.concat(m["from"], F.lit("\n"), m["value"])), "\n")
    return rows.select(F.col("line_no").alias("conv_id"), F.col("pair_index").cast("long").alias("pair_index"), F.col("pair_count").cast("long").alias("pair_count"), F.sha2(said, 256).alias("pair_sha256"))


def role_counts(spark, sf_dir):
    return _turns(spark, sf_dir).groupBy("conv_id", F.coalesce(F.nullif("role", F.lit("")), F.lit("unknown")).alias("role")).agg(F.count("*").alias("n"))


def turn_stats(spark, sf_dir):
    per = _turns(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("role") == "assistant", F.length("text")).otherwise(0)).alias("chars"))
    return per.agg(F.count("*").alias("conversations"), F.min("n").alias("turn_min"), F.max("n").alias("turn_max"), F.round(F.avg("n"), 6).alias("turn_mean"), F.sum("chars").alias("assistant_chars"))


def trace_ids(spark, sf_dir):
    ids = _turns(spark, sf_dir).select("conv_id").distinct()
    said = F.concat(F.lit('["table","'), F.col("conv_id").cast("string"), F.lit('"]'))
    return ids.select("conv_id", F.concat(F.lit("ts_"), F.substring(hmac_sha256(KEY.encode(), said), 1, 24)).alias("trace_id"))


FILTER = ExportConfig(min_turns=3, max_turns=8, min_assistant_chars=200, require_tools=False)


def filter_reasons(spark, sf_dir):
    rows = export.judged(_traces(spark, sf_dir), FILTER)
    return rows.select(F.col("line_no").alias("conv_id"), F.coalesce("reason", F.lit("kept")).alias("reason"))


def drop_report(spark, sf_dir):
    return filter_reasons(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"))


def source_globs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = docs.where(matches_any(F.col("source"), ["SRC1*", "src[2-4]"]) & ~matches_any(F.col("source"), ["src1?"]))
    return kept.groupBy("source").agg(F.count("*").alias("n"))


def dedup_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
    return export.first_of_each(docs, "key", ["doc_id"]).select("doc_id", "source", "key")


def eval_split(spark, sf_dir):
    rows = _turns(spark, sf_dir).select("conv_id").distinct()
    return corpus.split(rows, "conv_id", 0.2, SEED)


def _windows(spark, sf_dir):
    return corpus.windows(_traces(spark, sf_dir).withColumn("trace_id", F.col("line_no").cast("string")), SEED, 60, 20, 10)


def training_windows(spark, sf_dir):
    return _windows(spark, sf_dir).select("trace_id", "session_id", "score", F.sha2("target", 256).alias("target_sha256"), F.sha2("context", 256).alias("context_sha256"))


def window_topk(spark, sf_dir):
    return corpus.best_windows(_windows(spark, sf_dir), 3).select("trace_id", "session_id", "score")


def round_robin_mix(spark, sf_dir):
    best = corpus.best_windows(_windows(spark, sf_dir), 3)
    return corpus.round_robin(best, 50, SEED).select("session_id", F.col("round").cast("long").alias("round"))


SINCE, UNTIL = "2024-01-02T00:00:00+00:00", "2024-01-20T12:00:00"


def since_until(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("created"))
    why = F.coalesce(export.reason(ExportConfig(since=SINCE, until=UNTIL)), F.lit("kept"))
    return rows.groupBy("event_type", why.alias("reason")).agg(F.count("*").alias("n"))


def redact_documents(spark, sf_dir):
    text = redact_text(F.coalesce("text", F.lit("")), ["contextual_phone", "ipv4", "redacted_literal", "airpods_pro"])
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text, 256).alias("text_sha256"))


def stable_placeholders(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return stable_text(docs, "doc_id", "text", "email").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def verify_findings(spark, sf_dir):
    return verify.scan_column(table(spark, sf_dir, "documents"), "doc_id", "text", ["email", "ipv4"]).select("doc_id", "category", "match", F.col("start").cast("long").alias("start"), "snippet")


def _records(spark, sf_dir):
    """Conversations as JSON lines, as a log has them."""
    said = F.struct(F.col("role"), F.col("text").alias("content"))
    chats = _turns(spark, sf_dir).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", said.alias("m")))), lambda x: x["m"]).alias("messages"))
    return chats.select(F.lit("table.jsonl").alias("src_file"), F.col("conv_id").alias("line_no"), F.to_json(F.struct("messages", F.lit("table").alias("source"), F.col("conv_id").cast("string").alias("session_id"))).alias("raw"))


def json_traces(spark, sf_dir):
    rows = traces(_records(spark, sf_dir), KEY)
    return rows.select(F.col("line_no").alias("conv_id"), "trace_id", "dedup_key", "n_messages", "assistant_chars", F.coalesce(F.col("roles").getItem("user"), F.lit(0)).cast("long").alias("users"))


def corpus_totals(spark, sf_dir):
    made = export.messages_json(export.judged(traces(_records(spark, sf_dir), KEY), ExportConfig())).select("src_file", "line_no", F.col("value").alias("raw"))
    got = corpus.totals(corpus.exported(made))
    return got.select("total_conversations", "turn_count_min", "turn_count_max", F.round("turn_count_mean", 6).alias("turn_count_mean"), "total_assistant_chars", "total_assistant_messages", "total_tool_calls", "zero_tool_conversations")


def stats_by_source(spark, sf_dir):
    made = export.sharegpt_json(export.judged(traces(_records(spark, sf_dir), KEY), ExportConfig())).select("src_file", F.col("line_no"), F.col("value").alias("raw"))
    return corpus.by_source(corpus.exported(made.groupBy("src_file", "line_no").agg(F.min("raw").alias("raw"))))


def stats_by_model(spark, sf_dir):
    made = export.messages_json(export.judged(traces(_records(spark, sf_dir), KEY), ExportConfig())).select("src_file", "line_no", F.col("value").alias("raw"))
    return corpus.by_model(corpus.exported(made)).select("model", "conversations", "assistant_messages", "tool_calls", "zero_tool_conversations", F.round("tool_calls_per_assistant_message", 6).alias("tool_calls_per_assistant_message"))


def redact_records(spark, sf_dir):
    """Whole records through the ordered rules, with placeholders numbered over the run."""
    docs = table(spark, sf_dir, "documents")
    raw = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.coalesce("text", F.lit("")).alias("content"))).alias("messages"), F.col("source"), F.lit("x").alias("api_key")))
    rows, _ = redact(docs.select(F.lit("documents.jsonl").alias("src_file"), F.col("doc_id").alias("line_no"), raw.alias("raw")), RedactorConfig("nobody", "/nowhere"))
    return rows.select(F.col("line_no").alias("doc_id"), F.sha2("raw", 256).alias("raw_sha256"))


def sample_turns(spark, sf_dir):
    lines = _records(spark, sf_dir)
    return corpus.sample(lines, 25, 42).select(F.col("line_no").alias("conv_id"), "draw")


def sensitive_urls(spark, sf_dir):
    """URLs of pages by whether their host is allowed, and what the url rule makes of each kind."""
    url = F.coalesce("url", F.lit(""))
    told = redact_text(F.concat(F.lit("see "), url), ["url"], Identity("__nobody__", "__nowhere__", hosts=("example.com",)))
    kind = F.when(~url.rlike(r"(?i)^https?://[^/:?#]"), "no url").when(host_allowed(url, ("example.com",)), "public").otherwise("private")
    return table(spark, sf_dir, "pages").groupBy(kind.alias("kind"), (told != F.concat(F.lit("see "), url)).alias("marked")).agg(F.count("*").alias("n"))


def stable_order(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id").distinct().select("conv_id", stable_rank(SEED, F.col("conv_id").cast("string")).alias("rank"))


QUERIES = {f.__name__: f for f in (
    sharegpt_pairs, pair_counts, trailing_user_drops, messages_export, sharegpt_rows, role_counts, turn_stats, trace_ids, filter_reasons, drop_report, source_globs, dedup_first_wins, eval_split, training_windows, window_topk,
    round_robin_mix, since_until, redact_documents, stable_placeholders, verify_findings, json_traces, corpus_totals, stats_by_source, stats_by_model, redact_records, sample_turns, sensitive_urls, stable_order)}

# --- the same in SQL ---
_T = "t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)"
_PAIRS = f"""{_T},
l AS (SELECT conv_id, turn, role, text AS gpt, lag(role) OVER w AS before, lag(text) OVER w AS human FROM t WHERE role IN ('user', 'tool', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pair_index, count(*) OVER (PARTITION BY conv_id) AS pair_count, human, gpt FROM l WHERE role = 'assistant' AND before IN ('user', 'tool')),
s AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS lead, string_agg('system' || chr(10) || text, chr(10) ORDER BY turn) AS said FROM t WHERE role IN ('system', 'developer') GROUP BY conv_id)"""
_PER = f"{_T}, c AS (SELECT conv_id, count(*) AS n, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS chars, count(*) FILTER (role = 'assistant') AS said, count(*) FILTER (role = 'user') AS users FROM t GROUP BY conv_id)"


def _hmac_sql(message: str) -> str:
    key = KEY.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in key).hex() for x in (0x36, 0x5C))
    return f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({message}))))"


_TRACE_SQL = "'ts_' || left(" + _hmac_sql("""'["table","' || conv_id || '"]'""") + ", 24)"
_RANK = f"sha256('{SEED}' || chr(0) || {{0}})"
_WINDOWS = f"""{_T},
m AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM t),
a AS (SELECT conv_id, i, text, coalesce(lag(i) OVER (PARTITION BY conv_id ORDER BY i), -1) AS since FROM m WHERE role = 'assistant'),
u AS (SELECT a.conv_id, a.i, m.i AS k, m.text, row_number() OVER (PARTITION BY a.conv_id, a.i ORDER BY m.i DESC) AS back FROM a JOIN m ON m.conv_id = a.conv_id AND m.role = 'user' AND m.i < a.i AND m.i > a.since),
x AS (SELECT conv_id, i, list_filter(regexp_split_to_array(string_agg(text, chr(10) ORDER BY k), '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS w FROM u WHERE back <= 3 GROUP BY conv_id, i),
b AS (SELECT a.conv_id, a.i, list_filter(regexp_split_to_array(a.text, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS w,
  CASE WHEN x.w IS NULL THEN '<previous_context>conversation start</previous_context>' ELSE '<previous_context>' || chr(10) || array_to_string(x.w[greatest(len(x.w) - 19, 1):], ' ') END AS context
  FROM a LEFT JOIN x ON x.conv_id = a.conv_id AND x.i = a.i),
k AS (SELECT *, unnest(range(0, (len(w) + 59) // 60)) AS chunk FROM b),
v AS (SELECT CAST(conv_id AS VARCHAR) AS trace_id, conv_id || ':' || i || ':' || chunk AS session_id, array_to_string(w[chunk * 60 + 1:chunk * 60 + 60], ' ') AS target, context FROM k WHERE chunk = 0 OR len(w) - chunk * 60 >= 10),
z AS (SELECT *, 1 + CASE WHEN contains(target, '<tool_use') OR contains(target, '<tool_result') THEN 4 ELSE 0 END + CASE WHEN contains(target, '```') THEN 3 ELSE 0 END + CASE WHEN contains(target, '<reasoning_summary>') THEN 1 ELSE 0 END AS score,
  {_RANK.format('session_id')} AS rank FROM v),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY score DESC, rank) AS n FROM z) WHERE n <= 3)"""
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
_IPV4 = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"

ORACLE_SQL = {
    "sharegpt_pairs": f"WITH {_PAIRS} SELECT p.conv_id, pair_index, pair_count, CASE WHEN pair_index = 0 THEN lead END AS system, human, gpt FROM p LEFT JOIN s ON s.conv_id = p.conv_id",
    "pair_counts": f"WITH {_PAIRS} SELECT conv_id, count(*) AS pairs, CAST(sum(length(gpt)) AS BIGINT) AS gpt_chars FROM p GROUP BY conv_id",
    "trailing_user_drops": f"WITH {_T} SELECT conv_id, arg_max(role, turn) = 'user' AS trailing_user FROM t WHERE role NOT IN ('system', 'developer') GROUP BY conv_id",
    "messages_export": f"WITH {_T} SELECT conv_id, count(*) AS n_messages, sha256(string_agg(role || chr(10) || text, chr(10) ORDER BY turn, role, text)) AS messages_sha256 FROM t GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') > 0",
    "sharegpt_rows": f"WITH {_PAIRS} SELECT p.conv_id, pair_index, pair_count, sha256(CASE WHEN pair_index = 0 AND said IS NOT NULL THEN said || chr(10) ELSE '' END || 'human' || chr(10) || human || chr(10) || 'gpt' || chr(10) || gpt) AS pair_sha256 FROM p LEFT JOIN s ON s.conv_id = p.conv_id",
    "role_counts": f"WITH {_T} SELECT conv_id, coalesce(nullif(role, ''), 'unknown') AS role, count(*) AS n FROM t GROUP BY 1, 2",
    "turn_stats": f"WITH {_PER} SELECT count(*) AS conversations, min(n) AS turn_min, max(n) AS turn_max, round(avg(n), 6) AS turn_mean, CAST(sum(chars) AS BIGINT) AS assistant_chars FROM c",
    "trace_ids": f"SELECT DISTINCT conv_id, {_TRACE_SQL} AS trace_id FROM conversations",
    "filter_reasons": f"WITH {_PER} SELECT conv_id, CASE WHEN n < 3 THEN 'below_min_messages' WHEN n > 8 THEN 'above_max_messages' WHEN chars < 200 THEN 'below_min_assistant_chars' ELSE 'kept' END AS reason FROM c",
    "drop_report": f"WITH {_PER} SELECT CASE WHEN n < 3 THEN 'below_min_messages' WHEN n > 8 THEN 'above_max_messages' WHEN chars < 200 THEN 'below_min_assistant_chars' ELSE 'kept' END AS reason, count(*) AS n FROM c GROUP BY 1",
    "source_globs": "SELECT source, count(*) AS n FROM documents WHERE (lower(source) LIKE 'src1%' OR lower(source) IN ('src2', 'src3', 'src4')) AND lower(source) NOT LIKE 'src1_' GROUP BY source",
    "dedup_first_wins": "SELECT doc_id, source, key FROM (SELECT doc_id, source, sha256(coalesce(text, '')) AS key, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS n FROM documents) WHERE n = 1",
    "eval_split": f"WITH g AS (SELECT DISTINCT conv_id, {_RANK.format('conv_id')} AS rank FROM conversations), r AS (SELECT conv_id, row_number() OVER (ORDER BY rank, CAST(conv_id AS VARCHAR)) AS n, count(*) OVER () AS c FROM g) SELECT conv_id, n <= greatest(1, CAST(floor(c * 0.2) AS BIGINT)) AS is_eval FROM r",
    "training_windows": f"WITH {_WINDOWS} SELECT trace_id, session_id, score, sha256(target) AS target_sha256, sha256(context) AS context_sha256 FROM z",
    "window_topk": f"WITH {_WINDOWS} SELECT trace_id, session_id, score FROM best",
    "round_robin_mix": f"WITH {_WINDOWS}, q AS (SELECT session_id, trace_id, row_number() OVER (PARTITION BY trace_id ORDER BY rank) AS round, min(rank) OVER (PARTITION BY trace_id) AS queue FROM best) SELECT session_id, round FROM q ORDER BY round, queue, trace_id LIMIT 50",
    "since_until": f"SELECT event_type, CASE WHEN ts IS NULL OR ts < TIMESTAMP '2024-01-02 00:00:00' THEN 'before_since' WHEN ts > TIMESTAMP '2024-01-20 12:00:00' THEN 'after_until' ELSE 'kept' END AS reason, count(*) AS n FROM events GROUP BY 1, 2",
    "redact_documents": rf"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i)\bAirPods\s+Pro\b', '[HW:BLUETOOTH_DEVICE]', 'g'),
      '(?i)\b((?:phone|tel|mobile|call me|telefono|tel[eé]fono)\s*[:=]?\s*)(?:\+?\d[\d .()/-]{{7,}}\d)', '\1[PII:PHONE]', 'g'), '{_IPV4}', '[PII:IP_ADDRESS]', 'g'), '\bREDACTED\b', '[OMITTED]', 'g')) AS text_sha256 FROM documents""",
    "stable_placeholders": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '@@') AS m FROM documents),
      v AS (SELECT doc_id, unnest(m) AS value, generate_subscripts(m, 1) AS spot FROM d), f AS (SELECT value, min({'d': doc_id, 'a': spot}) AS f FROM v GROUP BY value),
      r AS (SELECT value, '[EMAIL:' || lpad(CAST(row_number() OVER (ORDER BY f) AS VARCHAR), 4, '0') || ':' || left(sha256(value), 10) || ']' AS mark FROM f),
      g AS (SELECT doc_id, spot, mark FROM v JOIN r USING (value)), o AS (SELECT doc_id, list(mark ORDER BY spot) AS marks FROM g GROUP BY doc_id),
      s AS (SELECT d.doc_id, string_split_regex(d.text, '@@') AS p, marks FROM d LEFT JOIN o USING (doc_id))
      SELECT doc_id, sha256(array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(marks[i], '')), '')) AS text_sha256 FROM s""".replace("@@", _EMAIL),
    "verify_findings": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      h AS (SELECT doc_id, text, 'email' AS category, regexp_extract(text, '{_EMAIL}') AS match, len(string_split_regex(text, '{_EMAIL}')[1]) AS start FROM d WHERE regexp_matches(text, '{_EMAIL}')
        UNION ALL SELECT doc_id, text, 'ipv4', regexp_extract(text, '{_IPV4}'), len(string_split_regex(text, '{_IPV4}')[1]) FROM d WHERE regexp_matches(text, '{_IPV4}'))
      SELECT doc_id, category, match, start, substr(replace(CASE WHEN start > 60 THEN '...' ELSE '' END || substr(text, greatest(start - 60, 0) + 1, start + length(match) + 60 - greatest(start - 60, 0)) || CASE WHEN start + length(match) + 60 < length(text) THEN '...' ELSE '' END, chr(10), '\n'), 1, 200) AS snippet FROM h""",
    "json_traces": f"WITH {_PER} SELECT conv_id, {_TRACE_SQL} AS trace_id, 'sid:table:' || conv_id AS dedup_key, n AS n_messages, CAST(chars AS BIGINT) AS assistant_chars, users FROM c",
    "corpus_totals": f"WITH {_PER} SELECT count(*) AS total_conversations, min(n) AS turn_count_min, max(n) AS turn_count_max, round(avg(n), 6) AS turn_count_mean, CAST(sum(chars) AS BIGINT) AS total_assistant_chars, CAST(sum(said) AS BIGINT) AS total_assistant_messages, CAST(0 AS BIGINT) AS total_tool_calls, count(*) AS zero_tool_conversations FROM c WHERE said > 0",
    "stats_by_source": f"WITH {_PAIRS}, {_PER.removeprefix(_T + ', ')} SELECT 'table' AS source, count(*) AS conversations, CAST(sum(chars) AS BIGINT) AS assistant_chars FROM c WHERE conv_id IN (SELECT conv_id FROM p)",
    "stats_by_model": f"WITH {_PER} SELECT 'unknown' AS model, count(*) AS conversations, CAST(sum(said) AS BIGINT) AS assistant_messages, CAST(0 AS BIGINT) AS tool_calls, count(*) AS zero_tool_conversations, CAST(0 AS DOUBLE) AS tool_calls_per_assistant_message FROM c WHERE said > 0",
    "sensitive_urls": r"SELECT CASE WHEN h = '' THEN 'no url' WHEN h = 'example.com' OR h LIKE '%.example.com' THEN 'public' ELSE 'private' END AS kind, h <> '' AND NOT (h = 'example.com' OR h LIKE '%.example.com') AS marked, count(*) AS n FROM (SELECT lower(regexp_extract(coalesce(url, ''), '(?i)^https?://([^/:?#]+)', 1)) AS h FROM pages) GROUP BY 1, 2",
    "stable_order": f"SELECT DISTINCT conv_id, {_RANK.format('conv_id')} AS rank FROM conversations",
}
