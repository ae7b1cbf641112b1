"""Statistics, samples, splits and training windows of exported traces."""

from __future__ import annotations

import random
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import WINDOW_SCORES
from ..functions.rank import numbered
from ..functions.text import stable_rank

_META = (
    "struct<trace_id:string,source:string,models:array<string>,counts:struct<messages:long,roles:map<string,long>,assistant_chars:long,tool_calls:long,tool_results:long,diffs:long>,"
    "token_usage:map<string,double>>"
)
_ROW = f"metadata {_META}, source string, messages array<struct<role:string,content:string>>, has string"


def exported(lines: DataFrame) -> DataFrame:
    """One row for each conversation of exported lines (src_file, line_no, raw).

    Rows with metadata count once for each trace_id, the first by file and line;
    rows without it (is_legacy) count each.
    """
    meta_text = F.get_json_object("raw", "$.metadata")
    row = F.from_json("raw", T._parse_datatype_string(_ROW))
    rows = lines.select("src_file", "line_no", "raw", row.alias("r"), F.coalesce(meta_text.startswith("{"), F.lit(False)).alias("has_meta"))
    stem = F.regexp_extract("src_file", r"([^/]*?)(?:\.[^./]*)?$", 1)
    said = F.filter("r.messages", lambda m: m["role"] == "assistant")
    trace = F.coalesce(F.when(F.col("r.metadata.trace_id") != "", F.col("r.metadata.trace_id")), F.concat(F.lit("legacy:"), "src_file", F.lit(":"), F.col("line_no").cast("string")))
    counts = "r.metadata.counts"
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    none = F.coalesce(F.size("r.messages"), F.lit(0))
    flat = rows.select(
        "src_file", "line_no", (~F.col("has_meta")).alias("is_legacy"), F.when(F.col("has_meta"), trace).alias("trace_id"),
        F.when(F.col("has_meta"), F.coalesce(F.when(F.col("r.metadata.source") != "", F.col("r.metadata.source")), F.lit("unknown"))).otherwise(F.coalesce(F.when(F.col("r.source") != "", F.col("r.source")), stem)).alias("source"),
        F.when(F.col("has_meta"), F.when(F.size("r.metadata.models") > 0, F.col("r.metadata.models")).otherwise(F.array(F.lit("unknown")))).alias("models"),
        F.when(F.col("has_meta"), zero(F.col(f"{counts}.messages"))).otherwise(F.greatest(none, F.lit(0)).cast("long")).alias("n_messages"),
        F.when(F.col("has_meta"), zero(F.col(f"{counts}.assistant_chars"))).otherwise(F.coalesce(F.aggregate(said, F.lit(0), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0)).cast("long")).alias("assistant_chars"),
        F.when(F.col("has_meta"), zero(F.col(f"{counts}.roles").getItem("assistant"))).otherwise(F.greatest(F.coalesce(F.size(said), F.lit(0)), F.lit(0)).cast("long")).alias("assistant_messages"),
        *[F.when(F.col("has_meta"), zero(F.col(f"{counts}.{k}"))).otherwise(F.lit(0).cast("long")).alias(k) for k in ("tool_calls", "tool_results", "diffs")],
        F.when(F.col("has_meta"), F.col("r.metadata.token_usage")).alias("token_usage"),
    )
    legacy, known = flat.where("is_legacy"), flat.where("not is_legacy")
    first = known.groupBy(F.col("trace_id").alias("_t")).agg(F.min(F.struct("src_file", "line_no")).alias("_f"))
    return known.join(first, (F.col("trace_id") == F.col("_t")) & (F.struct("src_file", "line_no") == F.col("_f")), "left_semi").unionByName(legacy)


def _per(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("conversations"), F.sum("assistant_chars").alias("assistant_chars"))


def by_model(rows: DataFrame) -> DataFrame:
    """Metrics of each model; a conversation of several models counts for each."""
    each = rows.where("models is not null").select(F.explode("models").alias("model"), "assistant_chars", "assistant_messages", "tool_calls")
    got = each.groupBy("model").agg(
        F.count("*").alias("conversations"), F.sum("assistant_chars").alias("assistant_chars"), F.sum("assistant_messages").alias("assistant_messages"), F.sum("tool_calls").alias("tool_calls"),
        F.count_if(F.col("tool_calls") == 0).alias("zero_tool_conversations"))
    return got.withColumn("tool_calls_per_assistant_message", _per(F.col("tool_calls"), F.col("assistant_messages")))


def token_sums(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("token_usage").alias("counter", "value")).groupBy("counter").agg(F.sum("value").alias("total"))


def totals(rows: DataFrame) -> DataFrame:
    """One row of corpus totals."""
    cached, prompt = F.col("token_usage").getItem("cached_input"), F.col("token_usage").getItem("input")
    some = lambda c: F.coalesce(c, F.lit(0))
    got = rows.agg(
        F.count("*").alias("total_conversations"), some(F.min("n_messages")).alias("turn_count_min"), some(F.max("n_messages")).alias("turn_count_max"), F.coalesce(F.avg("n_messages"), F.lit(0.0)).alias("turn_count_mean"),
        some(F.sum("assistant_chars")).alias("total_assistant_chars"), some(F.sum("assistant_messages")).alias("total_assistant_messages"), some(F.sum("tool_calls")).alias("total_tool_calls"),
        some(F.sum("tool_results")).alias("total_tool_results"), F.count_if(F.col("tool_calls") > 0).alias("traces_with_tools"), F.count_if(F.col("diffs") > 0).alias("traces_with_diffs"),
        F.count_if(cached > prompt).alias("cached_input_exceeds_input"), F.sum(cached).alias("_cached"), F.sum(prompt).alias("_prompt"))
    ratio = F.when(F.col("_prompt") != 0, F.col("_cached") / F.col("_prompt"))
    return got.withColumns({
        "tool_calls_per_assistant_message": _per(F.col("total_tool_calls"), F.col("total_assistant_messages")),
        "zero_tool_conversations": F.col("total_conversations") - F.col("traces_with_tools"), "reported_cache_hit_ratio": ratio}).drop("_cached", "_prompt")


def report(lines: DataFrame) -> dict:
    """All statistics as one report; what comes to the driver is a row for each source, model and counter."""
    rows = exported(lines)
    whole = totals(rows).first().asDict()
    anomalies = whole.pop("cached_input_exceeds_input")
    models = {r["model"]: {k: v for k, v in r.asDict().items() if k != "model"} for r in by_model(rows).collect()}
    return whole | {
        "conversations_by_source": {r["source"]: r["conversations"] for r in by_source(rows).collect()}, "conversations_by_model": {m: x["conversations"] for m, x in models.items()}, "model_metrics": models,
        "total_rows": lines.where(F.trim("raw") != "").count(), "token_usage": {r["counter"]: r["total"] for r in token_sums(rows).collect()}, "token_usage_anomalies": {"cached_input_exceeds_input": anomalies},
    }


def sample(lines: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """The lines that a seeded draw of n without replacement picks, in its order (draw), by place in file order.

    The driver holds the number of lines of each file and the n drawn places, no
    lines; only the files that hold a drawn place are numbered.
    """
    files = lines.groupBy("src_file").count().orderBy("src_file").collect()
    upto = list(accumulate(r["count"] for r in files))
    drawn = random.Random(seed).sample(range(upto[-1] if upto else 0), min(n, upto[-1] if upto else 0))
    of = [bisect_right(upto, p) for p in drawn]
    places = lines.sparkSession.createDataFrame([(files[f]["src_file"], p - upto[f] + files[f]["count"] + 1, i) for i, (p, f) in enumerate(zip(drawn, of))], "_file string, _place long, draw long")
    some = lines.join(F.broadcast(places.select("_file").distinct()), F.col("src_file") == F.col("_file"), "left_semi")
    placed = numbered(some, ["line_no"], ["src_file"], "_at")
    return placed.join(F.broadcast(places), (F.col("src_file") == F.col("_file")) & (F.col("_at") == F.col("_place"))).drop("_file", "_place", "_at")


def split(rows: DataFrame, group: str, fraction: float, seed: int) -> DataFrame:
    """rows with is_eval: whole groups, those of the smallest ranks, max(1, floor(groups * fraction)) of them."""
    if not 0.0 < fraction < 1.0:
        raise ValueError("eval_fraction must be between 0 and 1 exclusively")
    if seed < 0:
        raise ValueError("seed must be non-negative")
    name = F.col(group).cast("string")
    groups = rows.select(name.alias("_group")).distinct().withColumn("_rank", stable_rank(seed, F.col("_group")))
    size = groups.count()
    wanted = max(1, int(size * fraction))
    if wanted >= size:
        raise ValueError("dataset is too small for a non-empty train split")
    # The last rank of the eval part, by places in the order of ranks: the part itself may be large.
    ranked = numbered(groups, ["_rank", "_group"], name="_place")
    last = ranked.where(F.col("_place") == wanted).select("_rank", "_group").first()
    mine = F.struct(stable_rank(seed, name), name) <= F.struct(F.lit(last["_rank"]), F.lit(last["_group"]))
    return rows.withColumn("is_eval", mine)


def bad_split_rows(lines: DataFrame, variant: str) -> DataFrame:
    """src_file, line_no and problem of lines that cannot be split."""
    field = "messages" if variant == "messages" else "conversations"
    value, trace = F.get_json_object("raw", f"$.{field}"), F.get_json_object("raw", "$.metadata.trace_id")
    problem = (
        F.when(value.isNull() | ~value.startswith("["), f"row is missing required field '{field}'")
        .when(F.get_json_object("raw", f"$.{field}[0]").isNull(), f"row has an empty '{field}' field")
        .when(trace.isNull() | (trace == ""), "row is missing metadata.trace_id"))
    return lines.where(F.trim("raw") != "").select("src_file", "line_no", problem.alias("problem")).where("problem is not null")


def windows(rows: DataFrame, seed: int = 17, target_tokens: int = 768, context_tokens: int = 192, least: int = 50, tokens=lambda text: F.filter(F.split(text, r"\s+"), lambda w: w != ""), text=lambda t: F.array_join(t, " ")) -> DataFrame:
    """Training windows of traces (trace_id, source, models, messages): a chunk of an assistant message and what users said before it.

    tokens and text turn a string column into tokens and back (words by default).
    Columns: trace_id, source, model, session_id, context, target, score, rank.
    """
    msgs = F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), m["content"].alias("content"), i.alias("i")))
    rows = rows.withColumn("_m", msgs)
    since = F.transform(F.filter("_m", lambda m: m["role"] == "assistant"), lambda a: F.struct(
        a["i"].alias("i"), a["content"].alias("target"),
        F.filter("_m", lambda m: (m["role"] == "user") & (m["i"] < a["i"]) & ~F.exists("_m", lambda o: (o["role"] == "assistant") & (o["i"] > m["i"]) & (o["i"] < a["i"]))).alias("users")))
    each = rows.select("trace_id", "source", F.coalesce(F.try_element_at("models", F.lit(1)), F.lit("")).alias("model"), F.explode(since).alias("a"))
    users = F.col("a.users")
    last = F.transform(F.slice(users, F.greatest(F.size(users) - 2, F.lit(1)), F.lit(3)), lambda m: m["content"])
    words = tokens(F.array_join(last, "\n"))
    cut = F.slice(words, F.greatest(F.size(words) - (context_tokens - 1), F.lit(1)), F.lit(context_tokens))
    context = F.when(F.size(users) == 0, "<previous_context>conversation start</previous_context>").otherwise(F.concat(F.lit("<previous_context>\n"), text(cut)))
    each = each.select("trace_id", "source", "model", F.col("a.i").alias("i"), context.alias("context"), tokens(F.coalesce("a.target", F.lit(""))).alias("t"))
    starts = F.when(F.size("t") > 0, F.sequence(F.lit(0), F.size("t") - 1, F.lit(target_tokens))).otherwise(F.array().cast("array<int>"))
    chunks = each.select("*", F.posexplode(starts).alias("chunk", "start")).where((F.col("chunk") == 0) | (F.size("t") - F.col("start") >= least))
    target = text(F.slice("t", F.col("start") + 1, F.lit(target_tokens)))
    chunks = chunks.select("trace_id", "source", "model", F.concat_ws(":", "trace_id", "i", "chunk").alias("session_id"), "context", target.alias("target"))
    score = F.lit(1)
    for marks, points in WINDOW_SCORES:
        holds = F.lit(False)
        for m in marks:
            holds = holds | F.col("target").contains(m)
        score = score + F.when(holds, points).otherwise(0)
    return chunks.select("*", score.alias("score"), stable_rank(seed, F.col("session_id")).alias("rank"))


def best_windows(rows: DataFrame, most: int = 3) -> DataFrame:
    """Of each conversation, the windows of the highest scores."""
    return rows.withColumn("_n", F.expr("row_number() OVER (PARTITION BY trace_id ORDER BY score DESC, rank)")).where(F.col("_n") <= most).drop("_n")


def round_robin(rows: DataFrame, most: int, seed: int = 17) -> DataFrame:
    """One window of each conversation, then the second of each, up to `most`; conversations go by the rank of their first window's id."""
    turn = rows.withColumn("round", F.expr("row_number() OVER (PARTITION BY trace_id ORDER BY rank)"))
    turn = turn.withColumn("queue", F.expr("min(rank) OVER (PARTITION BY trace_id)"))
    return turn.orderBy("round", "queue", "trace_id").limit(most)


def filled(extras: DataFrame, base: DataFrame, key: str, most: int, seed: int = 17, over: bool = False) -> DataFrame:
    """extras, then rows of base by rank up to `most` rows, in an order of ranks (draw).

    Extras are never cut: more than `most` are an error or, with `over`, all that comes.
    """
    n = extras.count()
    if n > most and not over:
        raise ValueError("selected windows exceed max-train")
    rest = base.withColumn("rank", stable_rank(seed, F.col(key).cast("string"))).orderBy("rank").limit(max(0, most - n))
    both = extras.select(F.col(key).cast("string").alias("row")).unionByName(rest.select(F.col(key).cast("string").alias("row")))
    return both.withColumn("draw", stable_rank(seed + 1, F.col("row"))).orderBy("draw", "row")
