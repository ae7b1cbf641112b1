"""Filters with reasons, first-wins dedup, and the two training formats, over rows of TRACE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ExportConfig
from ..functions.text import matches_any, parse_bound

CONDITIONING = ("system", "developer")


def reason(config: ExportConfig) -> Column:
    """Why a trace is left out: the first test that fails, in this order; null if none does."""
    since, until = parse_bound("since", config.since), parse_bound("until", config.until)
    tests: list[tuple[str, Column]] = []
    add = lambda name, on, fails: tests.append((name, fails())) if on else None
    some = lambda array, patterns: F.exists(array, lambda v: matches_any(v, patterns))
    add("source_not_included", config.include_sources, lambda: ~matches_any(F.col("source"), config.include_sources))
    add("source_dropped", config.drop_sources, lambda: matches_any(F.col("source"), config.drop_sources))
    add("project_not_included", config.projects, lambda: ~some("project_values", config.projects))
    add("model_not_included", config.models, lambda: ~some("models", config.models))
    add("status_not_included", config.statuses, lambda: ~matches_any(F.col("status"), config.statuses))
    add("before_since", since is not None, lambda: F.col("created").isNull() | (F.col("created") < since))
    add("after_until", until is not None, lambda: F.col("created").isNull() | (F.col("created") > until))
    add("below_min_messages", config.min_turns is not None, lambda: F.col("n_messages") < config.min_turns)
    add("above_max_messages", config.max_turns is not None, lambda: F.col("n_messages") > config.max_turns)
    add("below_min_assistant_chars", config.min_assistant_chars is not None, lambda: F.col("assistant_chars") < config.min_assistant_chars)
    add("tools_required", config.require_tools, lambda: F.col("tool_calls") == 0)
    add("diffs_required", config.require_diffs, lambda: F.col("diffs") == 0)
    out = F.lit(None).cast("string")
    for name, fails in reversed(tests):
        out = F.when(fails, name).otherwise(out)
    return out


def first_of_each(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key.  The minimum is taken before the shuffle, so that a hot key is one row of each task."""
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*order)).alias("_first"))
    at = F.struct(*[F.col(c) for c in order])
    return df.join(first, (F.col(key) == F.col("_key")) & (at == F.col("_first")), "left_semi")


def judged(traces: DataFrame, config: ExportConfig) -> DataFrame:
    """traces with reason, repeat (a kept trace of the same key comes before) and the file order."""
    rows = traces.withColumn("reason", reason(config))
    if not config.dedup:
        return rows.withColumn("repeat", F.lit(False))
    # The minimum is taken before the shuffle, and the first ones are joined by their own place, so that no key gathers its traces.
    first = rows.where("reason is null").groupBy("dedup_key").agg(F.min(F.struct("src_file", "line_no")).alias("at")).select(F.col("at.src_file").alias("_file"), F.col("at.line_no").alias("_line"))
    joined = rows.join(first, (F.col("src_file") == F.col("_file")) & (F.col("line_no") == F.col("_line")), "left")
    return joined.withColumn("repeat", F.col("reason").isNull() & F.col("_line").isNull()).drop("_file", "_line")


def messages_rows(rows: DataFrame) -> DataFrame:
    """Of judged rows, those of the messages format."""
    return rows.where("reason is null and not repeat and has_assistant")


def pairs_of(messages: Column) -> Column:
    """array of struct(human, gpt): each assistant message with the user or tool message right before it, others left aside."""
    turns = F.filter(messages, lambda m: m["role"].isin("user", "tool", "assistant"))
    with_last = F.transform(turns, lambda m, i: F.struct(F.try_element_at(turns, F.when(i > 0, i).otherwise(F.lit(2147483647))).alias("human"), m.alias("gpt")))
    return F.filter(with_last, lambda p: (p["gpt"]["role"] == "assistant") & F.coalesce(p["human"]["role"] != "assistant", F.lit(False)))


def sharegpt_rows(rows: DataFrame) -> DataFrame:
    """Of judged rows, one for each pair: pair_index, pair_count, conversations (array of struct(from, value)).

    System and developer messages, wherever they stand, come before the first pair.
    A conversation is one row, so that pairing needs no shuffle.
    """
    kept = rows.where("reason is null and not repeat").withColumn("pairs", pairs_of(F.col("messages")))
    said = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    lead = F.transform(F.filter("messages", lambda m: m["role"].isin(*CONDITIONING)), lambda m: said("system", m["content"]))
    out = kept.withColumn("lead", lead).select("*", F.posexplode("pairs").alias("pair_index", "pair"))
    both = F.array(said("human", F.col("pair.human.content")), said("gpt", F.col("pair.gpt.content")))
    convs = F.when(F.col("pair_index") == 0, F.concat("lead", both)).otherwise(both)
    return out.select("src_file", "line_no", "source", "trace_id", "metadata", "pair_index", F.size("pairs").alias("pair_count"), convs.alias("conversations"))


def trailing_user(messages: Column) -> Column:
    """Whether the last message that is not conditioning is the user's."""
    turns = F.filter(messages, lambda m: m["role"].isNull() | ~m["role"].isin(*CONDITIONING))
    return F.coalesce(F.try_element_at(turns, F.lit(-1))["role"] == "user", F.lit(False))


def summary(rows: DataFrame, variant: str) -> dict:
    """Counts of rows written and left out, for reports (a few numbers, and one for each reason and source)."""
    open_ = F.col("reason").isNull() & ~F.col("repeat")
    n_pairs = F.size(pairs_of(F.col("messages")))
    if variant == "messages":
        written, none = (open_ & F.col("has_assistant")).cast("long"), open_ & ~F.col("has_assistant")
    else:
        written, none = F.when(open_, n_pairs).otherwise(0).cast("long"), open_ & (n_pairs == 0) & ~trailing_user(F.col("messages"))
    per = rows.groupBy("source", "reason").agg(
        F.sum(written).alias("written"), F.sum(none.cast("long")).alias("none"), F.sum(F.col("repeat").cast("long")).alias("repeats"),
        F.sum((open_ & trailing_user(F.col("messages"))).cast("long")).alias("trailing"), F.count("*").alias("n")).collect()
    reasons: dict[str, int] = {}
    sources: dict[str, int] = {}
    for r in per:
        if r["reason"]:
            reasons[r["reason"]] = reasons.get(r["reason"], 0) + r["n"]
        if r["written"]:
            sources[r["source"]] = sources.get(r["source"], 0) + r["written"]
    out = {("rows" if variant == "messages" else "pairs"): sum(sources.values()), "dropped_no_assistant": sum(r["none"] for r in per), "dropped_filter": sum(reasons.values()),
           "dropped_dedup": sum(r["repeats"] for r in per), "dropped_by_reason": reasons, "by_source": sources}
    return out if variant == "messages" else out | {"dropped_trailing_user": sum(r["trailing"] for r in per)}


def _json(value: Column) -> Column:
    """A string as JSON text (to_json of a one-element array, without its brackets)."""
    text = F.to_json(F.array(value))
    return F.substr(text, F.lit(2), F.length(text) - 2)


def messages_json(rows: DataFrame) -> DataFrame:
    """src_file, line_no and value: lines of messages.jsonl."""
    one = lambda m: F.concat(F.lit('{"role": '), F.coalesce(_json(m["role"]), F.lit("null")), F.lit(', "content": '), _json(m["content"]), F.lit("}"))
    line = F.concat(F.lit('{"messages": ['), F.array_join(F.transform("messages", one), ", "), F.lit('], "metadata": '), F.col("metadata"), F.lit("}"))
    return messages_rows(rows).select("src_file", "line_no", line.alias("value"))


def sharegpt_json(rows: DataFrame) -> DataFrame:
    """src_file, line_no, pair_index and value: lines of sharegpt.jsonl."""
    one = lambda m: F.concat(F.lit('{"from": '), _json(m["from"]), F.lit(', "value": '), _json(m["value"]), F.lit("}"))
    pair = F.concat(F.lit(', "pair": {"index": '), F.col("pair_index"), F.lit(', "count": '), F.col("pair_count"), F.lit("}}"))
    meta = F.concat(F.substr(F.col("metadata"), F.lit(1), F.length("metadata") - 1), pair)
    line = F.concat(F.lit('{"conversations": ['), F.array_join(F.transform("conversations", one), ", "), F.lit('], "metadata": '), meta, F.lit("}"))
    return sharegpt_rows(rows).select("src_file", "line_no", "pair_index", line.alias("value"))
