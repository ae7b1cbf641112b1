"""Chat formatting with a grammar round trip, by built-in expressions only.

Grammar of a formatted conversation (nothing stands between turns):

    turn      := user | assistant | system | other
    user      := "[INST]" body "[/INST]"          assistant := "<s>" body "</s>"
    system    := "<<SYS>>" body "<</SYS>>"        other     := "[ROLE]" role "[/ROLE]" user

A control string is any of these marks; none may stand within a role or body.
Escaping puts a backslash after its first character; one that already carries
backslashes there gets one more, which undoes uniquely.

Each turn is rendered as it is and parsed back.  If the parser does not give the
turn's role and text (a mark within a body is an error to it, and an escape is
undone), what conflicts in them is escaped and the turn rendered again; that one
parses to the source, as no mark is left within it.  The whole conversation is
parsed once more from its formatted text, and `identical` tells whether its
turns are those of the source.  The loss mask covers the bodies of assistant
turns.

Defined results: a null text or role is empty; turns are in order of turn, then
role, then text (ties, repeated rows); an empty table gives an empty result;
a null conv_id is a conversation of its own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import table

CONTROL = r"([<\[])(\\*)((?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>))"
ESCAPED = r"([<\[])\\(\\*)((?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>))"
#: A mark that is not escaped.
MARK = r"[<\[](?:(?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>))"
TURN = r"(?s)(?:\[ROLE\].*?\[/ROLE\])?\[INST\].*?\[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>"
_MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}


def escape(text: Column) -> Column:
    return F.when(text.rlike(CONTROL), F.regexp_replace(text, CONTROL, r"$1\\$2$3")).otherwise(text)


def unescape(text: Column) -> Column:
    return F.when(text.rlike(ESCAPED), F.regexp_replace(text, ESCAPED, "$1$2$3")).otherwise(text)


def _render(role: Column, text: Column) -> Column:
    """A turn with texts as they are given."""
    out = F.concat(F.lit("[ROLE]"), role, F.lit("[/ROLE][INST]"), text, F.lit("[/INST]"))
    for name, (a, b) in _MARKS.items():
        out = F.when(role == name, F.concat(F.lit(a), text, F.lit(b))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text, n, lead, all), unescaped.

    n: code points of the body as it stands, lead: those before it, all: those of
    the turn.  A role or body that holds a mark is an error: its text is null.
    """
    inner = lambda t, a, b: F.substr(t, F.lit(len(a) + 1), F.length(t) - len(a) - len(b))

    def one(t: Column) -> Column:
        role_end = F.instr(t, "[/ROLE]")
        out = F.struct(F.substr(t, F.lit(7), role_end - 7).alias("role"), F.substr(t, role_end + 13, F.length(t) - role_end - 19).alias("body"), (role_end + 12).alias("lead"))
        for name, (a, b) in _MARKS.items():
            out = F.when(t.startswith(a), F.struct(F.lit(name).alias("role"), inner(t, a, b).alias("body"), F.lit(len(a)).alias("lead"))).otherwise(out)
        return out

    read = lambda x: F.when(~x.rlike(MARK), unescape(x))
    pieces = F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), lambda t: F.struct(one(t).alias("x"), F.length(t).alias("all")))
    return F.transform(pieces, lambda p: F.struct(read(p["x"]["role"]).alias("role"), read(p["x"]["body"]).alias("text"), F.length(p["x"]["body"]).alias("n"), p["x"]["lead"].alias("lead"), p["all"].alias("all")))


def _survives(turn: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn parses to this role and text, and to nothing else."""
    read = parse(turn)
    same = lambda p: (F.size(p) == 1) & (p[0]["role"] == role) & (p[0]["text"] == text) & (p[0]["all"] == F.length(turn))
    return F.coalesce(let(read, same), F.lit(False))


def _digest_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (as parsed from it), loss (array of struct(start, end), code points) and identical of each conversation.

    A conversation is one row, as its formatted text is one string.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct("turn", role.alias("role"), text.alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("source"))
    pairs = lambda x: F.transform(x, lambda t: F.struct(t["role"], t["text"]))
    plain = F.transform("source", lambda t: F.struct(t["role"], t["text"], _render(t["role"], t["text"]).alias("turn")))
    kept = F.transform(plain, lambda t: F.when(_survives(t["turn"], t["role"], t["text"]), t["turn"]).otherwise(_render(escape(t["role"]), escape(t["text"]))))
    read = chats.select("conv_id", "source", F.array_join(kept, "").alias("formatted")).withColumn("parsed", parse(F.col("formatted")))
    read = read.withColumn("identical", F.coalesce(pairs(F.col("parsed")) == pairs(F.col("source")), F.lit(False)))
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + t["lead"]
        span = F.array(F.struct(start.alias("start"), (start + t["n"]).alias("end")))
        return F.struct((acc["at"] + t["all"]).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    loss = F.aggregate("parsed", F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return read.select("conv_id", "formatted", pairs(F.col("parsed")).alias("turns"), loss.alias("loss"), "identical")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    chats = format_chats(rows.unionByName(more))
    masked = F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(_digest_text(F.col("turns")), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


_CTRL_SQL = r"[<\[]\\*(?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>)"
ORACLE_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CTRL_SQL}')) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
    ELSE 26 + length(role) + len(regexp_extract_all(role, '{_CTRL_SQL}')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
