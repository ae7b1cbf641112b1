"""Personal data in texts, by built-in expressions only.

Regular expressions propose spans; checks confirm them (digit counts and Luhn
for cards, parts for IP addresses, mod-97 for IBANs); each span then gets a
score from its kind, raised or lowered by context words next to it.  The four
base kinds (email, ip, card, phone) always stay; the added kinds (iban, ssn)
stay with a score of `threshold` or more, so an ssn needs a word that speaks of
it nearby.  Per kind, matches are leftmost and do not overlap; a failing match
is dropped and not tried again.

The patterns carry ``(?<!class)|\\G`` where the leftmost match of the plain
pattern can only begin at the head of a run of that class or where the match
before ended, and possessive quantifiers where nothing after them can want a
character back: the same matches, in time linear in the text.

Context words are looked for between a match and its neighbours of the same
kind, at most `NEAR` code points away.  Starts are running sums over what
stands between matches, so that many matches in one text cost no more each.

Positions are code points.  Defined results: a null or empty text has no spans
(the digest is that of an empty string); ties in start are ordered by kind as
listed; repeated rows each get their own result; an empty table gives an empty
result; other columns of the input are kept in `_row` and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import carried, running_sums, table

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: kind: (pattern, what a text must hold to be searched, score, context that raises it, context that lowers it)
KINDS: dict[str, tuple[str, str, float, str, str]] = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@", 0.9, "mail|contact|kontakt|correo|courriel", "example|noreply"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.7, r"\bip\b|address|host|server", "version|release|section"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}", 0.8, "card|visa|master|credit|karte|tarjeta|carte", "order|invoice|serial|isbn"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|tel|call|mobile|fax", "offset|score|utc|gmt"),
    # The character before is part of the match, and the one after is looked at with it.
    "iban": (r"(?:^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", 0.9, "iban|account|konto|bank|cuenta|compte", "order|serial"),
    # Whole runs that hold the form, of which those that are no more are valid.
    "ssn": (r"(?<![0-9A-Za-z-])[0-9A-Za-z-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9A-Za-z-]*+", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.4, r"ssn|social security|tax id", "part|serial|model|order"),
}
BASE = ("email", "ip", "card", "phone")
THRESHOLD = 0.6
#: Code points on either side of a span in which context words count.
NEAR = 40


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _iban_rest(m: Column) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda a, c: (F.when(c.between("0", "9"), a * 10).otherwise(a * 100) + value(c)) % 97)


def _valid(kind: str, m: Column, after: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "ssn":
        return m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    if kind == "iban":
        return F.when(~after.rlike("^[A-Za-z0-9]") & F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34), _iban_rest(m) == 1).otherwise(False)
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    """The confirmed matches of a kind: array of struct(kind, start, end, score).

    split() and regexp_extract_all() run the same matcher, so piece i stands
    before match i, and the ends are running sums of lengths.
    """
    pattern, holds, score, more, less = KINDS[kind]
    order = list(KINDS).index(kind)
    none = F.expr("CAST(array() AS array<struct<start:int,ord:int,kind:string,end:int,score:double>>)")

    def spans(x: Column) -> Column:
        gaps, found = x["gaps"], x["found"]

        def one(m: Column, i: Column, ends: Column) -> Column:
            value = F.when(m.rlike("^[A-Z]"), m).otherwise(F.substr(m, F.lit(2))) if kind == "iban" else m
            before, after = gaps[i], gaps[i + 1]
            around = F.lower(F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR))))
            points = F.lit(score) + F.when(around.rlike(more), 0.3).otherwise(0.0) - F.when(around.rlike(less), 0.2).otherwise(0.0)
            span = F.struct((ends[i] - F.length(value)).alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), ends[i].alias("end"), F.round(F.least(F.lit(1.0), points), 2).alias("score"))
            return F.when(_valid(kind, value, after), span)

        sizes = F.transform(found, lambda m, i: F.length(gaps[i]) + F.length(m))
        return let(running_sums(sizes), lambda ends: F.filter(F.transform(found, lambda m, i: one(m, i, ends)), lambda s: s.isNotNull()))

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return F.when(text.rlike(holds), let(parts, spans)).otherwise(none)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """_row and pii (array of struct(start, ord, kind, end, score), by start, then kind) of each row of docs."""
    t = F.coalesce(F.col("_row")[text], F.lit(""))
    found = F.array_sort(F.flatten(F.array(*[_found(k, t) for k in KINDS])))
    return carried(docs).select("_row", F.filter(found, lambda s: s["kind"].isin(*BASE) | (s["score"] >= threshold)).alias("pii"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), *[number(k).alias(f"n_{k}") for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"))


# --- the same in SQL ---
_SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?:^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", "ssn": r"[0-9A-Za-z-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9A-Za-z-]*",
}
_DIGITS_SQL = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS_SQL}) + 1), lambda k: CAST(substr({_DIGITS_SQL}, -k, 1) AS BIGINT) * (1 + (k - 1) % 2) - CASE WHEN k % 2 = 0 AND CAST(substr({_DIGITS_SQL}, -k, 1) AS BIGINT) > 4 THEN 9 ELSE 0 END)) % 10 = 0"
_PLAIN = "replace(m, ' ', '')"
_TURNED = f"substr({_PLAIN}, 5) || left({_PLAIN}, 4)"
_REST = f"list_reduce(list_prepend(0, list_transform(string_split({_TURNED}, ''), lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT))), lambda a, v: (a * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97) = 1"
_VALID_SQL = {
    "email": "true", "ip": "list_max(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) * 1000 + TRY_CAST(right('0' || x, 3) AS BIGINT))) <= 3255", "card": f"CASE WHEN length({_DIGITS_SQL}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS_SQL}) BETWEEN 9 AND 15", "iban": f"CASE WHEN NOT regexp_matches(after, '^[A-Za-z0-9]') AND length({_PLAIN}) BETWEEN 15 AND 34 THEN {_REST} ELSE false END", "ssn": "regexp_matches(m, '^[0-9]{3}-[0-9]{2}-[0-9]{4}$')",
}


def _kind_sql(order: int, kind: str) -> str:
    pattern, (_, holds, score, more, less) = _SQL_PATTERNS[kind], KINDS[kind]
    value = "CASE WHEN regexp_matches(x.m, '^[A-Z]') THEN x.m ELSE substr(x.m, 2) END" if kind == "iban" else "x.m"
    return rf"""SELECT doc_id, {order} AS ord, '{kind}' AS kind, x.upto - length({value}) AS start, x.upto AS stop, {value} AS m, x.after AS after,
      {score} + CASE WHEN regexp_matches(x.around, '{more}') THEN 0.3 ELSE 0 END - CASE WHEN regexp_matches(x.around, '{less}') THEN 0.2 ELSE 0 END AS score
      FROM (SELECT doc_id, unnest(list_transform(range(1, len(f) + 1), lambda i: {{'m': f[i], 'after': g[i + 1], 'around': lower(right(g[i], {NEAR}) || ' ' || left(g[i + 1], {NEAR})),
        'upto': CAST(list_sum(list_transform(g[1:i], lambda s: length(s))) + list_sum(list_transform(f[1:i], lambda s: length(s))) AS BIGINT)}})) AS x
        FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}') AS f FROM d WHERE regexp_matches(text, '{holds}')))"""


ORACLE_SQL = "WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),\n" + ",\n".join(f"{k}_ AS (SELECT * FROM ({_kind_sql(i, k)}) WHERE {_VALID_SQL[k]})" for i, k in enumerate(KINDS)) + f""",
a AS ({' UNION ALL '.join(f'SELECT doc_id, ord, kind, start, stop, score FROM {k}_' for k in KINDS)}),
s AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < {len(BASE)}), '') AS base, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM a WHERE ord < {len(BASE)} OR score >= {THRESHOLD} - 1e-9 GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (doc_id)"""
