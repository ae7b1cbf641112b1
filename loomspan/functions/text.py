"""Scalar functions as Spark expressions."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import MILLISECONDS_FROM


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Lowercase hex of HMAC-SHA256, by two nested digests."""
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in key).hex()))
    inner = F.sha2(F.concat(pad(0x36), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(pad(0x5C), F.unhex(inner)), 256)


def opaque_id(prefix: str, key: bytes, canonical_json: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(hmac_sha256(key, canonical_json), 1, 24))


def stable_rank(seed: int, identity: Column) -> Column:
    """Hex of sha256 over the seed, a NUL and the identity: an order that no generator's version changes."""
    return F.sha2(F.concat(F.lit(f"{seed}\0"), identity), 256)


def glob_regex(pattern: str) -> str:
    """A shell pattern (*, ?, [..]) as an anchored Java expression over lower-cased text."""
    pattern, out, i = pattern.casefold(), "", 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if c == "[" and end > 0:
            body = pattern[i + 1 : end]
            body = ("^" + body[1:]) if body[0] == "!" else ("\\" + body if body[0] == "^" else body)
            out += "[" + re.sub(r"([\\\[&~])", r"\\\1", body) + "]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return f"(?s)^(?:{out})\\z"


def matches_any(value: Column, patterns) -> Column:
    """Whether a string matches one of the shell patterns, in any case; null: no."""
    # Lower case, with the letters that differ from it only when case is folded.
    low = F.translate(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), "ςſ", "σs")
    hit = F.lit(False)
    for p in patterns:
        hit = hit | low.rlike(glob_regex(p))
    return F.coalesce(hit, F.lit(False))


def parse_bound(name: str, raw: str | None) -> float | None:
    """An ISO time of the settings as epoch seconds; naive times are UTC."""
    if not raw:
        return None
    try:
        at = datetime.fromisoformat(raw.replace("Z", "+00:00"))
    except ValueError as e:
        raise ValueError(f"invalid --{name} timestamp: {raw!r}") from e
    return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()


def epoch_seconds(number: Column) -> Column:
    """Seconds of a number of seconds or milliseconds."""
    x = number.cast("double")
    return F.when(x > MILLISECONDS_FROM, x / 1000).otherwise(x)


def utc_day(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def let(value: Column, make) -> Column:
    """make(value), with value computed once however often make uses it: chains of such steps stay small."""
    return F.element_at(F.transform(F.array(value), make), 1)


def replace_matches(text: Column, pattern: str, make) -> Column:
    """text with each match m replaced by make(m): what stands between matches, and the matches, by turns.

    split() and regexp_extract_all() step through the same matches, so that equal
    matches need no second search.
    """

    def put(t: Column) -> Column:
        parts = F.struct(F.split(t, pattern, -1).alias("between"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("found"))
        joined = let(parts, lambda p: F.array_join(F.transform(p["between"], lambda x, i: F.concat(x, F.when(i < F.size(p["found"]), make(F.try_element_at(p["found"], i + 1))).otherwise(""))), ""))
        return F.when(t.rlike(pattern), joined).otherwise(t)

    return let(text, put)


def snippet(text: Column, start: Column, end: Column, around: int = 60, most: int = 200) -> Column:
    """What stands around a match (code points), on one line; dots where text goes on."""
    a, b = F.greatest(start - around, F.lit(0)), F.least(end + around, F.length(text))
    cut = F.concat(F.when(a > 0, "...").otherwise(""), F.substr(text, a + 1, b - a), F.when(b < F.length(text), "...").otherwise(""))
    return F.substr(F.replace(cut, F.lit("\n"), F.lit("\\n")), F.lit(1), F.lit(most))
