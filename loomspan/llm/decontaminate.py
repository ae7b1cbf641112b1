"""Benchmark decontamination by Wu-Manber search over words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.  The
patterns are all windows of ``window`` consecutive words of an item; an item of
fewer words, but not none, is one window.  For patterns of m words and blocks
of B words the shift table holds, for each block of any pattern, how far its
last occurrence in a pattern stands before the pattern's end, and m - B + 1 for
all other blocks.  A search looks at the block that ends at its position and
moves on by its shift; where that is 0, the bucket of the block (patterns that
end in it) is looked through by hash, the pattern found is compared with the
text word by word, and the search moves on by one word.

Texts are cut into stretches of `STRETCH` positions that are searched in step,
so that each step is a few operations over arrays; a window may reach back over
the head of its stretch, so stretches miss nothing.

Defined results: null or empty texts and items have no words; a text without
words is never contaminated; equal windows of several items count for each;
repeated rows each get their own result; an empty table gives an empty result;
an empty benchmark hits nothing.  Columns that the input brings are kept in
``_row`` and may have any name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, U64, mix, passes, span_hashes, spans_of, table, utf8, with_columns

WINDOW = 13
BLOCK = 2
#: Positions that are searched one after the other.
STRETCH = 192
#: Bytes of benchmark text held by each task at a time; a larger benchmark is searched for in several parts.
PART_BYTES = 8 << 20
KINDS = "n_words long, hits array<int>, items array<string>"

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
_STEP = U64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    begin, end, _ = spans_of(WORD, data, np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(begin, end)]


def _word_hashes(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return span_hashes(data, at[:-1], at[1:], 5)


def _chain(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(at), U64)
    for k in range(n):
        out = out * _STEP + h[at + k]
    return mix(out)


class Patterns:
    """The tables of one part of the benchmark, by length of the pattern."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        by: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            m = min(window, len(words))
            for i in range(len(words) - m + 1 if m else 0):
                of = by[m][b" ".join(words[i : i + m])]  # a null item has windows, but no name to report
                if item is not None:
                    of.add(item)
        self.tables = []
        for m, windows in sorted(by.items()):
            size = min(BLOCK, m)
            shift: dict[int, int] = {}
            bucket = []
            for w in windows:
                h = _word_hashes(w.split(b" "))
                blocks = _chain(h, np.arange(m - size + 1), size).tolist()
                for k, x in enumerate(blocks):
                    shift[x] = min(shift.get(x, m), m - size - k)
                bucket.append((blocks[-1], int(_chain(h, np.array([0]), m)[0])))
            known = np.array(sorted(shift), U64)
            # A bucket is a range of pairs (last block, window), searched as one mixed key.
            keys = np.array([b for b, _ in bucket], U64), np.array([w for _, w in bucket], U64)
            self.tables.append((m, size, known, np.array([shift[int(x)] for x in known], np.int64), np.unique(mix(keys[0]) ^ keys[1]), dict(windows)))

    def search(self, data: np.ndarray, starts: np.ndarray) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text: its words, the ordinals of those that are hit, the items found."""
        data = LOWER[data]
        begin, end, first = spans_of(WORD, data, starts)
        n = len(begin)
        out = [(int(b - a), np.zeros(0, np.int32), set()) for a, b in zip(first[:-1], first[1:])]
        if not n or not self.tables:
            return out
        h = span_hashes(data, begin, end, 5)
        raw = data.tobytes()
        found: dict[int, list] = defaultdict(list)
        words_in = np.diff(first)
        for m, size, known, shift, bucket, windows in self.tables:
            # The word that ends the window stands at m - 1 or later in its text; positions are dealt into stretches.
            last = np.maximum(words_in - m + 1, 0)
            per = -(-last // STRETCH)
            text = np.repeat(np.arange(len(last)), per)
            ordinal = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
            at = first[text] + m - 1 + ordinal * STRETCH
            stop = np.minimum(at + STRETCH, first[text + 1])
            while len(at):
                block = _chain(h, at - size + 1, size)
                place = np.minimum(np.searchsorted(known, block), len(known) - 1)
                step = np.where(known[place] == block, shift[place], m - size + 1)
                ends = np.flatnonzero(step == 0)
                if len(ends):
                    here = at[ends]
                    key = mix(block[ends]) ^ _chain(h, here - m + 1, m)
                    place = np.minimum(np.searchsorted(bucket, key), len(bucket) - 1)
                    for k in np.flatnonzero(bucket[place] == key):
                        i = int(here[k]) - m + 1
                        same = windows.get(b" ".join(raw[begin[x] : end[x]] for x in range(i, i + m)))
                        if same is not None:
                            found[int(text[ends[k]])].append((i, m, same))
                at = at + np.maximum(step, 1)
                on = at < stop
                if not on.all():
                    at, stop, text = at[on], stop[on], text[on]
        for k, got in found.items():
            covered = np.unique(np.concatenate([np.arange(i, i + m) for i, m, _ in got])) - first[k]
            out[k] = (out[k][0], covered.astype(np.int32), set().union(*(s for *_, s in got)))
        return out


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """_row, n_words, hits (ordinals of hit words) and items of each row of docs.

    The benchmark is dealt into parts of at most about `part_bytes`; one pass
    over the texts (no shuffle) searches for one part, so that what a task
    holds is bounded whatever the benchmark's size.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-int(total) // part_bytes) or 1
    out = None
    for part in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        patterns = docs.sparkSession.sparkContext.broadcast(Patterns([(r[0], r[1]) for r in mine.collect()], window))

        def find(col: pa.Array, patterns=patterns) -> dict[str, pa.Array]:
            data, starts = utf8(col)
            got = []
            for i, j in passes(starts):
                got += patterns.value.search(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
            return {
                "n_words": pa.array([n for n, *_ in got], pa.int64()),
                "hits": pa.array([x for _, x, _ in got], pa.list_(pa.int32())),
                "items": pa.array([sorted(x) for *_, x in got], pa.list_(pa.string())),
            }

        if out is None:
            out = with_columns(docs, find, KINDS)
        else:
            text = out.select("_row", F.col("hits").alias("h"), F.col("items").alias("i"), F.col("_row.text").alias("text"))
            out = with_columns(text, find, KINDS).select(
                F.col("_row._row").alias("_row"), "n_words",
                F.array_union("hits", "_row.h").alias("hits"), F.array_sort(F.array_union("items", "_row.i")).alias("items"),
            )
    return out


def contaminated(hits: str = "hits", words: str = "n_words"):
    return (F.size(hits) > 0) & (20 * F.size(hits) >= F.col(words))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
v AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT doc_id, i, v.m, item FROM v JOIN p ON v.m = p.m AND v.win = p.win),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
