"""Quality rules with adaptive thresholds.

Each text gets counts (one Arrow pass, no shuffle), then four ratios in parts
per thousand.  For each (lang, source) a quantile sketch of each ratio counts
values by bins: values below 256 have bins of their own, larger ones share one
with those that agree in their first eight binary digits.  So there is no upper
bound, a quantile is at most 1/128 of itself too low, and a sketch has some 128
bins for each doubling.  Sketches merge by adding counts, whatever the order, so
the result is the same on every run.

The threshold of a group is q3 + `reach` * max(q3 - q1, slack); that of its
language weighs in as `weight` documents would, and that of the whole corpus in
the language's in the same way, so small groups lean on what is around them and
large ones on themselves.  A document is an outlier if a ratio lies above the
threshold.  Counts are written once, without texts, and joined with the
thresholds, whose table has a row per language and source.

Defined results: null or empty texts have no words and fail the base rules; a
null lang or source is a group of its own; repeated rows each get their own
result and each count in the sketches; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, with_columns

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Documents that a language's threshold counts as in that of a group, and the corpus's in that of a language.
WEIGHT = 200
REACH = 3.0
#: Least spread of a ratio (parts per thousand) that a threshold allows for.
SLACK = {"symbols": 10, "dup_lines": 100, "repeats": 100, "word_length": 1200}
KINDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the number of lines with a word."""
    words = text.encode().split()  # bytes.split() cuts at \x20 and \x09-\x0D and nowhere else
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        last = -1
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeats += i + 3 - max(i, last)
                last = i + 3
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines)


def measured(docs: DataFrame) -> DataFrame:
    """_row and the counts of each row of docs."""

    def run(col: pa.Array) -> dict[str, pa.Array]:
        got = [counts(t) for t in col.to_pylist()]
        names = [k.split()[0] for k in KINDS.split(", ")]
        return {n: pa.array([g[k] for g in got], pa.int64()) for k, n in enumerate(names)}

    return with_columns(docs, run, KINDS)


RATIOS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}


def ratio(name: str):
    part, whole = map(F.col, RATIOS[name])
    return F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(0).cast("long")


def bin_of(value):
    """The least value of the bin: the first eight binary digits, zeros after them."""
    below = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, below), below)


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, kind, bin, n: the sketches as counts by bin.  rows: lang, source and the counts."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), bin_of(ratio(k)).alias("bin")) for k in RATIOS])
    return rows.select("lang", "source", F.explode(pairs).alias("p")).groupBy("lang", "source", "p.kind", "p.bin").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, weight: int = WEIGHT, reach: float = REACH) -> DataFrame:
    """lang, source, and the thresholds as a struct cut of one for each ratio."""
    whole = sketch.withColumns({"by": F.lit(2), "lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    by_lang = sketch.withColumns({"by": F.lit(1), "source": F.lit(None).cast("string")})
    merged = sketch.withColumn("by", F.lit(0)).unionByName(by_lang).unionByName(whole).groupBy("by", "lang", "source", "kind", "bin").agg(F.sum("n").alias("n"))
    w = "PARTITION BY `by`, lang, source, kind"
    run = merged.select("*", F.expr(f"sum(n) OVER ({w} ORDER BY bin)").alias("upto"), F.expr(f"sum(n) OVER ({w})").alias("size"))
    slack = F.create_map(*[F.lit(x) for k, v in SLACK.items() for x in (k, v)])
    q = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("size"), F.col("bin")))
    cuts = run.groupBy("by", "lang", "source", "kind").agg(q(1).alias("q1"), q(3).alias("q3"), F.first("size").cast("double").alias("size"))
    cuts = cuts.withColumn("cut", F.col("q3") + reach * F.greatest(F.col("q3") - F.col("q1"), slack[F.col("kind")]))
    wide = cuts.groupBy("by", "lang", "source").agg(F.first("size").alias("size"), F.struct(*[F.max(F.when(F.col("kind") == k, F.col("cut"))).alias(k) for k in RATIOS]).alias("cut"))
    one = wide.where("by = 0").select("lang", "source", F.col("size").alias("n0"), F.col("cut").alias("c0"))
    two = wide.where("by = 1").select(F.col("lang").alias("lang2"), F.col("size").alias("n1"), F.col("cut").alias("c1"))
    three = wide.where("by = 2").select(F.col("cut").alias("c2"))
    joined = one.join(two, F.col("lang").eqNullSafe(F.col("lang2"))).join(F.broadcast(three), F.lit(True), "left")
    lean = lambda n, own, other: (n * own + weight * other) / (n + weight)
    cut = F.struct(*[lean(F.col("n0"), F.col("c0")[k], lean(F.col("n1"), F.col("c1")[k], F.col("c2")[k])).alias(k) for k in RATIOS])
    return joined.select("lang", "source", cut.alias("cut"))


def judged(rows: DataFrame, weight: int = WEIGHT, reach: float = REACH) -> DataFrame:
    """rows (a table with lang, source and the counts, which is read twice) with base_failed and kept."""
    cut = thresholds(sketches(rows), weight, reach).select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), "cut")
    joined = rows.join(cut, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = F.greatest(*[(ratio(k) > F.col("cut")[k]).cast("int") for k in RATIOS]) > 0
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~F.coalesce(far, F.lit(False))}).drop("lang_", "source_", "cut")


def _counted(docs: DataFrame, *keep) -> DataFrame:
    """The counts of docs, written once: those columns of docs, lang, source and the counts."""
    group = [F.col(f"_row.{c}").cast("string").alias(c) for c in ("lang", "source")]
    return stored(measured(docs).select(*keep, *group, *[k.split()[0] for k in KINDS.split(", ")]), "counts")


def quality(docs: DataFrame, weight: int = WEIGHT, reach: float = REACH) -> DataFrame:
    """_row, the counts, base_failed and kept of each row of docs (text, lang, source and any other columns, which are written once, too)."""
    return judged(_counted(docs, "_row"), weight, reach).drop("lang", "source")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(_counted(docs, F.col("_row.doc_id").alias("doc_id"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_SPACE_CLASS = r"[\x20\x09-\x0D]"
ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
x AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS win FROM g),
r AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM x) WHERE c > 1) GROUP BY doc_id),
c AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_SPACE_CLASS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda l: length(regexp_replace(l, '{_SPACE_CLASS}', '', 'g')) > 0)) AS n_lines,
    len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: length(regexp_replace(l, '{_SPACE_CLASS}', '', 'g')) > 0))) AS u_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
m AS (
  SELECT *, CAST(n_lines - u_lines AS BIGINT) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN 1000 * (n_lines - u_lines) // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
    CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS word_length
  FROM c),
u AS (SELECT lang, source, p.kind AS kind, p.slack AS slack, (p.v >> greatest(length(bin(p.v)) - 8, 0)) << greatest(length(bin(p.v)) - 8, 0) AS bin FROM (
  SELECT lang, source, unnest([{{'kind': 'symbols', 'v': symbols, 'slack': {SLACK['symbols']}}}, {{'kind': 'dup_lines', 'v': dup_lines, 'slack': {SLACK['dup_lines']}}},
    {{'kind': 'repeats', 'v': repeats, 'slack': {SLACK['repeats']}}}, {{'kind': 'word_length', 'v': word_length, 'slack': {SLACK['word_length']}}}]) AS p FROM m)),
q AS (
  SELECT lvl, l, s, kind, count(*) AS n, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3, max(slack) AS slack
  FROM (SELECT 0 AS lvl, lang AS l, source AS s, kind, bin, slack FROM u UNION ALL SELECT 1, lang, NULL, kind, bin, slack FROM u UNION ALL SELECT 2, NULL, NULL, kind, bin, slack FROM u) GROUP BY lvl, l, s, kind),
t AS (SELECT lvl, l, s, kind, CAST(n AS DOUBLE) AS n, CAST(q3 + {REACH} * greatest(q3 - q1, slack) AS DOUBLE) AS cut FROM q),
k AS (
  SELECT g.lang, g.source, a.kind, (a.n * a.cut + {WEIGHT} * ((b.n * b.cut + {WEIGHT} * z.cut) / (b.n + {WEIGHT}))) / (a.n + {WEIGHT}) AS cut
  FROM (SELECT DISTINCT lang, source FROM m) g
  JOIN t a ON a.lvl = 0 AND a.l IS NOT DISTINCT FROM g.lang AND a.s IS NOT DISTINCT FROM g.source
  JOIN t b ON b.lvl = 1 AND b.l IS NOT DISTINCT FROM g.lang AND b.kind = a.kind
  JOIN t z ON z.lvl = 2 AND z.kind = a.kind),
f AS (SELECT lang, source, max(cut) FILTER (kind = 'symbols') AS c1, max(cut) FILTER (kind = 'dup_lines') AS c2, max(cut) FILTER (kind = 'repeats') AS c3, max(cut) FILTER (kind = 'word_length') AS c4 FROM k GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (symbols > c1 OR dup_lines > c2 OR repeats > c3 OR word_length > c4) AS kept
FROM m JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
"""
