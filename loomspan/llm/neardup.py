"""Near-duplicates by SetSketch registers.

A document's set is its distinct shingles of `width` words (A-Z to a-z; words
``[^\\x20\\x09-\\x0D]+``).  Each of m registers keeps the smallest point of a
Poisson process that the shingle's hash drives, on an exponential scale with
base `BASE` and truncated to 16 bits: registers of a union are the larger of
each pair, and two sets share a register with a chance of about their Jaccard
similarity.  Points above a bound at which all registers are filled are never
drawn, so a set costs about m * (ln m + 10) points whatever its size.

1. Equal sets are one class, found by digest; one of each goes on.
2. Bands of `ROWS` registers put classes into buckets.  At a similarity of 0.85
   the chance to share none of the 32 bands is below 1e-8.
3. In a bucket each class is paired with the smallest; a joint likelihood over
   the registers drops pairs that cannot be similar enough; the rest are
   confirmed on full sets.  Links join classes to components.
4. In buckets that still hold several components, every class outside the
   largest component meets every class of another one.  Classes of such buckets
   get `FINE` registers, of which the meeting compares three bits each; only
   pairs with few enough that differ come out of it, from their first bucket,
   and are confirmed as before.  Pairs inside a component can change nothing, so
   no group is expanded into all its pairs; what is left of quadratic work is
   the comparison of words of bits within buckets, between classes that are near
   but not near enough.

Sets so small that one shingle more is too much (fewer than 6 at 0.85) can only
be linked with equal ones.  Registers come from 64-bit hashes of shingles, which
only propose pairs: a link is confirmed word by word, and classes of equal sets
are told by a cryptographic digest of the words.

Defined results: a null or empty text has no shingles and is linked with
nothing; fewer than `width` words are one shingle; rows that repeat a doc_id and
its text are one document, and `named` keeps different texts of one doc_id
apart; a null doc_id never names a component; an empty table gives an empty
result; other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rank import numbered
from .common import LOWER, NOT_SPACE, PASS_BYTES, U64, mix, passes, span_hashes, spans_of, stored, table, utf8
from .components import components

ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
FINE = 1024
#: Pairs of one text that are confirmed by one task.
DEALT = 512
BASE = 1.01
WIDTH, SIMILAR = 3, (85, 100)
_GOLD = U64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = LOWER[data]
    begin, end, first = spans_of(NOT_SPACE, data, starts)
    h = span_hashes(data, begin, end, 7)
    n = max(0, len(h) - width + 1)
    sh = np.zeros(n, U64)
    for k in range(width):
        sh = mix(sh * _GOLD + h[k : n + k])
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(np.unique(sh[a : b - width + 1]))
        elif b > a:
            x = np.full(1, b - a, U64)
            for k in range(a, b):
                x = mix(x * _GOLD + h[k : k + 1] + U64(1))
            out.append(x)
        else:
            out.append(np.zeros(0, U64))
    return out


def exact_sets(data: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text as numbers that stand for their words, among these texts."""
    data = LOWER[data]
    begin, end, first = spans_of(NOT_SPACE, data, starts)
    edges = np.concatenate([[0], np.cumsum(end - begin)])
    words = np.ascontiguousarray(data[NOT_SPACE[data]])
    # Arrow compares words byte by byte.  A number past all words fills up shingles of fewer words.
    word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edges), pa.py_buffer(words)]).dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    n, fill = len(word), len(word)
    shingle = word
    for k in range(1, width):
        at = np.minimum(np.arange(n) + k, max(n - 1, 0))
        next_ = np.where((np.arange(n) + k < n) & (text[at] == text), word[at], fill)
        shingle = np.unique(shingle * (fill + 1) + next_, return_inverse=True)[1]
    out = []
    for a, b in zip(first[:-1], first[1:]):
        out.append(np.unique(shingle[a : max(b - width + 1, min(a + 1, b))]))
    return out


def _digest(text: bytes, size: int, small: int, width: int) -> bytes | None:
    """What tells classes of equal sets: 128 bits of the words in order or, of fewer than `small` shingles, of the shingles sorted.

    Equal digests mean equal sets.  Larger sets that are equal though their
    words come in another order have equal registers, and are linked by those.
    """
    if not size:
        return None
    words = text.split()  # at \x20 and \x09-\x0D and nowhere else
    if size < small:
        shingles = {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}
        return hashlib.blake2b(b"\n".join(sorted(shingles)), digest_size=16, person=b"set").digest()
    return hashlib.blake2b(b" ".join(words), digest_size=16, person=b"words").digest()


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """Register values of each non-empty set: int16, larger for a smaller least point."""
    out = np.zeros((len(sets), m), np.int16)
    todo, reach = np.arange(len(sets)), np.log(m) + 10.0
    while len(todo):
        size = np.array([len(sets[i]) for i in todo])
        e = np.concatenate([sets[i] for i in todo])
        doc = np.repeat(np.arange(len(todo)), size)
        bound = (reach / size)[doc]
        x = np.zeros(len(e))
        least = np.full(len(todo) * m, np.inf)
        k = 0
        while len(e):
            k += 1
            r = mix(e + U64(k * int(_GOLD) % (1 << 64)))
            x = x - np.log(((r >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
            keep = x <= bound
            e, doc, bound, x, r = e[keep], doc[keep], bound[keep], x[keep], r[keep]
            np.minimum.at(least, doc * m + (mix(r) % U64(m)).astype(np.int64), x)
        least = least.reshape(-1, m)
        full = np.isfinite(least).all(axis=1)
        out[todo[full]] = np.clip(np.floor(1 - np.log(least[full]) / np.log(BASE)), -32768, 32767).astype(np.int16)
        todo, reach = todo[~full], reach * 2
    return out


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def _small(similar: tuple[int, int]) -> int:
    """The least size of a set that a set of one shingle more can be similar to."""
    return -(-similar[0] // (similar[1] - similar[0])) if similar[0] < similar[1] else 1 << 60


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similar: float = SIMILAR[0] / SIMILAR[1], slack: float = 16.0) -> np.ndarray:
    """Which pairs may have that similarity: the best log-likelihood at or above it is within `slack` of the best at all.

    Under a similarity at the threshold the chance to be dropped is below 2e-8.
    """
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 101)[None, :]
    top = np.minimum(u / v, v / u)
    j = np.minimum(grid, top)
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    p, q = np.maximum(_chance(u - v * j), 1e-12), np.maximum(_chance(v - u * j), 1e-12)
    value = more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))
    high = np.where(grid >= similar - 1e-9, value, -np.inf).max(axis=1)
    return (top[:, 0] >= similar - 1e-9) & (high >= value.max(axis=1) - slack)


def planes(regs: np.ndarray) -> np.ndarray:
    """Three bits of each register, as three planes of whole 64-bit words."""
    bits = mix(regs.astype(np.int64).astype(U64) + np.arange(1, regs.shape[1] + 1, dtype=U64) * _GOLD)
    words = -(-regs.shape[1] // 64)
    out = []
    for k in range(3):
        plane = np.zeros((len(regs), words * 64), np.uint8)
        plane[:, : regs.shape[1]] = (bits >> U64(k)) & U64(1)
        out.append(np.packbits(plane, axis=1).view(">u8").astype(np.int64))
    return np.hstack(out) if len(regs) else np.zeros((0, 3 * words), np.int64)


def most_different(similar: tuple[int, int], m: int = FINE, chance: float = 2e-8) -> int:
    """So many registers differ in their three bits, at most, between sets at the threshold, but for a chance of 2e-8."""
    a, b = similar
    # Registers differ most often for sets of unequal sizes, one within the other: by the likelihood's own terms.
    j = a / b
    u = 1 / (1 + j)
    q = float(min(1.0, 1.02 * max(_chance(np.array(u - (1 - u) * j)) + _chance(np.array((1 - u) - u * j)), 2 * _chance(np.array((1 - j) / 2))))) * 7 / 8
    term = [math.exp(math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1) + k * math.log(q) + (m - k) * math.log1p(-q)) for k in range(m + 1)]
    left, k = 1.0, -1
    while left > chance and k < m:
        k += 1
        left = sum(term[k + 1 :])
    return k


def sketched(docs: DataFrame, width: int = WIDTH, small: int = _small(SIMILAR)) -> DataFrame:
    """doc_id, n_shingles, digest (null: no shingles), bands and registers (null: fewer than `small` shingles)."""

    def run(batches):
        for batch in batches:
            data, starts = utf8(pc.fill_null(batch.column(1), ""))
            size, digest, bands, regs = [], [], [], []
            for i, j in passes(starts):
                sets = shingle_sets(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], width)
                size += [len(s) for s in sets]
                raw, at = LOWER[data[starts[i] : starts[j]]].tobytes(), starts[i : j + 1] - starts[i]
                digest += [_digest(raw[a:b], len(s), small, width) for a, b, s in zip(at[:-1], at[1:], sets)]
                large = [k for k, s in enumerate(sets) if len(s) >= small]
                got = registers([sets[k] for k in large])
                key = np.zeros((len(large), BANDS), U64)
                for r in range(ROWS):
                    key = mix(key * _GOLD + got[:, r::ROWS].astype(np.int64).astype(U64) + np.arange(1, BANDS + 1, dtype=U64) * U64(1 << 32))
                place = dict(zip(large, range(len(large))))
                bands += [key[place[k]].astype(np.int64) if k in place else None for k in range(len(sets))]
                regs += [got[place[k]].tobytes() if k in place else None for k in range(len(sets))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(regs, pa.binary())],
                ["doc_id", "n_shingles", "digest", "bands", "registers"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, registers binary")


def _fine(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """doc_id, n and planes (of `FINE` registers) of the classes of a table of doc_ids."""

    def run(batches):
        for batch in batches:
            data, starts = utf8(pc.fill_null(batch.column(1), ""))
            size, bits = [], []
            for i, j in passes(starts):
                sets = shingle_sets(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], width)
                size += [len(s) for s in sets]
                bits += list(planes(registers(sets, FINE)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(bits, pa.list_(pa.int64()))], ["doc_id", "n", "planes"])

    return texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(run, "doc_id long, n long, planes array<long>")


def _promising(pairs: DataFrame, sketches: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that the registers do not rule out."""
    side = lambda x: sketches.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            regs = lambda x: np.frombuffer(b"".join(col[x].to_pylist()), np.int16).reshape(-1, REGISTERS)
            keep = likely(regs("r_a"), regs("r_b"), col["n_a"].to_numpy().astype(float), col["n_b"].to_numpy().astype(float), similar[0] / similar[1])
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets of shingles, compared word by word, are similar enough.

    A text that is in very many pairs is dealt over several keys, `DEALT` pairs
    each; for each key it comes once, before the texts that it is compared with.
    """
    pairs = stored(pairs, "pairs")
    several = pairs.groupBy("a").agg(F.ceil(F.count("*") / DEALT).alias("parts"))
    dealt = stored(pairs.join(several, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")), "dealt")
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.coalesce("text", F.lit("")).alias("text"))
    heads = dealt.select("a", "part").distinct().join(text("a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    rows = heads.unionByName(dealt.join(text("b"), "b").select("a", "part", "b", "text"))
    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches):
        head, a, held, size = "", None, [], 0

        def told():
            column = pa.array([head, *(t for _, t in held)], pa.large_string())
            first, *others = exact_sets(*utf8(column), width)
            keep = []
            for (b, _), other in zip(held, others):
                common = len(np.intersect1d(first, other, assume_unique=True))
                if similar[1] * common >= similar[0] * (len(first) + len(other) - common):
                    keep.append(b)
            return pa.RecordBatch.from_arrays([pa.array([a] * len(keep), pa.int64()), pa.array(keep, pa.int64())], ["a", "b"])

        for batch in batches:
            for x, b, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if b is None or size > PASS_BYTES:
                    if held:
                        yield told()
                    held, size = [], 0
                if b is None:
                    head, a = t.as_py(), x
                else:
                    held.append((b, t.as_py()))
                    size += len(held[-1][1])
        if held:
            yield told()

    return ordered.mapInArrow(run, "a long, b long")


def named(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """docs with `node`, a number of its own for each doc_id, or for each of its texts where a doc_id has several; then also node and doc_id.

    Nodes come in the order of doc_id, so that the smallest node is one of the smallest doc_id.
    """
    rows = docs.withColumn("node", F.col("doc_id").cast("long"))
    if not rows.where("node is not null").groupBy("node").count().where("count > 1").limit(1).count():
        return rows, None
    keyed = rows.withColumn("_key", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    places = numbered(keyed.where("node is not null").select("node", "_key").distinct(), ["node", "_key"])
    places = stored(places.select(F.col("node").alias("_id"), F.col("_key").alias("_its"), "place"), "places")
    joined = keyed.join(places, (F.col("node") == F.col("_id")) & (F.col("_key") == F.col("_its")), "left")
    return joined.withColumn("node", F.col("place")).drop("_key", "_id", "_its", "place"), places.select(F.col("place").alias("node"), F.col("_id").alias("doc_id"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs (doc_id, text and any other columns).

    width: words of a shingle; similar: the least Jaccard similarity of a link, as a fraction.
    """
    rows = stored(sketched(docs, width, _small(similar)), "sketches")
    classes = stored(rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")).where("n > 1 and class_id is not null"), "classes")
    later = rows.join(classes, "digest", "left").where("class_id is null or class_id = doc_id").where("bands is not null and doc_id is not null")
    sketches = stored(later.dropDuplicates(["doc_id", "digest"]).select("doc_id", "n_shingles", "bands", "registers"), "reps")
    band = sketches.select("doc_id", F.posexplode("bands").alias("band", "key"))
    full = band.groupBy("key").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    buckets = stored(band.join(full, "key").select("key", "band", "doc_id", "head"), "buckets")
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(buckets.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    tried = buckets.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = stored(_confirmed(_promising(tried, sketches, similar), texts, width, similar), "confirmed")
    found = components(links)

    labelled = buckets.join(found, F.col("doc_id") == F.col("node"), "left").select("key", "band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    left = stored(labelled.join(mixed, "key", "left_semi"), "mixed")
    largest = left.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"))
    fine = stored(_fine(left.select("doc_id").distinct(), texts, width), "fine")
    sized = left.join(largest, "key").join(fine, "doc_id").join(sketches.select("doc_id", "bands"), "doc_id")
    one = sized.where("component <> main").select("key", "band", F.col("bands").alias("bx"), F.col("doc_id").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("planes").alias("px"))
    two = sized.select(F.col("key").alias("k2"), F.col("bands").alias("by"), F.col("doc_id").alias("y"), F.col("component").alias("cy"), "main", F.col("n").alias("ny"), F.col("planes").alias("py"))
    words = -(-FINE // 64)
    differ = [functools.reduce(lambda a, b: a.bitwiseOR(b), [F.col("px")[k * words + w].bitwiseXOR(F.col("py")[k * words + w]) for k in range(3)]) for w in range(words)]
    close = sum(F.bit_count(d) for d in differ) <= most_different(similar)
    sizes = F.least("nx", "ny") * similar[1] >= F.greatest("nx", "ny") * similar[0]
    # Two classes that share several buckets, all of which are mixed then, meet in the first.
    first = functools.reduce(lambda a, b: a & b, [(F.lit(i) >= F.col("band")) | (F.col("bx")[i] != F.col("by")[i]) for i in range(BANDS)])
    rest = one.join(two, (F.col("key") == F.col("k2")) & (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("main")) | (F.col("x") < F.col("y"))) & sizes & close & first)
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    # The fine registers tell more than the likelihood over the others could.
    more = stored(_confirmed(rest, texts, width, similar), "confirmed")
    if more.limit(1).count():
        found = components(links.union(more))

    at = rows.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "class_id"), "digest", "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"))
    return at.join(found, F.col("class_id") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, names = named(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = near_duplicates(docs.select(F.col("node").alias("doc_id"), "text"))
    if names is not None:
        of = lambda a, b: names.select(F.col("node").alias(a), F.col("doc_id").alias(b))
        rows = rows.join(of("doc_id", "own"), "doc_id", "left").join(of("component_id", "least"), "component_id", "left")
        rows = rows.select(F.col("own").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))
    return rows.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, len(s) AS n FROM s),
e AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM s),
c AS MATERIALIZED (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
f AS MATERIALIZED (SELECT doc_id, g FROM e SEMI JOIN c USING (g)),
p AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM f x JOIN f y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id) q
  JOIN n na ON na.doc_id = q.a JOIN n nb ON nb.doc_id = q.b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
l AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r(node, low) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node WHERE r.low < l.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.low) AS component_id, min(r.low) = n.doc_id AS kept FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""
