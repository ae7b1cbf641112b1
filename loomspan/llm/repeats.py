"""Removal of bytes covered by a 100-byte string that also starts earlier in the corpus.

Prefix-free parsing, dealt over a cluster.  A window is a start of `SIZE` bytes
within one text.

* Rolling-hash triggers create phrases: the trigger of a window is the k-mer of
  least hash in it (the first of equal ones), so equal windows have equal
  triggers at equal places.  A phrase is a run of windows with one trigger, with
  all bytes they cover.  Every window is in one phrase.
* The dictionary holds each phrase at its first place in (doc_id, start); the
  parse is the phrases of each text.  All windows of a phrase that is not at its
  first place are repeats.
* Where phrases of one trigger differ, their windows may still be equal.  Such a
  phrase is cut into parts by how far its windows begin before the trigger, at
  most `PART` windows each.  All windows that a part may have share a core of
  bytes around the trigger; parts meet by it.  Equal parts are as equal phrases;
  a part whose core no other part has holds no repeats.
* What is left is put together a range of the dictionary at a time, and the
  suffix array of the range (by doubling of ranks, so it compares bytes) brings
  equal windows next to each other: the first of a range goes on, the others are
  repeats.  Ranges are combined into corpus order by 128-bit hashes of their
  distinct windows.  Other windows at the first place of a phrase have no
  earlier equal.

A task forwards one row for each phrase, part or window that it saw, however
often; its other occurrences in the task are repeats already.  So a passage
that stands in a third of all texts gives a key at most two rows a range.
Texts travel compressed, once.

Defined results: a null text has no bytes; texts of fewer than 100 bytes lose
nothing; rows with one doc_id are one document; rows with a null doc_id stay
whole; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE, U64, mix, passes, span_hashes, stored, table, utf8

SIZE = 100
KMER = 24
PART = 20
#: Phrases or parts, and windows, that a task gathers before it forwards the distinct ones.
GATHER, RANGE = 1 << 18, 1 << 18
#: Bytes of text that are worked on at a time; of a longer text, a piece.
PIECE = 1 << 20
_PLACE_BITS = U64(24)
#: What a row says: a phrase, a repeat, that its trigger has several phrases in one task, that its windows are to be compared.
PHRASE, REPEAT, MARK, QUERY = range(4)
_ROWS = "key long, more long, doc_id long, run long"


class Rolling:
    """Karp-Rabin hashes modulo 2**64 of k-mers by prefix sums: they choose triggers, and tell nothing to be equal."""

    BASE = 0x5851F42D4C957F2D
    _powers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64),) * 2

    def __init__(self, data: np.ndarray, seed: int = 21):
        values = np.random.default_rng(seed).integers(1, 1 << 63, 256).astype(U64)
        if len(self._powers[0]) <= len(data):
            size = max(len(data) + 1, PIECE + (1 << 18))
            Rolling._powers = tuple(np.cumprod(np.concatenate([np.ones(1, U64), np.full(size, b, U64)]), dtype=U64) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(values[data] * self._powers[0][: len(data)], out=self.sums[1:])

    def kmers(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * self._powers[1][:n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def phrases(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Trigger hash, phrase hash, text, first window (in its text), bytes from there to the trigger, and number of windows of each phrase."""
    n = len(data)
    none = tuple(np.zeros(0, t) for t in (U64, U64, *[np.int64] * 4))
    if n < SIZE:
        return none
    kmer = Rolling(data).kmers(KMER)
    key = (kmer >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(kmer), dtype=U64)
    trigger = (_least(key, SIZE - KMER + 1) & U64((1 << 24) - 1)).astype(np.int64)
    windows = len(trigger)
    text = np.searchsorted(starts, np.arange(windows), "right") - 1
    valid = np.arange(windows) + SIZE <= starts[text + 1]
    head = valid.copy()
    head[1:] &= (trigger[1:] != trigger[:-1]) | ~valid[:-1] | (text[1:] != text[:-1])
    begin = np.flatnonzero(head)
    if not len(begin):
        return none
    bound = head.copy()
    bound |= ~valid
    edges = np.append(np.flatnonzero(bound), windows)
    end = edges[np.searchsorted(edges, begin, "right")]
    phrase = mix(span_hashes(data, begin, end + SIZE - 1, 22) + (trigger[begin] - begin).astype(U64))
    return kmer[trigger[begin]], phrase, text[begin], begin - starts[text[begin]], trigger[begin] - begin, end - begin


def _firsts(a: np.ndarray, b: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (a, b, doc, start); in it, whether a row heads its (a, b), and whether it stands elsewhere than that head."""
    order = np.lexsort((start, doc, b, a))
    a, b, doc, start = a[order], b[order], doc[order], start[order]
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    mine = np.maximum.accumulate(np.where(head, np.arange(len(a)), 0))
    return order, head, (doc != doc[mine]) | (start != start[mine])


def _batch(kind: int, key: np.ndarray, more: np.ndarray, doc: np.ndarray, start: np.ndarray, off: np.ndarray | int, n: np.ndarray | int) -> pa.RecordBatch:
    """A run of windows is packed into one long: its first, how far the trigger stands behind that, its length, and the kind of the row."""
    run = (start.astype(np.int64) << 24) | (np.asarray(off, np.int64) << 16) | (np.asarray(n, np.int64) << 4) | kind
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (key.astype(np.int64), more.astype(np.int64), doc, run)], ["key", "more", "doc_id", "run"])


def _unpacked(runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = runs.to_numpy()
    return x >> 24, (x >> 16) & 0xFF, (x >> 4) & 0xFFF


def _scatter(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A key of its own for a row that needs no meeting."""
    return mix(doc.astype(U64) * U64(0x9E3779B97F4A7C15) + start.astype(U64))


def _distinct(found):
    """Rows of phrases or parts (key, more, doc, start, off, n): each once for a gathering, and what else there is to say of them."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def forward():
        a, b, doc, start, off, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, head, repeat = _firsts(a, b, doc, start)
        a, b, doc, start, off, n = (x[order] for x in (a, b, doc, start, off, n))
        yield _batch(REPEAT, _scatter(doc, start)[repeat], b[repeat], doc[repeat], start[repeat], off[repeat], n[repeat])
        a, b, doc, start, off, n = (x[head] for x in (a, b, doc, start, off, n))
        if not len(a):
            return
        same = np.zeros(len(a) + 1, bool)
        same[1:-1] = a[1:] == a[:-1]
        several = same[1:] | same[:-1]
        yield _batch(PHRASE, a[~several], b[~several], doc[~several], start[~several], off[~several], n[~several])
        # A key with several phrases in one task: their windows are compared, and one row tells the other tasks.
        yield _batch(QUERY, _scatter(doc, start)[several], b[several], doc[several], start[several], off[several], n[several])
        mark = several & ~same[:-1]
        yield _batch(MARK, a[mark], b[mark], doc[mark], start[mark], off[mark], n[mark])

    for rows in found:
        held.append(rows)
        size += len(rows[0])
        if size >= GATHER:
            yield from forward()
            size = 0
    if held:
        yield from forward()


def _phrase_rows(batches):
    def found():
        for batch in batches:
            doc = batch.column(0).to_numpy()
            data, starts = utf8(pc.fill_null(batch.column(1), ""))
            for i, j in passes(starts, PIECE):
                # A text beyond a pass is cut into pieces that share 99 bytes; phrases cut there are compared window by window.
                for p in range(int(starts[i]), max(int(starts[i]) + 1, int(starts[j]) - SIZE + 1), PIECE):
                    q = min(int(starts[j]), p + PIECE + SIZE - 1)
                    key, phrase, text, start, off, n = phrases(data[p:q], np.clip(starts[i : j + 1] - p, 0, q - p))
                    yield key, phrase, doc[i + text], start + (p - int(starts[i]) if j == i + 1 else 0), off, n

    return _distinct(found())


def _asked(batches):
    """Some texts that have asked runs, put together: their doc_ids and first bytes, the bytes, and of each run its text, first window, bytes to the trigger and length."""
    for batch in batches:
        has = np.flatnonzero(pc.fill_null(pc.list_value_length(batch.column(2)), 0).to_numpy())
        size = np.array([int.from_bytes(batch.column(1)[int(k)].as_py()[:8], "little") for k in has], np.int64)
        for i, j in passes(np.concatenate([[0], np.cumsum(size)]), PIECE):
            some = pa.array(has[i:j])
            data = np.frombuffer(b"".join(map(_opened, batch.column(1).take(some))), np.uint8)
            lists = batch.column(2).take(some)
            text = np.repeat(np.arange(j - i), pc.list_value_length(lists).to_numpy())
            yield batch.column(0).take(some).to_numpy(), np.cumsum(size[i:j]) - size[i:j], data, text, *_unpacked(lists.flatten())


def _part_rows(batches):
    def found():
        for doc, begin, data, text, start, off, n in _asked(batches):
            trigger, before, doc = begin[text] + start + off, begin[text], doc[text]
            for a in range(0, SIZE - KMER + 1, PART):
                b = min(a + PART - 1, SIZE - KMER)
                # Windows of the run that begin from `far` to `near` bytes before the trigger; those of the part: from b to a.
                far, near = np.minimum(off, b), np.maximum(off - n + 1, a)
                on = far >= near
                x, far, near = trigger[on], far[on], near[on]
                key = span_hashes(data, x - a, x - b + SIZE, 41 + a)
                more = mix(span_hashes(data, x - far, x - near + SIZE, 40) + far.astype(U64))
                yield key, more, doc[on], x - far - before[on], far, far - near + 1

    return _distinct(found())


def suffix_ranks(data: np.ndarray, begin: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The rank of each begin among all of them in the order of the `size` bytes that follow: equal bytes, equal ranks.

    Ranks of all positions by 8 bytes are doubled to the largest power below
    `size`; two of those that overlap then make up the whole (size >= 8).
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    rank = np.unique(np.ndarray(len(data), ">u8", padded, strides=(1,)).astype(U64), return_inverse=True)[1].astype(np.int64)
    have = 8
    while have * 2 <= size:
        after = np.zeros(len(rank), np.int64)
        after[:-have] = rank[have:] + 1
        rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1]
        have *= 2
    return np.unique(rank[begin] * (len(rank) + 1) + rank[begin + size - have], return_inverse=True)[1]


def _covered(data: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes that runs of windows cover, put together; where each window begins in the data, and in that."""
    order = np.argsort(first)
    first, n = first[order], n[order]
    reach = np.maximum.accumulate(first + n + SIZE - 1)
    head = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
    a, b = first[head], reach[np.append(head[1:], len(first)) - 1]
    upto = np.cumsum(n)
    windows = np.unique(np.repeat(first - (upto - n), n) + np.arange(upto[-1]))
    of = np.searchsorted(a, windows, "right") - 1
    size = b - a
    before = np.cumsum(size) - size
    return data[np.repeat(a - before, size) + np.arange(int(size.sum()))], windows, windows - a[of] + before[of]


def _runs_of(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows as runs of neighbours: document, first and number, at most 4,095."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(head)
    size = np.diff(np.append(begin, len(doc)))
    cut = -(-size // 0xFFF)
    part = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
    at, left = np.repeat(begin, cut) + part * 0xFFF, np.repeat(size, cut) - part * 0xFFF
    return doc[at], place[at], np.minimum(left, 0xFFF)


def _window_rows(batches):
    held: list[tuple[np.ndarray, ...]] = []

    def forward():
        docs, contents, places, spots = zip(*held)
        held.clear()
        before = np.cumsum([0, *map(len, contents)])[:-1]
        range_, doc, place = np.concatenate(contents), np.concatenate(docs), np.concatenate(places)
        where = np.concatenate([x + b for x, b in zip(spots, before)])
        rank = suffix_ranks(range_, where)
        order, head, repeat = _firsts(rank, np.zeros(len(rank), np.int8), doc, place)
        doc, place, where = doc[order], place[order], where[order]
        d, p, n = _runs_of(doc[repeat], place[repeat])
        yield _batch(REPEAT, _scatter(d, p), np.zeros(len(d), U64), d, p, 0, n)
        key, more = (span_hashes(range_, where[head], where[head] + SIZE, seed) for seed in (31, 32))
        yield _batch(PHRASE, key, more, doc[head], place[head], 0, 1)

    size = 0
    for doc, begin, data, text, start, _, n in _asked(batches):
        content, windows, spots = _covered(data, begin[text] + start, n)
        of = np.searchsorted(begin, windows, "right") - 1
        held.append((doc[of], content, windows - begin[of], spots))
        size += len(windows)
        if size >= RANGE:
            yield from forward()
            size = 0
    if held:
        yield from forward()


def _closed(batches):
    """Texts as compressed bytes, with their length before; null stays null."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            part = batch.slice(k, SLICE)
            raw = [None if t is None else t.encode() for t in part.column(1).to_pylist()]
            packed = [None if r is None else len(r).to_bytes(8, "little") + pa.compress(r, "zstd", asbytes=True) for r in raw]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def _opened(packed: pa.Scalar) -> bytes:
    data = packed.as_py()
    return b"" if data is None else pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _met(rows: DataFrame, repeats: str, asked: str) -> DataFrame:
    """doc_id, and its runs (arrays of packed ones) that are repeats or whose windows are to be compared, by the rows of all tasks."""
    met = rows.withColumn("kind", F.col("run").bitwiseAND(15)).select(
        "kind", "doc_id", "run",
        F.expr("rank() OVER (PARTITION BY key, more ORDER BY doc_id, run)").alias("place"),
        F.expr("min(more) OVER (PARTITION BY key)").alias("lo"), F.expr("max(more) OVER (PARTITION BY key)").alias("hi"), F.expr(f"max(kind = {MARK}) OVER (PARTITION BY key)").alias("marked"),
    )
    kind = F.when(F.col("kind").isin(REPEAT, QUERY), F.col("kind")).when(F.col("kind") == MARK, None)
    # A marker stands for a phrase that is compared elsewhere: it is no earlier occurrence here, so phrases of a marked key are all compared.
    kind = kind.when(F.col("marked"), QUERY).when(F.col("place") > 1, REPEAT).when(F.col("lo") < F.col("hi"), QUERY)
    known = met.select(kind.alias("kind"), "doc_id", "run").where("kind is not null")
    of = lambda k: F.collect_list(F.when(F.col("kind") == k, F.col("run")))
    return known.groupBy("doc_id").agg(of(REPEAT).alias(repeats), of(QUERY).alias(asked))


def keep_first(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, removed (array of struct(start, end), bytes) and kept (binary) of each row of docs.

    Texts meet their phrases by doc_id once: the windows to compare and the result read the same exchanges.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = whole.where("doc_id is not null")
    phrases_ = stored(_met(some.mapInArrow(_phrase_rows, _ROWS), "repeats", "asked"), "phrases")
    texts = some.mapInArrow(_closed, "doc_id long, packed binary").join(phrases_, "doc_id", "left")
    parts = _met(texts.select("doc_id", "packed", "asked").mapInArrow(_part_rows, _ROWS), "again", "left_over")
    texts = texts.join(parts, "doc_id", "left")
    windows = texts.select("doc_id", "packed", "left_over").mapInArrow(_window_rows, _ROWS)
    later = windows.select("doc_id", "run", F.expr("rank() OVER (PARTITION BY key, more ORDER BY doc_id, run)").alias("place")).where(f"run & 15 = {REPEAT} or place > 1")
    later = later.groupBy("doc_id").agg(F.collect_list("run").alias("later"))
    none = F.expr("CAST(array() AS array<long>)")
    runs = F.concat(*[F.coalesce(c, none) for c in ("repeats", "again", "later")]).alias("runs")
    rows = texts.join(later, "doc_id", "left").select("doc_id", "packed", runs).unionByName(whole.where("doc_id is null").mapInArrow(_closed, "doc_id long, packed binary").withColumn("runs", none))

    def cut(batches):
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, max(b.num_rows, 1), SLICE)):
            out = []
            for doc, packed, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = _opened(packed)
                spans, kept = [], data
                if len(runs):
                    start, _, n = _unpacked(runs.values)
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n + SIZE - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    flips = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans = list(zip(flips[::2].tolist(), flips[1::2].tolist()))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((doc, len(data), sum(b - a for a, b in spans), len(spans), [{"start": a, "end": b} for a, b in spans], kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], ["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:int,end:int>>, kept binary")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return keep_first(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Two hexadecimal digits are a byte; windows that begin within or right behind one another's bytes make one run.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - {SIZE} + 1)) AS p, unnest(list_transform(range(0, length(h) // 2 - {SIZE} + 1), lambda i: substr(h, CAST(2 * i + 1 AS BIGINT), {2 * SIZE}))) AS s FROM d WHERE length(h) >= {2 * SIZE}),
f AS (SELECT s, min({{'d': doc_id, 'p': p}}) AS f FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE f.f.d <> doc_id OR f.f.p <> p),
b AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {SIZE} THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM b),
o AS (SELECT doc_id, min(p) AS a, max(p) + {SIZE} AS z FROM n GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM o),
g AS (SELECT k.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a) || substr(any_value(h), CAST(2 * max(z) + 1 AS BIGINT)) AS kept FROM k JOIN d USING (doc_id) GROUP BY k.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(from_hex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN g USING (doc_id)
"""
