"""Operators over the whole corpus against brute force."""

import hashlib
import random

import numpy as np
import pytest

from loomspan.llm import components, neardup, repeats

DOCS = "doc_id long, text string, n_shingles long, component string"


def frame(spark, texts, parts=4, ids=None):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids or range(len(texts)), texts)], DOCS).repartition(parts)


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    line = " ".join(rng.choice(words) for _ in range(25))
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(20, 200))) for _ in range(12)]
    texts = [None, "", "a", "a b", "A B", "a  b", "a b c", "x" * 700, "x" * 350 + "y" + "x" * 350, "ab" * 400, "é" * 200, "  \n "]
    for k in range(70):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        text = " ".join(w)
        if k % 3 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + line + text[at:]
        texts.append(text if k % 5 else text.upper())
    rng.shuffle(texts)
    return texts


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    first = {}
    for d, b in enumerate(data):
        for p in range(len(b) - repeats.SIZE + 1):
            first.setdefault(b[p : p + repeats.SIZE], (d, p))
    out = []
    for d, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - repeats.SIZE + 1):
            if first[b[p : p + repeats.SIZE]] != (d, p):
                gone[p : p + repeats.SIZE] = True
        spans = int((np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("texts", [corpus(), corpus(7) + ["".join(random.Random(k % 9).choices("ab ", k=90)) + "shared " * 3 + "".join(random.Random(2).choices("cdef", k=130)) for k in range(40)]])
def test_repeats(spark, texts):
    rows = repeats.keep_first(frame(spark, texts)).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)
    assert got == brute_repeats(texts)


def test_repeats_in_pieces_of_a_long_text(monkeypatch):
    texts = [t for t in corpus(5) if t]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    n = len(data)
    for size in (n, 4000):
        seen = np.zeros(n, int)
        for p in range(0, n - repeats.SIZE + 1, size):
            q = min(n, p + size + repeats.SIZE - 1)
            _, _, _, start, _, count = repeats.phrases(data[p:q], np.array([0, q - p]))
            for a, c in zip(start + p, count):
                seen[a : a + c] += 1
        assert (seen[: n - repeats.SIZE + 1] == 1).all() and not seen[n - repeats.SIZE + 1 :].any()


def test_repeats_of_odd_tables(spark):
    assert repeats.keep_first(frame(spark, ["a"]).limit(0)).collect() == []
    twice = frame(spark, ["q" * 10 + "w" * 300, "q" * 10 + "w" * 300], ids=[5, 5])
    assert len({bytes(r["kept"]) for r in repeats.keep_first(twice).collect()}) == 1
    null = repeats.keep_first(frame(spark, ["abc" * 90, "abc" * 90], ids=[None, 1])).collect()
    assert {r["doc_id"]: r["n_removed"] for r in null}[None] == 0


@pytest.mark.parametrize("gather", [1, 200])
def test_repeats_forwarded_in_small_gatherings(spark, gather):
    """Tasks of their own workers would not see a patched module, so the functions of a task are run here and met in Spark."""
    import pyarrow as pa

    texts = corpus(3)
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    old = repeats.GATHER, repeats.RANGE
    repeats.GATHER, repeats.RANGE = gather, gather
    try:
        got = [b for b in repeats._phrase_rows([rows])]
    finally:
        repeats.GATHER, repeats.RANGE = old
    covered = sum(int(n) for b in got for n, k in zip(*[repeats._unpacked(b.column(3))[2], b.column(3).to_numpy() & 15]) if k != repeats.MARK)
    assert covered == sum(max(0, len((t or "").encode()) - repeats.SIZE + 1) for t in texts)


def test_suffix_ranks():
    rng = random.Random(8)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(900)).encode() + b"ab" * 200, np.uint8)
    for size in (8, 13, 64, 100):
        begin = np.arange(len(data) - size + 1)
        rank = repeats.suffix_ranks(data, begin, size)
        strings = [data[b : b + size].tobytes() for b in begin]
        order = {x: i for i, x in enumerate(sorted(set(strings)))}
        assert [order[x] for x in strings] == rank.tolist()


def brute_near(texts):
    def shingles(t):
        w = (t or "").encode().lower().split() if t else []
        w = [bytes(c + 32 if 65 <= c < 91 else c for c in x) for x in (t or "").encode().split()]
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    low = list(range(len(texts)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                low[y] = x
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def test_near_duplicates(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(frame(spark, texts)).collect())
        assert got == brute_near(texts)
    assert neardup.near_duplicates(frame(spark, ["a"]).limit(0)).collect() == []


def test_near_duplicates_compare_words(spark):
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    a, b = ("".join(x[k] for k in bits) for x in ("ab", "ba"))
    long = " ".join(f"w{i}" for i in range(200))
    texts = [f"{a} x y", f"{b} x y", f"{a} {long}", f"{b} {long}", f"{a} {long}", "p q p q p q", "q p q p q p", "p  Q p q p q p q", "r " * 500, "r r r"]
    for t in (texts, texts[::-1]):
        got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(frame(spark, t)).collect())
        assert got == brute_near(t)


def test_exact_sets_are_sets_of_words():
    texts = ["a b c a b c", "B c A", "", "a", "a b", "a b c d e a b", "A  B"]
    data = "".join(texts).encode()
    starts = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    for width in (3, 5):
        sets = neardup.exact_sets(np.frombuffer(data, np.uint8), starts, width)
        words = [t.lower().split() for t in texts]
        want = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in words]
        assert [[len(a & b) for b in want] for a in want] == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_several_texts_of_one_doc_id(spark):
    texts = ["a b c d", "e f g h", "a b c d", "e f g h", "i j k l", None, None]
    ids = [3, 3, 5, 4, None, None, 3]
    docs, names = neardup.named(frame(spark, texts, ids=ids))
    rows = docs.select("doc_id", "node", "text").collect()
    assert names is not None and len({(r["doc_id"], r["text"]) for r in rows}) == len({(r["doc_id"], r["text"], r["node"]) for r in rows})
    assert neardup.named(frame(spark, ["a", "b"]))[1] is None


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 1 << 62, 900).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(1, 1 << 62, 100).astype(np.uint64)])
    ra, rb, both = neardup.registers([np.unique(a), np.unique(b), np.unique(np.concatenate([a, b]))])
    assert (neardup.merge_registers(ra, rb) == both).all()
    assert abs((ra == rb).mean() - 0.8) < 0.15
    n = np.array([900.0])
    far = neardup.registers([rng.integers(1, 1 << 62, 900).astype(np.uint64)])[0]
    assert neardup.likely(ra[None], ra[None], n, n)[0] and not neardup.likely(ra[None], far[None], n, n)[0]


def test_components(spark):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(500, k) for k in range(501, 560)]
    low = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(x, x) == c for x, c in low.items())


@pytest.mark.parametrize(("width", "similar", "sizes"), [(5, (80, 100), [(4, 5), (8, 10), (80, 100), (15, 12)]), (3, (85, 100), [(17, 20), (200, 170)])])
def test_contained_texts_at_the_threshold(spark, width, similar, sizes):
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n + width - 1))
    texts = [words(k, n) for k, pair in enumerate(sizes) for n in pair]
    got = neardup.near_duplicates(frame(spark, texts), width, similar).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(i, sizes[i // 2][i % 2], i - i % 2) for i in range(len(texts))]
