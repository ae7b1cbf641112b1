"""Token files: round trips, damage, single blocks, and the query against a plain loop."""

import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspan.llm import token_file as t

DOCS = "doc_id long, text string, seq int, data string"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 65535)), max_size=80), max_size=6), st.integers(1, 40))
def test_round_trip(docs, block):
    flat = np.array([x for d in docs for x in d], np.uint32)
    data = t.write_segment(list(range(len(docs))), np.array([len(d) for d in docs], int), flat, block)
    ids, sizes, back = t.read_segment(data)
    assert ids.tolist() == list(range(len(docs))) and sizes.tolist() == [len(d) for d in docs] and (back == flat).all()
    for k in range(-(-len(flat) // block)):
        assert (t.read_segment(data, only=k)[2] == flat[k * block : k * block + block]).all()


def test_repeats_are_cheap_and_damage_is_seen():
    x = np.tile(np.arange(50), 400)
    data = t.write_segment([1], np.array([len(x)]), x)
    assert len(data) < len(x) // 4
    with pytest.raises(ValueError):
        t.read_segment(data[:200] + bytes([data[200] ^ 1]) + data[201:])
    with pytest.raises(ValueError):
        t.write_segment([1], np.array([1]), np.array([70000]))


def test_carries_reach_far():
    rng = np.random.default_rng(3)
    for k in range(20):
        x = rng.choice([0, 1, 65535, 4096 * 15], 600, p=[0.9, 0.05, 0.03, 0.02])
        assert (t.read_segment(t.write_segment([1], np.array([600]), x, 150))[2] == x).all()


def _chains(ids: int, lanes: int, steps: int) -> np.ndarray:
    """Ids of which a third follow from the last two, and the others from the last one among eight."""
    rng = np.random.default_rng(7)
    after, odds = rng.integers(0, ids, (ids, 8)), np.cumsum(0.5 ** np.arange(1, 9))
    out = np.zeros((steps, lanes), np.int64)
    for t in range(2, steps):
        drawn = after[out[t - 1], np.minimum(np.searchsorted(odds, rng.random(lanes)), 7)]
        out[t] = np.where(rng.random(lanes) < 1 / 3, (out[t - 1] * 31 + out[t - 2] * 17) % ids, drawn)
    return out.T.ravel()


def test_orders_are_used_and_cheap():
    x = _chains(2000, 1024, t.BLOCK)
    sizes, spent, yard = np.array([len(x)]), [], []
    for _ in range(2):
        a = time.process_time()
        data = t.write_segment([1], sizes, x)
        back = t.read_segment(data)[2]
        b = time.process_time()
        zlib.compress(x.astype("<u2").tobytes(), 6)
        spent.append(b - a)
        yard.append(time.process_time() - b)
    assert (back == x).all() and (t.read_segment(data, only=700)[2] == x[700 * t.BLOCK : 701 * t.BLOCK]).all()
    assert len(data) < 0.7 * len(x)  # 1.31 by adaptive guesses, 0.42 by shares of orders 2 and 1
    assert min(spent) < 9 * min(yard)  # zlib on the same ids as the yardstick: 16 and 4


def test_model_of_long_segments_is_bounded(monkeypatch):
    x = _chains(300, 64, 500)
    monkeypatch.setattr(t, "PAIRS", 10)
    model, _ = t.Model.counted(x.astype("<u4"), 500)
    assert 0 < len(model.follows) <= 1 << 11
    for block in (500, 77):
        assert (t.read_segment(t.write_segment([1], np.array([len(x)]), x, block))[2] == x).all()


TEXTS = [None, "", "hello world", "é\U0001f600 日本語", "a b c " * 3000, "<|endoftext|>", "hello world"]


@pytest.mark.parametrize("segment", [t.SEGMENT, 40])
def test_query_rows(spark, segment):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = [(i * 7 % 5 if i < 5 else 10 + i, x, 1, "x") for i, x in enumerate(TEXTS)]
    segments = t.write_tokens(spark.createDataFrame(rows, DOCS).repartition(3), segment=segment)
    got = {r["doc_id"]: r for r in t.read_digests(segments).join(t.starts(segments), ["part", "seq"]).collect()}
    ids = {r["doc_id"]: r["ids"] for r in t.read_tokens(segments).collect()}
    start = 0
    for doc, text, *_ in sorted(rows):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [t.END_ID]
        r = got[doc]
        assert (r["start"] + r["at"], r["n_tokens"], r["ids_crc32"], ids[doc]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()), want)
        start += len(want)


def test_odd_tables(spark):
    empty = t.write_tokens(spark.createDataFrame([], DOCS))
    assert t.read_digests(empty).collect() == [] and t.starts(empty).collect() == []
    null = t.write_tokens(spark.createDataFrame([(None, "a", 1, "x"), (3, "a", 1, "x"), (3, "a", 1, "x")], DOCS))
    rows = sorted((r["start"] + r["at"], r["doc_id"]) for r in t.read_digests(null).join(t.starts(null), ["part", "seq"]).collect())
    assert rows == [(0, None), (2, 3), (4, 3)]
