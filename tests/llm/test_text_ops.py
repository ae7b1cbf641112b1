"""Operators on single texts against brute force."""

import hashlib
import re
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspan.llm import bpe, chat, decontaminate, pii, quality

ODD = [None, "", " ", "\n", "a", "'s", "x's'll 've''t", " 's it'S don't!'re", "a  b\n\n c \t", "é  　x", "日本語 テキスト 123４５", "\x1c\x1d a", "----------" * 9, "aaaa" * 40,
       "<|endoftext|> hi", "\U0001f600\U0001f600 ok", "é ﷺ  ", "x " * 3000, "a" * 5000, "\x00 \x00", "12 345'm\r\n"]
DOCS = "doc_id long, text string, lang string, source string, n_words long, _row string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, "s", 1, "x") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.rank_file()), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Bpe(bpe.Bpe.source_of_ranks(bpe.rank_file()))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("' stmdrevl\n\t01é-=")), max_size=60), max_size=8))
def test_ids_are_those_of_the_rank_file(encoder, reference, texts):
    ids, at = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("=-_*a ./\\#"), max_size=300))
def test_runs_of_few_characters(encoder, reference, text):
    assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def thue_morse(n=1024):
    """Two words that polynomials modulo a power of two take for one."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_polynomial_hashes_confuse(spark, encoder, reference):
    words = [*thue_morse(), *thue_morse()]
    ids, at = encoder.encode(words)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [reference.encode_ordinary(t) for t in words]
    assert {r["decoded_sha256"] for r in bpe.round_trip(frame(spark, words)).collect()} == {hashlib.sha256(w.encode()).hexdigest() for w in words}


def test_texts_of_more_pieces_than_the_cache(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 40)
    encoder = bpe.Bpe(bpe.Bpe.source_of_ranks(bpe.rank_file()))
    for text in ["one two", " ".join(f"x{i}" for i in range(100)), "one x1 two", " ".join(f"x{i}y" for i in range(100)), ""]:
        ids, at = encoder.encode([text, "one"])
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [reference.encode_ordinary(t) for t in (text, "one")]


def test_pieces_of_one_hash_are_told_apart(reference, monkeypatch):
    monkeypatch.setattr(bpe, "span_hashes", lambda data, begin, end: np.full(len(begin), 5, np.uint64))
    encoder = bpe.Bpe(bpe.Bpe.source_of_ranks(bpe.rank_file()))
    for text in ["one two", "two one six", "sixes \u00e9one", "six two"]:
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_round_trip_query(spark, reference):
    got = {r["_row"]["doc_id"]: r for r in bpe.round_trip(frame(spark, ODD)).collect()}
    for i, t in enumerate(ODD):
        ids = reference.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(frame(spark, ODD).limit(0)).collect() == []


def test_offsets_and_split_characters(spark, reference):
    texts = ["\U0001f600 é x", "日本語", "", "plain"]
    for r in bpe.encode(frame(spark, texts), offsets=True).collect():
        text = r["_row"]["text"]
        assert all(0 <= a < b <= len(text) for a, b in zip(r["begins"], r["ends"]))
        decoder = bpe.Decoder.of_ranks(bpe.rank_file())
        assert "".join(decoder.feed(np.array([i])) for i in r["ids"]) + decoder.feed(np.zeros(0, int), True) == text
    back = bpe.decode(bpe.encode(frame(spark, texts)).select("_row.text", "ids")).collect()
    assert all(r["_row"]["text"] == r["decoded"] for r in back)


def luhn(d):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, p) in enumerate({"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), order, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


PII = [None, "", "a@b.c_d@e.f x.y%z@q-r.s.t.", "@a.b a@b a@b.", "1.2.3.4 0001.02.3.255 1.2.3.256 1.2.3.4.5.6.7.8 12.3", "4539 1488 0343 6467, 4539148803436467 4539148803436468 0000000000000 12", "+1 (988) 555-2485 +12 +1---------2 ++49 30 1234567890123456",
       "é\U0001f600 a@b.co 1.1.1.1 +4930123456 4539148803436467 a@b.co", "GB82 WEST 1234 5698 7654 32 and IBAN DE89370400440532013000, DE89370400440532013001", "ssn 123-45-6789" + " and" * 20 + "; part 123-45-6789", "9" * 30000 + " " + "a" * 30000 + "@", "1." * 3000, "a@b.cd " * 300]


def test_pii_base_spans(spark):
    rows = pii.find(frame(spark, PII)).collect()
    for r in rows:
        got = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["pii"] if s["kind"] in pii.BASE)
        assert got == base_spans(PII[r["_row"]["doc_id"]] or ""), (r["_row"]["doc_id"], got)
    kinds = {r["_row"]["doc_id"]: [(s["kind"], s["start"]) for s in r["pii"] if s["kind"] not in pii.BASE] for r in rows}
    assert kinds[8] == [("iban", 0), ("iban", 37)] and kinds[9] == [("ssn", 4)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("a.@-+ 0123459()%é"), max_size=60), min_size=1, max_size=30))
def test_pii_base_spans_of_any_text(spark, texts):
    for r in pii.find(frame(spark, texts)).collect():
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["pii"] if s["kind"] in pii.BASE) == base_spans(texts[r["_row"]["doc_id"]])


def test_quality_counts():
    def slow(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {k for i, x in enumerate(win) if win.count(x) > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), len(lines)

    for t in [x or "" for x in ODD if len(x or "") < 2000] + ["a b c a b c d\nx\nx\n \n \n#$", "a a a a a", "é é é\x1cé", "x y z\ty x y z"]:
        assert quality.counts(t) == slow(t), t


def test_quality_query_keeps_rows(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = quality.quality(frame(spark, ODD + [words] * 6 + ["#$%& " * 100 + words])).collect()
    assert len(rows) == len(ODD) + 7
    assert all(r["kept"] and not r["base_failed"] for r in rows if r["_row"]["text"] == words)
    assert quality.quality(frame(spark, ODD).limit(0)).collect() == []


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", ""), (2, 0, None, None), (2, 1, "tool", "[/ROLE] <\\s> [\\\\INST]"), (2, 1, "tool", "[/ROLE] <\\s> [\\\\INST]"), (3, 0, "system", "<<SYS>>é<</SYS>>"), (3, 1, "[ROLE]x", "<"), (None, 0, "assistant", "\\<"), (4, 0, "user", "[" * 50 + "/INST]" + "<" * 9)]


def chat_marks(conv):
    """Whether a text of the conversation holds a control string or a backslash of its own."""
    return any(re.search(r"[<\[]\\*(?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>)|\\", f"{ro or ''}\n{x or ''}") for c, _, ro, x in CHATS if c == conv)


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    for r in chat.format_chats(rows).collect():
        assert r["identical"] and (chat_marks(r["conv_id"]) or "\\" not in r["formatted"])
        want = sorted(((t, ro or "", x or "") for c, t, ro, x in CHATS if c == r["conv_id"]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for _, a, b in want]
        parts = [r["formatted"][s["start"] : s["end"]] for s in r["loss"]]
        undone = [re.sub(r"([<\[])\\(\\*)((?:/?(?:INST|ROLE)\]|/?s>|</?SYS>>))", r"\1\2\3", p) for p in parts]
        assert undone == [b for _, a, b in want if a == "assistant"]
    assert chat.format_chats(rows.limit(0)).collect() == []


def test_decontaminate_against_all_windows(spark):
    import random

    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "cc", "é", "x1", "y"])
    items = [(f"i{k}", " ".join(word() for _ in range(n))) for k, n in enumerate([1, 2, 5, 13, 14, 30, 30, 0])] + [("same", None), (None, "q q")]
    items += [("twin", items[5][1]), ("zz", "zz zz zz")]
    texts = [" ,".join([*(word() for _ in range(rng.randrange(60))), *items[rng.randrange(3, 7)][1].split(), *(word() for _ in range(9))]) for _ in range(60)] + ODD + ["ZZ.zz-zz zz"]
    bench = spark.createDataFrame(items, "item_id string, text string")
    patterns = {}
    for k, t in items:
        w = decontaminate.words_of(t)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m and k else 0):
            patterns.setdefault(tuple(w[i : i + m]), set()).add(k)
    for part_bytes in (1 << 20, 60):
        for r in decontaminate.search(frame(spark, texts), bench, part_bytes=part_bytes).collect():
            w = decontaminate.words_of(texts[r["_row"]["doc_id"]])
            hit, found = set(), set()
            for i in range(len(w)):
                for m in {len(p) for p in patterns}:
                    if tuple(w[i : i + m]) in patterns and i + m <= len(w):
                        hit |= {*range(i, i + m)}
                        found |= patterns[tuple(w[i : i + m])]
            assert (r["n_words"], sorted(r["hits"]), r["items"]) == (len(w), sorted(hit), sorted(found))


def test_benchmark_rows_without_an_item_id(spark):
    bench = spark.createDataFrame([(None, "zz yy xx"), (None, "vv uu"), ("i", "vv uu"), (None, None)], "item_id string, text string")
    for part_bytes in (1 << 20, 5):
        got = {r["_row"]["doc_id"]: (list(r["hits"]), list(r["items"])) for r in decontaminate.search(frame(spark, ["a zz yy xx", "vv uu b", "zz yy", None]), bench, part_bytes=part_bytes).collect()}
        assert got == {0: ([1, 2, 3], []), 1: ([0, 1], ["i"]), 2: ([], []), 3: ([], [])}
