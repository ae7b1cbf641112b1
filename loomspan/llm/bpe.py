"""Byte-level BPE over Arrow batches with the tokenizers library, and back.

A text is cut as the pattern of the rank file cuts it: by character classes
(letters, numbers, white space, others) over whole arrays of UTF-8 bytes, which
gives the same pieces as the regular expression.  Arrow numbers the distinct
pieces of a pass, comparing them byte by byte; each is encoded once by the
tokenizers library (a bounded cache keeps pieces between passes; they are found
by hash and then compared byte by byte), and ids of a text are gathered by piece.  The model is built from the rank file: its
vocabulary in the byte-to-character alphabet, and the merges that the ranks
imply.

Offsets of an id are code points: of the character that holds its first byte,
and one past the character that holds its last, so that ids that split a
character overlap in it.  Decoding turns the characters of each
id back into bytes by the alphabet reversed; `Decoder` decodes
ids that arrive in parts and holds back the bytes of a split character until
the rest of it comes.

Defined results: null and empty texts have no ids; special strings are ordinary
text; repeated rows each get their own result; an empty table gives an empty
result; other columns are kept and may have any name; decoding null gives null,
and an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import passes, span_hashes, table, utf8, with_columns

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Pieces that a worker keeps between passes.
CACHE = 600_000
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache
def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


@lru_cache
def _classes() -> np.ndarray:
    """The class of each code point; surrogates, which no text holds, are others."""
    out = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[np.frombuffer("".join(regex.findall(pattern, everything)).encode("utf-32-le"), np.uint32)] = kind
    return out


def _kinds(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to."""
    kind = _classes()[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first, wide = data[lead].astype(np.int32), lead + 4 <= len(data)
        byte = lambda k: data[np.minimum(lead + k, len(data) - 1)].astype(np.int32) & 0x3F
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        cp = np.where(size == 2, (first & 0x1F) << 6 | byte(1), np.where(size == 3, (first & 0x0F) << 12 | byte(1) << 6 | byte(2), (first & 0x07) << 18 | byte(1) << 12 | byte(2) << 6 | byte(3) * wide))
        of = _classes()[np.minimum(cp, 0x10FFFF)]
        for k in range(4):
            kind[lead[size > k] + k] = of[size > k]
    return kind


def pieces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where each piece of the pattern begins in UTF-8 bytes; starts: where each text begins (one more: the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _kinds(data)
    text = np.zeros(n + 1, bool)
    text[starts] = True
    run = text[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    begin = run.copy()
    heads = np.flatnonzero(run)
    ends = np.append(heads[1:], n)
    # White space before other text leaves its last character to what follows: as its head if it is a blank, else alone.
    last = ends[(kind[heads] == SPACE) & ~text[ends]] - 1
    follows = last + 1
    while len(inside := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[inside] -= 1
    begin[last] = True
    begin[follows[data[last] == 0x20]] = False
    # An apostrophe alone before letters, with no blank before it, begins one of the endings.
    single = heads[(ends - heads == 1) & (data[heads] == 0x27) & begin[heads] & ~text[ends]]
    single = single[kind[np.minimum(single + 1, n - 1)] == LETTER]
    if len(single):
        at = lambda k: np.where(single + k < n, data[np.minimum(single + k, n - 1)], 0)
        one, two = at(1), np.where(text[np.minimum(single + 2, n)], 0, at(2))
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for which, size in ((short, 2), (long, 3)):
            begin[single[which] + 1] = False
            after = single[which] + size
            begin[after[after < n]] = True
    return np.flatnonzero(begin)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that each token of two bytes or more is merged from: what is left of it under the ranks below its own."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(((ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)))
            if best >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class Bpe:
    """Encoder of many texts; `source` is the JSON of a byte-level tokenizer without its cutting of texts."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(source)
        # Pieces come in the alphabet of the vocabulary, which has no blank.
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.letter = np.array([ord(c) for c in byte_alphabet()], "<u4")
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # a token has a character for each of its bytes
            self.bytes[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        # Bytes of the known pieces, where each begins (one more: the end), their hashes, and a table of places by hash.
        self.data, self.begin, self.hash = np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.uint64)
        self.slots = np.full(1 << 12, -1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.place = np.zeros(1, np.int64)  # where the ids of each known piece begin (one more: the end)

    @staticmethod
    def source_of_ranks(path: str) -> str:
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, char = load_ranks(path), byte_alphabet()
        text = lambda b: "".join(char[x] for x in b)
        model = models.BPE(vocab={text(b): r for b, r in ranks.items()}, merges=[(text(a), text(b)) for a, b in merges_of(ranks)])
        tokenizer = Tokenizer(model)
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return tokenizer.to_str()

    @staticmethod
    def source_of_json(path: str) -> str:
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        return tokenizer.to_str()

    def _learn(self, data: np.ndarray, begin: np.ndarray, hashes: np.ndarray) -> None:
        """Encode pieces as one sequence; the bytes of its ids tell where each piece ends."""
        end = begin[1:]
        letters = np.full(len(data) + len(end), 0x20, "<u4")
        letters[np.arange(len(data)) + np.repeat(np.arange(len(end)), np.diff(begin))] = self.letter[data]
        ids = np.array(self.tokenizer.encode_batch_fast([letters.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, np.uint32)
        upto = np.cumsum(self.bytes[ids])
        place = np.searchsorted(upto, end) + 1
        if (upto[place - 1] != end).any():
            raise ArithmeticError("ids do not keep to their words")
        self.place = np.concatenate([self.place, place + self.place[-1]])
        self.ids = np.concatenate([self.ids, ids])
        self.data, self.begin, self.hash = np.concatenate([self.data, data]), np.concatenate([self.begin, end + self.begin[-1]]), np.concatenate([self.hash, hashes])
        known = len(self.hash)
        left = np.arange(known - len(end), known)
        if 2 * known > len(self.slots):
            self.slots, left = np.full(1 << (4 * known).bit_length(), -1, np.int64), np.arange(known)
        last = np.uint64(len(self.slots) - 1)
        at = (self.hash[left] & last).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            wait = self.slots[at] != left
            left, at = left[wait], (at[wait] + 1) & int(last)

    def _find(self, data: np.ndarray, begin: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The place of each piece among the known ones (-1: none); a hash alone decides nothing."""
        out, left, last = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), len(self.slots) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        if not len(self.hash):
            return out
        while len(left):
            got = self.slots[at]
            fits = (got >= 0) & (self.hash[got] == hashes[left])
            out[left[fits]] = got[fits]
            go = (got >= 0) & ~fits
            left, at = left[go], (at[go] + 1) & last
        size = np.diff(begin)
        found = np.flatnonzero(out >= 0)
        other = size[found] != self.begin[out[found] + 1] - self.begin[out[found]]
        out[found[other]] = -1
        found = found[~other]
        size, upto = size[found], np.cumsum(size[found])
        step = np.arange(upto[-1] if len(upto) else 0)
        differs = data[step + np.repeat(begin[found] - upto + size, size)] != self.data[step + np.repeat(self.begin[out[found]] - upto + size, size)]
        out[found[np.searchsorted(upto, np.flatnonzero(differs), "right")]] = -1
        return out

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins in them (one more: the end)."""
        data, starts = utf8(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        flat, at = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for i, j in passes(starts):
            ids, ends = self._pass(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i])
            flat.append(ids)
            at.append(ends + at[-1][-1])
        return np.concatenate(flat), np.concatenate(at)

    def _pass(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = pieces(data, starts)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(starts) - 1, np.int64)
        # Pieces follow each other without a gap, so they are an Arrow column over the bytes as they are.
        edges = np.append(begin, len(data))
        coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        same = coded.indices.to_numpy()
        words, at = utf8(coded.dictionary)
        hashes = span_hashes(words, at[:-1], at[1:])
        piece = self._find(words, at, hashes)
        fresh = np.flatnonzero(piece < 0)
        if len(fresh):
            if len(self.hash) + len(fresh) > CACHE:
                # Whatever a pass needs stays until its end, even if it is more than the bound.
                self._forget()
                fresh = np.arange(len(hashes))
            piece[fresh] = len(self.hash) + np.arange(len(fresh))
            self._learn(*utf8(coded.dictionary.take(pa.array(fresh))), hashes[fresh])
        count = (self.place[piece + 1] - self.place[piece]).astype(np.int32)[same]
        upto = np.cumsum(count, dtype=np.int32 if len(data) < 1 << 30 else np.int64)
        at = self.place[piece].astype(upto.dtype)[same]
        at -= upto
        at += count
        at = np.repeat(at, count)
        at += np.arange(len(at), dtype=at.dtype)
        return self.ids[at], np.concatenate([np.zeros(1, np.int64), upto])[np.searchsorted(begin, starts[1:])]


class Decoder:
    """Ids to bytes by table; text of ids that come in parts, without broken characters."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.place = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self._open = codecs.getincrementaldecoder("utf-8")("replace")

    @classmethod
    def of_model(cls, source: str) -> Decoder:
        """From the JSON of a byte-level tokenizer: the characters of its tokens stand for bytes, by the alphabet turned round."""
        from tokenizers import Tokenizer

        byte = {c: b for b, c in enumerate(byte_alphabet())}
        vocabulary = Tokenizer.from_str(source).get_vocab(with_added_tokens=False)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else b""
        return cls(tokens)

    @classmethod
    def of_ranks(cls, path: str) -> Decoder:
        return cls.of_model(Bpe.source_of_ranks(path))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where those of each end."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.size):
            raise ValueError("an id outside the vocabulary")
        size = self.size[ids]
        upto = np.cumsum(size)
        return self.flat[np.repeat(self.place[ids] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)], upto

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.decode(ids)[0].tobytes()

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        return self._open.decode(self.decode_bytes(ids), last)

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last code point of each id."""
        data, end = self.decode(ids)
        char = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        return char[end - self.size[ids]].astype(np.int32), (char[end - 1] + 1).astype(np.int32)


_MADE: dict[str, object] = {}


def _once(key: str, make):
    """One object for each worker and file: workers live on from task to task."""
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _source(spark: SparkSession, path: str):
    """The model as JSON, made on the driver; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(Bpe.source_of_json(path) if path.endswith(".json") else Bpe.source_of_ranks(path))


def encode(docs: DataFrame, ranks: str | None = None, offsets: bool = False) -> DataFrame:
    """_row and ids array<int> of each row of docs; with offsets, also begins and ends (code points)."""
    ranks = ranks or rank_file()
    source = _source(docs.sparkSession, ranks)

    def run(col: pa.Array) -> dict[str, pa.Array]:
        bpe = _once("bpe" + ranks, lambda: Bpe(source.value))
        ids, at = bpe.encode(col)
        where = pa.array(at, pa.int32())
        out = {"ids": pa.ListArray.from_arrays(where, pa.array(ids.astype(np.int32)))}
        if offsets:
            got = [_once("dec" + ranks, lambda: Decoder.of_model(source.value)).offsets(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
            for k, name in enumerate(("begins", "ends")):
                out[name] = pa.ListArray.from_arrays(where, pa.array(np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int32)))
        return out

    return with_columns(docs, run, "ids array<int>" + ", begins array<int>, ends array<int>" * offsets)


def decode(rows: DataFrame, ranks: str | None = None, ids: str = "ids") -> DataFrame:
    """_row and decoded (string; broken characters as U+FFFD) of each row with a column of ids."""
    ranks = ranks or rank_file()

    def run(batches):
        for batch in batches:
            decoder = _once("dec" + ranks, lambda: Decoder.of_ranks(ranks))
            col = batch.column(0).field(batch.column(0).type.get_field_index(ids))
            texts = [None if x is None else decoder.decode_bytes(np.array(x, np.int64)).decode("utf-8", "replace") for x in col.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["_row", "decoded"])

    from pyspark.sql import types as T

    from .common import carried

    packed = carried(rows)
    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, ranks: str | None = None, keep: bool = False) -> DataFrame:
    """_row, n_tokens, ids_sha256 and decoded_sha256 of each row of docs; ids stay in the worker, or come along as ids array<int> (keep)."""
    ranks = ranks or rank_file()
    source = _source(docs.sparkSession, ranks)

    def run(col: pa.Array) -> dict[str, pa.Array]:
        bpe, decoder = _once("bpe" + ranks, lambda: Bpe(source.value)), _once("dec" + ranks, lambda: Decoder.of_model(source.value))
        ids, at = bpe.encode(col)
        ids = ids.astype("<u4")
        data, upto = decoder.decode(ids)
        where = np.concatenate([[0], upto])[at]
        n = np.diff(at)
        a = [hashlib.sha256(ids[i:j]).hexdigest() for i, j in zip(at[:-1], at[1:])]
        b = [hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(where[:-1], where[1:])]
        out = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
        if keep:
            out["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
        return out

    return with_columns(docs, run, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs).select(F.col("_row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
