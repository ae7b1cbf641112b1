"""Token ids of a corpus in a binary file format, coded by context mixing and a range coder.

A segment holds whole consecutive documents.  Its bytes are

    magic "LSTF", version, number of documents, ids, blocks, and bytes of the
    model (u32 each); the model: numbers of distinct ids and of pairs (u32), the
    weights of orders 2, 1 and 0 (i32), then, deflated, for each id its distance
    from the one before, its share and its number of successors, and for each
    pair its successor, share, prediction and how sure that is (u32 each);
    doc_id (i64) and number of ids (u32) of each document;
    number of ids, number of 32-bit words, and crc32 of the ids (u32) of each block;
    the words of the blocks; the crc32 (u32) of all bytes before it.

All numbers are little-endian.  Blocks of `BLOCK` ids are coded independently:
they share the model alone, so any one can be decoded and checked alone, and all
blocks of a segment are coded in step, as lanes of numpy arrays.

The model is counted over the whole segment and goes with it.  Where the last
two ids (order 2) predict the next one well enough, a first binary decision says
whether it comes; its chance is mixed in the logistic domain from what order 2,
order 1 (the share of the pair) and order 0 (the share of the id) say of it, with
weights fitted to the segment.  Else the id is one interval of order 1, among
those that often follow the last id, or a way out and one interval of order 0.
What coder and decoder share is arithmetic on integers, so that they agree on
every machine; only the choice of what goes into the model is not.

A corpus is a table of segments (`part`, `seq`, `n_ids`, `data`) in the shared
folder, ordered by (part, seq) as documents by doc_id.

Defined results: null and empty texts have the end id alone; documents of one
doc_id stand next to each other, ordered by text; a null doc_id comes first and
is kept as such; an empty table gives no segments; other columns do not matter.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Bpe, _once, rank_file
from .common import stored, table

MAGIC, VERSION = b"LSTF", 3
BLOCK = 4096
#: Ids of a segment, about; a longer document is a segment of its own.
SEGMENT = 6 << 20
#: Lanes that are coded in step.
LANES = 2048
END_ID = 2
NULL_DOC = -(1 << 63)
#: Bits of the shares of order 0.
SHARE = 20
_U = np.uint64
_ZERO, _HALF, _FULL = _U(0), _U(32), _U(1 << 32)
#: Parts of the numbers that tell of a state and of an entry.
_CHANCE, _ROOM, _AWAY = _U(0x1FFF), _U((1 << 25) - 1), _U(1 << 25)
#: Pairs that come less often have no share of order 1 and are coded by order 0; more in segments of over 8 million
#: ids, so that a long document has no larger a model.
PAIR, PAIRS = 3, 21
#: Bits that a prediction of order 2 has to save before it is worth its place.
WORTH = 20
#: Steps that are prepared, or turned, at a time, to stay within the cache.
TILE = 8
#: Ids that are counted and looked up at a time, for the same reason.
CHUNK = 1 << 15

# Fixed tables of the logistic domain: chances of 12 bits, logits of 8 bits after the point.
_SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 32, 4064).astype(np.int64)
_STRETCH = np.clip(np.rint(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int64)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, deflated byte by byte."""
    flat = np.concatenate(columns).astype("<u4")
    return zlib.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 6)


def _unpacked(data: bytes, *sizes: int) -> list[np.ndarray]:
    flat = np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.split(flat.astype(np.int64), np.cumsum(sizes)[:-1])


def _turned(rows: np.ndarray) -> np.ndarray:
    out = np.empty(rows.shape[::-1], rows.dtype)
    for k in range(0, out.shape[0], TILE):
        out[k : k + TILE] = rows[:, k : k + TILE].T
    return out


def _looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray, other: int) -> np.ndarray:
    """The value of each 32-bit key that is known; of any other one, `other` and its lower half."""
    bits = max(4, (4 * len(known)).bit_length())
    slot = lambda x: (x * np.uint32(2654435769) >> np.uint32(32 - bits)).astype(np.int64)
    table_, at, left = np.zeros(1 << bits, _U), slot(known), np.arange(len(known))
    entry = known.astype(_U) << _HALF | values.astype(_U)  # no value is 0, so that 0 is free
    while len(left):
        free = left[table_[at[left]] == 0]
        table_[at[free]] = entry[free]
        left = left[table_[at[left]] != entry[left]]
        at[left] = (at[left] + 1) & ((1 << bits) - 1)
    out = np.empty(len(keys), np.int32)
    for k in range(0, len(keys), CHUNK):
        x = keys[k : k + CHUNK]
        at = slot(x)
        got = table_.take(at, mode="clip")
        value = got.astype(np.uint32)
        left = np.flatnonzero((got >> _HALF) != x)
        value[left] = 0
        left = left[got[left] != 0]
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << bits) - 1)
            got = table_.take(at)
            fit = (got >> _HALF) == x[left]
            value[left[fit]] = got[fit]
            go = ~fit & (got != 0)
            left, at = left[go], at[go]
        left = np.flatnonzero(value == 0)
        value[left] = (x[left] & np.uint32(0xFFFF)) + np.uint32(other)
        out[k : k + CHUNK] = value
    return out


class Model:
    """What a segment says of its ids, which its blocks are coded by.

    Ids stand by their rank among those of the segment.  A row for each (and one
    for the start of a block) has entries: the way out to order 0, then the ids
    that follow often, with shares of 2**bits of the row.  The state of a lane is
    the entry that it took last, which tells the last two ids, or, after a way
    out, one that tells the last id alone.  Entry 0 takes no room: it stands for
    what order 2 has settled.
    """

    def __init__(self, ids, share, kept, follows, share1, guess, level, weight):
        n, m = len(ids), len(follows)
        self.ids, self.share, self.kept, self.follows, self.share1, self.guess, self.level, self.weight = ids, share, kept, follows, share1, guess, level, weight
        self.below = np.cumsum(share) - share
        rows = np.append(kept, 0)  # the last one: the start of a block
        bits = self.bits_of(rows)
        first = 1 + np.cumsum(rows + 1) - (rows + 1)  # the way out of each row
        self.n, self.out, self.start = 1 + m + n + 1, first, 1 + m + n + 1 + n
        row = np.repeat(np.arange(n), kept)
        entry = np.arange(m) + row + 2
        # Entries: how wide they are, and what of their row comes before them.
        self.wide = np.ones(self.n, np.int64)
        self.wide[entry] = share1
        used = np.zeros(n + 1, np.int64)
        np.add.at(used, row, share1)
        self.wide[first] = (1 << bits) - used
        upto = np.cumsum(self.wide)
        self.low = upto - self.wide
        place = self.low[first]  # where the room of each row begins, after that of entry 0
        self.low[1:] -= np.repeat(place, rows + 1)
        self.low[0] = 0
        # States: the rank of the last id, and its row.
        self.rank = np.zeros(self.n + n + 1, np.int64)
        self.rank[entry] = follows
        self.rank[self.n :] = np.arange(n + 1)
        self.bits, self.way = bits[self.rank], first[self.rank]
        # Order 2: the entry that a state predicts, and the chance that it holds.
        self.next, chance = np.full(len(self.rank), -1, np.int64), np.zeros(len(self.rank), np.int64)
        has = np.flatnonzero(guess)
        at = entry[has]
        self.next[at] = first[follows[has]] + guess[has]
        chance[at] = _SQUASH[np.clip((self.logits(at, self.next[at], level[has]) * weight[:, None]).sum(axis=0) >> 16, -2047, 2047) + 2047]
        # As the coder wants them: chance, bits and place of a state; width, way out, and lower end of an entry.
        self.state = (place[self.rank] << 18 | self.bits << 13 | chance).astype(_U)
        self.room = self.low << 26 | self.wide
        self.room[first] |= int(_AWAY)
        self.room = self.room.astype(_U)

    @staticmethod
    def bits_of(kept: np.ndarray) -> np.ndarray:
        """Bits of a row's shares: sixteen to thirty-two for each id that follows; none if none does."""
        return np.where(kept > 0, np.frexp(kept)[1].astype(np.int64) + 4, 0)

    def logits(self, state: np.ndarray, entry: np.ndarray, level: np.ndarray) -> np.ndarray:
        """What orders 2, 1 and 0 say of an entry after a state."""
        one = (self.wide[entry] << 12) >> self.bits[state]
        none = self.share[self.rank[entry]] >> (SHARE - 12)
        return np.stack([(level - 16) * 128, _STRETCH[np.minimum(one, 4095)], _STRETCH[np.minimum(none, 4095)]])

    @classmethod
    def counted(cls, ids: np.ndarray, block: int) -> tuple[Model, np.ndarray]:
        """The model of a segment's ids, and the state after each of them."""
        count = np.zeros(1 << 16, np.int64)
        for k in range(0, len(ids), CHUNK):
            count += np.bincount(ids[k : k + CHUNK], minlength=1 << 16)
        here = np.flatnonzero(count)
        n, none = len(here), np.zeros(0, np.int64)
        share = 1 + (count[here] * ((1 << SHARE) - n) // max(len(ids), 1))
        if not n:
            return cls(here, share, none, none, none, none, none, np.zeros(3, np.int64)), np.zeros(0, np.int32)
        share[np.argmax(share)] += (1 << SHARE) - int(share.sum())
        rank = np.zeros(1 << 16, np.uint32)
        rank[here] = np.arange(n)
        # Pairs of ranks within blocks, in order: runs are the pairs.
        pair = rank.take(ids)
        pair[1:] |= pair[:-1] << np.uint32(16)
        inner = np.delete(pair, slice(None, None, block))
        inner.sort()
        begin = np.flatnonzero(np.concatenate([[True], inner[1:] != inner[:-1]])[: len(inner)])
        times, both = np.diff(begin, append=len(inner)), inner[begin]
        del inner
        row = (both >> np.uint32(16)).astype(np.int64)
        total = np.maximum(np.bincount(row, times, n).astype(np.int64), 1)
        often = times >= max(PAIR, len(ids) >> PAIRS)
        both, row, times = both[often], row[often], times[often]
        follows = (both & np.uint32(0xFFFF)).astype(np.int64)
        kept = np.bincount(row, minlength=n)
        states = _looked_up(pair, both, np.arange(len(both)) + row + 2, 2 + len(both) + n)
        states[::block] = 2 + len(both) + n + rank[ids[::block]]
        del pair
        # Shares of a row: one for each entry, the rest by counts; sums are rounded, so that nothing is left over.
        upto, first = np.cumsum(times), np.cumsum(kept) - kept
        upto -= np.concatenate([[0], upto])[first][row]
        spare = (1 << cls.bits_of(kept)) - 1 - kept
        upto = upto * spare[row] // total[row]
        share1 = 1 + np.diff(upto, prepend=0)
        head = first[kept > 0]
        share1[head] = 1 + upto[head]
        none = np.zeros(len(row), np.int64)
        model = cls(here, share, kept, follows, share1, none, none, np.zeros(3, np.int64))
        guess, level, weight = model._guesses(states, block, times)
        return cls(here, share, kept, follows, share1, guess, level, weight), states

    def _guesses(self, states: np.ndarray, block: int, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best successor of each pair where it is worth its place, how sure it is, and the weights of the orders."""
        n, m = len(self.ids), len(self.follows)
        guess, level, weight = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(3, np.int64)
        entry = np.arange(m) + np.repeat(np.arange(n), self.kept) + 2
        # Pairs of a state and the place of what follows in its row.
        size = int(self.kept.max(initial=0)).bit_length()
        kind = np.uint32 if size + self.n.bit_length() < 32 else _U
        both, none = np.empty(max(len(states) - 1, 0), kind), np.iinfo(kind).max
        way = self.way.astype(np.int32)
        for k in range(0, len(both), CHUNK):
            x, y = states[k : k + CHUNK][: len(both) - k], states[k + 1 : k + 1 + CHUNK]
            key = x.astype(kind)
            key <<= kind(size)
            key |= (y - way.take(x, mode="clip")).astype(kind)
            key[(x >= self.n) | (y >= self.n)] = none
            both[k : k + CHUNK] = key
        both[block - 1 :: block] = none
        both.sort()
        both = both[: np.searchsorted(both, none)]
        if not len(both):
            return guess, level, weight
        begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        times, both = np.diff(begin, append=len(both)), both[begin].astype(np.int64)
        before = both >> size
        after = (both & ((1 << size) - 1)) + self.way[before]
        group = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        best = np.maximum.reduceat(times << 32 | (len(times) - np.arange(len(times))), group)
        at, hits = len(times) - (best & 0xFFFFFFFF), best >> 32
        before, after = before[at], after[at]
        misses = seen[np.searchsorted(entry, before)] - hits
        q = np.clip(hits / (hits + misses), 1 / 128, 127 / 128)
        one = self.wide[after] / (1 << self.bits[before])
        worth = np.flatnonzero(hits * np.log2(q / one) + misses * np.log2(1 - q) > WORTH)
        if not len(worth):
            return guess, level, weight
        before, after, hits, misses, q = before[worth], after[worth], hits[worth], misses[worth], q[worth]
        sure = np.clip(np.rint(2 * np.log(q / (1 - q))), -16, 15).astype(np.int64) + 16
        x = self.logits(before, after, sure) / 256
        w, times = np.array([1.0, 0, 0]), hits + misses
        for _ in range(6):  # Newton's steps of a logistic regression, held near order 2
            p = 1 / (1 + np.exp(-np.clip(w @ x, -8, 8)))
            w += np.linalg.solve((x * (times * p * (1 - p))) @ x.T + np.eye(3), x @ (hits - times * p) - (w - [1, 0, 0]))
        if not np.isfinite(w).all():
            w = np.array([1.0, 0, 0])
        weight = np.clip(np.rint(w * 65536), -(1 << 20), 1 << 20).astype(np.int64)
        k = np.searchsorted(entry, before)
        guess[k], level[k] = after - self.out[self.rank[before]], sure
        return guess, level, weight

    def packed(self) -> bytes:
        gaps = np.diff(self.follows, prepend=0)
        head = (np.cumsum(self.kept) - self.kept)[self.kept > 0]
        gaps[head] = self.follows[head]
        return struct.pack("<2I3i", len(self.ids), len(self.follows), *self.weight.tolist()) + _packed(np.diff(self.ids, prepend=0), self.share, self.kept, gaps, self.share1, self.guess, self.level)

    @classmethod
    def unpacked(cls, data: bytes) -> Model:
        n, m, *weight = struct.unpack("<2I3i", data[:20])
        ids, share, kept, gaps, share1, guess, level = _unpacked(data[20:], n, n, n, m, m, m, m)
        upto, first = np.cumsum(gaps), np.cumsum(kept) - kept
        follows = upto - np.repeat(np.concatenate([[0], upto])[first], kept)
        return cls(np.cumsum(ids), share, kept, follows, share1, guess, level, np.array(weight, np.int64))


class _Encoder:
    """Range coder of n lanes: 64 bits of range, words of 32 bits; a carry stays in its word until the end."""

    def __init__(self, n: int, words: int):
        self.n, self.low, self.range = n, np.zeros(n, _U), np.full(n, (1 << 64) - 1, _U)
        self.out, self.at = np.zeros(words * n, _U), np.arange(n)  # the first words of all lanes, then the second ones

    def add(self, lanes, more: np.ndarray) -> None:
        low = self.low[lanes]
        new = low + more
        over = (new < low).nonzero()[0]
        if len(over):
            self.out[self.at[lanes][over] - self.n] += _U(1)
        self.low[lanes] = new

    def flow(self, small: np.ndarray) -> None:
        """Write a word from each of these lanes."""
        x, at = self.low[small], self.at[small]
        self.out[at] = x >> _HALF
        self.at[small] = at + self.n
        self.low[small] = x << _HALF
        self.range[small] = self.range[small] << _HALF

    def finish(self) -> list[np.ndarray]:
        for _ in range(2):
            self.flow(np.arange(self.n))
        size = self.at // self.n
        out = self.out.reshape(-1, self.n)[: int(size.max())]
        for k in range(len(out) - 1, 0, -1):
            out[k - 1] += out[k] >> _HALF
        return [w[:n] for w, n in zip(_turned(out.astype("<u4")), size)]


def encode_blocks(states: np.ndarray, sizes: np.ndarray, model: Model) -> list[np.ndarray]:
    """The 32-bit words of each block; states: those after each id, a row for each block; blocks in order of falling length."""
    steps, lanes = int(sizes.max()), len(sizes)
    on = (lanes - np.searchsorted(sizes[::-1], np.arange(steps), "right")).tolist()
    coder = _Encoder(lanes, 2 * steps + 8)
    last = np.full(lanes, model.start, np.int64)
    for t in range(0, steps, TILE):
        # What does not depend on the coder, for some steps at once.
        now = states[:, t : t + TILE].T.astype(np.int64, order="C")
        before = np.concatenate([last[None], now[:-1]])
        last = now[-1]
        told = model.state.take(before, mode="clip")
        p = told & _CHANCE
        failed = model.next.take(before, mode="clip") != now
        hit, mask = (~failed).ravel().nonzero()[0], -failed.astype(np.int64)  # all bits of it where order 2 fails
        told &= mask.view(_U)
        skip, width, bits, entry = told & _CHANCE, _U(4096) - p, (told >> _U(13)) & _U(31), now & mask
        width.ravel()[hit] = p.ravel()[hit]
        away = (now >= model.n).ravel().nonzero()[0]
        entry.ravel()[away] = model.way[before.ravel()[away]]
        room = model.room.take(entry, mode="clip")
        low, room = room >> _U(26), room & _ROOM
        at = np.searchsorted(away, np.arange(len(now) + 1) * lanes).tolist()
        rank = now.ravel()[away] - model.n
        below, share, away = model.below[rank].astype(_U), model.share[rank].astype(_U), away % lanes
        for k in range(len(now)):
            n = on[t + k]
            wide = coder.range[:n]
            # Does the prediction of order 2 hold?  Where there is none, its chance is 0.
            wide >>= _U(12)
            more = wide * skip[k, :n]
            wide *= width[k, :n]
            # Order 1, where order 2 has not settled it.
            wide >>= bits[k, :n]
            more += wide * low[k, :n]
            wide *= room[k, :n]
            coder.add(slice(0, n), more)
            coder.flow((wide < _FULL).nonzero()[0])
            i, j = at[k], at[k + 1]
            j = i + int(np.searchsorted(away[i:j], n))
            if j > i:
                left = away[i:j]
                r = coder.range[left] >> _U(SHARE)
                coder.add(left, r * below[i:j])
                r *= share[i:j]
                coder.range[left] = r
                coder.flow(left[r < _FULL])
    return coder.finish()


class _Decoder:
    """What lanes need to read ids: where each room of a row leads to, and each room of order 0."""

    def __init__(self, model: Model):
        self.model = model
        self.entry = np.repeat(np.arange(model.n, dtype=np.int32), model.wide)
        self.rank = np.repeat(np.arange(len(model.ids), dtype=np.int32), model.share)

    def blocks(self, words: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The ids of each block, whose words begin there; blocks in order of falling length."""
        model, steps, lanes = self.model, int(sizes.max()), len(sizes)
        states = np.zeros((steps, lanes), np.int32)
        on = (lanes - np.searchsorted(sizes[::-1], np.arange(steps), "right")).tolist()
        all_code, all_wide, all_place = words[begin].astype(_U) << _HALF | words[begin + 1], np.full(lanes, (1 << 64) - 1, _U), begin + 2
        share, below = model.share.astype(_U), model.below.astype(_U)
        last = np.full(lanes, model.start, np.int64)

        def flow(small):
            at = place[small]
            code[small] = code[small] << _HALF | words.take(at, mode="clip")
            place[small] = at + 1
            wide[small] = wide[small] << _HALF

        for t in range(steps):
            n = on[t]
            code, wide, place, state = all_code[:n], all_wide[:n], all_place[:n], last[:n]
            told = model.state.take(state, mode="clip")
            p = told & _CHANCE
            wide >>= _U(12)
            bound = wide * p
            hit = (code < bound).nonzero()[0]
            hit_code, hit_wide = code[hit], bound[hit]
            # All lanes go on as if order 2 had failed; those where it holds are put right afterwards.
            code -= bound
            wide *= _U(4096) - p
            told >>= _U(13)
            wide >>= told & _U(31)
            told >>= _U(5)
            told += code // wide
            to = self.entry.take(told.view(np.int64), mode="clip").astype(np.int64)
            room = model.room.take(to, mode="clip")
            code -= wide * (room >> _U(26))
            wide *= room & _ROOM
            room[hit] = _ZERO
            code[hit], wide[hit], to[hit] = hit_code, hit_wide, model.next.take(state[hit])
            flow((wide < _FULL).nonzero()[0])
            away = np.flatnonzero(room & _AWAY)
            if len(away):
                c, r = code[away], wide[away] >> _U(SHARE)
                rank = self.rank.take((c // r).view(np.int64), mode="clip")
                code[away] = c - r * below[rank]
                r *= share[rank]
                wide[away] = r
                to[away] = rank + model.n
                flow(away[r < _FULL])
            states[t, :n] = to
            last = to
        ids = _turned(model.ids.astype("<u2").take(model.rank.astype(np.int32).take(np.minimum(states, len(model.rank) - 2))))
        return [x[:n].astype("<u4") for x, n in zip(ids, sizes)]


def write_segment(docs: list[int], sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The bytes of a segment; sizes: ids of each document."""
    ids = ids.astype("<u4")
    if len(ids) and ids.max() > 0xFFFF:
        raise ValueError("ids of more than 16 bits have no place in this format")
    blocks = [ids[k : k + block] for k in range(0, len(ids), block)]
    lengths = np.array([len(b) for b in blocks], np.int64)
    words: list[np.ndarray] = []
    model, flat = Model.counted(ids, block)
    states = np.zeros((len(blocks), block), np.int32)
    states.ravel()[: len(ids)] = flat
    del flat
    for k in range(0, len(blocks), LANES):
        words += encode_blocks(states[k : k + LANES, : lengths[k]], lengths[k : k + LANES], model)
    orders = model.packed()
    head = MAGIC + struct.pack("<5I", VERSION, len(docs), len(ids), len(blocks), len(orders)) + orders
    head += np.array(docs, "<i8").tobytes() + np.asarray(sizes).astype("<u4").tobytes()
    head += np.array([(len(b), len(w), zlib.crc32(b.tobytes())) for b, w in zip(blocks, words)], "<u4").tobytes()
    body = head + b"".join(w.tobytes() for w in words)
    return body + struct.pack("<I", zlib.crc32(body))


def read_segment(data: bytes, only: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, ids of each document, and all ids (or those of one block); an error if a checksum does not fit."""
    if data[:4] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("not a whole segment")
    version, n, total, count, size = struct.unpack("<5I", data[4:24])
    if version != VERSION:
        raise ValueError(f"version {version} of a segment is not known")
    decoder, head = _Decoder(Model.unpacked(data[24 : 24 + size])), 24 + size
    docs = np.frombuffer(data, "<i8", n, head)
    sizes = np.frombuffer(data, "<u4", n, head + 8 * n)
    table_ = np.frombuffer(data, "<u4", 3 * count, head + 12 * n).reshape(-1, 3)
    words = np.append(np.frombuffer(data[head + 12 * n + 12 * count : -4], "<u4"), np.zeros(2, "<u4"))
    begin = np.cumsum(table_[:, 1], dtype=np.int64) - table_[:, 1]
    chosen = range(count) if only is None else [only]
    out: list[np.ndarray] = []
    for k in range(0, len(chosen), LANES):
        part = chosen[k : k + LANES]
        got = decoder.blocks(words, begin[part], table_[part, 0].astype(np.int64))
        for i, ids in zip(part, got):
            if zlib.crc32(ids.tobytes()) != table_[i, 2]:
                raise ValueError(f"block {i} of a segment is damaged")
        out += got
    return docs, sizes, np.concatenate(out) if out else np.zeros(0, "<u4")


def write_tokens(docs: DataFrame, tokenizer: str | None = None, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """part, seq, n_ids and data of each segment of docs (doc_id, text), as a table in the shared folder."""
    path = tokenizer or rank_file("byte_bpe_50k.json")
    source = docs.sparkSession.sparkContext.broadcast(Bpe.source_of_json(path))

    def run(batches):
        from pyspark import TaskContext

        bpe = _once("bpe" + path, lambda: Bpe(source.value))
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def forward():
            nonlocal seq, size
            data = write_segment([d for d, _ in held], np.array([len(x) for _, x in held]), np.concatenate([x for _, x in held]), block)
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], ["part", "seq", "n_ids", "data"])
            held.clear()
            seq, size = seq + 1, 0
            return out

        for batch in batches:
            ids, at = bpe.encode(pc.fill_null(batch.column(1), ""))
            for doc, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:]):
                held.append((NULL_DOC if doc is None else doc, np.append(ids[a:b], np.uint32(END_ID))))
                size += int(b - a) + 1
                if size >= segment:
                    yield forward()
        if held:
            yield forward()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, "part int, seq int, n_ids long, data binary"), "tokens")


def read_tokens(segments: DataFrame) -> DataFrame:
    """part, seq, doc_id, at (ids of the segment before it) and ids (array<int>) of each document."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                docs, sizes, ids = read_segment(batch.column(2)[k].as_py())
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                n = len(docs)
                for i in range(0, n, 512):
                    j = min(n, i + 512)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(batch.column(0)[k], j - i), pa.repeat(batch.column(1)[k], j - i), pa.array(docs[i:j], mask=docs[i:j] == NULL_DOC), pa.array(at[i:j]),
                         pa.ListArray.from_arrays(pa.array(at[i : j + 1] - at[i], pa.int32()), pa.array(ids[at[i] : at[j]].astype(np.int32)))], ["part", "seq", "doc_id", "at", "ids"])

    return segments.select("part", "seq", "data").mapInArrow(run, "part int, seq int, doc_id long, at long, ids array<int>")


def starts(segments: DataFrame) -> DataFrame:
    """part, seq and start (ids of all segments before it).

    Sums go by part first, so that what one task orders is a row for each part and then for each segment of a part.
    """
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("base"))
    within = segments.select("part", "seq", F.expr("coalesce(sum(n_ids) OVER (PARTITION BY part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("inside"))
    return within.join(before, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("start"))


def read_digests(segments: DataFrame) -> DataFrame:
    """part, seq, doc_id, at, n_tokens and ids_crc32 of each document, as read from its segment; ids stay in the worker."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                docs, sizes, ids = read_segment(batch.column(2)[k].as_py())
                at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column(0)[k], n), pa.repeat(batch.column(1)[k], n), pa.array(docs, mask=docs == NULL_DOC), pa.array(at[:-1]), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    return segments.select("part", "seq", "data").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")


def op6_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return read_digests(segments).join(starts(segments), ["part", "seq"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
