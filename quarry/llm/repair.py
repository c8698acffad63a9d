"""Re-Pair grammar compression of id sequences, and their decoding.

Each round turns the most frequent adjacent pairs (in a run of one pair every other is counted) into new
symbols and replaces them from left to right, until no pair is used ``least`` times.  A pair never spans two
documents.

A shard is ``bytes``: header (8 unsigned 32-bit numbers: magic, version, base, rules, symbols, anchors, symbol
bytes, anchor step), the rules' left and right symbols, the rules' expansion lengths (unsigned 32-bit), the
anchors (unsigned 64-bit: ids before every ``step``-th symbol), the symbols.  Symbol ``base + r`` is rule r;
anchors and expansion lengths find the symbols of any id range without expanding what stands before.
"""

from __future__ import annotations

import numpy as np

MAGIC, VERSION = 0x52505131, 1
PER_ROUND = 4096
#: Least uses of a pair (a rule takes 8 bytes, each use saves 2).
LEAST = 8
STEP = 1024
_HASH_BITS = 18
_HEAD = 8
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def compress(ids: np.ndarray, doc_ends: np.ndarray, per_round: int = PER_ROUND, least: int = LEAST) -> bytes:
    """A shard of the ids; doc_ends are the positions after each document's last id.

    Uses are counted over the whole shard once.  A round then takes away the pairs at and beside the places it
    replaces, and counts those that its new symbols form: pairs of older symbols never gain uses."""
    base = int(ids.max(initial=0)) + 1
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[doc_ends[doc_ends > 0] - 1] = True
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    size = base
    keys, uses = _often(_keys(symbols, last, np.arange(len(symbols) - 1)), least)
    while len(symbols) > 1:                 # each round replaces a pair at least
        own_keys, own_uses = _doubles(symbols, last, least)
        all_keys, all_uses = np.concatenate([keys, own_keys]), np.concatenate([uses, own_uses])
        if not len(all_keys):
            break
        chosen = all_keys[np.lexsort((all_keys, -all_uses))[:per_round]]
        a, b = (chosen >> _HALF).astype(np.uint32), (chosen & _LOW).astype(np.uint32)
        slot = _slot(a, b)
        table = np.full(1 << _HASH_BITS, -1, np.int32)
        table[slot[::-1]] = np.arange(len(chosen), dtype=np.int32)[::-1]     # of two in one slot the more frequent stays
        kept = np.flatnonzero(table[slot] == np.arange(len(chosen)))
        a, b = a[kept], b[kept]
        table[:] = -1
        table[slot[kept]] = np.arange(len(kept), dtype=np.int32)
        begins = np.zeros(size, bool)
        begins[a] = True
        at = np.flatnonzero(begins[symbols[:-1]] & ~last[:-1])
        rule = table[_slot(symbols[at], symbols[at + 1])]
        there = (rule >= 0) & (a[rule] == symbols[at]) & (b[rule] == symbols[at + 1])
        at, rule = at[there], rule[there]
        every = _every_other(np.append(True, np.diff(at) > 1))               # in a run of overlapping pairs every other one
        at, rule = at[every], rule[every]
        keys, uses = _less(keys, uses, _keys(symbols, last, _beside(at, len(symbols) - 1, (-1, 0, 1))), least)
        symbols[at] = rule.astype(np.uint32) + np.uint32(size)
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
        more, more_uses = _often(_keys(symbols, last, _beside(at - np.arange(len(at)), len(symbols) - 1, (-1, 0))), least)
        keys, uses = np.concatenate([keys, more]), np.concatenate([uses, more_uses])
        order = np.argsort(keys)
        keys, uses = keys[order], uses[order]
        left.append(a)
        right.append(b)
        size += len(a)
    lefts = np.concatenate(left) if left else np.zeros(0, np.uint32)
    rights = np.concatenate(right) if right else np.zeros(0, np.uint32)
    lengths = np.ones(size, np.int64)
    done = base
    for a in left:                          # a round's rules use symbols of earlier rounds alone
        n = len(a)
        lengths[done:done + n] = lengths[lefts[done - base:done - base + n]] + lengths[rights[done - base:done - base + n]]
        done += n
    before = np.cumsum(lengths[symbols]) - lengths[symbols]
    width = 2 if size <= 1 << 16 else 4
    kind = f"<u{width}"
    head = np.array([MAGIC, VERSION, base, len(lefts), len(symbols), len(before[::STEP]), width, STEP], "<u4")
    return b"".join([head.tobytes(), lefts.astype(kind).tobytes(), rights.astype(kind).tobytes(), lengths[base:].astype("<u4").tobytes(),
                     before[::STEP].astype("<u8").tobytes(), symbols.astype(kind).tobytes()])


def _every_other(head: np.ndarray) -> np.ndarray:
    """The first, third, ... of each run; head marks where runs begin."""
    place = np.arange(len(head))
    return (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0


def _beside(at: np.ndarray, n: int, steps: tuple[int, ...]) -> np.ndarray:
    """The places at the given distances from ascending ones, each once, inside 0 to n."""
    out = np.zeros(n + 2, bool)
    for s in steps:
        out[np.clip(at + s, -1, n) + 1] = True
    return np.flatnonzero(out[1:-1])


def _keys(symbols: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pairs at these places, ascending; without those that span two documents or repeat a symbol."""
    a, b = symbols[at], symbols[at + 1]
    own = ~last[at] & (a != b)
    return np.sort(a[own].astype(np.uint64) << _HALF | b[own])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each of some ascending keys, and how often it stands there."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _often(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    keys, uses = _counted(keys)
    often = uses >= least
    return keys[often], uses[often]


def _less(keys: np.ndarray, uses: np.ndarray, gone: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The table without the uses that are gone, and without the pairs that are then too rare."""
    pair, n = _counted(gone)
    if len(keys) and len(pair):
        place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        own = keys[place] == pair
        uses = uses.copy()
        uses[place[own]] -= n[own]
    often = uses >= least
    return keys[often], uses[often]


def _doubles(symbols: np.ndarray, last: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one symbol with itself; in a run of them every other place is a use."""
    at = np.flatnonzero((symbols[1:] == symbols[:-1]) & ~last[:-1])
    at = at[_every_other(np.append(True, np.diff(at) > 1))] if len(at) else at
    a = symbols[at].astype(np.uint64)
    return _often(np.sort(a << _HALF | a), least)


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - _HASH_BITS)


class Shard:
    """Reads a shard: all ids, or any range of them."""

    def __init__(self, raw: bytes):
        head = np.frombuffer(raw, "<u4", _HEAD)
        if head[0] != MAGIC or head[1] != VERSION:
            raise ValueError("this is no shard of this format")
        self.base, rules, count, anchors, width, self.step = (int(x) for x in head[2:])
        at, kind = 4 * _HEAD, f"<u{width}"
        self.left = np.frombuffer(raw, kind, rules, at).astype(np.int64)
        self.right = np.frombuffer(raw, kind, rules, at + rules * width).astype(np.int64)
        at += 2 * rules * width
        self.lengths = np.append(np.ones(self.base, np.int64), np.frombuffer(raw, "<u4", rules, at).astype(np.int64))
        at += 4 * rules
        self.anchors = np.frombuffer(raw, "<u8", anchors, at).astype(np.int64)
        self.symbols = np.frombuffer(raw, kind, count, at + 8 * anchors)
        # All expansions in one array, shorter ones first, so that each is two copies of finished ones.
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.flat = np.zeros(int(self.lengths.sum()), np.uint32)
        self.flat[:self.base] = np.arange(self.base)
        for r, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True)):
            to, na, nb = self.begin[self.base + r], self.lengths[a], self.lengths[b]
            self.flat[to:to + na] = self.flat[self.begin[a]:self.begin[a] + na]
            self.flat[to + na:to + na + nb] = self.flat[self.begin[b]:self.begin[b] + nb]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begin[symbols] - (ends - n), n) + np.arange(total)]

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def read(self, start: int, count: int) -> np.ndarray:
        """The ids start to start + count, by way of the nearest anchor before them."""
        if count <= 0 or not len(self.symbols):
            return np.zeros(0, np.uint32)
        first = max(0, int(np.searchsorted(self.anchors, start, side="right")) - 1)
        last = int(np.searchsorted(self.anchors, start + count, side="left"))
        ids = self._expand(self.symbols[first * self.step:last * self.step])
        skip = start - int(self.anchors[first])
        return ids[skip:skip + count]
