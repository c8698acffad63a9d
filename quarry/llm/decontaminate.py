"""Benchmark decontamination: SimHash fingerprints of item-sized windows, multi-index Hamming lookup, and an
exact weighted-shingle check.

A benchmark item of n words is compared with document windows of n words (a shorter document is one window).
Windows that hold none of the item's shingles have similarity 0 and get no fingerprint.  The fingerprint of
the others is the majority, bit by bit, of their shingles' 64-bit hashes, each shingle counted as often as it
occurs.  Items of one length are indexed by the 8 bytes of their fingerprint: two fingerprints within
RADIUS = 23 bits agree in some byte up to floor(23 / 8) = 2 bits, so looking up every byte with its
neighbours within 2 bits finds all items within the radius (shingle sets of similarity 0.8 are some 10 bits
apart, 23 is 4.6 standard deviations more).  Weighted Jaccard similarity of the shingle counts then decides.

At this radius a byte's postings hold 37 of 256 items of chance fingerprints, so two exact bounds narrow the lookup.
An item of similarity s shares s / (1 + s) of both totals with its window: a window with fewer shingles that stand in
any item of its length needs no fingerprint, and of any shingles of the window that are more than it may lack, the
item holds one; the postings are cut to the items that hold one of each of up to three such groups.  Windows and
postings are worked on in slices, so memory grows neither with the text nor with the items it meets.

The benchmark is broadcast in blocks of at most BLOCK_BYTES of text, one scan of the documents each, so that
no broadcast grows with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.words import Words, mix, slices, tidy, window_sums

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_BYTES = 4 << 20
#: First words of a text whose windows get fingerprints at a time, and (print, item) places looked at at a time.
SPAN, LOOKUP = 1 << 14, 1 << 20

#: Bytes between words once A-Z are lower-cased: all of ASCII but digits and letters.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:0x80] = True
NOT_WORD[0x30:0x3A] = NOT_WORD[0x61:0x7B] = False

_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash bytes (rows of 8) of the runs hashes[start : start + size]."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    return np.packbits(2 * (total[starts + size] - total[starts]) > size, axis=1)


class _Index:
    """Items of one word count: their shingle counts, fingerprints and postings by byte."""

    def __init__(self, items: list[tuple[int, np.ndarray]], radius: int):
        self.item = np.array([i for i, _ in items])
        self.shingles = [np.unique(h, return_counts=True) for _, h in items]
        self.total = len(items[0][1])
        self.prints = np.concatenate([fingerprints(h, np.zeros(1, np.int64), len(h)) for _, h in items])
        self.words = self.prints.view(np.uint64).ravel()
        near = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= radius // 8
        #: Byte number, byte value: the items within radius // 8 bits of it there, a bit an item.
        self.postings = np.stack([np.packbits(near[:, self.prints[:, b]], axis=1) for b in range(8)])

        keys = np.concatenate([h for h, _ in self.shingles])
        order = np.argsort(keys, kind="stable")
        #: The items' shingles, ascending, and the items that hold each (bounds, items).
        self.keys, first = np.unique(keys[order], return_index=True)
        self.holds = np.append(first, len(keys)), np.repeat(np.arange(len(items)), [len(h) for h, _ in self.shingles])[order]

    def holders(self, hashes: np.ndarray) -> np.ndarray:
        """For each shingle the items that hold it, a bit an item."""
        slot = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        bounds, items = self.holds
        many = np.where(self.keys[slot] == hashes, np.diff(bounds)[slot], 0)
        row = np.repeat(np.arange(len(hashes)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        held = np.zeros((len(hashes), len(self.item)), bool)
        held[row, items[bounds[slot[row]] + nth]] = True
        return np.packbits(held, axis=1)

    def lookup(self, prints: np.ndarray, radius: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, by window; ``among``: for each window the items to look for, a bit an item."""
        words = np.ascontiguousarray(prints).view(np.uint64).ravel()
        step = max(1, 8 * LOOKUP // len(self.item))
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo in range(0, len(words), step):
            part = prints[lo:lo + step]
            found = self.postings[0][part[:, 0]]
            for b in range(1, 8):
                found |= self.postings[b][part[:, b]]
            if among is not None:
                found &= among[lo:lo + step]
            row, byte = np.nonzero(found)
            at, bit = np.nonzero(np.unpackbits(found[row, byte][:, None], axis=1))
            w, i = lo + row[at], 8 * byte[at] + bit
            ok = np.bitwise_count(words[w] ^ self.words[i]) <= radius
            pairs.append((w[ok], i[ok]))
        w, i = zip(*pairs, strict=True)
        return np.concatenate(w), np.concatenate(i)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][ia], b[1][ib]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


class Matcher:
    """One block of the benchmark, ready to be held against texts."""

    def __init__(self, items: list[tuple[object, str | None]], k: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS):
        self.k, self.similarity, self.radius = k, similarity, radius
        self.ids = [i for i, _ in items]
        words = Words(pa.array([t for _, t in items], pa.large_string()), lower=True, is_gap=NOT_WORD)
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        seen = {}
        for i, n in enumerate(words.n_words().tolist()):
            if n:
                h = self._shingles(words.hash[words.row[i]:words.row[i + 1]], min(n, k))
                by_size.setdefault(n, []).append((i, h))
                for x in h.tolist():
                    seen.setdefault((min(n, k), x), set()).add(n)
        self.index = {n: _Index(x, radius) for n, x in by_size.items()}
        #: By shingle length: its hashes, ascending, and the item sizes in which each occurs (bounds, sizes).
        self.hits = {}
        for size in {s for s, _ in seen}:
            keys = sorted(x for s, x in seen if s == size)
            sizes = [sorted(seen[size, x]) for x in keys]
            self.hits[size] = (np.array(keys, np.uint64), (np.cumsum([0, *map(len, sizes)]), np.concatenate(sizes)))

    @staticmethod
    def _shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
        at = np.arange(len(word_hashes) - k + 1)
        return mix(window_sums(word_hashes, at, at + k))

    def _places(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, item size, first words): where a text holds shingles of items of that size."""
        docs, counts, places = [], [], []
        for size, (keys, sizes) in self.hits.items():
            at, h = words.windows(size)
            if not len(at):
                continue
            slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[slot] == h)
            slot, at = slot[hit], at[hit]
            doc = np.searchsorted(words.row, at, side="right") - 1
            many = np.diff(sizes[0])[slot]
            nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            docs.append(np.repeat(doc, many))
            counts.append(sizes[1][np.repeat(sizes[0][slot], many) + nth])
            places.append(np.repeat(at, many))
        if not docs:
            return
        doc, n, place = np.concatenate(docs), np.concatenate(counts), np.concatenate(places)
        order = np.lexsort((place, n, doc))
        doc, n, place = doc[order], n[order], place[order]
        cut = np.flatnonzero((np.diff(doc) != 0) | (np.diff(n) != 0)) + 1
        for part in np.split(np.arange(len(doc)), cut):
            if len(part):
                yield int(doc[part[0]]), int(n[part[0]]), place[part]

    def _compare(self, words: Words, starts: np.ndarray, m: int, lack: int, index: _Index, d: int, best: dict) -> None:
        """Windows of m words from ``starts`` (ascending) against the items, which may lack up to ``lack`` of a window's
        shingles; ``best`` keeps the best of each text and item."""
        at0, lo = int(starts[0]), int(words.row[d])
        h = self._shingles(words.hash[at0:int(starts[-1]) + m], min(self.k, m))
        size = m - min(self.k, m) + 1
        prints = fingerprints(h, starts - at0, size)
        grid = size // (lack + 1)                                # every window has lack + 1 shingles at places that this divides
        among = None
        for offset in sorted({0, grid // 3, 2 * grid // 3}):     # and as many at these, each of them with one that the item holds
            holders = index.holders(h[offset::grid])
            first = -(-(starts - at0 - offset) // grid)
            some = holders[first]
            for j in range(1, lack + 1):
                some |= holders[first + j]
            among = some if among is None else among & some
        held, counts = -1, None
        for w, i in zip(*(x.tolist() for x in index.lookup(prints, self.radius, among)), strict=True):
            s = int(starts[w])
            if s != held:
                held, counts = s, np.unique(h[s - at0:s - at0 + size], return_counts=True)
            score = weighted_jaccard(counts, index.shingles[i])
            if score < self.similarity:
                continue
            item = int(index.item[i])
            now = (score, lo - s, m, int(_BITS[prints[w] ^ index.prints[i]].sum()))
            best[d, item] = max(best.get((d, item), now), now)

    def search(self, col: pa.Array) -> list[tuple[int, int, int, int, int, float]]:
        """(text, item, first word, words, bits apart, similarity): the best window of each text and item."""
        words = Words(col, lower=True, is_gap=NOT_WORD)
        best: dict[tuple[int, int], tuple] = {}
        for d, n, places in self._places(words):
            lo, hi = int(words.row[d]), int(words.row[d + 1])
            m, k, index = min(n, hi - lo), min(self.k, n), self.index[n]
            if m < k:
                continue
            size = m - k + 1
            held = np.zeros(hi - lo - k + 2, np.int64)           # how many of the first shingles stand in some item
            held[places - lo + 1] = 1
            held = np.cumsum(held)
            least = math.ceil(self.similarity * (size + index.total) / (1 + self.similarity) - 1e-9)
            starts = lo + np.flatnonzero(held[size:] - held[:-size] >= least)
            at = 0
            while at < len(starts):
                to = int(np.searchsorted(starts, starts[at] + max(1, min(SPAN, 16 * LOOKUP // len(index.item)))))
                self._compare(words, starts[at:to], m, size - least, index, d, best)
                at = to
        return [(d, i, -s, m, far, score) for (d, i), (score, s, m, far) in sorted(best.items())]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items with text, in blocks of about BLOCK_BYTES."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / BLOCK_BYTES)
    for b in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b)
        yield [(r["item"], r["text"]) for r in block.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: ids, first word, words and fingerprint distance of
    the best window, and its similarity (at least ``similarity``).

    Words are runs of letters and digits, A-Z lower-cased, so case and punctuation do not matter.  Items of
    fewer than ``k`` words are one shingle and match only as a whole; null or wordless texts and items match
    nothing.  Equally good windows: the first.  Repeated documents each have their rows; repeated items one."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    item_arrow = to_arrow_type(benchmark.schema[item_col].dataType)
    schema = f"id {kind}, item {item_type}, first_word long, words int, distance int, similarity double"
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text):
        held = spark.sparkContext.broadcast((items, k, similarity, radius))

        @tidy
        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            match = Matcher(*held.value)
            for batch in batches:
                for part in slices(batch):
                    got = match.search(part.column("text"))
                    if got:
                        d, i, first, m, far, score = zip(*got, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").take(pa.array(d)), pa.array([match.ids[x] for x in i], item_arrow), pa.array(first, pa.int64()),
                             pa.array(m, pa.int32()), pa.array(far, pa.int32()), pa.array(score)],
                            names=["id", "item", "first_word", "words", "distance", "similarity"])

        out = out.union(base.mapInArrow(run, schema))
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all columns, in which ``find_leaks`` finds nothing; the rows are not moved."""
    for items in _blocks(benchmark, item_col, item_text):
        held = docs.sparkSession.sparkContext.broadcast((items, k, similarity, radius))

        @tidy
        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            match = Matcher(*held.value)
            for batch in batches:
                for part in slices(batch, text_col):
                    keep = np.ones(len(part), bool)
                    keep[[x[0] for x in match.search(part.column(text_col))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
