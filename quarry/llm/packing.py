"""Order-preserving packing of token ids into sequences by dynamic programming.

Documents are laid end to end in id order.  Sequences are runs of at most SIZE ids, cut where that costs least:
padding up to SIZE (none for a power of two from LEAST_POWER on) plus a penalty for a cut inside a document
(at a sentence end, or, where a sentence is long, every GRID ids inside it).  With places p and costs f,

    f(j) = penalty(j) + PER_SEQUENCE + min over i with p(j) - p(i) <= SIZE of f(i) + SIZE - (p(j) - p(i))

so the least f(i) + p(i) of a sliding window decides, which a monotone queue gives in constant time per place;
the runs that need no padding are looked up besides.  A task packs its range of ids batch by batch and carries
a batch's last sequence into the next, so memory is bounded and only the task's last one is short.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_order
from quarry.llm.tokens import WordTokenizer
from quarry.llm.words import slices, tidy

SIZE = 4096
END = 2
#: Costs in padded ids: of a cut at a sentence end, of a cut inside a sentence, of each sequence.
SENTENCE_CUT = 8
INNER_CUT = 48
PER_SEQUENCE = 16
LEAST_POWER = 256
GRID = 256
#: Ids packed at once, about.
PACK_IDS = 1 << 18
#: Text bytes encoded at once, and words whose ids a task keeps.
ENCODE_BYTES = 2 << 20
KEPT_WORDS = 150_000
#: Words that end a sentence, as the vocabulary writes them at a word's end.
SENTENCE_ENDS = (".", "!", "?", "...", "。")


def cut_places(docs: np.ndarray, sentences: np.ndarray, total: int, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sequence may end, from 0 to total, and their penalties.

    docs: places after a document's last id; sentences: places after a sentence's last id."""
    at = np.union1d(docs, np.union1d(sentences, [0, total])).astype(np.int64)
    gap = np.diff(at)
    extra = [np.arange(a + grid, a + g, grid) for a, g in zip(at[:-1][gap > grid].tolist(), gap[gap > grid].tolist(), strict=True)]
    places = np.union1d(at, np.concatenate(extra)).astype(np.int64) if extra else at
    penalty = np.full(len(places), INNER_CUT, np.int64)
    penalty[np.searchsorted(places, at)] = SENTENCE_CUT
    penalty[np.searchsorted(places, docs)] = 0
    penalty[0] = 0
    penalty[-1] = 0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """Ends of the sequences of least total cost (earlier starts win ties)."""
    p, pen = places.tolist(), penalty.tolist()
    powers = [1 << k for k in range(LEAST_POWER.bit_length() - 1, 63) if 1 << k < size]
    place_at = dict(zip(p, range(len(p)), strict=True))
    cost, back = [0] * len(p), [0] * len(p)
    queue: deque[tuple[int, int]] = deque([(0, 0)])          # (f + place, index), ascending in both
    get = place_at.get
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0][1]] < here - size:
            queue.popleft()
        least, i = queue[0]
        least += size - here
        for run in powers:
            k = get(here - run)
            if k is not None and cost[k] < least:
                least, i = cost[k], k
        f = least + PER_SEQUENCE + pen[j]
        cost[j], back[j] = f, i
        key = f + here
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(p) - 1
    while j > 0:
        out.append(p[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Packs batch after batch of encoded documents; the last sequence of a batch is held for the next."""

    def __init__(self, enders: np.ndarray, sequence: int, size: int = SIZE):
        self.enders, self.sequence, self.size = enders, sequence, size
        self.ids = np.zeros(0, np.uint32)                       # held ids, their documents and places in them
        self.doc = self.place = np.zeros(0, np.int64)
        self.names: pa.Array | None = None                      # the held documents and their numbers of ids
        self.counts = np.zeros(0, np.int64)

    def add(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch | None:
        old = len(self.counts)
        self.names = names if self.names is None else pa.concat_arrays([self.names, names])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.doc = np.concatenate([self.doc, np.repeat(np.arange(old, old + len(counts)), counts)])
        self.place = np.concatenate([self.place, np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)])
        return self.pack(False)

    def pack(self, last: bool) -> pa.RecordBatch | None:
        if not len(self.ids):
            return None
        ids, doc = self.ids, self.doc
        doc_ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1
        sentences = np.flatnonzero(self.enders[np.minimum(ids, len(self.enders) - 1)]) + 1
        cuts = best_cuts(*cut_places(doc_ends, sentences, len(ids)), self.size)
        if not last:
            cuts = cuts[:-1]
        if not cuts:
            return None
        stop, cuts = cuts[-1], np.array(cuts, np.int64)
        starts = np.unique(np.concatenate([[0], cuts[:-1], doc_ends[doc_ends < stop]])).astype(np.int64)
        ends = np.append(starts[1:], stop)
        seq = np.searchsorted(cuts, starts, side="right")
        view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        own = doc[starts]
        out = pa.RecordBatch.from_arrays(
            [self.names.take(pa.array(own)), pa.array(self.place[starts]), pa.array(ends - starts), pa.array(crc, pa.int64()),
             pa.array(self.counts[own]), pa.array(self.sequence + seq), pa.array(starts - np.append(0, cuts)[seq])],
            names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(cuts)
        self.ids, self.doc, self.place = ids[stop:], doc[stop:], self.place[stop:]
        low = int(self.doc[0]) if len(self.doc) else len(self.counts)
        self.names, self.counts, self.doc = self.names.slice(low), self.counts[low:], self.doc - low
        return out


def sentence_enders(tokenizer: WordTokenizer) -> np.ndarray:
    """By id, whether the token ends a sentence."""
    vocabulary = tokenizer.library.get_vocab()
    out = np.zeros(max(vocabulary.values(), default=0) + 2, bool)
    out[[i for w, i in vocabulary.items() if w.removesuffix("</w>") in SENTENCE_ENDS]] = True
    return out


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end: int = END, size: int = SIZE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document's id, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit numbers), ``doc_tokens`` (with ``end``),
    ``sequence_id`` (ascending with the ids' order) and ``offset`` in the sequence.

    A null or empty text is ``end`` alone.  Equal ids stand in the order of their texts, null ids first, and an
    id with many rows spans tasks; repeated rows are documents of their own.  Documents of any length are packed whole."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary, KEPT_WORDS)
        packer = Packer(sentence_enders(tokenizer), TaskContext.get().partitionId() << 40, size)
        for batch in batches:
            for part in slices(batch, size=ENCODE_BYTES):
                flat, bounds = tokenizer.encode(part.column("text"))
                at = 0
                while at < len(part):                       # some PACK_IDS at once, a longer document alone
                    to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PACK_IDS, side="right")) - 1)
                    own = bounds[at:to + 1] - bounds[at]
                    out = packer.add(part.column("id").slice(at, to - at), np.insert(flat[bounds[at]:bounds[to]], own[1:], end), np.diff(own) + 1)
                    if out is not None:
                        yield out
                    at = to
        out = packer.pack(True)
        if out is not None:
            yield out

    return (in_order(base)
            .mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
            .withColumnRenamed("id", id_col))
