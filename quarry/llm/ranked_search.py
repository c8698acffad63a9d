"""Ranked lexical search: impact lists in document shards, read by the Best Position Algorithm.

``impact_index`` reads the texts twice: once for the number of documents and terms, once to write, per shard of
documents, a list for each term: its documents by falling impact.  ``top_documents`` joins the queries' terms
with those lists, hands each shard's lists to one task, and runs the algorithm there for every query: sorted
access goes down all lists of the query together, and each new document is looked up at once in the others
(direct access).  Both mark places of the lists as seen.  A list's best position is the end of its seen stretch from the top:
no unseen document can have a greater impact in it than the one at that position.  The sum of these impacts bounds
all unseen documents; reading stops when the k-th score found is strictly above it, so equal scores are all met.  The
shards' answers are then ranked together.  A shard holds at most ``SHARD_DOCS`` documents, so memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.llm.words import Words, slices, text_bytes, tidy

#: Documents in a shard at most (places in a list fit 16 bits), and bytes of text at which a shard is closed.
SHARD_DOCS, SHARD_BYTES = 1 << 14, 1 << 25
#: Terms of queries searched at once, about, as queries are dealt to blocks by a hash (16 bytes each are broadcast).
BLOCK_TERMS = 100_000
#: Lists of a shard whose direct-access tables are kept.
KEPT_TABLES = 2048
FIRST_STEP = 32
TOP = 20

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False


def terms_of(col: pa.Array) -> Words:
    """Maximal runs of ASCII letters, digits and all other characters beyond ASCII, A-Z lower-cased."""
    return Words(col, lower=True, is_gap=_GAP)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = total = 0
    for batch in batches:
        for part in slices(batch):
            data, bounds = text_bytes(part.column("text"))
            gap = np.ones(len(data) + 1, bool)
            gap[1:] = _GAP[data]
            first = ~gap[1:] & gap[:-1]
            inner = bounds[1:-1]
            inner = np.unique(inner[inner < len(data)])
            first[inner] |= ~gap[inner + 1]
            n = np.diff(np.append(0, np.cumsum(first))[bounds])
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([total], pa.int64())], names=["docs", "terms"])


def impact(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a weight of 1 earns a document of n terms that holds a term tf times."""
    m = 100 - 25 + (25 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _shards(docs: int, terms: int, kind: pa.DataType):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 24
        ids: list[pa.Array] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = rows = 0

        def close() -> Iterator[pa.RecordBatch]:
            own = pa.concat_arrays(ids)
            order = pa.compute.sort_indices(own, null_placement="at_start").to_numpy()
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)         # documents are numbered by id, so ties go by number
            term = np.concatenate([t for t, _, _ in held])
            doc = place[np.concatenate([d for _, d, _ in held])]
            worth = np.concatenate([w for _, _, w in held])
            by = np.lexsort((doc, -worth, term))
            term, doc, worth = term[by], doc[by], worth[by]
            cut = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            yield row(pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int32())), own.take(pa.array(order)))
            for lo in range(0, len(cut), 20_000):
                some = cut[lo:lo + 20_000]
                end = int(cut[lo + 20_000]) if lo + 20_000 < len(cut) else len(term)
                start = int(some[0])
                offsets = pa.array(np.append(some, end).astype(np.int32) - np.int32(start))
                yield row(pa.array(term[some].view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(doc[start:end])),
                          pa.ListArray.from_arrays(offsets, pa.array(worth[start:end])), None)

        def row(term: pa.Array, docs: pa.Array, impacts: pa.Array, own: pa.Array | None) -> pa.RecordBatch:
            n = len(term)
            listed = pa.nulls(n, pa.list_(kind)) if own is None else pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            held_by = pa.compute.list_value_length(docs).cast(pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int64()), term, held_by, docs, impacts, listed], names=["shard", "term", "df", "docs", "impacts", "ids"])

        for batch in batches:
            for part in slices(batch):
                at = 0
                while at < len(part):
                    some = part.slice(at, SHARD_DOCS - rows)
                    words = terms_of(some.column("text"))
                    doc, n = words.doc(), words.n_words()
                    by = np.lexsort((words.hash, doc))
                    t, d = words.hash[by], doc[by]
                    first = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (d[1:] != d[:-1]))) if len(t) else np.zeros(0, np.int64)
                    tf = np.diff(np.append(first, len(t)))
                    d = d[first]
                    held.append((t[first], (d + rows).astype(np.int32), impact(tf, n[d], docs, terms).astype(np.int32)))
                    ids.append(some.column("id"))
                    size, rows, at = size + len(words.data), rows + len(some), at + len(some)
                    if rows >= SHARD_DOCS or size >= SHARD_BYTES:
                        yield from close()
                        shard, size, rows = shard + 1, 0, 0
                        ids.clear()
                        held.clear()
        if rows:
            yield from close()
    return run


def impact_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The written index and the number of documents with a term.  Rows: ``(shard, term, df, docs, impacts)``, a list for
    each term (64-bit hash) and shard, documents by falling impact, and their number; and ``(shard, ids)``, the shard's document ids
    in the order of their numbers."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sums = base.select("text").mapInArrow(tidy(_count), "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).collect()[0]
    n, total = sums[0] or 0, sums[1] or 0
    kind = base.schema["id"].dataType.simpleString()
    arrow = pa.schema(docs.sparkSession.createDataFrame([], base.select("id").schema).toArrow().schema).field("id").type
    index = base.mapInArrow(_shards(n, max(total, 1), arrow), f"shard long, term long, df long, docs array<int>, impacts array<int>, ids array<{kind}>")
    return written(index, "index"), n


@tidy
def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words = terms_of(part.column("text"))
            key = part.column("query").take(pa.array(words.doc()))
            yield pa.RecordBatch.from_arrays([key, pa.array(words.hash.view(np.int64))], names=["query", "term"])


class Shard:
    """One shard's lists, one after the other: documents, impacts, and where each list starts."""

    def __init__(self, terms: np.ndarray, docs: list[np.ndarray], impacts: list[np.ndarray]):
        self.at = {int(t): i for i, t in enumerate(terms)}
        self.start = np.append(0, np.cumsum([len(d) for d in docs])).astype(np.int64)
        self.docs = np.concatenate(docs) if docs else np.zeros(0, np.int32)
        self.impacts = np.concatenate(impacts).astype(np.int64) if docs else np.zeros(0, np.int64)
        self.size = int(self.docs.max()) + 1 if len(self.docs) else 0
        self.tables: dict[int, np.ndarray] = {}

    def table(self, i: int) -> np.ndarray:
        """For direct access: each document's place in list i, from 1 (0: not in it)."""
        got = self.tables.get(i)
        if got is None:
            got = np.zeros(self.size, np.uint16)
            own = self.docs[self.start[i]:self.start[i + 1]]
            got[own] = np.arange(1, len(own) + 1, dtype=np.uint16)
            if len(self.tables) >= KEPT_TABLES:
                self.tables.pop(next(iter(self.tables)))
            self.tables[i] = got
        return got


def best_positions(shard: Shard, terms: list[int], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents of a shard (score above 0; equal scores by number), their scores, and the places read.

    ``weights`` are positive.  Sorted access takes ever longer steps; after each, best positions are moved on over all
    places that sorted and direct access have seen."""
    own = [(shard.at[t], w) for t, w in zip(terms, weights, strict=True) if t in shard.at]
    none = np.zeros(0, np.int64)
    if not own:
        return none, none, 0
    lists = [i for i, _ in own]
    start = [int(shard.start[i]) for i in lists]
    length = [int(shard.start[i + 1]) - s for i, s in zip(lists, start, strict=True)]
    seen = [np.zeros(n + 1, bool) for n in length]               # the place after the end is never seen
    best = [0] * len(own)
    met = np.zeros(shard.size, bool)
    found, scores = [], []
    depth, step, floor = 0, FIRST_STEP, 0
    while depth < max(length):
        new = np.concatenate([shard.docs[s + depth:s + min(n, depth + step)] for s, n in zip(start, length, strict=True) if depth < n])
        new = np.unique(new[~met[new]])
        met[new] = True
        depth, step = depth + step, 2 * step
        score = np.zeros(len(new), np.int64)
        for j, (i, w) in enumerate(own):
            place = shard.table(i)[new].astype(np.int64)
            there = place > 0
            place = place[there] - 1
            score[there] += w * shard.impacts[start[j] + place]
            seen[j][place] = True
        found.append(new)
        scores.append(score)
        bound = 0
        for j, (_, w) in enumerate(own):
            best[j] += int(seen[j][best[j]:].argmin())
            if best[j] < length[j]:
                bound += w * int(shard.impacts[start[j] + best[j] - 1])
        have = np.concatenate(scores)
        if len(have) >= k:
            floor = int(np.partition(have, len(have) - k)[len(have) - k])
            if bound < floor:
                break
    doc, score = np.concatenate(found).astype(np.int64), np.concatenate(scores)
    order = np.lexsort((doc, -score))[:k]
    order = order[score[order] > 0]
    return doc[order], score[order], min(depth, max(length))


def _search(held, k: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value
        now, terms, docs, impacts = None, [], [], []

        def answers() -> pa.RecordBatch:
            lists = Shard(np.array(terms, np.int64), docs, impacts)
            out: list[tuple] = []
            for query, (own, weights) in queries.items():
                doc, score, _ = best_positions(lists, own, weights, k)
                out += zip([query] * len(doc), [now] * len(doc), doc.tolist(), score.tolist(), strict=True)
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int64()], strict=True)],
                                              names=["query", "shard", "doc", "score"])

        for batch in batches:
            shards = batch.column("shard").to_pylist()
            names = batch.column("term").to_pylist()
            for i, (s, t) in enumerate(zip(shards, names, strict=True)):
                if s != now:
                    if now is not None:
                        yield answers()
                    now, terms, docs, impacts = s, [], [], []
                terms.append(t)
                docs.append(batch.column("docs")[i].values.to_numpy())
                impacts.append(batch.column("impacts")[i].values.to_numpy())
        if now is not None:
            yield answers()
    return run


def top_documents(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  query_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """For each row of ``queries`` its k best documents: query id, ``rank`` (from 1, unique), document id, ``score``.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))); a document's score sums weight x impact over the query's
    terms, repeats included.  Only scores above 0 count; equal scores go by ascending id (null first), then by place
    in the index.  Null and empty texts have no terms: such documents are never found, such queries find nothing.
    Repeated rows are documents, or queries, of their own; other columns are not read.  An empty table gives no rows.
    Texts of any length are read whole."""
    spark = docs.sparkSession
    index, n = impact_index(docs, id_col, text_col)
    asked = written(queries.select(F.col(query_col).alias("qid"), F.col(query_text_col).alias("text"))
                    .withColumn("query", F.monotonically_increasing_id()), "queries")
    words = written(asked.select("query", "text").mapInArrow(_query_terms, "query long, term long").groupBy("query", "term").agg(F.count("*").alias("uses")), "terms")
    lists = index.where("term IS NOT NULL").select("shard", "term", "docs", "impacts")
    df = index.where("term IS NOT NULL").select("term", "df").join(words.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    weighed = written(words.join(df.select("term", weight.alias("w")).where("w > 0"), "term").select("query", "term", (F.col("w") * F.col("uses")).alias("w")), "weights")
    blocks = max(1, -(-weighed.count() // BLOCK_TERMS))
    found = None
    for b in range(blocks):
        rows = weighed.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).orderBy("query", "term").toArrow()
        held: dict[int, tuple[list, list]] = {}
        for q, t, w in zip(*[rows.column(c).to_pylist() for c in ("query", "term", "w")], strict=True):
            own = held.setdefault(q, ([], []))
            own[0].append(t)
            own[1].append(w)
        few = spark.createDataFrame(pa.table({"term": pa.array(sorted({t for own, _ in held.values() for t in own}), pa.int64())}))
        met = (lists.join(few, "term", "left_semi").repartition("shard").sortWithinPartitions("shard")
               .mapInArrow(_search(spark.sparkContext.broadcast(held), k), "query long, shard long, doc int, score long"))
        found = met if found is None else found.unionAll(met)
    ids = index.where("term IS NULL").select("shard", F.posexplode("ids").alias("doc", id_col))
    first = Window.partitionBy("query").orderBy(F.desc("score"), F.col(id_col).asc_nulls_first(), "shard", "doc")
    ranked = found.join(ids, ["shard", "doc"]).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", F.col("qid").alias(query_col)), "query").select(query_col, F.col("rank").cast("int").alias("rank"), id_col, "score")
