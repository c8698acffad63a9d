import random
import struct
import zlib

import numpy as np
from tokenizers import Tokenizer

from quarry.llm.common import in_order as in_tasks
from quarry.llm.packing import INNER_CUT, PER_SEQUENCE, SENTENCE_CUT, best_cuts, cut_places, pack_documents
from quarry.llm.repair import Shard, compress
from quarry.llm.token_files import read_token_files, token_files, write_token_files
from quarry.llm.tokens import word_vocabulary

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(word_vocabulary())
ODD = [(3, "It's  Hello,\tWORLD <|endoftext|>x é ́a 12 ﬁ"), (1, None), (2, ""), (2, "dup"), (2, "dup"), (None, "no id"), (9, "\x1c\x85a b"),
       (4, "long " * 30_000), (5, "i" * 9000), (6, "ΑΣ Σ Straße.")]


def encoded(text, end):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


def test_repair_round_trip_and_random_access():
    rnd = random.Random(1)
    for n, kinds in ((0, 5), (1, 5), (2, 1), (5000, 3), (200_000, 40)):
        ids = np.array([rnd.randrange(kinds) * 1000 for _ in range(n)], np.uint32)
        if n > 1000:
            ids[100:400] = 7                                    # a run of one id, and a passage that repeats
            ids[600:900] = ids[1000:1300]
        ends = np.array(sorted({*(rnd.randrange(n + 1) for _ in range(min(n, 20))), n}) if n else [], np.int64)
        raw = compress(ids, ends, least=4)
        shard = Shard(raw)
        assert (shard.ids() == ids).all()
        for _ in range(20):
            a = rnd.randrange(n + 1)
            c = rnd.randrange(0, n - a + 1)
            assert (shard.read(a, c) == ids[a:a + c]).all()
        if n > 100_000:
            assert len(shard.left) > 50 and len(shard.symbols) < 0.6 * n
            cut = set(np.cumsum(shard.lengths[shard.symbols]).tolist())
            assert set(ends.tolist()) - {0} <= cut             # no rule spans two documents


def test_repair_leaves_no_frequent_pair():
    """Pairs used a few dozen times in a long shard, at places equal modulo 16, and more of them than one round takes."""
    rnd = np.random.default_rng(3)
    ids = rnd.integers(0, 60_000, 1 << 18).astype(np.uint32)
    at = 16 * rnd.permutation(len(ids) // 16 - 1) + 5
    for k, place in enumerate(at[:8000].reshape(200, 40)):
        ids[place], ids[place + 1] = 100 + k, 300 + k
    for place in at[8000:8040]:
        ids[place:place + 9] = np.arange(70_000, 70_009)
    ends = np.array([100_000, len(ids)])
    shard = Shard(compress(ids, ends, per_round=50, least=32))
    assert (shard.ids() == ids).all()
    done = set(zip(shard.left.tolist(), shard.right.tolist(), strict=True))
    assert {(100 + k, 300 + k) for k in range(200)} <= done
    assert 9 in shard.lengths[shard.symbols]                    # the passage is one symbol
    keys, uses = np.unique(shard.symbols[:-1].astype(np.int64) << 32 | shard.symbols[1:], return_counts=True)
    assert uses.max() < 32


def test_odd_texts(spark):
    docs = spark.createDataFrame([(*r, 7) for r in ODD], "doc_id long, text string, start int").repartition(4)
    got = sorted(map(tuple, token_files(docs).collect()), key=lambda r: r[1])
    at, want = 0, []
    for doc, text in in_order(ODD):
        ids = encoded(text, 1)
        want.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want


def test_files_of_small_shards_and_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_token_files(docs, str(tmp_path / "a"), shard_ids=5000)
    got = read_token_files(spark, str(tmp_path / "a"), with_ids=True).orderBy("start").collect()
    at = 0
    for row, (doc, text) in zip(got, in_order([(r["doc_id"], r["text"]) for r in docs.collect()]), strict=True):
        ids = encoded(text, 1)
        assert (row["doc_id"], row["start"], row["n_tokens"], row["token_ids"], row["ids_crc32"]) == (doc, at, len(ids), ids, crc(ids))
        at += len(ids)
    write_token_files(docs.where("doc_id < 0"), str(tmp_path / "b"))
    assert read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_an_id_with_most_rows_spans_tasks_in_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")           # the table is small
    rng = random.Random(3)
    rows = [(None if i % 10 else i, f"{rng.random()} text {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = in_tasks(docs.selectExpr("doc_id AS id", "text")).selectExpr("spark_partition_id() AS p", "id", "text").collect()
    assert len({r["p"] for r in dealt if r["id"] is None}) > 3
    by_task = sorted({r["p"] for r in dealt})
    assert [(r["id"], r["text"]) for p in by_task for r in dealt if r["p"] == p] == in_order(rows)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_counts_carried_on_leave_no_frequent_pair_in_text():
    """Uses taken away and added round by round are those of a whole count at the end."""
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 60, rng.integers(2, 7)) for _ in range(40)]
    ids = np.concatenate([words[k] for k in rng.zipf(1.3, 4000) % 40] + [np.full(500, 7)]).astype(np.uint32)
    ends = np.unique(np.append(rng.integers(1, len(ids), 50), len(ids)))
    shard = Shard(compress(ids, ends, per_round=16))
    assert np.array_equal(shard.ids(), ids) and np.array_equal(shard.read(1234, 777), ids[1234:2011])
    cut = np.cumsum(shard.lengths[shard.symbols])
    open_ = ~np.isin(cut[:-1], ends)
    a, b = shard.symbols[:-1][open_].astype(np.int64), shard.symbols[1:][open_].astype(np.int64)
    pairs, uses = np.unique((a << 32 | b)[a != b], return_counts=True)
    assert len(shard.left) > 30 and uses.max() < 8


def test_best_cuts_against_exhaustive_dynamic_programming():
    rnd = random.Random(8)
    for _ in range(60):
        total = rnd.randrange(1, 2500)
        docs = np.array(sorted({*(rnd.randrange(1, total + 1) for _ in range(rnd.randrange(6))), total}))
        sentences = np.array(sorted({rnd.randrange(1, total + 1) for _ in range(rnd.randrange(40))}), np.int64)
        size = rnd.choice([600, 1024, 300])
        places, penalty = cut_places(docs, sentences, total)
        assert np.diff(places).max(initial=0) <= 256 and penalty[-1] == 0 and set(penalty.tolist()) <= {0, SENTENCE_CUT, INNER_CUT}

        def pad(n, size=size):
            return 0 if n == size or (n >= 256 and n & (n - 1) == 0) else size - n

        best = [0] + [None] * (len(places) - 1)
        for j in range(1, len(places)):
            best[j] = min(best[i] + pad(places[j] - places[i]) for i in range(j) if places[j] - places[i] <= size) + PER_SEQUENCE + penalty[j]
        cuts = best_cuts(places, penalty, size)
        at, cost = 0, 0
        for c in cuts:
            assert 0 < c - at <= size
            cost += pad(c - at) + PER_SEQUENCE + penalty[np.searchsorted(places, c)]
            at = c
        assert at == total and cost == best[-1]


def check_pieces(rows, docs, size=4096):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    want = {}
    for doc, text in docs:
        want.setdefault(doc, []).append(encoded(text, 2))
    assert set(by_doc) == set(want)
    for doc, lists in want.items():
        if len(lists) == 1:
            at = 0
            for r in sorted(by_doc[doc], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(lists[0]) and r["length"] > 0
                assert r["ids_crc32"] == crc(lists[0][at:at + r["length"]])
                at += r["length"]
            assert at == len(lists[0])
        else:
            assert sum(r["length"] for r in by_doc[doc]) == sum(map(len, lists))
    padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        padded += 0 if at & (at - 1) == 0 else size - at
    return padded


def test_packing_odd_texts(spark):
    docs = spark.createDataFrame([(*r, 7) for r in ODD], "doc_id long, text string, length int").repartition(4)
    check_pieces(pack_documents(docs).collect(), ODD)
    assert pack_documents(docs.where("doc_id < 0")).count() == 0


def test_packing_a_whole_table_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack_documents(docs).collect()
    padded = check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    tasks = len({r["sequence_id"] >> 40 for r in rows})
    assert padded - 4096 * tasks < 0.02 * sum(r["length"] for r in rows)
