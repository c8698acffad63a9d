import math
from collections import Counter

import numpy as np

from quarry.llm.vector_dedup import near_vectors, spherical_kmeans

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, key string"


def brute(rows, least=0.93):
    ok = []
    for vec, label in rows:
        x = None if vec is None or label is None or any(v is None for v in vec) or not vec else np.array(vec, np.float64)
        ok.append(x if x is not None and np.isfinite(x).all() and np.abs(x).max() > 0 else None)
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(ok):
        for j in range(i):
            y = ok[j]
            if x is not None and y is not None and rows[i][1] == rows[j][1] and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    return n, [find(i) for i in range(len(rows))]


def compare(spark, ids, vecs, labels, **how):
    rows = [(i, v, c, "") for i, v, c in zip(ids, vecs, labels, strict=True)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect()
    # cosines are of the stored single-precision values
    held = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vecs]
    n, part = brute(list(zip(held, labels, strict=True)))
    want = []
    for i, vec in enumerate(ids):
        mine = [ids[j] for j in range(len(ids)) if part[j] == part[i] and ids[j] is not None]
        least = min(mine) if mine else None
        want.append((vec, n[i], least, vec is not None and vec == least))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_edge_cases(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.05, 0.0]
    vecs = [a, b, a, None, [], [0.0, 0.0, 0.0], [1.0, None, 0.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], a, a, [1.0, 0.0], [2.0, 0.0], [1e30, 0.0, 0.0], [1e-30, 0.0, 0.0], a]
    labels = [1, 1, 2, 1, 1, 1, 1, 1, 1, None, 2, 1, 1, 1, 1, 3]
    ids = [7, 3, 5, 11, 12, 13, 14, 15, 16, 17, 5, 20, 21, 22, None, None]
    compare(spark, ids, vecs, labels)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_cells_a_hot_group_and_chains(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(260, 32))
    hot = rnd.normal(size=32) + 0.03 * rnd.normal(size=(150, 32))
    copies = base[:60] + 0.05 * rnd.normal(size=(60, 32))
    chain = [rnd.normal(size=32)]
    for _ in range(12):
        chain.append(chain[-1] + 0.28 * np.linalg.norm(chain[-1]) / math.sqrt(32) * rnd.normal(size=32))
    vecs = np.concatenate([base, hot, copies, np.array(chain)])
    order = rnd.permutation(len(vecs))
    vecs = vecs[order]
    ids = list(range(1000, 1000 + len(vecs)))
    compare(spark, ids, [v.tolist() for v in vecs], [int(i % 11 == 0) for i in range(len(vecs))], cell=60, chunk=32)


def test_a_dense_group_keeps_one_centre():
    rnd = np.random.default_rng(1)
    dense = rnd.normal(size=16) + 0.02 * rnd.normal(size=(200, 16))
    points = np.concatenate([dense, rnd.normal(size=(40, 16))])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres = spherical_kmeans(points, 12)
    assert (centres @ points[0] > 0.9).sum() == 1 and len(centres) == 12
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)


def test_recall_at_the_limit(spark):
    """Pairs just above the least cosine, in many cells: none below is linked, nearly all above are found."""
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rnd.normal(size=x.shape)
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cos = rnd.uniform(0.9, 0.96, size=(800, 1))
    y = cos * x + np.sqrt(1 - cos ** 2) * off
    rows = [(i, v.tolist(), 1, "") for i, v in enumerate(np.concatenate([x, y]))]
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double")), cell=100).collect()}
    want = (cos[:, 0] >= 0.93)
    found = sum(got[i] for i in range(800))
    assert all(got[i] == 0 for i in range(800) if cos[i, 0] < 0.9299) and found >= 0.995 * want.sum()


def low_rank(n=300, dims=10, width=192, seed=5):
    """Vectors and near copies of them that vary in few directions of a wide space, as embeddings do."""
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rnd.normal(size=x.shape)
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cos = rnd.uniform(0.931, 0.95, size=(n, 1))
    basis = np.linalg.qr(rnd.normal(size=(width, dims)))[0]
    return (np.concatenate([x, cos * x + np.sqrt(1 - cos ** 2) * off]) @ basis.T).tolist()


def test_few_directions_and_many_cells(spark):
    """Every pair across a border is found where vectors and borders share few directions."""
    vecs = low_rank()
    compare(spark, list(range(len(vecs))), vecs, [1] * len(vecs), cell=30)


def test_a_link_across_cells_counts_for_both_ends(spark):
    """However the cells lie, link ends come in pairs: no vector of a component is without a link of its own."""
    rows = [(i, v, 1, "") for i, v in enumerate(low_rank(dims=24, seed=6))]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), cell=30).collect()
    size = Counter(r["component_id"] for r in got)
    assert any(n == 2 for n in size.values())
    assert all(r["n_links"] == 1 for r in got if size[r["component_id"]] == 2)
    assert all(r["n_links"] > 0 for r in got if size[r["component_id"]] > 1)


def test_the_driver_holds_seeds_and_centres_alone(spark, monkeypatch):
    rows = [(i, v, 1, "") for i, v in enumerate(low_rank(n=1000, width=16))]
    frame, most = type(spark.range(0)), []
    real = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (lambda got: most.append(len(got)) or got)(real(self)))
    out = near_vectors(spark.createDataFrame(rows, SCHEMA), cell=100)
    assert 20 < max(most) <= 160                                # 20 centres, 640 sampled vectors
    assert out.count() == 2000


def test_whole_table(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    compare(spark, [r["vec_id"] for r in t], [r["embedding"] for r in t], [r["label"] for r in t], cell=20)
