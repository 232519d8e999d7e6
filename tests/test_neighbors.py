"""KNN classifier (G3) against brute force: clustered vectors, exact copies
(zero distances vote alone), distance ties broken by id, fewer rows than k,
and several buckets and query blocks."""

import numpy as np
import pytest

from quarry.operators.neighbors import knn_classify


def brute_force(ids, vecs, labels, k):
    x = np.asarray(vecs, dtype="float64")
    out = {}
    for i, q in enumerate(x):
        acc = np.zeros(len(x))
        for j in range(x.shape[1]):
            diff = q[j] - x[:, j]
            acc += diff * diff
        d = np.sqrt(acc)
        cand = sorted((d[t], ids[t], labels[t]) for t in range(len(x)) if ids[t] != ids[i])[:k]
        zero = any(c[0] == 0 for c in cand)
        w = {}
        for dist, _, lab in cand:
            w[lab] = w.get(lab, 0.0) + ((1.0 if dist == 0 else 0.0) if zero else 1.0 / dist)
        out[ids[i]] = min(w, key=lambda lab: (-w[lab], lab)) if w else None
    return out


def run(spark, ids, vecs, labels, k, **kw):
    rows = [(int(i), [float(v) for v in vec], int(lab)) for i, vec, lab in zip(ids, vecs, labels)]
    df = spark.createDataFrame(rows, "vid long, emb array<float>, lab int")
    res = knn_classify(df, "vid", "emb", "lab", k=k, **kw).collect()
    assert sorted(r["vid"] for r in res) == sorted(int(i) for i in ids)
    return {r["vid"]: r["pred"] for r in res}


@pytest.mark.parametrize("k", [1, 5, 15])
def test_matches_brute_force_clustered(spark, k):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(4, 8))
    lab = rng.integers(0, 4, 300)
    vecs = (centers[lab] + 0.4 * rng.normal(size=(300, 8))).astype("float32")
    noisy = np.where(rng.random(300) < 0.2, rng.integers(0, 4, 300), lab)
    ids = np.arange(1000, 1300)
    # small buckets: many tiles, bands narrower than the table
    got = run(spark, ids, vecs, noisy, k, tile_rows=64, min_bucket_rows=16)
    assert got == brute_force(list(ids), vecs, list(noisy), k)


def test_exact_copies_and_ties(spark):
    base = [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0], [3.0, 3.0]]
    vecs = base + [[0.0, 0.0], [0.0, 0.0], [3.0, 3.0]]
    labels = [0, 1, 1, 2, 2, 3, 4, 4, 5]
    ids = list(range(len(vecs)))
    got = run(spark, ids, vecs, labels, 3, min_bucket_rows=8, tile_rows=4)
    want = brute_force(ids, np.array(vecs, dtype="float32"), labels, 3)
    assert got == want
    assert got[0] == 4  # two copies at distance 0 outvote everything else
    assert got[5] == 5 and got[8] == 3  # a lone copy decides alone


def test_fewer_rows_than_k(spark):
    vecs = [[0.0], [1.0], [5.0]]
    got = run(spark, [1, 2, 3], vecs, [7, 8, 8], 15)
    assert got == brute_force([1, 2, 3], np.array(vecs, dtype="float32"), [7, 8, 8], 15)


def test_embeddings_fixture(spark):
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pandas()
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = {r["vec_id"]: r["pred"] for r in knn_classify(df, "vec_id", "embedding", "label", k=15).collect()}
    want = brute_force(list(t.vec_id), np.stack(t.embedding.to_numpy()), list(t.label), 15)
    assert got == want


def test_chunked_tiles(spark, monkeypatch):
    from quarry.operators import neighbors
    monkeypatch.setattr(neighbors, "_TILE_CELLS", 50)  # several query chunks per tile
    rng = np.random.default_rng(11)
    vecs = rng.normal(size=(120, 6)).astype("float32")
    labels = list(rng.integers(0, 3, 120))
    ids = list(range(120))
    got = run(spark, ids, vecs, labels, 7, tile_rows=64, min_bucket_rows=8)
    assert got == brute_force(ids, vecs, labels, 7)


def test_many_dimensions_text_labels_and_a_single_row(spark):
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(40, 768)).astype("float32")
    vecs[20:] += 3
    rows = [(i, [float(x) for x in v], "low" if i < 20 else "high") for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vid long, emb array<float>, lab string")
    got = {r.vid: r.pred for r in knn_classify(df, "vid", "emb", "lab", k=3, min_bucket_rows=8).collect()}
    assert got == {i: lab for i, _, lab in rows}
    one = knn_classify(df.limit(1), "vid", "emb", "lab", k=3).collect()
    assert [(r.vid, r.lab, r.pred) for r in one] == [(0, "low", None)]
    assert knn_classify(df.limit(0), "vid", "emb", "lab").count() == 0


def test_several_features_are_imputed_at_once(spark):
    from quarry.operators.knn import knn_impute
    rng = np.random.default_rng(8)
    x = rng.integers(0, 6, size=(90, 4)).astype(float)
    x[rng.random(x.shape) < 0.15] = np.nan
    x[0] = np.nan
    rows = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in r], "kept") for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, note string")
    got = {r.id: r for r in knn_impute(df, ["a", "b", "c", "d"], "id", k=3, block_rows=17).collect()}
    for i, row in enumerate(x):
        gap = (row - x) ** 2
        shared = (~np.isnan(gap)).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            far = np.sqrt(4 / shared * np.nansum(gap, axis=1))
        for c in range(4):
            want = row[c]
            if np.isnan(want):
                near = [j for _, j in sorted((far[j], j) for j in range(90) if shared[j] and not np.isnan(x[j, c]))[:3]]
                want = np.mean(x[near, c]) if near else np.nanmean(x[:, c])
            assert got[i][1 + c] == pytest.approx(want)
        assert got[i].note == "kept"


def test_donors_meet_a_block_of_queries_not_each_query(spark, monkeypatch):
    """Only the nearest leave a stream of donors, and far offsets, unused blocks and many small blocks change nothing."""
    from quarry.operators import neighbors
    rng = np.random.default_rng(5)
    vecs = (rng.normal(size=(400, 5)) + 1000 * rng.integers(0, 3, size=(400, 1))).astype("float32")
    labels, ids = list(rng.integers(0, 3, 400)), list(range(400))
    seen = []
    add = neighbors._Nearest.add
    block = neighbors._Nearest.__new__(neighbors._Nearest)
    import pandas as pd
    rows = pd.DataFrame({"_id": ids[:50], "_lab": labels[:50], "_v": list(vecs[:50]), "_p": [[0.0]] * 50, "_r": [np.inf] * 50})
    block.__init__(rows, 4, 1)
    for a in range(0, 400, 40):
        add(block, pd.DataFrame({"_id": ids[a:a + 40], "_lab": labels[a:a + 40], "_v": list(vecs[a:a + 40]), "_p": [[0.0]] * 40}))
        seen.append(sum(len(f) for f in block.found))
    assert max(seen) <= 50 * 44 and len(block.result()) == 200
    assert run(spark, ids, vecs, labels, 7, tile_rows=32, min_bucket_rows=8) == brute_force(ids, vecs, labels, 7)
