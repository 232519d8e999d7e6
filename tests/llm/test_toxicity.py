"""Toxicity: FTRL against its formulas, held-out accuracy, odd rows."""

import zlib

import numpy as np

from quarry.llm.common import read_table
from quarry.llm.toxicity import SparseWeights, _Hashes, blocks, features, fit_ftrl, fit_toxicity, toxicity_scores

SF = "/root/testdata/sf0.1"


def plain_ftrl(rows, y, alpha, beta, l1, l2, epochs):
    """One coordinate at a time, in dicts."""
    z, n = {}, {}

    def weight(i):
        s = 0 if i == "bias" else l1
        if abs(z.get(i, 0)) <= s:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for r, label in zip(rows, y):
            w = {i: weight(i) for i in [*r, "bias"]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i, v in w.items():
                sigma = ((n.get(i, 0) + g * g) ** 0.5 - n.get(i, 0) ** 0.5) / alpha
                z[i], n[i] = z.get(i, 0) + g - sigma * v, n.get(i, 0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_follows_its_formulas():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 60, 12)).astype(np.uint32) * 70_001 for _ in range(300)]
    y = np.array([float(140_002 in r or 350_005 in r) for r in rows])
    options = {"alpha": 0.7, "beta": 1.0, "l1": 1.5, "l2": 0.1, "epochs": 3}
    model, plain = fit_ftrl(rows, y, **options), plain_ftrl([r.tolist() for r in rows], y, **options)
    assert set(model.keys.tolist()) == set(plain) - {"bias"} and 0 < len(model.keys) < 60
    assert np.allclose(model.weights, [plain[k] for k in model.keys.tolist()]) and np.isclose(model.bias, plain["bias"])


def test_features_of_blocks_and_words():
    hashes = _Hashes()
    text = ("Du ÉTAIS là, IDIOT! 2x " * 50).encode()
    for size in (1, 7, 64, 10_000):
        got = b" ".join(blocks(text, size)).split()
        assert got == ("du étais là idiot 2x " * 50).encode().split()
    assert len(features(b"a b c", hashes)) == 6  # a b c, ab bc, a_c
    assert len(features(b"A b", hashes)) == 3 and len(features(b"", hashes)) == len(features(None, hashes)) == 0
    assert len(set(features(b"a b c", hashes)) & set(features(b"b a", hashes))) == 2
    from quarry.llm import toxicity
    whole = features(text * 40, hashes)
    assert (np.unique(np.concatenate(list(toxicity.gram_blocks(text * 40, hashes, 100)))) == whole).all()


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = {r.id: r for r in toxicity_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    y = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [i for i in y if got[i].held_out]
    assert np.mean([got[i].predicted == y[i] for i in held]) > 0.97
    assert np.mean([got[i].predicted for i in held if y[i]]) > 0.8 and np.mean([got[i].predicted for i in held if not y[i]]) < 0.005
    # labels of the held-out fold make no difference
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, flipped)
    assert (a.keys == b.keys).all() and (a.weights == b.weights).all() and a.bias == b.bias
    assert 0 < len(a.keys) < 2000


def test_odd_rows(spark):
    rows = [(1, "plain words. " * 30, 0.0, 1), (2, None, 1.0, 0), (None, "", 2.0, 0), (4, "x" * 3_000_000, 3.0, 0), (4, "x" * 3_000_000, 3.0, 0),
            *[(i, ("you vile thing " if i % 2 else "plain words go on ") * 9 + str(i), 4.0, 1) for i in range(10, 210)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 210)] + [(None, 1), (10, None), (999, 0)], "doc_id long, toxic int")
    got = toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.id % 2 for r in got if r.id and r.id >= 10)
    text_ids = docs.withColumn("doc_id", docs.doc_id.cast("string")), labels.withColumn("doc_id", labels.doc_id.cast("string"))
    assert sorted(r.predicted for r in toxicity_scores(*text_ids).collect()) == sorted(r.predicted for r in got)
    # a bound on the bytes of the sample passes over long texts only
    assert len(fit_toxicity(docs, labels, max_bytes=20_000).keys)
    assert not len(fit_toxicity(docs, labels, max_bytes=10).keys)
    assert {r.score for r in toxicity_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity_scores(docs.limit(0), labels).count() == 0


def test_repeated_features_count_once():
    model = SparseWeights(features(b"vile", _Hashes()), np.array([3.0]), -1.0)
    assert model.raw(b"vile", _Hashes()) == model.raw(b"Vile vile, VILE!", _Hashes()) == 2.0
