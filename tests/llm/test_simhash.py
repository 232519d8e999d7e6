"""SimHash operator against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from quarry.llm.components import connected_components
from quarry.llm.simhash import drop_near_duplicates, fingerprint, near_links, simhash_components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_pairs(values, bits=4):
    v = np.array(values, np.int64).view(np.uint64)
    return [(values[i], values[j]) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1:]) <= bits) + i + 1]


@pytest.mark.parametrize("text", ["", None, "one", "Two words", "a b c d", "A B c D e f g a b c d", "é ß  x\ty\nz w w w w w"])
def test_fingerprint_matches_its_definition(text):
    assert fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_long_text_in_blocks():
    rng = random.Random(3)
    text = " ".join(rng.choice("ab cd ef gh ij kl mn".split()) for _ in range(5000)).encode()
    assert fingerprint(text, block=64) == fingerprint(text)


@pytest.mark.parametrize("node_rows,seed", [(20_000, 1), (12, 2), (3, 3)])
def test_links_connect_what_brute_force_connects(spark, node_rows, seed):
    """Random values and dense clusters; small node limits force the descent in Spark."""
    rng = random.Random(seed)
    values = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(12):
        v = rng.getrandbits(64)
        for _ in range(25):
            values.add(v)
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
    values |= {0, 1, (1 << 64) - 1, 1 << 63, (1 << 63) | 3}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    links = near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, node_rows, batch_rows=40)
    got = [(r.u, r.v) for r in links.collect()]
    near = set(brute_pairs(signed))
    assert all((min(p), max(p)) in near or roots(near, signed)[p[0]] == roots(near, signed)[p[1]] for p in got)
    want = roots(near, signed)
    assert roots(got, signed) == want
    comp = {r.node: r.root for r in connected_components(spark.createDataFrame(got, "u long, v long")).collect()}
    assert {v: comp.get(v, v) for v in signed} == want


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 150), (200, 150)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 150, 150: 150}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents_with_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text, "x"), (3, text.upper(), "y"), (9, text + " tail", "z"), (1, None, None), (2, "", "q"), (2, "", "q"),
            (None, "other words entirely here now", "q"), (None, " ", "q"), (4, "lone", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.id, r.fp): r.component_id for r in simhash_components(docs).collect()}
    assert {k[0]: v for k, v in got.items() if k[0] in (3, 5, 9)} == {3: 3, 5: 3, 9: 3}
    assert got[(1, 0)] == got[(2, 0)] == got[(None, 0)] == 1
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert simhash_components(docs.limit(0)).count() == 0
