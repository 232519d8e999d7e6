"""Source mixing: targets by water filling, sizes, caps, reruns, odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm.common import read_table
from quarry.llm.mixing import mix


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare the excess by weight until no target is above its cap."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > cap * sizes[s]}
        for s in full or open_:
            out[s] = cap * sizes[s] if full else level * w[s]
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def documents(spark):
    return read_table(spark, "/root/testdata/sf0.001", "documents")


def test_targets_sizes_caps_and_reruns(spark, documents):
    got = mix(documents).collect()
    texts = {r.doc_id: r for r in documents.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == words(texts[r.id].text) and r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        sizes[texts[r.id].source] += r["size"]
        taken[texts[r.id].source] += r.taken
    targets = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[texts[r.id].source]
        assert r.target == pytest.approx(targets[texts[r.id].source])
    for s, t in targets.items():
        largest = max(words(x.text) for x in texts.values() if x.source == s)
        assert abs(taken[s] - t) <= max(0.05 * t, min(largest, 0.2 * t)), s
    again = {r.id: r.taken for r in mix(documents.repartition(5)).collect()}
    assert again == {r.id: r.taken for r in got}


def test_inclusion_odds_follow_the_measure(spark):
    """Documents of measure 2 have twice the expected copies of measure 1."""
    rows = [(i, "w " * 60 if i % 2 else "w " * 30, "a") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, share=0.4, weights=(1,)).collect()
    mean = {k: sum(r.copies for r in got if r["size"] == k) / 1500 for k in (30, 60)}
    total = sum(r.taken for r in got)
    assert abs(total - 0.4 * sum(r["size"] for r in got)) <= 60
    assert mean[60] == pytest.approx(2 * mean[30], rel=0.2)


def test_a_long_text_at_the_crossing_leaves_no_gap(spark):
    """One text of 30 % of the source, 70 short ones, half of all wanted."""
    rows = [(i, "w " * (1500 if i == 0 else 50), "a") for i in range(71)]
    rank = lambda seed: sorted(range(71), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13])
    seed = next(s for s in range(1000) if 25 <= rank(s).index(0) <= 35)  # 20 to 50: the long text is the one at the crossing
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs, share=0.5, weights=(1,), seed=seed).collect()
    assert abs(sum(r.taken for r in got) - 2500) <= 25
    assert {r.id for r in got if r.copies} == set([i for i in rank(seed) if i][:50])


def test_descent_against_a_replay(spark):
    """All of one measure, so that the rank order is that of the uniforms."""
    rng = random.Random(6)
    sizes = {i: rng.choice([3, 40, 200, 900, 5000]) + rng.randrange(40) for i in range(240)}
    docs = spark.createDataFrame([(i, "w " * n, f"s{i % 4}") for i, n in sizes.items()], "doc_id long, text string, source string")
    got = {r.id: r for r in mix(docs, measure=F.lit(1)).collect()}
    for k in range(4):
        own = sorted((i for i in sizes if i % 4 == k), key=lambda i: hashlib.md5(f"17:{i}".encode()).hexdigest()[:13])
        target, total = got[own[0]].target, sum(sizes[i] for i in own)
        whole = math.floor(min(target / total, 2.0))
        short = target - whole * total if target / total < 2 else 0
        tries = []
        for descend in (True, False):
            gap, want, over = short, set(), False
            for i in own:
                over = over or sizes[i] > gap
                if sizes[i] <= gap and (descend or not over):
                    want.add(i)
                    gap -= sizes[i]
            for _ in range(2):
                near = min((abs(sizes[i] - gap), n, i) for n, i in enumerate(own) if i not in want)
                if near[0] < abs(gap):
                    want.add(near[2])
                    gap -= sizes[near[2]]
            tries.append((abs(gap), want))
        want = dict.fromkeys(min(tries, key=lambda x: x[0])[1], 1)
        assert {i: got[i].copies - whole for i in own} == {i: want.get(i, 0) for i in own}


def test_odd_rows(spark):
    rows = [(1, "a b c", "x", 9), (1, "a b c", "x", 9), (None, None, None, 9), (2, "", None, 9), (3, "one two", None, 9),
            (4, "z " * 5000, "x", 9), (5, "q", "emptyé", 9), (6, None, "nothing", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mix(docs, carry=True)
    out = got.collect()
    assert len(out) == len(rows) and all(r.copies <= 2 for r in out)
    assert {r.id: r["size"] for r in out}[4] == 5000
    sizes = {"x": 5006, None: 2, "emptyé": 1, "nothing": 0}
    want = brute_targets(sizes)
    for r in out:
        assert r.row.size == 9 and r.target == pytest.approx(want[r.row.source]) and r.source_size == sizes[r.row.source]
    assert mix(docs.limit(0)).count() == 0


def test_crc_is_what_python_says(spark):
    from quarry.llm.quality_gbt import fold
    ids = spark.range(50)
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 7 for r in ids.select("id", fold(ids.id, 7).alias("f")).collect())
