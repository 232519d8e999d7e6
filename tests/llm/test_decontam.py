"""Decontamination against a plain search of every window at every place."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quarry.llm import decontam as dc
from quarry.llm.decontam import decontaminate_report, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i:i + n]))):
                    hit |= set(range(i, i + n))
                    ids |= own
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "c") for r in docs], "doc_id long, text string, n int, win string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate_report(d, b, **options)
    clean = sorted((r.doc_id for r in drop_contaminated(d, b, **options).collect()), key=str)
    return sorted([tuple(r) for r in got.collect()], key=str), clean


def test_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(14)] + ["the", "of", "été"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(14, 60))) for i in range(12)] + [(50, "the"), (51, "w1 W2"), (52, "of the of"), (53, text(8))]
    docs = [(i, text(rng.choice([0, 3, 40, 300]))) for i in range(40)]
    for i in range(40, 70):
        w = items[rng.randrange(12)][1].split()
        a = rng.randrange(len(w) - 12)
        docs.append((i, text(rng.randint(0, 200)) + " -- " + ", ".join(w[a:a + rng.randint(10, 30)]).title() + "! " + text(rng.randint(0, 150))))
    for some in (items, items[:12]):
        for block in (64, 7):
            got, clean = run(spark, docs, some, block=block)
            assert got == brute(docs, some)
            assert clean == sorted((r[0] for r in got if not r[5]), key=str)


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(1, None), (None, passage), (2, ""), (3, "..."), (4, passage), (4, passage), (5, "x " * 30_000 + passage), (6, passage.replace(" ", "\n"))]
    items = [(7, passage), (7, passage), (None, passage), (8, None), (9, "?!"), (10, "")]
    got, clean = run(spark, docs, items)
    assert got == brute(docs, items) and clean == [1, 2, 3, 5]
    assert run(spark, docs, items[:0] + [(8, None)])[0] == brute(docs, [(8, None)])
    assert run(spark, [], items)[0] == []


def test_only_prefix_shingles_meet_the_texts(spark):
    """A shingle that is in every text is counted, but never joined: every
    window that holds it has a rarer one."""
    common = "one of the "
    items = spark.createDataFrame([(i, " ".join(f"q{i}x{j}" for j in range(8)) + " " + common + f"r{i} s{i}") for i in range(5)],
                                  "item_id long, text string")
    docs = [(i, common * 30 + f"z{i}") for i in range(40)]
    docs.append((40, "start " + " ".join(f"q2x{j}" for j in range(8)) + " " + common + "r2 s2 end"))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    shingles = dc.window_shingles(dc.item_windows(items, "item_id", "text", 13), 3)
    places = dc._places(docs, "text", [3], 13, 64)
    prefix = dc.window_prefixes(places, shingles)
    # the other items' rarer shingles are in no text: their windows are ruled out
    assert [(r.win.split()[0], r.n_found) for r in prefix.collect()] == [("q2x0", 1)]
    assert places.join(shingles.select("h").distinct(), "h").count() == 40 * 30 + 11
    assert places.join(prefix, "h").count() == 1
    counted = places.select("h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(text" not in plan  # the counting pass carries neither the texts' keys nor their words
    got = decontaminate_report(docs, items).where("contaminated").collect()
    assert [(r.id, r.n_hit) for r in got] == [(40, 13)]
