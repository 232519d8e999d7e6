"""Source divergences against plain counting; bounds, ties, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm.common import read_table
from quarry.llm.divergence import shares, source_divergences, term_counts

SF = "/root/testdata/sf0.01"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def plain(rows, min_docs=30, top=50, smoothing=5, scale=10**9):
    groups, df = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(words)
        df.setdefault(lang, Counter()).update(set(words))
    out = set()
    for lang, by in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        every = Counter()
        for c in by.values():
            every.update(c)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + smoothing) // (n + smoothing * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in by.items()}, p(every)
        for s in by:
            pair = sorted(((-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in by if o != s), key=lambda x: (x[0], x[1].encode()))
            term = sorted(((q[t] - ps[s][t], t) for t in kept if by[s][t] and ps[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:top]
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(pair)}
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(term)}
    return out


def rows_of(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_table(spark):
    docs = read_table(spark, SF, "documents")
    assert rows_of(source_divergences(docs)) == plain([(r.text, r.lang, r.source) for r in docs.collect()])


@pytest.fixture(scope="module")
def small():
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{'é' * (i // 26)}" for i in range(60)] + ["A", "a", "ÄB", "äb", "x1y"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s10", None, "S1", ""]))
            for _ in range(500)]
    rows += [("w " * 5, "en", "hot")] * 300 + [(None, "en", "no text"), ("", "xx", "a"), (None, "xx", "b"), ("", "yy", "alone")]
    return rows


@pytest.mark.parametrize("options", [{}, {"spill_bytes": 2000}, {"group_terms": 3}, {"tile": 2, "group_terms": 7}, {"tile": 1}, {"top": 3}])
def test_bounds_make_no_difference(spark, small, options):
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in small], "text string, lang string, source string, n int, value double").repartition(5)
    got = rows_of(source_divergences(docs, min_docs=4, **options))
    want = plain(small, min_docs=4, top=options.get("top", 50))
    assert got == want and {r[1] for r in got if r[0] == "xx"} == {"a", "b"} and not any(r[0] == "yy" for r in got)


def test_no_terms_and_no_rows(spark):
    schema = "text string, lang string, source string"
    assert source_divergences(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([("a b", "en", "s"), ("a", "en", "t"), ("1 2 3", "en", "u")], schema)
    assert {(r[4], r[5]) for r in rows_of(source_divergences(few))} == {(0, 1), (0, 2)}


def test_long_texts_and_large_counts():
    text = ("Größe abc DEF, " * 1000 + "x" * 5000).encode()
    whole = term_counts(text)
    assert whole == term_counts(text, 1) == term_counts(text, 777) and whole["def".encode()] == 1000 and whole[b"x" * 5000] == 1
    assert term_counts(None) == term_counts(b"") == Counter()
    big = np.array([[10**12, 3]], np.int64)
    n = np.array([10**13, 10**13])
    assert shares(big, n, 7, 5, 10**9).tolist() == [[1 + 10**9 * (c + 5) // (10**13 + 35) for c in (10**12, 3)]]
