"""Language model, token cache and URL filters against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import ngram_lm as lm
from quarry.llm import token_cache as tc
from quarry.llm.common import read_table, scratch_path
from quarry.llm.queries import URL_RULES
from quarry.llm.url_filter import absolute, judge_urls

SF = "/root/testdata/sf0.001"


# -- language model ----------------------------------------------------------

def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["</end>"]


def brute_counts(docs, parts):
    one, two, before = Counter(), Counter(), Counter()
    for i, t in docs:
        if (zlib.crc32(str(i).encode()) % 7 if i is not None else None) in parts:
            w = ["<s>"] + tokens(t)
            one.update(w[1:])
            two.update(zip(w, w[1:]))
            before.update(w[:-1])
    return one, two, before


def brute_scores(docs, weights):
    one, two, before = brute_counts(docs, {0, 1, 3, 4, 5, 6, None})
    n, v = sum(one.values()), len(one)
    out = {}
    for i, t in docs:
        w = ["<s>"] + tokens(t)
        base = score = 0.0
        for a, b in zip(w, w[1:]):
            base += math.log10((one[b] + 1) / (n + v + 1))
            x = weights[min(int(math.log2(before[a] + 1)), lm.BUCKETS - 1)]
            rest = x[1] * one[b] / max(n, 1) + x[2] / (v + 1)
            score += math.log10(x[0] * two[a, b] / before[a] + rest if before[a] else rest / (x[1] + x[2]))
        out[i] = (len(w) - 1, sum(one[b] > 0 for b in w[1:]), n, base, score)
    return out


def test_scores_against_plain_counting(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = ["The", "cat", "dog", "ran", "é", "sat", "on"] + [f"v{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(vocabulary[: 7 + rng.randrange(60)]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    docs += [(200, None), (201, ""), (203, "\t cat\n ran ")]
    kept = {}
    fit = lm.fit_weights
    monkeypatch.setattr(lm, "fit_weights", lambda cells: kept.setdefault("w", fit(cells)))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    got = lm.interpolated_scores(frame, chunk_bytes=700, range_bytes=900).collect()
    want = brute_scores(docs, kept["w"])
    assert len(got) == len(docs)
    for r in got:
        n, known, total, base, score = want[r.id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.held_out == (zlib.crc32(str(r.id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_weights_maximise_held_out_likelihood():
    """Every bucket's weights beat small moves away from them."""
    rng = np.random.default_rng(1)
    cells = np.array([(b, rng.choice([-9999, 40, 60, 80]), rng.choice([-9999, 5, 20, 40]), rng.integers(1, 50)) for b in (3, 9) for _ in range(60)], float)
    weights = lm.fit_weights(cells, rounds=400)

    def likelihood(b, w):
        part = cells[cells[:, 0] == b]
        ratio = [np.where(part[:, k] > -9999, 2.0 ** (part[:, k] / lm.STEPS), 0) for k in (1, 2)]
        return (part[:, 3] * np.log(w[0] * ratio[0] + w[1] * ratio[1] + w[2])).sum()

    for b in (3, 9):
        best = likelihood(b, weights[b])
        for i in range(3):
            for j in {0, 1, 2} - {i}:
                w = weights[b].copy()
                step = min(0.02, w[i])
                w[i], w[j] = w[i] - step, w[j] + step
                assert likelihood(b, w) <= best + 1e-6


def test_model_beats_base_and_odd_tables(spark):
    docs = read_table(spark, SF, "documents")
    got = lm.interpolated_scores(docs).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.interpolated_scores(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, "w " * 30_000)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in lm.interpolated_scores(odd).collect()) == [3, 3, 30_001]


def test_planes_round_trip():
    for kind in (np.uint64, np.uint32):
        x = np.random.default_rng(0).integers(0, 2 ** 31, 1000).astype(kind)
        assert (lm.unplanes(lm.planes(x), kind) == x).all()
    assert len(lm.unplanes(lm.planes(np.zeros(0, np.uint64)), np.uint64)) == 0


def test_counts_past_32_bits():
    """Corpus-wide counts of a key over 2**32 stay whole, there and back."""
    tokens = lm.Tokens([b"a b"])
    keys, _ = tokens.keys()
    most = 3_000_000_000
    asked = pa.table({"chunk": ["x", "y"], "part": pa.array([lm.RETAINED, lm.DELETED], pa.int32()),
                      "range": pa.array([0, 0], pa.int32()), "keys": [lm.planes(keys)] * 2,
                      "counts": [lm.planes(np.full(len(keys), most, np.uint32))] * 2})
    answers = lm._answer(asked)
    stats = answers.to_pylist()[-1]
    assert (stats["n_all"], stats["v_all"], stats["n_retained"], stats["v_retained"]) == (6 * most, 3, 3 * most, 3)
    for column, want in (("all", 2 * most), ("retained", most)):
        for counts in lm._token_counts(tokens, answers.slice(1, 1), column):
            assert set(counts.tolist()) == {want}


# -- token counts ------------------------------------------------------------

TEXTS = ["Hello world", "", None, "Hello world", "<|endoftext|> in text", "é ß 漢字 🙂", "x" * 100_000, "a  b\n\n c\t"]


def test_token_counts_and_cache(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    want = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    docs = spark.createDataFrame([(i if i else None, t, "d") for i, t in enumerate(TEXTS)], "doc_id long, text string, digest string")
    cache = scratch_path(spark, "cache-test")
    got = sorted(tc.token_counts(docs, path, cache).collect(), key=lambda r: r.id or 0)
    assert [r.n_tokens for r in got] == want
    assert [r.n_bytes for r in got] == [len((t or "").encode()) for t in TEXTS]
    assert [r.over_limit for r in got] == [n > 512 for n in want]
    with open(path, "rb") as f:
        version = tc.tokenizer_version(f.read())
    stored = spark.read.parquet(f"{cache}/{version}")
    assert stored.count() == len({t or "" for t in TEXTS})
    # only what the cache lacks is encoded, and what it has is believed
    more = docs.unionByName(spark.createDataFrame([(100, "new one", "d")], docs.schema))
    with open(path, encoding="utf-8") as f:
        assert [r.n_tokens for r in tc.encode_misses(more, "text", f.read(), f"{cache}/{version}").collect()] == [2]
    assert tc.token_counts(more, path, cache).count() == 9
    assert spark.read.parquet(f"{cache}/{version}").count() == len({t or "" for t in TEXTS}) + 1
    assert tc.tokenizer_version(b"{}") != version
    assert tc.token_counts(docs.limit(0), path).count() == 0


def test_texts_of_hits_are_not_shuffled(spark, tmpdir_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "c d e", "a b", "", None, "x" * 50_000])], "doc_id long, text string")
    assert tc.token_counts(docs, path, tmpdir_path).count() == 6
    with open(path, "rb") as f:
        folder = f"{tmpdir_path}/{tc.tokenizer_version(f.read())}"
    more = docs.union(spark.createDataFrame([(9, "new"), (10, "new")], docs.schema))
    missing = tc.missing_texts(more, "text", folder)
    assert [bytes(r.body) for r in missing.collect()] == [b"new"]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    # the semi join with the few digests missed lies below the only exchange of bodies
    assert plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning(digest")
    assert tc.missing_texts(docs, "text", folder).count() == 0
    assert tc.token_counts(docs, path, tmpdir_path).count() == 6


# -- URL filters -------------------------------------------------------------

def test_rules_and_components(spark):
    link = lambda u: f"<html><link href='{u}' rel=canonical><p>"
    move = lambda u: f'<META HTTP-EQUIV="Refresh" CONTENT="0; URL={u}">'
    pages = [
        (1, "http://Example.COM/en/x?q=1#f", None), (2, "https://www.example.com/en/y", ""), (3, "https://a.example.net/es/1", ""),
        (4, "https://free.example.org/1", link("https://a.example.net/es/1")), (5, "https://free.example.org/2", move("/1")),
        (6, "http://free.example.org/2/?utm_source=z", None), (7, "https://free.example.org/3", link("https://b.example.net/es/1?a=1&amp;b=2")),
        (8, "https://free.example.org/4", link("http://free.example.org/3") + move("https://ok.com/")), (9, None, link("https://a.example.net/es/1")),
        (10, "no scheme", link("https://a.example.net/es/1")), (None, "https://example.net/de/1", link("")), (11, "https://net/es/", ""),
        (11, "https://net/es/", ""), (12, "https://xnet/es/", ""), (13, "ftp://h.example.org:21", "")]
    frame = spark.createDataFrame([(*p, "r") for p in pages], "page_id long, url string, html string, rule string")
    got = defaultdict(list)
    for r in judge_urls(frame, URL_RULES).collect():
        got[r.id].append((r.host, r.path, r.rule, r.verdict))
    assert got[1] == [("example.com", "/en/x", "example.com/en/", "block")]
    assert got[2] == [("www.example.com", "/en/y", "www.example.com/en/", "allow")]
    assert got[3] == [("a.example.net", "/es/1", "net/es/", "block")]
    assert [got[i][0][2:] for i in (4, 5, 6)] == [(None, "block")] * 3  # named after a blocked page
    assert [got[i][0][2:] for i in (7, 8)] == [(None, "allow")] * 2  # an allowed name has precedence
    assert got[9] == got[10] == [("", "", None, "allow")]
    assert got[None] == [("example.net", "/de/1", None, "allow")]
    assert got[11] == [("net", "/es/", "net/es/", "block")] * 2
    assert got[12] == [("xnet", "/es/", None, "allow")] and got[13] == [("h.example.org:21", "", None, "allow")]
    assert judge_urls(frame.limit(0), URL_RULES).count() == 0
    extra = spark.createDataFrame([("https://xnet/es/", "http://a.example.net/es/1/")], "from_url string, to_url string")
    assert {r.verdict for r in judge_urls(frame, URL_RULES, redirects=extra).where("id = 12").collect()} == {"block"}


def test_absolute_targets(spark):
    base = "https://h.org/a/b?x"
    cases = [("http://o.org/", "http://o.org/"), ("//o.org/z", "https://o.org/z"), ("/z", "https://h.org/z"), ("z", "https://h.org/a/z")]
    frame = spark.createDataFrame([(t, base) for t, _ in cases], "t string, b string")
    assert [r.u for r in frame.select(absolute(frame.t, frame.b).alias("u")).collect()] == [w for _, w in cases]


def test_absolute_targets_with_dots_and_queries(spark):
    base = "https://h.org/a/b/c?x#y"
    cases = [("?page=2", "https://h.org/a/b/c?page=2"), ("#z", "https://h.org/a/b/c?x#z"), ("./z", "https://h.org/a/b/z"),
             ("../z", "https://h.org/a/z"), ("../../../z", "https://h.org/z"), ("..", "https://h.org/a/"), (".", "https://h.org/a/b/"),
             ("/p/./q/../r?u=/../v", "https://h.org/p/r?u=/../v"), ("//o.org/../z", "https://o.org/z"), ("z?u=../v", "https://h.org/a/b/z?u=../v"),
             ("http://o.org/a/../b#/./", "http://o.org/b#/./"), ("..z/.q", "https://h.org/a/b/..z/.q"), ("x//../y", "https://h.org/a/b/x/y")]
    frame = spark.createDataFrame([(t, base) for t, _ in cases], "t string, b string")
    assert [r.u for r in frame.select(absolute(frame.t, frame.b).alias("u")).collect()] == [w for _, w in cases]
    bare = spark.createDataFrame([("?q", "https://h.org"), ("../z", "https://h.org")], "t string, b string")
    assert [r.u for r in bare.select(absolute(bare.t, bare.b).alias("u")).collect()] == ["https://h.org?q", "https://h.org/z"]


def test_a_block_reaches_relative_names(spark):
    pages = [(1, "https://a.example.net/es/x/1", "<link rel=canonical href='../../free'>"), (2, "https://a.example.net/free", None),
             (3, "https://a.example.net/fr/y", "<link rel=canonical href='../y/?p=2'>"),
             (4, "https://a.example.net/y?p=2", None), (5, "https://b.example.net/list", "<link rel=canonical href='?p=3'>"),
             (6, "https://b.example.net/list?p=3", "<link rel=canonical href='./es/../es/'>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.id: r.verdict for r in judge_urls(frame, URL_RULES).collect()} == dict.fromkeys(range(1, 7), "block")


def test_without_spellings_only_links_join_names(spark):
    rows = [(1, "http://a.net/es/", None), (2, "http://a.net/es", None), (3, "https://a.net/es/#x", None),
            (4, "http://b.org/1", '<link rel="canonical" href="http://a.net/es/">'), (5, "http://b.org/1/", ""),
            (6, "HTTP://b.org/1", "<p>" * 200_000 + '<meta http-equiv="refresh" content="0; url=http://b.org/1">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.id: r.verdict for r in judge_urls(pages, URL_RULES, spellings=False).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "block"}
    assert {r.id: r.verdict for r in judge_urls(pages, URL_RULES).collect()}[2] == "block"


def test_linked_pages_through_the_query(spark, tmpdir_path):
    """The registered query over pages that hold links, against union-find."""
    from quarry.llm.queries import queries
    rng = random.Random(8)
    hosts = ["a.net", "b.net", "b.org", "c.de", "example.com", "www.example.com"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['es', 'fr', 'en', 'x'])}/{i}" for i in range(400)]
    rows, parent = [], {u: u for u in urls}

    def root(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for i, url in enumerate(urls):
        html = f"<p>{i}</p>"
        if rng.random() < 0.4:
            to = rng.choice(urls[: 1 + i])
            html += rng.choice([f'<link rel="canonical" href="{to}">', f"<meta http-equiv='refresh' content='3; url={to}'>"])
            parent[root(url)] = root(to)
        rows.append((i, url, html))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmpdir_path}/pages.parquet")

    def rule(url):
        host, path = url.split("://")[1].split("/", 1)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and f"/{path}".startswith(r.path)]
        return max(fits, key=lambda r: len(r.host + r.path), default=None)

    said = defaultdict(set)
    for u in urls:
        if rule(u):
            said[root(u)].add(rule(u).verdict)
    want = {i: rule(u).verdict if rule(u) else "block" if said[root(u)] == {"block"} else "allow" for i, u, _ in rows}
    got = {r.page_id: r.verdict for r in queries()["op8_url_filter"](spark, tmpdir_path).collect()}
    assert got == want
    assert sum(want[i] == "block" and rule(u) is None for i, u, _ in rows) > 10


def test_sql_resolves_targets_as_the_query_does(spark, tmpdir_path):
    import duckdb
    from quarry.llm.queries import oracles, queries
    bases = ["http://a.net/es/p", "http://a.net/x/y/z?q=1", "http://b.org/x/", "https://b.org", "http://c.de/es/#top", "http://a.net/z"]
    targets = ["../es/p", "./z", "..", ".", "?page=2", "#top", "/x/./y/../es/p", "//a.net/es/p", "z", "", "../../../../es/p", "http://b.org/x/../x/"]
    rows = [(10 * i + 100 * n, u, f'<link href="{t}" rel="canonical">') for n, t in enumerate(targets) for i, u in enumerate(bases)]
    rows += [(5, "http://b.org/x/z", None), (7, None, "<p>"), (8, "no scheme", ""), (9, "http://a.net/x/es/p", ""), (3, "http://a.net/es/p?page=2", "")]
    path = f"{tmpdir_path}/pages.parquet"
    for only in ([0], [6], list(range(len(targets)))):
        some = [r for r in rows if r[0] < 10 or r[0] // 100 in only]
        spark.createDataFrame(some, "page_id long, url string, html string").coalesce(1).write.mode("overwrite").parquet(path)
        got = sorted(map(str, (tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict"))
                               for r in queries()["op8_url_filter"](spark, tmpdir_path).collect())))
        sql = oracles()["op8_url_filter"].replace("FROM pages", f"FROM read_parquet('{path}/*.parquet') pages")
        assert got == sorted(map(str, duckdb.sql(f"SELECT page_id, host, path, rule, verdict FROM ({sql})").fetchall())), only
