"""Line runs: levels, compaction, anti-join, and odd texts against brute force."""

from collections import defaultdict

from quarry.llm.common import scratch_path
from quarry.llm.line_runs import LineRuns, dedup_lines

LONG = "a line that is long enough to be counted as a passage "


def brute(rows, min_length=40, min_docs=5):
    blanks = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(blanks))
    holders = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_length:
                holders[k].append((doc_id is not None, doc_id, i))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), [])) < min_docs
                or (doc_id is not None, doc_id) == max((h[0], h[1] if h[0] else 0) if h[0] else (False, None) for h in holders[key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, gone string, h1 int")
    out = dedup_lines(docs, **options)
    return sorted([(r.id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()], key=str), out


def test_against_brute_force_for_any_batches(spark):
    rows = []
    for i in range(60):
        lines = [f"{LONG}{i % 7}", f"  {LONG.upper()}{i % 9}\t", "short", f"only here {i} " + "z" * 50]
        rows.append((i * 3 % 61, "\n".join(lines[: 1 + i % 4] + lines[:1] * (i % 3))))
    want = brute(rows)
    for batches, fanout in ((1, 4), (5, 2), (9, 3)):
        got, _ = run(spark, rows, batches=batches, fanout=fanout)
        assert got == want


def test_odd_texts(spark):
    rows = [(i, LONG) for i in range(4)] + [(None, LONG), (None, None), (3, ""), (7, "\n\n"), (8, "x" * 300_000),
                                            (9, f"É{LONG}\r\n{LONG}"), (9, f"É{LONG}\r\n{LONG}"), (None, "é" + LONG)]
    got, out = run(spark, rows)
    assert got == brute(rows)
    assert out.select("row.*").columns == ["doc_id", "text", "gone", "h1"]
    assert run(spark, rows[:0])[0] == []
    nulls = [(None, LONG)] * 6
    assert run(spark, nulls)[0] == brute(nulls) and run(spark, nulls)[0][0][2] == 0


def test_ids_that_are_not_numbers(spark):
    """Text ids, all or some of them digits: largest in their own order."""
    for ids in ([f"doc-{i}" for i in range(12)], [str(i) for i in range(12)], [*"abcdef", "7", "10", "9", None]):
        rows = [(i, f"{LONG}\n{LONG}{n % 2}") for n, i in enumerate(ids)]
        docs = spark.createDataFrame(rows, "doc_id string, text string")
        got = [(r.id, r.n_lines, r.n_dropped, r.kept) for r in dedup_lines(docs).collect()]
        assert sorted(got, key=str) == brute(rows)


def test_levels_and_unseen(spark):
    store = LineRuns(spark, scratch_path(spark, "runs-test"), fanout=2)
    for batch in range(5):
        keys = spark.createDataFrame([(k, 0, 100 - batch) for k in range(batch, batch + 3)], "h1 long, h2 long, id long")
        fresh = {r.h1 for r in store.unseen(keys).collect()}
        assert fresh == ({0, 1, 2} if batch == 0 else {batch + 2})
        store.add(keys)
    assert [len(x) for x in store.levels] == [1, 0, 1]
    rows = {r.h1: (r.n_docs, r.keeper) for r in store.merged().collect()}
    assert rows == {k: (min(k + 1, 3, 7 - k), 100 - max(0, k - 2)) for k in range(7)}


def test_runs_are_merged_without_moving_or_sorting_them(spark):
    store = LineRuns(spark, scratch_path(spark, "runs-test"), fanout=9, buckets=3)
    for n in range(3):
        store.add(spark.range(n * 500, n * 500 + 2000).selectExpr("id AS h1", "id % 7 AS h2", "id"))
    name = store.levels[0][0]
    batch = store._read(name).withColumnRenamed("keeper", "top")
    plan = store.marked(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan and "Sort [" not in plan
    merged = store.merged()._jdf.queryExecution().executedPlan().toString()
    assert merged.count("Exchange") == 1
    assert store.merged().count() == 3000
    store.drop()
    assert not spark.catalog.tableExists(name)
