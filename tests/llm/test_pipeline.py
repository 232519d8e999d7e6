"""The pipeline's stages on a small table: each one's decisions take effect."""

import corpus_pipeline as cp
from quarry.llm.common import read_table
from quarry.llm.decontam import decontaminate_report
from quarry.llm.simhash import simhash_components

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in cp.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "mixture"]
    seen = {}
    for name, stage in cp.STAGES:
        before, docs = docs, stage(spark, docs, SF).checkpoint()
        seen[name] = (before, docs)
        if name != "mixture":
            assert docs.columns == cp.COLUMNS
    counts = [seen[n][1].count() for n, _ in cp.STAGES]
    assert counts[1] == counts[0] < seen["quality"][0].count() and counts[2] < counts[1] and counts[3] <= counts[2]
    before, after = seen["near_duplicates"]
    groups = {r.component_id for r in simhash_components(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)
    bad = {r.id for r in decontaminate_report(seen["benchmark"][0], read_table(spark, SF, "benchmark")).where("contaminated").collect()}
    assert {r.doc_id for r in seen["benchmark"][1].collect()} == {r.doc_id for r in seen["benchmark"][0].collect()} - bad
    last = seen["mixture"][1].collect()
    assert last and all(r.copies in (1, 2) and r.taken == r.copies * r["size"] for r in last)
    assert {r.doc_id for r in last} <= {r.doc_id for r in seen["benchmark"][1].collect()}


def test_empty_table(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
    assert docs.count() == 0


def test_stages_on_odd_rows(spark):
    """Nulls, empty and very long texts, null ids and repeated rows."""
    words, others = [f"w{i}" for i in range(3000)], [f"x{i}" for i in range(180_000)]
    rows = [(1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \n ", "en", None, 3), (4, " ".join(words), "en", "a", 9),
            (4, " ".join(words), "en", "a", 9), (None, " ".join(words[:40]), "en", "b", 9), (5, " ".join(others), "de", "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = lambda df: sorted(str(r.doc_id) for r in df.collect())
    kept = {name: stage(spark, docs, SF) for name, stage in cp.STAGES}
    assert set(ids(kept["quality"])) <= set(ids(docs))
    assert sorted(map(str, kept["lines"].collect())) == sorted(map(str, docs.collect()))
    assert ids(kept["benchmark"]) == ids(docs)
    near = ids(kept["near_duplicates"])
    assert near == ["1", "4", "5", "None"]
    assert {r.doc_id for r in kept["mixture"].collect()} <= {1, 2, 3, 4, 5, None}
