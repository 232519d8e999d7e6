"""A slice of the correctness gate inside pytest: Spark query vs its SQL twin
on DuckDB at sf0.001 (names, row count, order-insensitive value hash)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES = ["null_counts", "completeness", "uniqueness", "iqr_outliers", "quality_score", "dedup_keys",
           "median_fill", "group_median_fill", "knn_impute", "categorize", "record_hash", "histogram",
           "box_summary", "loo_encode", "quantile_bins_rank", "quantile_bins", "label_encode_unseen",
           "stratified_split", "roc_auc", "roc_curve", "upsert_latest", "corrupt_drop", "spark_etl_job"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    import __spark_entry__ as E
    from oracle_check import table_hash
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in res.fetchall()]
    assert len(srows) == len(drows)
    assert table_hash(cols, srows)[0] == table_hash(cols, drows)[0]
