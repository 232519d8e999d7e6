"""Run metrics (D13, E7): narrow rows, and wide ones whose groups keep hashes alone."""

import pytest

from quarry.plans.metrics import run_metrics

ROWS = [(1, "a", 1.0), (1, "a", 1.0), (2, None, float("nan")), (2, None, float("nan")), (3, None, None), (None, "b", 2.0)]


@pytest.mark.parametrize("columns, filled", [(["id", "note", "x"], 5), (["id", "x"], 3)])
def test_counts_with_and_without_texts(spark, columns, filled):
    df = spark.createDataFrame(ROWS, "id int, note string, x double").select(*columns)
    assert tuple(run_metrics(df).first()) == (6, 4, 2, filled, 66.67)
    assert tuple(run_metrics(df.limit(0)).first()) == (0, 0, 0, 0, None)
