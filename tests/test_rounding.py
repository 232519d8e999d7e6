"""Quality metrics round from the counts: ties, and keys of wide rows."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quarry.operators import quality as Q


def up(part, whole):
    """Nearest ten-thousandth, ties up, by exact fractions."""
    return (2 * Fraction(part, whole) * 10_000 + 1) // 2 / 10_000


# 3/60000 and 9/60000 are ties whose binary and decimal forms disagree
COUNTS = [1, 2, 3, 9, 15, 21, 27, 33, 39, 45, 59_997, 60_000]


def test_ties_follow_the_counts(spark):
    n = 60_000
    df = spark.range(n).select(*[(F.col("id") % k).alias(f"d{k}") for k in COUNTS],
                               *[F.when(F.col("id") >= k, F.col("id")).alias(f"m{k}") for k in COUNTS])
    unique = {r[0]: r[1] for r in Q.uniqueness(df).collect()}
    complete = {r[0]: r[1] for r in Q.completeness(df).collect()}
    for k in COUNTS:
        assert unique[f"d{k}"] == up(k, n) and unique[f"m{k}"] == up(n - k, n)
        assert complete[f"m{k}"] == up(n - k, n) and complete[f"d{k}"] == 1.0


def test_ties_match_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from quarry.plans.sqlgen import ten_thousandths_sql
    pairs = [(k, n) for n in (3, 7, 16, 60_000, 999_999) for k in range(0, n + 1, max(1, n // 97))]
    df = spark.createDataFrame(pairs, "k long, n long")
    got = [r[0] for r in df.select(Q.ten_thousandths(F.col("k"), F.col("n"))).collect()]
    assert got == [duckdb.execute(f"SELECT {ten_thousandths_sql(f"{k}::BIGINT", f"{n}::BIGINT")}").fetchall()[0][0] for k, n in pairs]
    assert [g / 10_000 for g in got] == [up(k, n) for k, n in pairs]


def test_score_ties(spark):
    # sums of ten-thousandths of 8 columns whose score is a tie at one decimal
    rows = spark.createDataFrame([(c, u, d, o) for c in (80_000, 79_975, 12_345) for u in (100, 150, 4_075) for d in (0, 3) for o in (0, 7)],
                                 "c long, u long, d long, o long")
    got = rows.select("*", Q.quality_score_expr(F.col("c"), F.col("u"), 8, F.col("d"), F.col("o")).alias("s")).collect()
    for r in got:
        exact = Fraction(40 * r.c + 20 * r.u, 80_000) + max(0, 20 - 2 * r.d) + max(0, 20 - r.o)
        assert r.s == (20 * exact + 1) // 2 / 10


def test_empty_and_wide_rows(spark):
    df = spark.createDataFrame([("a", None, [1.0]), (None, "a", [1.0]), ("a", None, [1.0]), ("", "", []), ("", "", None), ("ab", "c", None), ("a", "bc", None)],
                               "x string, y string, v array<double>")
    assert Q.duplicate_rows(df).first()[0] == 1
    assert sorted(r[0] for r in Q.duplicate_groups(df).select("_n").collect()) == [1, 1, 1, 1, 1, 2]
    assert Q.duplicate_rows(df.limit(0)).first()[0] == 0
    assert {r[1] for r in Q.uniqueness(df.limit(0)).collect()} == {1.0}
    assert {r[1] for r in Q.completeness(df.limit(0)).collect()} == {None}
    assert Q.quality_summary(df.select("x", "y").limit(0)).first()["status"] == "empty"
