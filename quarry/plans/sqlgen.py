"""Helpers that write the oracle SQL for per-column (long-form) metrics."""

from __future__ import annotations

from collections.abc import Sequence

from .fixtures import DIRTY_CTE

DIRTY_COLUMNS = ["id", "cust", "status", "priority", "amount", "age", "date_text"]
DIRTY_NUMERIC = ["id", "cust", "amount", "age"]
DIRTY_DOUBLE = ["amount"]


def with_dirty(body: str) -> str:
    return f"WITH {DIRTY_CTE}\n{body}"


def missing_sql(c: str, doubles: Sequence[str] = ()) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in doubles else f"({c} IS NULL)"


def union_per_column(cols: Sequence[str], select_tpl: str) -> str:
    """``select_tpl`` uses ``{c}`` for the column; each branch adds column_name."""
    parts = [f"SELECT '{c}' AS column_name, " + select_tpl.format(c=c) for c in cols]
    return "\nUNION ALL\n".join(parts)


def ten_thousandths_sql(part: str, whole: str = "count(*)") -> str:
    """The quality metrics' rounding: to the nearest ten-thousandth, ties up,
    in integers."""
    return f"((20000 * ({part}) + {whole}) // (2 * {whole}))"


def iqr_sql(table: str, cols: Sequence[str], factor: float = 1.5) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS outliers FROM {table}, "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table} "
            f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))) q "
            f"WHERE {c} < q1 - {factor} * (q3 - q1) OR {c} > q3 + {factor} * (q3 - q1) HAVING count(*) > 0")
    return "\nUNION ALL\n".join(parts)
