"""Exact and approximate quantiles, optionally per group, for many columns.

Exact mode refines brackets instead of sorting columns:

1. One aggregate over the table gives, per group and column, the count of
   present values (NULL and NaN are missing, as in pandas) and, from
   ``percentile_approx`` a little below and above each probability, a
   bracket around the wanted order statistics.
2. One more pass counts the values below each bracket, and counts the values
   inside it by value: both combine map-side, so a hot group or a hot value
   moves one row a task.  Only the distinct values inside a bracket, about
   ``6 / accuracy`` of a group's values, are ordered.
3. The values at ranks ``floor/ceil(p*(n-1))`` are read off the running
   counts and interpolated linearly, as ``quantile_cont`` / pandas
   ``quantile`` do.  A bracket that misses a rank (small groups, where the
   approximation's rank unit is coarser than the margin) is found by its
   counts and widened to the whole group for a second round.

Approximate mode uses ``percentile_approx`` (bounded sketch per group,
partial aggregation) and returns an actual element, not an interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number
from ..session import reliable_checkpoint

def _value(c: str) -> Column:
    return number(f"`{c}`").cast("double")


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), method: str = "exact",
              accuracy: int = 10000) -> DataFrame:
    """Quantiles in long form: ``by..., column_name, prob, value``.

    Groups (or columns) with no present value produce no row.
    """
    columns, by, probs = list(columns), list(by), [float(p) for p in probs]
    if not columns:
        raise ValueError("quantiles needs at least one column")
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method {method!r}")
    keys = [f"_k{i}" for i in range(len(by))]  # clear of the columns' own names
    base = df.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)],
                     *[_value(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    marks = probs if method == "approx" else [x for p in probs for x in (max(0.0, p - 3 / accuracy), min(1.0, p + 3 / accuracy))]
    aggs = []
    for i in range(len(columns)):
        aggs += [F.count(f"_v{i}").alias(f"_n{i}"), F.min(f"_v{i}").alias(f"_lo{i}"), F.max(f"_v{i}").alias(f"_hi{i}"),
                 F.percentile_approx(f"_v{i}", F.array(*[F.lit(m) for m in marks]), F.lit(accuracy)).alias(f"_q{i}")]
    rough = base.groupBy(*keys).agg(*aggs)
    name_of, prob_of = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(p) for p in probs])
    final = [*[F.col(k).alias(b) for k, b in zip(keys, by)], F.get(name_of, F.col("_i")).alias("column_name"),
             F.get(prob_of, F.col("_j")).alias("prob")]
    cells = []
    for i in range(len(columns)):
        for j, p in enumerate(probs):
            q = F.col(f"_q{i}")
            if method == "approx":
                cells.append(F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), F.get(q, F.lit(j)).alias("value")))
                continue
            low = F.col(f"_lo{i}") if marks[2 * j] == 0 else F.get(q, F.lit(2 * j))
            high = F.col(f"_hi{i}") if marks[2 * j + 1] == 1 else F.get(q, F.lit(2 * j + 1))
            cells.append(F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), (F.lit(p) * (F.col(f"_n{i}") - 1)).alias("_pos"),
                                  low.alias("_from"), high.alias("_to"), F.col(f"_lo{i}").alias("_least"), F.col(f"_hi{i}").alias("_most")))
    if method == "approx":
        return rough.select(*keys, F.inline(F.array(*cells))).where("value IS NOT NULL").select(*final, "value")

    targets = reliable_checkpoint(rough.select(*keys, F.inline(F.array(*cells))).where("_from IS NOT NULL"))
    found = reliable_checkpoint(_order_statistics(base, targets, keys, len(columns)))
    # beside each target row, so that a bracket without any value shows, too
    missed = targets.join(found.where("_ok").select(*_named(keys, "_f"), F.col("_i").alias("_fi"), F.col("_j").alias("_fj")),
                          _same(keys, "_f") & (F.col("_i") == F.col("_fi")) & (F.col("_j") == F.col("_fj")), "left_anti")
    if missed.head(1):
        wide = missed.withColumn("_from", F.col("_least")).withColumn("_to", F.col("_most"))
        found = found.where("_ok").unionByName(_order_statistics(base, reliable_checkpoint(wide), keys, len(columns)))
    part = F.col("_pos") - F.floor("_pos")
    value = F.when(F.col("_b") == F.col("_a"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * part)
    return found.where("_ok").select(*final, value.alias("value"))


def _named(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(k).alias(prefix + k) for k in keys]


def _same(keys: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def _order_statistics(base: DataFrame, targets: DataFrame, keys: list[str], n_columns: int) -> DataFrame:
    """``keys, _i, _j, _pos, _a, _b, _ok``: the values at the ranks around
    ``_pos``, if the target's bracket holds both."""
    from .joins import size_checked
    below = F.lit(float("-inf"))
    if keys:
        # a row per group with its brackets, joined to the group's rows
        bracket = F.struct("_i", "_j", "_from", "_to")  # columns x probabilities a group
        per_group = targets.groupBy(*keys).agg(F.collect_list(bracket).alias("_t")).select(*_named(keys, "_g"), "_t")
        values = F.array(*[F.col(f"_v{i}") for i in range(n_columns)])
        at = F.transform("_t", lambda t: F.struct(t["_i"].alias("_i"), t["_j"].alias("_j"), F.when(
            F.get(values, t["_i"]) < t["_from"], below).otherwise(F.get(values, t["_i"])).alias("_v"), t["_to"].alias("_to")))
        cells = (base.join(size_checked(per_group), _same(keys, "_g"))
                 .select(*keys, F.inline(F.filter(at, lambda t: t["_v"] <= t["_to"]))))
    else:
        stored = targets.select("_i", "_j", "_from", "_to").collect()  # columns x probabilities
        at = [F.struct(F.lit(r["_i"]).alias("_i"), F.lit(r["_j"]).alias("_j"), F.when(F.col(f"_v{r['_i']}") < r["_from"], below).when(
            F.col(f"_v{r['_i']}") <= r["_to"], F.col(f"_v{r['_i']}")).alias("_v")) for r in stored]
        cells = base.select(F.inline(F.array(*at).cast("array<struct<_i:int,_j:int,_v:double>>"))).where("_v IS NOT NULL")
    counted = cells.groupBy(*keys, "_i", "_j", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # a bracket may start at a value of minus infinity itself: then nothing is below it
    upto = Window.partitionBy(*keys, "_i", "_j").orderBy("_v")
    ranked = counted.withColumn("_end", F.sum("_n").over(upto)).withColumn("_start", F.col("_end") - F.col("_n"))
    goal = targets.select(*_named(keys, "_g"), F.col("_i").alias("_gi"), F.col("_j").alias("_gj"), "_pos", "_from")
    joined = ranked.join(goal, _same(keys, "_g") & (F.col("_i") == F.col("_gi")) & (F.col("_j") == F.col("_gj")))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")) & (F.col("_v") >= F.col("_from")), F.col("_v")))

    out = joined.groupBy(*keys, "_i", "_j").agg(F.first("_pos").alias("_pos"), at_rank(F.floor("_pos")).alias("_a"),
                                                at_rank(F.ceil("_pos")).alias("_b"))
    return out.withColumn("_ok", F.col("_a").isNotNull() & F.col("_b").isNotNull())


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   by: Sequence[str] = (), method: str = "exact", names=None) -> DataFrame:
    """Wide form: one row per ``(by..., column)`` with one column per prob.

    ``names`` maps each prob to an output column name (default ``q<prob>``).
    """
    names = list(names) if names else [f"q{p}" for p in probs]
    long = quantiles(df, columns, probs, by, method)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("value"))).alias(n)
            for p, n in zip(probs, names)]
    return long.groupBy(*by, "column_name").agg(*aggs)


def fit_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                  method: str = "exact") -> dict[str, dict[float, float]]:
    """Whole-table quantiles as small driver values: ``{column: {p: v}}``.

    The collected result has ``len(columns) * len(probs)`` rows at most.
    """
    out: dict[str, dict[float, float]] = {c: {} for c in columns}
    if not columns:
        return out
    for r in quantiles(df, columns, probs, (), method).collect():
        out[r["column_name"]][float(r["prob"])] = r["value"]
    return out


def fit_medians(df: DataFrame, columns: Sequence[str], method: str = "exact") -> dict[str, float | None]:
    q = fit_quantiles(df, columns, [0.5], method)
    return {c: q[c].get(0.5) for c in columns}
