"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target size by weight.  Within a source a document's
expected number of copies is ``min(cap, c * measure)``, with ``c`` chosen so
that the expected size meets the target.  Its whole part is allocated for
certain; the fraction ``p`` is the inclusion probability of one more copy.
For those, documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and taken in rank order up to the size
that is left (Pareto order sampling with a fixed size).  A document that
exceeds what is left is passed over, and smaller ones after it still come.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import size_checked
from ..operators.ranking import prefix_sums
from .common import col, materialise, row_struct, space_words

#: 2 to the power of 52: the uniforms are odd multiples of half its inverse.
GRID = 4503599627370496.0


def word_count(text: Column) -> Column:
    return F.size(space_words(text)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A reproducible uniform number in (0, 1) from the md5 of seed and key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / GRID


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``skey, source, source_size, target`` from ``skey, source, source_size``.

    Sources by code point, null last, take the weights in turn.  Targets are
    ``min(cap * size, level * weight)``; the level is the one at which they
    add up to ``share`` of all sizes, which is what resharing the excess by
    weight until no target is above its cap ends at.  The windows run over
    one row per source."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("weight", F.element_at(listed, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    rows = rows.withColumn("full_at", cap * F.col("source_size") / F.col("weight"))
    everything, nothing = Window.partitionBy(F.lit(0)), F.lit(0.0)
    filled = Window.partitionBy(F.lit(0)).orderBy("full_at", "skey").rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(filled), nothing)
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), nothing)
    rows = rows.withColumn("level", left / open_weight)
    level = F.max("level").over(everything)
    return rows.select("skey", "source", "source_size",
                       F.least(cap * F.col("source_size"), level * F.col("weight")).alias("target"))


def copies_per_measure(levels: DataFrame, cap: float) -> DataFrame:
    """Adds ``c`` to ``skey, measure, size, target``: the expected copies of
    one unit of measure, so that copies of at most ``cap`` meet the target.
    The windows run over one row per measure of a source."""
    whole = Window.partitionBy("skey")
    filled = whole.orderBy(F.desc("measure")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("target") - F.coalesce(F.sum(cap * F.col("size")).over(filled), F.lit(0.0))
    mass = F.sum(F.col("size") * F.col("measure")).over(whole) - F.coalesce(
        F.sum(F.col("size") * F.col("measure")).over(filled), F.lit(0))
    rows = levels.withColumn("c", F.when(mass > 0, left / mass))
    return rows.withColumn("c", F.coalesce(F.max("c").over(whole), F.lit(0.0)))


def further_fits(later: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``uid, skey`` of the documents that still fit when the rank order is gone down
    to its end, and the gaps after them, from ``skey, uid, size, upto`` of the
    documents not taken and ``skey, gap``.

    A round takes, per source, the documents that fit singly up to the first
    that no longer fits; what it passes over is larger than the gap from then
    on.  Every round narrows the gap of each source that it has rows of, and
    the rounds end when no document fits."""
    found, left = [], later.where("size > 0")
    while True:
        fits = left.join(gaps, "skey").where("size <= gap")
        sums = materialise(prefix_sums(fits, ["skey", "upto"], ["size"]), "mix-fits")
        if sums.isEmpty():
            break
        start = size_checked(sums.groupBy("skey").agg(F.min(F.col("size_cum") - F.col("size")).alias("start")))
        run = F.col("size_cum") - F.col("start")
        rows = sums.join(start, "skey")
        found.append(rows.where(run <= F.col("gap")).select("uid", "skey"))
        got = rows.where(run <= F.col("gap")).groupBy("skey").agg(F.max(run).alias("got"))
        gaps = size_checked(gaps.join(got, "skey", "left").select("skey", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")))
        left = rows.where(run > F.col("gap")).select("skey", "uid", "size", "upto")
    if not found:
        return later.select("uid", "skey").limit(0), gaps
    return materialise(reduce(DataFrame.unionByName, found), "mix-further"), gaps


def nearest_singles(rest: DataFrame, gaps: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """``uid, skey`` of up to ``rounds`` documents per source whose size is
    nearest to its gap, if that narrows it, and the gaps after them."""
    found = rest.select("uid", "skey").limit(0)
    for _ in range(rounds):
        off = F.abs(F.col("size") - F.col("gap"))
        near = (rest.join(gaps, "skey").where(off < F.abs("gap")).groupBy("skey")
                .agg(F.min_by(F.struct("uid", "size"), F.struct(off, F.col("q"), F.col("upto"))).alias("one")))
        near = size_checked(near.select("skey", "one.uid", "one.size"))
        found = found.unionByName(near.select("uid", "skey"))
        gaps = size_checked(gaps.join(near.select("skey", F.col("size").alias("got")), "skey", "left")
                            .select("skey", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")))
        rest = rest.join(near.select("uid"), "uid", "left_anti")
    return found, gaps


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, measure: Column | None = None,
        seed: int = 17, fill_rounds: int = 2, carry: bool = False,
        descend: bool = True) -> DataFrame:
    """Documents with the number of copies that a mix takes of each.

    Returns one row per input row: ``id, size`` (words), ``source_size``,
    ``target`` (its source's), ``copies`` and ``taken`` (``size * copies``);
    with ``carry`` also ``row``, the whole input row.  ``measure`` is a
    small positive integer per document (default: 2 from 50 words on, else
    1, so that short fragments have half the odds); it may be built from the
    columns ``id``, ``size`` and ``source``.

    Sampling goes down the rank order and passes over documents that exceed
    the size that is left; then up to ``fill_rounds`` single documents whose
    size is nearest to the remaining gap are added, if that narrows it.
    Without ``descend``, and in sources whose target it does not come nearer
    to, sampling ends at the first document that exceeds it.

    A null text has size 0; documents of size 0 are sampled like others but
    count nothing, and none is taken after the first one passed over.  A null source is a source of its own, the last.  Null or
    equal ids share their random number; ties go by size and then at will
    among rows that are alike.  The words of a very long text are counted
    whole, in its row, and sampling passes over it where it does not fit.  A source of size 0 has target 0.  An empty
    table gives no rows.  Only the named columns are looked at.
    """
    source = col(source_col)
    fields = [col(id_col).alias("id"), word_count(col(text_col)).alias("size"), source.alias("source"),
              F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")).alias("skey")]
    base = docs.select(*fields, *([row_struct(docs)] if carry else []))
    level = measure if measure is not None else F.when(F.col("size") >= 50, 2).otherwise(1)
    # the row number is fixed by being written; it only tells rows apart that are alike
    base = base.withColumn("measure", level.cast("int")).withColumn("u", uniform(F.col("id"), seed))
    base = materialise(base.withColumn("uid", F.monotonically_increasing_id()), "mix")
    levels = base.groupBy("skey", "measure").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("size"))
    sources = levels.groupBy("skey").agg(F.first("source", ignorenulls=True).alias("source"),
                                         F.sum("size").alias("source_size"))
    targets = size_checked(source_targets(sources, weights, share, cap))
    plan = copies_per_measure(levels.drop("source").join(targets.drop("source"), "skey"), cap)
    plan = plan.withColumn("expected", F.least(F.lit(cap), F.col("c") * F.col("measure")))
    plan = plan.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    plan = size_checked(plan.select("skey", "measure", "source_size", "target", "whole", "p", F.col("size").alias("level_size")))
    left = plan.groupBy("skey").agg((F.first("target") - F.sum(F.col("whole") * F.col("level_size"))).alias("left"))

    # rank the documents that have a fraction, with running sizes per source
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = (base.select("uid", "id", "size", "skey", "measure", "u").join(plan.select("skey", "measure", "p"), ["skey", "measure"])
              .where("p > 0").select("uid", "skey", "id", "size", odds.alias("q")))
    sums = materialise(prefix_sums(ranked, ["skey", "q", "id", "size"], ["size"]), "mix-rank")
    start = sums.groupBy("skey").agg(F.min(F.col("size_cum") - F.col("size")).alias("start"))
    state = size_checked(left.join(start, "skey"))
    order = sums.join(state, "skey").withColumn("upto", F.col("size_cum") - F.col("start"))
    inside = F.col("upto") <= F.col("left")
    chosen = order.where(inside).select("uid")
    gaps = size_checked(order.groupBy("skey").agg((F.first("left") - F.coalesce(
        F.max(F.when(inside, F.col("upto"))), F.lit(0))).alias("gap")))
    rest = order.where(~inside).select("uid", "skey", "size", "q", "upto")
    singles, ends = nearest_singles(rest, gaps, fill_rounds)
    if descend:
        # go on down the order, except where the singles alone come nearer
        further, deeper = further_fits(rest.drop("q"), gaps)
        last, deeper = nearest_singles(rest.join(further, "uid", "left_anti"), deeper, fill_rounds)
        both = ends.join(deeper.withColumnRenamed("gap", "deep"), "skey")
        nearer = size_checked(both.select("skey", (F.abs("deep") <= F.abs("gap")).alias("down")))
        more = [further.withColumn("way", F.lit(True)), last.withColumn("way", F.lit(True)), singles.withColumn("way", F.lit(False))]
        singles = reduce(DataFrame.unionByName, more).join(nearer, "skey").where("way = down")
    chosen = chosen.unionByName(singles.select("uid"))
    rows = base.join(plan, ["skey", "measure"]).join(chosen.withColumn("more", F.lit(1)), "uid", "left")
    out = rows.withColumn("copies", (F.col("whole") + F.coalesce("more", F.lit(0))).cast("long"))
    return out.select(*(["row"] if carry else []), "id", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))
