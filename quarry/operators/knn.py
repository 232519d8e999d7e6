"""Exact k-nearest-neighbour imputation without pairing all rows.

Distances use the one feature present on both sides (nan-euclidean
distance over co-present coordinates reduces to |dx| times a constant, so
the ranking is by |dx|).  Donors sorted by the feature hold every
receiver's k nearest within the k donors just before it in the order
``(x asc, receiver after donor, donor id desc)`` and the k donors just after
it in ``(x asc, receiver after donor, donor id asc)``: reading either side
outward from the receiver visits donors by (distance, donor id).  Ranks come
from distributed prefix counts, and the 2k candidates are fetched with an
equi-join on donor rank, so the work is O(n log n + receivers * k) and no
group or cross product is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number
from ..session import reliable_checkpoint, ship_code
from .joins import size_checked
from .ranking import group_positions, prefix_sums

#: Cells of a distance matrix that a task holds at once.
_CELLS = 4_000_000


def _ranked(both: DataFrame, id_desc: bool) -> DataFrame:
    order = [F.col("_x").asc(), F.col("_recv").asc(), F.col("_id").desc() if id_desc else F.col("_id").asc()]
    return prefix_sums(both, order, ["_donor"], suffix="_before", inclusive=False)


def knn_impute_1d(df: DataFrame, target: str, feature: str, id_col: str, k: int = 5,
                  out: str | None = None) -> DataFrame:
    """Fill ``target`` where missing with the mean ``target`` of the k donors
    nearest in ``feature`` (ties by donor id); a receiver without ``feature``
    gets the donors' mean.  Adds nothing else; ``out`` defaults to
    ``target`` (as double, like the matrix-based imputer)."""
    out = out or target
    x = F.col(feature).cast("double")
    y = F.col(target).cast("double")
    present_y = y.isNotNull() & ~F.isnan(y)
    present_x = x.isNotNull() & ~F.isnan(x)
    base = df.select(F.col(id_col).alias("_id"), x.alias("_x"), y.alias("_y"),
                     present_y.alias("_has_y"), present_x.alias("_has_x"))
    both = base.where(F.col("_has_x")).select(
        "_id", "_x", "_y", (~F.col("_has_y")).cast("int").alias("_recv"), F.col("_has_y").cast("int").alias("_donor"))
    sides = []
    for id_desc, lo, hi in ((True, -k, -1), (False, 0, k - 1)):
        r = _ranked(both, id_desc)
        donors = r.where("_donor = 1").select(F.col("_donor_before").alias("_rank"), F.col("_id").alias("_did"),
                                              F.col("_x").alias("_dx"), F.col("_y").alias("_dy"))
        recv = r.where("_recv = 1").select("_id", "_x", F.explode(F.sequence(
            F.col("_donor_before") + lo, F.col("_donor_before") + hi)).alias("_rank"))
        sides.append(recv.join(donors, "_rank"))
    cand = sides[0].unionByName(sides[1])
    w = Window.partitionBy("_id").orderBy(F.abs(F.col("_x") - F.col("_dx")), F.col("_did"))
    nearest = (cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
               .groupBy("_id").agg(F.avg("_dy").alias("_knn")))
    fallback = df.agg(F.avg(y).alias("_m")).first()["_m"]
    nearest = size_checked(nearest)  # one row per receiver
    j = df.join(nearest, df[id_col] == nearest["_id"], "left")
    filled = F.when(present_y, y).otherwise(F.coalesce(F.col("_knn"), F.lit(fallback)))
    return j.select(*[filled.alias(out) if c == target else F.col(c) for c in df.columns])


def _tile_neighbours(n_features: int, k: int):
    """Of a tile's donors, the k nearest of each receiver, by column to fill."""
    def run(receivers, donors):
        import pandas as pd
        found: dict[str, list] = {c: [] for c in ("_id", "_c", "_d", "_did", "_y")}
        if len(receivers) and len(donors):
            donors = donors.sort_values("_did", kind="stable")
            there = np.stack(donors["_x"].to_numpy()).astype(float)
            names = donors["_did"].to_numpy()
            step = max(1, _CELLS // len(donors))
            for a in range(0, len(receivers), step):
                part = receivers.iloc[a:a + step]
                here = np.stack(part["_x"].to_numpy()).astype(float)
                total, shared = np.zeros((len(here), len(there))), np.zeros((len(here), len(there)))
                for j in range(n_features):
                    gap = here[:, j, None] - there[None, :, j]
                    known = ~np.isnan(gap)
                    total += np.where(known, gap * gap, 0)
                    shared += known
                with np.errstate(divide="ignore", invalid="ignore"):
                    far = np.sqrt(n_features / shared * total)
                far[shared == 0] = np.inf
                for c in range(n_features):
                    rows = np.flatnonzero(np.isnan(here[:, c]))
                    cols = np.flatnonzero(~np.isnan(there[:, c]))
                    if not len(rows) or not len(cols):
                        continue
                    d = far[np.ix_(rows, cols)]
                    order = np.argsort(d, axis=1, kind="stable")[:, :k]  # donors come by id: ties by id
                    near = np.take_along_axis(d, order, axis=1)
                    at, slot = np.nonzero(np.isfinite(near))
                    pick = cols[order[at, slot]]
                    found["_id"].append(part["_id"].to_numpy()[rows[at]])
                    found["_c"].append(np.full(len(at), c))
                    found["_d"].append(near[at, slot])
                    found["_did"].append(names[pick])
                    found["_y"].append(there[pick, c])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in found.items()})
    return run


#: Boxes of donors whose bounds every receiver is compared with, and sets of
#: known columns that get boxes of their own.
_BOXES, _PATTERNS = 16_384, 256

#: Rows of tiles (and of neighbours found there) that a task gets, about.
_TASK_ROWS = 400_000


def _places(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The place of a row's ``_x`` on a space-filling curve: the bits of the
    columns' quantile bins, interleaved.  Missing values count as bin 0; as
    many columns take part as fit a long."""
    n = min(len(columns), 60 // bits)
    steps = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(F.get("_x", F.lit(i)), steps, 1000) for i in range(n)]).first()  # 63 numbers a column
    key = F.lit(0).cast("long")
    for i in range(n):
        marks = F.array(*[F.lit(float(m)) for m in sorted(set(cuts[i] or []))]).cast("array<double>")
        code = F.size(F.filter(marks, lambda m: m < F.get("_x", F.lit(i)))).cast("long")
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(code, b).bitwiseAND(F.lit(1).cast("long")), b * n + i))
    return key


@dataclass
class _Boxes:
    """Donors by boxes: rows, least and greatest value of each column and one
    donor, the ``pin``; a column that a box's donors lack is NaN.  ``loose``
    boxes hold donors with different sets of known columns: they have no
    bounds."""

    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    pin: np.ndarray
    loose: np.ndarray

    def visits(self, x: np.ndarray, k: int) -> np.ndarray:
        """Which boxes may hold one of a receiver's k nearest donors for a
        column it lacks: (receivers, boxes).

        Over the columns that both sides know, a donor is no nearer than its
        box and no farther than the box's far corner.  The far corners of
        boxes with k donors bound the k-th distance, and so do the k nearest
        pins, which are donors themselves."""
        below, above, shared, apart, common = np.zeros((5, len(x), len(self.rows)))
        for j in range(x.shape[1]):
            v = x[:, j, None]
            both = ~np.isnan(v) & ~np.isnan(self.low[None, :, j])
            under, over = self.low[None, :, j] - v, v - self.high[None, :, j]
            below += np.where(both, np.maximum(0, np.maximum(under, over)) ** 2, 0)
            above += np.where(both, np.maximum(np.abs(under), np.abs(over)) ** 2, 0)
            shared += both
            gap = self.pin[None, :, j] - v
            apart += np.where(np.isnan(gap), 0, gap * gap)
            common += ~np.isnan(gap)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = x.shape[1] / shared
            near, far = np.where(shared > 0, below * scale, np.inf), np.where(shared > 0, above * scale, np.inf)
            pins = np.where(common > 0, apart * (x.shape[1] / common), np.inf)
        near[:, self.loose], far[:, self.loose] = 0, np.inf
        out = np.zeros(shared.shape, bool)
        for c in range(x.shape[1]):
            has, pinned = np.flatnonzero(~np.isnan(self.low[:, c]) | self.loose), np.flatnonzero(~np.isnan(self.pin[:, c]))
            rows = np.flatnonzero(np.isnan(x[:, c]))
            if not len(rows) or not len(has):
                continue
            reach, least = far[np.ix_(rows, has)], near[np.ix_(rows, has)]
            some = min(k, len(has))  # every box has a row: k boxes are enough
            order = np.argpartition(reach, some - 1, axis=1)[:, :some]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(reach, order, axis=1), axis=1, kind="stable"), axis=1)
            reach = np.take_along_axis(reach, order, axis=1)
            enough = np.cumsum(self.rows[has][order], axis=1) >= k
            bound = np.where(enough.any(1), reach[np.arange(len(rows)), enough.argmax(1)], np.inf)
            if len(pinned) >= k:
                bound = np.minimum(bound, np.partition(pins[np.ix_(rows, pinned)], k - 1, axis=1)[:, k - 1])
            out[np.ix_(rows, has)] |= (least <= bound[:, None] * (1 + 1e-9)) & np.isfinite(least)
        return out


def donor_visits(df: DataFrame, columns: Sequence[str], id_col: str, k: int = 5, block_rows: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """Receivers and donors, dealt to the tiles ``_p, _b, _s`` in which they meet.

    Donors that know the same columns are sorted along a space-filling curve
    and cut into boxes; a receiver goes to the boxes that may hold one of its
    nearest donors, and a box goes to the parts of receivers that visit it.
    A box of more than ``block_rows`` rows is cut into slices ``_s``, so tiles
    do not grow with the data.  Both are dealt by tile to so many tasks that
    a task's rows do not grow either, however well the rows compress."""
    return _visits(df, columns, id_col, k, block_rows)[:2]


def _visits(df: DataFrame, columns: Sequence[str], id_col: str, k: int, block_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """:func:`donor_visits`, and the number of tasks that the tiles are dealt to."""
    ship_code()
    columns = list(columns)
    kind = df.schema[id_col].dataType.simpleString()
    base = df.select(F.col(id_col).alias("_id"), F.array(*[number(c).cast("double") for c in columns]).alias("_x"))
    known = F.concat(*[F.when(F.get("_x", F.lit(i)).isNotNull(), F.lit("1")).otherwise(F.lit("0")) for i in range(len(columns))])
    base = reliable_checkpoint(base.withColumn("_k", known))
    base = base.withColumn("_z", _places(base, columns))
    full, none = "1" * len(columns), "0" * len(columns)
    often = [r["_k"] for r in base.where(F.col("_k") != none).groupBy("_k").count().orderBy(F.desc("count"), "_k").limit(_PATTERNS - 1).collect()]
    donors = base.where(F.col("_k") != none).withColumn("_g", F.when(F.col("_k").isin(often), F.col("_k")).otherwise(F.lit("")))
    donors = reliable_checkpoint(group_positions(donors, ["_g"], ["_z", "_id"]))
    n = donors.count()
    box_rows = max(block_rows, -(-n // (_BOXES - _PATTERNS)))
    slices = -(-box_rows // block_rows)
    donors = donors.withColumn("_b", F.concat_ws(":", "_g", F.floor(F.col("_pos") / box_rows)))
    cells = [F.get("_x", F.lit(i)) for i in range(len(columns))]
    table = donors.groupBy("_b", "_g").agg(F.count(F.lit(1)).alias("rows"), F.min_by("_x", "_pos").alias("pin"),
                                          *[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(cells) for f in (F.min, F.max)])
    got = table.toPandas()  # _BOXES rows at most
    edge = lambda f: np.array([got[f"{f}{i}"].to_numpy(float) for i in range(len(columns))]).T.reshape(len(got), len(columns))
    pin = np.array([np.array(v, float) for v in got["pin"]]).reshape(len(got), len(columns))
    boxes = _Boxes(got["rows"].to_numpy(), edge("min"), edge("max"), pin, (got["_g"] == "").to_numpy(bool))
    spark = df.sparkSession
    marks = spark.createDataFrame([(b, i) for i, b in enumerate(got["_b"])], "_b string, _bn int")
    donors = donors.join(F.broadcast(marks), "_b").select("_id", "_x", "_pos", F.col("_bn").alias("_b"))

    receivers = group_positions(base.where(F.col("_k") != full), [], ["_k", "_z", "_id"], size_col=None)
    receivers = reliable_checkpoint(receivers.select("_id", "_x", F.floor(F.col("_pos") / (4 * block_rows)).cast("int").alias("_p")))

    def visit(batches):
        import pandas as pd
        for pdf in batches:
            step = max(1, _CELLS // max(1, len(boxes.rows)))
            for a in range(0, len(pdf), step):
                part = pdf.iloc[a:a + step]
                seen = boxes.visits(np.stack(part["_x"].to_numpy()).astype(float), k)
                yield part.assign(_bs=[np.flatnonzero(v).astype(np.int32) for v in seen])

    # a row a receiver, with its boxes; dealt to all cores, as each meets every bound
    tasks = max(spark.sparkContext.defaultParallelism, -(-receivers.count() // 10_000))
    seen = reliable_checkpoint(receivers.repartition(tasks).mapInPandas(visit, f"_id {kind}, _x array<double>, _p int, _bs array<int>"))
    left = seen.select("_id", "_x", "_p", F.explode("_bs").alias("_b"))
    pairs = size_checked(left.select(F.col("_p").alias("_tp"), F.col("_b").alias("_tb")).distinct())
    right = donors.join(pairs, F.col("_b") == F.col("_tb")).select(
        F.col("_id").alias("_did"), "_x", F.col("_tp").alias("_p"), "_b", F.pmod(F.col("_pos"), F.lit(slices)).cast("int").alias("_s"))
    left = left.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    met = seen.agg(F.sum(F.size("_bs").cast("long"))).first()[0] or 0
    sent = pairs.join(F.broadcast(spark.createDataFrame([(i, int(r)) for i, r in enumerate(got["rows"])], "_tb int, _r long")), "_tb").agg(F.sum("_r")).first()[0] or 0
    dealt = max(spark.sparkContext.defaultParallelism, -(-(met * slices * k + sent) // _TASK_ROWS))
    return left.repartition(dealt, "_p", "_b", "_s"), right.repartition(dealt, "_p", "_b", "_s"), dealt


def knn_impute(df: DataFrame, columns: Sequence[str], id_col: str, k: int = 5, block_rows: int = 2_000) -> DataFrame:
    """Fill every missing value of ``columns`` with the mean of that column
    over the k nearest rows that have it (E10, several features).

    The distance is nan-euclidean: over the coordinates that both rows have,
    scaled up by all over shared ones; ties go by id.  A row that shares no
    coordinate with any donor gets the column's mean.  ``columns`` come back
    as doubles; ``id_col`` must be unique.

    Exact: a receiver meets only the boxes of donors whose bound, for the
    columns known on both sides, is within that of its k-th neighbour
    (:func:`donor_visits`); in a tile numpy computes exact distances a slab at
    a time and keeps k donors a row and column."""
    columns = list(columns)
    kind = df.schema[id_col].dataType.simpleString()
    left, right, dealt = _visits(df, columns, id_col, k, block_rows)
    tile = ["_p", "_b", "_s"]
    near = (left.groupBy(*tile).cogroup(right.groupBy(*tile))
            .applyInPandas(_tile_neighbours(len(columns), k), f"_id {kind}, _c int, _d double, _did {kind}, _y double")
            .repartition(dealt, "_id", "_c"))
    rank = Window.partitionBy("_id", "_c").orderBy("_d", "_did")
    means = near.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= k).groupBy("_id", "_c").agg(F.avg("_y").alias("_m"))
    filled = means.groupBy(F.col("_id").alias("_fid")).agg(F.map_from_entries(F.collect_list(F.struct("_c", "_m"))).alias("_f"))
    whole = df.agg(*[F.avg(number(c).cast("double")) for c in columns]).first()
    out = df.join(filled, F.col(id_col) == F.col("_fid"), "left")
    value = {c: F.coalesce(number(c).cast("double"), F.element_at("_f", F.lit(i)), F.lit(whole[i]).cast("double"))
             for i, c in enumerate(columns)}
    return out.select(*[value[c].alias(c) if c in value else F.col(c) for c in df.columns])
