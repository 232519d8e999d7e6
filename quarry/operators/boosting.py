"""Second-order gradient boosting over distributed histograms.

Values are cut into quantile bins once.  A level of a tree costs one job:
every task sums gradients and Hessians of its rows by node, feature and bin,
and the sums are combined by those keys; only they reach the driver (nodes x
features x bins, set by the parameters), which picks the splits.  A missing
value goes to the side where it lowers the loss more.  Trees are arrays, and a
DataFrame of arrays on demand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import number
from ..session import reliable_checkpoint, ship_code

#: Rows of a batch that a task handles at once.
_ROWS = 50_000


@dataclass
class BoostedTrees:
    """``feature`` (-1: leaf), ``bin`` and ``threshold`` (right if above),
    ``missing_right``, ``value`` and ``gain`` have shape (trees, nodes);
    children of node i are 2i+1 and 2i+2."""

    names: list[str]
    cuts: list[np.ndarray]
    loss: str
    base: float
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)
    bin: list[np.ndarray] = field(default_factory=list)
    missing_right: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    gain: list[np.ndarray] = field(default_factory=list)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bins of values: 0 for missing, else 1 + the number of cuts below."""
        out = np.zeros(x.shape, np.int16)
        for j, c in enumerate(self.cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(c, x[:, j], "left"))
        return out

    def leaves(self, codes: np.ndarray, t: int, levels: int | None = None) -> np.ndarray:
        node, row = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(self.depth if levels is None else levels):
            f = self.feature[t][node]
            code = codes[row, np.maximum(f, 0)]
            right = np.where(code == 0, self.missing_right[t][node], code > self.bin[t][node])
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def margin(self, codes: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        out = np.zeros(len(codes))
        for t in range(first, len(self.value) if last is None else last):
            out += self.value[t][self.leaves(codes, t)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        raw = self.base + self.margin(self.codes(x))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30))) if self.loss == "logistic" else raw

    def column(self) -> Column:
        """The prediction (for ``logistic`` the probability of 1) from the
        feature columns."""
        ship_code()
        model = self

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.stack(x.to_numpy()).astype(float)) if len(x) else [], dtype=float)

        return predict(_vector(self.names))

    def table(self, spark: SparkSession) -> DataFrame:
        """``tree, feature, threshold, missing_right, value, gain``: a row a tree."""
        rows = [(t, self.feature[t].tolist(), [float(self.cuts[f][b - 1]) if f >= 0 and 0 < b <= len(self.cuts[f]) else None for f, b in zip(self.feature[t], self.bin[t])],
                 self.missing_right[t].tolist(), self.value[t].tolist(), self.gain[t].tolist()) for t in range(len(self.value))]
        return spark.createDataFrame(rows, "tree int, feature array<int>, threshold array<double>, missing_right array<boolean>, value array<double>, gain array<double>")

    def importances(self, spark: SparkSession) -> DataFrame:
        """Each feature's share of the splits' gain, ranked."""
        total = np.zeros(len(self.names))
        for f, g in zip(self.feature, self.gain):
            np.add.at(total, f[f >= 0], g[f >= 0])
        share = total / total.sum() if total.sum() > 0 else total
        return spark.createDataFrame(list(zip(self.names, share.tolist())), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _vector(names: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(number(c).cast("double"), F.lit(float("nan"))) for c in names])


def _matrix(column: pa.Array, m: int) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py():column.offsets[-1].as_py()].reshape(-1, m)


def _packed(codes: np.ndarray, y: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """A block of rows as one row of three binaries."""
    values = (codes.astype(np.int16, copy=False), y, margin)
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], ["codes", "y", "margin"])


def _blocks(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for codes, y, margin in zip(*(batch.column(c).to_pylist() for c in ("codes", "y", "margin"))):
            yield np.frombuffer(codes, np.int16).reshape(-1, m), np.frombuffer(y), np.frombuffer(margin)


def best_splits(g: np.ndarray, h: np.ndarray, l2: float, gamma: float, min_child: float):
    """Of each node the best (gain, feature, bin, missing to the right) from
    its sums, shape (nodes, features, bins); bin 0 is the missing values.
    Codes up to the split bin go left.  Ties go to the first feature, the
    lowest bin, and missing values to the left."""
    gt, ht = g[:, :1].sum(2, keepdims=True), h[:, :1].sum(2, keepdims=True)
    whole = gt ** 2 / (ht + l2)
    best = None
    for right in (False, True):
        gl, hl = np.cumsum(g[:, :, 1:], 2), np.cumsum(h[:, :, 1:], 2)
        if not right:
            gl, hl = gl + g[:, :, :1], hl + h[:, :, :1]
        gr, hr = gt - gl, ht - hl
        gain = 0.5 * (gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - whole) - gamma
        gain[(hl < min_child) | (hr < min_child)] = 0
        if right:  # without missing values both ways are the same split
            gain[np.broadcast_to(h[:, :, :1] == 0, gain.shape)] = 0
        flat = gain.reshape(len(g), -1)
        at = flat.argmax(1)
        top = flat[np.arange(len(g)), at]
        f, b = np.divmod(at, gain.shape[2])
        if best is None:
            best = [top, f, b + 1, np.zeros(len(g), bool)]
        else:
            take = top > best[0] + 1e-12
            best = [np.where(take, top, best[0]), np.where(take, f, best[1]), np.where(take, b + 1, best[2]), take]
    return best


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, loss: str = "logistic", trees: int = 50, depth: int = 4,
                rate: float = 0.3, l2: float = 1.0, gamma: float = 0.0, min_child: float = 1.0, bins: int = 64,
                keep_every: int = 10) -> BoostedTrees:
    """Fit on all rows that have a label; ``loss`` is ``logistic`` (labels 0
    and 1) or ``squared``.  ``min_child`` is the least Hessian sum of a leaf.
    Every ``keep_every`` trees the rows' margins are written anew, so a job
    walks that many trees at most.  No rows give a constant model."""
    if loss not in ("logistic", "squared"):
        raise ValueError(loss)
    ship_code()
    names, m = list(features), len(features)
    rows = reliable_checkpoint(df.select(_vector(names).alias("x"), number(label).cast("double").alias("y")).where("y IS NOT NULL"))
    steps = [i / (bins - 1) for i in range(1, bins - 1)]
    known = [F.when(~F.isnan(F.get("x", F.lit(j))), F.get("x", F.lit(j))) for j in range(m)]
    got = rows.agg(F.count(F.lit(1)), F.avg("y"), *[F.percentile_approx(v, steps, 10_000) for v in known]).first()  # features x bins
    n, mean = got[0], got[1]
    share = min(max(mean or 0.0, 1e-6), 1 - 1e-6) if loss == "logistic" else (mean or 0.0)
    base = float(np.log(share / (1 - share))) if loss == "logistic" and n else float(share if n else 0.0)
    model = BoostedTrees(names, [np.unique(np.array(got[2 + j] or [], float)) for j in range(m)], loss, base, depth)
    if not n:
        return model
    width = max(len(c) for c in model.cuts) + 2

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                codes = model.codes(_matrix(part.column("x"), m))
                yield _packed(codes, part.column("y").to_numpy(), np.full(len(codes), base))

    schema = "codes binary, y binary, margin binary"
    # rows packed by the thousand and dealt to all cores, whatever the files' row groups
    packed = rows.mapInArrow(start, schema)
    table = reliable_checkpoint(packed.repartition(max(df.sparkSession.sparkContext.defaultParallelism, packed.rdd.getNumPartitions())))
    kept = 0
    for t in range(trees):
        if t - kept >= keep_every:
            table = reliable_checkpoint(table.mapInArrow(_advance(model, m, kept, t), schema))
            kept = t
        size = 2 ** (depth + 1) - 1
        for name, kind, fill in (("feature", np.int64, -1), ("bin", np.int64, 0), ("missing_right", bool, False), ("value", float, 0), ("gain", float, 0)):
            getattr(model, name).append(np.full(size, fill, kind))
        for level in range(depth + 1):
            first, nodes = 2 ** level - 1, 2 ** level
            sums = table.mapInArrow(_histograms(model, m, width, kept, t, level), "at long, g double, h double")
            sums = sums.groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()  # nodes x features x bins
            at = sums["at"].to_numpy()
            g, h = (np.bincount(at, sums[c].to_numpy(), nodes * m * width).reshape(nodes, m, width) for c in ("g", "h"))
            gt, ht = g[:, 0].sum(1), h[:, 0].sum(1)
            model.value[t][first:first + nodes] = np.where(ht > 0, -rate * gt / (ht + l2), 0)
            if level == depth:
                break
            gain, f, b, right = best_splits(g, h, l2, gamma, min_child)
            split = (gain > 1e-9) & (ht > 0)
            model.feature[t][first:first + nodes] = np.where(split, f, -1)
            model.bin[t][first:first + nodes], model.missing_right[t][first:first + nodes] = b, right
            model.gain[t][first:first + nodes] = np.where(split, gain, 0)
            if not split.any():
                break
    return model


def _gradients(model: BoostedTrees, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if model.loss == "squared":
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    return p - y, np.maximum(p * (1 - p), 1e-16)


def _advance(model: BoostedTrees, m: int, first: int, last: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, y, margin in _blocks(batches, m):
            yield _packed(codes, y, margin + model.margin(codes, first, last))
    return run


def _histograms(model: BoostedTrees, m: int, width: int, kept: int, t: int, level: int):
    """Sums of a task's rows by node of the level, feature and bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nodes = 2 ** level - 1, 2 ** level
        total = np.zeros((2, nodes * m * width))
        for codes, y, margin in _blocks(batches, m):
            g, h = _gradients(model, y, margin + model.margin(codes, kept, t))
            node = model.leaves(codes, t, level) - first
            here = node >= 0  # others stopped above
            at = ((node[here, None] * m + np.arange(m)) * width + codes[here]).ravel()
            for k, v in enumerate((g, h)):
                total[k] += np.bincount(at, np.repeat(v[here], m), nodes * m * width)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[0, some]), pa.array(total[1, some])], ["at", "g", "h"])
    return run
