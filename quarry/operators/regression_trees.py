"""Boosted regression trees on squared error over packed rows.

The trees are those of MLlib's ``GBTRegressor``: the same quantile cuts, rows
drawn anew for every tree, variance gain and halved gradients.  Only the work
differs: a row is a byte a feature, its residual and the trees that draw it, in
blocks of some ten thousand.  A level of a tree costs one job, whose tasks sum
residuals and counts of their rows by node, feature and bin, one row a task;
the driver picks the splits.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_code
from .boosting import _matrix

#: Rows of a block, trees whose draws share a long, trees that a pass walks
#: before the residuals are written anew, rows from which cuts are taken, and
#: rows of a task at most (as a task costs the start of its worker in every
#: pass, packed rows are held in few partitions).
_BLOCK, _WORD, _KEEP, _SAMPLE, _TASK = 32_000, 62, 5, 10_000, 4_000_000
_PACKED = "codes binary, residual binary, drawn binary"


class Trees:
    """Complete trees of ``depth`` levels: a split's feature and bin (right if
    above; a node that is not split sends all rows left) and leaf values."""

    def __init__(self, cuts, depth, feature=None, bin=None, value=None):
        self.cuts, self.depth = [np.array(c, float) for c in cuts], depth
        self.feature, self.bin, self.value = feature or [], bin or [], [np.array(v, float) for v in value or []]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A row a feature: the number of cuts below each value."""
        kind = np.uint8 if max((len(c) for c in self.cuts), default=0) < 255 else np.uint16
        return np.stack([np.searchsorted(c, x[:, j], "left").astype(kind) for j, c in enumerate(self.cuts)])

    def places(self, codes: np.ndarray, t: int, levels: int) -> np.ndarray:
        """Each row's node in a level of the tree, counted from the left."""
        place = np.zeros(codes.shape[1], np.uint8 if levels <= 8 else np.int64)
        feature, bins = self.feature[t], self.bin[t]
        for level in range(levels):
            first = 2 ** level - 1
            if level > 5:
                f, b = (np.array(v)[place.astype(np.int64) + first] for v in (feature, bins))
                right = codes[f, np.arange(len(place))] > b
            else:
                right = np.zeros(len(place), bool)
                for k in range(2 ** level):
                    if bins[first + k] < len(self.cuts[feature[first + k]]):
                        right |= (place == k) & (codes[feature[first + k]] > bins[first + k])
            place = 2 * place + right
        return place

    def margin(self, codes: np.ndarray, first: int, last: int) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for t in range(first, last):
            out += self.value[t][self.places(codes, t, self.depth)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.margin(self.codes(x), 0, len(self.value))

    def text(self) -> str:
        return json.dumps({"cuts": [c.tolist() for c in self.cuts], "depth": self.depth, "feature": self.feature, "bin": self.bin,
                           "value": [v.tolist() for v in self.value]})


def cuts_of(values: np.ndarray, rows: float, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts, halfway between values, from a sample of a
    feature; ``rows`` is the size the sample was to have.  Rows that it lacks
    count as zeros, as MLlib counts them."""
    some = values[values != 0]
    if not len(some):
        return np.zeros(0)
    seen, counts = np.unique(some, return_counts=True)
    counts = counts.astype(float)
    if rows - counts.sum() > 100 * np.finfo(float).eps * len(some):
        at = np.searchsorted(seen, 0.0)
        seen, counts = np.insert(seen, at, 0.0), np.insert(counts, at, rows - counts.sum())
    between = (seen[:-1] + seen[1:]) / 2
    if len(between) < bins:
        return between
    stride = goal = rows / bins
    total, out = counts[0], []
    for i, c in enumerate(counts[1:]):
        if abs(total - goal) < abs(total + c - goal):
            out.append(between[i])
            goal += stride
        total += c
    return np.array(out)


def _sampled(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """A sample of the rows by ``RDD.sample``, which MLlib takes its cuts from."""
    if share >= 1:
        return rows
    spark = rows.sparkSession
    draw = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    return DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.toJavaRDD().sample(False, share, draw), rows._jdf.schema()), spark)


def _pack(model: Trees, m: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            x = _matrix(batch.column("x"), m)
            if np.isnan(y).any() or not np.isfinite(x).all():
                raise ValueError("labels and features must be numbers")
            held.append((model.codes(x), y, _matrix(batch.column("w"), words).T))
            n += len(y)
            if n >= _BLOCK:
                yield _block(*(np.concatenate(v, -1) for v in zip(*held)))
                held, n = [], 0
        if held:
            yield _block(*(np.concatenate(v, -1) for v in zip(*held)))
    return run


def _block(*values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], ["codes", "residual", "drawn"])


def _blocks(model: Trees, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    m = len(model.cuts)
    kind = model.codes(np.zeros((0, m))).dtype
    for batch in batches:
        for i in range(batch.num_rows):
            codes, residual, drawn = (np.frombuffer(batch.column(c)[i].as_buffer(), k)
                                      for c, k in (("codes", kind), ("residual", float), ("drawn", np.int64)))
            yield codes.reshape(m, -1), residual, drawn.reshape(-1, len(residual))


def _advance(model: Trees, last: int):
    """Residuals after the first ``last`` trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, residual, drawn in _blocks(model, batches):
            yield _block(codes, residual - model.margin(codes, 0, last), drawn)
    return run


def _histograms(model: Trees, width: int, kept: int, t: int, level: int):
    """A task's sums of residuals and counts of rows, by node of the level,
    feature and bin, of the rows that tree ``t`` draws."""
    m, nodes = len(model.cuts), 2 ** level
    # two features at a time, as long as their bins fit the cache
    step = 2 if width * width * (nodes + 1) <= 1 << 17 else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, nodes, m, width))
        for codes, residual, drawn in _blocks(model, batches):
            r = residual - model.margin(codes, kept, t) if t > kept else residual
            mine = (drawn[t // _WORD] >> (t % _WORD)) & 1
            place = np.where(mine, model.places(codes, t, level), nodes).astype(np.intp)  # the last place: not drawn
            for j in range(0, m, step):
                pair = codes[j:j + step].astype(np.int32)
                k = len(pair)
                at = place * width ** k + (pair[0] if k == 1 else pair[0] * width + pair[1])
                for out, weights in zip(total, (r, None)):
                    cells = np.bincount(at, weights, (nodes + 1) * width ** k)[:nodes * width ** k].reshape(nodes, *[width] * k)
                    for i in range(k):
                        out[:, j + i] += cells.sum(2 - i) if k == 2 else cells
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])
    return run


def _best(total: np.ndarray, count: np.ndarray):
    """Of each node the first split of most variance gain: gain, feature, bin,
    and residual sums and counts to its left; shape (nodes, features, bins)."""
    left, n_left = np.cumsum(total, 2), np.cumsum(count, 2)
    whole, n = left[:, :1, -1:], n_left[:, :1, -1:]
    n_right = n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left ** 2 / n_left + (whole - left) ** 2 / n_right - whole ** 2 / n) / n
    gain = np.where((n_left > 0) & (n_right > 0), gain, -np.inf).reshape(len(total), -1)
    at = gain.argmax(1)
    nodes = np.arange(len(total))
    f, b = np.divmod(at, total.shape[2])
    return gain[nodes, at], f, b, left[nodes, f, b], n_left[nodes, f, b], whole[:, 0, 0], n[:, 0, 0]


def fit_trees(rows: DataFrame, features: str, label: str, trees: int, depth: int, rate: float, share: float, bins: int, seed: int) -> Trees:
    """Fit on all rows: each tree on a ``share`` of them drawn anew, the first
    on the labels and each other on the doubled residuals, weighed ``rate``."""
    ship_code()
    spark = rows.sparkSession
    x = vector_to_array(features)
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit")
    bins = min(bins, n)
    part = min(1.0, max(bins * bins, _SAMPLE) / n)
    sample = np.array([r[0] for r in _sampled(rows.select(x.alias("x")), part, seed).collect()] or [rows.select(x).first()[0]], float)  # some 10,000 rows
    model = Trees([cuts_of(v, part * n, bins) for v in sample.T], depth)
    m, width = len(model.cuts), max(len(c) for c in model.cuts) + 1
    # the trees that draw a row, a bit each
    bit = lambda t: F.lit(1 << t % _WORD).cast("long")
    draws = [F.when(F.rand(seed + t + 1) < share, bit(t)).otherwise(0) if share < 1 else bit(t) for t in range(trees)]
    words = [sum(draws[a + 1:a + _WORD], draws[a]) for a in range(0, trees, _WORD)]
    packed = rows.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.array(*words).alias("w")).mapInArrow(_pack(model, m, len(words)), _PACKED)
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-n // _TASK))
    base = reliable_checkpoint(packed).coalesce(tasks)  # drawn already: the partitions may change
    table, kept = base.persist(StorageLevel.MEMORY_AND_DISK), 0
    try:
        for t in range(trees):
            if t - kept >= _KEEP:
                table.unpersist()
                table, kept = base.mapInArrow(_advance(model, t), _PACKED).persist(StorageLevel.MEMORY_AND_DISK), t
            model.feature.append([0] * (2 ** depth - 1))
            model.bin.append([width] * (2 ** depth - 1))
            model.value.append(np.zeros(2 ** depth))
            worth = None
            for level in range(depth):
                nodes = 2 ** level
                got = table.mapInArrow(_histograms(model, width, kept, t, level), "sums binary").collect()  # a row a task
                sums = sum(np.frombuffer(r[0]) for r in got).reshape(2, nodes, m, width)
                gain, f, b, left, n_left, whole, n_all = _best(*sums)
                if worth is None:
                    worth = [whole[0] / max(n_all[0], 1)]
                below = []
                for k in range(nodes):
                    if gain[k] > 0:
                        model.feature[t][nodes - 1 + k], model.bin[t][nodes - 1 + k] = int(f[k]), int(b[k])
                        below += [left[k] / n_left[k], (whole[k] - left[k]) / (n_all[k] - n_left[k])]
                    else:
                        below += [worth[k]] * 2
                worth = below
                if not (gain > 0).any():
                    worth = list(np.repeat(worth, 2 ** (depth - level - 1)))
                    break
            if worth is None:  # no levels
                got = table.mapInArrow(_histograms(model, width, kept, t, 0), "sums binary").collect()  # a row a task
                whole, n_all = sum(np.frombuffer(r[0]) for r in got).reshape(2, m, width)[:, 0].sum(1)
                worth = [whole / max(n_all, 1)]
            model.value[t] = np.array(worth) * (2 * rate if t else 1)
    finally:
        table.unpersist()
    return model


class _TreeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)


class PackedGBTRegressor(Estimator, _TreeParams):
    """``GBTRegressor`` on packed rows, with its parameters and defaults."""

    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "weight of every tree but the first", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows that a tree draws", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, maxIter=20, maxDepth=5, maxBins=32,
                 stepSize=0.1, subsamplingRate=1.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, maxIter=20, maxDepth=5, maxBins=32,
                         stepSize=0.1, subsamplingRate=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PackedGBTModel:
        get = self.getOrDefault
        rows = dataset.select(self.getFeaturesCol(), self.getLabelCol())
        model = fit_trees(rows, self.getFeaturesCol(), self.getLabelCol(), get(self.maxIter), get(self.maxDepth), get(self.stepSize),
                          get(self.subsamplingRate), get(self.maxBins), get(self.seed))
        return PackedGBTModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), trees=model.text())


class PackedGBTModel(Transformer, _TreeParams):
    """The fitted trees (kept as JSON); predictions are a column."""

    trees = Param(Params._dummy(), "trees", "cuts, splits and leaf values as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", trees=None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_code()
        model = Trees(**json.loads(self.getOrDefault(self.trees)))

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            return pa.array(model.predict(_matrix(x, len(model.cuts))) if len(x) else [], pa.float64())

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))
