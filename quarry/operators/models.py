"""Model jobs on MLlib.

Fitting is distributed by MLlib; the driver only loops over folds and
candidates (a handful of fits) and keeps small metric tables.  Feature
pipelines are ``Pipeline`` objects so a fitted model can be saved and
reloaded for batch scoring.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_code
from .regression_trees import PackedGBTRegressor


def fourier(x: np.ndarray, size: int, gamma: float, seed: int, kind: type = np.float64) -> np.ndarray:
    """Random Fourier features: rows whose inner products come near the
    kernel ``exp(-gamma * |x - y|^2)``.  The same seed gives the same
    features in every task; ``gamma`` 0 stands for 1 / dimension.  ``kind``
    is the precision of the cosines."""
    rng = np.random.default_rng(seed)
    gamma = gamma or 1.0 / x.shape[1]
    waves = rng.normal(size=(x.shape[1], size)) * np.sqrt(2 * gamma)
    phase = rng.uniform(0, 2 * np.pi, size)
    out = x @ waves
    out += phase
    out = out.astype(kind, copy=False)
    np.cos(out, out=out)
    out *= kind(np.sqrt(2 / size))
    return out


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """A vector column's random Fourier features (Arrow batches, one
    matrix product each).  A linear machine on them is a kernel machine whose
    cost grows with the rows, not with their square."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 for 1 / dimension", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", size=256, gamma=0.0, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", outputCol="fourier", size=256, gamma=0.0, seed=42)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_code()
        size, gamma, seed = (self.getOrDefault(p) for p in (self.size, self.gamma, self.seed))

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            return pd.Series(list(fourier(np.stack(x), size, gamma, seed)) if len(x) else [], dtype=object)

        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(self.getInputCol()))))


def _margin(x: np.ndarray, size: int, gamma: float, seed: int, weights: np.ndarray) -> np.ndarray:
    return fourier(x, size, gamma, seed) @ weights[:-1] + weights[-1] if len(x) else np.zeros(0)


class FourierSVCModel(Transformer, HasInputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted kernel machine: ``rawPrediction`` and ``prediction``."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 for 1 / dimension", TypeConverters.toFloat)
    weights = Param(Params._dummy(), "weights", "a weight a feature, and the intercept", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", size=256, gamma=0.0, seed=42, weights=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(inputCol="features", size=256, gamma=0.0, seed=42)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_code()
        size, gamma, seed = (self.getOrDefault(p) for p in (self.size, self.gamma, self.seed))
        weights = np.array(self.getOrDefault(self.weights))

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(_margin(np.stack(x), size, gamma, seed, weights) if len(x) else [], dtype=float)

        raw = margin(vector_to_array(self.getInputCol()))
        out = dataset.withColumn("rawPrediction", raw)
        return (out.withColumn("prediction", (F.col("rawPrediction") > 0).cast("double"))
                .withColumn("rawPrediction", array_to_vector(F.array(-F.col("rawPrediction"), F.col("rawPrediction")))))


#: Rows whose Fourier features a task holds at once, and the step lengths
#: along a direction that one pass over the rows compares.
_WAVE_ROWS = 512
_STEPS = np.array([4.0, 2.0, 1.0, 0.5, 0.2, 0.05, 0.01, 0.001])


class FourierSVC(Estimator, HasInputCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """A linear support vector machine on random Fourier features
    (hinge loss, L2 penalty on the standardised weights, free intercept).

    Features are 256 numbers a row where the input has a few, so they are
    never kept: every pass computes them again, a few thousand rows at a time
    (single precision), and returns sums of gradients, one row a task.  The
    driver takes L-BFGS steps; a pass tries several step lengths at once."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 for 1 / dimension", TypeConverters.toFloat)
    regParam = Param(Params._dummy(), "regParam", "L2 penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "passes at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least relative gain of a pass, on average over ten", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", labelCol="label", size=256, gamma=0.0, seed=42, regParam=0.001, maxIter=100, tol=1e-6):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", labelCol="label", size=256, gamma=0.0, seed=42, regParam=0.001, maxIter=100, tol=1e-6)

    def _fit(self, dataset: DataFrame) -> FourierSVCModel:
        ship_code()
        size, gamma, seed, reg = (self.getOrDefault(p) for p in (self.size, self.gamma, self.seed, self.regParam))
        spark = dataset.sparkSession
        rows = dataset.select(vector_to_array(self.getInputCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        # packed, so that a pass moves few large rows, and dealt to all cores
        blocks = rows.mapInPandas(_pack, "x binary, y binary")
        tasks = max(spark.sparkContext.defaultParallelism, blocks.rdd.getNumPartitions())
        blocks = reliable_checkpoint(blocks.repartition(tasks)).persist()
        try:
            def sums(*args):
                def run(batches):
                    total = None
                    for pdf in batches:
                        for x, y in zip(pdf["x"], pdf["y"]):
                            part = _svc_sums(x, y, size, gamma, seed, *args)
                            total = part if total is None else total + part
                    if total is not None:
                        yield pd.DataFrame({"s": [total.ravel()]})
                got = blocks.mapInPandas(run, "s array<double>").collect()  # a row a task
                return sum(np.array(r["s"]) for r in got) if got else None

            first = sums()
            if first is None:
                raise ValueError("no rows to fit")
            n, odd, mean = first[0], first[1], first[2:2 + size] / first[0]
            if odd or not np.isfinite(first).all():
                raise ValueError("features must be numbers and labels 0 or 1")
            spread = np.sqrt(np.maximum(first[2 + size:] - n * mean * mean, 0) / max(n - 1, 1))
            scale = np.divide(1, spread, out=np.zeros(size), where=spread > 1e-7)

            def losses(w, directions):
                """Loss and gradient at each of the points ``w + direction``."""
                points = w + directions
                raw = points[:, :-1] * scale
                shift = points[:, -1] - raw @ mean  # the features are centred
                out = sums(np.column_stack([raw, shift]).T).reshape(size + 2, -1)
                loss, slope, edge = out[0] / n, out[1:-1] / n, out[-1] / n
                slope = (slope - np.outer(mean, edge)) * scale[:, None]
                loss = loss + reg / 2 * (points[:, :-1] ** 2).sum(1)
                return loss, np.column_stack([slope.T + reg * points[:, :-1], edge])

            w = np.zeros(size + 1)
            loss, slope = (v[0] for v in losses(w, np.zeros((1, size + 1))))
            history, seen = [], [loss]
            for _ in range(self.getOrDefault(self.maxIter)):
                step = _direction(slope, history)
                steps = _STEPS if history else _STEPS / max(np.linalg.norm(slope), 1e-12)
                tried, slopes = losses(w, steps[:, None] * step)
                best = int(np.argmin(tried))
                if not tried[best] < loss:
                    if not history:
                        break
                    history = []  # once more, straight down
                    continue
                moved = steps[best] * step
                if (turn := moved @ (slopes[best] - slope)) > 1e-12 * (moved @ moved):
                    history = [*history[-9:], (moved, slopes[best] - slope, turn)]
                w, loss, slope = w + moved, tried[best], slopes[best]
                seen.append(loss)
                if len(seen) > 10 and (seen[-11] - loss) / 10 <= self.getOrDefault(self.tol) * abs(loss):
                    break
        finally:
            blocks.unpersist()
        raw = w[:-1] * scale
        weights = [*raw.tolist(), float(w[-1] - raw @ mean)]
        return FourierSVCModel(inputCol=self.getInputCol(), size=size, gamma=gamma, seed=seed, weights=weights)


def _pack(batches):
    for pdf in batches:
        if len(pdf):
            yield pd.DataFrame({"x": [np.stack(pdf["x"]).astype(float).tobytes()], "y": [pdf["y"].to_numpy(float).tobytes()]})


def _svc_sums(x: bytes, y: bytes, size: int, gamma: float, seed: int, points: np.ndarray | None = None) -> np.ndarray:
    """Of a block's rows: without ``points`` rows, odd labels and the features'
    sums and sums of squares; with them, a column a point, the hinge losses
    and their slopes by weight and intercept."""
    y = np.frombuffer(y)
    x = np.frombuffer(x).reshape(len(y), -1)
    total = np.zeros(2 + 2 * size) if points is None else np.zeros((size + 2, points.shape[1]))
    for a in range(0, len(y), _WAVE_ROWS):
        z, t = fourier(x[a:a + _WAVE_ROWS], size, gamma, seed, np.float32), y[a:a + _WAVE_ROWS]
        if points is None:
            total += np.concatenate([[len(t), np.sum((t != 0) & (t != 1)) + np.sum(np.isnan(t))], z.sum(0, dtype=float), (z.astype(float) ** 2).sum(0)])
            continue
        sign = (2 * t - 1)[:, None]
        short = 1 - sign * (z @ points[:-1].astype(np.float32) + points[-1])
        inside = np.where(short > 0, -sign, 0)
        total[0] += np.maximum(short, 0).sum(0)
        total[1:-1] += z.T @ inside.astype(np.float32)
        total[-1] += inside.sum(0)
    return total


def _direction(slope: np.ndarray, history: list) -> np.ndarray:
    """The L-BFGS direction from the last moves and changes of slope."""
    q, kept = -slope, []
    for moved, change, turn in reversed(history):
        a = moved @ q / turn
        q = q - a * change
        kept.append(a)
    if history:
        moved, change, turn = history[-1]
        q = q * (turn / (change @ change))
    for (moved, change, turn), a in zip(history, reversed(kept)):
        q = q + (a - change @ q / turn) * moved
    return q


def feature_stages(categorical: Sequence[str], numeric: Sequence[str], scale: bool = True) -> list:
    """K1/K6 stages: index categoricals (unseen -> extra index), assemble,
    optionally standardise."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                            stringOrderType="alphabetAsc") for c in categorical]
    cols = [f"{c}_idx" for c in categorical] + list(numeric)
    stages.append(VectorAssembler(inputCols=cols, outputCol="raw_features" if scale else "features",
                                  handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return stages


def classifier(kind: str, label: str = "label", seed: int = 42, **params) -> Estimator:
    """K10-K13 model families with the scripts' typical settings."""
    if kind == "logreg":
        return LogisticRegression(labelCol=label, maxIter=100, regParam=params.get("regParam", 0.1),
                                  elasticNetParam=params.get("elasticNetParam", 0.0))
    if kind == "rf":
        return RandomForestClassifier(labelCol=label, seed=seed, numTrees=params.get("numTrees", 100),
                                      maxDepth=params.get("maxDepth", 6),
                                      minInstancesPerNode=params.get("minInstancesPerNode", 2))
    if kind == "gbt":
        return GBTClassifier(labelCol=label, seed=seed, maxIter=params.get("maxIter", 50),
                             maxDepth=params.get("maxDepth", 4), stepSize=params.get("stepSize", 0.1),
                             subsamplingRate=params.get("subsamplingRate", 0.8))
    if kind == "svc":
        return LinearSVC(labelCol=label, maxIter=100, regParam=params.get("regParam", 0.1))
    if kind == "rbf_svc":
        return FourierSVC(labelCol=label, size=params.get("size", 256), gamma=params.get("gamma", 0.0), seed=seed,
                          maxIter=100, regParam=params.get("regParam", 0.001))
    raise ValueError(kind)


def positive_probability(pred: DataFrame, out: str = "p1") -> DataFrame:
    """P(class 1) from ``probability`` (or a squashed margin for LinearSVC)."""
    if "probability" in pred.columns:
        return pred.withColumn(out, vector_to_array("probability")[1])
    return pred.withColumn(out, 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1])))


def evaluator(metric: str = "accuracy", label: str = "label"):
    if metric == "auc":
        return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


#: Fits that run side by side: the rows of a small fold rarely keep every core busy.
_AT_ONCE = 4


def side_by_side(spark: SparkSession, work, items: Sequence, at_once: int = _AT_ONCE) -> list:
    """``work`` on each item, a few at once (their jobs share the cores); results in order."""
    with ThreadPool(max(1, min(at_once, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def folds_at_once(df: DataFrame) -> int:
    """Folds of a table to work on side by side: each keeps its rows, so there
    are fewer the more partitions a core the table has, and one from four on."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, _AT_ONCE * cores // max(cores, df.rdd.getNumPartitions()))


def fold_features(stages: list, train: DataFrame, *others: DataFrame, label: str = "label") -> tuple:
    """The fitted feature stages, and the tables with their features; of the
    training rows features and label are kept for the members that fit on them."""
    prep = Pipeline(stages=[s.copy() for s in stages]).fit(train)
    return prep, prep.transform(train).select("features", label).persist(kept_at(train)), *[prep.transform(o) for o in others]


def kept_at(df: DataFrame) -> StorageLevel:
    """Rows of a large table are kept on disk alone: memory is left to what
    the fits keep, and a task never takes rows read back into memory again."""
    return StorageLevel.DISK_ONLY if folds_at_once(df) == 1 else StorageLevel.MEMORY_AND_DISK_DESER


def cv_scores_by(spark: SparkSession, stages: list, models: Mapping[str, Estimator], df: DataFrame, fold_col: str = "fold",
                 k: int = 5, metric: str = "accuracy", label: str = "label") -> dict[str, DataFrame]:
    """K9: each model's score per fold, ``(fold, score)``.  The feature stages
    are refitted inside each fold, once for all models; folds of a small table
    run side by side."""
    def fold(i: int) -> list[float]:
        _, tr, va = fold_features(stages, df.where(F.col(fold_col) != i), df.where(F.col(fold_col) == i), label=label)
        va = va.select("features", label)
        try:
            if len(models) > 1:
                va = va.persist(kept_at(df))
            return [float(evaluator(metric, label).evaluate(m.copy().fit(tr).transform(va))) for m in models.values()]
        finally:
            tr.unpersist()
            va.unpersist()

    scores = side_by_side(spark, fold, range(k), folds_at_once(df))
    return {name: spark.createDataFrame([(i, s[j]) for i, s in enumerate(scores)], "fold int, score double") for j, name in enumerate(models)}


def cv_scores(spark: SparkSession, stages: list, model: Estimator, df: DataFrame, fold_col: str = "fold",
              k: int = 5, metric: str = "accuracy", label: str = "label") -> DataFrame:
    """K9: per-fold score with the feature stages refitted inside each fold;
    returns ``(fold, score)``."""
    return cv_scores_by(spark, stages, {"": model}, df, fold_col, k, metric, label)[""]


def cv_summary(scores: DataFrame) -> DataFrame:
    """K9: mean and 2 x population std of the fold scores."""
    return scores.agg(F.avg("score").alias("cv_mean"), (2 * F.stddev_pop("score")).alias("cv_2std"))


def grid_search(spark: SparkSession, stages: list, kind: str, grid: Sequence[Mapping], df: DataFrame,
                fold_col: str = "fold", k: int = 5, metric: str = "accuracy", label: str = "label") -> DataFrame:
    """Cross-validated score per candidate; best first."""
    out = None
    models = {str(i): classifier(kind, label, **params) for i, params in enumerate(grid)}
    scores = cv_scores_by(spark, stages, models, df, fold_col, k, metric, label)
    for i, params in enumerate(grid):
        s = cv_summary(scores[str(i)])
        s = s.select(F.lit(kind).alias("model"), F.lit(i).alias("candidate"),
                     F.lit(str(dict(params))).alias("params"), "cv_mean", "cv_2std")
        out = s if out is None else out.unionByName(s)
    return out.orderBy(F.desc("cv_mean"), "candidate")


def fit_pipeline(stages: list, model: Estimator, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages + [model]).fit(train)


def feature_importances(model: PipelineModel, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """Importances of the final tree model, ranked."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def regressor(kind: str, label: str, seed: int = 42, **params) -> Estimator:
    """K14 members: a penalised linear regression (ridge / lasso / elastic
    net by its parameters) or boosted regression trees."""
    if kind == "linear":
        return LinearRegression(labelCol=label, maxIter=params.pop("maxIter", 100), **params)
    if kind == "gbt":
        defaults = {"maxIter": 50, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}
        return PackedGBTRegressor(labelCol=label, seed=seed, **defaults | params)
    raise ValueError(kind)


def regression_average(stages: list, train: DataFrame, test: DataFrame, label: str,
                       members: Sequence[tuple[str, Mapping]], keep: Sequence[str] = ()) -> DataFrame:
    """Mean of several regressions, each ``(kind, parameters)``, on a log
    target, back-transformed with ``expm1``; the members' own predictions
    stay as ``p0, p1, ...``.  The feature stages are fitted once on the kept
    training rows, the members side by side, and they score one after the
    other in one pass over the test rows, whose columns ``keep`` stay."""
    train = train.persist()
    prep = Pipeline(stages=stages).fit(train)
    # kept as well: every member reads them, and the boosted ones several times
    rows, out = prep.transform(train).select("features", label).persist(), prep.transform(test).select(*test.columns, "features")
    named = [regressor(kind, label, **cfg).setPredictionCol(f"p{i}") for i, (kind, cfg) in enumerate(members)]
    for fit in side_by_side(train.sparkSession, lambda member: member.fit(rows), named):
        out = fit.transform(out)
    rows.unpersist()
    train.unpersist()
    names = [f"p{i}" for i in range(len(members))]
    avg = sum(F.col(n) for n in names) / len(names)
    return out.select("_row_id", *keep, *names, avg.alias("log_prediction"), F.expm1(avg).alias("prediction"))


def oof_stacking(spark: SparkSession, stages: list, members: Mapping[str, Estimator], df: DataFrame,
                 test: DataFrame, id_col: str, refit: Estimator, fold_col: str = "fold",
                 label: str = "label") -> DataFrame:
    """Out-of-fold member probabilities train a logistic meta-learner;
    test member probabilities are averaged over the fold models.  ``refit``
    is fitted again on all training rows.  Final score = mean of (member
    average, meta, refit).  Every fold that the rows have takes its turn, so
    every training row has out-of-fold probabilities (``oof_rows`` counts
    them, ``train_rows`` all)."""
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())  # as many as the caller's k

    def fold(i) -> list[tuple[DataFrame, DataFrame]]:
        _, tr, va, te = fold_features(stages, df.where(F.col(fold_col) != i), df.where(F.col(fold_col) == i), test, label=label)
        try:
            fits = [(name, est.copy().fit(tr)) for name, est in members.items()]
        finally:
            tr.unpersist()
        return [tuple(positive_probability(m.transform(rows), "p").select(id_col, F.lit(name).alias("member"), "p") for rows in (va, te))
                for name, m in fits]

    pairs = [pair for parts in side_by_side(spark, fold, folds, folds_at_once(df)) for pair in parts]
    oof_parts, test_parts = [p[0] for p in pairs], [p[1] for p in pairs]

    def wide(parts):
        u = parts[0]
        for p in parts[1:]:
            u = u.unionByName(p)
        return u.groupBy(id_col).pivot("member", list(members)).agg(F.avg("p"))

    # written once: the meta-learner's passes do not score the folds again
    oof = reliable_checkpoint(wide(oof_parts).join(df.select(id_col, label), id_col))
    names = list(members)
    meta = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"),
                            LogisticRegression(labelCol=label, maxIter=100, regParam=0.01)]).fit(oof)
    scored = positive_probability(meta.transform(wide(test_parts)), "meta")
    whole = positive_probability(fit_pipeline(stages, refit, df).transform(test), "refit").select(id_col, "refit")
    final = (sum(F.col(n) for n in names) / len(names) + F.col("meta") + F.col("refit")) / 3
    return scored.join(whole, id_col).select(
        id_col, *names, "meta", "refit", final.alias("final"), (final > 0.5).cast("int").alias("prediction"),
        F.lit(oof.count()).alias("oof_rows"), F.lit(df.count()).alias("train_rows"))
