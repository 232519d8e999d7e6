"""Quality classifier: histogram gradient-boosted trees over text statistics.

The trees are fitted on a bounded sample of labelled rows, whose statistics
come from Spark, and flattened into arrays; scoring is one pass over the
texts in Arrow batches, in which numpy walks all rows down all trees at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, reliable_checkpoint, row_struct, ship_code

#: Byte classes whose shares of a text are statistics.
CLASSES = (b" ", b"\n", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".", b",", b"!", b"?", b"|", b"%$#&*",
           b"<>{}[]=/\\_", b":;'\"()-")
N_FEATURES = len(CLASSES) + 12


def statistics(text: bytes | None) -> np.ndarray:
    """Statistics of one text (UTF-8); a null or empty text has all zero."""
    text = text or b""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    for i, members in enumerate(CLASSES):
        out[i] = counts[list(members)].sum() / len(text)
    words, lines = text.split(), text.split(b"\n")
    k = len(CLASSES)
    out[k] = np.log1p(len(text))
    out[k + 1] = counts[128:].sum() / len(text)
    out[k + 2] = np.log1p(len(lines))
    out[k + 3] = len(set(lines)) / len(lines)
    out[k + 4] = np.log1p(max(map(len, lines)))
    if words:
        tally = Counter(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        most = max(tally.values())
        out[k + 5] = np.log1p(len(words))
        out[k + 6] = sizes.mean()
        out[k + 7] = sizes.std()
        out[k + 8] = np.log1p(sizes.max())
        out[k + 9] = len(tally) / len(words)
        out[k + 10] = most / len(words)
        out[k + 11] = (sizes == 1).mean()
    return out


def statistics_matrix(texts) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, N_FEATURES), np.float32)


@dataclass
class Trees:
    """Complete binary trees as arrays of shape (trees, nodes)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray, rows: int = 4096) -> np.ndarray:
        out = np.full(len(x), self.base)
        tree = np.arange(len(self.feature))[None, :]
        for a in range(0, len(x) if len(self.feature) else 0, rows):
            part = x[a:a + rows]
            node, row = np.zeros((len(part), len(self.feature)), np.int64), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                right = part[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            out[a:a + rows] += self.value[tree, node].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64,
              l2: float = 1.0, min_hessian: float = 1.0) -> Trees:
    """Boost log loss; splits are searched in histograms of binned features."""
    n, m = x.shape if len(x) else (0, N_FEATURES)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base, nodes = float(np.log(share / (1 - share))), 2 ** (depth + 1) - 1
    feature, value = np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes))
    threshold = np.full((trees, nodes), np.inf, np.float32)
    if n == 0 or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], value[:0], base, depth)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1]).astype(np.float32)) for f in range(m)]
    code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)  # x <= cuts[code]
    flat = code + np.arange(m) * bins
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (m * bins) + flat).ravel()
            hist = [np.bincount(at, np.repeat(v, m), width * m * bins).reshape(width, m, bins) for v in (g, h)]
            gl, hl = (np.cumsum(v, axis=2) for v in hist)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(hl < min_hessian) | (ht - hl < min_hessian)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c):] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                if gain[k].flat[best[k]] > 1e-9:
                    f, b = divmod(int(best[k]), bins)
                    feature[t, first + k], threshold[t, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        first = 2 ** depth - 1
        sums = [np.bincount(node - first, v, first + 1) for v in (g, h)]
        value[t, first:] = -rate * sums[0] / (sums[1] + l2)
        raw += value[t, node]
    return Trees(feature, threshold, value, base, depth)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality", folds: int = 3, held_out: int = 1,
                max_rows: int = 20_000, **options) -> Trees:
    """Fit on labelled documents outside the held-out fold.

    The fold is crc32 of the id as text, modulo ``folds``.  ``max_rows``
    bounds the sample: the labelled rows with the least hash of their id.
    Only its ids and statistics reach the driver, no texts.  No labels, or
    labels of one class only, give a constant score."""
    ship_code()
    tagged = (labels.select(col(label_id).alias("id"), col(label_col).cast("double").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), folds) != held_out)))
    known = docs.select(col(id_col).alias("id")).distinct()
    sample = tagged.join(known, "id").groupBy("id").agg(F.avg("y").alias("y"))
    sample = reliable_checkpoint(sample.orderBy(F.xxhash64("id"), "id").limit(max_rows))  # at most max_rows rows

    @F.pandas_udf("array<float>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series(list(statistics_matrix(texts)))

    rows = (docs.select(col(id_col).alias("id"), col(text_col).cast("binary").alias("body"))
            .join(F.broadcast(sample), "id").select("id", "y", stats("body").alias("x")))
    got = rows.orderBy(F.xxhash64("id"), "id", F.hash("x")).limit(max_rows).toPandas()
    x = np.stack(got["x"].to_numpy()).astype(np.float32) if len(got) else np.zeros((0, N_FEATURES), np.float32)
    return fit_trees(x, (got["y"].to_numpy(float) >= 0.5).astype(float), **options)


def fold(id_column: Column, folds: int) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds))


def score_column(text: Column, model: Trees) -> Column:
    """The model's probability of label 1 for a string column."""
    ship_code()

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(statistics_matrix(texts)))

    return quality(F.coalesce(text, F.lit("")).cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   folds: int = 3, held_out: int = 1, **options) -> DataFrame:
    """``id, held_out, score, predicted`` of every document's whole text.

    Null and empty texts score like a text without any characters.  A null
    id belongs to no fold: ``held_out`` is false, and its label is never
    used.  Repeated rows get a row each; an id labelled more than once
    counts once, with the majority (a tie counts as 1).  A very long text is
    measured whole, in its row.  An empty table gives no rows.  Other columns, labels included, are no inputs of a score.
    """
    model = fit_quality(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **options)
    scored = docs.select(col(id_col).alias("id"), score_column(col(text_col), model).alias("score"))
    out = F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False))
    return scored.select("id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents predicted to be of quality, all columns kept.

    Null, empty and very long texts, null ids, repeated rows and empty tables
    are taken as in ``quality_scores``; rows with equal texts stay or go
    together."""
    model = fit_quality(docs, labels, id_col, text_col, **options)
    return (docs.select(row_struct(docs), score_column(col(text_col), model).alias("score"))
            .where("score >= 0.5").select("row.*"))
