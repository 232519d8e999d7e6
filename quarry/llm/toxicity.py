"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

A text's features are the 32-bit hashes of its words, its word pairs and its
skip-grams (two words with one between them), each present or not.  The fit
is McMahan's FTRL-proximal: every coordinate has its own learning rate, and
the L1 term leaves a few hundred non-zero weights, which every scoring task
gets.  Scoring is one pass over the texts, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, reliable_checkpoint, ship_code
from .quality_gbt import fold

#: Words are runs of ASCII letters and digits and of all other code points.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
MIX = np.uint64(0x9E3779B97F4A7C15)
PAIR, SKIP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BLOCK = 1 << 20


class _Hashes(dict):
    """Hashes of the words seen by a worker; a bounded number of short ones is kept."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 48 and len(self) < 200_000:
            self[word] = value
        return value


def blocks(body: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """The words of a text, lower-cased and separated by blanks, some
    ``size`` bytes at a time; no word is cut."""
    at = 0
    while at < len(body):
        end = len(body)
        if end - at > size:
            end = at + size
            while end < len(body) and WORD_BYTES[body[end]] != 32:
                end += 1
        part = body[at:end].translate(WORD_BYTES)
        yield part if part.isascii() else part.decode("utf-8", "replace").lower().encode()
        at = end


def gram_blocks(body: bytes | None, hashes: _Hashes, size: int = BLOCK) -> Iterator[np.ndarray]:
    """Hashes (uint32) of words, pairs and skip-grams, block by block; pairs
    across a cut are counted, too.  Null and empty texts give none."""
    before = np.zeros(0, np.uint64)  # the last two words of the block before
    for part in blocks(body or b"", size):
        words = part.split()
        new = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        h = np.concatenate([before, new])
        k = len(before)
        pairs = h[max(0, k - 1):-1] * MIX + PAIR ^ h[max(0, k - 1) + 1:]
        skips = h[max(0, k - 2):-2] * MIX + SKIP ^ h[max(0, k - 2) + 2:]
        yield (np.concatenate([new, pairs, skips]) * MIX >> np.uint64(32)).astype(np.uint32)
        before = h[-2:]


def features(body: bytes | None, hashes: _Hashes) -> np.ndarray:
    """The distinct features of a whole text, ascending."""
    out = np.zeros(0, np.uint32)
    for part in gram_blocks(body, hashes):
        out = np.union1d(out, part)
    return out


@dataclass
class SparseWeights:
    """The non-zero weights, by ascending feature, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 16, bool)  # by the upper half of a feature
        self.maybe[self.keys >> 16] = True

    def raw(self, body: bytes | None, hashes: _Hashes) -> float:
        found = np.zeros(0, np.int64)
        for grams in gram_blocks(body, hashes):
            grams = grams[self.maybe[grams >> 16]]
            if len(grams):
                at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
                found = np.union1d(found, at[self.keys[at] == grams])
        return self.bias + float(self.weights[found].sum())

    def score(self, bodies) -> np.ndarray:
        hashes = _Hashes()
        raw = np.fromiter((self.raw(b, hashes) for b in bodies), float, len(bodies))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_ftrl(rows: list[np.ndarray], y: np.ndarray, alpha: float = 2.0, beta: float = 1.0, l1: float = 8.0,
             l2: float = 0.0, epochs: int = 5) -> SparseWeights:
    """Fit on rows of distinct features, in their order, ``epochs`` times.

    Features of one row only are left out: one gradient is at most 1, so
    with ``l1 >= 1`` they would first get a weight by being repeated.  The
    bias has no L1 term."""
    every = np.concatenate([np.zeros(0, np.uint32), *rows])
    every.sort()
    keys = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    bias, active = len(keys), []
    for r in rows:
        at = np.searchsorted(keys, r)
        at = at[at < bias]
        active.append(np.append(at[keys[at] == r[:len(at)]], bias).astype(np.int32))  # r ascends, as keys do
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(z: np.ndarray, n: np.ndarray, shrink: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - shrink, 0) / ((beta + np.sqrt(n)) / alpha + l2)

    for _ in range(epochs):
        for at, label in zip(active, y):
            zi, ni = z[at], n[at]
            shrink = np.full(len(at), l1)
            shrink[-1] = 0
            w = weights(zi, ni, shrink)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label  # the gradient of every active feature
            n[at] = ni + g * g
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
    w = weights(z, n, np.append(np.full(bias, l1), 0))
    kept = np.flatnonzero(w[:bias])
    return SparseWeights(keys[kept], w[kept], float(w[bias]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_id: str = "doc_id", label_col: str = "toxic", folds: int = 5, held_out: int = 0,
                 max_rows: int = 20_000, max_bytes: int = 64_000_000, **options) -> SparseWeights:
    """Fit on labelled documents outside the held-out fold.

    The fold is crc32 of the id as text, modulo ``folds``.  The sample is the
    ``max_rows`` labelled ids of least hash, passing over texts that would
    take it beyond ``max_bytes``; their features are made where the texts
    are, and one task fits on them, so it reads no more than that.  The
    driver gets the non-zero weights only.  An id labelled more than once
    counts once, with the majority (a tie counts as 1); of several texts
    under one id the one of least hash counts.  No labels give the score 0.5."""
    ship_code()
    tagged = (labels.select(col(label_id).alias("id"), col(label_col).cast("double").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), folds) != held_out)))
    known = docs.select(col(id_col).alias("id")).distinct()
    sample = tagged.join(known, "id").groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    sample = reliable_checkpoint(sample.orderBy(F.xxhash64("id"), "id").limit(max_rows))  # at most max_rows rows

    @F.pandas_udf("array<int>")
    def grams(bodies: pd.Series) -> pd.Series:
        hashes = _Hashes()
        return pd.Series([features(b, hashes).view(np.int32) for b in bodies])

    body = F.coalesce(col(text_col), F.lit("")).cast("binary")
    rows = docs.select(col(id_col).alias("id"), body.alias("body")).join(F.broadcast(sample), "id")
    rows = rows.select("id", "y", F.octet_length("body").cast("long").alias("size"), F.xxhash64("body").alias("h"), grams("body").alias("x"))
    rows = rows.groupBy("id", "y").agg(F.min_by(F.struct("size", "x"), "h").alias("one"))
    rows = rows.select("y", "one.size", "one.x", F.xxhash64("id").alias("h"), "id").repartition(1).sortWithinPartitions("h", "id")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, size = [], [], 0
        for batch in batches:
            lists = batch.column("x")
            values, ends = lists.values.to_numpy().view(np.uint32), lists.offsets.to_numpy()
            for i, (label, more) in enumerate(zip(batch.column("y").to_pylist(), batch.column("size").to_pylist())):
                if size + more <= max_bytes:
                    size += more
                    x.append(values[ends[i]:ends[i + 1]].copy())
                    y.append(label)
        model = fit_ftrl(x, np.array(y), **options)
        yield pa.RecordBatch.from_arrays([pa.array([None, *model.keys.tolist()], pa.int64()),
                                          pa.array([model.bias, *model.weights.tolist()], pa.float64())], ["key", "weight"])

    got = rows.select("y", "size", "x").mapInArrow(fit, "key long, weight double").collect()  # the non-zero weights
    got = sorted(((r.key, r.weight) for r in got if r.key is not None)), [r.weight for r in got if r.key is None]
    keys = np.array([k for k, _ in got[0]], np.uint32)
    return SparseWeights(keys, np.array([w for _, w in got[0]], float), got[1][0] if got[1] else 0.0)


def toxicity_column(text: Column, model: SparseWeights) -> Column:
    """The model's probability that a string column is toxic."""
    ship_code()

    @F.pandas_udf("double")
    def toxic(bodies: pd.Series) -> pd.Series:
        return pd.Series(model.score(bodies))

    return toxic(F.coalesce(text, F.lit("")).cast("binary"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 5, held_out: int = 0, **options) -> DataFrame:
    """``id, held_out, score, predicted`` of every document's whole text.

    Null and empty texts, and texts without words, score by the bias alone.
    Very long texts are read in blocks of 1 MB, with the word pairs across
    the cuts.  A null id belongs to no fold: ``held_out`` is false, and its
    label is never used.  Repeated rows get a row each; equal texts score
    alike.  An empty table gives no rows.  Other columns, whatever their
    names, are no inputs of a score.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, folds=folds, held_out=held_out, **options)
    scored = docs.select(col(id_col).alias("id"), toxicity_column(col(text_col), model).alias("score"))
    out = F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False))
    return scored.select("id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
