"""Embedding whitening from the covariance of distinct vectors.

Identical vectors are grouped first; every later pass reads each distinct
vector once, with its multiplicity (or one) as its weight: the weighted sums,
the weighted centred products (a GEMM per batch), and the projection.  The
projections are then joined back to the rows.  Only tables with a bound set by
the dimension reach the driver: the sums, the covariance and its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, reliable_checkpoint, ship_code

#: Largest entry, times the scale, that still has an exact long.
MOST = float(2 ** 52)
#: Vectors that hold more than this share of the rows are joined by broadcast;
#: there are at most 1000 of them.
HOT_SHARE = 1000


def fixed_point(vector: Column, scale: int = 1024, shift: int = 100_000) -> Column:
    """``floor(scale * c) + shift`` of every entry as a long; null for a
    vector that is null, empty, or holds an entry that is null, not finite or
    too large for an exact long (2^52 over ``scale``)."""
    entries = F.transform(vector, lambda c: c.cast("double") * float(scale))
    good = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= MOST, F.lit(False)))  # NaN is above every number
    whole = F.transform(entries, lambda c: F.floor(c).cast("long") + F.lit(shift).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & good, whole)


def _matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    lists = batch.column(name)
    flat = lists.values.to_numpy()[lists.offsets[0].as_py():lists.offsets[-1].as_py()]
    return flat.reshape(batch.num_rows, d)


def _slices(batch: pa.RecordBatch, d: int, cells: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    step = max(1, cells // d)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


@dataclass
class Whitening:
    """The fit: ``n`` vectors with sums ``s``; the leading components."""

    n: int
    s: np.ndarray
    values: np.ndarray
    vectors: np.ndarray  # (dimension, components)
    trace: float
    wide: bool = False  # n * x may exceed a long

    def gap(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact."""
        return self.n * (x.astype(object) if self.wide else x) - self.s

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.gap(x) / self.n).astype(float)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n*x - S, exact; None beyond a long."""
        gap = self.gap(x)
        rough = (gap.astype(float) ** 2).sum(axis=1)
        out: list[int | None] = (gap * gap).sum(axis=1).tolist()  # may wrap where rough is large
        for i in np.flatnonzero(rough > 2.0 ** 62):
            exact = sum(int(v) ** 2 for v in gap[i])
            out[i] = exact if exact < 2 ** 63 else None
        return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``x, many``: the distinct vectors of rows ``(id, x)``; a vector that
    holds many rows is counted map-side."""
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("many"))


def _sums(distinct: DataFrame, d: int) -> tuple[int, list[int], int]:
    """Number of fitted vectors, their sums, and the largest entry.  Entries
    are summed in two halves, so that no sum exceeds a long."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most, high, low = 0, 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for part in _slices(batch, d):
                w, x = part.column("w").to_numpy(), _matrix(part, "x", d)
                n += int(w.sum())
                most = max(most, int(np.abs(x).max()))
                high += w @ (x >> 26)
                low += w @ (x & ((1 << 26) - 1))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *high.tolist()], pa.int64()),
                                              pa.array([0, *low.tolist()], pa.int64()), pa.array([most] * (d + 1), pa.int64())],
                                             ["i", "high", "low", "most"])

    got = distinct.mapInArrow(fold, "i int, high long, low long, most long").groupBy("i").agg(
        F.sum("high"), F.sum("low"), F.max("most")).collect()  # a row a dimension
    by = {r[0]: (r[1], r[2]) for r in got}
    sums = [by[i][0] * 2 ** 26 + by[i][1] for i in range(d)] if got else [0] * d
    return by.get(-1, (0, 0))[0], sums, max((r[3] for r in got), default=0)


def _products(distinct: DataFrame, fit: Whitening, d: int) -> np.ndarray:
    """Weighted covariance: centred before multiplying, divisor n."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d)), False
        for batch in batches:
            for part in _slices(batch, d):
                c = fit.centred(_matrix(part, "x", d))
                total += (c * part.column("w").to_numpy()[:, None]).T @ c
                seen = True
        for a in range(0, d if seen else 0, max(1, (1 << 16) // d)):
            i, j = np.mgrid[a:min(d, a + max(1, (1 << 16) // d)), 0:d].reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i * d + j, pa.int64()), pa.array(total[i, j])], ["at", "v"])

    ship_code()
    got = distinct.mapInArrow(fold, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    got = got.toPandas()  # the square of the dimension
    out = np.zeros(d * d)
    out[got["at"].to_numpy()] = got["v"].to_numpy()
    out = out.reshape(d, d) / fit.n
    return (out + out.T) / 2


def whitened_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
                  weights: str = "count", scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``.

    Dropped are rows whose vector is null or empty, or holds a null, an entry
    that is not finite, or one beyond an exact long; and rows whose vector
    has another length than most (of lengths equally frequent the longer
    one counts).  ``weights="one"`` fits on each distinct vector once,
    ``"count"`` on all rows.  Repeated rows and null ids get rows of their
    own.  Components whose eigenvalue is zero to double precision have no
    whitened value and are left out; equal eigenvalues have some orthonormal
    basis, the same for all rows.  ``deviation`` is null beyond a long.
    An empty table gives no rows; other columns are not read."""
    if weights not in ("count", "one"):
        raise ValueError("weights: count or one")
    ship_code()
    rows = vectors.select(col(id_col).alias("id"), fixed_point(col(vector_col), scale, shift).alias("x")).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("many"), F.desc("d")).first()
    d = sizes["d"] if sizes else 1
    rows = rows.where(F.size("x") == d)
    # written once: each pass below reads the distinct vectors
    weight = F.col("many") if weights == "count" else F.lit(1).cast("long")
    distinct = reliable_checkpoint(distinct_vectors(rows).withColumn("w", weight))
    n, sums, most = _sums(distinct, d)
    wide = n * most >= 2 ** 62
    s = np.array(sums, object if wide else np.int64)
    fit = Whitening(n, s, np.zeros(0), np.zeros((d, 0)), 0.0, wide)
    if n:
        covariance = _products(distinct, fit, d)
        values, basis = np.linalg.eigh(covariance)  # dimension by dimension, on the driver
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > d * np.finfo(float).eps * max(values.max(), 0.0)]
        fit = Whitening(n, s, values[order], np.ascontiguousarray(basis[:, order]), float(np.trace(covariance)), wide)
    k = len(fit.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, d):
                x = _matrix(part, "x", d)
                z = fit.project(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("x"), part.column("many"), part.column("w"), pa.array(fit.deviation(x), pa.int64()),
                     pa.ListArray.from_arrays(np.arange(0, z.size + 1, k, np.int32) if k else np.zeros(len(z) + 1, np.int32), z.ravel())],
                    ["x", "many", "w", "deviation", "z"])

    done = reliable_checkpoint(distinct.mapInArrow(project, "x array<long>, many long, w long, deviation long, z array<double>"))
    error = _identity_error(done, n, k)
    # a frequent vector's rows stay where they are; the join of the others is by vector
    hot = F.col("many") * HOT_SHARE > sizes["many"] if sizes else F.lit(False)
    known = done.select(F.col("x").alias("key"), "deviation", "z", hot.alias("hot"))
    often = rows.join(F.broadcast(known.where("hot").select("key", "deviation", "z")), F.col("x") == F.col("key"), "left")
    taken = often.where("key IS NOT NULL").select("id", "deviation", "z")
    rest = often.where("key IS NULL").select("id", "x").join(known.where(~F.col("hot")), F.col("x") == F.col("key"))
    both = taken.unionByName(rest.select("id", "deviation", "z"))
    share = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values]).cast("array<double>")
    return both.select("id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        "id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("i")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def _identity_error(done: DataFrame, n: int, k: int) -> float:
    """Largest entry of the whitened vectors' covariance less the identity."""
    if not k:
        return 0.0
    z = [F.get("z", F.lit(i)) for i in range(k)]
    means = done.agg(*[(F.sum(v * F.col("w")) / n).alias(f"m{i}") for i, v in enumerate(z)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    got = done.agg(*[(F.sum((z[i] - means[i]) * (z[j] - means[j]) * F.col("w")) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
