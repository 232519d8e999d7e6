"""Approximate nearest neighbours: an inverted file over quantised residuals.

The rows are dealt to k-means cells; a row's difference from its cell's
centre is product-quantised to a few bytes.  A query visits the cells nearest
to it and ranks their rows by the bytes alone; the vectors of the best ones
are then fetched and ranked by exact distance.

Only the centres are fitted on a sample (``sample_rows`` rows of least hash
of the id, a bound on what the driver holds); every row is indexed.  How many
cells a query visits and how many rows are ranked exactly is measured on the
sample, so that ``target_recall`` of the true neighbours are found there; on
vectors without structure that means many cells, on clustered ones few.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, ship_code
from .neighbors import euclidean

#: Distances a task computes at once.
_CELLS = 2_000_000


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's iterations from ``k`` random distinct rows; an empty cell
    keeps its centre."""
    points = np.unique(x, axis=0)
    centres = points[np.random.default_rng(seed).permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        count = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, _CELLS // max(1, len(centres)))
    return np.concatenate([squared_distances(x[a:a + step], centres).argmin(1) for a in range(0, len(x), step)] or [np.zeros(0, np.int64)])


@dataclass
class Quantiser:
    """Cell centres, one codebook for each part of the residual, and what a
    search visits."""

    centres: np.ndarray
    books: list[np.ndarray]
    probes: int = 1
    finalists_per_row: float = 1.0  # of the rows visited

    def parts(self) -> list[slice]:
        edges = np.cumsum([0, *(b.shape[1] for b in self.books)])
        return [slice(a, b) for a, b in zip(edges, edges[1:])]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = nearest(x, self.centres)
        rest = x - self.centres[cell]
        codes = [nearest(rest[:, p], b) for p, b in zip(self.parts(), self.books)]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray, cell: int) -> np.ndarray:
        """Squared distances of every code of every part to the queries'
        residuals: (queries, parts, codes)."""
        rest = queries - self.centres[cell]
        width = max(len(b) for b in self.books)
        out = np.zeros((len(queries), len(self.books), width))
        for j, (p, b) in enumerate(zip(self.parts(), self.books)):
            out[:, j, :len(b)] = squared_distances(rest[:, p], b)
        return out


def estimates(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Estimated squared distances (queries, rows) from the codes."""
    out = np.zeros((len(table), len(codes)))
    for j in range(codes.shape[1]):
        out += table[:, j, codes[:, j]]
    return out


def _calibrate(q: Quantiser, sample: np.ndarray, k: int, target: float, queries: int = 200) -> None:
    """Set ``probes`` and ``finalists_per_row`` from the sample's own
    neighbours: each loses at most half of what the target leaves."""
    n = len(sample)
    if n < 2:
        return
    asked = np.arange(0, n, max(1, n // queries))
    true = squared_distances(sample[asked], sample)
    true[np.arange(len(asked)), asked] = np.inf
    k = min(k, n - 1)
    wanted = np.argpartition(true, k - 1, axis=1)[:, :k]
    cell, codes = q.encode(sample)
    order = squared_distances(sample[asked], q.centres).argsort(1).argsort(1)  # a cell's place for a query
    at = np.take_along_axis(order, cell[wanted], axis=1).ravel()
    keep = 1 - (1 - target) / 2
    q.probes = int(np.quantile(at, keep, method="higher")) + 1
    shares = []
    for i, row in enumerate(asked):
        seen = np.flatnonzero(order[i][cell] < q.probes)
        estimate = np.empty(len(seen))
        for c in np.unique(cell[seen]):
            mine = cell[seen] == c
            estimate[mine] = estimates(q.tables(sample[row:row + 1], c), codes[seen[mine]])[0]
        estimate[seen == row] = np.inf
        place = estimate.argsort().argsort()
        shares += [(place[seen == w][0] + 1) / len(seen) for w in wanted[i] if (seen == w).any()]
    if shares:
        q.finalists_per_row = min(1.0, float(np.quantile(shares, keep, method="higher")))


def fit_quantiser(vectors: DataFrame, id_col: str, vec_col: str, k: int = 15, target_recall: float = 0.96,
                  sample_rows: int = 20_000, cells: int | None = None, part_width: int = 4, codes: int = 256) -> Quantiser:
    """Fit cells and codebooks on the sample; ``cells`` defaults to the square
    root of the number of rows, at most one for 32 sampled rows."""
    rows = vectors.where(F.col(vec_col).isNotNull())
    n = rows.count()
    sample = rows.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows).select(F.col(vec_col).alias("v")).toPandas()["v"]
    if not len(sample):
        return Quantiser(np.zeros((1, 1)), [np.zeros((1, 1))])
    x = np.stack(sample.to_numpy()).astype(float)
    cells = max(1, min(cells or round(math.sqrt(n)), len(x) // 32 or 1))
    centres = k_means(x, cells)
    rest = x - centres[nearest(x, centres)]
    books = [k_means(rest[:, a:a + part_width], min(codes, max(1, len(x) // 2))) for a in range(0, x.shape[1], part_width)]
    out = Quantiser(centres, books)
    _calibrate(out, x, k, target_recall)
    return out


def build_index(vectors: DataFrame, id_col: str, vec_col: str, quantiser: Quantiser) -> DataFrame:
    """``_id, _cell, _code`` of every row that has a vector."""
    ship_code()
    kind = vectors.schema[id_col].dataType.simpleString()

    def encode(batches):
        for pdf in batches:
            if len(pdf):
                cell, code = quantiser.encode(np.stack(pdf["v"].to_numpy()).astype(float))
                yield pd.DataFrame({"_id": pdf["_id"], "_cell": cell.astype(np.int32), "_code": [c.tobytes() for c in code]})

    rows = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(vec_col).alias("v"))
    return rows.mapInPandas(encode, f"_id {kind}, _cell int, _code binary")


def search(queries: DataFrame, vectors: DataFrame, id_col: str, vec_col: str, quantiser: Quantiser, k: int = 15,
           index: DataFrame | None = None, block_rows: int = 50_000, query_rows: int = 2_000) -> DataFrame:
    """``query, id, distance, rank``: the k nearest indexed rows of each query
    (never the row of its own id), ordered by exact distance, then id.

    A cell of many rows, or one that many queries visit, is dealt out in
    blocks of ``block_rows`` rows and ``query_rows`` queries, so no task
    grows with a frequent vector.  Codes travel, not vectors, until the
    finalists are known.  Rows and queries without a vector are left out."""
    ship_code()
    index = reliable_checkpoint(index if index is not None else build_index(vectors, id_col, vec_col, quantiser))
    kind, probes = vectors.schema[id_col].dataType.simpleString(), min(quantiser.probes, len(quantiser.centres))
    asked = queries.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("_q"), F.col(vec_col).alias("v"))

    @F.pandas_udf("array<int>")
    def visits(vecs: pd.Series) -> pd.Series:
        if not len(vecs):
            return pd.Series([], dtype=object)
        far = squared_distances(np.stack(vecs.to_numpy()).astype(float), quantiser.centres)
        return pd.Series(list(np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32)))

    # sizes of the cells: a row a cell, at most one for 32 sampled rows
    sizes = {r["_cell"]: r["count"] for r in index.groupBy("_cell").count().collect()}
    most = max(sizes.values(), default=0)
    visited = sorted(sizes.values(), reverse=True)[:probes]
    finalists = max(4 * k, math.ceil(quantiser.finalists_per_row * sum(visited)))
    blocks = max(1, -(-most // block_rows))
    of_cell = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for c, s in sizes.items() for v in (c, -(-s // block_rows))]), F.col("_cell")), F.lit(1)) \
        if blocks > 1 else F.lit(1)
    n_queries = asked.count()
    parts = max(1, -(-n_queries // query_rows))
    rows = index.select("_cell", F.pmod(F.xxhash64("_id"), of_cell).cast("int").alias("_b"), "_id", "_code",
                        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_p"))
    visit = asked.select("_q", "v", F.pmod(F.xxhash64("_q"), F.lit(parts)).cast("int").alias("_p"), F.explode(visits("v")).alias("_cell"))
    visit = visit.withColumn("_b", F.explode(F.sequence(F.lit(0), (of_cell - 1).cast("int"))))
    keys = ["_cell", "_b", "_p"]

    def rank(key, left, right):
        if left.empty or right.empty:
            return pd.DataFrame({"_q": [], "_id": [], "_e": []})
        right = right.sort_values("_id", kind="stable")
        names = right["_id"].to_numpy()
        codes = np.frombuffer(b"".join(right["_code"]), np.uint8).reshape(len(right), -1)
        own, x = left["_q"].to_numpy(), np.stack(left["v"].to_numpy()).astype(float)
        # a group's share of the finalists, fourfold, as near cells hold more
        share = max(2 * k, math.ceil(4 * quantiser.finalists_per_row * len(right)))
        out, step, keep = [], max(1, _CELLS // len(right)), min(finalists, share, len(right))
        for a in range(0, len(own), step):
            e = estimates(quantiser.tables(x[a:a + step], int(key[0])), codes)
            e[own[a:a + step, None] == names[None, :]] = np.inf
            at = np.argsort(e, axis=1, kind="stable")[:, :keep]  # ties by id
            got = np.take_along_axis(e, at, axis=1)
            i, j = np.nonzero(np.isfinite(got))
            out.append(pd.DataFrame({"_q": own[a:a + step][i], "_id": names[at[i, j]], "_e": got[i, j]}))
        return pd.concat(out, ignore_index=True)

    found = visit.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(rank, f"_q {kind}, _id {kind}, _e double")
    best = found.withColumn("_r", F.row_number().over(Window.partitionBy("_q").orderBy("_e", "_id"))).where(F.col("_r") <= finalists)
    near = (best.select("_q", "_id").join(vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_w")), "_id")
            .join(asked, "_q").select("_q", "_id", euclidean(F.col("v"), F.col("_w")).alias("distance")))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy("distance", "_id"))).where(F.col("rank") <= k)
    return near.select(F.col("_q").alias("query"), F.col("_id").alias("id"), "distance", "rank")


def exact_search(queries: DataFrame, vectors: DataFrame, id_col: str, vec_col: str, k: int = 15, block_rows: int = 20_000,
                 query_rows: int = 1_000) -> DataFrame:
    """The exact way, for measuring: every query meets every block of rows,
    k rows of each block go on."""
    ship_code()
    rows = vectors.where(F.col(vec_col).isNotNull())
    blocks = max(1, -(-rows.count() // block_rows))
    asked = queries.where(F.col(vec_col).isNotNull())
    parts = max(1, -(-asked.count() // query_rows))
    kind = vectors.schema[id_col].dataType.simpleString()
    spread = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.select(F.col(id_col).alias("_q"), F.col(vec_col).alias("v"), F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int").alias("_p"), spread(blocks).alias("_b"))
    right = rows.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("w"), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("_b"),
                        spread(parts).alias("_p"))

    def rank(left, right):
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "id": [], "distance": []})
        right = right.sort_values("_id", kind="stable")
        names, y = right["_id"].to_numpy(), np.stack(right["w"].to_numpy()).astype(float)
        own, x, out = left["_q"].to_numpy(), np.stack(left["v"].to_numpy()).astype(float), []
        step = max(1, _CELLS // len(right))
        for a in range(0, len(own), step):
            total = np.zeros((len(own[a:a + step]), len(y)))
            for j in range(y.shape[1]):
                total += (x[a:a + step, j, None] - y[None, :, j]) ** 2
            d = np.sqrt(total)
            d[own[a:a + step, None] == names[None, :]] = np.inf
            at = np.argsort(d, axis=1, kind="stable")[:, :k]
            got = np.take_along_axis(d, at, axis=1)
            i, j = np.nonzero(np.isfinite(got))
            out.append(pd.DataFrame({"query": own[a:a + step][i], "id": names[at[i, j]], "distance": got[i, j]}))
        return pd.concat(out, ignore_index=True)

    near = left.groupBy("_p", "_b").cogroup(right.groupBy("_p", "_b")).applyInPandas(rank, f"query {kind}, id {kind}, distance double")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row ``wanted, found, recall``: the share of exact neighbours that
    were found; a row as near as the farthest exact one counts as well."""
    edge = exact.groupBy("query").agg(F.max("distance").alias("edge"), F.count(F.lit(1)).alias("n"))
    good = found.join(edge, "query").where(F.col("distance") <= F.col("edge")).groupBy("query").agg(F.count(F.lit(1)).alias("got"))
    both = edge.join(good, "query", "left")
    return both.agg(F.sum("n").alias("wanted"), F.coalesce(F.sum(F.least("got", "n")), F.lit(0)).alias("found")).select(
        "wanted", "found", F.try_divide("found", "wanted").alias("recall"))


def ann_classify(df: DataFrame, id_col: str, vec_col: str, label_col: str, k: int = 15, **options) -> DataFrame:
    """Leave-one-out KNN label of every row, ``(id, label, pred)``, as
    :func:`neighbors.knn_classify` gives it, from the approximate search."""
    from .neighbors import weighted_vote
    df = df.where(F.col(vec_col).isNotNull())
    quantiser = fit_quantiser(df, id_col, vec_col, k, **options)
    near = search(df, df, id_col, vec_col, quantiser, k)
    labels = df.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_lab"))
    votes = near.join(labels.withColumnsRenamed({"_id": "id", "_lab": "_dlab"}), "id").select(
        F.col("query").alias("_id"), "_dlab", F.col("distance").alias("_d"))
    return labels.join(weighted_vote(votes), "_id", "left").select(F.col("_id").alias(id_col), F.col("_lab").alias(label_col), "pred")
