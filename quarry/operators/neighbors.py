"""Exact k-nearest-neighbour classifier over vector columns.

Semantics of a distance-weighted KNN classifier (Euclidean, k neighbours,
weights 1/d; when some of a row's k neighbours are at distance 0 only
those vote, each with weight 1; the heaviest label wins, ties to the
smallest label).  Neighbours are ordered by (distance, id), and every row
is classified by the other rows (leave-one-out), so the whole table is
both the training and the query side.

No cross join and no per-group pair list: the plan is a block join.

1. Directions.  The top principal directions come from MLlib's PCA (a
   d x d covariance reduced on the driver: bounded by the dimension, not
   by the rows).  Projections onto orthonormal directions never increase
   distances, so ``||P(x - q)|| <= ||x - q||`` is a lower bound.
2. Blocks.  Rows are ranked by the first projection (one range sort,
   checkpointed) and cut into blocks of equal size (a hot projection value
   is split by the id tie-break, so no block grows with skew).  The k-th
   smallest distance inside a row's own block bounds its true k-th
   neighbour distance from above: its reach.
3. Block join.  The donors of a block go to the blocks of queries whose
   projections, widened by their reach, meet the donors' projections, and
   stream past them in Arrow batches, nearest blocks first.  A matrix
   product says which pairs may lie within a query's k-th distance so far;
   only these few get their exact distance (double, summed in index order).
   A task holds one block of queries and one batch: pairs never become rows
   or shuffle.
4. The top k per query over the parts of its stream, then the weighted vote.

On clustered embeddings few blocks meet.  On near-isotropic vectors
(distance concentration) no exact bound prunes: the work is then a blocked
all-pairs matrix product, spread over tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .ranking import group_positions

# Relative and absolute slack on the pruning bounds (never on the ranking):
# projections and distances are rounded differently, and a wider band only
# adds candidates that the exact distance then ranks.
_REL_SLACK = 1e-9
_ABS_SLACK = 1e-12
# Blocks that the rows are cut into, at least where there are enough rows
# for that, and rows of a block at most.
_BLOCKS, _BLOCK_ROWS = 24, 16_384
# Parts that a query block's donors are dealt to, at most.
_PARTS = 4
# Matrix cells computed at once (queries are taken in chunks of this many
# cells per batch of donors): bounds task memory.
_TILE_CELLS = 4_000_000


def dots(vec: Column, directions) -> Column:
    """Projections of a vector on fixed directions, as an array (numpy in
    Arrow batches: no expression grows with the dimension)."""
    import numpy as np
    matrix = np.asarray(directions, float).T

    @F.pandas_udf("array<double>")
    def project(vectors):
        import pandas as pd
        return pd.Series(list(np.stack(vectors.to_numpy()).astype(float) @ matrix)) if len(vectors) else pd.Series([], dtype=object)
    return project(vec)


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two numeric arrays of one length, summed in
    double in index order (the same rounding as a sequential loop)."""
    import numpy as np

    @F.pandas_udf("double")
    def distance(left, right):
        import pandas as pd
        if not len(left):
            return pd.Series([], dtype=float)
        x, y = (np.stack(v.to_numpy()).astype(float) for v in (left, right))
        total = np.zeros(len(x))
        for j in range(x.shape[1]):
            total += (x[:, j] - y[:, j]) ** 2
        return pd.Series(np.sqrt(total))
    return distance(a, b)


def vector_dim(vectors: DataFrame, vec_col: str) -> int:
    row = vectors.select(F.size(vec_col).alias("d")).where("d > 0").first()
    return int(row["d"]) if row else 0


def principal_directions(vectors: DataFrame, vec_col: str, n_dirs: int) -> list[list[float]]:
    """Top ``n_dirs`` principal directions of an array column (unit vectors).
    The covariance on the driver is bounded by the dimension.  A single
    vector has no covariance; any unit vector serves."""
    dim = vector_dim(vectors, vec_col)
    n_dirs = max(1, min(n_dirs, dim))
    if vectors.limit(2).count() < 2:
        return [[1.0 if j == i else 0.0 for j in range(dim)] for i in range(n_dirs)]
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    vv = vectors.select(array_to_vector(F.col(vec_col)).alias("_vv"))
    pc = PCA(k=n_dirs, inputCol="_vv").fit(vv).pc.toArray()  # dim x n_dirs
    return [[float(pc[j, i]) for j in range(dim)] for i in range(n_dirs)]


def _matrix(vectors):
    import numpy as np
    return np.stack(vectors.to_numpy()).astype("float64")


def _scores(x, centre):
    """For the matrix product: rows about ``centre`` and half their squared
    lengths; half a squared distance is the halves' sum less the product.
    The last is what rounding can shift a row's distances by."""
    import numpy as np
    z = x - centre
    half = 0.5 * (z * z).sum(1)
    return z, half, 8 * np.finfo(float).eps * np.sqrt(x.shape[1]) * np.sqrt((x * x).sum(1) + centre @ centre)


def _kind(half):
    """Single precision for the matrix product where its range holds the rows."""
    import numpy as np
    return np.float32 if np.nanmax(half, initial=0) < 1e30 else np.float64


def _at_most(distance, blur, half, dim: int, kind):
    """Half of the greatest squared distance that the matrix product can
    show, in ``kind``, where the exact one is ``distance`` at most; ``half``
    is half of both rows' squared lengths."""
    import numpy as np
    eps = np.finfo(kind).eps
    wide = distance * (1 + _REL_SLACK) + blur + 4 * eps * np.sqrt(dim * half) + _ABS_SLACK
    return 0.5 * wide * wide + (dim + 8) * 4 * eps * half


def _block_reach(k: int):
    """For the rows of a block, an upper bound of the distance of the k-th
    other row (infinite where the block has fewer)."""
    def run(pdf):
        import numpy as np
        import pandas as pd
        x = _matrix(pdf["_v"])
        names = pd.factorize(pdf["_id"])[0]
        z, half, blur = _scores(x, x.mean(0))
        out = np.full(len(x), np.inf)
        step = max(1, _TILE_CELLS // len(x))
        for a in range(0, len(x) if len(x) > k else 0, step):
            part = slice(a, a + step)
            far = half[part, None] + half[None, :] - z[part] @ z.T
            far[names[part, None] == names[None, :]] = np.inf
            kth = np.partition(far, k - 1, axis=1)[:, k - 1]
            noise = (x.shape[1] + 8) * 4 * np.finfo(float).eps * (half[part] + half.max())
            out[part] = np.sqrt(2 * np.maximum(kth + noise, 0)) * (1 + _REL_SLACK) + blur[part] + blur.max() + _ABS_SLACK
        return pd.DataFrame({"_pos": pdf["_pos"], "_r": out})
    return run


class _Nearest:
    """A block of queries and the k nearest of the donors seen so far."""

    def __init__(self, rows, k: int, dims: int):
        import numpy as np
        self.rows, self.k = rows, k
        self.x, self.p = _matrix(rows["_v"]), _matrix(rows["_p"])[:, :dims]
        self.centre = self.x.mean(0)
        self.z, self.half, self.blur = _scores(self.x, self.centre)
        self.reach = rows["_r"].to_numpy("float64").copy()
        self.names = rows["_id"].to_numpy()
        self.found, self.fresh = [], 0
        self.live = np.flatnonzero(~np.isnan(self.half))

    def add(self, donors) -> None:
        import numpy as np
        import pandas as pd
        x, p = _matrix(donors["_v"]), _matrix(donors["_p"])[:, :self.p.shape[1]]
        z, half, blur = _scores(x, self.centre)
        good = ~np.isnan(half)
        if not good.any():
            return
        names, labels = donors["_id"].to_numpy(), donors["_lab"].to_numpy()
        low, high = np.min(p[good], axis=0), np.max(p[good], axis=0)
        gap = np.maximum(0, np.maximum(low - self.p, self.p - high))
        wide = self.reach * (1 + _REL_SLACK) + _ABS_SLACK
        slack = self.blur + blur[good].max()
        rows = self.live[((gap * gap).sum(1) <= (wide + slack) ** 2)[self.live]]
        step = max(1, _TILE_CELLS // len(donors))
        kind = np.promote_types(_kind(self.half), _kind(half))
        there, here, far_half = z.astype(kind).T, self.z.astype(kind), half.astype(kind)
        for a in range(0, len(rows), step):
            at = rows[a:a + step]
            limit = _at_most(self.reach[at], slack[at], self.half[at] + half[good].max(), x.shape[1], kind) - self.half[at]
            i, j = np.nonzero(far_half[None, :] - here[at] @ there <= limit[:, None].astype(kind))
            i = at[i]
            other = self.names[i] != names[j]
            i, j = i[other], j[other]
            total = np.zeros(len(i))
            for c in range(x.shape[1]):
                diff = self.x[i, c] - x[j, c]
                total += diff * diff
            far = np.sqrt(total)
            near = far <= self.reach[i]
            self.found.append(pd.DataFrame({"_q": i[near], "_d": far[near], "_did": names[j[near]], "_dlab": labels[j[near]]}))
            self.fresh += int(near.sum())
            if self.fresh > max(2 * self.k * len(self.names), _TILE_CELLS):
                self.settle()
        if self.fresh > self.k * len(self.names):
            self.settle()

    def settle(self) -> None:
        """Keep the k nearest of each query; the k-th is its reach."""
        import numpy as np
        import pandas as pd
        if not self.fresh:
            return
        top = pd.concat([f for f in self.found if len(f)], ignore_index=True).sort_values(["_q", "_d", "_did"], kind="stable")
        place = top.groupby("_q").cumcount()
        top = top[place < self.k]
        last = top[place[place < self.k] == self.k - 1]
        at = last["_q"].to_numpy()
        self.reach[at] = np.minimum(self.reach[at], last["_d"].to_numpy())
        self.found, self.fresh = [top], 0

    def result(self):
        import pandas as pd
        self.settle()
        top = self.found[0] if self.found else pd.DataFrame({c: [] for c in ("_q", "_d", "_did", "_dlab")})
        at = top["_q"].to_numpy(int)
        return pd.DataFrame({"_id": self.names[at], "_did": top["_did"].to_numpy(), "_dlab": top["_dlab"].to_numpy(), "_d": top["_d"].to_numpy()})


def _stream(k: int, dims: int):
    """Each group ``_g`` brings its queries, then its donors."""
    def run(batches):
        import pandas as pd
        group, waiting, block = None, [], None
        for pdf in batches:
            for g, part in pdf.groupby("_g", sort=False):
                if g != group:
                    if block is not None:
                        yield block.result()
                    group, waiting, block = g, [], None
                if block is None:
                    waiting.append(part[part["_near"] < 0])
                part = part[part["_near"] >= 0]
                if len(part):
                    if block is None:
                        block = _Nearest(pd.concat(waiting, ignore_index=True), k, dims)
                    block.add(part)
        if block is not None:
            yield block.result()
    return run


def knn_classify(df: DataFrame, id_col: str, vec_col: str, label_col: str, k: int = 15,
                 n_dirs: int = 4, tile_rows: int = _BLOCK_ROWS, min_bucket_rows: int = 256) -> DataFrame:
    """Leave-one-out KNN label for every row: ``(id, label, pred)``.

    ``id_col`` must be unique; rows with a NULL vector are not classified
    and are not neighbours.  Vectors must share one length.  A block has
    ``tile_rows`` rows at most.
    """
    spark = df.sparkSession
    base = df.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), F.col(label_col).alias("_lab"))
    from ..session import ship_code
    ship_code()
    dirs = principal_directions(base, "_v", n_dirs)
    m = len(dirs)
    pts = base.withColumn("_p", dots(F.col("_v"), dirs)).withColumn("_p0", F.get("_p", F.lit(0)))

    # 1. Rank by the first projection (unique tie-break: hot values split).
    ranked = group_positions(pts, [], [F.col("_p0"), F.col("_id")], pos_col="_pos", size_col=None)
    ranked = reliable_checkpoint(ranked)
    n = ranked.count()
    id_t, lab_t = (df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    if n == 0:
        return spark.createDataFrame([], f"{id_col} {id_t}, {label_col} {lab_t}, pred {lab_t}")

    # 2. Equal blocks by rank, and the reach of every row in its own block.
    block_rows = min(max(min_bucket_rows, math.ceil(n / _BLOCKS)), tile_rows)
    blocks = math.ceil(n / block_rows)
    base = ranked.withColumn("_b", F.floor(F.col("_pos") * blocks / n).cast("int"))
    reach = base.select("_b", "_pos", "_id", "_v").groupBy("_b").applyInPandas(_block_reach(k), "_pos long, _r double")
    base = reliable_checkpoint(base.join(reach, "_pos"))

    # 3. Which blocks meet: a row a block, and a row a pair of blocks (a
    # proven bound: (rows / block rows)^2), so the fan-out join broadcasts.
    # Without a number for a projection a block meets every other.
    wide = F.col("_r") * (1 + _REL_SLACK) + _ABS_SLACK
    known = lambda c: F.when(~F.isnan("_p0"), c)
    ranges = base.groupBy("_b").agg(F.min(known(F.col("_p0"))).alias("lo"), F.max(known(F.col("_p0"))).alias("hi"),
                                    F.min(known(F.col("_p0") - wide)).alias("from"), F.max(known(F.col("_p0") + wide)).alias("to"))
    q, d = (ranges.select(*[F.col(c).alias(f"{side}_{c}") for c in ranges.columns]) for side in ("q", "d"))
    parts = min(_PARTS, blocks)
    meets = F.coalesce((F.col("d_hi") >= F.col("q_from")) & (F.col("d_lo") <= F.col("q_to")), F.lit(True))
    tiles = q.join(F.broadcast(d), meets).select("q__b", "d__b", F.abs(F.col("q__b") - F.col("d__b")).alias("_near"))
    group = lambda part: (F.col("q__b") * parts + part).cast("int").alias("_g")
    columns = ["_id", "_lab", "_v", "_p", "_r"]
    queries = base.withColumnRenamed("_b", "q__b").select(
        "q__b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"), *columns).select(group(F.col("_part")), F.lit(-1).alias("_near"), *columns)
    donors = base.join(F.broadcast(reliable_checkpoint(tiles)), F.col("_b") == F.col("d__b")).select(
        group(F.pmod(F.col("d__b") - F.col("q__b"), F.lit(parts))), "_near", *columns)
    stream = queries.unionByName(donors).repartition(max(blocks * parts, 1), "_g").sortWithinPartitions("_g", "_near")
    cand = stream.mapInPandas(_stream(k, m), f"_id {id_t}, _did {id_t}, _dlab {lab_t}, _d double")

    # 4. The top k per query over its parts, and their vote.
    order = [F.col("_d"), F.col("_did")]
    top = cand.withColumn("_rn", F.row_number().over(Window.partitionBy("_id").orderBy(*order))) \
        .where(F.col("_rn") <= k)
    best = weighted_vote(top)
    # a row without any other row has no prediction
    return ranked.select("_id", "_lab").join(best, "_id", "left").select(
        F.col("_id").alias(id_col), F.col("_lab").alias(label_col), "pred")


def weighted_vote(neighbours: DataFrame) -> DataFrame:
    """``_id, pred`` from the neighbours ``_id, _dlab, _d`` of each row: the
    heaviest label by weights 1/distance; where some are at distance 0 only
    those vote.  Ties go to the smallest label."""
    top = neighbours.withColumn("_has0", F.min("_d").over(Window.partitionBy("_id")) == 0)
    weight = F.when(F.col("_has0"), (F.col("_d") == 0).cast("double")).otherwise(1.0 / F.col("_d"))
    votes = top.groupBy("_id", "_dlab").agg(F.sum(weight).alias("_w"))
    return votes.groupBy("_id").agg(F.min_by("_dlab", F.struct(-F.col("_w"), F.col("_dlab"))).alias("pred"))
