"""SimHash near-duplicates: a self-join of binary tries of the fingerprints.

A fingerprint is seen as a path in a binary trie.  Two fingerprints within
``max_bits`` are found by walking pairs of trie nodes together: a pair of
nodes carries the number of bits in which their paths differ, and a pair is
pruned when that number exceeds the budget of its depth.

The budget is spent evenly.  Cut the 64 bits into ``max_bits + 1`` blocks.
If all of them together differ in at most ``max_bits`` bits, then some
rotation of the blocks has at most ``l * max_bits / blocks`` differing bits
in its first ``l`` blocks, for every ``l``.  So each rotation has its own
trie, whose node pairs are pruned by that much tighter budget; in the first
block it is 0, so the node pairs of a trie start as its nodes at that depth,
which is how Spark deals them out.  Nodes that hold more than ``node_rows``
fingerprints are descended in Spark, block by block, into pairs of their
children; no task gets more than such a node pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, doc_key, materialise, reliable_checkpoint, row_struct, ship_code, shuffle_partitions
from .components import connected_components

BITS = 64


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42, block: int = 1 << 15) -> int:
    """SimHash of one text (UTF-8); no words give 0.

    Bit counts are added up over blocks of shingles, so a very long text
    needs little beside its words."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        starts, ends = [0], [len(joined)]
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts, ends = [0, *(stops[:n - 1] + 1).tolist()], stops[shingle - 1:].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, block):
        h = [digest(view[s:e], seed) for s, e in zip(starts[a:a + block], ends[a:a + block])]
        ones += np.unpackbits(np.array(h, ">u8").view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of a string column as a long (two's complement)."""
    ship_code()

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return simhash(F.coalesce(text, F.lit("")).cast("binary"))


def hex_column(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# -- the trie self-join ------------------------------------------------------

def _blocks(max_bits: int) -> list[int]:
    """Widths of the blocks, as even as can be."""
    m = max_bits + 1
    return [BITS // m + (i < BITS % m) for i in range(m)]


def _cuts(max_bits: int, rotation: int) -> list[int]:
    """Depths (in bits) at which the blocks of a rotation end."""
    w = _blocks(max_bits)
    return np.cumsum(w[rotation:] + w[:rotation]).tolist()


def _allowed(max_bits: int, blocks_done: int) -> int:
    return blocks_done * max_bits // (max_bits + 1)


def _depth_budget(max_bits: int, rotation: int) -> np.ndarray:
    """Most differing bits in the first d bits, for d = 0 .. 64."""
    cuts = _cuts(max_bits, rotation)
    return np.array([_allowed(max_bits, int(np.searchsorted(cuts, d)) + 1) if d else 0 for d in range(BITS + 1)])


class _Forest:
    """Least-index labels of what has been linked so far."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            new = a != b
            if not new.any():
                return
            i, j, a, b = i[new], j[new], a[new], b[new]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def _compare(fp: np.ndarray, pairs: np.ndarray, max_bits: int, forest: _Forest, slab: int = 1 << 20) -> None:
    """Compare the leaves below node pairs that are small enough, a slab at a time."""
    alo, ahi, blo, bhi = pairs
    na, nb = ahi - alo, bhi - blo
    ends = np.cumsum(na * nb)
    first = 0
    while first < len(ends):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + slab, "right")))
        k = np.repeat(np.arange(first, last), (na * nb)[first:last])
        at = np.arange(len(k)) - np.repeat(ends[first:last] - (na * nb)[first:last] - done, (na * nb)[first:last])
        i, j = alo[k] + at // nb[k], blo[k] + at % nb[k]
        near = (i < j) & (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits)
        forest.link(i[near], j[near])
        first = last


def trie_links(fp: np.ndarray, a: np.ndarray, b: np.ndarray, cross: np.ndarray, rotation: int, depth: int,
               max_bits: int, leaf_pairs: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links within the node pairs of one rotation, as a forest of indices.

    ``fp``: fingerprints (unsigned), sorted within each node; ``a``, ``b``:
    ``(lo, hi)`` ranges of the nodes of each pair, the same range twice for
    a node with itself; ``cross``: bits in which the paths differ so far."""
    forest, budget = _Forest(len(fp)), _depth_budget(max_bits, rotation)
    alo, ahi, blo, bhi, err = a[0], a[1], b[0], b[1], cross
    for d in range(depth, BITS + 1):
        small = ((ahi - alo) * (bhi - blo) <= leaf_pairs) | (d == BITS)
        if small.any():
            _compare(fp, np.stack([x[small] for x in (alo, ahi, blo, bhi)]), max_bits, forest)
        alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            break
        ones = np.concatenate([[0], np.cumsum((fp >> np.uint64(BITS - 1 - d)) & np.uint64(1), dtype=np.int64)])
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        one = alo != blo  # (1, 0) is the same pair as (0, 1) for a node with itself
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
                 tuple(x[one] for x in (amid, ahi, blo, bmid, err + 1))]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts))
        go = (ahi > alo) & (bhi > blo) & (err <= budget[d + 1]) & ((alo != blo) | (ahi - alo > 1))
        alo, ahi, blo, bhi, err = (x[go] for x in (alo, ahi, blo, bhi, err))
    child = np.flatnonzero(forest.label != np.arange(len(fp)))
    return child, forest.label[child]


def _join_units(rows: dict[str, np.ndarray], max_bits: int) -> pa.RecordBatch:
    """Links of whole node pairs: rows with ``rot, level, pa, pb, fp``."""
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    kinds = np.unique(np.stack([rows["rot"], rows["level"]]), axis=1)
    for rot, level in kinds.T.tolist():
        own = (rows["rot"] == rot) & (rows["level"] == level)
        fp, pa_, pb = rows["fp"][own].view(np.uint64), rows["pa"][own].view(np.uint64), rows["pb"][own].view(np.uint64)
        pa_, pb = np.minimum(pa_, pb), np.maximum(pa_, pb)
        order = np.lexsort((fp, pb, pa_))
        fp, pa_, pb = fp[order], pa_[order], pb[order]
        starts = np.flatnonzero(np.concatenate([[True], (pa_[1:] != pa_[:-1]) | (pb[1:] != pb[:-1])]))
        ends = np.append(starts[1:], len(fp))
        depth = _cuts(max_bits, rot)[level - 1]
        in_a = np.concatenate([[0], np.cumsum((fp >> np.uint64(BITS - depth)) == pa_)])
        mid = starts + in_a[ends] - in_a[starts]
        self_pair = pa_[starts] == pb[starts]
        a = np.stack([starts, np.where(self_pair, ends, mid)])
        b = np.stack([np.where(self_pair, starts, mid), ends])
        cross = np.bitwise_count(pa_[starts] ^ pb[starts]).astype(np.int64)
        go = (a[1] > a[0]) & (b[1] > b[0]) & (~self_pair | (ends - starts > 1))
        i, j = trie_links(fp, a[:, go], b[:, go], cross[go], rot, depth, max_bits)
        turn = (sum(_blocks(max_bits)[:rot])) % BITS  # turn the rotation back
        back = (fp >> np.uint64(turn)) | (fp << np.uint64((BITS - turn) % BITS)) if turn else fp
        us.append(back[i].view(np.int64))
        vs.append(back[j].view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])


def _unit_stream(max_bits: int, batch_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] | None = None
        for batch in batches:
            new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            kept = new if kept is None else {c: np.concatenate([kept[c], new[c]]) for c in new}
            if len(kept["fp"]) < batch_rows:
                continue
            # the last node pair may go on in the next batch
            last = np.ones(len(kept["fp"]), bool)
            for c in ("rot", "level", "pa", "pb"):
                last &= kept[c] == kept[c][-1]
            if not last.all():
                yield _join_units({c: x[~last] for c, x in kept.items()}, max_bits)
                kept = {c: x[last] for c, x in kept.items()}
        if kept is not None and len(kept["fp"]):
            yield _join_units(kept, max_bits)
    return run


def _prefix(fp: Column, rot: Column, max_bits: int, level: int) -> Column:
    """Path of a rotated fingerprint to the end of its level-th block."""
    out = None
    for r in range(max_bits + 1):
        cut = _cuts(max_bits, r)[level - 1]
        p = F.shiftrightunsigned(fp, BITS - cut)
        out = F.when(rot == r, p) if out is None else out.when(rot == r, p)
    return out


def _masks(width: int, most: int) -> list[int]:
    """Block values of at most ``most`` set bits."""
    out, layer = [0], [0]
    for _ in range(most):
        layer = sorted({x | 1 << i for x in layer for i in range(width) if not x >> i & 1})
        out += layer
    return out


def _descend(hot: DataFrame, max_bits: int, level: int) -> DataFrame:
    """Pairs of the children of large node pairs, within the budget."""
    most = _allowed(max_bits, level + 1)
    width = max(_blocks(max_bits))
    spent = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")))
    own = _prefix(F.col("fp"), F.col("rot"), max_bits, level + 1)
    masks = None
    for left in range(most, -1, -1):
        lists = F.lit(_masks(width, left)).cast("array<bigint>")
        masks = F.when(spent == most - left, lists) if masks is None else masks.when(spent == most - left, lists)
    at_a = _prefix(F.col("fp"), F.col("rot"), max_bits, level) == F.col("pa")
    shift = [_cuts(max_bits, r)[level] - _cuts(max_bits, r)[level - 1] for r in range(max_bits + 1)]
    other = F.when(at_a, F.col("pb")).otherwise(F.col("pa"))
    turned = None
    for r, s in enumerate(shift):
        block = F.col("own").bitwiseAND(F.lit((1 << s) - 1)).bitwiseXOR(F.col("mask"))
        v = F.shiftleft(F.col("other"), s).bitwiseOR(block)
        ok = F.col("rot") == r
        turned = F.when(ok & (F.col("mask") < (1 << s)), v) if turned is None else turned.when(
            ok & (F.col("mask") < (1 << s)), v)
    itself = F.col("pa") == F.col("pb")
    rows = (hot.select("*", own.alias("own"), at_a.alias("at_a"), other.alias("other"), F.explode(masks).alias("mask"))
            .withColumn("that", turned).where(F.col("that").isNotNull()))
    return rows.select(
        "rot", F.lit(level + 1).alias("level"),
        F.when(itself, F.least("own", "that")).when(F.col("at_a"), F.col("own")).otherwise(F.col("that")).alias("pa"),
        F.when(itself, F.greatest("own", "that")).when(F.col("at_a"), F.col("that")).otherwise(F.col("own")).alias("pb"),
        "fp")


def near_links(fps: DataFrame, max_bits: int = 4, node_rows: int = 20_000, batch_rows: int = 200_000) -> DataFrame:
    """Links ``(u, v)`` that connect all fingerprints within ``max_bits``.

    ``fps`` has distinct longs in ``fp``.  The links span every group of
    linked fingerprints but leave out pairs already connected within a task.
    """
    ship_code()
    m = max_bits + 1
    turns = np.cumsum([0, *_blocks(max_bits)])[:m].tolist()
    turned = [F.struct(F.lit(r).alias("rot"), (F.col("fp") if not t else F.shiftleft("fp", t).bitwiseOR(
        F.shiftrightunsigned("fp", BITS - t))).alias("fp")) for r, t in enumerate(turns)]
    rows = fps.where(F.col("fp").isNotNull()).select(F.inline(F.array(*turned)))
    path = _prefix(F.col("fp"), F.col("rot"), max_bits, 1)
    units = rows.select("rot", F.lit(1).alias("level"), path.alias("pa"), path.alias("pb"), "fp")
    key, out = ["rot", "level", "pa", "pb"], None
    for level in range(1, m + 1):
        cool, hot = units, None
        if level < m:
            large = reliable_checkpoint(units.groupBy(*key).count().where(F.col("count") > node_rows).drop("count"))
            if large.head(1):
                cool = units.join(large, key, "left_anti")
                hot = reliable_checkpoint(_descend(units.join(large, key, "left_semi"), max_bits, level))
        links = (cool.repartition(shuffle_partitions(fps.sparkSession), *key).sortWithinPartitions(*key)
                 .mapInArrow(_unit_stream(max_bits, batch_rows), "u long, v long"))
        out = links if out is None else out.unionByName(links)
        if hot is None:
            break
        units = hot
    return out


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, node_rows: int = 20_000) -> DataFrame:
    """Near-duplicate class of every document.

    Returns one row per input row: ``id``, ``fp`` (the fingerprint as a
    long), ``component_id`` (the smallest id in the class) and ``keep``
    (this id and fingerprint stand for the class).  Whole texts, lower-cased
    A-Z, in word shingles with repeats.

    Null or empty texts, and texts without words, have fingerprint 0 and are
    linked like any other.  A null id counts as greater than all others; a
    class of null ids has a null ``component_id``, and its least fingerprint
    stands for it.  Rows repeated exactly get the same values each.  Very
    long texts are hashed whole, in blocks of shingles.  An empty table gives no rows.  Other columns are not looked at.
    """
    marked = materialise(docs.select(col(id_col).alias("id"), fingerprint_column(col(text_col), shingle).alias("fp")),
                         "simhash")
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("fp"))
    least = marked.groupBy("fp").agg(F.min(order).alias("rep"))
    labels = connected_components(near_links(least.select("fp"), max_bits, node_rows))
    rooted = (least.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    reps = rooted.groupBy("root").agg(F.min("rep").alias("rep"))
    classes = rooted.select("fp", "root").join(reps, "root").select("fp", "rep")
    return marked.join(classes, "fp").select(
        "id", "fp", F.col("rep.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("fp") == F.col("rep.fp"))).alias("keep"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                         max_bits: int = 4) -> DataFrame:
    """One document of each class, the one with the smallest id, all columns kept.

    Rows that share both id and fingerprint count as one document.  Null,
    empty and very long texts, null ids and empty tables are taken as in
    ``simhash_components``: texts without words are one class."""
    keep = (simhash_components(docs, id_col, text_col, shingle, max_bits).where("keep")
            .select(F.col("id").alias("keep_id"), F.col("fp").alias("keep_fp")).distinct())
    marked = docs.select(row_struct(docs), *doc_key(id_col, text_col), fingerprint_column(col(text_col), shingle).alias("fp"))
    kept = marked.join(keep, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("fp") == F.col("keep_fp")))
    once = Window.partitionBy("keep_id", "keep_fp").orderBy("h1", "h2")
    return kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row.*")
