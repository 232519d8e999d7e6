"""Language-model scores by deleted interpolation.

A token's probability is a mixture of its maximum-likelihood estimates from
the pair with the token before it, from the token alone, and from a uniform
share; the weights depend on how frequent the token before is.  They are
learned by expectation-maximisation on counts of a part of the training
texts that is left out of the estimates; then the estimates are made again
from all training texts.

Counts are gathered by keys.  Texts are packed into chunks once.  A chunk
asks for its distinct keys (64-bit hashes of tokens and token pairs), with
how often it has each; the answers come back in the order of its keys, so
tokens never travel one by one, and a key that all texts share is one entry
a chunk.  Key ranges are as many as the size of the texts asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialise, ship_code

#: Parts of the texts: estimates, left out for the weights, not for training.
RETAINED, DELETED, HELD_OUT = 0, 1, 2
BUCKETS = 32
#: Steps an octave in which ratios of estimates are counted for the weights.
STEPS = 8
EVEN = np.uint64(0xFFFFFFFFFFFFFFFE)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Word to 64-bit hash, remembered while a chunk is read."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 7) & ~1
        return value


def _marker(name: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(name.encode(), 11) & ~1)


#: No word has white space, so these are no words.
END, BEGIN = _marker("\n end"), _marker("\n begin")


def pair_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    a, b, c = (np.uint64(m) for m in _MULTIPLIERS)
    k = before * a + token * b
    k ^= k >> np.uint64(32)
    k *= c
    return (k ^ (k >> np.uint64(29))) | np.uint64(1)


class Tokens:
    """Tokens of a chunk of texts: ids, the id before each, and text ends."""

    def __init__(self, bodies: list[bytes | None]):
        seen, parts, sizes = _Hashes(), [], []
        for body in bodies:
            words = (body or b"").lower().split()
            parts += [np.fromiter(map(seen.__getitem__, words), np.uint64, len(words)), np.array([END], np.uint64)]
            sizes.append(len(words) + 1)
        self.sizes = np.array(sizes, np.int64)
        self.ids = np.concatenate(parts)
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.before[self.starts] = BEGIN
        self.pairs = pair_keys(self.before, self.ids)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in order, and how often the chunk has each."""
        begins = np.full(len(self.sizes), BEGIN)
        return np.unique(np.concatenate([self.ids, begins, self.pairs]), return_counts=True)


def planes(values: np.ndarray) -> bytes:
    """Bytes by place, so that the alike high bytes of sorted values compress."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(blob: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(kind).ravel()


# -- packing -----------------------------------------------------------------

def _pack(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[int, list[pa.RecordBatch]] = {}
        size: dict[int, int] = {}

        def flush(part: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            table = pa.Table.from_batches(held.pop(part))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            row = [f"{task}-{made}"], [part], [size.pop(part)], [sink.getvalue().to_pybytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0]), pa.array(row[1], pa.int32()), pa.array(row[2], pa.int64()), pa.array(row[3], pa.binary())],
                ["chunk", "part", "n_bytes", "blob"])

        for batch in batches:
            lengths = np.array([len(x) for x in batch.column("body").to_pylist()], np.int64)
            parts = batch.column("part").to_numpy()
            for part in np.unique(parts).tolist():
                at = np.flatnonzero(parts == part)
                # cut where the running size fills a chunk
                room = np.cumsum(lengths[at]) + size.get(part, 0)
                for _, own in sorted({int(c): at[room // chunk_bytes == c] for c in np.unique(room // chunk_bytes)}.items()):
                    held.setdefault(part, []).append(batch.select(["id", "body"]).take(pa.array(own)))
                    size[part] = size.get(part, 0) + int(lengths[own].sum())
                    if size[part] >= chunk_bytes:
                        yield flush(part)
        for part in sorted(held):
            yield flush(part)
    return run


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


# -- counting ----------------------------------------------------------------

def _ask(ranges: int):
    """Keys of each chunk by key range, in order, with the chunk's counts."""
    edges = np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, part, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "blob"))):
                keys, counts = Tokens(_unpack(blob).column("body").to_pylist()).keys()
                if part == HELD_OUT:
                    counts = np.zeros_like(counts)
                cut = np.append(np.searchsorted(keys, edges), len(keys))
                own = [r for r in range(ranges) if cut[r + 1] > cut[r]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([chunk] * len(own)), pa.array([part] * len(own), pa.int32()),
                     pa.array([planes(keys[cut[r]:cut[r + 1]]) for r in own], pa.binary()),
                     pa.array([planes(counts[cut[r]:cut[r + 1]].astype(np.uint32)) for r in own], pa.binary())],
                    ["range", "chunk", "part", "keys", "counts"])
    return run


ANSWERS = "chunk string, part int, range int, all binary, retained binary, n_all long, v_all long, n_retained long, v_retained long"


def _answer(table: pa.Table) -> pa.Table:
    """Counts of one key range over all chunks, sent back chunk by chunk."""
    chunks, parts = table.column("chunk").to_pylist(), table.column("part").to_pylist()
    keys = [unplanes(x.as_py(), np.uint64) for x in table.column("keys")]
    counts = [unplanes(x.as_py(), np.uint32) for x in table.column("counts")]
    sizes = [len(k) for k in keys]
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    kind = np.repeat(np.array(parts), sizes)
    amount = np.concatenate(counts).astype(np.float64)
    # over all chunks a key may pass 2**32; doubles are whole up to 2**53
    retained = np.bincount(at, amount * (kind == RETAINED), len(known)).astype(np.uint64)
    everything = np.bincount(at, amount, len(known)).astype(np.uint64)
    single = (known & np.uint64(1) == 0) & (known != BEGIN)
    stats = [int(f(c[single])) for c in (everything, retained) for f in (lambda x: x.sum(dtype=np.int64), np.count_nonzero)]
    ends = np.cumsum(sizes)
    own = [at[e - n:e] for e, n in zip(ends, sizes)]
    n = len(chunks)
    r = table.column("range")[0].as_py()
    columns = [chunks + [None], parts + [None], [r] * (n + 1), [planes(everything[i]) for i in own] + [None],
               [planes(retained[i]) if p == DELETED else None for i, p in zip(own, parts)] + [None]]
    columns += [[None] * n + [s] for s in stats]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in ANSWERS.split(", ")])


def _token_counts(tokens: Tokens, answers: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: count of the pair, of the token, of the token before."""
    keys, _ = tokens.keys()
    order = np.argsort(answers.column("range").to_numpy())
    blobs = answers.column(column).to_pylist()
    counts = np.concatenate([unplanes(blobs[i], np.uint64) for i in order]).astype(np.float64)
    if len(counts) != len(keys):
        raise RuntimeError("answers do not fit the chunk")
    one = counts[np.searchsorted(keys, tokens.ids)]
    before = np.empty_like(one)
    before[1:] = one[:-1]
    before[tokens.starts] = counts[np.searchsorted(keys, BEGIN)]
    return counts[np.searchsorted(keys, tokens.pairs)], one, before


def _bucket(before: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(before + 1).astype(np.int64), BUCKETS - 1)


# -- weights -----------------------------------------------------------------

def _cells(n: int, v: int):
    """Held-out counts by bucket and by the estimates' ratios to the uniform share."""
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        cells: dict[tuple[int, int, int], int] = {}
        if packed.num_rows:
            tokens = Tokens(_unpack(packed.column("blob")[0].as_py()).column("body").to_pylist())
            pair, one, before = _token_counts(tokens, answers, "retained")
            with np.errstate(divide="ignore"):
                two = np.where(pair > 0, np.rint(STEPS * np.log2(pair / np.maximum(before, 1) * (v + 1))), -9999)
                single = np.where(one > 0, np.rint(STEPS * np.log2(one / max(n, 1) * (v + 1))), -9999)
            found, amount = np.unique(np.stack([_bucket(before), two.astype(np.int64), single.astype(np.int64)]), axis=1,
                                      return_counts=True)
            cells = {tuple(c): int(a) for c, a in zip(found.T.tolist(), amount)}
        rows = list(cells.items())
        return pa.table({"bucket": pa.array([c[0] for c, _ in rows], pa.int64()), "two": pa.array([c[1] for c, _ in rows], pa.int64()),
                         "one": pa.array([c[2] for c, _ in rows], pa.int64()), "n": pa.array([a for _, a in rows], pa.int64())})
    return run


def fit_weights(cells: np.ndarray, rounds: int = 40) -> np.ndarray:
    """EM: weights (pair, token, uniform) by bucket, from rows ``bucket, two,
    one, n``.  Buckets without held-out tokens take those of all buckets."""
    def em(part: np.ndarray, weights: np.ndarray) -> np.ndarray:
        ratio = np.stack([np.where(part[:, 1] > -9999, 2.0 ** (part[:, 1] / STEPS), 0),
                          np.where(part[:, 2] > -9999, 2.0 ** (part[:, 2] / STEPS), 0), np.ones(len(part))], axis=1)
        for _ in range(rounds):
            share = ratio * weights
            share /= share.sum(axis=1, keepdims=True)
            weights = np.maximum((share * part[:, 3:4]).sum(axis=0) / part[:, 3].sum(), 1e-6)
            weights /= weights.sum()
        return weights

    start = np.array([0.4, 0.4, 0.2])
    pooled = em(cells, start) if len(cells) else start
    out = np.tile(pooled, (BUCKETS, 1))
    for b in np.unique(cells[:, 0]).astype(int) if len(cells) else []:
        out[b] = em(cells[cells[:, 0] == b], pooled)
    return out


# -- scores ------------------------------------------------------------------

def _scores(n: int, v: int, weights: np.ndarray):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        table = _unpack(packed.column("blob")[0].as_py())
        part = packed.column("part")[0].as_py()
        tokens = Tokens(table.column("body").to_pylist())
        pair, one, before = _token_counts(tokens, answers, "all")
        w = weights[_bucket(before)]
        rest = w[:, 1] * one / max(n, 1) + w[:, 2] / (v + 1)
        p = np.where(before > 0, w[:, 0] * pair / np.maximum(before, 1) + rest, rest / (w[:, 1] + w[:, 2]))
        add = lambda x: np.add.reduceat(x, tokens.starts)
        return pa.table({
            "id": table.column("id"), "held_out": pa.array([part == HELD_OUT] * table.num_rows),
            "n_tokens": pa.array(tokens.sizes), "n_known": pa.array(add((one > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(table.num_rows, n, np.int64)),
            "base_score": pa.array(add(np.log10((one + 1) / (n + 1 * (v + 1))))), "score": pa.array(add(np.log10(p)))})
    return run


def interpolated_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
                        held_out: int = 2, deleted: int = 6, chunk_bytes: int = 4 << 20,
                        range_bytes: int = 8 << 20) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every whole text.

    Tokens are the words between white space, A-Z lower-cased, and an end
    token.  Texts whose crc32 of the id as text, modulo ``folds``, is
    ``held_out`` are scored but not learned from; of the others, those with
    ``deleted`` are left out of the estimates while the weights are learned.

    Null and empty texts have only the end token.  A null id is in no fold,
    so its text is learned from.  Rows repeated exactly get a row each and
    count as often.  A very long text is never cut: it fills a chunk, which
    its task holds, whatever ``chunk_bytes`` says.  An empty table gives no rows.  Without training texts
    all probability is uniform.  Other columns are not looked at.  Tokens
    and pairs are told apart by 64-bit hashes.
    """
    ship_code()
    mod = F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(folds))
    part = F.when(mod == held_out, HELD_OUT).when(mod == deleted, DELETED).otherwise(RETAINED)
    rows = docs.select(col(id_col).alias("id"), part.cast("int").alias("part"),
                       F.coalesce(col(text_col), F.lit("")).cast("binary").alias("body"))
    id_type = docs.schema[id_col].dataType.simpleString()
    packed = materialise(rows.mapInArrow(_pack(chunk_bytes), "chunk string, part int, n_bytes long, blob binary"), "lm-texts")
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, -(-total // range_bytes))
    asked = packed.mapInArrow(_ask(ranges), "range int, chunk string, part int, keys binary, counts binary")
    answers = materialise(asked.groupBy("range").applyInArrow(_answer, ANSWERS), "lm-counts")
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_all", "v_all", "n_retained", "v_retained")]).first()
    by_chunk = lambda df: df.groupBy("chunk")
    mine = answers.where("chunk IS NOT NULL").select("chunk", "part", "range", "all", "retained")
    cells = (by_chunk(packed.where(F.col("part") == DELETED).select("chunk", "blob"))
             .cogroup(by_chunk(mine.where(F.col("part") == DELETED).select("chunk", "range", "retained")))
             .applyInArrow(_cells(sums[2], sums[3]), "bucket long, two long, one long, n long"))
    # at most 32 buckets times the ratios in steps: bounded, whatever the texts
    found = cells.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect()
    weights = fit_weights(np.array([tuple(r) for r in found], float).reshape(-1, 4))
    return (by_chunk(packed.select("chunk", "part", "blob")).cogroup(by_chunk(mine.select("chunk", "range", "all")))
            .applyInArrow(_scores(sums[0], sums[1], weights), f"id {id_type}, held_out boolean, n_tokens long, n_known long, "
                          "train_tokens long, base_score double, score double"))
