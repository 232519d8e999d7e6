"""Source divergence audit by in-mapper stripes.

Each partition folds whole documents into a hash table of stripes: a term of
a language with its document frequency and its counts by source.  A table
that grows beyond its bound is spilled as rows.  Rows are merged by key, rare
terms go, and the merged stripes, in groups of a bounded number of terms,
directly emit the sources' divergences: a term's shares in all sources stand
in one stripe, so no source is joined with another.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, reliable_checkpoint, ship_code

#: Terms are runs of ASCII letters and of all code points from U+0080.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
STRIPES = "lang string, term binary, docs long, counts array<struct<source:string,n:long>>"
COUNTS = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
EMITTED = "lang string, part string, source string, item string, value long"


def term_counts(body: bytes | None, size: int = 1 << 20) -> Counter:
    """The terms of a whole text, read some ``size`` bytes at a time; no
    term is cut.  Null and empty texts have none."""
    out: Counter = Counter()
    body, at = body or b"", 0
    while at < len(body):
        end = min(len(body), at + size)
        while end < len(body) and TERM_BYTES[body[end]] != 32:
            end += 1
        out.update(body[at:end].translate(TERM_BYTES).split())
        at = end
    return out


class _Stripes:
    """Stripes by language and term: [documents, {source: count}]."""

    def __init__(self, spill_bytes: int):
        self.spill_bytes, self.used = spill_bytes, 0
        self.table: dict[str, dict[bytes, list]] = {}

    def add(self, lang: str, source: str, counts: Counter) -> None:
        stripes = self.table.setdefault(lang, {})
        for term, n in counts.items():
            stripe = stripes.get(term)
            if stripe is None:
                stripes[term] = [1, {source: n}]
                self.used += 500 + len(term)
            else:
                stripe[0] += 1
                if source in stripe[1]:
                    stripe[1][source] += n
                else:
                    stripe[1][source] = n
                    self.used += 100

    def full(self) -> bool:
        return self.used > self.spill_bytes

    def spill(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        for lang, stripes in self.table.items():
            terms = list(stripes)
            for at in range(0, len(terms), rows):
                part = terms[at:at + rows]
                got = [stripes[t] for t in part]
                ends = np.cumsum([0, *(len(s[1]) for s in got)]).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array([k for s in got for k in s[1]], pa.string()),
                                                   pa.array([v for s in got for v in s[1].values()], pa.int64())], ["source", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()),
                                                  pa.array([s[0] for s in got], pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                                                 ["lang", "term", "docs", "counts"])
        self.table, self.used = {}, 0


def stripe_rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str, spill_bytes: int) -> DataFrame:
    """Stripes of each partition; a stripe without a term names the sources
    of a language, those without terms included."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes, groups = _Stripes(spill_bytes), {}
        for batch in batches:
            for lang, source, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                groups.setdefault(lang, {})[source] = 0
                stripes.add(lang, source, term_counts(body))
                if stripes.full():
                    yield from stripes.spill()
        yield from stripes.spill()
        for lang, sources in groups.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.binary()), pa.array([0], pa.int64()),
                                              pa.array([[{"source": s, "n": 0} for s in sources]], COUNTS)], ["lang", "term", "docs", "counts"])

    ship_code()
    known = [F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    return docs.select(*known, F.coalesce(col(text_col), F.lit("")).cast("binary").alias("body")).mapInArrow(fold, STRIPES)


def merged_stripes(stripes: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term, total, counts`` of the terms that ``min_docs`` documents
    of the language hold, and the sources of every language (null term).

    One exchange by (lang, term); both sums below it use that dealing."""
    entry = stripes.repartition("lang", "term").select(
        "lang", "term", "docs", F.posexplode("counts").alias("at", "entry"))
    entry = entry.groupBy("lang", "term", "entry.source").agg(
        F.sum("entry.n").alias("n"), F.sum(F.when(F.col("at") == 0, F.col("docs")).otherwise(0)).alias("docs"))
    out = entry.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))  # an entry a source
    return out.where((F.col("docs") >= min_docs) | F.col("term").isNull())


def shares(counts: np.ndarray, totals: np.ndarray, terms: int, smoothing: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), exact."""
    below = totals + smoothing * terms
    if counts.size and scale * (int(counts.max()) + smoothing) >= 2 ** 63:
        return (1 + scale * (counts.astype(object) + smoothing) // below).astype(np.int64)
    return 1 + scale * (counts + smoothing) // below


def _emit(left: pa.Table, right: pa.Table, lang: str, a: int, b: int, top: int, smoothing: int, scale: int, cells: int = 1 << 18):
    """Divergences of a group of stripes between the sources of tiles a and b."""
    sources, totals = right.column("source").to_pylist(), right.column("n").to_numpy()
    tile, terms = right.column("tile").to_numpy(), int(right.column("terms")[0].as_py())
    everything = right.column("everything").to_numpy()[:1]
    first, second = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    sums, best = np.zeros((len(sources), len(sources)), np.int64), [[] for _ in sources]
    step = max(1, cells // len(sources))
    wanted = pa.array(sources, pa.string())
    for at in range(0, left.num_rows, step):
        part = left.slice(at, step).combine_chunks()
        lists = part.column("counts").combine_chunks()
        flat = lists.flatten()
        row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
        place = pc.index_in(flat.field("source"), wanted)
        known = place.is_valid().to_numpy(zero_copy_only=False)
        counts = np.zeros((part.num_rows, len(sources)), np.int64)
        counts[row[known], place.drop_null().to_numpy()] = flat.field("n").to_numpy()[known]
        p = shares(counts, totals, terms, smoothing, scale)
        for i in first:
            js = second[second > i] if a == b else second
            sums[i, js] += np.abs(p[:, js] - p[:, i:i + 1]).sum(axis=0)
        if a == b:
            q = shares(part.column("total").to_numpy()[:, None], everything, terms, smoothing, scale)
            more = np.where(counts > 0, p - q, 0)
            words = part.column("term").to_pylist()
            for i in first:
                up = np.flatnonzero(more[:, i] > 0)
                if len(up) > top:  # ties with the last one stay
                    up = up[more[up, i] >= np.partition(more[up, i], -top)[-top]]
                best[i] = sorted(best[i] + [(-int(more[r, i]), words[r]) for r in up])[:top]
    rows = [(lang, "pair", sources[i], sources[j], int(sums[i, j])) for i in first for j in (second[second > i] if a == b else second)]
    rows += [(lang, "term", sources[i], word.decode(), -value) for i in first for value, word in best[i]]
    names = ["lang", "part", "source", "item", "value"]
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)], names)


def source_divergences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                       min_docs: int = 30, top: int = 50, smoothing: int = 5, scale: int = 1_000_000_000,
                       spill_bytes: int = 64_000_000, group_terms: int = 4096, tile: int = 256) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a
    language is from every other one (part ``pair``) and the terms that it
    uses more than the language (part ``term``, the ``top`` of them).

    Shares are smoothed and in integers of 1/``scale``; all sums are exact.
    Null texts, languages and sources read as ''.  A row is a document,
    repeated rows count again.  Very long texts are read in blocks; a
    partition's stripes take about ``spill_bytes`` before they are spilled.
    Ties rank by the UTF-8 bytes of the item.  A language without kept terms
    has pairs of value 0, one with a single source has none; an empty table
    gives no rows.  A task emits for at most ``group_terms`` terms and two
    tiles of ``tile`` sources at a time; other columns are not read."""
    merged = reliable_checkpoint(merged_stripes(stripe_rows(docs, text_col, lang_col, source_col, spill_bytes), min_docs))
    kept = merged.where("term IS NOT NULL")
    by_source = merged.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    by_lang = merged.groupBy("lang").agg(F.count("term").alias("terms"), F.sum("total").alias("everything"))
    # one row a source of a language: the result holds their square
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = by_source.withColumn("tile", F.call_function("div", place, F.lit(tile)).cast("int")).join(by_lang, "lang")
    tiles = F.max("tile").over(Window.partitionBy("lang"))
    sources = reliable_checkpoint(sources.withColumn("last", tiles))
    bound = sources.agg(F.max("terms"), F.max("last")).first()
    groups = max(1, -(-(bound[0] or 0) // group_terms))
    last = sources.select("lang", "last").distinct()  # a row a language
    group = F.pmod(F.xxhash64("term"), F.lit(groups)).cast("int")
    left = kept.select("lang", "term", "total", "counts", group.alias("group"))
    if bound[1]:
        left = left.join(last, "lang").withColumn("a", F.explode(F.sequence(F.lit(0), F.col("last")))).withColumn(
            "b", F.explode(F.sequence(F.col("a"), F.col("last"))))
    else:
        left = left.withColumn("a", F.lit(0)).withColumn("b", F.lit(0))
    right = (sources.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
             .withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    keys = ["lang", "a", "b", "group"]

    def emit(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, a, b = (k.as_py() for k in key[:3])
        return _emit(left, right, lang, a, b, top, smoothing, scale)

    ship_code()
    right = right.select(*[F.col(k).alias(f"{k}_") for k in keys], "source", "n", "tile", "terms", "everything")
    out = left.groupBy(*keys).cogroup(right.groupBy(*[f"{k}_" for k in keys]))
    out = reliable_checkpoint(out.applyInArrow(emit, EMITTED))
    pairs = out.where("part = 'pair'").groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    back = pairs.select("lang", "part", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    ranked = [_ranked(pairs.unionByName(back)), _ranked(out.where("part = 'term'")).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame) -> DataFrame:
    order: list[Column] = [F.desc("value"), F.asc("item")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
