"""Benchmark decontamination by a prefix-filtered set join, JVM only.

A window of a benchmark item (13 words, or a whole shorter item) is taken as
the set of its word shingles.  A text that holds the window holds all of
them, so its rarest shingle alone is the necessary prefix of the set in an
order by rarity.  A first pass counts the windows' shingles in the texts,
keys and counts only, combined map-side; it gives the order.  A second pass
joins windows to texts on the prefix only.  A joined pair must pass the
positional bound (the window starts inside the text) and the length bound
(and ends inside it); then the words of the text at that place are compared
with the window's.

Texts are cut into blocks of words that overlap by a window, so no row past
the first step grows with a text, and nothing is exploded beside a long
array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import size_checked
from .common import ascii_lower, col, materialise, text_hash

#: What does not belong to a word: ASCII but for digits and small letters.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Sha-256 of no items.
NO_ITEMS = ""


def letter_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _shingle(words: Column, at: Column, g: int) -> Column:
    """Hash of the g words from position ``at`` (0-based); g is part of it."""
    return F.xxhash64(F.lit(g), *[F.get(words, at + i) for i in range(g)])


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``item_id, win`` (the words in one string) and ``len``, each once."""
    words = items.select(col(id_col).alias("item_id"), letter_words(col(text_col)).alias("w")).where(F.size("w") > 0)
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    cut = words.withColumn("at", F.explode(starts)).withColumn("part", F.slice("w", F.col("at") + 1, F.least(n, F.lit(window))))
    return cut.select("item_id", F.array_join("part", " ").alias("win"), F.size("part").alias("len")).distinct()


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``win, len, offset, h`` for every shingle of every distinct window."""
    g_of = F.least(F.col("len"), F.lit(shingle))
    rows = (windows.select("win", "len").distinct().withColumn("w", F.split("win", " "))
            .withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("len") - g_of))))
    h = F.lit(None).cast("long")
    for g in range(1, shingle + 1):
        h = F.when(g_of == g, _shingle(F.col("w"), F.col("offset"), g)).otherwise(h)
    return rows.select("win", "len", "offset", h.alias("h"))


def _places(docs: DataFrame, text_col: str, sizes: list[int], window: int, block: int) -> DataFrame:
    """Every shingle of the texts: ``h1, h2, n`` (words of the text), ``c``
    (its block, with a window's words on both sides), ``i`` (place in the
    block), ``pos`` (place in the text) and ``h``."""
    around = window - 1
    words = docs.select(*text_hash(col(text_col)), letter_words(col(text_col)).alias("w")).where(F.size("w") > 0)
    words = words.withColumn("n", F.size("w"))
    begin = F.sequence(F.lit(0), F.col("n") - 1, F.lit(block))
    lead = lambda b: F.least(b, F.lit(around))
    cut = F.transform(begin, lambda b: F.struct(b.alias("b"), F.slice(
        F.col("w"), b - lead(b) + 1, lead(b) + F.lit(block + around)).alias("c")))
    blocks = words.select("h1", "h2", "n", F.explode(cut).alias("part")).select("h1", "h2", "n", "part.b", "part.c")
    first = lead(F.col("b"))
    # places are exploded before they are hashed: no function of higher order
    # keeps the hashes, the join and the counts out of generated code
    last = F.least(F.lit(block) + first, F.size("c")) - 1
    placed = blocks.select("h1", "h2", "n", "c", (F.col("b") - first).alias("at"), F.explode(F.sequence(first, last)).alias("i"))
    marks = [F.when(F.col("i") + g <= F.size("c"), _shingle(F.col("c"), F.col("i"), g)) for g in sizes]
    h = F.explode(F.array(*marks)) if len(marks) > 1 else marks[0]
    return placed.select("h1", "h2", "n", "c", "i", (F.col("at") + F.col("i")).alias("pos"), h.alias("h"))


def window_prefixes(places: DataFrame, shingles: DataFrame) -> DataFrame:
    """``win, len, h, offset, n_found``: each window's rarest shingle and how
    often the texts hold it.  A shingle that no text holds rules its windows
    out."""
    wanted = size_checked(shingles.select("h").distinct())
    counts = places.select("h").join(wanted, "h").groupBy("h").agg(F.count(F.lit(1)).alias("n_found"))
    found = F.coalesce("n_found", F.lit(0))
    ranked = shingles.join(counts, "h", "left").groupBy("win", "len").agg(
        F.min(found).alias("n_found"), F.min_by(F.struct("h", "offset"), F.struct(found, F.col("h"), F.col("offset"))).alias("key"))
    return ranked.where("n_found > 0").select("win", "len", "key.h", "key.offset", "n_found")


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, shingle: int = 3, block: int = 64) -> DataFrame:
    """Texts that hold a window: ``h1, h2`` (hash of the text), ``n_hit``,
    ``n_items``, ``items_sha256``; one row per different text."""
    windows = materialise(item_windows(items, item_id, item_text, window), "windows")
    shingles = materialise(window_shingles(windows, shingle), "window-shingles")
    sizes = sorted(r[0] for r in windows.select(F.least("len", F.lit(shingle)).alias("g")).distinct().collect())  # <= shingle
    places = _places(docs, text_col, sizes or [shingle], window, block)
    prefix = size_checked(window_prefixes(places, shingles).drop("n_found"))
    start = F.col("pos") - F.col("offset")
    bounds = (start >= 0) & (start + F.col("len") <= F.col("n"))
    same = F.array_join(F.slice("c", F.col("i") - F.col("offset") + 1, F.col("len")), " ") == F.col("win")
    # the bounds first: a slice may not start before its array
    hits = (places.join(prefix, "h").where(F.when(bounds, same).otherwise(False))
            .select("h1", "h2", start.alias("start"), "len", "win").distinct())
    hits = materialise(hits, "hits")
    before = Window.partitionBy("h1", "h2").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    reached = F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    words = (hits.select("h1", "h2", "start", "len").distinct().withColumn("new", F.greatest(end - reached, F.lit(0)))
             .groupBy("h1", "h2").agg(F.sum("new").alias("n_hit")))
    named = (hits.select("h1", "h2", "win").distinct().join(windows.select("win", "item_id"), "win")
             .groupBy("h1", "h2").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    return words.join(named, ["h1", "h2"]).select(
        "h1", "h2", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))


def judged(n_hit: Column, n_words: Column, times: int = 20) -> Column:
    return (n_hit > 0) & (times * n_hit >= n_words)


def decontaminate_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_id: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """Per input row: ``id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words and are clean.  Items without words
    have no windows; items of equal id count once and a null item id is not
    counted.  Rows repeated exactly get the same values each.  An empty
    table on either side gives clean documents or no rows.  Very long texts
    are cut into blocks and judged whole.  Other columns are not looked at.
    """
    found = contamination(docs, items, text_col, item_id, item_text, **options)
    rows = docs.select(col(id_col).alias("id"), *text_hash(col(text_col)),
                       F.size(letter_words(col(text_col))).cast("long").alias("n_words"))
    out = rows.join(found, ["h1", "h2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(NO_ITEMS), 256)).alias("items_sha256"),
                      judged(n_hit, F.col("n_words")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, all columns kept.

    Null, empty and very long texts, repeated rows and empty tables are
    taken as in ``decontaminate_report``: rows without words stay, and rows
    with equal texts stay or go together."""
    found = contamination(docs, items, text_col, **options).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_hit")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), *text_hash(col(text_col)),
                       F.size(letter_words(col(text_col))).alias("n_words"))
    bad = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & judged(F.col("n_hit"), F.col("n_words"))
    return rows.join(found, bad, "left_anti").select("row.*")
