"""Benchmark decontamination by a prefix-filtered join with exact verification.

An item's windows are its runs of `size` consecutive words (the whole item, if it is shorter).
All of a window's words have to occur, in order, so one word of it is a sufficient prefix: the
rarest by its count over the whole corpus. Steps:

1. Counts of the benchmark's words over all documents give the order of rarity.
2. Every distinct window is filed under its rarest word and the place of it in the window. Windows
   with a word that no document has are dropped: they cannot occur.
3. Every occurrence of a prefix word in a document is a candidate, with the `size` - 1 words on
   either side. A bitmap of fixed size keeps other words from being shipped.
4. Candidates join the places of their word: at most size * (size + 1) / 2 of them, however many
   windows have the word. The length bound (words needed before and after exist) and the positional
   bound (the window starts where the word's place in it says) leave one stretch of words per place.
5. Stretches join windows by hash and are compared word for word. Hits name windows, and windows
   their items, so that a window which many items share is compared once.

The bitmap has 2 MB whatever the benchmark's size, and the joins are Spark's, so neither side need
be small. Every row of the documents has a result of its own, rows with equal or null ids too.
Null and empty texts, and texts and items without words, have no windows and no hits; items with a
null id are left out, repeated items count once. Texts are read whole, however long. Empty tables
give no rows, or no hits. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.text import ALNUM, blocks, buffers, find_words
from meterflow.plans.stage import staged

WINDOW = 10
#: Bits of the word filter: 2 MB, at most a few percent of it set by a million prefix words.
FILTER_BITS = 24
_PER_BUCKET = 8 * 4096


def _place(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, words): the lower-cased words of every item that has any."""

    def run(batches):
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                w = find_words(offs[lo : hi + 1], data, ALNUM)
                rows = [[w.word(i) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("item").slice(lo, hi - lo), pa.array(rows, pa.list_(pa.string()))], ["item", "words"])

    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null")
    return rows.mapInArrow(run, f"item {items.schema[id_col].dataType.simpleString()}, words array<string>").where(F.size("words") > 0)


def word_filter(words: DataFrame) -> np.ndarray:
    """Bitmap (2 ** FILTER_BITS bits as booleans) of the hashes of a column `word`."""

    def run(batches):
        for batch in batches:
            offs, data = buffers(batch.column("word"))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_place(find_words(offs, data, ALNUM).hash)))], ["bit"])

    bits = words.select("word").mapInArrow(run, "bit long")
    parts = bits.groupBy((F.col("bit") / _PER_BUCKET).cast("long").alias("bucket")).agg(F.bitmap_construct_agg(F.col("bit") % _PER_BUCKET).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in parts.collect():  # at most 512 rows of 4 KB
        out[row["bucket"] * 4096 : (row["bucket"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return np.unpackbits(out, bitorder="little").view(bool)


def word_counts(docs: DataFrame, text_col: str, passes: np.ndarray) -> DataFrame:
    """(word, n): occurrences over all documents of the words that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(passes))

    def run(batches):
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                w = find_words(offs[lo : hi + 1], data, ALNUM)
                at = np.flatnonzero(bits[_place(w.hash)])
                _, first, n = np.unique(w.hash[at], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([w.word(i) for i in at[first]], pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, words): the distinct windows of every item of `item_words`."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    return items.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, size))).alias("words")).distinct()


def prefixes(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, words, hash, word, at): windows of distinct words with the rarest one, which stands
    at place `at`. Equal counts are told apart by the word, then the place."""
    per_word = texts.select("window", F.posexplode("words").alias("at", "word")).join(counts, "word", "left")
    rarest = per_word.groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("p"))
    known = texts.join(rarest.where("p.n > 0"), "window")
    return known.select("window", "words", F.xxhash64("words").alias("hash"), "p.word", "p.at")


def candidates(docs: DataFrame, id_col: str, text_col: str, passes: np.ndarray, size: int = WINDOW) -> DataFrame:
    """(doc, n_words, found array<struct<word, pos, at, near>>), a row for each of `docs`: the
    occurrences of words that pass the filter, `near` with up to size - 1 words on either side, `at`
    the word's place in it."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(passes))
    entry = pa.struct([("word", pa.string()), ("pos", pa.int32()), ("at", pa.int32()), ("near", pa.list_(pa.string()))])

    def run(batches):
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                w = find_words(offs[lo : hi + 1], data, ALNUM)
                at = np.flatnonzero(bits[_place(w.hash)])
                rows = np.searchsorted(w.first, at, "right") - 1
                found: list[list[dict]] = [[] for _ in range(hi - lo)]
                memo: dict[int, str] = {}
                for i, r in zip(at.tolist(), rows.tolist()):
                    a, b = max(int(w.first[r]), i - size + 1), min(int(w.first[r + 1]), i + size)
                    near = [memo.get(k) or memo.setdefault(k, w.word(k)) for k in range(a, b)]
                    found[r].append({"word": near[i - a], "pos": i - int(w.first[r]), "at": i - a, "near": near})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(lo, hi - lo), pa.array(np.diff(w.first), pa.int64()), pa.array(found, pa.list_(entry))],
                    ["doc", "n_words", "found"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc {kind}, n_words long, found array<struct<word:string,pos:int,at:int,near:array<string>>>")


def verified(cands: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, lo, hi, window): every occurrence [lo, hi) of a window in the words of a row."""
    size = F.size("words")
    places = staged(windows.groupBy("word").agg(F.collect_set(F.struct(F.col("at").alias("before"), size.alias("n"))).alias("places")), "places")
    one = cands.select("row", F.explode("found").alias("c")).select("row", "c.*").join(places, "word")
    start = F.col("at") - F.col("before")
    one = one.select("row", "pos", "at", "near", F.explode("places").alias("p")).select("row", "pos", "at", "near", "p.*")
    fits = one.where((start >= 0) & (F.size("near") >= start + F.col("n"))).select(
        "row", (F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") - F.col("before") + F.col("n")).alias("hi"),
        F.col("before").alias("at"), F.slice("near", start + 1, F.col("n")).alias("words"),
    )
    hits = fits.withColumn("hash", F.xxhash64("words")).join(windows.select("hash", "at", "words", "window"), ["hash", "at", "words"])
    return hits.select("row", "lo", "hi", "window")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW
) -> DataFrame:
    """(id_col, n_words, n_hit, items array): for every row of `docs` its words, the words inside an
    occurrence of a window of an item, and the items, sorted as strings, with such windows."""
    words = staged(item_words(items, item_id, item_text), "items")
    counts = staged(word_counts(docs, text_col, word_filter(words.select(F.explode("words").alias("word")).distinct())), "counts")
    of_items = staged(item_windows(words, size), "windows")
    texts = staged(of_items.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "texts")
    windows = staged(prefixes(texts, counts), "prefixes")
    cands = candidates(docs, id_col, text_col, word_filter(windows), size).withColumn("row", F.monotonically_increasing_id())
    cands = staged(cands, "candidates")  # rows keep their numbers from here on
    hits = staged(verified(cands, windows), "hits")
    # covered words: every occurrence adds what reaches beyond the furthest end before it
    by_start = Window.partitionBy("row").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    added = F.greatest(F.lit(0), F.col("hi") - F.greatest(F.col("lo"), F.coalesce(F.max("hi").over(by_start), F.lit(0))))
    covered = hits.select("row", "lo", "hi").distinct().select("row", added.cast("long").alias("n_hit")).groupBy("row").agg(F.sum("n_hit").alias("n_hit"))
    owners = of_items.join(texts, "words").select("window", F.col("item").cast("string").alias("item"))
    named = hits.select("row", "window").distinct().join(owners, "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = covered.join(named, "row")
    out = cands.select("row", "doc", "n_words").join(found, "row", "left")
    no_items = F.array().cast("array<string>")
    return out.select(F.col("doc").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", no_items).alias("items"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items_sha256, contaminated) from `contamination`."""
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
