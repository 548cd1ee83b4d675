"""Quality by importance resampling: the ratio of two hashed n-gram generative models.

Both models are bags of hashed n-grams with additive smoothing: one of the target text (documents
labelled good), one of the raw text (all documents). A document's log ratio is the sum, over its
n-grams, of the log ratio of the two probabilities. Its log weight is that sum times L / (n + L)
for n n-grams: short documents have their own ratio, long ones tend to L times the mean ratio of an
n-gram, so that length alone neither keeps nor rejects. Gumbel noise, drawn from a hash of the row,
is added to the log weights and the k largest sums are kept, which samples k documents without
replacement in proportion to their weights.

N-grams: words as written, pairs of words (a word that repeats the one before it gives the same
pair whatever the word), and pairs of word shapes (letters and digits collapsed to their class).

k follows from the corpus: a threshold on the log weight is fitted where it separates the two labels
best, on the half of the labelled sample that the target model has not read, and k is the number of
all documents at or above it. The k-th
largest sum is found exactly by counting 16 bits at a time; ties with it are kept.

Fitting reads at most `max_labels` labelled ids per label, picked by a hash of their id; counts
of the raw model, weights, k and the selection cover every document. Without labels of both kinds
every document is kept. Null and empty texts have no n-grams and weight 0. Repeated rows have
equal weights and noise; rows without an id are scored and sampled like others. Texts are read
whole, however long. An empty table gives no rows. Columns of other names are not read by
`resample`, and pass through `keep_sampled`, which has the same verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meterflow.llm.text import SOLID, Words, blocks, buffers, find_words, grams, mix
from meterflow.plans.stage import release, staged

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """2 ** bits hash buckets; `smooth` counts are added to each; `length` is L."""

    bits: int = 14
    smooth: float = 1.0
    length: float = 100.0
    max_labels: int = 10_000


def _shape_table() -> np.ndarray:
    """Byte -> class: digits, upper case, lower case and non-ASCII letters; other bytes are themselves."""
    t = np.arange(256).astype(np.uint8)
    t[0x30:0x3A], t[0x41:0x5B], t[0x61:0x7B], t[0x80:] = 1, 2, 3, 3
    return t


_SHAPE = _shape_table()


def shape_hashes(w: Words) -> np.ndarray:
    """Hash of every word's shape: its classes of characters, runs of one class collapsed."""
    if not len(w.start):
        return np.zeros(0, _U)
    size = w.end - w.start
    at = np.cumsum(size) - size
    body = _SHAPE[w.data[np.arange(int(size.sum())) + np.repeat(w.start - at, size)]]
    new = np.ones(len(body), bool)
    new[1:] = body[1:] != body[:-1]
    new[at] = True
    rank = np.cumsum(new)
    place = (rank - np.repeat(rank[at], size)).astype(_U)
    part = mix((body.astype(_U) << _U(32)) + place) * new.astype(_U)
    return mix(np.add.reduceat(part, at))


def features(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of a block of texts."""
    slot = lambda h: (h >> _U(64 - bits)).astype(np.int64)
    row = w.row
    at, pair = grams(w.hash, w.last, 2)
    pair = np.where(w.hash[at] == w.hash[at + 1], _U(0x1234567890ABCDEF), pair)
    at2, shapes = grams(shape_hashes(w), w.last, 2)
    return np.concatenate([row, row[at], row[at2]]), np.concatenate([slot(mix(w.hash)), slot(pair), slot(mix(shapes))])


def labelled(labels: DataFrame, id_col: str, label_col: str, most: int) -> DataFrame:
    """(id, label, half): at most `most` ids of each label, the first in the order of a hash of the
    id; half is 1 for the part that the target model reads."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    pick = lambda y: known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(most)
    return pick(0).unionByName(pick(1)).withColumn("half", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).cast("int"))


def log_ratios(docs: DataFrame, picked: DataFrame, settings: Settings, id_col: str, text_col: str) -> np.ndarray:
    """Log of target over raw probability, by bucket."""
    size = 1 << settings.bits
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked.where("label = 1 and half = 1")), "id", "left")

    def count(batches):
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            good = np.equal(batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False), 1)
            for lo, hi in blocks(offs):
                row, slot = features(find_words(offs[lo : hi + 1], data, SOLID), settings.bits)
                raw += np.bincount(slot, minlength=size)
                target += np.bincount(slot[good[lo:hi][row]], minlength=size)
        live = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(live), pa.array(raw[live]), pa.array(target[live])], ["slot", "raw", "target"])

    counts = rows.mapInArrow(count, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.full(size, settings.smooth), np.full(size, settings.smooth)
    for r in counts.collect():  # at most 2 ** bits rows
        raw[r["slot"]] += r["raw"]
        target[r["slot"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _scorer(ratios: np.ndarray, settings: Settings):
    """From a string array and the row range of a block to (log weights, numbers of words)."""

    def of(offs, data, lo, hi):
        w = find_words(offs[lo : hi + 1], data, SOLID)
        row, slot = features(w, settings.bits)
        total = np.bincount(row, ratios[slot], hi - lo) * settings.length / (np.bincount(row, minlength=hi - lo) + settings.length)
        return total, np.diff(w.first)

    return of


def log_weights(docs: DataFrame, ratios: np.ndarray, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(id, log_weight, n_words), one row per row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # 2 ** bits numbers

    def run(batches):
        score = _scorer(shared.value, settings)
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                total, n = score(offs, data, lo, hi)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(total), pa.array(n)], ["id", "log_weight", "n_words"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, log_weight double, n_words long")


def best_cut(scored: DataFrame, picked: DataFrame) -> float | None:
    """The log weight that separates the labels best (largest sum of the two recalls)."""
    rows = scored.join(F.broadcast(picked.where("label = 0 or half = 0")), "id").groupBy("id").agg(F.max("label").alias("label"), F.max("log_weight").alias("log_weight"))
    rows = rows.collect()  # at most 2 * max_labels ids
    x, y = np.array([r["log_weight"] for r in rows]), np.array([r["label"] for r in rows])
    if not (y == 1).any() or not (y == 0).any():
        return None
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    bad = np.append(0, np.cumsum(y == 0)) / (y == 0).sum()
    good = 1 - np.append(0, np.cumsum(y == 1)) / (y == 1).sum()
    gain = bad + good
    gain[1:-1][x[1:] == x[:-1]] = -1
    i = int(gain.argmax())
    return -np.inf if i == 0 else float(x[i - 1] + x[min(i, len(x) - 1)]) / 2


def kth_largest(values: DataFrame, col: str, k: int) -> int:
    """The k-th largest of a column of non-negative longs, by counting 16 bits at a time."""
    prefix = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(F.col(col), shift).bitwiseAND(F.lit(0xFFFF))
        rows = values.where(F.shiftright(F.col(col), shift + 16) == prefix) if shift < 48 else values
        for r in sorted(rows.groupBy(digit.alias("d")).count().collect(), reverse=True):  # at most 65,536 rows
            if k <= r["count"]:
                prefix = (prefix << 16) | r["d"]
                break
            k -= r["count"]
    return prefix


#: Bound of the sums of log weights and noise, in millionths.
_LIMIT = 4_000_000_000_000_000_000


def noisy_key(id_col: str = "id") -> Column:
    """The sum of log weight and Gumbel noise in millionths, shifted to be positive: an order-preserving
    whole number. The noise is drawn from the row itself, so that a lost task draws it again."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, "log_weight", F.lit("gumbel")), 11) + 0.5) * F.lit(2.0**-53)
    sums = (F.col("log_weight") - F.log(-F.log(u))) * 1e6
    return F.least(F.greatest(sums, F.lit(-float(_LIMIT))), F.lit(float(_LIMIT))).cast("long") + F.lit(_LIMIT)


@dataclass(frozen=True)
class Sampler:
    """Log ratios by bucket, and the smallest `noisy_key` that is kept (None: nothing is)."""

    ratios: np.ndarray
    least: int | None
    settings: Settings


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> tuple[Sampler, DataFrame]:
    """The sampler for `docs`, and the rows (id, log_weight, n_words) it was counted on."""
    picked = staged(labelled(labels, id_col, label_col, settings.max_labels), "labelled")
    ratios = log_ratios(docs, picked, settings, id_col, text_col)
    scored = staged(log_weights(docs, ratios, settings, id_col, text_col), "weights")
    cut = best_cut(scored, picked)
    release(picked)
    k = scored.where(F.col("log_weight") >= F.lit(cut)).count() if cut is not None else scored.count()
    return Sampler(ratios, kth_largest(scored.withColumn("key", noisy_key()), "key", k) if k else None, settings), scored


def _kept(sampler: Sampler, id_col: str) -> Column:
    return noisy_key(id_col) >= F.lit(sampler.least) if sampler.least is not None else F.lit(False)


def resample(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(id_col, n_words, log_weight, kept boolean), one row per row of `docs`."""
    sampler, scored = fit(docs, labels, label_col, id_col, text_col, settings)
    return scored.select(F.col("id").alias(id_col), "n_words", "log_weight", _kept(sampler, "id").alias("kept"))


def keep_sampled(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of `docs` that `resample` keeps. Weights are made again next to the text, so that no
    text is shuffled to meet its verdict."""
    sampler, scored = fit(docs, labels, label_col, id_col, text_col, settings)
    release(scored)
    shared = docs.sparkSession.sparkContext.broadcast(sampler.ratios)  # 2 ** bits numbers

    # columns by place, whatever their names
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, key = (names[docs.columns.index(c)] for c in (text_col, id_col))
    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema)] + [StructField("log_weight", DoubleType())])

    def run(batches):
        score = _scorer(shared.value, settings)
        for batch in batches:
            offs, data = buffers(batch.column(text))
            for lo, hi in blocks(offs):
                cols = [c.slice(lo, hi - lo) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score(offs, data, lo, hi)[0])], [*names, "log_weight"])

    weighed = docs.toDF(*names).mapInArrow(run, schema)
    return weighed.where(_kept(sampler, key)).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))
