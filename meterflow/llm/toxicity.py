"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word pairs and pairs with one word between them of a
text, lower-cased. Training reads at most `max_rows` labelled ids, picked by a hash of their id (all
of them if there are fewer), and of their rows, in the same order, as many as have `max_features`
features in all: FTRL is an online method, and its passes over this bounded sample (4 bytes a
feature, 320 MB) run in one task, from features that are made in parallel. Learning rates are kept per
coordinate and L1 leaves most weights at zero, so the weights that scoring broadcasts are few:
never more than 2 ** bits of them, 4 MB.

Null and empty texts have no features and get the score of the intercept, the base rate. Without
a label of either kind nothing can be learned, and every score is the base rate (0 without
labels). Labels other than 0 and 1 are left out; of several labels of an id the largest counts. Rows
with a null id are scored but not trained on. Repeated rows get equal scores. Texts are scored whole,
however long. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import ALNUM, Words, blocks, buffers, find_words, grams


@dataclass(frozen=True)
class Ftrl:
    """Settings of the learner. `positive` weighs rows with label 1."""

    bits: int = 20
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 16.0
    l2: float = 1.0
    epochs: int = 4
    positive: float = 3.0
    min_rows: int = 3
    max_rows: int = 24_000
    max_features: int = 80_000_000


def features(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of all features of a block of texts, in no order and with repeats."""
    row = w.row
    slot = lambda h: (h >> np.uint64(64 - bits)).astype(np.int64)
    rows, slots = [row], [slot(w.hash * np.uint64(0x9E3779B97F4A7C15))]
    for skip in (1, 2):
        at, g = grams(w.hash, w.last, 2, skip)
        rows.append(row[at])
        slots.append(slot(g))
    return np.concatenate(rows), np.concatenate(slots)


def fit(xs: list[np.ndarray], ys: list[int], s: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept) from rows of distinct slots and their labels, by FTRL-proximal.

    Features of fewer than `min_rows` rows are left out: they would only remember single rows.
    """
    y = np.array(ys, float)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    b0, b, nb = float(np.log(rate / (1 - rate))), 0.0, 0.0
    if not 0 < y.sum() < len(y):
        return np.zeros(0, np.int64), np.zeros(0), b0
    seen = np.bincount(np.concatenate(xs), minlength=1 << s.bits)
    xs = [x[seen[x] >= s.min_rows] for x in xs]
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)

    def weights(slots):
        zs = z[slots]
        w = -(zs - np.sign(zs) * s.l1) / ((s.beta + np.sqrt(n[slots])) / s.alpha + s.l2)
        return np.where(np.abs(zs) <= s.l1, 0.0, w)

    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(len(xs)):
            slots = xs[i]
            w = weights(slots)
            p = 1 / (1 + np.exp(-np.clip(b0 + b + w.sum(), -35, 35)))
            g = (p - y[i]) * (s.positive if y[i] else 1.0)
            z[slots] += g - (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / s.alpha * w
            n[slots] += g * g
            nb += g * g
            b -= s.alpha * g / (s.beta + np.sqrt(nb))
    kept = np.flatnonzero(np.abs(z) > s.l1)
    return kept, weights(kept), b0 + b


def sample(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """At most `max_rows` labelled ids: the first in the order of a hash of the id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64("id")
    return known.orderBy(order, "id").limit(max_rows).withColumn("place", order)


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", settings: Ftrl = Ftrl()) -> dict[int, float]:
    """Weights by slot; slot -1 is the intercept."""
    s = settings
    picked = F.broadcast(sample(labels, id_col, label_col, s.max_rows))  # at most max_rows ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")

    def featurise(batches):
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                row, slot = features(find_words(offs[lo : hi + 1], data, ALNUM), s.bits)
                both = np.unique((row << s.bits) | slot)
                first = np.searchsorted(both >> s.bits, np.arange(hi - lo + 1))
                slots = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(both & ((1 << s.bits) - 1), pa.int32()))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("place"), part.column("id").cast(pa.string()), part.column("label"), slots], ["place", "id", "label", "slots"])

    def learn(batches):
        xs, ys, held = [], [], 0
        for batch in batches:
            offs, vals = batch.column("slots").offsets.to_numpy(), batch.column("slots").values.to_numpy(zero_copy_only=False)
            for a, b, label in zip(offs[:-1], offs[1:], batch.column("label").to_pylist()):
                held += int(b - a)
                if held > s.max_features and xs:
                    break
                xs.append(vals[a:b])
                ys.append(label)
            if held > s.max_features:
                break
        slots, weights, bias = fit(xs, ys, s)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(slots, -1), pa.int64()), pa.array(np.append(weights, bias), pa.float64())], ["slot", "weight"])

    made = rows.mapInArrow(featurise, "place long, id string, label int, slots array<int>")
    model = made.repartition(1).sortWithinPartitions("place", "id").mapInArrow(learn, "slot long, weight double")
    return {r["slot"]: r["weight"] for r in model.collect()}  # at most 2 ** bits + 1 rows


def score(docs: DataFrame, weights: dict[int, float], id_col: str = "doc_id", text_col: str = "text", settings: Ftrl = Ftrl()) -> DataFrame:
    """(id_col, score double): the probability of label 1, one row per row of `docs`."""
    bits = settings.bits
    dense = np.zeros(1 << bits, np.float32)
    for k, v in weights.items():
        if k >= 0:
            dense[k] = v
    bias = weights.get(-1, -35.0)
    shared = docs.sparkSession.sparkContext.broadcast(dense)

    def run(batches):
        w = shared.value
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                row, slot = features(find_words(offs[lo : hi + 1], data, ALNUM), bits)
                live = np.flatnonzero(w[slot])
                both = np.unique((row[live] << bits) | slot[live])
                total = np.bincount(both >> bits, w[both & ((1 << bits) - 1)].astype(np.float64), hi - lo)
                p = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(p)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id as text leaves 1 when divided by 3. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.7, settings: Ftrl = Ftrl()) -> DataFrame:
    """(doc_id, held_out, score, predicted), trained on labelled rows that are not held out."""
    weights = train(docs, labels.where(~held_out()), label_col, settings=settings)
    return score(docs, weights, settings=settings).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
