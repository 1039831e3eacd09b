"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features are hashes of single words, their stems (first 4 and 6 letters), word pairs
and pairs with one word between, all lower-cased and without ASCII punctuation.
FTRL keeps a learning rate per coordinate and an L1 threshold, so few weights are
not zero. The model is fitted on a bounded sample of labelled rows in one task and
scores every text map-side: a weight table of at most ``2 ** BITS`` entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import mix, owner, slices, texts, word_hashes, words

BITS = 20
#: Labelled rows that the fit reads at most, in order of a hash of doc_id.
FIT_ROWS = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
STEMS = (4, 6)


def features(column: pa.Array, bits: int = BITS, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of each word, pair and skip pair, sorted and different per text.

    ``only`` marks the slots that are wanted: those with a weight, of which there are few.
    """
    offsets, flat = words(pc.utf8_lower(pc.replace_substring_regex(column, r"[!-/:-@\[-`{-~]+", "")))
    h, who = word_hashes(flat), owner(offsets)
    grams, owners = [mix(h)], [who]
    for size in STEMS:
        grams.append(mix(word_hashes(pc.utf8_slice_codeunits(flat, 0, size)) + np.uint64(size)))
        owners.append(who)
    for gap in (1, 2):
        if len(h) > gap:
            near = who[gap:] == who[:-gap]
            with np.errstate(over="ignore"):
                pair = mix(h[:-gap] * np.uint64(3) + mix(h[gap:] + np.uint64(gap)))
            grams.append(pair[near])
            owners.append(who[:-gap][near])
    found = []
    for gram, text in zip(grams, owners):
        slots = (gram >> np.uint64(64 - bits)).astype(np.int64)
        if only is not None:
            wanted = np.flatnonzero(only[slots])
            slots, text = slots[wanted], text[wanted]
        found.append((text << bits) | slots)
    keys = np.unique(np.concatenate(found))
    return keys >> bits, keys & ((1 << bits) - 1)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights by slot and the bias; each row has value 1 in its slots."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    share = min(max(float(np.mean(labels)) if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    bias, bias_n = np.log(share / (1 - share)), 1.0

    def weight(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for slots, y in zip(rows, labels):
            if not len(slots):
                continue
            zi, ni = z[slots], n[slots]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = p - y
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[slots] = zi + g - step * w
            n[slots] = ni + g * g
            bias_n += g * g
            bias -= 0.05 * g / np.sqrt(bias_n)
    return weight(z, n), float(bias)


def _slot_batches(bits):
    def slots_of(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                who, slots = features(texts(part.column("text")), bits)
                cut = np.searchsorted(who, np.arange(part.num_rows + 1)).astype(np.int32)
                rows = pa.ListArray.from_arrays(pa.array(cut), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), rows], ["doc_id", "toxic", "slots"])

    return slots_of


def _fit_batches(bits):
    def fit(batches):
        rows, labels = [], []
        for batch in batches:
            column = batch.column("slots")
            # Copied, so that no batch stays in memory for one of its rows.
            rows += [column[i].values.to_numpy().copy() for i in range(batch.num_rows)]
            labels += batch.column("toxic").to_pylist()
        order = np.random.default_rng(0).permutation(len(rows))
        w, bias = ftrl([rows[i] for i in order], np.array([labels[i] for i in order], float), bits)
        there = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[there, -1]), pa.array(np.r_[w[there], bias])], ["slot", "weight"])

    return fit


def held_out(doc_id) -> F.Column:
    """The rows that no label is learnt from; a null id is among them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def fit_weights(docs: DataFrame, labels: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (slot, weight) of the model, slot -1 being the bias; without labels the bias alone.

    At most ``fit_rows`` labelled rows are read, those first by a hash of their id, each whole.
    Rows of the held-out fold and null labels take no part.
    """
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "toxic", "text").mapInArrow(_slot_batches(bits), f"doc_id {id_type}, toxic int, slots array<int>")
    # The slots of at most fit_rows texts: one task, in a fixed order.
    one = found.repartition(1).sortWithinPartitions("doc_id", "slots").select("slots", "toxic")
    return one.mapInArrow(_fit_batches(bits), "slot long, weight double")


def _score_batches(model, bits):
    def score(batches):
        there, weight, bias = model.value
        weights = np.zeros(1 << bits)
        weights[there] = weight
        only = weights != 0
        for batch in batches:
            for part in slices(batch, "text"):
                who, slots = features(texts(part.column("text")), bits, only)
                total = np.bincount(who, weights=weights[slots], minlength=part.num_rows) + bias
                p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row, from its whole text alone.

    A null or empty text gets the score of the bias. Repeated rows and null ids stay; a
    table without rows gives none; texts are read whole, however long; other columns are
    ignored. Only weights that are not zero are broadcast, and only their slots are looked for.
    """
    model = fit_weights(docs, labels, bits, fit_rows).toPandas()  # at most 2 ** bits + 1 numbers
    there = model[model["slot"] >= 0]
    bias = float(model.loc[model["slot"] == -1, "weight"].sum()) if len(model) else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(
        (there["slot"].to_numpy(np.int64), there["weight"].to_numpy(np.float32).astype(np.float64), bias))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score_batches(shared, bits), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
                          spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
