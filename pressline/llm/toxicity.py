"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, pairs of neighbours and pairs with one word between, hashed
to 2**BITS. Training follows per-coordinate FTRL-proximal (McMahan et al. 2013):
each weight has its own learning rate, and L1 keeps most weights at exactly 0.
The weights that are left go to the executors in the closure; their number is
bounded by 2**BITS (4 MB). Training reads at most MAX_TRAIN labelled rows, those
of smallest id hash, and MAX_TRAIN_BYTES of them; scoring reads every whole text, in one narrow pass.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.words import arrow_map, mixed, raw, texts_of, word_hashes

BITS = 20
#: Most labelled rows that training reads (a documented sample; all of them where there are fewer).
MAX_TRAIN = 10_000
#: Bytes of text that are learned from at most.
MAX_TRAIN_BYTES = 64_000_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
#: Bias of a model that saw no label: nothing is known against any text.
UNKNOWN = -1.0
#: Lower-case A-Z; ASCII punctuation separates words.
TABLE = bytes(32 if c < 128 and not chr(c).isalnum() else c + 32 if 65 <= c <= 90 else c for c in range(256))


def features(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, index) of each word, neighbour pair and skip pair."""
    doc = np.repeat(np.arange(len(counts)), counts)
    docs, found = [doc], [hashes.copy()]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(hashes) > gap:
            same = doc[gap:] == doc[:-gap]
            pair = (hashes[:-gap] * np.uint64(salt)) ^ (hashes[gap:] + np.uint64(salt))
            docs.append(doc[gap:][same])
            found.append(pair[same])
    all_ = mixed(np.concatenate(found))
    return np.concatenate(docs), (all_ >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_features(texts):
    """Yield (first text, number of texts, documents, indices), each index once a document."""
    for first, counts, hashes in word_hashes(texts, TABLE):
        doc, index = features(hashes, counts)
        key = np.unique((doc << BITS) | index)
        yield first, len(counts), key >> BITS, key & ((1 << BITS) - 1)


class Ftrl:
    """FTRL-proximal with binary features; the last coordinate is the bias, free of L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        penalty = np.where(at == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= penalty, 0.0, -(z - np.sign(z) * penalty) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, index: np.ndarray, label: float) -> None:
        at = np.append(index, 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        every = self.weights(np.arange((1 << BITS) + 1))
        at = np.flatnonzero(every[:-1])
        return at.astype(np.int32), every[at].astype(np.float32), float(every[-1])


def train(rows: DataFrame):
    """Model (indices, weights, bias) from rows of (order, text bytes, label); one task over a bounded sample."""

    def fit(batches):
        data, size = [], 0
        for batch in batches:
            labels, upto = batch.column(1).to_pylist(), size + np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False), dtype=np.int64)
            few = int(np.searchsorted(upto, MAX_TRAIN_BYTES, "right"))
            size = int(upto[-1]) if len(upto) else size
            for first, n, doc, index in distinct_features(texts_of(batch.column(0)[:few])):
                ends = np.searchsorted(doc, np.arange(n + 1))
                data += [(index[ends[i] : ends[i + 1]].astype(np.int32), float(labels[first + i])) for i in range(n)]
        model = Ftrl()
        for _ in range(EPOCHS):
            for index, label in data:
                model.learn(index.astype(np.int64), label)
        at, w, bias = model.model()
        yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()]), pa.array([w.tobytes()]), pa.array([bias])], ["at", "w", "bias"])

    one = arrow_map(rows.repartition(1).sortWithinPartitions("order").select("data", "label"), fit, "at binary, w binary, bias double").collect()
    if not one:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), UNKNOWN
    return np.frombuffer(bytes(one[0].at), np.int32), np.frombuffer(bytes(one[0].w), np.float32), one[0].bias


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """The labelled rows to learn from: crc32(id) mod 5 is not 0, smallest id hash first, `most` at most.

    An id labelled twice counts as toxic if one of its labels is 1; of several texts of one id the
    least is learned from. train() stops where the texts exceed MAX_TRAIN_BYTES.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("label"))
    known = known.where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    known = known.withColumn("order", F.xxhash64("id", F.lit(7))).orderBy("order", "id").limit(most)
    texts = docs.select(F.col("doc_id").alias("id"), raw("text").alias("data"))
    # `most` rows of 20 bytes: a proven bound for the broadcast
    rows = texts.join(F.broadcast(known), "id")
    return rows.groupBy("id", "order", "label").agg(F.min("data").alias("data")).select("order", "data", "label")


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; an empty or null text gets the bias alone."""
    at, w, bias = model
    kind = dict(docs.dtypes)[id_col]

    def scored(batches):
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        for batch in batches:
            totals = np.full(batch.num_rows, bias)
            for first, counts, hashes in word_hashes(texts_of(batch.column(1)), TABLE):
                doc, index = features(hashes, counts)
                hit = np.flatnonzero(dense[index])
                key = np.unique((doc[hit] << BITS) | index[hit])
                totals[first : first + len(counts)] += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], len(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(totals, -500, 500))))], ["doc_id", "score"])

    out = arrow_map(docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("data")), scored, f"doc_id {kind}, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """Train on the labelled part of docs, score all of it.

    Without usable labels every score is that of the bias UNKNOWN, below 0.5, so none is
    predicted toxic. Repeated rows and null ids are scored like any row; a null id is not held
    out. A null or empty text gets the bias alone, an empty table gives no rows, a text of any
    length is read whole, in runs of bounded memory. Ties do not arise: rows are scored on
    their own. Only id and text are read, so other columns may have any name.
    """
    return score(docs, train(training_rows(docs, labels, most)))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """docs without the rows predicted toxic, columns as they are; one narrow pass, no join.

    The rows that score_toxicity predicts as 1 go. Without usable labels nothing is dropped;
    null and empty texts, null and repeated ids are judged like any row, and columns beside
    `text` and `doc_id` may have any name.
    """
    at, w, bias = train(training_rows(docs, labels, most))
    place = docs.columns.index("text")

    def clean(batches):
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        for batch in batches:
            totals = np.full(batch.num_rows, bias)
            texts = ((v.as_py() or "").encode() for v in batch.column(place))
            for first, counts, hashes in word_hashes(texts, TABLE):
                doc, index = features(hashes, counts)
                hit = np.flatnonzero(dense[index])
                key = np.unique((doc[hit] << BITS) | index[hit])
                totals[first : first + len(counts)] += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], len(counts))
            yield batch.filter(pa.array(totals < 0))

    return arrow_map(docs, clean, docs.schema)
