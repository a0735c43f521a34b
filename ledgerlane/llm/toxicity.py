"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, each hashed to one of ``FEATURES`` embeddings; a stretch of
``STRETCH`` words is the mean of its words' means, and a linear softmax over it gives the chance of toxicity. A misspelt word
shares most n-grams, and so most of its vector, with the word it stands for. A text is as toxic as its most toxic
stretch, so that a few words count in a long text; every word of every text is looked at. A run of more than ``RUN`` characters
without white space is cut into pieces of ``PIECE`` characters that overlap by half; each piece is a word.

Learning uses at most ``TRAIN_ROWS`` labelled rows and ``TRAIN_BYTES`` bytes of text, those with the
smallest hash of their id, of rows whose crc32(id as text) modulo ``FOLDS`` is not 0. As the model is linear, an n-gram's
embedding and the softmax weights fold into one number per n-gram, and only these are broadcast.

NULL and empty texts get the chance of a stretch that says nothing. Rows with NULL labels are not learned from; without labels, or with labels of one
kind only, scores follow the share of toxic rows, 0 without labels. A NULL id counts as the text "" in the split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .caches import WordCache

FEATURES = 1 << 17
DIMENSIONS = 6
STRETCH = 8
RUN = 64
PIECE = 16
GRAMS = (3, 4, 5)
EPOCHS = 50
MEAN_EPOCHS = 10
RATE = 0.05
DECAY = 1e-5
LEAST_DOCUMENTS = 6
FOLDS = 5
TRAIN_ROWS = 4000
TRAIN_BYTES = 24 << 20


def words_of(text: str) -> list[bytes]:
    out = []
    for word in text.lower().encode().split():
        if len(word) <= RUN or len(run := word.decode()) <= RUN:
            out.append(word)
        else:
            out += [run[k : k + PIECE].encode() for k in range(0, len(run) - PIECE // 2, PIECE // 2)]
    return out


def features(word: bytes) -> list[int]:
    """Hashed n-grams of a word between marks, and the word itself."""
    marked = "<" + word.decode() + ">"
    found = {marked} | {marked[k : k + n] for n in GRAMS for k in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode()) % FEATURES for g in sorted(found)]


class Bags:
    """Documents as stretches of words, words as bags of features."""

    def __init__(self, texts: list[str]):
        index: dict[bytes, int] = {}
        self.words, self.stretches, doc_of = [], [], []
        for d, text in enumerate(texts):
            numbers = [index.setdefault(w, len(index)) for w in words_of(text)]
            for k in range(0, len(numbers), STRETCH):
                self.stretches.append(len(numbers[k : k + STRETCH]))
                doc_of.append(d)
            self.words += numbers
        bags = [features(w) for w in index]
        self.words = np.array(self.words, np.int64)
        self.stretches = np.array(self.stretches, np.int64)
        self.begins = np.cumsum(self.stretches) - self.stretches
        self.doc = np.array(doc_of, np.int64)
        self.sizes = np.array([len(b) for b in bags], np.int64)
        self.features = np.array([f for b in bags for f in b], np.int64)
        self.owner = np.repeat(np.arange(len(bags)), self.sizes)
        self.n_docs = len(texts)

    def strongest(self, logits: np.ndarray) -> np.ndarray:
        """The stretch of the highest logit of each document that has one."""
        order = np.lexsort((logits, self.doc))
        last = np.append(self.doc[order][1:] != self.doc[order][:-1], True)
        return order[last]


def fit(texts: list[str], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """One number per feature and a bias: a word's number is the mean over its features, a stretch's the mean over its words."""
    share = float(np.mean(labels)) if len(labels) else 0.0
    prior = np.log((share + 1e-6) / (1 - share + 1e-6))
    bags = Bags(texts)
    if not len(bags.words) or share in (0.0, 1.0):
        return np.zeros(FEATURES, np.float32), float(prior)
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.1, (FEATURES, DIMENSIONS))
    softmax = random.normal(0, 0.1, (DIMENSIONS, 2))
    bias = np.array([0.0, prior])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (embedding, softmax, bias)]
    per_feature = 1.0 / bags.sizes[bags.owner]
    # An n-gram of too few documents could only be learned by heart.
    doc_of = np.repeat(bags.doc, bags.stretches)
    pairs = np.unique(doc_of * len(bags.sizes) + bags.words) % len(bags.sizes)
    documents = np.bincount(pairs, minlength=len(bags.sizes))
    usual = np.bincount(bags.features, documents[bags.owner], FEATURES) >= LEAST_DOCUMENTS
    embedding *= usual[:, None]
    stretch_of = np.repeat(np.arange(len(bags.stretches)), bags.stretches)
    target = labels[bags.doc]
    for epoch in range(1, EPOCHS + 1):
        vectors = np.stack([np.bincount(bags.owner, embedding[bags.features, k] * per_feature, len(bags.sizes)) for k in range(DIMENSIONS)], axis=1)
        means = np.add.reduceat(vectors[bags.words], bags.begins) / bags.stretches[:, None]
        logits = means @ softmax + bias
        odds = logits[:, 1] - logits[:, 0]
        chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if epoch <= MEAN_EPOCHS:
            weight = 1.0 / np.bincount(bags.doc, minlength=bags.n_docs)[bags.doc]
        else:
            weight = np.zeros(len(odds))
            weight[bags.strongest(odds)] = 1.0
        # Both kinds of labels weigh the same.
        weight = weight * np.where(target == 1, 0.5 / share, 0.5 / (1 - share)) / bags.n_docs
        error = (chance - target) * weight
        both = np.stack([-error, error], axis=1)
        d_softmax, d_bias = means.T @ both, both.sum(axis=0)
        d_means = (both @ softmax.T) / bags.stretches[:, None]
        d_words = np.stack([np.bincount(bags.words, d_means[stretch_of, k], len(bags.sizes)) for k in range(DIMENSIONS)], axis=1)
        d_embedding = np.stack([np.bincount(bags.features, d_words[bags.owner, k] * per_feature, FEATURES) for k in range(DIMENSIONS)], axis=1) * usual[:, None] + DECAY * embedding
        for p, g, (m, v) in zip((embedding, softmax, bias), (d_embedding, d_softmax, d_bias), state):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-9)
    return (embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The bounded sample (text, label) that is learned from."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    known = labels.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & (F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != 0))
    known = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), body.alias("t")).join(F.broadcast(known), "id")  # at most TRAIN_ROWS rows
    size = F.sum(F.octet_length("t")).over(Window.orderBy(F.xxhash64("id"), "id", "t").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__sum", size).filter(F.col("__sum") <= TRAIN_BYTES).select("t", "label")


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    spark = docs.sparkSession
    sample = training_rows(docs, labels, doc_id, text, label).toPandas()  # bounded by TRAIN_ROWS and TRAIN_BYTES
    numbers, bias = fit(sample["t"].tolist(), sample["label"].to_numpy(np.float64))
    shared = spark.sparkContext.broadcast(numbers)
    key = zlib.crc32(numbers.tobytes())
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compute(words: list[bytes]) -> list[float]:
            bags = [features(w) for w in words]
            sizes = np.array([len(b) for b in bags])
            return (np.add.reduceat(shared.value[[f for b in bags for f in b]], np.cumsum(sizes) - sizes) / sizes).tolist() if bags else []

        cache = WordCache.of(("toxicity", key), compute)
        for batch in batches:
            out = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                odds = bias
                if words := words_of(t):
                    found = np.array(cache.get(words))
                    begins = np.arange(0, len(found), STRETCH)
                    sizes = np.minimum(len(found) - begins, STRETCH)
                    odds = float((np.add.reduceat(found, begins) / sizes).max()) + bias
                score = float(1 / (1 + np.exp(-min(max(odds, -30.0), 30.0))))
                out.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == 0, score, int(score >= 0.5)))
            kinds = [pa.int64(), pa.bool_(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
