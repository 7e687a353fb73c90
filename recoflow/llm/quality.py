"""Operator 1: quality scores by supervised subword embeddings.

A text's features are its words, pairs of neighbouring words (a word that
repeats the one before is one feature, whatever the word) and the 3- and 4-grams
of the words' characters (with a mark before and after each word), hashed into
``BUCKETS`` rows of learned vectors, and one constant feature. The vectors of all features are averaged and
a softmax over the classes is put on top; both are trained by stochastic
gradient descent in numpy.

Training reads a bounded sample: at most ``SAMPLE_DOCS`` labelled documents per
class, picked by a hash of the id, of at most ``SAMPLE_DOC_CHARS`` characters.
Since averaging is linear, each bucket's vector is folded with the output layer
into one number per class; the tasks get that table and score whole texts in one
pass without a shuffle.

Defined cases: null and empty texts have the constant feature alone; with one
class or none to learn from, scores are 1, 0 or 0.5 throughout; null labels and
ids, and documents with labels of both kinds, are not learned from, and of an id on several rows only its
smallest text is; repeated rows score alike; an empty table gives an
empty result; no column but text enters a score, others are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import smallest
from recoflow.llm.cross_parse import text_pieces

BUCKETS = 1 << 18
DIM = 12
EPOCHS = 6
RATE = 0.4
SAMPLE_DOCS = 1_000
SAMPLE_DOC_CHARS = 20_000
SEED = 7
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scatter(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, then take a bucket (0 is the constant feature, 1 a repeated word)."""
    h = (h ^ (h >> np.uint64(29))) * _MIX
    h ^= h >> np.uint64(32)
    return (h % np.uint64(BUCKETS - 2)).astype(np.int64) + 2


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every feature of the texts, the constant feature of each included."""
    spaced = [f" {' '.join(t.split())} " for t in texts]
    code = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in spaced])
    gap = code == 32
    mixed = (code + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    buckets, owners = [np.zeros(len(texts), dtype=np.int64)], [np.arange(len(texts))]
    start = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if len(start):
        end = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
        # A word is the sum of its characters, each times a power by its place.
        size = end - start
        at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        power = np.cumprod(np.full(int(size.max()), 0x100000001B3, dtype=np.uint64))
        word = np.add.reduceat(mixed[at] * power[at - np.repeat(start, size)], np.cumsum(size) - size)
        buckets.append(_scatter(word))
        owners.append(owner[start])
        # Word pairs, of which all pairs of a word with itself are one feature.
        pair = owner[start[1:]] == owner[start[:-1]]
        one, two = word[:-1][pair], word[1:][pair]
        buckets.append(np.where(one == two, 1, _scatter(one * np.uint64(31) + two)))
        owners.append(owner[start[1:]][pair])
    for n in (3, 4):
        if len(code) < n:
            continue
        last = len(code) - n + 1
        ok = owner[:last] == owner[n - 1:]
        for k in range(1, n - 1):  # a gap only as the mark at either end
            ok &= ~gap[k:k + last]
        h = np.full(last, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ mixed[k:k + last]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        buckets.append(_scatter(h[ok]))
        owners.append(owner[:last][ok])
    return np.concatenate(buckets), np.concatenate(owners)


def fit(texts: list[str], labels: list[int], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[list[int], np.ndarray]:
    """Classes, and per bucket its number for each class (vectors times the output layer)."""
    classes = sorted(set(labels))
    if not classes:
        return [], np.zeros((BUCKETS, 0), dtype=np.float32)
    bags = []
    for t in texts:
        ids, n = np.unique(features([t])[0], return_counts=True)
        bags.append((ids, (n / n.sum()).astype(np.float32)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    top = np.zeros((len(classes), dim), dtype=np.float32)
    y = np.array([classes.index(v) for v in labels])
    weight = (len(y) / (len(classes) * np.bincount(y, minlength=len(classes)))).astype(np.float32)
    steps, done = max(1, epochs * len(y)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids, share = bags[i]
            mean = share @ vectors[ids]
            z = top @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= rate * (1 - done / steps) * weight[y[i]]
            pull = p @ top
            top -= np.outer(p, mean)
            vectors[ids] -= np.outer(share * len(ids) ** 0.5, pull)
            done += 1
    return classes, vectors @ top.T


def score(classes: list[int], table: np.ndarray, texts: list[str], positive: int = 1) -> np.ndarray:
    """Probability of the positive class for each text."""
    if positive not in classes or len(classes) < 2:
        return np.full(len(texts), 0.5 if not classes else float(positive in classes))
    ids, owner = features(texts)
    n = np.bincount(owner, minlength=len(texts))
    z = np.stack([np.bincount(owner, weights=table[ids, k], minlength=len(texts)) / n for k in range(len(classes))], axis=1)
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p[:, classes.index(positive)] / p.sum(axis=1)


def train(docs: DataFrame, labels: DataFrame, eligible: Column | None = None, label: str = "quality",
          sample_docs: int = SAMPLE_DOCS) -> tuple[list[int], np.ndarray]:
    """Fit on documents (doc_id, text) that ``labels`` (doc_id, label) marks, where ``eligible`` (on doc_id) holds."""
    marked = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    if eligible is not None:
        marked = marked.where(eligible)
    # Documents with labels of both kinds teach nothing.
    marked = marked.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select(
        "doc_id", "y", F.xxhash64(F.lit("sample"), "doc_id").alias("h"))
    short = docs.where(F.coalesce(F.char_length("text"), F.lit(0)) <= SAMPLE_DOC_CHARS)
    ids = smallest(marked.join(short.select("doc_id"), "doc_id", "left_semi"), "y", "h", "doc_id", sample_docs)
    rows = short.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id", "y", "h").agg(F.min("text").alias("text")).collect()  # an id may stand on many rows
    rows.sort(key=lambda r: (r.h, r.doc_id, r.text or ""))
    return fit([r.text or "" for r in rows], [r.y for r in rows])


def score_documents(docs: DataFrame, model: tuple[list[int], np.ndarray], score_as: str = "score") -> DataFrame:
    """``docs`` with its score as last column (in place of a column so named)."""
    docs = docs.drop(score_as)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias(score_as)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table = sent.value
        for batch in batches:
            for piece, texts in text_pieces(batch):
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(score(classes, table, texts), pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
