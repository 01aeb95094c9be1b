"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A lower-cased word is the bag of its byte n-grams (``<`` and ``>`` mark its
ends), hashed to ``buckets``. Each bucket has an embedding; a text is the mean
of the embeddings of all n-grams of all its words; a linear layer and a softmax
give the two classes. Embeddings and layer are trained jointly, in numpy. Words
that were never seen (misspellings, new endings) share n-grams, and so vectors,
with seen ones.

Training takes at most ``max_docs`` labelled documents (a quarter of them toxic,
chosen by the hash of their id, so the choice does not depend on the order of
rows); their n-gram counts are made on the executors and brought to the driver
whole, at most ``max_docs * buckets`` pairs.

As layer and mean are linear, a bucket adds one number to the difference of the
two classes: only those numbers go to the executors (``buckets`` doubles), and
scoring is one map over the documents without a shuffle. A worker remembers the
sums of words it has met, at most ``MEMO``.

Defined results: a text without words (null, empty, signs only) gets the score
of the bias alone. Labels with a null id or class are ignored; the higher class
wins where a document has several; repeated documents of an id are trained on
once. Without labels of both classes the score is the share of class 1 (0.5
without any). Repeated rows are scored once per row; a null id is not held out.
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, query, runs, table

#: Bytes of words as they are, all other bytes blank.
WORD_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
MEMO, CHUNK_BYTES = 600_000, 2_000_000


@dataclass(frozen=True)
class Shape:
    shortest: int = 3
    longest: int = 6
    buckets: int = 1 << 17
    dim: int = 8


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(WORD_BYTES).split()


def grams(words: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and the word each belongs to (sorted by word in each length)."""
    text = np.frombuffer(b"".join([b"<%b>" % w for w in words]) + bytes(8), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(ends))
    value, found, of = text[: len(ends)], [], []
    for n in range(2, shape.longest + 1):
        value = value | (text[n - 1 : n - 1 + len(ends)] << np.uint64(8 * (n - 1)))
        if n >= shape.shortest:
            whole = at + n <= ends
            found.append(mixed(value[whole] + (np.uint64(n) << np.uint64(56))) & np.uint64(shape.buckets - 1))
            of.append(owner[whole])
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


class Scorer:
    """Sum of bucket numbers and count of n-grams, by word."""

    def __init__(self, weights: np.ndarray, bias: float, shape: Shape):
        self.weights, self.bias, self.shape = weights, bias, shape
        self.sums: dict[bytes, float] = {}
        self.counts: dict[bytes, int] = {}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        bags = [words_of(t) for t in texts]
        sizes = np.array([len(b) for b in bags], dtype=np.int64)
        words = [w for b in bags for w in b]
        if len(self.sums) > MEMO:
            self.sums, self.counts = {}, {}
        known = self.sums
        new = list({w for w in words if w not in known})
        if new:
            buckets, of = grams(new, self.shape)
            known.update(zip(new, np.bincount(of, self.weights[buckets], len(new)).tolist(), strict=True))
            self.counts.update(zip(new, np.bincount(of, minlength=len(new)).tolist(), strict=True))
        cut = np.concatenate([[0], np.cumsum(sizes)])
        total = np.concatenate([[0.0], np.cumsum(np.fromiter(map(known.__getitem__, words), np.float64, len(words)))])
        count = np.concatenate([[0], np.cumsum(np.fromiter(map(self.counts.__getitem__, words), np.int64, len(words)))])
        total, count = total[cut[1:]] - total[cut[:-1]], count[cut[1:]] - count[cut[:-1]]
        return _sigmoid(self.bias + total / np.maximum(count, 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, shape: Shape, steps: int = 1200, batch: int = 64,
    rate: float = 3000.0, layer_rate: float = 0.1, min_docs: int = 4, seed: int = 1,
) -> tuple[np.ndarray, float]:
    """Fit embeddings and softmax layer jointly by gradient descent; returns each bucket's number and the bias.

    ``bags``: bucket ids and counts of each document. In the mean a bucket counts
    by the inverse root of the share of documents that hold it, and not at all
    below ``min_docs`` documents: what a few documents share by chance would be
    learned by heart. Steps are plain (not scaled by past gradients) for the
    same reason: consistent n-grams move most.
    """
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    if not bags or not 0 < share < 1:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return np.zeros(shape.buckets), float(np.log(share / (1 - share)))
    held = np.bincount(np.concatenate([i for i, _ in bags]), minlength=shape.buckets)
    scale = np.where(held >= min_docs, np.sqrt(len(bags) / np.maximum(held, 1)), 0.0)
    for d, (i, n) in enumerate(bags):
        some = scale[i] > 0
        bags[d] = (i[some], (scale[i[some]] * n[some] / n.sum(dtype=np.int64)).astype(np.float32))
    embed = rng.normal(0, 0.1, (shape.buckets, shape.dim)).astype(np.float32)
    layer, bias = rng.normal(0, 0.3, (shape.dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    epochs = max(1, round(steps * batch / len(bags)))
    for epoch in range(epochs):
        order, slower = rng.permutation(len(bags)), 1 - epoch / epochs
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            ids = np.concatenate([bags[d][0] for d in part])
            weight = np.concatenate([bags[d][1] for d in part])
            doc = np.repeat(np.arange(len(part)), [len(bags[d][0]) for d in part])
            used, slot = np.unique(ids, return_inverse=True)
            local = embed[used]
            means = np.stack([np.bincount(doc, weight * local[slot, k], len(part)) for k in range(shape.dim)], axis=1)
            z = means @ layer + bias
            wrong = np.exp(z - z.max(axis=1, keepdims=True))
            wrong /= wrong.sum(axis=1, keepdims=True)
            wrong[np.arange(len(part)), labels[part]] -= 1
            wrong /= len(part)
            back = wrong @ layer.T
            grads = np.stack([np.bincount(slot, weight * back[doc, k], len(used)) for k in range(shape.dim)], axis=1)
            embed[used] -= rate * slower * grads
            layer -= layer_rate * slower * (means.T @ wrong)
            bias -= layer_rate * slower * wrong.sum(axis=0)
    return scale * (embed @ (layer[:, 1] - layer[:, 0])), float(bias[1] - bias[0])


def training_bags(docs: DataFrame, labels: DataFrame, shape: Shape, max_docs: int):
    """Bucket counts and classes of a bounded sample of the labelled documents."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    most = {1: max_docs // 4, 0: max_docs - max_docs // 4}
    picks = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in most.items()]
    sample = picks[0].unionByName(picks[1])

    def counted(batches):
        for batch in batches:
            out = {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "buckets": [], "counts": []}
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                ids, n = np.unique(grams(words, shape)[0], return_counts=True) if words else (np.zeros(0, np.int64),) * 2
                out["buckets"].append(ids.astype(np.int32).tobytes())
                out["counts"].append(n.astype(np.uint16 if n.max(initial=0) < 1 << 16 else np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict(out)

    # of texts that share an id the one with the least hash, whatever the order of rows
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(least)
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, toxic {labels.schema['toxic'].dataType.simpleString()}"
    found = []
    # partition by partition, so that neither side of the driver holds the rows twice
    for row in rows.select("doc_id", "toxic", "text").mapInArrow(counted, f"{kinds}, buckets binary, counts binary").toLocalIterator():
        if row.buckets:
            ids = np.frombuffer(row.buckets, np.int32)
            counts = np.frombuffer(row.counts, np.uint16 if len(row.counts) == 2 * len(ids) else np.uint32)
            found.append((row.doc_id, int(row.toxic), ids, counts))
    found.sort(key=lambda f: f[0])
    return [(ids, n) for _, _, ids, n in found], np.array([toxic for _, toxic, _, _ in found], dtype=np.int64)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), max_docs: int = 6000,
) -> DataFrame:
    """doc_id and score of every document, trained on ``labels`` (doc_id, toxic 0 or 1)."""
    weights, bias = train(*training_bags(docs, labels, shape, max_docs), shape)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def scored(batches):
        scorer = Scorer(*shared.value, shape)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [scorer.scores(texts[i:j]) for i, j in runs([len(t or "") for t in texts], CHUNK_BYTES)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts or [np.zeros(0)]))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query()
def op10_toxicity(spark, sf_dir):
    """Score of every whole document; one labelled document in five is never learned from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    scored = score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
