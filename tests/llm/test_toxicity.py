"""Held-out accuracy, unseen spellings, odd rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from themelake.llm import toxicity as T


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "er", "th", "on", "ing", "re", "st", "le"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def docs_and_labels(rng, n):
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(40, 200)).split()
        toxic = int(i % 4 == 0)
        for _ in range(toxic * (2 + len(words) // 40)):
            words[rng.randrange(len(words))] = "grubw" + rng.choice("aeiou") + rng.choice(["nd", "ck", "st", "lm", "rt", "sh", "pp"])
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def test_unseen_endings(spark):
    rng = random.Random(5)
    docs, labels = docs_and_labels(rng, 600)
    tests = [(10_000 + i, prose(rng, 60) + (" Grubwyzz! " if i % 2 else " ") + prose(rng, 20) + (" grubwoff grubwezt, grubwüb" if i % 2 else "")) for i in range(40)]
    odd = [(20_000, None), (20_001, ""), (20_002, "!!! ..."), (None, "null id")]
    frame = spark.createDataFrame([(*d, 0.0) for d in docs + tests + odd + docs[:1]], "doc_id long, text string, score double")
    known = spark.createDataFrame(labels + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    rows = T.score_toxicity(frame, known).collect()
    assert len(rows) == 600 + 40 + 4 + 1 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    right = sum((by[d] >= 0.5) == (d % 2 == 1) for d, _ in tests)
    assert right >= 38
    assert by[20_000] == by[20_001] == by[20_002] < 0.5


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in T.score_toxicity(docs, none).collect()] == [0.5, 0.5]
    assert T.score_toxicity(docs.limit(0), none).count() == 0


def test_held_out(spark):
    rows = spark.range(200).select("id", T.held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 5 == 0 for r in rows]


def test_grams_do_not_cross_words():
    shape = T.Shape(shortest=3, longest=4)
    apart = [set(T.grams([w], shape)[0].tolist()) for w in (b"ab", "é".encode(), b"abcdef")]
    ids, of = T.grams([b"ab", "é".encode(), b"abcdef"], shape)
    assert [set(ids[of == k].tolist()) for k in range(3)] == apart
    assert [int((of == k).sum()) for k in range(3)] == [3, 3, 11]


def test_all_grams_of_a_long_document_are_learned(spark):
    rng, shape = random.Random(8), T.Shape()
    long = " ".join("%x" % rng.randrange(16**9) for _ in range(3000))
    docs = spark.createDataFrame([(1, long), (2, "a few words")], "doc_id long, text string")
    bags, toxic = T.training_bags(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), shape, max_docs=8)
    ids, n = np.unique(T.grams(T.words_of(long), shape)[0], return_counts=True)
    assert len(ids) > 20_000 and toxic.tolist() == [1, 0]
    assert bags[0][0].tolist() == ids.tolist() and bags[0][1].tolist() == n.tolist()
