"""Decontamination against a plain scan of every document for every window."""

import hashlib
import random
import re

from themelake.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            size = min(window, len(iw))
            if item is None or not size:
                continue
            for i in range(len(iw) - size + 1):
                for k in range(len(w) - size + 1):
                    if w[k : k + size] == iw[i : i + size]:
                        hit.update(range(k, k + size))
                        found.add(str(item))
        n = len(hit)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), n, len(found), digest, n > 0 and 20 * n >= len(w)))
    return sorted(out, key=repr)


def found(df):
    from pyspark.sql import functions as F

    rows = df.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), D.digest(F.col("items")).alias("d"), "contaminated").collect()
    return sorted([tuple(r) for r in rows], key=repr)


def case():
    rng = random.Random(2)
    vocabulary = ["w%d" % i for i in range(12)] + ["É", "ß2", "x_y", "Tab\tx"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 4, 5, 9, 13, 14, 30]))) for i in range(25)]
    items += [(7, say(20)), (8, None), (None, say(14)), (9, ""), (10, "a " * 40), (11, "...")]
    docs = [(i, say(rng.randrange(0, 60))) for i in range(40)]
    for i in range(40, 80):
        item = rng.choice(items)[1] or ""
        docs.append((i, say(rng.randrange(0, 90)) + " " + item.upper() + "," + say(rng.randrange(0, 20))))
    return docs + [(80, None), (81, ""), (None, items[3][1]), (82, items[4][1]), (82, items[4][1])], items


def test_same_as_scan(spark):
    docs, items = case()
    d = spark.createDataFrame([(*x, "spans") for x in docs], "doc_id long, text string, items string").repartition(3)
    b = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, n_words string")
    expected = brute(docs, items)
    assert found(D.find_contamination(d, b)) == expected
    assert found(D.find_contamination(d, b, block_words=60)) == expected  # several blocks


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(D.find_contamination(docs, none)) == brute([(1, "a b c")], [])
    assert D.find_contamination(docs.limit(0), none).count() == 0
