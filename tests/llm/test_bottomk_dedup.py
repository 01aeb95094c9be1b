"""Components against all pairs; hot groups stay linear."""

import random

import pytest
from brute import components

from themelake.llm import bottomk_dedup as B
from themelake.llm.components import components as link


def docs_with_copies(rng, words):
    vocabulary = ["w%d" % i for i in range(400)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 7, 8, 9, 12, 20, 40, 90, 300]))]
        out.append(base)
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(max(1, len(base) // (12 * words)) + 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(copy)
    passage = [rng.choice(vocabulary) for _ in range(60)]  # shared, but not enough to be alike
    out += [passage + [rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(40)]
    rng.shuffle(out)
    return [(i * 3, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_same_as_all_pairs(spark, words, percent):
    docs = docs_with_copies(random.Random(words), words)
    docs += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "ONE "), (1005, "one two"), (1006, "One\ntwo"), (1007, "É"), (1008, "é")]
    expected = components(docs, words, percent)
    frame = spark.createDataFrame([(*d, "a", "b") for d in docs], "doc_id long, text string, rep string, key string")
    rows = B.near_duplicates(frame, words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(docs)


def test_odd_rows(spark):
    text = " ".join("v%d" % i for i in range(50))
    docs = [(None, text), (None, None), (7, text), (7, text), (3, text), (9, text + " more")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in B.near_duplicates(frame).collect()), key=repr)
    assert rows == sorted([(None, None, True), (None, None, True), (7, 3, False), (7, 3, False), (3, 3, True), (9, 3, False)], key=repr)
    assert B.near_duplicates(frame.limit(0)).count() == 0


def test_large_group_costs_one_test_each(spark, monkeypatch):
    rng = random.Random(3)
    base = ["b%d" % i for i in range(200)]
    docs = []
    for i in range(400):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = "x%d" % rng.randrange(10**6)
        docs.append((i, " ".join(copy if i else base)))
    asked = []
    confirmed = B._confirmed
    monkeypatch.setattr(B, "_confirmed", lambda pairs, *a: asked.append(pairs.count()) or confirmed(pairs, *a))
    rows = B.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.component_id for r in rows} == {0}
    assert sum(asked) < 3 * len(docs)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(200, k) for k in range(201, 240)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in link(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in got} and {x for p in pairs if p[0] != p[1] for x in p} == set(got)
    assert link(spark.createDataFrame([], "a long, b long")).count() == 0
