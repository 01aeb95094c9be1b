"""Removed strings against a table of all strings."""

import random

import pytest
from brute import repeats

from themelake.llm import parse_dedup as P


def texts(rng):
    passage = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (30, 49, 50, 51, 80, 200, 700)]
    out = []
    for _ in range(60):
        parts = [rng.choice(passage) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh é\n") for _ in range(rng.randrange(120))) for _ in range(rng.randrange(5))]
        out.append("".join(parts))
    return out + ["x" * 49, "x" * 50, "x" * 51, "x" * 5000, "ab" * 3000, "ab" * 60, None, "", passage[6][10:300], "=" * 400 + passage[5] + "=" * 400]


def got(df):
    return sorted(((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("small_slices", [False, True])
def test_same_as_table(spark, monkeypatch, small_slices):
    docs = list(enumerate(texts(random.Random(6))))
    random.Random(1).shuffle(docs)
    docs += [(None, docs[0][1]), (None, "x" * 60), (5, "x" * 300), (5, docs[3][1])]  # null ids, rows that share an id
    frame = spark.createDataFrame([(*d, "s", 0) for d in docs], "doc_id long, text string, first string, gram int").repartition(3)
    if small_slices:  # a text in many overlapping slices
        slices = P._slices

        def short(texts, length):
            P.SLICE = 400
            return slices(texts, length)

        monkeypatch.setattr(P, "SLICE", 400)
    assert got(P.remove_repeats(frame)) == sorted((r[:5] for r in repeats(docs)), key=repr)


def test_other_lengths(spark):
    docs = list(enumerate(texts(random.Random(9))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(P.remove_repeats(frame, length=31, gram=9)) == sorted((r[:5] for r in repeats(docs, 31)), key=repr)


def test_left_text(spark):
    long = "é" * 40 + "abcdefghij" * 6
    docs = [(1, "x" + long), (2, "y" + long + "z"), (3, "ñ" + "é" * 30)]
    rows = {r.doc_id: r for r in P.remove_repeats(spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, source string"), keep=("source",), texts=True).collect()}
    assert rows[1].text == "x" + long and rows[1].source == "k" and rows[2].text == "yz" and rows[3].text == "ñ"
    # a character that is cut in its middle goes whole
    assert P.kept_text("aéb".encode(), [(0, 2)]) == "b" and P.kept_text("aéb".encode(), [(2, 3)]) == "ab"
    assert P.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_of_one_id_whose_texts_hash_alike(spark):
    """Two texts with one 32-bit hash share an id; only the one that repeats a smaller document loses bytes."""
    from pyspark.sql import functions as F

    found = spark.range(300_000).select(F.concat(F.lit("A "), F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("t"))
    same = found.select("t", F.hash("t").alias("h")).groupBy("h").agg(F.collect_list("t").alias("t")).where("size(t) > 1").first()
    a, b = sorted(same.t[:2])
    docs = [(0, a), (5, a), (5, b), (5, b)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(P.remove_repeats(frame)) == sorted((r[:5] for r in repeats(docs)), key=repr)
    lost = sorted(r[2] for r in got(P.remove_repeats(frame)))
    assert lost == [0, 0, 0, len(a)]


@pytest.mark.parametrize("together", [0, 3])
def test_frequent_grams(spark, monkeypatch, together):
    docs = list(enumerate(texts(random.Random(8))))
    monkeypatch.setattr(P, "TOGETHER", together)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert got(P.remove_repeats(frame)) == sorted((r[:5] for r in repeats(docs)), key=repr)


def alike_by_lanes(rng):
    """Two strings of 50 bytes, different in two of them, of the same sum of lanes times odd numbers for both seeds and with the same trigger."""
    import numpy as np

    odd = [np.random.default_rng([seed, 50]).integers(1 << 63, size=7, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for seed in (1, 2)]
    pairs = [
        (i, j, x, y) for i in range(5) for j in range(i) for x in range(-60, 60) for y in range(1, 60)
        if all((x * int(m[i]) + y * int(m[j])) % 256 == 0 for m in odd)
    ]
    while True:
        i, j, x, y = rng.choice(pairs)
        a = bytearray(rng.choice(b"ABCDEFGHabcdefgh !#") for _ in range(50))
        a[8 * i + 7], a[8 * j + 7] = (33 if x > 0 else 100), 50
        b = bytearray(a)
        b[8 * i + 7] += x
        b[8 * j + 7] += y
        p, q = (P.phrases([(0, 0, bytes(t))], 50, 20) for t in (a, b))
        if p["gram"][0] == q["gram"][0]:
            return a.decode(), b.decode()


def test_strings_of_frequent_grams_that_differ_in_two_bytes(spark, monkeypatch):
    docs = list(enumerate(alike_by_lanes(random.Random(3))))
    monkeypatch.setattr(P, "TOGETHER", 0)
    assert [r[2] for r in got(P.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))] == [0, 0]


def test_strings_with_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    rng = random.Random(4)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(8, 30))) for _ in range(60)]
    group, doc = np.sort(np.array([rng.randrange(4) for _ in keys])), np.array([rng.randrange(9) for _ in keys])
    want = [(k, x) for k, t in enumerate(keys) for x in range(len(t) - 7) if any(
        group[m] == group[k] and doc[m] < doc[k] and t[x : x + 8] in keys[m] for m in range(len(keys)))]
    for hashed in (P._digest, lambda lanes, at, size, seed: at.astype(np.uint64) % np.uint64(2) * np.uint64(0)):
        monkeypatch.setattr(P, "_digest", hashed)
        found = P.repeated(keys, group, doc, 8)
        assert [(k, x) for k, a, b in zip(*found) for x in range(a, b + 1)] == want and len(want) > 20


def test_a_place_travels_as_one_number(spark):
    """Two longs and the gram a row: five columns took more disk than the budget."""
    docs = spark.createDataFrame([(3, "abcdefghij" * 30)], "doc_id long, text string")
    rows = P._parsed(docs, 50, 20, places=True)
    assert rows.columns == ["gram", "doc_id", "place"]
    p = P.phrases([(0, 0, b"abcdefghij" * 30)], 50, 20)
    unpacked = sorted((r.gram, r.place >> 32, (r.place >> 16) & 0xFFFF, r.place & 0xFFFF) for r in rows.collect())
    assert unpacked == sorted(zip(p["gram"].tolist(), p["first"].tolist(), (p["trigger"] - p["first"]).tolist(), (p["last"] - p["first"]).tolist()))
