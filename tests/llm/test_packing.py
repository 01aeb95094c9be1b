"""Packed matrices give every document back; the segment tree finds the tightest fit."""

import random

import numpy as np

from themelake.llm import packing as P


def plain_best_fit(lengths, size):
    free, out = [], []
    for s in sorted(range(len(lengths)), key=lambda s: -lengths[s]):
        fits = [r for r in free if r >= lengths[s]]
        k = free.index(min(fits)) if fits else len(free)
        if not fits:
            free.append(size)
            out.append([])
        free[k] -= lengths[s]
        out[k].append(s)
    return sorted(free)


def test_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        size = rng.choice([1, 5, 16, 37])
        lengths = [rng.randrange(1, size + 1) for _ in range(rng.randrange(60))]
        packed = P.best_fit(lengths, size)
        assert sorted(s for q in packed for s in q) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[s] for s in q) for q in packed) == plain_best_fit(lengths, size)


def test_round_trip(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "word", "lorem " * 3000] + [" ".join(rng.choice(["alpha", "bêta", "x"]) for _ in range(rng.randrange(400))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, "null id", "c"), (2, "word", "c")], "doc_id long, text string, ids string").repartition(3)
    packed = P.pack(docs, size=128, bucket_tokens=3000, rows_per_matrix=4)
    P.write_packed(packed, str(tmp_path / "packed"))
    packed = spark.read.parquet(str(tmp_path / "packed"))
    rows = packed.collect()
    assert len({r.matrix_id for r in rows}) == len(rows)
    for r in rows:
        ids, positions = [np.frombuffer(x, "<u2").reshape(r.n_rows, 128) for x in (r["ids"], r["positions"])]
        for row, pos, ends in zip(ids, positions, r["cu_seqlens"], strict=True):
            assert ends[0] == 0 and (row[ends[-1] :] == 0).all() and (pos[ends[-1] :] == 0).all()
            assert pos[: ends[-1]].tolist() == [i for a, b in zip(ends, ends[1:], strict=False) for i in range(b - a)]
    whole = {}
    for r in P.unpack(packed, 128).collect():
        whole.setdefault(r.doc_id, []).append((r.part, r.ids))
    model = P.tokenizer(P.MODEL)
    for i, t in enumerate(texts):
        parts = sorted(whole[i])
        if i == 2:
            parts = parts[:1]  # its row is there twice
        assert [x for _, ids in parts for x in ids] == model.encode(t or "") + [2]
        assert all(len(ids) == 128 for _, ids in parts[:-1])
    assert len(whole[2]) == 2 and len(whole[None]) == 1
    assert P.pack(docs.limit(0)).count() == 0


def test_words_remembered_give_the_ids_of_whole_texts():
    model, rng = P.tokenizer(P.MODEL), random.Random(8)
    letters = ["a", "b", "é", "ñ", "e\u0301", "\u00b4", "\u200b", "\u00a0", "\n", "\t", "\r\n", " ", "  ", "\u3000", "ﬁ", "Ⅳ", "日", "本", "\U0001f600", ".", "1", "<s>", "</s>", "\u2581", "ß", "\x00", "\u0301", "½"]
    words = P.Words(model)
    assert words.apart
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(3000)]
    assert [list(x) for x in words(texts)] == [model.encode(t) for t in texts]
    texts = [" ".join(rng.choice(["one", "two", "three", "four", "five" * 30]) for _ in range(9)) for _ in range(50)] + ["", "x " * 100_000 + "y"]
    words.MOST = 3
    for cut in (1, 100, 10**7):
        P.TOGETHER, before = cut, P.TOGETHER
        try:
            assert [list(x) for x in words(texts)] == [model.encode(t) for t in texts]
        finally:
            P.TOGETHER = before
    assert list(words([])) == []


def test_other_types_of_ids(spark):
    from decimal import Decimal

    for kind, value in (("decimal(20,0)", Decimal(7)), ("smallint", 7), ("string", "seven")):
        packed = P.pack(spark.createDataFrame([(value, "a text"), (None, "b")], f"doc_id {kind}, text string"), size=16)
        assert sorted((r.doc_id for r in P.unpack(packed, 16).collect()), key=repr) == sorted([value, None], key=repr)
