"""Exact duplicates against a dictionary of texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from themelake.llm import bloom_dedup as B

SCHEMA = "doc_id long, text string, kept string, _digest int, block int, note string"
LONG = "long text " * 200_000
ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, None), (7, "A"), (8, "a "), (2, "a"), (2, "other"), (2, "b"),
    (None, "a"), (None, "only null ids"), (None, "only null ids"), (9, LONG), (10, LONG), (11, LONG + "."), (12, "é"), (13, "é"), (3, "b"),
]


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out, seen = [], set()
    for d, t in rows:
        ids = groups[t or ""]
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        kept = d == top and (t or "") not in seen
        if kept:
            seen.add(t or "")
        out.append((d, top, len(ids), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, f"n{i}") for i, (d, t) in enumerate(rows)], SCHEMA)


def found(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr)


@pytest.mark.parametrize("bits", [8, 1, 64])
def test_nulls_ties_repeats_and_long_texts(spark, bits):
    docs = table(spark, ROWS)
    assert found(B.exact_duplicates(docs, bits_per_row=bits)) == brute(ROWS)
    assert found(B.exact_duplicates(docs.repartition(7), bits_per_row=bits)) == brute(ROWS)


def test_empty_table(spark):
    assert B.exact_duplicates(table(spark, ROWS).limit(0)).count() == 0


def test_a_third_in_one_group_and_a_full_filter(spark):
    """3,000 rows share a text, the rest is single or doubled; one block of bits is then full."""
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5000)).alias("text"),
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = B.exact_duplicates(docs)
    assert found(result) == brute(rows)
    single = result.where("group_size = 1")
    assert single.where("passed").count() > 0.85 * single.count()
    assert result.where("group_size > 1 AND passed").count() == 0
    assert found(B.exact_duplicates(docs, bits_per_row=1, max_filter_mb=1)) == brute(rows)


def test_filter_never_misses_a_repeat(spark):
    rows = spark.range(20_000).select(B.text_digest((F.col("id") % 15_000).cast("string")).alias("d"), (F.col("id") % 15_000).alias("k"))
    for blocks in (1, 3, 40):
        repeats = B.repeat_filter(rows, "d", blocks)
        missed = B.maybe_repeated(rows, "d", blocks, repeats).where("k < 5000 AND NOT maybe")
        assert missed.count() == 0


def test_columns_to_keep(spark):
    kept = B.exact_duplicates(table(spark, ROWS), keep=("note", "block")).where("kept")
    assert sorted(r.note for r in kept.select("note").collect())[:2] == ["n1", "n10"] or kept.count() == len({t or "" for _, t in ROWS})
    assert {"note", "block"} <= set(kept.columns)
    with pytest.raises(ValueError, match="names of results"):
        B.exact_duplicates(table(spark, ROWS), keep=("kept",))


def test_plan_is_native_and_texts_do_not_move(spark, plan):
    result = B.exact_duplicates(table(spark, ROWS))
    text = plan(result)
    assert "Python" not in text and "Arrow" not in text and "BroadcastHashJoin" in text
    assert "text#" not in text
