"""Replicas with rot, losses, shifts, repeated and missing ids."""

from pyspark.sql import functions as F

from themelake.llm import warc_fixity as W

SCHEMA = "page_id long, url string, html string, file string, digest int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 0) for i, u, h in rows], SCHEMA)


def some(n):
    return [(i, f"http://h/{i}", "x" * (i * 37 % 500) + str(i)) for i in range(n)]


def records(df):
    return df.select("file", "offset", "length", "digest")


def found(df):
    return sorted((r.file, r.offset, r.status) for r in df.collect())


def test_clean_replicas_cost_no_row(spark):
    a = records(W.located(pages(spark, some(300)), 100))
    assert W.audit(a, a.repartition(5)).count() == 0
    assert W.audit(a.limit(0), a.limit(0)).count() == 0


def test_rot_and_losses_in_their_place(spark):
    rows = some(2500)
    located = W.located(pages(spark, rows), 1000, copy=F.when(F.col("page_id") % 700 == 9, F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    second = located.where("page_id % 900 <> 5").select("file", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    by_place = {r.page_id: (r.file, r.offset) for r in located.collect()}
    expected = sorted([(*by_place[i], "changed") for i in range(2500) if i % 700 == 9] + [(*by_place[i], "missing") for i in range(2500) if i % 900 == 5])
    assert found(W.audit(records(located), second, range_bytes=4096, fanout=4)) == expected
    assert found(W.audit(second, records(located), range_bytes=4096, fanout=4)) == [(f, o, {"missing": "extra"}.get(s, s)) for f, o, s in expected]


def test_a_shift_marks_the_rest_of_its_file_only(spark):
    rows = some(300)
    shorter = [(i, u, h[:-1] if i == 150 else h) for i, u, h in rows]
    a, b = (records(W.located(pages(spark, r), 100)) for r in (rows, shorter))
    got = W.audit(a, b)
    assert {r.file for r in got.collect()} == {1}
    first = a.where("file = 1").orderBy("offset").collect()[50]
    assert got.where(F.col("offset") < first.offset).count() == 0
    status = {r.offset: r.status for r in got.collect()}
    assert status[first.offset] == "changed" and {"missing", "extra"} <= set(status.values())


def test_repeated_and_missing_ids_nulls_and_long_pages(spark):
    rows = [(1, "u", "same")] * 40 + [(1, "u", "other"), (2, None, None), (None, "u", "no id"), (3, "u", "long " * 200_000)]
    located = W.located(pages(spark, rows), 1000, copy=W.rotten("html"))
    assert located.count() == 43 and located.select("offset").distinct().count() == 43
    second = located.select("file", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest"))
    changed = found(W.audit(records(located), second))
    assert [s for _, _, s in changed] == ["changed"]  # page 3 alone, none of the repeated ones


def test_several_records_at_one_place_and_a_lost_file(spark):
    schema = "file long, offset long, length long, digest string"
    a = spark.createDataFrame([(1, 0, 5, "x"), (1, 0, 7, "y"), (1, 9, 1, "z"), (2, 0, 1, "w"), (None, 0, 1, "n"), (1, None, 1, "n")], schema)
    b = spark.createDataFrame([(1, 0, 7, "y"), (1, 0, 5, "x"), (1, 9, 1, "Z")], schema)
    got = W.audit(a, b).collect()
    assert sorted((r.file, r.offset, r.status, r.digest_a, r.digest_b) for r in got) == [(1, 9, "changed", "z", "Z"), (2, 0, "missing", "w", None)]
    assert all(r.root_a != r.root_b for r in got)
