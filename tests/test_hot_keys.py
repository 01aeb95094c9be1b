"""One key holds a third of all rows, with and without broadcasts."""

import pytest
from pyspark.sql import functions as F

from themelake.operators import collapse, latest_n, lookup, restrict, unmatched, upsert

N = 30000


@pytest.fixture(params=["10m", "-1"])
def hot(spark, request):
    """Keys k0 (a third), null (a tenth), the rest spread."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    i = F.col("id")
    yield spark.range(0, N, 1, 8).select(
        F.when(i % 3 == 0, F.lit("k0")).when(i % 10 != 1, F.concat(F.lit("k"), i % 500)).alias("k"),
        (i % 101).cast("double").alias("v"), i.alias("i"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def expected_keys():
    return ["k0" if i % 3 == 0 else f"k{i % 500}" if i % 10 != 1 else None for i in range(N)]


def test_lookup_keeps_every_row(spark, hot):
    dim = spark.range(0, 500, 2).select(F.concat(F.lit("K"), "id").alias("k"), F.col("id").cast("string").alias("name"))
    got = lookup(hot, dim, "k", "name", "none").groupBy("name").count().collect()
    counts = {r["name"]: r["count"] for r in got}
    keys = expected_keys()
    known = [k for k in keys if k and int(k[1:]) % 2 == 0]
    assert sum(counts.values()) == N and counts["none"] == N - len(known) and counts["0"] == keys.count("k0")
    assert unmatched(hot, dim, "k").count() == N - len(known)


def test_restrict_with_repeated_keys(hot):
    keys = hot.where("k = 'k0' OR k = 'k1'").select("k")
    assert restrict(hot, keys, ["k"]).count() == sum(k in ("k0", "k1") for k in expected_keys())


def test_upsert_with_a_hot_update(spark, hot):
    base = spark.range(0, 1000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(-1.0).alias("v"))
    updates = hot.where("k IS NOT NULL").select("k", "v", F.when(F.col("i") != 0, F.col("i")).alias("i"))
    got = {r["k"]: r["v"] for r in upsert(base, updates, ["k"], "i").collect()}
    last = {}
    for i, k in enumerate(expected_keys()):
        if k:
            last[k] = float(i % 101)
    assert got == {**{f"k{i}": -1.0 for i in range(1000)}, **last}


def test_collapse_and_latest(hot):
    row = collapse(hot.withColumn("label", F.concat(F.lit("l"), "i")), ["k"], "label", "i").where("k = 'k0'").first()
    of_k0 = [i for i, k in enumerate(expected_keys()) if k == "k0"]
    assert row["label"] == "l0" and abs(row["v"] - sum(i % 101 for i in of_k0) / len(of_k0)) < 1e-9
    for n in (3, 1200):
        got = sorted(r["i"] for r in latest_n(hot.where("k IS NOT NULL"), ["k"], "i", n).where("k = 'k0'").collect())
        assert got == of_k0[-n:]
