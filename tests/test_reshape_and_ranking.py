from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from themelake.operators import (
    asset_patterns, collapse, count_distinct, counts, distinct_sorted, expand_daily, latest_n, month_spine, outcomes,
    page, pivot_mean, select_assets, stack, trailing_days, window_bounds,
)


def lights(spark):
    return spark.createDataFrame(
        [
            ("A", "2018-01", 1.0, 10, 1), ("A", "2018-01", 3.0, None, 2), (None, "2018-01", None, 30, 0),
            ("B", "2018-01", 5.0, 20, 3), ("B", "2018-02", None, 1, 4), ("C", None, 7.0, 1, 5), (None, "2018-03", 2.0, 1, 6),
        ],
        "municipio string, date string, mean double, n int, i int",
    )


def test_collapse_by_municipality_and_by_date(spark):
    assert rows(collapse(lights(spark), ["municipio", "date"], "municipio", "i")) == [
        ("A", "2018-01", 2.0, 10.0), ("B", "2018-01", 5.0, 20.0), ("B", "2018-02", None, 1.0),
    ]
    assert rows(collapse(lights(spark), ["date"], "municipio", "i")) == [
        ("2018-01", 3.0, 20.0, "A"), ("2018-02", None, 1.0, "B"), ("2018-03", 2.0, 1.0, None),
    ]


@pytest.mark.parametrize("parts", [1, 64])
def test_results_do_not_hang_on_partitions(spark, parts):
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("k"), F.concat(F.lit("n"), F.col("id") % 13).alias("label"),
        (F.col("id") * 37 % 101).cast("double").alias("v"), F.col("id").alias("i"),
    ).repartition(parts)
    got = {r["k"]: (r["label"], r["v"]) for r in collapse(df, ["k"], "label", "i").collect()}
    assert got[3][0] == "n3" and len(got) == 7
    last = latest_n(df, ["k"], "i", 2)
    assert rows(last.where("k = 0"), "i") == [(2989,), (2996,)]


def test_collapse_sorts_no_rows(spark, plan):
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.lit(1.0).alias("v"), F.col("id").alias("i"))
    text = plan(collapse(df, ["k"], "s", "i"))
    lowest = text[text.rindex("HashAggregate"):]
    assert "Sort" not in lowest and "partial_sum" in lowest


def test_pivot_mean(spark):
    df = spark.createDataFrame(
        [("A", 1, "Total", 1.0), ("A", 1, "Total", 3.0), ("A", 1, "Hombres", 2.0), ("B", 1, "x", 9.0), ("B", 1, None, 9.0),
         ("C", 1, "Total", None), (None, 1, "Total", 5.0)],
        "m string, y int, c string, v double",
    )
    got = pivot_mean(df, ["m", "y"], "c", "v", ["Total", "Hombres"], {"Total": "total"})
    assert got.columns == ["m", "y", "total", "Hombres"] and rows(got) == [("A", 1, 2.0, 2.0)]


def test_pivot_takes_one_shuffle(spark, plan):
    df = spark.range(10).select((F.col("id") % 3).alias("m"), F.lit("a").alias("c"), F.lit(1.0).alias("v"))
    assert plan(pivot_mean(df, ["m"], "c", "v", ["a", "b"], {})).count("Exchange") == 1


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    assert rows(count_distinct(df, "s")) == rows(count_distinct(df, "s", approximate=True)) == [(2,)]
    assert rows(counts(df, top=1, max_pages=3)) == [(4, 3)] and rows(counts(df)) == [(4, 4)]
    assert [r[0] for r in distinct_sorted(df, "s").collect()] == ["a", "b"]
    assert rows(counts(df.limit(0), top=5)) == [(0, 0)]


def test_stack_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(stack([a, b, a])) == [(1, "x", None), (1, "x", None), (None, "y", 2.0)]


def test_latest_n(spark, plan):
    df = spark.createDataFrame([("a", y) for y in range(5)] + [("b", 1)], "s string, y int")
    assert rows(latest_n(df, ["s"], "y", 2)) == [("a", 3), ("a", 4), ("b", 1)]
    assert latest_n(df, ["s"], "y", None).count() == 6
    assert "WindowGroupLimit" in plan(latest_n(df, ["s"], "y", 2))


def test_latest_n_beyond_the_group_limit(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("s"), F.col("id").alias("y"))
    got = latest_n(df, ["s"], "y", 2500).where("s = 'hot'").agg(F.count("*"), F.min("y"), F.max("y")).first()
    assert tuple(got) == (2500, 19998 - 2499 * 3, 19998)


def test_page(spark, plan):
    df = spark.range(100).select("id", (F.col("id") % 10).alias("d"))
    got = [r["id"] for r in page(df, [F.desc("d"), F.asc("id")], top=3, max_pages=2, skip=8).collect()]
    assert got == [89, 99, 8, 18, 28, 38]
    assert "TakeOrderedAndProject" in plan(page(df, [F.desc("d"), F.asc("id")], top=3))


def test_spines(spark):
    months = [r[0] for r in spark.range(1).select(F.explode(month_spine(2018, 2019))).collect()]
    assert len(months) == 24 and months[0] == date(2018, 1, 1) and months[-1] == date(2019, 12, 1)
    days = [r[0] for r in spark.range(1).select(F.explode(trailing_days(date(2024, 3, 3)))).collect()]
    assert days == [date(2024, 2, d) for d in range(25, 30)] + [date(2024, 3, 1), date(2024, 3, 2)]
    assert window_bounds(date(2024, 3, 3), 7) == ("2024-03-03", "2024-02-25")


def test_daily_expansion_cuts_at_the_shortest(spark):
    df = spark.createDataFrame([(1704063600, 1704063600 + 4 * 86400, 86400, [1.0, 2.0, 3.0, 4.0], [5.0, 6.0, None])],
                               "start bigint, end bigint, interval bigint, a array<double>, b array<double>")
    got = expand_daily(df, ["a", "b"], "Europe/Madrid")
    assert rows(got) == [(date(2024, 1, 1), 1.0, 5.0), (date(2024, 1, 2), 2.0, 6.0), (date(2024, 1, 3), 3.0, None)]
    assert expand_daily(df.withColumn("end", F.col("start")), ["a", "b"], "Europe/Madrid").count() == 0


def test_daily_expansion_over_the_autumn_change(spark):
    df = spark.createDataFrame([(1729893600, 1729893600 + 4 * 86400, 86400, [1.0, 2.0, 3.0, 4.0])],
                               "start bigint, end bigint, interval bigint, a array<double>")
    assert [r[0].day for r in expand_daily(df, ["a"], "Europe/Madrid").collect()] == [26, 27, 28, 29]


MEMBERS = [
    "a/IMG_DATA/x/y/R10m/q/TCI.jp2", "a/IMG_DATA/R20m/T_SCL_20m.jp2", "a/IMG_DATA_R10m/T_B04.jp2", "a/b_tci.jp2", "TCI.jp2",
    "a/TCIxjp2", "x/manifest.safe", "xmanifestZsafe", "m/measurement/iw.tiff", "preview/q.png", "a/IMG_DATA/R10m/B04_10m.jp2\n",
]


def chosen(spark, *args):
    members = spark.createDataFrame([("p", m) for m in MEMBERS] * 2, "product_id string, member string")
    return {r["member"] for r in select_assets(members, asset_patterns(*args)).collect()}


def test_assets_by_mode(spark):
    assert chosen(spark, "TCI") == {MEMBERS[0]}
    assert chosen(spark, "scl") == {MEMBERS[1]}
    assert chosen(spark, "bands", [" b04 "]) == {MEMBERS[2]}
    assert chosen(spark, "all") == {MEMBERS[0], MEMBERS[1], MEMBERS[2], MEMBERS[6]}
    assert chosen(spark, "tci", None, "SENTINEL-1") == {MEMBERS[6], MEMBERS[8], MEMBERS[9]}
    assert chosen(spark, "bands", []) == chosen(spark, "other") == set()


def test_assets_match_like_a_glob(spark):
    from fnmatch import fnmatchcase
    from itertools import product

    paths = ["".join(p) for n in range(1, 5) for p in product(["IMG_DATA", "/", "TCI", ".jp2", "R10m", "é\n"], repeat=n)]
    globs = asset_patterns("tci") + asset_patterns("all")
    expected = {p for p in paths if any(fnmatchcase(p, g) for g in globs)}
    members = spark.createDataFrame([(p,) for p in paths], "member string")
    assert {r[0] for r in select_assets(members, globs).collect()} == expected and expected


def test_outcomes(spark):
    df = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("c", "no-id")], "identifier string, status string")
    assert rows(outcomes(df)) == [("no-id", 1), ("ok", 2)]


def test_hourly_axis_has_the_day_of_each_instant(spark):
    start = 1704063600 + 23 * 3600  # 23:00 in Madrid
    values = [1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([(start, start + 4 * 3600, 3600, values)], "start long, end long, interval long, a array<double>")
    assert [(r["date"].day, r["a"]) for r in expand_daily(df, ["a"], "Europe/Madrid").collect()] == [(1, 1.0), (2, 2.0), (2, 3.0), (2, 4.0)]


def test_nan_is_a_missing_number(spark):
    nan = float("nan")
    df = spark.createDataFrame([("k", "l", 1.0, 1), ("k", "l", nan, 2), ("k", "m", 3.0, 3)], "k string, label string, v double, i int")
    assert rows(collapse(df, ["k"], "label", "i").select("v")) == [(2.0,)]
    assert rows(pivot_mean(df, ["k"], "label", "v", ["l", "m"], {})) == [("k", 1.0, 3.0)]
