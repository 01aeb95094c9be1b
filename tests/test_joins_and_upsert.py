from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from themelake.fixed_values import WEATHER_VALUES
from themelake.operators import join, lookup, needs_refresh, restrict, trailing_days, unmatched, upsert
from themelake.plans.jobs import province_table
from themelake.sinks import ensure_table, merged_partitions, publish, read_table, save_theme, save_theme_json, upsert_table
from themelake.sources import read_csv


def test_lookup_normalises_both_sides(spark):
    df = spark.createDataFrame([(" ABÁRZUZA ",), ("Ababuj",), ("otra",), (None,)], "municipio string")
    got = lookup(df, province_table(spark), "municipio", "provincia", "Desconocida")
    assert rows(got) == [(" ABÁRZUZA ", "Navarra"), ("Ababuj", "Teruel"), ("otra", "Desconocida"), (None, "Desconocida")]


def test_lookup_never_adds_rows(spark):
    dim = spark.createDataFrame([("Á", "x"), ("a", "b"), (None, "n")], "k string, v string")
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(lookup(df, dim, "k", "v", "?")) == [("a", "b"), (None, "?")]


def test_unmatched_is_the_rest(spark):
    df = spark.createDataFrame([("Á",), ("b",), (None,)], "k string")
    assert rows(unmatched(df, spark.createDataFrame([("a",)], "k string"), "k")) == [("b",), (None,)]


def test_left_join_and_restrict(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    assert rows(join(left, right, ["k"])) == [(1, "a", "x"), (1, "a", "y"), (2, "b", None)]
    assert rows(restrict(left, right, ["k"])) == [(1, "a")]


def test_needs_refresh(spark):
    store = spark.createDataFrame(
        [(date(2024, 1, 1), 1.0, 0.0, 0.0, 1), (date(2024, 1, 2), 1.0, None, 0.0, 1), (date(2024, 1, 3), 1.0, float("nan"), 0.0, 1)],
        "date date, tmax double, tmin double, precipitation_sum double, weather_code int",
    )
    targets = spark.range(1).select(F.explode(trailing_days(date(2024, 1, 5), 4)).alias("date"))
    got = [r[0].day for r in rows(needs_refresh(targets, store, ["date"], WEATHER_VALUES))]
    assert got == [2, 3, 4]
    assert needs_refresh(targets.limit(0), store, ["date"], WEATHER_VALUES).count() == 0


def test_upsert_last_wins(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    updates = spark.createDataFrame([(2, "x", None, 2), (2, "y", 9.0, 1), (3, "z", 3.0, 1)], "k int, s string, v double, n int")
    assert rows(upsert(base, updates, ["k"], "n")) == [(1, "a", 1.0), (2, "x", None), (3, "z", 3.0)]
    assert rows(upsert(base, updates.limit(0), ["k"], "n")) == rows(base)


SCHEMA = "day date, v double, month string"


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(*items):
        return spark.createDataFrame(
            [(d, v, d.strftime("%Y-%m"), i) for i, (d, v) in enumerate(items)], SCHEMA + ", n int"
        )

    def put(*items):
        upsert_table(spark, path, SCHEMA, batch(*items), ["day", "month"], "n", "month")

    assert ensure_table(spark, path, SCHEMA, "month").count() == 0
    put((date(2024, 1, 1), 1.0), (date(2024, 2, 1), 2.0), (date(2024, 2, 2), None))
    january = sorted((tmp_path / "t" / "month=2024-01").iterdir())
    assert january
    put((date(2024, 2, 2), 5.0), (date(2024, 2, 2), 6.0), (date(2024, 3, 1), 3.0))
    expected = [
        (date(2024, 1, 1), 1.0, "2024-01"), (date(2024, 2, 1), 2.0, "2024-02"), (date(2024, 2, 2), 6.0, "2024-02"),
        (date(2024, 3, 1), 3.0, "2024-03"),
    ]
    assert rows(read_table(spark, path, SCHEMA)) == expected
    assert sorted((tmp_path / "t" / "month=2024-01").iterdir()) == january  # not rewritten
    put()
    ensure_table(spark, path, SCHEMA, "month")
    assert rows(read_table(spark, path, SCHEMA)) == expected


def test_an_upsert_opens_the_partitions_of_its_batch_only(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    rows_ = [(date(2024, m, 1), float(m), f"2024-{m:02d}", 0) for m in range(1, 10)]
    ensure_table(spark, path, SCHEMA, "month")
    upsert_table(spark, path, SCHEMA, spark.createDataFrame(rows_, SCHEMA + ", n int"), ["day", "month"], "n", "month")
    batch = spark.createDataFrame(rows_[3:5], SCHEMA + ", n int")
    merged = merged_partitions(read_table(spark, path, SCHEMA), batch, ["day", "month"], "n", "month")
    assert merged.count() == 2
    stored = read_table(spark, path, SCHEMA)
    assert merged_partitions(stored, batch.limit(0), ["day", "month"], "n", "month").count() == 0


def test_keys_are_checked(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_table(spark, path, SCHEMA, "month")
    put = lambda row, keys: upsert_table(spark, path, SCHEMA, spark.createDataFrame([row], SCHEMA + ", n int"), keys, "n", "month")
    with pytest.raises(ValueError, match="one of the keys"):
        put((date(2024, 1, 1), 1.0, "2024-01", 1), ["day"])
    with pytest.raises(Exception, match="row without a whole key"):
        put((date(2024, 1, 1), 1.0, None, 1), ["day", "month"])
    assert read_table(spark, path, SCHEMA).count() == 0


def test_a_run_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    from themelake.sinks import keyed

    path = str(tmp_path / "t")
    ensure_table(spark, path, SCHEMA, "month")
    put = lambda v: upsert_table(
        spark, path, SCHEMA, spark.createDataFrame([(date(2024, 1, 1), v, "2024-01", 1)], SCHEMA + ", n int"), ["day", "month"], "n", "month"
    )
    put(1.0)
    landed = []

    def dies(df, *_):  # after the merge, before partitions are put in place
        landed.append(df)
        raise RuntimeError("driver gone")

    monkeypatch.setattr(keyed, "publish", dies)
    with pytest.raises(RuntimeError):
        put(2.0)
    monkeypatch.undo()
    assert rows(read_table(spark, path, SCHEMA)) == [(date(2024, 1, 1), 1.0, "2024-01")]
    for _ in range(2):  # finished from what is landed, or repeated
        publish(landed[0], path, "month")
        assert rows(read_table(spark, path, SCHEMA)) == [(date(2024, 1, 1), 2.0, "2024-01")]
    put(3.0)
    assert rows(read_table(spark, path, SCHEMA)) == [(date(2024, 1, 1), 3.0, "2024-01")]


def test_themed_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "b", ñ\\ ', {"k": 'q"ñ'})], "i int, s string, tags map<string,string>")
    path = save_theme(df, "transporte", "x.csv", str(tmp_path))
    assert path == f"{tmp_path}/transporte/x.csv"
    assert rows(read_csv(spark, path)) == [(1, ' a "b", ñ\\ ', '{"k":"q\\"ñ"}')]
    save_theme(df.limit(0), "transporte", "x.csv", str(tmp_path))
    assert spark.read.option("header", True).csv(path).count() == 0  # replaced
    text = spark.read.text(save_theme_json(df, "demografia", "x.json", str(tmp_path))).first()[0]
    assert '"tags":{"k":"q\\"ñ"}' in text
    assert save_theme(df, "satelital", "p", str(tmp_path), fmt="parquet").endswith("satelital/p")


def test_unknown_theme_or_format(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError, match="unknown theme"):
        save_theme(df, "otro", "x.csv", str(tmp_path))
    with pytest.raises(ValueError, match="unknown theme"):
        save_theme_json(df, "otro", "x.json", str(tmp_path))
    with pytest.raises(ValueError, match="unknown format"):
        save_theme(df, "satelital", "x", str(tmp_path), fmt="xls")
