"""Forms of plans that hold at any size: one scan, one shuffle, hot keys spread, runs that go on."""

import json
import random
from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from themelake.fixed_values import WEATHER_VALUES
from themelake.operators import latest_n, month_spine, upsert
from themelake.plans.jobs import catalogue_run, night_light_blocks, night_light_history, pending_blocks, weather_repair, zone_blocks
from themelake.sources import (
    CATALOGUE_ITEM, cube_out_of_range, decode_cube, decode_documents, read_csv, read_csv_set,
)
from themelake.sources.cube import split_cube

ORDER = ("time", "geo")


# --- last N periods

def brute_latest(data, n):
    out = []
    for s in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, -r[2]), reverse=True)
        out += mine[:n]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 60, 5000])
def test_latest_n_with_ties_missing_periods_and_a_hot_series(spark, n):
    rng = random.Random(n)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(9)]), i) for i in range(900)]
    df = spark.createDataFrame(data, "s string, y int, i int")
    got = latest_n(df, ["s"], "y", n, ["i"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_latest(data, n)
    assert rows(latest_n(df.repartition(9), ["s"], "y", n)) == rows(got)  # all other columns break ties


def test_latest_n_ranks_rows_of_one_period_only(spark, plan):
    df = spark.range(10).select(F.lit("s").alias("s"), (F.col("id") % 3).alias("y"), "id")
    deep, flat = plan(latest_n(df, ["s"], "y", 5000)), plan(latest_n(df, ["s"], "y", 2))
    assert deep.count("Window [") == flat.count("Window [") and "_part" not in deep
    assert "partial_count" in deep


# --- upsert

def test_upsert_reads_and_shuffles_either_side_once(spark, plan, tmp_path):
    for name in ("base", "batch"):
        spark.range(100).select(F.col("id").alias("k"), F.lit(name).alias("s"), F.lit(1).alias("n")).write.parquet(str(tmp_path / name))
    base, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("base", "batch"))
    text = plan(upsert(base.drop("n"), batch, ["k"], "n"))
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2


def test_upsert_keeps_rows_without_a_key(spark):
    base = spark.createDataFrame([(None, "a"), (1, "b")], "k int, s string")
    updates = spark.createDataFrame([(1, None, 1), (2, "c", 1)], "k int, s string, n int")
    assert rows(upsert(base, updates, ["k"], "n")) == sorted([(None, "a"), (1, None), (2, "c")], key=repr)


# --- cubes

def cube(geo, time, values):
    return json.dumps({"dimension": {"geo": {"category": {"label": geo}}, "time": {"category": {"label": time}}}, "value": values})


def test_cubes_decoded_inside_the_row(spark, plan, tmp_path):
    geo = {f"Z{9 - i}": f"n{i}" for i in range(10)}
    docs = [("a", cube(geo, {"2021": "b", "2020": "a"}, {"0": 1, "12": 2, "20": 3, "5": None, "7": ":"})), ("b", cube({"ES2": "y", "ES3": "z"}, {"2019": "t"}, {"1": 2.5})),
            ("none", cube({}, {}, {})), ("empty", "{}"), ("null", None)]
    spark.createDataFrame(docs, "doc string, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    cells, dims = split_cube(docs, ORDER)
    assert rows(decode_documents(docs, ORDER)) == rows(decode_cube(cells, dims, ORDER)) and cube_out_of_range(cells).count() == 1
    text = plan(decode_documents(docs, ORDER))
    assert text.count("FileScan") == 1 and "Join" not in text and "Exchange" not in text
    with pytest.raises(Exception, match="past the axes: 20"):
        decode_documents(docs, ORDER, strict=True).collect()


# --- CSV

def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.csv").write_bytes(content.encode())
    return str(folder)


FILES = {
    "p_1": 'a,b,"c, d"\r\n1,"x ""y"", z",3\r\n2,"line\nbreak\r\nagain",\r\n', "p_2": '﻿"c, d",a\n7,8\n\n9,NaN\n', "p_3": "b,extra\nñ,1\n,2", "p_4": "a,b\n", "p_5": "",
    "other": "a\n100\n",
}


def test_csv_set_with_quotes_breaks_and_odd_files(spark, tmp_path):
    found = read_csv_set(spark, put(tmp_path, **FILES), "p_", "b string, `c, d` int, a int, missing string")
    assert found.columns == ["b", "c, d", "a", "missing"]
    assert rows(found) == sorted([
        ('x "y", z', 3, 1, None), ("line\nbreak\r\nagain", None, 2, None), (None, 7, 8, None), (None, 9, None, None), ("ñ", None, None, None), (None, None, None, None),
    ], key=repr)
    by_name = read_csv_set(spark, str(tmp_path), "p_")
    assert dict(by_name.dtypes) == {"a": "bigint", "b": "string", "c, d": "bigint", "extra": "bigint"}


def test_csv_set_by_lines(spark, tmp_path):
    files = {k: v for k, v in FILES.items() if k != "p_1"} | {"p_6": "a,b\r\n" + "".join(f"{i},t{i}\r\n" for i in range(20000)) + "a,b\r\n"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = read_csv_set(spark, put(tmp_path, **files), "p_", "a string, b string", multi_line=False)
        assert found.where("b LIKE 't%'").count() == 20000 and found.where("a = '19999' AND b = 't19999'").count() == 1
        assert found.where("a = 'a' AND b = 'b'").count() == 1  # a row that looks like the header is one
        assert found.where("b = 'ñ' OR a = '8'").count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_thousand_files_in_one_job(spark, tmp_path, plan):
    put(tmp_path, **{f"p_{i}": f"{'a,b' if i % 2 else 'b,a'}\n{i},{-i}\n" for i in range(1000)})
    found = read_csv_set(spark, str(tmp_path), "p_", "a int, b int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("set", "set")
    try:
        sums = found.agg(F.sum("a"), F.sum("b"), F.count("*")).collect()[0]
        assert tuple(sums) == (500, -500, 1000) and len(tracker.getJobIdsForGroup("set")) <= 2  # map and result stage
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan(found).count("FileScan") == 1


def test_csv_set_of_a_large_file_is_split(spark, tmp_path):
    large = "a,b\r\n" + "".join(f'{i},"t{i}, ""{i % 7}"""\r\n\r\n' for i in range(80000)) + "a,b\r\na,b\r\n"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = read_csv_set(spark, put(tmp_path, p_1=large, p_2="b,c,a\nx,y,7\n", p_3="a\n"), "p_", "b string, a string, missing int")
        assert found.rdd.getNumPartitions() > 10  # a file was one task, and one array of all its records
        assert found.where("b = concat('t', a, ', \"', try_cast(a AS int) % 7, '\"') AND missing IS NULL").count() == 80000
        assert rows(found.where("b NOT LIKE 't%'")) == [("b", "a", None), ("b", "a", None), ("x", "7", None)]
        by_name = read_csv_set(spark, str(tmp_path), "p_")
        assert by_name.dtypes == [("a", "string"), ("b", "string"), ("c", "string")] and by_name.count() == 80003
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_set_of_large_files_with_breaks_in_cells(spark, tmp_path):
    cell = "line\nbreak\r\nand\rthat, "
    files = FILES | {
        "p_6": 'a,"b\nc"\r\n' + "".join(f'{i},"{cell}{i}"\r\n' if i % 3 else f"{i},plain\r" for i in range(200)) + '"' + "long\n" * 1000 + '",x',  # over some blocks
        "p_7": '\n\n"a",b\n1,"x\ny"\n\n2,"open\n3,z "q\n4,"u\n5,w\n',  # a quote too many
        "p_8": "a,b\na,b\n1,2\na,b\n", "p_9": '\ufeff"a"\n"\ufeff\n"\n', "p_10": "\n\r\n",
    }
    schema = "a string, b string, `c, d` string, `b\nc` string, extra string"
    path = put(tmp_path, **files)
    expected, inferred = rows(read_csv_set(spark, path, "p_", schema)), read_csv_set(spark, path, "p_")
    assert {("2", "open\n3,z "), ("4", None), ("u", None), ("5", "w")} <= {r[:2] for r in expected}
    assert len(expected) == 216 and sum(r[3] == f"{cell}{r[0]}" for r in expected) == 133
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert rows(read_csv_set(spark, path, "p_", schema, whole_bytes=0)) == expected
        split = read_csv_set(spark, path, "p_", whole_bytes=0, broadcast_bytes=0)
        assert split.dtypes == inferred.dtypes and rows(split) == rows(inferred)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_without_open_quotes_is_split(spark, tmp_path):
    path = put(tmp_path / "plain", t="a,b\n" + "".join(f'{i},"q{i}"\n' for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        assert read_csv(spark, path, "a int, b string").rdd.getNumPartitions() > 3
        broken = put(tmp_path / "broken", t='a,b\n1,"x\ny"\n')
        assert rows(read_csv(spark, broken, "a int, b string")) == [(1, "x\ny")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- weather

def test_repair_touches_the_last_days_only(spark, plan, tmp_path):
    today, schema = date(2024, 3, 10), "date date, tmax double, tmin double, precipitation_sum double, weather_code int"
    days = [(today - timedelta(days=d), float(d), None if d == 3 else 1.0, 0.0, 1) for d in range(0, 40) if d != 5]
    spark.createDataFrame(days, schema).write.partitionBy("date").parquet(str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store")).select("date", *WEATHER_VALUES)
    start = 1709856000 - 20 * 86400  # 2024-02-17 00:00 UTC
    fetched = spark.createDataFrame([(start, start + 30 * 86400, 86400, [5.0] * 30, [4.0] * 30, [3.0] * 30, [2.0] * 30, 1)],
                                    "start long, end long, interval long, tmax array<double>, tmin array<double>, precipitation_sum array<double>, weather_code array<double>, n int")
    repaired = lambda: weather_repair(store, fetched, spark.range(1).select(F.lit(1).alias("_")), today, [], "n", zone="UTC")
    new, whole = repaired()
    assert sorted(r.date for r in new.collect()) == [today - timedelta(days=5), today - timedelta(days=3)]
    got = {r.date: r.tmin for r in whole.collect()}
    assert len(got) == 40 and got[today - timedelta(days=5)] == 4.0 and got[today - timedelta(days=3)] == 4.0 and got[today] == 1.0
    text = plan(repaired()[1])
    assert text.count("FileScan") <= 4 and text.count("PartitionFilters: [isnotnull(date") >= 1


# --- night lights by block

def boxes(spark, n):
    return spark.createDataFrame(
        [(f"z{i}", [[(float(i), 0.0), (i + 1.0, 0.0), (i + 1.0, 1.0), (float(i), 1.0)]], f"n{i}") for i in range(n)],
        "zone_id string, rings array<array<struct<x:double,y:double>>>, LAU_NAME string",
    )


def test_blocks_resume_where_a_run_has_died(spark, tmp_path, monkeypatch):
    pixels = spark.range(400).select((F.col("id") % 20 + 0.5).alias("lon"), F.lit(0.5).alias("lat"), F.lit(date(2018, 1, 5)).alias("date"), F.col("id").cast("double").alias("avg_rad"))
    spine, zones, path = month_spine(2018, 2018), boxes(spark, 20), str(tmp_path / "h")
    expected = rows(night_light_history(pixels, zones, spine, cell=0.5))
    from themelake.plans import jobs

    made, history = [], jobs.night_light_history

    def dies(*a, **k):
        made.append(1)
        if len(made) == 3:
            raise RuntimeError("driver gone")
        return history(*a, **k)

    monkeypatch.setattr(jobs, "night_light_history", dies)
    run = lambda z, p=pixels: night_light_blocks(spark, p, z, spine, path, blocks=5, at_once=1, cell=0.5)
    with pytest.raises(RuntimeError):
        run(zones)
    landed = spark.read.parquet(f"{path}/landed")
    assert landed.count() == 2 and pending_blocks(zone_blocks(zones, 5), landed).count() == 3
    columns = ["zone_id", "date", "mean", "min", "max", "stdDev", "LAU_NAME"]
    assert sorted(rows(run(zones).select(*columns))) == sorted(rows(history(pixels, zones, spine, cell=0.5).select(*columns))) and len(made) == 6
    assert len(expected) == 240
    unread = pixels.withColumn("avg_rad", F.raise_error(F.lit("pixels are read")).cast("double"))
    assert run(zones, unread).count() == 240 and len(made) == 6  # computes nothing
    more = run(boxes(spark, 21))  # one block has another zone
    assert more.count() == 252 and len(made) == 7 and more.where("zone_id = 'z20'").count() == 12
    assert night_light_blocks(spark, pixels, zones.limit(0), spine, str(tmp_path / "none")).count() == 0


# --- counts while writing

def test_counts_come_from_the_write(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(CATALOGUE_ITEM)
    items = [
        tuple({"Id": f"p{i}", "Name": "S2A_MSIL2A", "collection": "SENTINEL-2" if i % 2 else "SENTINEL-1", "ContentDate": (f"2024-01-{i % 28 + 1:02d}T00:00:00Z", None)}.get(n)
              for n in schema.names) for i in range(100)
    ]
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(items, schema)
    (row,) = catalogue_run(spark, df, "sentinel2", "SENTINEL-2", date(2024, 1, 1), date(2024, 1, 14), str(tmp_path), "s2", top=2, max_pages=5).collect()
    matched = df.where("collection = 'SENTINEL-2' AND substring(ContentDate.Start, 9, 2) <= '14'").count()
    assert (row.total, row.returned) == (matched, 10) and spark.read.parquet(row.path).count() == 10 and seen.value == 0
    (all_,) = catalogue_run(spark, df, "sentinel2", "SENTINEL-2", date(2024, 1, 1), date(2024, 1, 14), str(tmp_path), "s2").collect()
    assert (all_.total, all_.returned) == (matched, matched)
    (none,) = catalogue_run(spark, df, "sentinel2", "SENTINEL-2", date(2030, 1, 1), date(2030, 1, 2), str(tmp_path), "s2", top=3).collect()
    assert (none.total, none.returned) == (0, 0)
