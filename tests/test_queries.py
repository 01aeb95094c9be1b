"""Every registered query gives the rows of its SQL."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry
from themelake.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["municipio", "year", "vistas", "clics", "compras", "provincia"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_slow_path(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_asset_run_is_registered_whole(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 4 <> 0").count()
    statuses = QUERIES["asset_run_statuses_all"](spark, SF)
    assert orders > 200 and statuses.count() == orders
    assert QUERIES["asset_run_assets_all"](spark, SF).count() == sum(r.assets for r in statuses.collect())
    assert sum(r.products for r in QUERIES["run_outcomes_all"](spark, SF).collect()) == orders
