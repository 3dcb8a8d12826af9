"""Plan checks: the physical plans are the ones we want at scale."""

from pyspark.sql import functions as F

from tidemark.plans.flow import Flow
from tidemark.plans import kpi as K

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    plan = _plan(Flow(spark, SF_SMALL).silver["orders"])
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_json_parsed_once_per_record(spark):
    plan = _plan(Flow(spark, SF_SMALL).silver["orders"])
    # one envelope parse and one image parse
    assert plan.count("from_json(") == 2


def test_silver_reads_only_its_topic(spark):
    plan = _plan(Flow(spark, SF_SMALL).silver["products"])
    assert "lineitem" not in plan and "orders.parquet" not in plan


def test_scan_is_pruned_and_filtered(spark):
    p = Flow(spark, SF_SMALL)
    df = p.tables.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_top_k_is_take_ordered(spark):
    p = Flow(spark, SF_SMALL)
    plan = _plan(K.kpi_top_customers(p.gold["sales_facts"]))
    assert "TakeOrderedAndProject" in plan


def test_audit_is_one_scan(spark):
    p = Flow(spark, SF_SMALL)
    plan = _plan(p.gold["cdc_audit"])
    # partial aggregation before the single shuffle of the audit
    assert plan.count("HashAggregate") >= 2
