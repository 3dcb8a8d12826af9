"""SQL consumers read the published views; a flow builds only what is asked for."""

from tidemark.plans import kpi as K
from tidemark.plans.flow import Flow

from conftest import SF_SMALL


def test_sql_over_published_views(spark):
    p = Flow(spark, SF_SMALL)
    K.publish_views(p.gold, p.kpis, ["orders", "kpi_cancellation_rate", "kpi_top_customers"])
    rate = spark.sql("SELECT round(100 * avg(is_cancelled), 2) FROM gold_orders").first()[0]
    assert abs(rate - spark.table("kpi_cancellation_rate").first()[0]) < 0.011
    assert spark.table("kpi_top_customers").count() == p.kpis["kpi_top_customers"].count()


def test_flow_is_lazy_by_name(spark):
    p = Flow(spark, SF_SMALL)
    p.kpis["kpi_cancellation_rate"]
    assert set(dict.keys(p.gold)) == {"orders"} and set(dict.keys(p.silver)) == {"orders", "customers"}
    assert "lineitem" not in p.tables._cache


def test_batch_runs_append(spark, scratch):
    from tidemark.plans import jobs
    from tidemark.sources.store import Store
    p = Flow(spark, SF_SMALL)
    records = p.records_of("products")
    store = Store(spark, scratch)
    first, _ = jobs.run_bronze(store, records)
    jobs.run_bronze(store, records)
    assert store.read("bronze").select("batch").distinct().count() == 2
    assert store.read("bronze").count() == 2 * first


def test_status_audit_findings(spark):
    import importlib.util
    import os
    spec = importlib.util.spec_from_file_location(
        "entry", os.path.join(os.path.dirname(__file__), "..", "__spark_entry__.py"))
    E = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(E)
    got = {(r["from_status"], r["to_status"]): (r["n_transitions"], r["is_legal"])
           for r in E.queries()["status_transition_audit"](spark, "/root/testdata/sf0.01").collect()}
    assert got[("pending", "delivered")] == (4933, False)
    assert got[("pending", "shipped")] == (1002, False)
    assert got[("pending", "confirmed")][1] is True
