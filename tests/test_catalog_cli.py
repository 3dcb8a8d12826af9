"""Catalog DDL path and the job command surface."""

from pyspark.sql import functions as F

from tidemark import cli
from tidemark.operators import silver as S
from tidemark.plans.flow import Flow
from tidemark.sources import catalog as C

from conftest import SF_SMALL


def test_catalog_tables(spark, scratch):
    p = Flow(spark, SF_SMALL)
    C.ensure_namespace(spark, "tm_bronze")
    C.ensure_namespace(spark, "tm_silver")
    # the test log is thin (a few events per day), so it is stored by table only
    ddl = C.bronze_ddl("tm_bronze.orders_cdc", f"{scratch}/b", partition_by=("cdc_table",))
    assert "PARTITIONED BY (cdc_table, event_day)" in C.bronze_ddl("x")
    C.ensure_table(spark, ddl)
    C.ensure_table(spark, ddl)  # idempotent
    C.ensure_table(spark, C.silver_ddl("orders", "tm_silver.orders", f"{scratch}/s"))
    assert C.table_exists(spark, "tm_bronze.orders_cdc")
    assert not C.table_exists(spark, "tm_bronze.nope")
    C.append(C.bronze_rows(p.bronze_of("orders")), "tm_bronze.orders_cdc")
    b = spark.table("tm_bronze.orders_cdc")
    assert b.count() == p.bronze_of("orders").count()
    s = S.state(b, "orders")
    C.append(C.silver_rows(s), "tm_silver.orders")
    assert spark.table("tm_silver.orders").filter(F.col("_is_deleted")).count() == \
        s.filter(F.col("_is_deleted")).count()
    spark.sql("DROP TABLE tm_bronze.orders_cdc")
    spark.sql("DROP TABLE tm_silver.orders")


def test_cli_layers(spark, scratch, capsys):
    p = Flow(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    p.records.write.parquet(landing)
    root = f"{scratch}/lake"
    cli.main(["bronze", "--source", landing, "--checkpoint", f"{scratch}/ckpt", "--root", root,
              "--available-now", "--partition-by", "cdc_table", "--topics", "cdc.public.orders,customers,order_items,products,"
              "payments,returns"], spark=spark)
    cli.main(["silver", "--root", root, "--incremental", "--checkpoint", f"{scratch}/silver"], spark=spark)
    cli.main(["gold", "--root", root], spark=spark)
    out = cli.main(["kpi", "--root", root, "--name", "kpi_cancellation_rate"], spark=spark)
    want = p.kpis["kpi_cancellation_rate"].collect()
    assert out["kpi_cancellation_rate"] == want
    cli.main(["sql", "--root", root, "--out", f"{scratch}/answer",
              "SELECT CAST(ROUND(100.0 * SUM(is_cancelled) / COUNT(*), 2) AS DOUBLE) AS rate FROM gold_orders"], spark=spark)
    assert spark.read.parquet(f"{scratch}/answer").first()[0] == want[0][0]
    cli.main(["sql", "--root", root, "--limit", "2", "SELECT order_id, status FROM gold_orders"], spark=spark)
    assert len(capsys.readouterr().out.strip().splitlines()) == 2
    # a full rebuild, by month of the change
    cli.main(["silver", "--root", root, "--by-month"], spark=spark)
    cli.main(["gold", "--root", root, "--table", "orders"], spark=spark)
    out = cli.main(["kpi", "--root", root, "--name", "kpi_cancellation_rate"], spark=spark)
    assert out["kpi_cancellation_rate"] == want


def test_merge_is_refused_by_parquet_tables(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException, UnsupportedOperationException

    spark.sql(f"CREATE TABLE IF NOT EXISTS tm_merge (order_id BIGINT, status STRING, "
              f"_cdc_ts TIMESTAMP) USING parquet LOCATION '{scratch}/m'")
    upd = spark.createDataFrame([(1, "x", None)], "order_id bigint, status string, _cdc_ts timestamp")
    for guarded in (False, True):  # the statement is resolved, then the table has no MERGE
        with pytest.raises((UnsupportedOperationException, AnalysisException), match="(?i)merge"):
            C.merge_into_table(upd, "tm_merge", ["order_id"], guarded=guarded, order=("_cdc_ts",))
    spark.sql("DROP TABLE tm_merge")
