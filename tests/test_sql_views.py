"""The questions asked as SQL text over registered views give the DataFrame answers."""

from emporia.operators import reports as Q
from emporia.plans.batch_job import register_views
from emporia.plans.tables import from_testdata
from tests.conftest import SF_SMALL, rows


def test_sql_over_views_matches_dataframe(spark):
    t = from_testdata(spark, SF_SMALL)
    register_views(t)
    sql = """
        SELECT customer_state,
               COUNT(DISTINCT order_id) AS orders,
               COUNT(DISTINCT customer_unique_id) AS customers,
               CAST(ROUND(SUM(total_order_value), 2) AS DOUBLE) AS revenue,
               CAST(ROUND(CAST(CAST(SUM(total_order_value) AS DOUBLE) / COUNT(total_order_value)
                               AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_order_value
        FROM master_featured WHERE order_status = 'delivered'
        GROUP BY customer_state ORDER BY revenue DESC, customer_state LIMIT 10"""
    assert rows(spark.sql(sql)) == rows(Q.q03_revenue_by_state(t.master_featured))
    seg = spark.sql("SELECT customer_segment, COUNT(*) AS n FROM rfm_olist GROUP BY customer_segment")
    assert sum(r.n for r in seg.collect()) == t.rfm_olist.count()


def test_batch_job_writes_tables_and_exports(spark, tmp_path):
    from emporia.plans.batch_job import run
    t = from_testdata(spark, SF_SMALL)
    manifest = {r.export: r.files for r in run(t, str(tmp_path)).collect()}
    assert {"master_featured.parquet", "summary_state", "rfm_olist_csv"} <= set(manifest)
    back = spark.read.parquet(str(tmp_path / "tables" / "master_featured"))
    assert back.count() == t.master_featured.count()


def test_views_with_original_orientation(spark):
    t = from_testdata(spark, SF_SMALL)
    register_views(t, orientation="as_coded")
    champions = spark.sql("SELECT COUNT(*) AS n FROM rfm_olist WHERE customer_segment = 'Champions'").first().n
    expect = t.rfm_olist_as_coded.filter("customer_segment = 'Champions'").count()
    assert champions == expect
    register_views(t)
