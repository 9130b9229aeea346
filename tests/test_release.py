"""The export job deletes its saved tables after their last use; tables that a session shares stay."""

from pathlib import Path

import pytest

from emporia.plans import registry
from emporia.plans.session import ensure_checkpoint_dir
from emporia.plans.tables import CommerceTables, from_testdata
from emporia.sources import testdata

TABLES = {
    "region": "SELECT id r_regionkey, concat('R', id) r_name FROM range(2)",
    "nation": "SELECT id n_nationkey, concat('N', id) n_name, id % 2 n_regionkey FROM range(4)",
    "customer": "SELECT id c_custkey, id % 4 c_nationkey, 'BUILDING' c_mktsegment FROM range(20)",
    "supplier": "SELECT id s_suppkey, id % 4 s_nationkey FROM range(5)",
    "part": "SELECT id p_partkey, concat('p', id) p_name, IF(id % 3 = 0, 'LARGE', 'SMALL') p_type, CAST(id % 9 + 1 AS INT) p_size FROM range(10)",
    "orders": "SELECT id o_orderkey, id % 20 o_custkey, IF(id % 3 = 0, 'O', 'F') o_orderstatus, "
              "timestampadd(DAY, CAST(id * 9 AS INT), timestamp '1995-01-01') o_orderdate FROM range(80)",
    "lineitem": "SELECT id div 3 l_orderkey, id % 10 l_partkey, id % 5 l_suppkey, CAST(id % 3 + 1 AS INT) l_linenumber, CAST(id % 6 + 1 AS DOUBLE) l_quantity, "
                "CAST(id + 10 AS DOUBLE) l_extendedprice, 0.05D l_discount, 0.02D l_tax, array('A', 'N', 'R')[id % 3] l_returnflag, "
                "timestampadd(DAY, CAST(id AS INT), timestamp '1995-02-01') l_shipdate FROM range(240)",
    "events": "SELECT id event_id, timestampadd(HOUR, CAST(id AS INT), timestamp '1995-03-01') ts, CAST(id AS DOUBLE) value FROM range(150)",
}


@pytest.fixture()
def sf_dir(spark, tmp_path):
    for name, sql in TABLES.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def _saved(spark) -> set[str]:
    """The folders of saved tables with files, by path."""
    base = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    return {str(d) for d in base.glob("tables-*/*") if any(d.rglob("part-*"))}


def test_an_export_job_leaves_no_table_beside_its_exports(spark, sf_dir):
    before = _saved(spark)
    alone = sorted(map(tuple, registry.queries()["export_manifest"](spark, sf_dir).collect()))
    left = {Path(d).name for d in _saved(spark) - before}
    assert left == {"summary_cells"}
    assert dict(alone)["master_featured_csv"] > 60 and dict(alone)["online_retail_featured_csv"] > 100
    # With tables that other queries have built, the same rows, and the tables stay readable.
    t = from_testdata(spark, sf_dir)
    n, lines = t.master_featured.count(), t.retail_lines.count()
    assert sorted(map(tuple, registry.queries()["export_manifest"](spark, sf_dir).collect())) == alone
    assert (t.master_featured.count(), t.retail_lines.count(), t.orders_clean.count() >= n) == (n, lines, True)


def test_a_released_table_is_built_again(spark, sf_dir):
    t = CommerceTables(spark, testdata.raw_tables(spark, sf_dir))
    rows, totals = sorted(map(str, t.items_clean.collect())), sorted(map(str, t.items_agg.collect()))
    path, names = t._paths["order_items_clean"], list(t.bucketed)
    t.release("order_items_clean", "not saved")
    assert not Path(path.removeprefix("file:")).exists() and not t.bucketed
    assert not any(spark.catalog.tableExists(n) for n in names)
    assert sorted(map(str, t.items_agg.collect())) == totals and sorted(map(str, t.items_clean.collect())) == rows
