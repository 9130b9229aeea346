from emporia.sources.files import load_csv, load_parquet, table
from emporia.sources.sinks import list_files, save_table, write_csv, write_parquet


def test_single_file_csv_is_the_callers_choice(spark, tmp_path):
    df = spark.range(100).repartition(4)
    one = write_csv(df, str(tmp_path / "one"), single_file=True)
    many = write_csv(df, str(tmp_path / "many"))
    parts = lambda p: [f for f in (tmp_path / p).iterdir() if f.name.startswith("part-")]
    assert len(parts("one")) == 1 and len(parts("many")) == 4
    assert load_csv(spark, one).count() == load_csv(spark, many).count() == 100


def test_save_table_by_path_and_in_the_catalog(spark, tmp_path):
    df = spark.range(60).selectExpr("id", "id % 3 AS g").repartition(5)
    path = save_table(df, "t", str(tmp_path / "t"), partition_by=["g"])
    assert load_parquet(spark, path).count() == 60
    try:
        name = save_table(df, "emporia_saved_test", partition_by=["g"])
        assert table(spark, name).filter("g = 2").count() == 20
    finally:
        spark.sql("DROP TABLE IF EXISTS emporia_saved_test")


def test_partitioned_writes_are_balanced_first(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "id % 3 AS g").repartition(8)
    write_parquet(df, str(tmp_path / "t"), partition_by=["g"])
    assert all(len(list(d.glob("part-*"))) == 1 for d in (tmp_path / "t").glob("g=*"))


def test_large_csv_is_read_in_splits(spark, tmp_path):
    """Only the tables with free text are read as one task per file."""
    from emporia.sources.files import load_all
    from emporia.sources.schemas import MULTI_LINE

    assert MULTI_LINE == {"reviews", "retail"}
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = "\n".join(f"o{i},c{i},delivered,2017-01-01 00:00:00,,,," for i in range(20000))
    header = ("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
              "order_delivered_customer_date,order_estimated_delivery_date")
    (folder / "olist_orders_dataset.csv").write_text(f"{header}\n{lines}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000b")
        orders = load_all(spark, str(folder), names=["orders"])["orders"]
        assert orders.rdd.getNumPartitions() > 3
        assert orders.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_partitioned_parquet_and_listing(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "id % 3 AS g")
    write_parquet(df, str(tmp_path / "t"), partition_by=["g"])
    assert spark.read.parquet(str(tmp_path / "t")).filter("g = 1").count() == 17
    files = list_files(spark, str(tmp_path / "t"))
    assert files.columns == ["path", "length", "modificationTime"]
    assert files.filter(files.path.endswith(".parquet")).count() >= 3


AWKWARD = ['say "hi", you', "back\\slash", 'ends "', '"', "", None, " both ends ", "two\nlines", "car\rriage", "a\\\"b", "tab\t", ",", "'"]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    from emporia.sources import schemas

    rows = [(f"r{i}", f"o{i}", "5", t, t, None, None) for i, t in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, schemas.REVIEWS)
    path = write_csv(df, str(tmp_path / "r"), single_file=True)
    back = {r.review_id: tuple(r) for r in load_csv(spark, path, schemas.REVIEWS).collect()}
    # The reader takes one kind of line end for all, and empty text for a missing value.
    same = lambda t: None if t in (None, "") else t.replace("\r", "\n")
    assert {k: (same(v[3]), same(v[4])) for k, v in back.items()} == {r[0]: (same(r[3]), same(r[4])) for r in rows}
    import csv
    with open(next((tmp_path / "r").glob("part-*")), newline="") as f:
        plain = {r["review_id"]: r["review_comment_title"] for r in csv.DictReader(f)}
    assert plain == {r[0]: r[3] or "" for r in rows}


def test_refresh_replaces_only_the_changed_partitions(spark, tmp_path):
    from emporia.sources.sinks import refresh_partitions

    path = str(tmp_path / "t")
    old = spark.range(3000).selectExpr("id", "CAST(id % 4 AS INT) AS y", "'old' AS v")
    write_parquet(old, path, partition_by=["y"])
    files = lambda y: {(f.name, f.stat().st_mtime_ns, f.stat().st_size) for f in (tmp_path / "t" / f"y={y}").glob("part-*")}
    before = {y: files(y) for y in range(4)}
    new = old.selectExpr("id", "y", "'new' AS v").filter("y <> 3")
    refresh_partitions(new, path, "y", [1, 3])
    assert files(0) == before[0] and files(2) == before[2]
    assert files(1) and not files(1) & before[1] and not (tmp_path / "t" / "y=3").exists()
    found = {(r.y, r.v): r["count"] for r in load_parquet(spark, path).groupBy("y", "v").count().collect()}
    assert found == {(0, "old"): 750, (1, "new"): 750, (2, "old"): 750}
