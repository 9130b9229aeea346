"""Writers: Parquet, CSV, managed tables, and a listing of written files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.sources.files import load_csv, load_parquet


def balanced(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of a partition value brought together (large ones in several tasks), so that few files are written."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    w = balanced(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with a header; ``single_file`` (for grouped summaries) writes one part, otherwise the partitioning stays.

    Quotes inside a field are doubled, as other tools and ``load_csv`` expect;
    spaces at the ends of a field stay, and empty text is quoted, so it differs
    from null.
    """
    out = df.coalesce(1) if single_file else df
    (out.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""').csv(path))
    return path


def refresh_partitions(df: DataFrame, path: str, partition_by: str, values: list) -> str:
    """Replace the partitions ``values`` of the Parquet table at ``path`` by their rows in ``df``; no other file is touched.

    Only the rows of those partitions are computed. A partition that has no
    row any more is removed. Rows in other partitions than ``values`` are not
    written.
    """
    spark = df.sparkSession
    folders = [f"{partition_by}={v}" for v in values]
    before = _files_in(spark, path, folders)
    (balanced(df.filter(F.col(partition_by).isin(list(values))), [partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
    # Only partitions with rows are overwritten: one that keeps its old files has none.
    for folder in {f for f, _ in before & _files_in(spark, path, folders)}:
        delete_folder(spark, f"{path.rstrip('/')}/{folder}")
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def _files_in(spark: SparkSession, path: str, folders: list[str]) -> set[tuple[str, str]]:
    """(folder, file) of the data files in partition folders; a listing, no file is read."""
    folder = F.regexp_extract("path", r"/([^/]+)/part-[^/]*$", 1)
    return {tuple(r) for r in list_files(spark, path).select(folder.alias("f"), "path").filter(F.col("f").isin(folders)).collect()}


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
               partition_by: list[str] | None = None) -> str:
    """Managed table in the catalog, or Parquet at ``path`` when there is no metastore."""
    if path is None:
        w = balanced(df, partition_by).write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(name)
        return name
    return write_parquet(df, path, partition_by=partition_by, mode=mode)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> str:
    """Parquet at ``path``, in ``buckets`` files by ``key``, sorted by it, known to the catalog as ``name``.

    The one exchange by the key is paid here; aggregations and joins by the key
    of tables with equally many buckets need none.
    """
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name))
    return name


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of every file under ``path``.

    The binary-file source prunes the ``content`` column, so file bodies are
    not read.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", "modificationTime"))


def export_all(tables: dict[str, DataFrame], summaries: dict[str, DataFrame], base: str,
               parquet_tables: tuple[str, ...] = ("master_featured",), done=None) -> DataFrame:
    """Write the export set and return its manifest: rows, files and bytes per export, read back from the files.

    Named tables go out as Parquet (those in ``parquet_tables``) and as
    partitioned CSV; the grouped summaries as single CSV files. ``done(name)``
    is called when a table is out and will not be read again.
    """
    base = base.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        if name in parquet_tables:
            write_parquet(df, f"{base}/{name}.parquet")
            rows.append((f"{name}.parquet", load_parquet(spark, f"{base}/{name}.parquet").count()))
        rows.append((f"{name}_csv", load_csv(spark, write_csv(df, f"{base}/{name}_csv"), df.schema, multi_line=True).count()))
        if done:
            done(name)
    for name, df in summaries.items():
        path = write_csv(df, f"{base}/summary_{name}", single_file=True)
        rows.append((f"summary_{name}", load_csv(spark, path, df.schema, multi_line=True).count()))
    counts = spark.createDataFrame(rows, "export string, row_count long")
    rel = F.regexp_extract("path", r"^.*?/(" + base.split("/")[-1] + r"/.*)$", 1)
    folder = F.regexp_extract(rel, r"^[^/]+/([^/]+)/", 1)
    files = (list_files(spark, base).filter(~F.col("path").rlike(r"/(_SUCCESS|\.[^/]*\.crc)$"))
             .groupBy(folder.alias("export")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))
    return counts.join(files, "export", "left")
