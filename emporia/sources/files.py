"""Readers for the raw tables and session views."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from emporia.sources.schemas import CATALOGUE, has_free_text


def load_csv(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool | None = None) -> DataFrame:
    """CSV with a header row, quoted fields and doubled-quote escapes.

    With a declared schema nothing is inferred; without one every column is
    read as text. Malformed rows are kept with nulls in the bad fields
    (``load_sound_csv`` sets them aside). ``multi_line`` allows line ends inside
    quoted fields, at the price of one task per file; by default it is on where
    the schema has free text or none is declared.
    """
    reader = _csv_reader(spark, schema, multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _csv_reader(spark: SparkSession, schema: StructType | None, multi_line: bool | None) -> DataFrameReader:
    lines = has_free_text(schema) if multi_line is None else multi_line
    return (spark.read.option("header", True).option("multiLine", lines)
            .option("escape", '"').option("mode", "PERMISSIVE"))


RECORD, SOUND = "_record", "_sound"
# Reasons for which a row is set aside.
TOO_FEW, TOO_MANY, BAD_QUOTES = "too few fields", "too many fields", "badly quoted"


_END = "\u0001end"


def _reason(record: Column, n: int) -> Column:
    """Why a record does not fit ``n`` columns, null if it has as many fields (a value of another type makes a null, no more).

    The fields are counted by reading the record once more as text, with a mark
    behind its last field.
    """
    names = [f"c{i}" for i in range(n + 1)]
    marked = F.concat(F.regexp_replace(record, r"[\r\n]+$", ""), F.lit(f",{_END}"))
    fields = F.from_csv(marked, ", ".join(f"{c} string" for c in names), {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"})
    end = F.array_position(F.array(*[fields[c] for c in names]), _END)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"')))
    return F.when(quotes % 2 == 1, BAD_QUOTES).when(end == 0, TOO_MANY).when(end <= n, TOO_FEW)


def stage_csv(spark: SparkSession, path: str, schema: StructType, out: str, multi_line: bool | None = None, header: bool = True) -> None:
    """Read a CSV once and save it as Parquet below ``out``: sound rows, and malformed records with file and reason.

    A record with too few or too many fields, or with an odd number of quotes,
    is malformed. One write does both, by a partition column, so no row is
    parsed twice and no column is left out of the check.
    """
    declared = StructType([*schema.fields, StructField(RECORD, StringType(), True)])
    reader = _csv_reader(spark, schema, multi_line).option("header", header).option("columnNameOfCorruptRecord", RECORD)
    rows = reader.schema(declared).csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    rows = rows.withColumn("_reason", F.when(F.col(RECORD).isNotNull(), _reason(F.col(RECORD), len(schema.fields))))
    bad = F.col("_reason").isNotNull()
    kept = [F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields]
    aside = [F.when(bad, F.col(c)).alias(c) for c in ("_file", "_reason", RECORD)]
    rows.select(*kept, *aside, (~bad).alias(SOUND)).write.mode("overwrite").partitionBy(SOUND).parquet(out)


def load_staged(spark: SparkSession, out: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(sound rows, quarantine) of what ``stage_csv`` saved; the quarantine has file, reason and record."""
    fields = [*schema.fields, *[StructField(c, StringType(), True) for c in ("_file", "_reason", RECORD)],
              StructField(SOUND, BooleanType(), True)]
    rows = spark.read.schema(StructType(fields)).parquet(out)
    sound = rows.filter(F.col(SOUND)).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    aside = rows.filter(~F.col(SOUND)).select(F.col("_file").alias("file"), F.col("_reason").alias("reason"),
                                              F.col(RECORD).alias("record"))
    return sound, aside


def load_sound_csv(spark: SparkSession, path: str, schema: StructType, out: str, multi_line: bool | None = None,
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``stage_csv``, then what it saved."""
    stage_csv(spark, path, schema, out, multi_line, header)
    return load_staged(spark, out, schema)


def load_all(spark: SparkSession, base: str, names=None, paths: dict | None = None) -> dict[str, DataFrame]:
    """Read every catalogued table under ``base`` (or the given paths)."""
    return {name: load_csv(spark, path, schema) for name, path, schema in _catalogued(base, names, paths)}


def load_all_sound(spark: SparkSession, base: str, out: str, names=None,
                   paths: dict | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Sound rows and quarantine of every catalogued table; both are saved below ``out``."""
    found = {name: load_sound_csv(spark, path, schema, f"{out.rstrip('/')}/{name}")
             for name, path, schema in _catalogued(base, names, paths)}
    return {n: sound for n, (sound, _) in found.items()}, {n: aside for n, (_, aside) in found.items()}


def _catalogued(base: str, names, paths: dict | None) -> Iterator[tuple[str, str, StructType]]:
    for name in names or CATALOGUE:
        default_file, schema = CATALOGUE[name]
        yield name, (paths or {}).get(name) or f"{base.rstrip('/')}/{default_file}", schema


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet reader (our hand-over format between stages)."""
    return spark.read.parquet(path)


def register_views(tables: dict[str, DataFrame], suffix: str = "") -> list[str]:
    """Register each DataFrame as a session temp view ``<name><suffix>``."""
    names = []
    for name, df in tables.items():
        view = f"{name}{suffix}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a view or catalog table by name."""
    return spark.table(name)
