"""Scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

CORRUPT = "_corrupt_record"


def csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    keep_corrupt: bool = False,
    line_breaks: bool = False,
) -> DataFrame:
    """CSV with header and doubled quotes. Without a schema Spark reads the files once more to infer one.

    With ``keep_corrupt`` the text of a row that does not fit goes to ``_corrupt_record``.
    ``line_breaks`` allows line breaks inside quotes; a file is then no longer split between tasks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = f"{schema}, {CORRUPT} string"
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def csv_tables(spark: SparkSession, folder: str, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """One frame per entity from ``folder/<entity>.csv``."""
    return {name: csv(spark, f"{folder}/{name}.csv", schema) for name, schema in schemas.items()}


def columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of each file; the content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
