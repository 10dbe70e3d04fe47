"""Sinks, copies and their verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.sources import readers


def csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a CSV folder. ``single_file`` is for report-sized results only.

    Blanks around a text are kept; an empty text reads back as NULL, as files do not tell them apart.
    """
    out = df.repartition(1) if single_file else df
    writer = out.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a table together with its schema."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def publish(df: DataFrame, name: str, path: str) -> None:
    """Write the next snapshot of a table to a new path and point the table there.

    The old files stay as they were, so ``df`` may read the table itself, and readers never see half a write.
    Refuses other columns or types than the table's.
    """
    have = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in df.sparkSession.table(name).schema.fields]
    if have != want:
        raise ValueError(f"columns of {name} are {want}, got {have}")
    df.write.mode("error").parquet(path)
    quoted_name = ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))
    quoted_path = path.replace("\\", "\\\\").replace("'", "\\'")
    df.sparkSession.sql(f"ALTER TABLE {quoted_name} SET LOCATION '{quoted_path}'")


def append_to_table(df: DataFrame, name: str) -> None:
    """Append by column name; refuses other columns than the table's."""
    table = df.sparkSession.table(name)
    if set(df.columns) != set(table.columns):
        raise ValueError(f"columns of {name} are {table.columns}, got {df.columns}")
    df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields]).write.insertInto(name)


def append_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    schema = spark.table(name).schema
    append_to_table(spark.createDataFrame(list(rows), schema), name)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free sum of row hashes."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row_hash), F.lit(0)).alias("hash_sum"))


def copy_csv(spark: SparkSession, source: str, target: str, schema: str) -> DataFrame:
    """Copy a CSV folder and compare both sides: ``(n_source, n_target, same_rows)``.

    Cells are copied and compared as text, so one that does not fit ``schema`` is kept, and a lost one is seen;
    ``unfit_rows`` finds those.
    """
    csv(readers.csv(spark, source, _as_text(schema)), target)
    return compare_copies(spark, source, target, schema)


def _as_text(schema: str) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in T.StructType.fromDDL(schema).fields)


def unfit_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a CSV folder, as text, with a cell that is not of its column's type."""
    unfit = F.lit(False)
    for f in T.StructType.fromDDL(schema).fields:
        unfit = unfit | (F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
    return readers.csv(spark, path, _as_text(schema)).filter(unfit)


def compare_copies(spark: SparkSession, source: str, target: str, schema: str) -> DataFrame:
    """Rows of two CSV folders and whether all their cells agree as text: ``(n_source, n_target, same_rows)``."""
    text = _as_text(schema)
    before = fingerprint(readers.csv(spark, source, text))
    after = fingerprint(readers.csv(spark, target, text)).select(F.struct("n_rows", "hash_sum").alias("t")).scalar()
    return before.withColumn("t", after).select(
        F.col("n_rows").alias("n_source"),
        F.col("t.n_rows").alias("n_target"),
        ((F.col("n_rows") == F.col("t.n_rows")) & (F.col("hash_sum") == F.col("t.hash_sum"))).alias("same_rows"),
    )


def compare_formats(df: DataFrame, folder: str) -> DataFrame:
    """The same rows as CSV and as Parquet: rows, files and bytes of each."""
    spark = df.sparkSession
    csv(df, f"{folder}/csv")
    parquet(df, f"{folder}/parquet")
    copies = {
        "csv": readers.csv(spark, f"{folder}/csv", df.schema.toDDL()),
        "parquet": readers.parquet(spark, f"{folder}/parquet"),
    }
    result = None
    for kind, copy in copies.items():
        size = (
            readers.file_metadata(spark, f"{folder}/{kind}")
            .filter(F.col("path").rlike(r"/part-[^/]*$"))
            .agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))
            .select(
                F.lit(kind).alias("format"), copy.agg(F.count("*")).scalar().alias("n_rows"), "n_files", "n_bytes"
            )
        )
        result = size if result is None else result.unionByName(size)
    return result
