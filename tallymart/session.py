"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

T = TypeVar("T")

# Joins against a key that holds a large share of the rows are split at run time,
# also where the split costs one more shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_fallback_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Set the skew handling that the plans in this library count on."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A temporary folder, gone with the process, stands in only where the setting is missing and
    the master is local.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _fallback_dirs:
        _fallback_dirs[context.applicationId] = tempfile.TemporaryDirectory(prefix="tallymart-")
    return _fallback_dirs[context.applicationId].name


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage so that several readers see the same rows, and so that a lost
    executor costs a re-read and not a second (possibly different) computation.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small frame from values on the driver, as one literal of the plan."""
    fields = T_.StructType.fromDDL(schema)
    text = json.dumps([dict(zip(fields.names, row, strict=True)) for row in rows], default=str)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), T_.ArrayType(fields))))


def together(*jobs: Callable[[], T]) -> list[T]:
    """Results of independent Spark jobs, submitted at the same time so that they share the cluster."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
