"""Feeds that arrive as files in a folder, applied to a type-2 history as they come.

A history is a folder of snapshots by batch: ``open`` holds the current version of every key as of a batch,
``closed`` the versions that a batch ended, ``late`` the rows that it could not place, and ``log`` one row per batch
that is complete. A batch writes its own folders and then its log row, so a batch that died half way is
written over, and one that is in the log, because the stream repeats it after a crash, is left alone. Closed versions are
never read or written again by a batch; only the open ones are.

Versions go by a time column of the feed and not by the batch, so the history does not depend on how files are
dealt to batches, as long as a key's rows do not arrive before its earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.operators import merge, scans
from tallymart.session import materialise, new_path, tune

LOG = "source string, number long, batch int"


@dataclass(frozen=True)
class FeedHistory:
    """The type-2 history of ``keys`` below ``path``.

    ``schema`` is the feed's; a new version begins where a ``tracked`` column differs from the version before
    (NULL equals NULL) and is valid from ``time``. Other columns are those of the row that opened the version.
    A row that repeats another, or the current version, changes nothing. Rows of one key and time that differ within a
    batch, and keys or times that are NULL, are an error, and the batch is not applied. Rows not later than the current
    version of their key go to ``late``. An empty batch gives a snapshot equal to the last.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    tracked: Sequence[str]
    time: str

    @property
    def _columns(self) -> list[str]:
        return [c for c in self.schema.names if c != self.time]

    @property
    def _open_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema.fields if f.name != self.time] + [T.StructField("effective_date", self.schema[self.time].dataType)])

    @property
    def _closed_schema(self) -> T.StructType:
        return T.StructType([*self._open_schema.fields, T.StructField("end_date", self.schema[self.time].dataType)])

    def create(self) -> FeedHistory:
        """An empty history, or the one that is there."""
        for part, schema in (("open", self._open_schema), ("closed", self._closed_schema), ("late", self.schema)):
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.path}/{part}/batch=0")
        self.spark.range(1).select(F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("number")).write.mode("ignore").parquet(f"{self.path}/log/batch=0")
        return self

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        """What complete batches wrote."""
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
        return self.spark.read.schema(with_batch).parquet(f"{self.path}/{part}").filter(F.col("batch") <= self.last_batch()).drop("batch")

    def log(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.path}/log")

    def last_batch(self) -> int:
        return self.log().agg(F.max("batch")).first()[0]

    def current(self) -> DataFrame:
        """The open version of every key: what an upsert of all rows so far gives."""
        return self.spark.read.schema(self._open_schema).parquet(f"{self.path}/open/batch={self.last_batch()}")

    def versions(self) -> DataFrame:
        closed = self._read("closed", self._closed_schema).withColumn("is_current", F.lit(False))
        end = F.lit(None).cast(self.schema[self.time].dataType)
        return closed.unionByName(self.current().withColumn("end_date", end).withColumn("is_current", F.lit(True)))

    def late(self) -> DataFrame:
        """Rows that came after a later version of their key, to be looked at."""
        return self._read("late", self.schema)

    def apply(self, rows: DataFrame, source: str, number: int) -> bool:
        """Apply batch ``number`` of ``source``; False if it has been applied before."""
        if self.log().filter((F.col("source") == source) & (F.col("number") == number)).head(1):
            return False
        # a stream has a session of its own for its batches; the rest is ordinary work of this one
        path = new_path(self.spark, "arrived")
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.parquet(path)
        tune(self.spark)
        keys, batch = list(self.keys), self.last_batch() + 1
        feed = merge.stored_feed(self.spark.read.schema(self.schema).parquet(path).distinct(), [*keys, self.time])
        held = self.current()

        known = held.select(*keys, F.col("effective_date").alias("_since"), F.struct(*self.tracked).alias("_held"))
        compared = feed.join(known, keys, "left")
        later = F.col("_since").isNull() | (F.col(self.time) > F.col("_since"))
        again = (F.col(self.time) == F.col("_since")) & F.struct(*self.tracked).eqNullSafe(F.col("_held"))
        fresh = compared.filter(later).select(*self._columns, F.col(self.time).alias("effective_date"))
        late = compared.filter(~later & ~again).select(*self.schema.names)

        touched = materialise(fresh.select(*keys).distinct(), "touched")
        met = held.join(touched, keys, "left_semi").unionByName(fresh).withColumn("_now", F.struct(*self.tracked))
        # windows over keys of any size
        seen = scans.scan(materialise(met, "met"), ["effective_date"], by=keys, number="_place", lags={"_before": ("_now", 1)})
        changes = seen.filter((F.col("_place") == 1) | ~F.col("_now").eqNullSafe(F.col("_before"))).drop("_place", "_now", "_before")
        ended = materialise(scans.scan(materialise(changes, "changes"), ["-effective_date"], by=keys, lags={"end_date": ("effective_date", 1)}), "ended")

        open_now = held.join(touched, keys, "left_anti").unionByName(ended.filter("end_date IS NULL").drop("end_date"))
        for part, frame in (("open", open_now), ("closed", ended.filter("end_date IS NOT NULL")), ("late", late)):
            frame.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch}")
        done = self.spark.range(1).select(F.lit(source).alias("source"), F.lit(number).cast("long").alias("number"))
        done.write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")
        return True

    def follow(self, folder: str, checkpoint: str, files_per_batch: int | None = None) -> None:
        """Apply all Parquet files of ``folder`` that ``checkpoint`` has not seen, oldest first, and return."""
        reader = self.spark.readStream.schema(self.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        stream = (
            reader.parquet(folder)
            .writeStream.foreachBatch(lambda rows, number: self.apply(rows, checkpoint, number) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
