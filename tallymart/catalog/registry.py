"""Registry of the queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.catalog.tables import Bound, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: Sequence[str] = ()):
    """Register ``build(bound)`` under ``name``; without ``sql`` only its rows are checked.

    Dates leave a registered query as ISO text on both sides, since clients turn dates into different types.
    """

    def register(build: Callable[[Bound], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Bound(spark, sf_dir)).withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[name] = run if dates else lambda spark, sf_dir: build(Bound(spark, sf_dir))
        if sql is not None:
            texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            ORACLES[name] = f"SELECT * REPLACE ({texts}) FROM ({with_views(sql)})" if dates else with_views(sql)
        return build

    return register
