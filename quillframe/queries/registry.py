"""Query registration: a function from tables to a DataFrame, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.lineage import scratch_path


class Tables:
    """The tables of one folder, read lazily: ``t.orders`` is orders.parquet."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self) -> str:
        """A new folder all executors can reach, next to the checkpoints."""
        return scratch_path(self.spark, "files")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(run: Callable[[Tables], DataFrame]):
        REGISTRY[run.__name__] = Query(run.__name__, run, sql)
        return run

    return register


def rnd(value: Column | str, places: int = 4) -> Column:
    return F.round(value, places)


def with_gaps(t: Tables) -> DataFrame:
    """events with the reading ``v``, which is missing for error events."""
    return t.events.withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))


# The same in SQL, as the start of a WITH clause.
GAPS = "ev AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"
