"""Scans (S1-S4): read tables by name, restrict to changed ids, emptiness test."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Full scan of one parquet table (S1). Column pruning and filter pushdown
    are left to Catalyst: callers select / filter on the returned frame."""
    return spark.read.parquet(table_path(base_dir, name))


class TableSet(Mapping[str, DataFrame]):
    """Lazily opened parquet tables of one directory, cached per name so that
    a plan that uses a table twice refers to one relation (exchange reuse)."""

    def __init__(self, spark: SparkSession, base_dir: str, names: Iterable[str] = DRIVER_TABLES):
        self.spark = spark
        self.base_dir = base_dir
        self._names = tuple(names)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.base_dir, name)
        return self._frames[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def load_tables(spark: SparkSession, base_dir: str, names: Iterable[str] = DRIVER_TABLES) -> TableSet:
    return TableSet(spark, base_dir, names)


def restrict_to(df: DataFrame, ids: DataFrame, on: str, ids_col: str | None = None) -> DataFrame:
    """Keep the rows of ``df`` whose ``on`` value occurs in ``ids``.

    A left-semi join: it never multiplies rows of ``df`` and never carries
    columns of ``ids``; duplicate ids are harmless and NULL ids match nothing.
    The id set is a DataFrame, not a Python list, so it can be as large as the
    change log; how the join runs is left to the planner and to AQE's measured
    sizes."""
    ids_col = ids_col or on
    keys = ids.select(F.col(ids_col).alias("__restrict_key")).where(F.col("__restrict_key").isNotNull())
    return df.join(keys, df[on] == keys["__restrict_key"], "left_semi")


def id_set(ids: DataFrame, column: str | None = None) -> DataFrame:
    """The distinct non-NULL ids, as column ``id``."""
    col = column or ids.columns[0]
    return ids.select(F.col(col).alias("id")).where(F.col("id").isNotNull()).distinct()


def has_rows(df: DataFrame) -> bool:
    """Emptiness test (S4): a one-row probe job, not a count."""
    return not df.isEmpty()
