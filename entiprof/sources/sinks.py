"""Sinks (S5, S6) and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from entiprof.session import ensure_checkpoint_dir


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write one profile table as parquet. Task retries and the output
    committer make the write survive lost executors; no coalesce to one file."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_tables(outputs: list[tuple[DataFrame, str]], mode: str = "overwrite", parallel: bool = True) -> None:
    """Write several frames. With ``parallel`` the writes are submitted as
    concurrent jobs from driver threads, so the scheduler interleaves their
    stages (small stages of one job fill the idle cores of the other); a
    failure of any write is raised after all have finished."""
    if not parallel or len(outputs) < 2:
        for df, path in outputs:
            write_table(df, path, mode)
        return
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
        futures = [pool.submit(write_table, df, path, mode) for df, path in outputs]
    for f in futures:
        f.result()


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Spark's file systems; False if there is none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Stage:
    """Frames that feed several outputs, kept while a build runs (S3).

    ``mode``: ``table`` writes a Parquet table in the session's shared checkpoint
    folder and reads it back, which cuts the lineage, lets readers prune columns
    and tells the planner its size; ``checkpoint`` and ``persist`` are those of
    :func:`materialize`; None keeps frames lazy."""

    def __init__(self, spark: SparkSession, mode: str | None):
        self.spark, self.mode = spark, mode
        self._paths: list[str] = []
        self._frames: list[DataFrame] = []

    def keep(self, *frames: tuple[str, DataFrame]) -> list[DataFrame]:
        """The frames, kept; tables are written as concurrent jobs."""
        if self.mode != "table":
            out = [materialize(df, self.mode) for _, df in frames]
            self._frames += out if self.mode else []
            return out
        root = ensure_checkpoint_dir(self.spark).rstrip("/")
        paths = [f"{root}/stage-{name}-{uuid.uuid4().hex}" for name, _ in frames]
        self._paths += paths
        write_tables([(df, path) for (_, df), path in zip(frames, paths)], "errorifexists")
        return [self.spark.read.schema(df.schema).parquet(path) for (_, df), path in zip(frames, paths)]

    def release(self) -> None:
        """Drop what was kept, once the outputs are written."""
        for df in self._frames:
            df.unpersist()
        for path in self._paths:
            delete_path(self.spark, path)
        self._frames.clear()
        self._paths.clear()


def materialize(df: DataFrame, mode: str | None = "checkpoint") -> DataFrame:
    """Cut the lineage of a frame that feeds several outputs.

    ``checkpoint`` writes it to the session's reliable checkpoint directory
    (shared storage on a cluster), so a lost executor does not recompute the
    upstream joins; ``persist`` keeps it in memory and disk of the executors;
    ``None`` leaves the plan lazy (Catalyst may then reuse exchanges within a
    single action only).
    """
    if mode is None:
        return df
    if mode == "persist":
        return df.persist()
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialize mode {mode!r}")
