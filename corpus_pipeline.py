"""The corpus pipeline: documents in, tokenized training mix out, a Parquet table between stages.

Counted as part of subpackage ``llm``. Every stage takes (spark, docs, sf_dir)
and works on all that its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiprof.llm import bpe, linededup, mix, neardup, toxicity
from entiprof.llm.common import read, ship, stored

#: No SQL: the classifier, the sampling and the encoder have no SQL form.
ORACLE_SQL = None

#: Rows of an Arrow batch at most, as rows hold whole texts; a session that set a number of its own keeps it.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """The stage with batches of BATCH_ROWS; a task holds two, in the JVM and in Python, beside what it makes of them."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCH) == "10000":  # Spark's own default
            spark.conf.set(_BATCH, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; the score learns from the labelled documents among ``docs``."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


@_in_small_batches
def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay where they occur first; n_chars follows the text. Documents of which nothing is left go."""
    out = linededup.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_in_small_batches
def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: one document of each group stays."""
    return neardup.without_near_duplicates(docs, percent=80, shingle=5)


@_in_small_batches
def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands as often as the mix takes it: 0, 1 or 2 times."""
    return mix.mixed(docs)


@_in_small_batches
def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every document."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", _toxicity), ("line_dedup", _line_dedup), ("near_dedup", _near_dedup), ("mix", _mix), ("bpe", _encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next stage's input."""
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
