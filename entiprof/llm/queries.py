"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiprof.llm import align, ann, bpe, fingerprints, html, infill, linededup, lm, mix, neardup, pii, secrets, toxicity
from entiprof.llm.common import read, ship


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85, shingle=3)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), _path("word_bpe_49k.json"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix_sources(read(spark, sf_dir, "documents")).drop("copies")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(read(spark, sf_dir, "documents"))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_digests(read(spark, sf_dir, "documents"), _path("byte_bpe_50k.json"), _path("piece_bpe_32k.model"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (op1_pii, op2_fingerprints, op3_near_duplicates, op4_nearest, op5_secrets, op6_toxicity, op7_lm, op8_line_dedup, op9_bpe, op10_mix, op11_infill, op12_html, op13_align)
}

def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
#: The others have none: regular expressions with spans, sampling, training and encoding have no SQL form here; tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {"op11_infill": infill.ORACLE_SQL}
