"""The registered queries of the numbered operators: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to the whole intended table and
returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.llm import (
    langid,
    licenses,
    merkle,
    minmax_dedup,
    mixing,
    nra,
    packing,
    ppm,
    qalsh,
    quality,
    subspace_dedup,
    substring,
    toxicity,
)
from lastmile.llm.textops import crc_remainder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder("doc_id", 3) == 1
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality.score(docs, labels, train=~held_out, passed=("doc_id", "held_out"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op2_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op3_qalsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qalsh.nearest(_table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)


def op4_subspace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder("doc_id", 4) == 2
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out)
    return langid.identify(docs, ~held_out, passed=("doc_id", "held_out")).drop("n_grams")


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder("doc_id", 10) == 0
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    return ppm.score(docs, train=~held_out, passed=("doc_id", "held_out"))


def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = mixing.rates(docs, _table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", F.col("__t").cast("bigint").alias("tokens"), F.col("__p").alias("posteriors"), "rate", "copies"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = crc_remainder("doc_id", 5)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold == 0)
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(
        docs, labels, train=fold.isin(1, 2, 3), calibrate=fold == 4, passed=("doc_id", "held_out")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, passed=("doc_id",)).drop("places")


def op11_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.without_repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op12_postorder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Query] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_bm25_packing": op2_bm25_packing,
    "op3_qalsh": op3_qalsh,
    "op4_subspace_dedup": op4_subspace_dedup,
    "op5_language_id": op5_language_id,
    "op6_ppm": op6_ppm,
    "op7_minmax_dedup": op7_minmax_dedup,
    "op8_soft_mixing": op8_soft_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_license_scan": op10_license_scan,
    "op11_seed_extend": op11_seed_extend,
    "op12_postorder_manifest": op12_postorder_manifest,
    "op13_nra_search": op13_nra_search,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
