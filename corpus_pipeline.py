"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes below the
shared folder and reads back as the next stage's documents; what else a stage wrote is then
deleted. All stages but the last return the columns of ``documents``, with whatever further
columns came in, whatever their names.

1. language_id: documents go whose language cannot be told: without any letter, or with less than
   ``MIN_LANGUAGE_SCORE`` of their letter sequences known in the language found. Documents whose
   words have one letter each (formulas, tables) hold no such sequence and stay.
2. toxicity: documents go whose toxicity score is 0.5 or more.
3. near_dedup: one document of each group of near duplicates stays, the one of the smallest doc_id.
4. mixing: documents are kept, left out or repeated so that the soft domains of the labels
   table meet ``TARGETS``, which ask for nothing of the domain that stage 2 rejects.
5. packing: token sequences of 2048 that hold lexically similar documents together.

A repeated input row (same doc_id and text) is a near duplicate of itself: stage 3 keeps it once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.llm import langid, minmax_dedup, mixing, packing, toxicity
from lastmile.llm.store import scratch, written
from lastmile.llm.textops import crc_remainder

MIN_LANGUAGE_SCORE = 0.3
TARGETS = {d: share for d, share in mixing.TARGETS.items() if d != "toxic"}


def _rows(docs: DataFrame, *needed: str) -> DataFrame:
    """Whole rows but for the text as one column, beside the text and the columns an operator needs."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {n: f"c{i}" for i, n in enumerate(docs.columns)}
    rest = [c for c in plain.columns if c != at["text"]]
    return plain.select(F.struct(*rest).alias("row"), *[F.col(at[n]).alias(n) for n in ("text", *needed)])


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(
        *[(F.col("text") if n == "text" else F.col(f"row.c{i}")).alias(n) for i, n in enumerate(docs.columns)]
    )


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _rows(docs, "doc_id", "lang")
    found = langid.identify(rows, crc_remainder("doc_id", 4) != 2, passed=("row", "text"))
    told = (F.col("score") >= MIN_LANGUAGE_SCORE) | (F.col("n_grams") == 0)
    known = (F.col("lang_pred") != langid.UNDETERMINED) & told
    return _back(found.filter(known), docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fold = crc_remainder("doc_id", 5)
    found = toxicity.score(
        _rows(docs, "doc_id"), _labels(spark, sf_dir), train=fold.isin(1, 2, 3), calibrate=fold == 4, passed=("row", "text")
    )
    return _back(found.filter("score < 0.5"), docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax_dedup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, _labels(spark, sf_dir), TARGETS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Learned models decide in several stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        with scratch():
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
