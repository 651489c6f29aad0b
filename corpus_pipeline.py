"""A corpus from raw documents to a training mix: five stages, each over all that the one before it kept.

1. The quality classifier drops documents that it scores under 0.7.
2. Line dedup drops lines that many documents share.
3. The n-gram Jaccard join keeps one document of each group (five words, similarity 0.8).
4. Decontamination drops documents that hold a benchmark passage.
5. The mix takes whole copies of documents until each source has its share of words.

Stages 1 to 4 return the columns of documents; the last one returns a row for each copy that the mix takes, with
copy_no from 1.  Every stage handles nulls, empty texts, repeated rows and empty tables as its operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import decontaminate, line_dedup, mixing, ngram_join, quality, runtime


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars follows the text, if the table has it."""
    out = out.select(*(F.col(f"`{c}`") for c in docs.columns))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fitted_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, keep_at=quality.THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _same_columns(line_dedup.dedup_lines(docs), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_groups(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs).where("copies > 0")
    return mixed.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(*docs.columns, "copy_no")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mix_stage),
]

#: The trained classifier of the first stage can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row; what each returns is written as Parquet in the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = runtime.shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.mode("overwrite").parquet(f"{folder}/stage{k}")
            docs = spark.read.parquet(f"{folder}/stage{k}")
    return docs
