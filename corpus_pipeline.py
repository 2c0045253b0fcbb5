"""Stages that turn the documents table into a training corpus.

Each stage gets what the stage before it kept and returns the columns of documents; the last returns one row for each
draw of the mix, with the copy's number and the output shard. ``run`` writes each stage to the shared folder and goes
on from there, so a lost executor costs at most one stage's tasks; what a stage stored beside its result is removed when
the result is written.

A document that line deduplication leaves without any line is dropped: all of it stands elsewhere. Documents that came
in without text are judged by the quality classifier like any other. Extra columns of documents are left out.

Defined results: an empty table gives an empty corpus. Null ids come last where the smallest id decides. Repeated rows are
judged alike, keep the same lines as one document does, and count as one group of near copies, of which one row stays;
rows without words are in no group, and the mix never takes them. Ties are broken by id, then by a hash of the text. Every
stage works on whole texts of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlane.llm.decontaminate import remove_contaminated
from fraudlane.llm.fuzzy_lines import dedup_lines
from fraudlane.llm.mixing import mix_in_order
from fraudlane.llm.near_duplicates import drop_near_duplicates
from fraudlane.llm.quality_crf import THRESHOLD, score_quality, train
from fraudlane.scratch import discard, materialise, temporary_rows

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The stages learn, link and permute; none of that has an SQL form.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs.select(*COLUMNS), chain).where(F.col("crf_score") >= THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of equal or nearly equal lines the first stays; n_chars follows the text."""
    left = dedup_lines(docs, tuple(c for c in COLUMNS if c != "text"))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    return left.where(~emptied).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    ).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the smallest id, a null one only if there is no other."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return remove_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each draw."""
    return mix_in_order(docs, COLUMNS)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        given = docs
        with temporary_rows(spark) as keep:
            docs = materialise(stage(spark, given, sf_dir), f"stage_{name}")
            keep(docs)
        discard(given)
    return docs
