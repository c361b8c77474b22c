"""The corpus pipeline: quality, line and near deduplication, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import decontaminate, line_dedup, mixing, near_dup, quality_model
from flowtables.session import scratch_path, split_skew
from flowtables.sources.tables import table

NEAR_PERCENT = 80
# Columns of documents that stages work with; all others are only carried along.
OWN = ("doc_id", "text", "n_chars")


def carrying(stage: Callable) -> Callable:
    """A stage that returns the columns it is given, whatever their names.

    Columns that stages do not work with go through it under numbers, so that none is taken for one of the
    stage's own; a column with a name that only differs by case from another stays apart as well.
    """

    @wraps(stage)
    def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in OWN else f"column {i}" for i, c in enumerate(docs.columns)]
        kept = stage(spark, docs.toDF(*names), sf_dir)
        return kept.select(*names).toDF(*docs.columns)

    return apart


@carrying
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from those of them with a label.

    Without labels every document has the score 0.5 and would go, so then all stay.
    """
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    if not model[0][0]:
        return docs
    return quality_model.classify(docs, model).where("predicted = 1").select(*docs.columns)


@carrying
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one that had words and has none left goes, as a copy.

    ``n_chars`` of a changed text is counted again.
    """
    lines = line_dedup.dedup_lines(docs)
    left = line_dedup.has_words(F.col("kept_text")) | (F.col("n_dropped") == 0)
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return lines.where(left).withColumns(changed).select(*docs.columns)


@carrying
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group, once; texts without words stay."""
    return near_dup.drop_near_dups(docs, NEAR_PERCENT)


@carrying
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with ``size``, ``source_size``, ``target`` and ``taken`` words."""
    return mixing.mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("near-duplicates", near_dedup),
    ("decontamination", drop_contaminated),
    ("source mix", mix_sources),
]
# The compression classifier cannot be written in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole table ``documents``."""
    split_skew(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{number}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        docs = out
    return docs
