"""A corpus pipeline: quality, lines, near-duplicates, benchmark leaks, packing.

Stages take whole tables of any columns, also empty ones, texts of any length, and keep the columns that they don't change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bugloom.llm import gam_quality, icws, line_spread, packing, qgram_decon
from bugloom.llm.common import dropped, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its threshold go; null and empty texts are scored too, rows that repeat alike."""
    return gam_quality.accepted(docs, gam_quality.fitted(docs, table(spark, "labels", sf_dir)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites go; n_chars follows the text.  All rows stay, null texts as they are, also those left empty."""
    return line_spread.without_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class one row stays, that of the least doc_id; a row that repeats stays once, empty texts and rows without doc_id stay."""
    return icws.without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go; null and empty texts hold none, each of several like rows is judged."""
    return qgram_decon.decontaminated(docs, table(spark, "benchmark", sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each row's tokens; null and empty texts are the end id alone."""
    return packing.packed(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: The classifier, the weighted samples and the packing have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, "documents", sf_dir)
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        dropped(before)  # but for the input, which isn't a scratch table
    return STAGES[-1][1](spark, docs, sf_dir)
