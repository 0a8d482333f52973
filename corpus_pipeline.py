"""Documents to a training mix, in five stages. Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All return the columns of `documents`, the last one also `copies`.

Each stage works on all that the one before it kept: texts that a quality rule rejects go; of lines that repeat more
than a few times, up to one edit, only the first stays; of near-duplicate documents the one with the smallest id stays; documents
with a benchmark item go; of what is left the mix to the sources' target weights takes each document `copies` times, or leaves it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanloom.llm.common import delete, fresh_path, scratch, table
from scanloom.llm.decontaminate import drop_contaminated
from scanloom.llm.lines import drop_repeated_lines
from scanloom.llm.mixing import mixed_documents
from scanloom.llm.omh import keep_one_of_each
from scanloom.llm.quality import keep_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Near duplicates and the seeded choice of the mix are not SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
