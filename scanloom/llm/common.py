"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.shared import delete, fresh_path, materialise, scratch, shared_dir

__all__ = ["BLANK", "WORD", "delete", "fresh_path", "materialise", "n_words", "scratch", "shared_dir", "table", "text_of"]

#: ASCII whitespace, as a Java character class body.
BLANK = r"\x20\x09-\x0D"
#: Words of the quality rules and of mixing: runs without ASCII whitespace.
WORD = rf"[^{BLANK}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def n_words(text: Column) -> Column:
    """Number of runs without ASCII whitespace, as long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")
