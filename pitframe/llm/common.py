"""Helpers shared by the corpus operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that all word rules here mean: blank and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; other letters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole(text: Column) -> Column:
    """The text, or the empty one for null."""
    return F.coalesce(text, F.lit(""))


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of separators, without the empty ones that split leaves at the ends."""
    return F.array_remove(F.split(text, f"{separators}+"), "")
