"""Search text to keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Anything that is neither a letter nor a digit separates keywords.
SEPARATORS = r"[^\p{L}\p{N}]+"


def keywords(text: Column | str) -> Column:
    """Lower-cased words of the whole text, in order, repeats kept."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def explode_keywords(df: DataFrame, text: str, keyword: str = "keyword") -> DataFrame:
    """One row per keyword; a row whose text holds none disappears."""
    return df.withColumn(keyword, F.explode(keywords(text))).drop(text)
