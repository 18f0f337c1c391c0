"""Exact dedup by content-defined chunk recipes.

A text is cut at its own sentence and line ends, so equal passages give equal chunks.  Chunks are
de-duplicated once, which verifies that a chunk's identifier stands for one text only; from there on
documents are lists of identifiers, and only lists are grouped and joined, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A chunk ends at the first sentence or line end after 256 characters, at 2048 at the latest, or with the text.
CHUNK = r"(?s).{256,2047}?(?:[\n.!?]|\z)|.{1,2048}"


def chunks_of(text: Column) -> Column:
    """The chunks of a text in order; joined, they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def identifiers(text: Column) -> Column:
    return F.transform(chunks_of(text), lambda chunk: F.xxhash64(chunk))


def ambiguous(texts: DataFrame, text: str) -> DataFrame:
    """Identifiers that stand for more than one chunk text (column ``chunk_id``); next to none.

    Every task first drops its own repeated chunks, so a passage that many documents share moves once
    per task."""
    chunk = texts.select(F.explode(chunks_of(F.col(text))).alias("chunk"))
    distinct = chunk.select(F.xxhash64("chunk").alias("chunk_id"), "chunk").groupBy("chunk_id", "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1").select("chunk_id")


def grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per (text, id): doc_id, text_sha256, n (rows alike), keep_id, group_size."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    recipes = (texts.select("doc_id", F.sha2("t", 256).alias("text_sha256"), identifiers(F.col("t")).alias("recipe"))
               .groupBy("recipe", "text_sha256", "doc_id").agg(F.count("*").alias("n")))
    parts = recipes.select(F.xxhash64("recipe").alias("recipe_id"), F.explode("recipe").alias("chunk_id"))
    doubtful = (parts.join(ambiguous(texts, "t"), "chunk_id", "left_semi").select("recipe_id").distinct()
                .withColumn("doubtful", F.lit(True)))
    # A list with an ambiguous identifier is told apart by the digest of the whole text.
    listed = (recipes.withColumn("recipe_id", F.xxhash64("recipe")).join(doubtful, "recipe_id", "left")
              .withColumn("apart", F.when(F.col("doubtful"), F.col("text_sha256")).otherwise(F.lit(""))))
    groups = listed.groupBy("recipe", "apart").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return (listed.join(groups, ["recipe", "apart"])
            .select("doc_id", "text_sha256", "n", "keep_id", "group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group rows with identical texts; the row with the largest id of a group stays.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256.  A null text counts
    as empty, so null and empty texts are one group.  A null id loses against any other; if all ids of
    a group are null, keep_id is null and one row stays.  Of rows with the same id and text one stays.
    An empty table gives no rows; extra columns are not read."""
    rows = grouped(docs, id_col, text_col).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns, also those with dots in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def keep_rows(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` named by (doc_id, text_sha256, n) in ``rows``, all columns; of n rows alike in id
    and text, one.  Only where n > 1 are rows themselves grouped."""
    sha, own_id, own_sha, n = (unused(docs, x) for x in ("sha", "own_id", "own_sha", "n_alike"))
    marked = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    named = rows.select(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_sha), F.col("n").alias(n))
    found = marked.join(named, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(sha) == F.col(own_sha)))
    alike = found.filter(F.col(n) > 1).dropDuplicates([id_col, sha])
    return found.filter(F.col(n) == 1).unionByName(alike).select(*columns_of(docs))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = grouped(docs, id_col, text_col).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return keep_rows(docs, rows, id_col, text_col)
