"""Registered queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lyceum.llm import byte_bpe_codec, compression_classifier, ngram_trie
from lyceum.llm.cross_alignment import link_digests
from lyceum.llm.exact_dedup import exact_dedup
from lyceum.llm.html_extraction import extract
from lyceum.llm.near_dedup import near_duplicates
from lyceum.llm.packing import pack
from lyceum.llm.periodic_runs import periodic_runs
from lyceum.llm.pseudonyms import pseudonymise
from lyceum.llm.quality_rules import quality_rules
from lyceum.llm.sentencepiece_codec import digests
from lyceum.llm.substring_dedup import substring_digests
from lyceum.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
    grams AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
    keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM grams),
    marked AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM keyed),
    spans AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS s
              FROM marked WHERE n > 1),
    repeats AS (SELECT doc_id, sum(s) AS n_repeat_words FROM spans GROUP BY doc_id),
    lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    counted AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
               len(list_filter(w, lambda x: list_contains(string_split('STOP_WORDS', ' '), lower(x)))) + 1 AS stops
        FROM d JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    judged AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END BETWEEN 2 AND 15 AS r1,
               CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END <= 0.1 AS r2,
               CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END >= 0.02 AS r3,
               CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END <= 0.6 AS r4
        FROM counted)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND r1 AND r2 AND r3 AND r4 AS kept,
           concat_ws(',', CASE WHEN NOT r1 THEN 'word_length' END, CASE WHEN NOT r2 THEN 'symbols' END,
                     CASE WHEN NOT r3 THEN 'stop_words' END, CASE WHEN NOT r4 THEN 'lines' END) AS failed_rules
    FROM judged
""".replace("STOP_WORDS", "the of and to in a is that for it was on are as with by this from or an be not le la de et les des en un une du "
            "que qui dans pour est sur pas au avec der die und den von zu das mit sich auf für ist im dem nicht ein eine "
            "el y los se del las por con para una su al lo es"))
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


PSEUDONYM_KEY = "a key for the supplied tables only"


@query()
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digests(table(spark, sf_dir, "documents"))


@query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), width=4).drop("tie")


def fold(parts: int) -> Column:
    """Remainder of the checksum of the id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(0).cast("long"))


@query()
def op7_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.filter(fold(3) != 1).select("doc_id", F.col("quality").alias("label"))
    scores = compression_classifier.score(documents, compression_classifier.fit(documents, known))
    return scores.select("doc_id", (fold(3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op8_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = ngram_trie.build(spark, documents.filter(fold(7) != 2), min_count=1)
    scores = ngram_trie.score(documents, model)
    return scores.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query()
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query()
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_codec.digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op11_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))


def made_periodic(doc_id: int | None, words: list[str]) -> list[str]:
    """Every tenth document, by the checksum of its id, repeats one period from some word on.  A null id
    counts as an empty text."""
    drawn, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if drawn % 10 or not n:
        return words
    rest = drawn // 10
    start = rest % n
    period = 1 + (n - start) // (3 + rest % 8)
    return words[:start] + [words[start + (i - start) % period] for i in range(start, n)]


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=made_periodic)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
