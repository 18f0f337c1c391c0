"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lyceum.llm.exact_dedup import columns_of
from lyceum.llm.words import words_of

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages, in lower case.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with by this from or an be not",
    "le la de et les des en un une du que qui dans pour est sur pas au avec",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine",
    "el la de que y en un los se del las por con para una su al lo es",
)


@dataclass(frozen=True)
class Rule:
    """A measure (a name in ``measures``) and the range in which a document passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "mean_word_length", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_share", 0.02, None),
    Rule("lines", "dup_line_share", None, 0.6),
)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def window_hashes(words: Column) -> Column:
    """Hash of the five words from each start on.  ``words`` has to be a column, not an expression:
    it is read once per window."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 4, F.lit(0))), lambda w, i: F.xxhash64(
        w, *[F.get(words, i + k) for k in range(1, 5)]))


def repeated_starts(ordered: Column) -> Column:
    """Starts, in order, of windows equal to another, from (window, start) pairs sorted by window.
    ``ordered`` has to be a column.  Neighbours are compared, so the sort is all the work there is."""
    same = F.filter(ordered, lambda x, k: F.coalesce(
        (x["w"] == F.get(ordered, k - 1)["w"]) | (x["w"] == F.get(ordered, k + 1)["w"]),
        x["w"] == F.get(ordered, k - 1)["w"], x["w"] == F.get(ordered, k + 1)["w"], F.lit(False)))
    return F.array_sort(F.transform(same, lambda x: x["i"]))


def covered(starts: Column, width: int = 5) -> Column:
    """Length of the union of [start, start + width) for sorted starts; ``starts`` has to be a column."""
    steps = F.transform(starts, lambda s, k: F.coalesce(F.least(F.get(starts, k + 1) - s, F.lit(width)), F.lit(width)))
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """One row per document: counts and ratios that the rules test.  One pass, no shuffle.

    A null text counts as empty; ids may be null or repeated; other columns are not read, or go along in
    the column ``row``."""
    text = F.coalesce(F.col("t"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"),
                       *([F.struct(*columns_of(docs)).alias("row")] if whole_rows else []))
    row = ["row"] if whole_rows else []
    split = base.select("doc_id", "t", *row, words_of(F.col("t")).alias("words"))
    hashed = split.select("*", window_hashes(F.col("words")).alias("windows"))
    # Windows are compared by 64-bit hashes: among 1e10 texts of 500 words, 1e-4 wrong pairs are expected.
    # Only texts with a repeated window are sorted.
    ordered = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(
        F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    sorted_windows = hashed.select("doc_id", "t", *row, "words", ordered.alias("ordered"))
    starts = repeated_starts(F.col("ordered"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stop_words = sorted({w for line in STOP_WORDS for w in line.split()})
    flagged = sorted_windows.select("doc_id", "t", *row, "words", starts.alias("found"), lines.alias("lines"))
    n = F.size("words")
    counted = flagged.select(
        "doc_id", *row,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered(F.col("found")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*stop_words))).cast("long").alias("n_stop_words"))
    return counted.select(
        "*", share(F.col("word_chars"), F.col("n_words")).alias("mean_word_length"),
        share(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        share(F.col("n_stop_words") + 1, F.col("n_words")).alias("stop_word_share"),  # + 1: short texts may have none
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"))


def passes(rules: tuple[Rule, ...]) -> list[Column]:
    """The table as one boolean column per rule."""
    tests = []
    for rule in rules:
        value, test = F.col(rule.measure), F.lit(True)
        if rule.low is not None:
            test = test & (value >= rule.low)
        if rule.high is not None:
            test = test & (value <= rule.high)
        tests.append(test.alias(rule.name))
    return tests


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                  text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Judge every document by the threshold table.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and
    failed_rules (names joined by commas, empty if all pass).  One row per input row: null and empty
    texts have no words and fail the base rule, repeated rows are judged alike, an empty table gives no
    rows, and extra columns are not read."""
    return judged(measures(docs, id_col, text_col), rules, min_words, max_repeat_percent).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def judged(measured: DataFrame, rules: tuple[Rule, ...], min_words: int, max_repeat_percent: int) -> DataFrame:
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    tests = passes(rules)
    verdict = ~failed
    for test in tests:
        verdict = verdict & test
    names = F.concat_ws(",", *[F.when(~test, F.lit(rule.name)) for rule, test in zip(rules, tests, strict=True)])
    # A generator, as a filter on the verdict would otherwise be moved below all projections, each of
    # which it would repeat for every mention of a column.
    own = [c for c in measured.columns if c not in ("row",)]
    return measured.select(*([F.col("row")] if "row" in measured.columns else []), F.inline(F.array(F.struct(
        *own, failed.alias("base_failed"), verdict.alias("kept"), names.alias("failed_rules")))))


def drop_failing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text",
                 min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """The rows that pass, with all their columns."""
    measured = measures(docs, id_col, text_col, whole_rows=True)
    return judged(measured, rules, min_words, max_repeat_percent).filter("kept").select("row.*")
