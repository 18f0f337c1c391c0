"""Quality classifier by compression: dictionaries built from good and from bad texts.

A text is compressed with both; the difference of the sizes, per byte of text, says which kind it resembles.
The difference and the ratio without dictionary (texts that repeat themselves compress far too well) are
turned into a probability by logistic calibration on labelled texts that made no dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.words import slices

LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries of at most ``dictionary`` bytes and the weights of the calibration."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


class Scorer:
    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        make = lambda raw: zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_content_size=False)
        self.good, self.bad, self.plain = make(good), make(bad), make(b"")

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Difference of compressed sizes per byte and per compressed byte, and the plain ratio; zeros for an empty text."""
        n = len(text)
        if not n:
            return 0.0, 0.0, 0.0
        good, bad, plain = (len(c.compress(text)) for c in (self.good, self.bad, self.plain))
        return (bad - good) / n, (bad - good) / max(good, bad), math.log(plain / n)


def spread_features(rows: np.ndarray) -> np.ndarray:
    """Inputs of the calibration: a constant, the features and their squares."""
    return np.column_stack([np.ones(len(rows)), rows, rows**2])


def calibrated(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Logistic regression by Newton's method on standardised inputs; weights for the raw ones."""
    x = spread_features(rows)
    mean, scale = x[:, 1:].mean(0), x[:, 1:].std(0) + 1e-9
    z = np.column_stack([x[:, :1], (x[:, 1:] - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - labels) / len(z) + penalty * w
        bend = (z * (p * (1 - p))[:, None]).T @ z / len(z) + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / scale
    return np.concatenate([[w[0] - raw @ mean], raw])


def built(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    import zstandard

    parts = [t[k:k + 2000] for t in texts for k in range(0, len(t), 2000)]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[:size]


def features_of(docs: DataFrame, good: bytes, bad: bytes, kept: list[str]) -> DataFrame:
    """The columns ``kept`` and the three features of every whole ``text`` (binary, null: empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(good, bad)
        for part in slices(batches, "text"):
            x = np.array([scorer.features(t or b"") for t in part.column("text").to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in kept], *[pa.array(column, pa.float64()) for column in x.T]],
                names=[*kept, "gain", "gain_of_packed", "plain"])

    types = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in kept) + ", gain double, gain_of_packed double, plain double")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, text_bytes: int = 65_536,
        dictionary: int = 112_640, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from ``docs`` and ``labels`` (doc_id, label 0 or 1).

    The sample of rows is bounded: ``per_class`` ids of each label, those with the smallest hash.  Every
    other one of them makes the dictionaries, which take at most ``text_bytes`` bytes of a text, as they have
    room for ``dictionary`` bytes in all; the others calibrate on whole texts, compressed in Spark tasks, so
    only three numbers a text come to the driver.  Rows without id or label are left out; an id without a
    document counts in the sample but teaches nothing.  Without texts of one label for its dictionary, every
    text is scored as the other one."""
    known = labels.select(F.col("doc_id").alias("own_id"), "label").filter("own_id is not null").distinct()
    ids = [known.filter(F.col("label") == label).orderBy(F.xxhash64("own_id"), "own_id").limit(per_class) for label in (0, 1)]
    # At most 2 x per_class rows of an id and a label.
    chosen = sorted((int(r["label"]), r["own_id"]) for r in ids[0].union(ids[1]).collect())
    sides = {label: [own for of, own in chosen if of == label] for label in (0, 1)}
    parts = [(own, label, at % 2) for label in (0, 1) for at, own in enumerate(sides[label])]
    schema = f"own_id {dict(known.dtypes)['own_id']}, label int, part int"
    picked = F.broadcast(docs.sparkSession.createDataFrame(parts, schema))
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    sample = texts.join(picked, F.col("doc_id") == F.col("own_id"))
    makers = sample.filter("part = 0").select("label", "doc_id", F.substring("text", 1, text_bytes).alias("text")).collect()
    makers = sorted((r["label"], r["doc_id"], bytes(r["text"])) for r in makers)
    bad, good = ([text for label, _, text in makers if label == own] for own in (0, 1))
    if not bad or not good:
        return Model(b"", b"", (0.0 if bad == good else 20.0 if good else -20.0, *[0.0] * 6))
    raw = built(good, dictionary), built(bad, dictionary)
    rows = features_of(sample.filter("part = 1").select("label", "text"), *raw, ["label"]).collect()
    rows = sorted(tuple(r) for r in rows) or [(1, 0.0, 0.0, 0.0)]
    return Model(*raw, tuple(calibrated(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], float))))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): probability of label 1 for every whole text.

    One row per input row, whatever the id; null and empty texts get the score of an empty one; texts
    alike get scores alike; an empty table gives no rows; extra columns are not read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    constant, *weights = map(float, model.weights)
    inputs = ["gain", "gain_of_packed", "plain"]
    # The terms of ``spread_features``: the features, then their squares.
    terms = [F.col(c) for c in inputs] + [F.col(c) * F.col(c) for c in inputs]
    sum_of_terms = sum((F.lit(w) * t for w, t in zip(weights, terms, strict=True)), F.lit(constant))
    bounded = F.greatest(F.least(sum_of_terms, F.lit(30.0)), F.lit(-30.0))
    featured = features_of(rows, model.good, model.bad, ["doc_id"])
    return featured.select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded))).alias("score"))
