"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

The blocks of a page, in order, are a chain; each is main text or not.  Features are the elements above a
block with their class and id names, neighbouring pairs of them, and the shape of the text.  Weights are
fitted on labelled pages by stochastic gradient on the conditional likelihood; Viterbi finds the best
labels of a page."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lyceum.llm.page_blocks import Block, blocks_of, labelled_pages
from lyceum.llm.words import slices


def path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    """Elements above a block, names, and pairs of neighbouring elements; each once."""
    tags = [tag for tag, _ in path if tag not in ("html", "body")]
    found = {f"in {tag}" for tag in tags} | {f"named {name}" for _, names in path for name in names}
    found |= {f"pair {a} {b}" for a, b in zip(["top", *tags], tags, strict=False)}
    found.add(f"own {tags[-1] if tags else 'none'}")
    return sorted(found)


def text_features(block: Block) -> list[str]:
    n = len(block.text)
    words = block.text.count(" ") + 1
    return ["always", f"words {min(int(math.log2(words)), 7)}", f"links {round(3 * block.linked / n)}",
            f"ends {block.text[-1] if block.text[-1] in '.!?:' else 'else'}"]


@dataclass(frozen=True)
class Field:
    """Weight of each feature for label 1 over label 0, and of each step between labels."""

    weights: dict[str, float]
    steps: tuple[tuple[float, float], tuple[float, float]]


def scores(field: Field, blocks: list[Block], seen: dict) -> list[float]:
    found = []
    for block in blocks:
        above = seen.get(block.path)
        if above is None:
            if len(seen) > 50_000:
                seen.clear()
            above = seen[block.path] = sum(field.weights.get(x, 0.0) for x in path_features(block.path))
        found.append(above + sum(field.weights.get(x, 0.0) for x in text_features(block)))
    return found


def viterbi(field: Field, own: list[float]) -> list[int]:
    """Best labels; on ties the lower one."""
    if not own:
        return []
    (s00, s01), (s10, s11) = field.steps
    a, b, back = 0.0, own[0], []
    for x in own[1:]:
        from_a, from_b = a + s01, b + s11
        stay_a, stay_b = a + s00, b + s10
        back.append((int(stay_b > stay_a), int(from_b > from_a)))
        a, b = max(stay_a, stay_b), max(from_a, from_b) + x
    label = int(b > a)
    labels = [label]
    for choice in reversed(back):
        label = choice[label]
        labels.append(label)
    return labels[::-1]


def log_sum(x: float, y: float) -> float:
    high = max(x, y)
    return high + math.log1p(math.exp(min(x, y) - high))


def marginals(own: list[float], s: list[list[float]]) -> tuple[list[float], list[list[float]]]:
    """Probability of label 1 at each place, and expected steps, by forward and backward sums."""
    n = len(own)
    ahead, behind = [(0.0, own[0])], [(0.0, 0.0)]
    for x in own[1:]:
        a, b = ahead[-1]
        ahead.append((log_sum(a + s[0][0], b + s[1][0]), log_sum(a + s[0][1], b + s[1][1]) + x))
    for x in own[:0:-1]:
        a, b = behind[-1]
        behind.append((log_sum(s[0][0] + a, s[0][1] + x + b), log_sum(s[1][0] + a, s[1][1] + x + b)))
    behind.reverse()
    total = log_sum(*ahead[-1])
    ones = [math.exp(ahead[i][1] + behind[i][1] - total) for i in range(n)]
    expected = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(n - 1):
        for p in (0, 1):
            for q in (0, 1):
                expected[p][q] += math.exp(ahead[i][p] + s[p][q] + q * own[i + 1] + behind[i + 1][q] - total)
    return ones, expected


def train(pages: list[list[Block]], rounds: int = 6, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Fit to pages of labelled blocks, page by page, with steps that shrink for frequent features."""
    weights: dict[str, float] = {}
    moved: dict[str, float] = {}
    s = [[0.0, 0.0], [0.0, 0.0]]
    s_moved = [[1.0, 1.0], [1.0, 1.0]]
    rows = [([path_features(b.path) + text_features(b) for b in page], [b.label for b in page]) for page in pages if page]
    for _ in range(rounds):
        for features, labels in rows:
            own = [sum(weights.get(x, 0.0) for x in f) for f in features]
            ones, expected = marginals(own, s)
            slope: dict[str, float] = {}
            for f, label, p in zip(features, labels, ones, strict=True):
                if abs(label - p) > 1e-4:
                    for x in f:
                        slope[x] = slope.get(x, 0.0) + label - p
            for x, g in slope.items():
                g -= decay * weights.get(x, 0.0)
                moved[x] = moved.get(x, 1.0) + g * g
                weights[x] = weights.get(x, 0.0) + rate * g / math.sqrt(moved[x])
            seen = [[0.0, 0.0], [0.0, 0.0]]
            for p, q in zip(labels, labels[1:], strict=False):
                seen[p][q] += 1
            for p in (0, 1):
                for q in (0, 1):
                    g = seen[p][q] - expected[p][q]
                    s_moved[p][q] += g * g
                    s[p][q] += rate * g / math.sqrt(s_moved[p][q])
    return Field(weights, tuple(tuple(x) for x in s))


def main_text(field: Field, html: str | None, seen: dict) -> str:
    blocks = blocks_of(html)
    labels = viterbi(field, scores(field, blocks, seen))
    return "\n\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page: blocks of main text, joined by an empty line.

    ``field`` is a trained model; by default one is fitted to pages made by a rule (``labelled_pages``).
    One row per input row, whatever the id and url; null, empty and textless pages have an empty text; an
    empty table gives no rows; extra columns are not read.  Broken markup is read as browsers do."""
    field = field or train(labelled_pages())
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for part in slices(batches, "html"):
            texts = [main_text(field, html, seen) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")
