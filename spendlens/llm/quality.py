"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted feature by feature in turn. Each tree is a step function of the bins of
one feature (or of two, for the interactions), so all trees of a feature add up to one lookup
table, and a score is the sum of one entry of each table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import column, id_and_text, unpacked, whole_row
from spendlens.llm.labels import labelled_sample

MAX_ROWS = 20_000  # labelled rows a model is fitted on, at most
THRESHOLD = 0.3

FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "space_share", "stop_share",
    "comma_share", "symbol_share", "mark_share", "bar_share", "wide_share", "symbol_kinds",
    "distinct_words", "repeated_neighbours", "top_word", "capital_words", "log_line_length",
    "repeated_lines",
)


def _bytes(chars: bytes) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars)] = 1
    return mask


_LOWER, _UPPER, _DIGIT = (_bytes(bytes(range(a, b))) for a, b in ((97, 123), (65, 91), (48, 58)))
_SYMBOL = _bytes(b"#$%&*+/<=>@[\\]^_`{}~")
_CLASSES = np.stack([
    _LOWER, _UPPER, _DIGIT, _bytes(b" \t\n\x0b\x0c\r"), _bytes(b".?"), _bytes(b",;:"), _SYMBOL,
    _bytes(b"!"), _bytes(b"|"), _bytes(bytes(range(128, 256)))], axis=1)


def features(text: str) -> list[float]:
    """Numbers that describe one whole text, as ``FEATURES`` names them; zeros for an empty text."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    lower, upper, digit, space, stop, comma, symbol, mark, bar, wide = (counts @ _CLASSES).tolist()
    size, n = float(counts.sum()), len(words)
    found = Counter(words)
    lines = [line for line in text.split("\n") if line]
    return [
        math.log(n), sum(map(len, words)) / n, upper / max(1.0, upper + lower), digit / size,
        space / size, stop / n, comma / n, symbol / n, mark / n, bar / n, wide / size,
        float(np.count_nonzero(counts * _SYMBOL)),
        len(found) / n, sum(map(eq, words, islice(words, 1, None))) / n,
        found.most_common(1)[0][1] / n,
        sum(map(str.istitle, words)) / n, math.log(size / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
    ]


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features; ``cuts`` are the inner bin edges."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    coarse: list[np.ndarray] = field(default_factory=list)  # of each feature: coarse bin of a fine bin

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, j], side="right")
                         for j, c in enumerate(self.cuts)], axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.intercept)
        if self.tables and len(rows):
            bins = self.bins(rows)
            for j, table in enumerate(self.tables):
                total += table[bins[:, j]]
            for (j, k), table in self.pairs.items():
                total += table[self.coarse[j][bins[:, j]], self.coarse[k][bins[:, k]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _step(gradient: np.ndarray, hessian: np.ndarray, penalty: float, depth: int = 2) -> np.ndarray:
    """A shallow regression tree over ordered bins: its value in each bin."""
    if depth and len(gradient) > 1:
        g, h = np.cumsum(gradient), np.cumsum(hessian)
        left, right = g[:-1] ** 2 / (h[:-1] + penalty), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + penalty)
        gain = left + right - g[-1] ** 2 / (h[-1] + penalty)
        at = int(np.argmax(gain)) + 1
        if gain[at - 1] > 1e-9:
            return np.concatenate([_step(gradient[:at], hessian[:at], penalty, depth - 1),
                                   _step(gradient[at:], hessian[at:], penalty, depth - 1)])
    return np.full(len(gradient), gradient.sum() / (hessian.sum() + penalty))


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The best tree of one cut on each axis of a grid: its gain, and its value in each cell."""
    sums = [np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h)]

    def corners(s: np.ndarray) -> list[np.ndarray]:
        inner, rows, cols, total = s[1:-1, 1:-1], s[1:-1, -1:], s[-1:, 1:-1], s[-1, -1]
        return [inner, rows - inner, cols - inner, total - rows - cols + inner]

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    parts = list(zip(corners(sums[0]), corners(sums[1])))
    gain = sum(a ** 2 / (b + penalty) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    low, right, down, both = (a[i, j] / (b[i, j] + penalty) for a, b in parts)
    cells = np.empty_like(g)
    cells[:i + 1, :j + 1], cells[:i + 1, j + 1:], cells[i + 1:, :j + 1], cells[i + 1:, j + 1:] = (
        low, right, down, both)
    return float(gain[i, j]), cells


def fit(rows: np.ndarray, labels: np.ndarray, bins: int = 32, grid: int = 8, rounds: int = 120,
        pairs: int = 8, rate: float = 0.15, penalty: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of the single features, then of the pairs with the largest gain.

    Without rows, or with one class only, the score is the smoothed share of label 1.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = AdditiveModel(math.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return model
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model.cuts = [np.unique(np.concatenate([np.quantile(column_, quantiles), [0.0, 1e-9]]))
                  for column_ in rows.T]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    found = model.bins(rows)
    total = np.full(len(rows), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = (np.bincount(found[:, j], s, len(table)) for s in slopes())
            step = rate * _step(g, h, penalty)
            table += step
            total += step[found[:, j]]

    model.coarse = [np.arange(len(t)) * grid // max(grid, len(t)) for t in model.tables]
    cells = np.stack([c[found[:, j]] for j, c in enumerate(model.coarse)], axis=1)
    g, h = slopes()

    def sums(s: np.ndarray, j: int, k: int) -> np.ndarray:
        return np.bincount(cells[:, j] * grid + cells[:, k], s, grid * grid).reshape(grid, grid)

    ranked = sorted(combinations(range(rows.shape[1]), 2), reverse=True,
                    key=lambda p: _quadrants(sums(g, *p), sums(h, *p), penalty)[0])
    model.pairs = {p: np.zeros((grid, grid)) for p in ranked[:pairs]}
    for _ in range(rounds // 2):
        for (j, k), table in model.pairs.items():
            g, h = slopes()
            step = rate * _quadrants(sums(g, j, k), sums(h, j, k), penalty)[1]
            table += step
            total += step[cells[:, j], cells[:, k]]
    return model


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(text.as_py()) for text in texts], dtype=float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target: str = "quality", max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold.

    The sample's ids are broadcast: 16 bytes for each of ``max_rows`` rows. Of the rows that repeat an id
    one text is learnt from. The features, a few numbers per id, are all that reaches the driver.
    """
    sample = F.broadcast(labelled_sample(labels, target, max_rows, id_col))
    names = [f"f{i}" for i in range(len(FEATURES))]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [pa.array(values) for values in _matrix(part.column(1)).T]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["label", *names])

    rows = (id_and_text(docs, id_col, text_col).join(sample, "doc_id").groupBy("doc_id", "label")
            .agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "text"))
    found = rows.mapInArrow(batches, ", ".join(["label int", *(f"{n} double" for n in names)])).toPandas()
    found = found.sort_values(names).to_numpy(dtype=float)  # a fixed order, whatever the tasks' order
    return fit(found[:, 1:], found[:, 0])


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: better).

    A null or empty text has a score too, that of a text whose features are all zero. Repeated
    rows score alike, an empty table gives no rows, and other columns are not read.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores = pa.array(model.score(_matrix(part.column(1))))
            yield pa.RecordBatch.from_arrays([part.column(0), scores], ["doc_id", "score"])

    pair = id_and_text(docs, id_col, text_col)
    kind = pair.schema["doc_id"].dataType.simpleString()
    return pair.mapInArrow(batches, f"doc_id {kind}, score double")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns.

    Rows are scored where they lie: the text goes to the classifier and the row does not move.
    """
    model = train(docs, labels, id_col, text_col, max_rows=max_rows)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(pa.array(texts, pa.string()))))

    rows = docs.select(whole_row(docs).alias("row"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"))
    return unpacked(rows.filter(scored("text") >= threshold), "row", docs.columns)

