"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed once and staged. Trees are grown in numpy on a bounded
sample of labelled rows: features are cut into bins at quantiles, gradients and curvatures are
summed per bin, and the best split of a node is read off the sums. A tree of fixed depth is an
array in heap order (children of i at 2i+1 and 2i+2), so that all rows walk all trees together
with one array look-up per level.

Learning reads at most ``SAMPLE_ROWS`` labelled rows, those of smallest id hash.

Defined results: NULL text is scored as empty; rows whose label is NULL teach nothing; without
labelled rows every score is 0.5; a document labelled twice counts twice; repeated rows are each
scored; rows without id are scored but never learned from; very long texts are measured whole;
an empty table gives no rows; only the text decides a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.hashing import shingles, word_hashes
from tidemark.llm.tables import least_by_hash, spread, stage

SAMPLE_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
PENALTY = 1.0
LEAST_CURVATURE = 1.0
# A score of this much or more predicts label 1, by contract.
CUT = 0.3

STATISTICS = (
    "words", "chars", "mean_word", "longest_word", "distinct_words", "commonest_word", "equal_neighbours",
    "repeated_runs", "lines", "repeated_lines", "words_per_line", "upper", "digits", "non_ascii", "marks",
    "stops", "exclaims", "bars", "hashes", "stars", "money", "percents", "ands", "symbol_ends", "shouts", "short_words",
)


def statistics(text: bytes | None) -> np.ndarray:
    """Statistics of UTF-8 text, in the order of ``STATISTICS``."""
    data = text or b""
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n = max(len(words), 1)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    letters = max(upper + lower, 1)
    chars = max(len(data) - int(counts[0x80:0xC0].sum()), 1)
    lines = [line for line in data.split(b"\n") if line.strip()]
    runs = shingles(word_hashes(data), 3) if len(words) > 2 else np.empty(0, dtype=np.uint64)
    each = Counter(words)
    symbols = [counts[ord(c)] for c in "!|#*$%&"]
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    lengths = list(map(len, words))
    return np.array(
        [
            np.log1p(len(words)),
            np.log1p(len(data)),
            sum(lengths) / n,
            max(lengths, default=0),
            len(each) / n,
            max(each.values(), default=0) / n,
            sum(map(eq, words, words[1:])) / n,
            1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0,
            np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            n / max(len(lines), 1),
            upper / letters,
            int(counts[48:58].sum()) / chars,
            int(counts[0xC0:].sum()) / chars,
            marks / n,
            int(counts[46] + counts[44]) / n,
            *[s / n for s in symbols],
            sum(word[-1] in b"!|#*$%&<>" for word in words) / n,
            sum(word.isupper() and len(word) > 3 for word in words) / n,
            sum(length < 3 for length in lengths) / n,
        ],
        dtype=np.float32,
    )


@dataclass(frozen=True)
class Trees:
    """Trees in heap order, flattened: ``feature`` and ``cut`` of inner nodes, ``value`` of leaves."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees of the leaf each row reaches; all rows walk a level at a time."""
        inner = self.feature.shape[1]
        tree = np.arange(len(self.feature))[None, :]
        rows = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.cut[tree, at])
        return self.start + self.value[tree, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost trees on rows ``x`` with labels ``y`` (0 or 1)."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    prior = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(prior / (1 - prior)))
    if len(y) == 0:
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    feature = np.zeros((trees, inner), dtype=np.int64)
    cut = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    margin = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = at - first
            best = np.zeros(width)
            for f, e in enumerate(edges):
                if len(e) == 0:
                    continue
                key = local * (len(e) + 1) + binned[:, f]
                g = np.bincount(key, slope, width * (len(e) + 1)).reshape(width, -1)
                h = np.bincount(key, bend, width * (len(e) + 1)).reshape(width, -1)
                gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                g_all, h_all = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + PENALTY) + (g_all - gl) ** 2 / (h_all - hl + PENALTY) - g_all**2 / (h_all + PENALTY)
                gain[(hl < LEAST_CURVATURE) | (h_all - hl < LEAST_CURVATURE)] = 0
                place = gain.argmax(1)
                top = gain[np.arange(width), place]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                feature[t, first + better] = f
                cut[t, first + better] = e[place[better]]
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[t, at]] > cut[t, at])
        leaf = at - inner
        value[t] = -RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + PENALTY)
        margin += value[t, leaf]
    return Trees(start, feature, cut, value)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``statistics`` of every row, staged."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "statistics": [statistics(t) for t in batch["text"]]})

    whole = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return stage(spread(whole).mapInPandas(describe, "doc_id long, statistics array<float>"), "statistics")


def learn(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Trees:
    """Trees from staged statistics and ``doc_id``, ``quality`` of the rows that may teach."""
    taught = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
    taught = taught.filter("doc_id is not null and quality is not null")
    taught = least_by_hash(taught, "doc_id", sample)
    found = rows.join(F.broadcast(taught), "doc_id").toPandas()  # both bounded by the sample size
    found = found.sort_values(["doc_id", "quality"], kind="stable")
    x = np.stack(found["statistics"].to_numpy()).astype(float) if len(found) else np.empty((0, len(STATISTICS)))
    return grow(x, (found["quality"].to_numpy() > 0).astype(float))


def classify(rows: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` of staged statistics. The trees' size is fixed."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    @pandas_udf("double")
    def score(columns: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(columns.to_numpy()).astype(float)) if len(columns) else [], dtype=float)

    scored = rows.select("doc_id", score("statistics").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
