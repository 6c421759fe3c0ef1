"""Quality of whole texts from histogram gradient-boosted trees over document statistics.

Statistics are computed by array operations over all characters of a text. The
trees are grown level by level from histograms of gradients over quantile bins
and kept as flat arrays of complete trees, which numpy walks for all documents
of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import ragged
from skyledger.llm.inputs import pick
from skyledger.llm.labelled import class_shares, held_out, platt, training_sample

# fixed values: characters whose shares are statistics of their own
GROUPS = {"sentence": ".,;:?", "exclaim": "!", "signs": "#$%&*@^~", "bar": "|", "dash": "-_=+", "bracket": "()[]{}<>", "quote": "\"'`", "slash": "/\\"}

STATISTICS = [
    "characters", "words", "word_length", "word_length_spread", "longest_word", "letters", "digits", "spaces", "others", "upper", "lines", "line_words",
    *GROUPS, "short_words", "upper_words", "other_words", "end_letter_words", "distinct_words", "distinct_lines",
]


def _share(flags: np.ndarray, bounds: np.ndarray, of: np.ndarray) -> np.ndarray:
    return ragged.per_text(flags.astype(np.int64), bounds) / np.maximum(of, 1)


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of distinct values among the values of each text."""
    count = np.diff(bounds)
    owner = np.repeat(np.arange(len(count)), count)
    _, first = np.unique(ragged.mix(hashes ^ ragged.mix(owner.astype(np.uint64))), return_index=True)
    return np.bincount(owner[first], minlength=len(count)) / np.maximum(count, 1)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of STATISTICS per text; all are 0 for an empty text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for a, b in ragged.chunks(texts, 1_000_000):
        text, offsets = ragged.points(texts[a:b])
        if not len(text):
            continue
        kind, low = ragged.classes()[text], ragged.lower_table()[text]
        count = np.diff(offsets)
        starts, ends = ragged.words(kind == ragged.SPACE, offsets)
        word_bounds = np.searchsorted(starts, offsets)
        words, length = np.diff(word_bounds), ends - starts
        mean = ragged.per_text(length, word_bounds) / np.maximum(words, 1)
        longest = np.zeros(b - a)
        full = np.flatnonzero(words)
        if len(full):
            longest[full] = np.maximum.reduceat(length, word_bounds[full])
        upper = low != text
        line_starts, line_ends = ragged.words(text == 0x0A, offsets)
        line_bounds = np.searchsorted(line_starts, offsets)
        lines = np.diff(line_bounds)
        letters = ragged.per_text((kind == ragged.LETTER).astype(np.int64), offsets)
        held = np.append(0, np.cumsum(upper))
        other = np.append(0, np.cumsum(kind == ragged.OTHER))
        groups = [_share(np.isin(text, [ord(c) for c in members]), offsets, count) for members in GROUPS.values()]
        columns = [
            np.log1p(count), np.log1p(words), mean,
            np.sqrt(np.maximum(ragged.per_text(length * length, word_bounds) / np.maximum(words, 1) - mean * mean, 0)), np.log1p(longest),
            letters / np.maximum(count, 1), _share(kind == ragged.NUMBER, offsets, count), _share(kind == ragged.SPACE, offsets, count),
            _share(kind == ragged.OTHER, offsets, count), ragged.per_text(upper.astype(np.int64), offsets) / np.maximum(letters, 1),
            np.log1p(lines), words / np.maximum(lines, 1), *groups,
            _share(length <= 2, word_bounds, words), _share((held[ends] - held[starts]) * 2 > length, word_bounds, words),
            _share(other[ends] - other[starts] > 1, word_bounds, words), _share(kind[ends - 1] == ragged.LETTER, word_bounds, words),
            _distinct(ragged.span_hash(low, starts, ends), word_bounds), _distinct(ragged.span_hash(text, line_starts, line_ends), line_bounds),
        ]
        out[a:b] = np.stack(columns, 1)
    return out


@dataclass
class Forest:
    """Complete trees of one depth: the statistic and bound of every inner node, the value of every leaf."""

    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    @property
    def learnt(self) -> bool:
        """False for the trees without examples of both labels, which score every text alike."""
        return bool(self.value.any())

    def logits(self, rows: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(rows), len(self.feature)), np.int64)
        line = np.arange(len(rows))[:, None]
        depth = self.value.shape[1].bit_length() - 1
        for _ in range(depth):
            node = 2 * node + 1 + (rows[line, self.feature[trees, node]] > self.bound[trees, node])
        return self.offset + self.value[trees, node - (1 << depth) + 1].sum(1)


def fit(rows: np.ndarray, labels: np.ndarray, shares: tuple[int, int], trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
        penalty: float = 1.0, least: float = 2.0) -> Forest:
    """Trees for the logistic loss; without examples of both labels the share of label 1 alone."""
    offset = float(np.log((shares[1] + 1) / (shares[0] + 1)))
    inner, leaves, width = (1 << depth) - 1, 1 << depth, max(rows.shape[1], 1)
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), offset)
    if not (labels == 1).any() or not (labels == 0).any():
        return forest
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], 1)
    weight = np.where(labels == 1, shares[1] / labels.sum(), shares[0] / (len(labels) - labels.sum()))
    weight = weight / weight.mean()
    logits = np.full(len(rows), offset)
    for t in range(trees):
        p = 1 / (1 + np.exp(-logits))
        g, h = weight * (p - labels), weight * p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            nodes, base = 1 << level, (1 << level) - 1
            at = (node - base)[:, None] * (width * bins) + np.arange(width)[None, :] * bins + binned
            sums = [np.bincount(at.ravel(), np.repeat(x, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2) for x in (g, h)]
            total = [s[:, :, -1:] for s in sums]
            gain = sums[0] ** 2 / (sums[1] + penalty) + (total[0] - sums[0]) ** 2 / (total[1] - sums[1] + penalty) - total[0] ** 2 / (total[1] + penalty)
            gain[(sums[1] < least) | (total[1] - sums[1] < least)] = -1
            best = gain.reshape(nodes, -1).argmax(1)
            for k, place in enumerate(best):
                f, cut = divmod(int(place), bins)
                if gain[k, f, cut] > 1e-9 and cut < len(cuts[f]):
                    forest.feature[t, base + k], forest.bound[t, base + k] = f, cuts[f][cut]
            f = forest.feature[t, node]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), f] > forest.bound[t, node])
        leaf = node - inner
        value = -np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + penalty) * rate
        forest.value[t] = value
        logits = logits + value[leaf]
    forest.slope, forest.shift = platt(logits, labels, shares)
    return forest


def scorer(forest: Forest):
    """A column function from text to score."""

    @ragged.tidy
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            logits = forest.logits(statistics(["" if t is None else t for t in texts]))
            yield pd.Series(1 / (1 + np.exp(-np.clip(forest.slope * logits + forest.shift, -500, 500))))

    return F.pandas_udf(score, "double")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series(list(statistics(["" if t is None else t for t in texts])))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000, max_chars: int = 200_000, **options) -> Forest:
    """The trees learnt from at most ``per_class`` labelled documents of either kind outside the held-out fold.

    Only their statistics, computed by the executors, reach the driver.
    """
    sample = training_sample(docs, labels, "quality", per_class, per_class, max_chars).select("doc_id", "label", statistics_of("text").alias("row"))
    known = sample.toPandas().sort_values("doc_id", ignore_index=True)
    rows = np.stack(known["row"].tolist()) if len(known) else np.zeros((0, len(STATISTICS)))
    return fit(rows, known["label"].to_numpy(np.int64), class_shares(labels, "quality"), **options)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= ``threshold``).

    Only the text enters a score. A null text counts as empty; all statistics of
    an empty text are 0 and it is scored like any other. A null doc_id stays
    null and counts as not held out; repeated rows stay repeated and score
    alike; an empty table gives no rows; other columns are left out. Without
    labels of both kinds every text gets the smoothed share of label 1.
    """
    score = scorer(train(docs, labels, **options))
    return (
        pick(docs, doc_id="long", text="string")
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
