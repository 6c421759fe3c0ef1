"""Toxicity of whole texts from subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams, each with an embedding row found by
hash; a window of a few words is the average of its words' vectors, and a
softmax layer over the average gives the class. Rows and layer are trained
jointly in numpy. A document counts as toxic as its two most toxic windows, so
insults in a long text are not averaged away; training first lets all
windows carry the label of their document, then goes on with the window that
stands out in each document; small samples are gone over more often.

Of a long text a bounded number of windows is learnt from: first some spread by
hash, then also those that the first model finds most toxic in the whole text.
The curve from logit to score is fitted to the top windows of whole texts.

As average and layer are linear, scoring needs one number per n-gram row, which
is all that executors receive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import ragged
from skyledger.llm.inputs import pick, stored
from skyledger.llm.labelled import class_shares, held_out, platt, training_sample

SIZES = (3, 4, 5)
FIELDS = ["rows", "offset", "slope", "shift", "window", "top"]
WINDOW, TOP = 2, 2
OPEN, CLOSE = 0x110001, 0x110002


@dataclass
class Model:
    """One number per n-gram row, the offset, the curve from the logit to a score, words per window and windows that count."""

    rows: np.ndarray
    offset: float
    slope: float
    shift: float
    window: int
    top: int = TOP

    @property
    def learnt(self) -> bool:
        """False for the model without examples of both labels, which scores every text alike."""
        return bool(self.rows.any())


def _words(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Lower-cased code points, word spans, word hashes, and the first word of every text; a word said again at once counts once."""
    text, offsets = ragged.points(texts)
    text = ragged.lower_table()[text]
    starts, ends = ragged.words(ragged.classes()[text] == ragged.SPACE, offsets)
    hashes = ragged.span_hash(text, starts, ends)
    word_starts = np.searchsorted(starts, offsets)
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = hashes[1:] != hashes[:-1]
    new[word_starts] = True
    new = new[:-1]
    starts, ends = starts[new], ends[new]
    return text, starts, ends, hashes[new], np.searchsorted(starts, offsets)


def _grams(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every n: the row of the n-gram at each place of all marked words, and each word's first and last place."""
    lengths = ends - starts + 2
    edge = np.cumsum(lengths)
    first = edge - lengths
    marked = np.empty(int(edge[-1]) if len(edge) else 0, np.uint64)
    inner = np.ones(len(marked), bool)
    inner[first] = inner[edge - 1] = False
    marked[inner] = text[ragged.gather(starts, ends - starts)]
    marked[first], marked[edge - 1] = OPEN, CLOSE
    rows, spans = [], []
    for n in SIZES:
        size = max(len(marked) - n + 1, 0)
        value = np.full(size, np.uint64(0x632BE59BD9B4E019 + n))
        for k in range(n):
            value = value * np.uint64(0x100000001B3) + marked[k : k + size]
        rows.append((ragged.mix(value) & np.uint64(buckets - 1)).astype(np.int64))
        spans.append(np.stack([first, np.maximum(first, edge - n + 1)]))
    return rows, spans


def word_scores(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Mean of the n-gram numbers of every word."""
    total, number = np.zeros(len(starts)), np.zeros(len(starts))
    for at, (first, last) in zip(*_grams(text, starts, ends, len(rows)), strict=True):
        held = np.zeros(len(at) + 1)
        np.cumsum(rows[at], out=held[1:])
        last = np.minimum(last, len(at))
        first = np.minimum(first, last)
        total += held[last] - held[first]
        number += last - first
    return total / np.maximum(number, 1)


def _windows(word_starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number of every word, and the first window of every text; texts without words have none."""
    count = np.diff(word_starts)
    windows = -(-count // window)
    first = np.append(0, np.cumsum(windows))
    place = np.arange(word_starts[-1]) - np.repeat(word_starts[:-1], count)
    return np.repeat(first[:-1], count) + place // window, first


def _ranked(means: np.ndarray, first_window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows in order of text and, in a text, from the highest mean down, and each one's rank."""
    count = np.diff(first_window)
    order = np.lexsort((-means, np.repeat(np.arange(len(count)), count)))
    return order, np.arange(len(order)) - np.repeat(first_window[:-1], count)


def _top_mean(means: np.ndarray, first_window: np.ndarray, top: int) -> np.ndarray:
    """Mean of the ``top`` highest windows of every text that has one (of all, if there are fewer)."""
    order, rank = _ranked(means, first_window)
    owner = np.repeat(np.arange(len(first_window) - 1), np.diff(first_window))[rank < top]
    total = np.bincount(owner, means[order[rank < top]], len(first_window) - 1)
    return (total / np.maximum(np.bincount(owner, minlength=len(total)), 1))[np.diff(first_window) > 0]


def top_logits(texts: list[str], model: Model) -> np.ndarray:
    """Logit of the most toxic windows of every text; the offset alone for texts without words."""
    out = np.full(len(texts), model.offset)
    for a, b in ragged.chunks(texts, 1_500_000):
        text, starts, ends, hashes, word_starts = _words(texts[a:b])
        if not len(starts):
            continue
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        score = word_scores(text, starts[first], ends[first], model.rows)[inverse]
        number, first_window = _windows(word_starts, model.window)
        means = np.bincount(number, score) / np.bincount(number)
        out[a + np.flatnonzero(np.diff(first_window))] = model.offset + _top_mean(means, first_window, model.top)
    return out


def fit(texts: list[str], labels: np.ndarray, shares: tuple[int, int], window: int = WINDOW, top: int = TOP, buckets: int = 1 << 17, dims: int = 8,
        warm_steps: int = 80, top_steps: int = 80, rate: float = 0.4, seed: int = 7) -> Model:
    """The model of the given texts; without examples of both labels it gives every text the smoothed share of label 1."""
    rng = np.random.default_rng(seed)
    prior = float(np.log((shares[1] + 1) / (shares[0] + 1)))
    if not (labels == 1).any() or not (labels == 0).any() or not any(t.strip() for t in texts):
        return Model(np.zeros(buckets, np.float32), 0.0, 1.0, prior, window, top)
    text, starts, ends, hashes, word_starts = _words(texts)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    rows, spans = _grams(text, starts[first], ends[first], buckets)
    lengths = np.stack([np.minimum(s[1], len(r)) - np.minimum(s[0], len(r)) for r, s in zip(rows, spans, strict=True)])
    lengths = np.maximum(lengths, 0)
    gram_starts = np.append(0, np.cumsum(lengths.sum(0)))
    flat = np.empty(gram_starts[-1], np.int32)
    begin = gram_starts[:-1].copy()
    for place, (own, _), size in zip(rows, spans, lengths, strict=True):
        flat[ragged.gather(begin, size)] = place[ragged.gather(own, size)]
        begin += size
    del rows, spans, text, starts, ends, hashes
    grams = np.diff(gram_starts)
    number, first_window = _windows(word_starts, window)
    window_starts = np.append(np.searchsorted(number, np.arange(first_window[-1])), len(number))
    doc_of = np.repeat(np.arange(len(texts)), np.diff(first_window))
    used = np.flatnonzero(np.diff(first_window))

    # rows of n-grams that no example has stay close to zero and add next to nothing
    table = ((rng.random((buckets, dims)) - 0.5) * 0.01).astype(np.float32)
    layer = ((rng.random((dims, 2)) - 0.5)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen, layer_seen = np.full(buckets, 1e-8, np.float32), np.full((dims, 2), 1e-8, np.float32)
    target = np.stack([labels == 0, labels == 1], 1).astype(np.float32)
    balance = np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (len(labels) - labels.sum()))).astype(np.float32)

    def step(chosen: np.ndarray) -> None:
        nonlocal bias
        size = np.diff(window_starts)[chosen]
        at = ragged.gather(window_starts[chosen], size)
        word = inverse[at]
        many = grams[word]
        row = flat[ragged.gather(gram_starts[word], many)]
        share = np.repeat(1 / (np.maximum(many, 1) * np.repeat(size, size)), many).astype(np.float32)
        of = np.repeat(np.repeat(np.arange(len(chosen)), size), many)
        vectors = table[row] * share[:, None]
        mean = np.stack([np.bincount(of, vectors[:, d], len(chosen)) for d in range(dims)], 1).astype(np.float32)
        logit = mean @ layer + bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        docs = doc_of[chosen]
        error = (p - target[docs]) * balance[docs][:, None]
        back = error @ layer.T
        distinct, place = np.unique(row, return_inverse=True)
        gradient = np.stack([np.bincount(place, back[of, d] * share, len(distinct)) for d in range(dims)], 1).astype(np.float32)
        seen[distinct] += (gradient**2).mean(1)
        table[distinct] -= rate * gradient / np.sqrt(seen[distinct])[:, None]
        slope = mean.T @ error / len(chosen)
        layer_seen[:] += slope**2
        layer[:] -= 0.1 * slope / np.sqrt(layer_seen)
        bias = bias - 0.1 * error.mean(0)

    def ends_of() -> np.ndarray:
        difference = table @ (layer[:, 1] - layer[:, 0])
        score = np.empty(len(grams))
        for a in range(0, len(grams), 20_000):
            part = slice(gram_starts[a], gram_starts[min(a + 20_000, len(grams))])
            held = np.append(0, np.cumsum(difference[flat[part]], dtype=np.float64))
            edges = gram_starts[a : a + 20_001] - gram_starts[a]
            score[a : a + 20_000] = (held[edges[1:]] - held[edges[:-1]]) / np.maximum(grams[a : a + 20_000], 1)
        return np.bincount(number, score[inverse]) / np.bincount(number)

    parts = max(1, len(doc_of) // 2048)
    for _ in range(-(-warm_steps // parts)):
        for part in np.array_split(rng.permutation(len(doc_of)), parts):
            step(part)
    parts = max(1, len(used) // 256)
    for _ in range(-(-top_steps // parts)):
        order, rank = _ranked(ends_of(), first_window)
        for part in np.array_split(rng.permutation(order[rank == 0]), parts):
            step(part)
    difference = table @ (layer[:, 1] - layer[:, 0])
    model = Model(difference.astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, window, top)
    logits = np.full(len(texts), model.offset)
    logits[used] = model.offset + _top_mean(ends_of(), first_window, top)
    model.slope, model.shift = platt(logits, labels, shares)
    return model


def scorer(model: Model):
    """A column function from text to score."""

    @ragged.tidy
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            logits = top_logits(["" if t is None else t for t in texts], model)
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * logits + model.shift, -500, 500))))

    return F.pandas_udf(score, "double")


def shortened(text: str, max_chars: int, window: int, model: Model | None = None, most: int = 8) -> str:
    """A text of about ``max_chars`` characters: itself, or windows of a longer text by hash, after the ``most`` most toxic ones if a model is given."""
    if len(text) <= max_chars:
        return text
    words = text.split()
    pieces = [" ".join(words[i : i + window]) for i in range(0, len(words), window)]
    # in order of a hash of their place, which no pattern in a text can follow
    order = np.argsort(ragged.mix(np.arange(len(pieces), dtype=np.uint64)), kind="stable")
    if model is not None:
        top = np.argsort(-top_logits(pieces, model), kind="stable")[:most]
        order = np.append(top, order[~np.isin(order, top)])
    held = np.cumsum([len(pieces[i]) + 1 for i in order])
    return " ".join(pieces[i] for i in np.sort(order[: max(1, most if model else 1, int(np.searchsorted(held, max_chars)))]))


def train(docs: DataFrame, labels: DataFrame, toxic: int = 1000, clean: int = 2500, max_chars: int = 4000, **options) -> Model:
    """The model learnt from at most ``toxic`` and ``clean`` labelled documents of the kinds, outside the held-out fold.

    The bounded sample goes to one task, which is fitted there; the driver gets
    the numbers of the model only. Texts of over ``max_chars`` characters go
    there shortened to windows of theirs; the curve is fitted on the driver to
    one logit of each whole text of the sample.
    """
    sample, shares = stored(training_sample(docs, labels, "toxic", toxic, clean)), class_shares(labels, "toxic")
    if not sample.where(F.length("text") > max_chars).limit(1).count():
        return _fit_in_task(sample, max_chars, None, shares, **options)
    # the first model only has to find the windows that stand out in long texts
    model = _fit_in_task(sample, max_chars, None, shares, **{"top_steps": 60} | options)
    if not model.learnt:
        return model
    model = _fit_in_task(sample, max_chars, model, shares, **options)

    @F.pandas_udf("double")
    def logit(texts: pd.Series) -> pd.Series:
        return pd.Series(top_logits(texts.tolist(), model))

    known = sample.select("doc_id", "label", logit("text").alias("logit")).toPandas().sort_values("doc_id")
    slope, shift = platt(known["logit"].to_numpy(), known["label"].to_numpy(np.int64), shares)
    return Model(model.rows, model.offset, slope, shift, model.window, model.top)


def _fit_in_task(sample: DataFrame, max_chars: int, before: Model | None, shares: tuple[int, int], window: int = WINDOW, **options) -> Model:
    """The model of the sample with its long texts shortened, with the help of the model ``before`` if there is one."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[shortened(t, max_chars, window, before) for t in batch["text"]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *batches]).sort_values("doc_id", ignore_index=True)
        model = fit(known["text"].tolist(), known["label"].to_numpy(np.int64), shares, window=window, **options)
        yield pd.DataFrame([(model.rows.astype("<f4").tobytes(), model.offset, model.slope, model.shift, model.window, model.top)], columns=FIELDS)

    row = sample.mapInPandas(cut, sample.schema).repartition(1).mapInPandas(run, "rows binary, offset double, slope double, shift double, window int, top int").first()
    if row is None:  # no labelled rows, no task
        return fit([], np.zeros(0, np.int64), shares, window=window, **options)
    return Model(np.frombuffer(row.rows, "<f4"), row.offset, row.slope, row.shift, row.window, row.top)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= ``threshold``).

    Only the text enters a score. A null or empty text, or one of white space,
    has no window and gets the score of the offset alone. A null doc_id stays
    null and counts as not held out; repeated rows stay repeated and score
    alike; an empty table gives no rows; other columns are left out. Without
    labels of both kinds every text gets the smoothed share of label 1.
    """
    score = scorer(train(docs, labels, **options))
    return (
        pick(docs, doc_id="long", text="string")
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", predicted("score", threshold))
    )


def predicted(score: str, threshold: float) -> Column:
    return (F.col(score) >= threshold).cast("int")
