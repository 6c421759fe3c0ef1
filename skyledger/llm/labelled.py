"""Bounded samples of labelled documents, and the folds both classifiers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.inputs import pick


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most_yes: int, most_no: int, max_chars: int | None = None) -> DataFrame:
    """At most ``most_yes`` documents of label 1 and ``most_no`` of label 0 outside the held-out fold: doc_id, text, label.

    Null ids, null labels and null texts take no part. If an id is labelled more
    than once the majority counts (label 1 on a tie); if documents repeat an id
    the smallest text stands for it. Documents of over ``max_chars`` characters
    are not learnt from (all are scored), and others take their places. The
    order is that of a hash of the id.
    """
    known = (
        pick(labels, **{"doc_id": "long", label: "int"}).toDF("id", "label").where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    by_hash = [F.xxhash64("id"), F.col("id")]
    texts = pick(docs, doc_id="long", text="string").where(F.col("text").isNotNull() if max_chars is None else F.length("text") <= max_chars)
    known = known.join(texts.select("doc_id"), F.col("doc_id") == F.col("id"), "left_semi")
    chosen = known.where("label = 1").orderBy(*by_hash).limit(most_yes).union(known.where("label = 0").orderBy(*by_hash).limit(most_no))
    # at most most_yes + most_no rows of two numbers, whatever the size of the tables
    chosen = F.broadcast(chosen)
    return (
        texts.join(chosen, F.col("doc_id") == F.col("id"))
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )


def class_shares(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many rows outside the held-out fold have label 0 and label 1."""
    row = (
        pick(labels, **{"doc_id": "long", label: "int"}).toDF("id", "label").where(F.col("id").isNotNull() & ~held_out(F.col("id")))
        .agg(F.count_if(F.col("label") == 0).alias("no"), F.count_if(F.col("label") == 1).alias("yes")).first()
    )
    return row.no, row.yes


def platt(logits, labels, shares: tuple[int, int]) -> tuple[float, float]:
    """Slope and offset of the logistic curve from logits to label 1, weighted to the class shares of all labels."""
    import numpy as np

    yes = labels.sum()
    weight = np.where(labels == 1, shares[1] / max(yes, 1), shares[0] / max(len(labels) - yes, 1))
    weight = weight / max(weight.sum(), 1e-9) * len(labels)
    target = np.where(labels == 1, (yes + 1) / (yes + 2), 1 / (len(labels) - yes + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        gradient = np.array([(g * logits).sum() + 1e-3 * (a - 1), g.sum()])
        curve = np.array([[(h * logits * logits).sum() + 1e-3, (h * logits).sum()], [(h * logits).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(curve, gradient)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return float(max(a, 1e-3)), float(b)
