"""The corpus pipeline: stages over documents, each working on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written and read
again as the next stage's documents. Labels come from the folder's table. Rows keep
the columns of documents up to the last stage, which returns pieces of sequences.

In every stage an empty table gives no rows. Stages that filter keep rows as they
are, with extra columns of any name, and repeated rows alike; a null or empty text
is scored like any text without words, and a null doc_id, lang, source or n_chars
decides nothing. What a stage does otherwise is in its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import jaccard, mixing, packing, quality, toxicity
from skyledger.llm.inputs import read, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3.

    Without labels of both kinds nothing can be learnt; then no document is
    rejected.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.scorer(model)(F.col("text")) < 0.3) if model.learnt else docs


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7; all, if labels of both kinds are missing."""
    forest = quality.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.scorer(forest)(F.col("text")) >= 0.7) if forest.learnt else docs


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id.

    Repeated rows are copies. A class without any id keeps one row; rows without
    id and words are copies of nothing and all stay, as do documents without
    words that have different ids. Extra columns stay.
    """
    return jaccard.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the weights of their sources ask for.

    Columns beside those of documents are left out. A null source is a source of
    its own; documents without words come as often as their source's whole copies;
    rows that repeat id and size are taken or left together.
    """
    return mixing.mixed_documents(docs, whole_only=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their ids.

    A null or empty text is the end id alone; a null doc_id stays null; repeated
    rows are packed each for itself; other columns are left out.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("jaccard_join", without_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# the two classifiers are numpy models, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs)
    return docs
