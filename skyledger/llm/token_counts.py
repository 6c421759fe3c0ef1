"""Token counts of whole texts under a byte-level pair vocabulary.

Method: rank-synchronous array merging (see ``bpe.py``). Pre-tokens of a chunk
of texts are held as ragged numpy arrays; in every round each sequence applies
its lowest-ranked pair at once, and the symbols that are left are counted.
The job is one map over the documents: no shuffle, nothing collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import bpe, ragged
from skyledger.llm.inputs import pick


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is the path of the vocabulary file on every executor.
    A null text counts as empty: 0 bytes, 0 tokens, not over the limit. A null
    doc_id stays null; repeated rows stay repeated; texts are never cut; other
    columns, whatever their names, are left out. Special strings inside a text
    are one token each, as the library does by default.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for a, b in ragged.chunks(texts):
                tokens[a:b] = bpe.count(texts[a:b], vocabulary)
                size[a:b] = [len(t.encode("utf-8", "surrogatepass")) for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return pick(docs, doc_id="long", text="string").mapInArrow(ragged.tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
