"""Registered queries of the numbered operators and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from skyledger.llm import (
    collocations, html_text, jaccard, mixing, neardup, packing, prefix_trie, quality, token_counts, topk, toxicity, url_filter, warc,
)
from skyledger.llm.inputs import read


def op1_embedding_near_dedup(spark, sf_dir):
    """Links and classes of all vectors."""
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_exact_top_k(spark, sf_dir):
    """The five best rows of every fiftieth vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark, sf_dir):
    """Main text of all pages."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_warc(spark, sf_dir):
    """Metadata and conversion records of the responses of all pages."""
    return warc.derive_records(warc.page_responses(read(spark, sf_dir, "pages")))


def op5_jaccard_join(spark, sf_dir):
    """Classes of all documents linked by shingle similarity."""
    return jaccard.link_documents(read(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    """Pieces of all documents in windows of 4096 tokens."""
    packed = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.drop("ids")


def op7_toxicity(spark, sf_dir):
    """Toxicity of all documents."""
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_quality(spark, sf_dir):
    """Quality of all documents."""
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_mixing(spark, sf_dir):
    """Words taken of every document by the weighted mix."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    """Token counts of all documents."""
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_url_filter(spark, sf_dir):
    """Verdicts on the urls of all pages."""
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op12_collocations(spark, sf_dir):
    """The best phrases of every language of all documents."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_html_extraction": op3_html_extraction,
    "op4_warc": op4_warc,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_url_filter": op11_url_filter,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op1_embedding_near_dedup": neardup.NEARDUP_SQL,
    "op2_exact_top_k": topk.TOP_K_SQL,
    "op5_jaccard_join": jaccard.LINK_SQL,
    "op9_mixing": mixing.MIX_SQL,
    "op11_url_filter": url_filter.URL_SQL,
    "op12_collocations": collocations.COLLOCATIONS_SQL,
    "op13_prefix_trie": prefix_trie.TRIE_SQL,
}
