"""Token counts and packing against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import bpe, packing, token_counts

PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")]
LIBRARY = {path: Tokenizer.from_file(path) for path in PATHS}


def ids(text, path):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", PATHS)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40) | st.text(" \n'stremld!1aA", max_size=30), max_size=6))
def test_ids_equal_the_library(path, texts):
    flat, sizes = bpe.encode(texts, path)
    expected = [ids(t, path) for t in texts]
    assert sizes.tolist() == [len(e) for e in expected] == bpe.count(texts, path).tolist()
    assert flat.tolist() == [i for e in expected for i in e]


def test_repeated_symbols_merge_from_the_left():
    for path in PATHS:
        texts = ["a" * n for n in range(40)] + ["ha" * n for n in range(20)]
        assert bpe.count(texts, path).tolist() == [len(ids(t, path)) for t in texts]


def test_a_full_cache_is_dropped():
    known = bpe.Known(bpe.merger(PATHS[0]), most=3)
    text = np.array([ord(c) for c in "ab cd ef"], np.uint32)
    for a, b in ((0, 2), (3, 5), (6, 8), (0, 2)):
        at = known.places(np.array([a + 1], np.uint64), np.zeros(1, np.int64), text, np.array([a]), np.array([b]))
        part = known.ids()[known.begin[at[0]] : known.begin[at[0]] + known.sizes[at[0]]]
        assert part.tolist() == ids("".join(chr(c) for c in text[a:b]), PATHS[0])


def test_counts_of_odd_rows(odd, empty, clashing):
    rows = [tuple(r) for r in token_counts.count_tokens(odd, PATHS[0]).collect()]
    expected = [(r.doc_id, len((r.text or "").encode()), len(ids(r.text or "", PATHS[0]))) for r in odd.collect()]
    assert sorted(rows, key=repr) == sorted(((*e, e[2] > 512) for e in expected), key=repr)
    other = clashing(odd, "n_tokens", "over_limit")
    assert sorted(map(tuple, token_counts.count_tokens(other, PATHS[0]).collect()), key=repr) == sorted(rows, key=repr)
    assert token_counts.count_tokens(empty, PATHS[0]).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.integers(0, 20))
def test_plans_hold_every_id_once(lengths, slack):
    sequences = packing.plan(np.array(lengths, np.int64), 100, slack)
    seen = {(n, i) for s in sequences for n, start, length in s for i in range(start, start + length)}
    assert len(seen) == sum(lengths) == sum(length for s in sequences for _, _, length in s)
    for s in sequences:
        fill = sum(length for _, _, length in s)
        assert fill == 100 or 100 - fill <= slack or fill & (fill - 1) == 0


def test_best_fit_takes_the_tightest_window():
    assert packing.best_fit([60, 70, 25, 40], 100) == [[1, 2], [0, 3]]


def test_packing_of_odd_rows(odd, empty, clashing):
    path = PATHS[1]
    pieces = packing.pack(clashing(odd, "start", "offset"), path).collect()
    assert packing.pack(empty, path).count() == 0
    total = sum(len(ids(r.text or "", path)) + 1 for r in odd.collect())
    assert sum(p.length for p in pieces) == total
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    documents = {}
    for p in pieces:
        documents.setdefault(p.doc_id, []).append(p)
    for doc_id in (1, 3, 8, 9):
        text = next(r.text for r in odd.collect() if r.doc_id == doc_id)
        parts = sorted(documents[doc_id], key=lambda p: p.start)
        held = b"".join(p.ids for p in parts)
        assert np.frombuffer(held, "<u4").tolist() == [*ids(text or "", path), 2]
        assert all(p.doc_tokens == len(held) // 4 for p in parts)
    places = {}
    for p in pieces:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
