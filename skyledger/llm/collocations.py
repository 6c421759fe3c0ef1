"""Phrase collocations by mergeable Misra-Gries summaries and an exact second pass.

First pass: every n-gram is a 64-bit hash. Its leading bits name the hash
partition, the next 32 its key there. Tasks combine what they meet and send each
partition one summary at a time, never occurrences. A partition with mass M
merges them into a Misra-Gries summary of more than M / threshold counters. Such
a summary undercounts by less than the threshold, so every n-gram that reaches
it survives; the survivors of all partitions make a bitmap of bounded size. It
passes the driver deflated, a stretch per partition, and is opened in the tasks.

Second pass: n-grams whose bit is set are counted exactly, as words. Hashes that
share a bit only cost work there, they change no count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import ragged
from skyledger.llm.inputs import pick, stored

# fixed values: bytes that end a piece, and bytes that stand between words
BREAKS = [*b".,;:!?", *range(0x0A, 0x0E)]
BLANKS = [0x20, 0x09]
UNKNOWN = "und"

BITMAP_BITS = 27
LEAST_BITS = 10
PARTITION_MASS = 1 << 22
CHUNK_BYTES = 1_000_000
BUFFER = 4_000_000
LANES = 64
TASK_BYTES = 1 << 28

_KIND = np.zeros(256, np.uint8)
_KIND[BREAKS], _KIND[BLANKS] = 2, 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Tokens(NamedTuple):
    """Words of a chunk: each one's number and how many words of its piece follow it; the word and language of each number."""

    ids: np.ndarray
    left: np.ndarray
    words: pa.Array
    lang: np.ndarray
    names: list[str]


def tokens(texts: list[bytes], langs: list[str]) -> Tokens:
    """Words of all texts; the same word of two languages has two numbers."""
    offsets = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
    letters = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    kind = _KIND[letters]
    starts, ends = ragged.words(kind > 0, offsets)
    solid = letters[kind == 0]
    lengths = np.append(0, np.cumsum(ends - starts))
    flat = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(solid)])
    coded = flat.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    breaks = np.zeros(len(letters) + 1, np.int64)
    np.cumsum(kind == 2, out=breaks[1:])
    text = np.searchsorted(offsets, starts, side="right") - 1
    numbered = {name: i for i, name in enumerate(dict.fromkeys(langs))}
    lang = np.array([numbered[x] for x in langs], np.int64)[text]
    # a piece is left behind at each break and at each new text
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = (breaks[starts[1:]] != breaks[starts[:-1]]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(starts)) - 1
    size = max(len(coded.dictionary), 1)
    distinct, ids = np.unique(lang * size + numbers, return_inverse=True)
    return Tokens(ids, left, coded.dictionary.take(pa.array(distinct % size)), distinct // size, list(numbered))


def _hashed(values: list[bytes]) -> np.ndarray:
    offsets = np.append(0, np.cumsum([len(v) for v in values], dtype=np.int64))
    return ragged.span_hash(np.frombuffer(b"".join(values), np.uint8), offsets[:-1], offsets[1:])


def gram_hashes(chunk: Tokens, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 on: the places where such n-grams begin, and their hashes."""
    seeds = ragged.mix(_hashed([name.encode("utf-8", "surrogatepass") for name in chunk.names]))
    word = ragged.mix(_hashed(chunk.words.to_pylist()) ^ seeds[chunk.lang])
    at, value = np.arange(len(chunk.ids)), word[chunk.ids]
    yield at, value
    for size in range(2, longest + 1):
        go_on = chunk.left[at] >= size - 1
        at = at[go_on]
        value = ragged.mix(value[go_on] * np.uint64(0x9E3779B97F4A7C15) + word[chunk.ids[at + size - 1]])
        yield at, value


def _chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[Tokens]:
    """Words of texts with ``limit`` bytes together (one text at least)."""
    texts, langs, held = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            data = text.as_buffer().to_pybytes()
            if held and held + len(data) > limit:
                yield tokens(texts, langs)
                texts, langs, held = [], [], 0
            texts.append(data)
            langs.append(lang)
            held += len(data)
    if texts:
        yield tokens(texts, langs)


# --- first pass -------------------------------------------------------------------


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, their first bytes together, then the second ones and so on: what is mostly zero compresses well."""
    return np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(np.uint32).ravel(), dtype=np.uint32)


def _summaries(hashes: np.ndarray, bits: int) -> Iterator[tuple]:
    """From ascending hashes one row per partition: its number, keys met once, keys met more often, and how often."""
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    edges = np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]])
    for part in np.flatnonzero(np.diff(edges)):
        own = ((hashes[edges[part] : edges[part + 1]] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts, keys = np.diff(np.append(at, len(own))), own[at]
        yield int(part), _pack(keys[counts == 1]), _pack(keys[counts > 1]), counts[counts > 1].astype(np.uint32).tobytes()


SUMMARY = pa.schema([("part", pa.int64()), ("once", pa.binary()), ("more", pa.binary()), ("counts", pa.binary())])


def _send_summaries(longest: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            hashes = np.concatenate(buffer)
            buffer.clear()
            hashes.sort()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*_summaries(hashes, bits)), SUMMARY)], schema=SUMMARY)

        buffer, held = [], 0
        for chunk in _chunks(batches):
            for _, value in gram_hashes(chunk, longest):
                buffer.append(value)
                held += len(value)
            if held > BUFFER:
                yield flush()
                held = 0
        if held:
            yield flush()

    return send


def merge(keys: np.ndarray, counts: np.ndarray, more_keys: np.ndarray, more_counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Two Misra-Gries summaries as one of at most ``capacity`` counters, and by how much all counters were lowered."""
    keys, place = np.unique(np.concatenate([keys, more_keys]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([counts, more_counts]), len(keys)).astype(np.int64)
    lowered = 0
    if len(counts) > capacity:
        lowered = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        counts = counts - lowered
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts, lowered


def survivors(summaries: list[tuple[np.ndarray, np.ndarray]], threshold: int) -> np.ndarray:
    """Keys whose count may reach the threshold; none that reaches it is missing."""
    mass = sum(int(c.sum()) for _, c in summaries)
    capacity = mass // threshold + 1
    keys, counts, lowered = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    waiting, held = [], 0
    for i, (k, c) in enumerate(summaries, 1):
        waiting.append((k, c))
        held += len(k)
        if held > 2 * capacity or i == len(summaries):
            keys, counts, less = merge(keys, counts, np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), capacity)
            lowered += less
            waiting, held = [], 0
    return keys[counts + lowered >= threshold]


class Bitmap(NamedTuple):
    """2^size bits as deflated stretches of 2^width bits each; a missing stretch has no bit set."""

    size: int
    width: int
    stretches: dict[int, bytes]

    def opened(self) -> np.ndarray:
        """The bits, eight to a byte, the lowest first."""
        whole, step = np.zeros(1 << self.size - 3, np.uint8), 1 << self.width - 3
        for part, data in self.stretches.items():
            whole[part * step : (part + 1) * step] = np.frombuffer(zlib.decompress(data), np.uint8)
        return whole


def _segments(bits: int, bitmap_bits: int, threshold: int):
    """The stretch of the bitmap that belongs to a hash partition, deflated."""
    width = bitmap_bits - bits

    def segment(table: pa.Table) -> pa.Table:
        parts = []
        for once, more, counts in zip(*(table.column(c).to_pylist() for c in ("once", "more", "counts"))):
            single = _unpack(once)
            parts.append((np.concatenate([single, _unpack(more)]), np.concatenate([np.ones(len(single), np.int64), np.frombuffer(counts, np.uint32).astype(np.int64)])))
        flags = np.zeros(1 << width, bool)
        flags[survivors(parts, threshold) >> np.uint32(32 - width)] = True
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64()), "bits": pa.array([zlib.compress(np.packbits(flags, bitorder="little"), 1)], pa.binary())})

    return segment


def frequent_bitmap(docs: DataFrame, letters: int, longest: int, threshold: int, bitmap_bits: int = BITMAP_BITS, partition_mass: int = PARTITION_MASS) -> Bitmap:
    """Up to 2^bitmap_bits bits; that of the leading bits of an n-gram's hash is set if the n-gram may occur ``threshold`` times.

    Fewer bits for a small table: four for each n-gram that its letters can
    repeat so often. The deflated stretches of all partitions come to the
    driver, which does not open them: these bits at most, whatever the table's
    size.
    """
    # words have two bytes at least, with the blank behind them
    mass = letters * longest // 2
    size = min(bitmap_bits, max(LEAST_BITS, (4 * mass // threshold).bit_length()))
    bits = min(max(0, (mass // partition_mass).bit_length()), size - 3)
    sent = docs.mapInArrow(ragged.tidy(_send_summaries(longest, bits)), "part long, once binary, more binary, counts binary")
    rows = sent.groupBy("part").applyInArrow(_segments(bits, size, threshold), "part long, bits binary").collect()
    return Bitmap(size, size - bits, {part: bytes(data) for part, data in rows})


# --- second pass ------------------------------------------------------------------

COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])
SLICE = 1 << 16


def _count_frequent(longest: int, shared):
    """Counts per chunk of n-grams whose bit is set, and of all words (phrase null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, shift = shared.value.opened(), np.uint64(64 - shared.value.size)
        for chunk in _chunks(batches):
            names, kinds = pa.array(chunk.names, pa.string()), len(chunk.lang)
            sums = np.bincount(chunk.lang[chunk.ids], minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.nulls(len(names), pa.string()), pa.array(sums)], schema=COUNTS)
            words = chunk.words.cast(pa.large_string())
            for size, (at, value) in enumerate(gram_hashes(chunk, longest), 1):
                bit = value >> shift
                at = at[(bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if not len(at):
                    continue
                # numbers for equal sequences of words, one word more at a time
                number = chunk.ids[at]
                for k in range(1, size):
                    number = np.unique(number * kinds + chunk.ids[at + k], return_inverse=True)[1]
                _, first, n = np.unique(number, return_index=True, return_counts=True)
                for i in range(0, len(first), SLICE):
                    begin = at[first[i : i + SLICE]]
                    spans = [words.take(pa.array(chunk.ids[begin + k])) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*spans, pa.scalar(" ", pa.large_string())) if size > 1 else spans[0]
                    lang = names.take(pa.array(chunk.lang[chunk.ids[begin]]))
                    yield pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(n[i : i + SLICE].astype(np.int64))], schema=COUNTS)

    return count


def gram_counts(docs: DataFrame, longest: int, threshold: int, bitmap_bits: int = BITMAP_BITS, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """lang, phrase, a: all n-grams of up to ``longest`` words that occur ``threshold`` times, and all words together (phrase null)."""
    context = docs.sparkSession.sparkContext
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = context.broadcast(frequent_bitmap(docs, letters, longest, threshold, bitmap_bits, partition_mass))
    # a frequent phrase leaves a task once: fewer, larger tasks send less
    tasks = max(2 * context.defaultParallelism, -(-letters // TASK_BYTES))
    met = docs.coalesce(tasks).mapInArrow(ragged.tidy(_count_frequent(longest, shared)), "lang string, phrase string, a long")
    return met.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where((F.col("a") >= threshold) | F.col("phrase").isNull())


def collocations(docs: DataFrame, longest: int = 3, threshold: int = 10, covered: int = 50, first: int = 2000, **options) -> DataFrame:
    """The ``first`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Phrases of two to ``longest`` words, at least ``threshold`` times in all;
    the score floor(10^6 a^2 / (l r)) is that of the lowest cut, exact in
    decimals (counts up to 10^16, beyond which Spark raises an error). A phrase
    inside a longer candidate with ``covered`` percent of its count is dropped.
    A null lang is ``und``; null and empty texts have no words; repeated rows
    count as often as they stand; doc_id and other columns are left out; an
    empty table, or one without phrases, gives no rows. Ties in score are put in
    order by count, then by the phrase's bytes.
    """
    rows = pick(docs, text="string", lang="string").select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    counts = stored(gram_counts(rows, longest, threshold, **options))
    # no word holds a blank
    grams = counts.where("phrase IS NOT NULL").withColumn("words", F.size(F.split("phrase", " ")))
    candidates = grams.where("words > 1")
    # parts of a cut are expressions of phrase and k, so that no row carries its words twice through a shuffle
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    left, right = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring(phrase, length(substring_index(phrase, ' ', k)) + 2)")
    for side, part in (("l", left), ("r", right)):
        known = grams.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias(side))
        cuts = cuts.join(known, (F.col("lang") == F.col("of")) & (part == F.col("part"))).drop("of", "part")
    whole = "decimal(38,0)"
    score = F.expr(f"cast(1000000 as {whole}) * cast(a as {whole}) * cast(a as {whole}) div (cast(l as {whole}) * cast(r as {whole}))")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    # every shorter phrase inside a candidate: from each start, of each size below its own
    inner = candidates.where("words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("parts"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")).select(
        "lang", "a", "parts", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("start"))
    shorter = F.array_join(F.slice("parts", F.col("start"), F.col("size")), " ")
    longer = inner.groupBy("lang", shorter.alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    # first in lanes, so that what the many tasks of a language keep does not meet in one
    order = [F.desc("best.score"), F.desc("a"), F.asc("phrase")]
    lane = F.pmod(F.xxhash64("phrase"), F.lit(LANES))
    kept = kept.withColumn("lane", lane).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lane").orderBy(*order))).where(F.col("rank") <= first)
    listed = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    totals = counts.where("phrase IS NULL").select("lang", F.col("a").alias("n"))
    return listed.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")


COLLOCATIONS_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS place, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')), '[^\x20\x09]+') AS w FROM texts
), grams AS (
  SELECT lang, w[i] AS phrase, 1 AS words FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM pieces)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM pieces)
), f AS (
  SELECT lang, phrase, words, count(*)::HUGEINT AS a FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10
), cuts AS (
  SELECT lang, phrase, words, a, 1 AS k, w[1] AS part, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, phrase, words, a, 2, array_to_string(w[:2], ' '), w[3] FROM candidates WHERE words = 3
), scored AS (
  SELECT c.lang, c.phrase, c.words, c.a, k, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = part JOIN f y ON y.lang = c.lang AND y.phrase = rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE words = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE words = 3) GROUP BY ALL
), ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.phrase) AS rank
  FROM lowest c LEFT JOIN longer t ON t.lang = c.lang AND t.phrase = c.phrase WHERE t.a IS NULL OR 100 * t.a < 50 * c.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
