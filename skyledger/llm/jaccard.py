"""Near-duplicate documents by an exact Jaccard join of their shingle sets.

The similarity is decided by signature trees (see ``signature_tree.py``), each
built in one task over a bounded number of sets. What leads sets to a common
tree is exact, so no link is lost:

1. Every document becomes a sorted set of shingle hashes; equal sets are one.
2. Shingles are dealt out by hash and counted. A set of which fewer than 80 %
   of the shingles occur in another set cannot be linked and goes no further.
3. The others are read again. In an order of shingles that all sets share
   (the most frequent last) two linked sets have a shingle in common among the
   first |A| - ceil(0.8 |A|) + 1 of each. Sets that share such a shingle and
   whose sizes are compatible, directly or through others, form a family.
4. Each family is joined by signature trees; a large one is dealt out to tiles
   and every pair of tiles has a tree of its own.
5. Trees return a spanning forest of their links, not all pairs; components of
   the forests are the classes.

Shingles travel packed, a chunk of documents and a range of hashes in one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import ragged
from skyledger.llm.components import components, roots
from skyledger.llm.inputs import pick, stored
from skyledger.llm.shingles import set_ids, shingle_sets
from skyledger.llm.signature_tree import Join

TOKENS, HEADER, REPLY, FREQUENT = 0, 1, 2, 3
# marks a number of sets in the place of a set's number
SEVERAL = np.uint32(1 << 31)
PART_SHINGLES = 1 << 22
ROW = "kind int, part int, chunk long, numbers binary, hashes binary, doc_ids array<long>, text_keys array<long>, sizes array<long>, set_ids array<long>"
ROW_NAMES = ["kind", "part", "chunk", "numbers", "hashes", "doc_ids", "text_keys", "sizes", "set_ids"]
ROW_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 4]


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _slices(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal values in a sorted array: value, start, end."""
    edges = np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys)) if len(keys) else np.zeros(1, np.int64)
    return [(int(keys[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _deal(docs: DataFrame, bits: int, width: int) -> DataFrame:
    """Per chunk of documents one header, and the shingles of its distinct sets by range of the hash.

    A shingle goes out once per chunk, with the number of its set, or with how
    many sets have it if these are several; that it is shared is then known here
    and replied at once. So copies of one shingle are at most as many as chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, keys = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist()
            for a, b in ragged.chunks(texts):
                tokens, sizes = shingle_sets(texts[a:b], width)
                names = set_ids(tokens, sizes)
                rows = [(HEADER, chunk % (1 << bits), chunk, None, None, ids[a:b], keys[a:b], sizes.tolist(), names.tolist())]
                distinct, first = np.unique(names, return_index=True)
                begin = (np.cumsum(sizes) - sizes)[first]
                numbers = np.repeat(np.arange(len(distinct), dtype=np.uint32), sizes[first])
                hashes = tokens[ragged.gather(begin, sizes[first])] >> np.uint64(32 - bits)
                order = np.argsort(hashes)
                ascending = hashes[order]
                at = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1])) if len(hashes) else np.zeros(0, np.int64)
                many = np.diff(np.append(at, len(hashes)))
                hot = np.flatnonzero(many > 1)
                copies = order[ragged.gather(at[hot], many[hot])]
                sets, times = np.unique(numbers[copies], return_counts=True)
                if len(sets):
                    rows.append((REPLY, chunk % (1 << bits), chunk, sets.tobytes(), times.astype(np.uint32).tobytes(), None, None, None, None))
                numbers[copies] = SEVERAL
                numbers[order[at[hot]]] |= many[hot].astype(np.uint32)
                kept = np.flatnonzero(numbers != SEVERAL)
                parts = (hashes[kept] >> np.uint64(32)).astype(np.int64)
                order = np.argsort(parts, kind="stable")
                kept, parts = kept[order], parts[order]
                numbers, low = numbers[kept], hashes[kept].astype(np.uint32)
                for part, x, y in _slices(parts):
                    rows.append((TOKENS, part, chunk, numbers[x:y].tobytes(), low[x:y].tobytes(), None, None, None, None))
                yield _table(rows, ROW_NAMES, ROW_TYPES)
                chunk += 1

    return docs.mapInArrow(ragged.tidy(run), ROW)


def _count(dealt: DataFrame, frequent: int, most: int) -> DataFrame:
    """Per part: for every chunk how many shingles of each set occur elsewhere too; the most frequent shingles; headers and replies as they are."""

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind"))
        headers = table.filter(pa.array(kinds != TOKENS))
        mine = table.filter(pa.array(kinds == TOKENS))
        rows: list[tuple] = []
        if mine.num_rows:
            part, chunks = mine.column("part")[0].as_py(), mine.column("chunk").to_pylist()
            numbers = [np.frombuffer(x, np.uint32) for x in mine.column("numbers").to_pylist()]
            hashes = np.concatenate([np.frombuffer(x, np.uint32) for x in mine.column("hashes").to_pylist()])
            values, inverse = np.unique(hashes, return_inverse=True)
            owners = np.concatenate(numbers)
            several = owners >= SEVERAL
            counts = np.bincount(inverse, np.where(several, owners ^ SEVERAL, 1), len(values)).astype(np.int64)
            shared = (counts[inverse] > 1) & ~several
            at = 0
            for chunk, owner in zip(chunks, numbers, strict=True):
                sets, times = np.unique(owner[shared[at : at + len(owner)]], return_counts=True)
                at += len(owner)
                if len(sets):
                    rows.append((REPLY, part, chunk, sets.tobytes(), times.astype(np.uint32).tobytes(), None, None, None, None))
            top = np.flatnonzero(counts >= frequent)
            top = top[np.argsort(-counts[top], kind="stable")[:most]]
            if len(top):
                rows.append((FREQUENT, part, None, counts[top].astype(np.uint32).tobytes(), values[top].tobytes(), None, None, None, None))
        return pa.concat_tables([headers, pa.Table.from_batches([_table(rows, ROW_NAMES, ROW_TYPES)], headers.schema)])

    return dealt.groupBy("part").applyInArrow(run, ROW)


def _sizes(counted: DataFrame) -> DataFrame:
    """Per document: doc_id, text_key, size of its set, set_id, and how many of the shingles occur elsewhere too."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        head = kinds.index(HEADER)
        names = np.array(table.column("set_ids")[head].as_py(), np.int64)
        distinct, inverse = np.unique(names, return_inverse=True)
        shared = np.zeros(len(distinct), np.int64)
        for kind, sets, times in zip(kinds, table.column("numbers").to_pylist(), table.column("hashes").to_pylist(), strict=True):
            if kind == REPLY:
                shared[np.frombuffer(sets, np.uint32)] += np.frombuffer(times, np.uint32)
        return pa.table({
            "doc_id": pa.array(table.column("doc_ids")[head].as_py(), pa.int64()), "text_key": pa.array(table.column("text_keys")[head].as_py(), pa.int64()), "size": pa.array(table.column("sizes")[head].as_py(), pa.int64()),
            "set_id": names, "shared": shared[inverse],
        })

    return counted.where(F.col("kind").isin(HEADER, REPLY)).groupBy("chunk").applyInArrow(run, "doc_id long, text_key long, size long, set_id long, shared long")


def _frequent(counted: DataFrame, bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, at most ``most`` of them: leading bits of the hash, ascending, and the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, counts, values in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                yield pa.RecordBatch.from_arrays([
                    pa.array((np.frombuffer(values, np.uint32).astype(np.int64) | (part << 32))), pa.array(np.frombuffer(counts, np.uint32).astype(np.int64)),
                ], names=["value", "times"])

    rows = counted.where(F.col("kind") == FREQUENT).select("part", "numbers", "hashes").mapInArrow(ragged.tidy(run), "value long, times long")
    top = rows.orderBy(F.desc("times"), "value").limit(most).toPandas().sort_values("value")
    return top["value"].to_numpy(np.uint64), top["times"].to_numpy(np.int64)


def _payload(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """set_id, size and sorted hashes of the wanted sets, each once, from the text of one document of ``wanted``.

    ``wanted`` names that document by id and text_key together, as one id (or
    null) may stand for several texts, and says how many rows have both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, asked = [t or "" for t in batch.column(0).to_pylist()], np.array(batch.column(1), np.int64)
            for a, b in ragged.chunks(texts):
                tokens, sizes = shingle_sets(texts[a:b], width)
                names = set_ids(tokens, sizes)
                edges = np.append(0, np.cumsum(sizes))
                rows = [(int(names[i]), int(sizes[i]), tokens[edges[i] : edges[i + 1]].tobytes()) for i in np.flatnonzero(names == asked[a:b])]
                yield _table(rows, ["set_id", "size", "tokens"], [pa.int64(), pa.int64(), pa.binary()])

    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["at_id"]) & (docs["text_key"] == wanted["at_key"]))
    texts = found.where("times = 1").select("text", "set_id")
    if wanted.where("times > 1").limit(1).count():
        repeated = found.where("times > 1").groupBy("set_id").agg(F.first("text").alias("text"))
        texts = texts.union(repeated.select("text", "set_id"))
    return texts.mapInArrow(ragged.tidy(run), "set_id long, size long, tokens binary")


def _family_edges(payload: DataFrame, hot: tuple[np.ndarray, np.ndarray], bits: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) between sets of compatible size that share one of their leading shingles."""
    names = ["part", "keys", "sizes", "set_ids"]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, sizes = np.array(batch.column(0), np.int64), np.array(batch.column(1), np.int64)
            blobs = batch.column(2).to_pylist()
            weight = np.cumsum(sizes)
            for a, b in ((x[0], x[-1] + 1) for x in np.split(np.arange(len(sets)), np.searchsorted(weight, np.arange(1_000_000, int(weight[-1]) if len(weight) else 0, 1_000_000))) if len(x)):
                tokens = np.concatenate([np.frombuffer(x, np.uint64) for x in blobs[a:b]])
                owner = np.repeat(np.arange(b - a), sizes[a:b])
                lead = tokens >> np.uint64(32 - bits)
                rank = np.zeros(len(tokens), np.int64)
                if len(hot[0]):
                    at = np.minimum(np.searchsorted(hot[0], lead), len(hot[0]) - 1)
                    rank = np.where(hot[0][at] == lead, hot[1][at], 0)
                order = np.lexsort((tokens, rank, owner))
                length = sizes[a:b] - -(-num * sizes[a:b] // den) + 1
                chosen = order[ragged.gather(np.cumsum(sizes[a:b]) - sizes[a:b], length)]
                parts = (lead[chosen] >> np.uint64(32)).astype(np.int64)
                order = np.argsort(parts, kind="stable")
                chosen = chosen[order]
                rows = [(p, tokens[chosen[x:y]].tobytes(), sizes[a:b][owner[chosen[x:y]]].tobytes(), sets[a:b][owner[chosen[x:y]]].tobytes())
                        for p, x, y in _slices(parts[order])]
                yield _table(rows, names, [pa.int32()] + [pa.binary()] * 3)

    def link(table: pa.Table) -> pa.Table:
        key, size, name = (np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in zip(names[1:], (np.uint64, np.int64, np.int64), strict=True))
        order = np.lexsort((size, key))
        key, size, name = key[order], size[order], name[order]
        near = np.flatnonzero((key[1:] == key[:-1]) & (num * size[1:] <= den * size[:-1]))
        distinct, place = np.unique(name, return_inverse=True)
        root = roots(len(distinct), place[near], place[near + 1])
        moved = root != np.arange(len(root))
        return pa.table({"a": distinct[moved], "b": distinct[root[moved]]})

    return (
        payload.mapInArrow(ragged.tidy(keys), "part int, keys binary, sizes binary, set_ids binary").groupBy("part").applyInArrow(link, "a long, b long")
    )


def shared_groups(sets: int, tokens: int, tile: int, tile_tokens: int) -> int:
    """Number of groups in which small families share trees: half a tile of sets or of shingles a group on average."""
    return max(1, 2 * sets // tile, 2 * tokens // tile_tokens)


def _tree_edges(payload: DataFrame, family: DataFrame, num: int, den: int, tile: int, tile_tokens: int) -> DataFrame:
    """A spanning forest (a, b) of the links inside the families."""
    held = payload.join(family.withColumnRenamed("node", "set_id"), "set_id")
    sizes = (
        payload.select("set_id", "size").join(family.withColumnRenamed("node", "set_id"), "set_id")
        .groupBy("root").agg(F.count("*").alias("sets"), F.sum("size").alias("tokens"))
        .select("root", "sets", "tokens", F.greatest(F.ceil(F.col("sets") / tile), F.ceil(F.col("tokens") / tile_tokens)).alias("tiles"))
    )
    sizes = stored(sizes)
    small = sizes.where("tiles <= 1").agg(F.sum("sets").alias("sets"), F.sum("tokens").alias("tokens")).first()
    groups = shared_groups(small.sets or 0, small.tokens or 0, tile, tile_tokens)
    placed = (
        held.join(sizes.select("root", "tiles"), "root")
        .withColumn("tile", F.when(F.col("tiles") > 1, F.pmod(F.xxhash64("set_id"), F.col("tiles"))).otherwise(0))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumn("group", F.when(F.col("tiles") > 1, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(groups))))
        .select("group", (F.col("tiles") > 1).alias("large"), F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"),
                "tile", "set_id", "size", "tokens")
    )

    def run(table: pa.Table) -> pa.Table:
        names, sizes, side = (np.array(table.column(c), np.int64) for c in ("set_id", "size", "tile"))
        tokens = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
        crossing = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        root = Join(tokens, sizes, num, den, side if crossing else None).run()
        moved = root != np.arange(len(root))
        return pa.table({"a": names[moved], "b": names[root[moved]]})

    return placed.groupBy("group", "large", "x", "y").applyInArrow(run, "a long, b long")


def link_documents(docs: DataFrame, width: int = 5, numerator: int = 4, denominator: int = 5, tile: int = 2000, tile_tokens: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents are linked when the Jaccard similarity of their sets of
    ``width``-word shingles is at least numerator / denominator; component_id is
    the smallest doc_id reachable by links, itself included. A text that is null
    or without words has no shingles, is linked with nothing and has its own id
    as component. Repeated rows stay repeated. A null doc_id takes part in the
    links but is never smallest; a component of null ids only has a null id.
    Other columns are left out; an empty table gives no rows.
    """
    linked = _linked(pick(docs, doc_id="long", text="string"), width, numerator, denominator, tile, tile_tokens)
    return linked.select("doc_id", "n_shingles", "component_id")


def _linked(docs: DataFrame, width: int = 5, numerator: int = 4, denominator: int = 5, tile: int = 2000, tile_tokens: int = 2_000_000) -> DataFrame:
    """The rows of ``link_documents`` with text_key and class, one number per component; texts without words have no class."""
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    letters = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word has two letters at least, with the blank behind it; parts hold a bounded number of shingles whatever the table's size
    bits = min(max(8, (2 * parallel - 1).bit_length(), (letters // 2 // PART_SHINGLES).bit_length()), 24)
    counted = stored(_count(_deal(docs, bits, width), frequent=8, most=max(1, (1 << 20) >> bits)))
    sized = stored(_sizes(counted))
    sets = (
        sized.where("size > 0").groupBy("set_id", "doc_id", "text_key").agg(F.count("*").alias("times"), F.max("shared").alias("shared"), F.first("size").alias("size"))
        .groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min(F.struct("times", "doc_id", "text_key")).alias("at"), F.max("shared").alias("shared"),
                               F.first("size").alias("size"))
    )
    wanted = stored(
        sets.where(F.col("shared") * denominator >= F.col("size") * numerator)
        .select("set_id", F.col("at.doc_id").alias("at_id"), F.col("at.text_key").alias("at_key"), "at.times")
    )
    payload = stored(_payload(docs, wanted, width))
    family = components(_family_edges(payload, _frequent(counted, bits, 1 << 18), bits, numerator, denominator))
    linked = components(_tree_edges(payload, family, numerator, denominator, tile, tile_tokens))
    classed = (
        sets.select("set_id", "rep").join(linked.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("set_id", "rep", F.coalesce("root", "set_id").alias("root"))
    )
    smallest = classed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_set = classed.join(smallest, "root").select("set_id", "component_id", F.col("root").alias("class"))
    own = ["doc_id", "text_key", F.col("size").alias("n_shingles")]
    worded = sized.where("size > 0").join(of_set, "set_id").select(*own, "component_id", "class")
    return worded.unionByName(sized.where("size = 0").select(*own, F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents whose id is the smallest of their class, with all their columns.

    Of rows of a class that repeat such an id one stays (the one with the smallest text).
    Of a class that has no id at all one row stays; texts without an id and
    without words are linked with nothing, so all of them stay.
    """
    linked = _linked(pick(docs, doc_id="long", text="string"), **options)
    named = linked.where("doc_id = component_id")
    # an id that stands once in its class names its row; only rows of repeated ones are compared
    rows_of = named.groupBy("doc_id", "class").agg(F.count("*").alias("rows"), F.min("text_key").alias("kept_key")).withColumnRenamed("doc_id", "kept_id")
    repeated = rows_of.where("rows > 1").select(F.col("kept_id").alias("again_id"), F.col("class").alias("again_class"))
    kept = named.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), "class").distinct().join(
        repeated, (F.col("kept_id") == F.col("again_id")) & F.col("class").eqNullSafe(F.col("again_class")), "left_semi")
    nameless = linked.where("component_id IS NULL")
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    keyed = plain.withColumn("_key", F.xxhash64(F.col(f"_c{text_at}").cast("string")))
    same = F.col("_key") == F.col("kept_key")
    others = [f"_c{i}" for i in range(len(docs.columns)) if i not in (id_at, text_at)]

    def one_row(rows: DataFrame, *key: str) -> DataFrame:
        single = rows.groupBy(*key).agg(F.min(F.struct(f"_c{text_at}", f"_c{id_at}", *others)).alias("row"))
        return single.select("row.*").select(*plain.columns)

    own_id = F.col(f"_c{id_at}") == F.col("kept_id")
    single = keyed.join(rows_of.where("rows = 1").select("kept_id", "kept_key"), own_id & same).select(*plain.columns)
    if repeated.limit(1).count():
        single = single.unionByName(one_row(keyed.join(kept, own_id & same), "kept_id", "class"))
    if nameless.limit(1).count():
        without_id = keyed.where(F.col(f"_c{id_at}").isNull())
        worded = nameless.where("n_shingles > 0").groupBy("class").agg(F.min("text_key").alias("kept_key")).select("kept_key")
        blank = nameless.where("n_shingles = 0").select(F.col("text_key").alias("kept_key")).distinct()
        single = single.unionByName(one_row(without_id.join(worded, same, "left_semi"), "_key"))
        single = single.unionByName(without_id.join(blank, same, "left_semi").drop("_key"))
    return single.toDF(*docs.columns)


LINK_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), sides AS (
  SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, s.b FROM reach r JOIN sides s ON r.b = s.a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
