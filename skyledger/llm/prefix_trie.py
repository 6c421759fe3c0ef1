"""Conversation prefix trie with subtree totals by depth-band rollup.

Nothing here holds a conversation, a node's members or a node's children
together, so any of them may have a third of all rows:

- Turns are numbered by one range sort; a conversation that spans several of
  its parts gets the numbers of the earlier parts added.
- A node is named by its depth and 128 bits that combine the digests of its
  turns, each mixed with its place; running combinations are built per part and
  carried from part to part. Two different nodes of one depth share a name with
  odds of n^2 / 2^129 for n nodes.
- Subtree totals: a path is cut into bands of fixed height. A node's own amount
  goes to its ancestors within its band only. The tops of the bands form a trie
  of their own, one level up, whose totals are found in the same way; they then
  come down to the ancestors in the band above them. With bands of height H,
  both the copies of a row (H at most) and the rounds (the logarithm of the
  greatest depth to base H) are bounded.
- The ids of conversations that end at a node are sorted over the cluster and
  joined in blocks; only nodes with several blocks stream these through SHA-256,
  a block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.inputs import pick, stored

# fixed values: conversations of one family share a base, whose first turns (less than HEADS) they may take over
FAMILY, HEADS = 5, 9
BAND = 16
BLOCK_BITS = 16
NODE = ["depth", "x", "y"]


def _sorted_parts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in order of the keys, with ``at``: their number, and in its upper bits that of their part.

    The result is stored, as parts of another run might be cut elsewhere.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))


def _numbered(turns: DataFrame) -> DataFrame:
    """Own turns of every conversation with ``r``, their number from 1, ``part``, and ``base_turns``, the turns of the family's base."""
    rows = _sorted_parts(turns, "conv_id", "turn", "digest").withColumn("part", F.shiftright("at", 33))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("turns"))
    bases = parts.where((F.col("before") == 0) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    parts = parts.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    return rows.join(parts, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("before") + F.col("at") - F.col("first") + 1).alias("r"), "base", F.coalesce("base_turns", F.lit(0)).alias("base_turns"),
        "digest", "bytes")


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt_paths(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turns) of every rebuilt conversation, and its path: conv_id, depth from 1, node (x, y), parent (px, py), bytes."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    own = stored(_numbered(rows.select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))))
    convs = own.where("r = 1").select("conv_id", "base", heads(F.col("conv_id")).alias("h"))
    is_base, taken = F.col("conv_id") == F.col("base"), F.least(heads(F.col("conv_id")), "base_turns")
    kept = own.withColumn("h", heads(F.col("conv_id"))).where(is_base | (F.col("r") > F.col("h"))).select(
        "conv_id", "part", F.when(is_base, F.col("r")).otherwise(F.col("r") - F.col("h") + taken).alias("depth"), "digest", "bytes")
    lent = own.where(is_base & (F.col("r") < HEADS)).select(F.col("conv_id").alias("base"), F.col("r").alias("depth"), "digest", "bytes")
    lent = lent.join(convs.where(~is_base), "base").where("depth <= h").select("conv_id", F.lit(-1).cast("long").alias("part"), "depth", "digest", "bytes")
    steps = kept.unionByName(lent).select(
        "conv_id", "part", "depth", "bytes", F.xxhash64(F.lit(1), "depth", "digest").alias("u"), F.xxhash64(F.lit(2), "digest", "depth").alias("v"))
    parts = steps.groupBy("conv_id", "part").agg(F.bit_xor("u").alias("u"), F.bit_xor("v").alias("v"), F.max("depth").alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = parts.select("conv_id", "part", *[F.coalesce(F.bit_xor(c).over(earlier), zero).alias(f"{c}0") for c in "uv"])
    lengths = convs.join(parts.groupBy("conv_id").agg(F.max("turns").alias("turns")), "conv_id", "left").select(
        "conv_id", F.coalesce("turns", zero).alias("turns"))
    so_far = Window.partitionBy("conv_id", "part").orderBy("depth")
    running = steps.select("conv_id", "part", "depth", "bytes", "u", "v", F.bit_xor("u").over(so_far).alias("u1"), F.bit_xor("v").over(so_far).alias("v1"))
    x, y = F.col("u0").bitwiseXOR(F.col("u1")), F.col("v0").bitwiseXOR(F.col("v1"))
    paths = running.join(carried, ["conv_id", "part"]).select(
        "conv_id", "depth", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("u")).alias("px"), y.bitwiseXOR(F.col("v")).alias("py"), "bytes")
    return stored(lengths), stored(paths)


def _strips(paths: DataFrame, step: int, band: int) -> DataFrame:
    """conv_id, depth of the first, and ``names`` of the nodes at every ``step``-th depth, cut into bands; each band ends with the top of the next one.

    ``paths`` has the roots, too.
    """
    place = F.floor(F.col("depth") / step)
    top = F.floor(place / band)
    tops = F.when((place % band == 0) & (place > 0), F.array(top, top - 1)).otherwise(F.array(top))
    return (
        paths.where(F.col("depth") % step == 0).select("conv_id", F.explode(tops).alias("band"), F.struct(*NODE).alias("name"))
        .groupBy("conv_id", "band").agg(F.sort_array(F.collect_list("name")).alias("names"))
    )


def subtree_sums(nodes: DataFrame, paths: DataFrame, deepest: int, amounts: list[str], band: int = BAND) -> DataFrame:
    """Every node with its amounts summed over its subtree.

    ``nodes`` has conv_id, a member whose path goes through the node; ``paths``
    holds the nodes on the path of every such member, the roots included.
    """
    sums = [F.sum(a).alias(a) for a in amounts]
    levels, step, weights = [], 1, nodes.select(*NODE, *amounts)
    while True:
        of_level = nodes.where(F.col("depth") % step == 0).select("conv_id", "depth")
        # every node once, on the path of its own member, with the names above it in its band and, for a top, in the band above
        entries = _strips(paths, step, band).select("conv_id", F.posexplode("names").alias("i", "name"), "names")
        entries = entries.select("conv_id", F.col("name.depth").alias("depth"), F.col("name.x").alias("x"), F.col("name.y").alias("y"), "i", "names")
        entries = stored(entries.join(of_level, ["conv_id", "depth"]))
        inside = entries.where(F.col("i") < band).select(*NODE, F.explode(F.slice("names", 1, F.col("i") + 1)).alias("above"))
        partial = stored(inside.join(weights, NODE).groupBy("above").agg(*sums).select("above.*", *amounts))
        levels.append((partial, entries.where(F.col("i") == band).select(*NODE, F.explode(F.slice("names", 1, band)).alias("above"))))
        step *= band
        if step > deepest:
            break
        weights = partial.where(F.col("depth") % step == 0)
    totals = levels.pop()[0]
    while levels:
        partial, links = levels.pop()
        lower = links.join(totals, NODE).groupBy("above").agg(*sums).select("above.*", *amounts)
        totals = stored(partial.unionByName(lower).groupBy(*NODE).agg(*sums))
    return totals


def _stream_sha(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its blocks, which come in order, node after node; only the running state is held."""
    last, state = None, None

    def row() -> pa.RecordBatch:
        depth, x, y = last
        return pa.RecordBatch.from_pylist([{"depth": depth, "x": x, "y": y, "sha": state.hexdigest()}], SHA)

    for batch in blocks:
        for depth, x, y, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if (depth, x, y) != last:
                if last is not None:
                    yield row()
                last, state = (depth, x, y), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if last is not None:
        yield row()


SHA = pa.schema([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("sha", pa.string())])


def end_digests(ends: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Node and ``sha``: SHA-256 of its conv_ids in decimal, ascending, joined by commas."""
    rows = _sorted_parts(ends, *NODE, "conv_id")
    block = F.shiftright("at", block_bits)
    blocks = stored(
        rows.groupBy(*NODE, block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select(*NODE, "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    )
    one = blocks.groupBy(*NODE).agg(F.count("*").alias("blocks"))
    several = one.where("blocks > 1").drop("blocks")
    single = blocks.join(several, NODE, "left_anti").select(*NODE, F.sha2("ids", 256).alias("sha"))
    long_ = blocks.join(several, NODE, "left_semi").repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")
    return single.unionByName(long_.mapInArrow(_stream_sha, "depth long, x long, y long, sha string"))


def prefix_trie(conversations: DataFrame, band: int = BAND, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation's turns stand in order of turn, null first; turns with the
    same number in order of the MD5 of role and text, so repeated rows follow
    one another and count as turns of their own. A null role or text is empty.
    Rows without a conv_id belong to no conversation and are left out; other
    columns are, too. An empty table gives no rows: without a conversation there
    is no root.
    """
    lengths, paths = rebuilt_paths(conversations)
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "x", "y", "px", "py", "bytes")])
    paths = paths.unionByName(roots)
    nodes = stored(paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.min(c).alias(c) for c in ("px", "py", "bytes")]))
    parents = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    lower = nodes.where("depth > 0")
    children = lower.groupBy(*parents).agg(F.count("*").alias("n_children"))
    own = stored(nodes.join(children, NODE, "left").select(
        "conv_id", *NODE, "px", "py", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")))
    deepest = lengths.agg(F.max("turns")).first()[0] or 0
    totals = subtree_sums(own, paths, deepest, ["n_leaves", "saved_tokens"], band)
    ends = paths.join(lengths.select("conv_id", F.col("turns").alias("depth")), ["conv_id", "depth"]).select("conv_id", *NODE)
    digests = end_digests(ends, block_bits)
    # a node's parent has the same smallest member, unless the node is the first that its smallest member has to itself
    first = own.where("depth > 0").groupBy("conv_id").agg(F.min_by(F.struct((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")), "depth").alias("up"))
    above = first.select(F.col("conv_id").alias("member"), "up.*").join(nodes.select(F.col("conv_id").alias("above"), *NODE), NODE, "left")
    above = above.select(F.col("member").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "above")
    return (
        own.drop("n_leaves", "saved_tokens").join(totals, NODE).join(digests, NODE, "left").join(above, ["conv_id", "depth"], "left")
        .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                "saved_tokens", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    )


TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), rebuilt AS (
  SELECT c.conv_id, 0 AS side, r, role, text FROM convs c JOIN own o ON o.conv_id = c.base AND r <= h
  UNION ALL SELECT c.conv_id, 1, r, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND r > h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, r) AS depth, length(role) || ':' || role || length(text) || ':' || text AS step, strlen(text) AS bytes
  FROM rebuilt
), paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(step, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY depth, node
), links AS (
  SELECT DISTINCT a.depth, a.node, b.depth AS below_depth, b.node AS below
  FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth
), children AS (
  SELECT depth, node, count(*) - 1 AS n_children FROM links WHERE below_depth <= depth + 1 GROUP BY ALL
), sums AS (
  SELECT l.depth, l.node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
  FROM links l JOIN nodes n ON n.depth = below_depth AND n.node = below JOIN children c ON c.depth = below_depth AND c.node = below GROUP BY ALL
), lengths AS (
  SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), ends AS (
  SELECT depth, node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths JOIN lengths USING (conv_id, depth) GROUP BY depth, node
), parents AS (
  SELECT l.below_depth AS depth, l.below AS node, n.conv_id AS parent_conv_id
  FROM links l JOIN nodes n ON n.depth = l.depth AND n.node = l.node WHERE l.below_depth = l.depth + 1
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes JOIN children USING (depth, node) JOIN sums USING (depth, node) LEFT JOIN parents USING (depth, node) LEFT JOIN ends USING (depth, node)
"""
