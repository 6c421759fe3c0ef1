"""Mixing sources to target weights by Pareto order sampling.

Every document of a source is expected to be taken target / source size times.
The whole part is allocated for certain; for the rest documents are ranked by
random odds divided by inclusion odds, and the lowest ranks are taken until the
words still missing are reached, so the size of each source's sample is fixed.
Inclusion is the same for all documents of a source and ranks are compared only
inside a source, so there the order is plain random order.

Ranks are never sorted as a whole: words are summed per source and slice of the
rank, which finds the one slice in which a source's sample ends, and only the
documents of that slice are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.inputs import pick, stored

# fixed value: a word as the sizes count it
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size and target of every source.

    Sources in order of code points, null last, weigh ``weights`` in turn and
    share ``share`` times all words; a target stops at ``most`` times its
    source's size and the excess goes to the others by weight. The fixed point
    is found at once: sources ordered by bound per weight are bounded up to the
    first whose bound is over its share of what is left.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")).cast("long")
    ordered = Window.orderBy("per_weight", "turn")
    before, onward = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy()
    return (
        totals.withColumns({"weight": weight, "turn": turn, "bound": F.col("source_size") * most})
        .withColumn("per_weight", F.col("bound") / F.col("weight"))
        .withColumn("pool", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("pool") - F.coalesce(F.sum("bound").over(before), F.lit(0))) / F.sum("weight").over(onward))
        .withColumn("bounded", F.col("per_weight") <= F.col("level"))
        .withColumn("taken", F.coalesce(F.sum(F.when(F.col("bounded"), F.col("bound"))).over(everything), F.lit(0)))
        .withColumn("open_weight", F.sum(F.when(~F.col("bounded"), F.col("weight"))).over(everything))
        .select("source", "source_size", F.when(F.col("bounded"), F.col("bound").cast("double"))
                .otherwise((F.col("pool") - F.col("taken")) / F.col("open_weight") * F.col("weight")).alias("target"))
    )


# a plan of the sources up to this many bytes goes to all tasks; beyond it rows and plan are joined by a shuffle
PLAN_BYTES = 32_000_000


def _chance(seed: str) -> Column:
    """A random number in (0, 1) that follows from seed, id and text, so rows that repeat an id, or have none, have numbers of their own."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") + 1) / F.lit(float(2**48 + 2))


def _ranked(rows: DataFrame, targets: DataFrame, slices: int) -> DataFrame:
    """Rows (doc_id, source, size, chance) with their source's target, whole copies and words still missing, and their rank and slice of the ranks."""
    chance = F.col("chance")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("whole_copies", F.floor(expected).cast("long"))
        .withColumn("missing", F.round("target").cast("long") - F.col("whole_copies") * F.col("source_size"))
        .withColumn("inclusion", expected - F.col("whole_copies"))
        .withColumn("rank", F.when(F.col("inclusion") > 0, (chance / (1 - chance)) / (F.col("inclusion") / (1 - F.col("inclusion")))))
        .withColumn("slice", F.when(F.col("rank").isNull(), slices).otherwise(F.floor(F.col("rank") / (1 + F.col("rank")) * slices)).cast("int"))
    )


def _edges(ranked: DataFrame) -> DataFrame:
    """Per source with words missing: the slice in which its sample ends, and the words wanted of it."""
    sums = ranked.groupBy("source", "slice", "missing").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    return (
        sums.withColumn("reached", running)
        .where((F.col("reached") >= F.col("missing")) & (F.col("reached") - F.col("words") < F.col("missing")))
        .select(F.col("source").alias("edge_source"), F.col("slice").alias("edge"), (F.col("missing") - F.col("reached") + F.col("words")).alias("wanted"))
    )


def _sized(docs: DataFrame, seed: str, carry: dict[str, str] | None = None) -> DataFrame:
    rows = pick(docs, **{"doc_id": "long", "source": "string", "text": "string"} | (carry or {}))
    kept = [c for c in carry or {} if c not in ("doc_id", "source", "size")]
    return stored(rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), _chance(seed).alias("chance"), *kept))


def _targets(sized: DataFrame) -> DataFrame:
    return source_targets(sized).select(F.col("source").alias("of_source"), "source_size", "target")


def mix(docs: DataFrame, seed: str = "mix", slices: int = 4096, carry: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (both of its source), taken, whole_copies, and columns to ``carry`` (name to type).

    ``taken`` counts the words the mix takes of the document: its size times the
    whole copies, plus its size if it is sampled; the document at the edge of a
    source's sample gives the words still missing. The random numbers depend on
    seed, doc_id and text alone, so reruns agree, and rows that repeat both are
    ranked side by side. A null text has size 0; a null source is a source of its
    own; null doc_ids take part like any other; other columns are left out; an
    empty table gives no rows.
    """
    sized = _sized(docs, seed, carry)
    ranked = _ranked(sized, _targets(sized), slices)
    placed = ranked.join(_edges(ranked), F.col("source").eqNullSafe(F.col("edge_source")), "left")
    at_edge = F.col("slice") == F.col("edge")
    inner = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    close = (
        placed.where(at_edge)
        .withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
        .withColumn("sampled", F.greatest(F.lit(0), F.least(F.col("size"), F.col("wanted") - F.col("before"))))
    )
    rest = placed.where(~at_edge | F.col("edge").isNull()).withColumn("sampled", F.when(F.col("slice") < F.col("edge"), F.col("size")).otherwise(0))
    columns = ["doc_id", "size", "source_size", "target", (F.col("whole_copies") * F.col("size") + F.col("sampled")).cast("long").alias("taken"), "whole_copies",
               *(c for c in carry or {} if c not in ("doc_id", "size"))]
    return rest.select(*columns).unionByName(close.select(*columns))


def source_plan(sized: DataFrame, slices: int = 4096) -> DataFrame:
    """One row per source: target, sizes, and the place (rank, id, size) of the last document of its sample, which gives ``last_words``.

    Documents before that place are sampled whole. Rows that share rank, id and
    size share the place; ``last_words`` is then meant for all of them together,
    ``last_size`` words in ``last_rows`` rows.
    """
    targets = _targets(sized)
    ranked = _ranked(sized, targets, slices)
    close = ranked.join(_edges(ranked), F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("slice") == F.col("edge")))
    # rows that cannot be told apart are one place, so a source's many repeated rows are one row here
    places = close.groupBy("source", "wanted", F.struct("rank", "doc_id", "size").alias("place")).agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    inner = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        places.withColumn("left", F.col("wanted") - F.coalesce(F.sum("words").over(inner), F.lit(0)))
        .where((F.col("left") > 0) & (F.col("left") <= F.col("words")))
        .select(F.col("source").alias("last_source"), F.col("place").alias("last"), F.col("left").alias("last_words"), F.col("words").alias("last_size"), F.col("rows").alias("last_rows"))
    )
    return stored(targets.join(last, F.col("of_source").eqNullSafe(F.col("last_source")), "left").drop("last_source"))


def mixed_documents(docs: DataFrame, whole_only: bool = False, seed: str = "mix", slices: int = 4096, plan_bytes: int = PLAN_BYTES) -> DataFrame:
    """The documents as often as the mix takes them: copies are repeated rows.

    The columns are those of documents. Documents without words come as often as
    their source's whole copies. With ``whole_only`` no text is cut: the
    document at the end of a source's sample is taken or left whole, whichever
    brings the source nearer to its target; else it gives its first words, those
    still missing, and n_chars is counted anew. Rows that repeat its id and size
    are taken or left together. Null texts, sources and ids are treated as in
    ``mix``; an empty table gives no rows.

    Sizes and ids alone decide, and leave one row per source. With that row
    every document's copies follow from itself, so texts are not shuffled unless
    the plan of the sources is too large to send to all tasks.
    """
    columns = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    plan = source_plan(_sized(docs, seed), slices)
    weight = plan.agg(F.sum(F.coalesce(F.octet_length("of_source"), F.lit(0)) + 100)).first()[0] or 0
    rows = pick(docs, **columns).withColumns({"size": word_count(F.col("text")), "chance": _chance(seed)})
    ranked = _ranked(rows, F.broadcast(plan) if weight <= plan_bytes else plan, slices)
    place = F.struct("rank", "doc_id", "size")
    # ranks are null where nothing is missing, and then nothing is sampled
    open_ = (F.col("size") > 0) & F.col("rank").isNotNull()
    is_last = open_ & (place == F.col("last"))
    cut = F.lit(False) if whole_only else is_last & (F.col("last_rows") == 1) & (F.col("last_words") < F.col("size"))
    sampled = F.when(open_ & (place < F.col("last")), 1).when(is_last & ~cut & (2 * F.col("last_words") >= F.col("last_size")), 1).otherwise(0)
    times = (F.col("whole_copies") + sampled).cast("int")
    whole = ["doc_id", "text", "lang", "source", "n_chars"]
    if whole_only:
        return ranked.select(*whole, F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")).drop("_copy")
    # the text behind the last word to keep is what a split into one part more leaves over; white space in front makes an empty first part
    more = F.when(cut, F.col("last_words")).otherwise(0).cast("int")
    rest = F.element_at(F.split("text", r"[\x20\x09-\x0D]+", more + 1 + F.col("text").rlike(r"^[\x20\x09-\x0D]").cast("int")), -1)
    part = F.expr("substring(text, 1, length(text) - length(rest))")
    copies = F.concat(
        F.array_repeat(F.struct("text", "n_chars"), F.col("times")),
        F.when(F.col("more") > 0, F.array(F.struct(part.alias("text"), F.length(part).cast("long").alias("n_chars")))).otherwise(F.array()),
    )
    return (
        ranked.withColumns({"times": times, "more": more}).withColumn("rest", F.when(F.col("more") > 0, rest).otherwise(""))
        .select("doc_id", "lang", "source", F.explode(copies).alias("copy")).select("doc_id", "copy.text", "lang", "source", "copy.n_chars")
    )


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(text, '')) AS mark FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS turn FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS bound,
         1.5::DOUBLE * sum(source_size) OVER () AS pool FROM totals
), levels AS (
  SELECT *, bound::DOUBLE / weight AS per_weight,
         (pool - coalesce(sum(bound) OVER (ORDER BY bound::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER (ORDER BY bound::DOUBLE / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN per_weight <= level THEN bound::DOUBLE
         ELSE (pool - coalesce(sum(CASE WHEN per_weight <= level THEN bound END) OVER (), 0)::DOUBLE)
              / (sum(CASE WHEN per_weight > level THEN weight END) OVER ())::DOUBLE * weight END AS target FROM levels
), expected AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
         (('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || mark), 1, 12))::BIGINT + 1)::DOUBLE / 281474976710658::DOUBLE AS chance
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, floor(e)::BIGINT AS whole_copies, round(target)::BIGINT - floor(e)::BIGINT * source_size AS missing,
         CASE WHEN e - floor(e) > 0 THEN (chance / (1 - chance)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS rank FROM expected
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank ASC NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ranked
)
SELECT doc_id, size, source_size, target, CAST(whole_copies * size + greatest(0, least(size, missing - before)) AS BIGINT) AS taken, whole_copies FROM placed
"""
