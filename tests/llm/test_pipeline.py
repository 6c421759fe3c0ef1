"""The pipeline: stages against what their operators say, and the registered names."""

from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from skyledger.llm.inputs import written

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    from skyledger.llm import jaccard, quality, toxicity
    from skyledger.llm.inputs import read

    labels = read(spark, FOLDER, "labels")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, FOLDER)
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    assert clean.columns == COLUMNS
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in bad)
    good = stages["quality"](spark, docs, FOLDER)
    kept = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    assert good.columns == COLUMNS and {r.doc_id for r in good.collect()} == kept
    single = stages["jaccard_join"](spark, docs, FOLDER)
    classes = {r.component_id for r in jaccard.link_documents(docs).collect()}
    assert single.columns == COLUMNS and sorted(r.doc_id for r in single.collect()) == sorted(classes)
    assert stages["mixing"](spark, docs, FOLDER).columns == COLUMNS


def run_stages(spark, docs, folder):
    """Rows of every stage, each over what the one before kept, written and read again."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder))
        out[name] = docs
    return out


def test_odd_rows_pass_every_stage(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(odd)
    stages = run_stages(spark, docs, FOLDER)
    before = {tuple(r) for r in docs.collect()}
    for name in ("toxicity", "quality", "jaccard_join", "mixing"):
        assert stages[name].columns == COLUMNS and {tuple(r) for r in stages[name].collect()} <= before
        before = {tuple(r) for r in stages[name].collect()}
    assert {r.doc_id for r in stages["packing"].collect()} == {r[0] for r in before}


def test_clashing_columns_pass_every_stage(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(odd)
    plain = run_stages(spark, docs, FOLDER)
    wide = docs.select(
        "*", *[F.lit(7).alias(c) for c in ("label", "score", "rank", "slice", "size", "root", "key", "_copy", "kept_id")])
    for name, stage in corpus_pipeline.STAGES:
        wide = written(stage(spark, wide, FOLDER))
        if name != "packing":
            assert sorted(map(repr, wide.select(*COLUMNS).collect())) == sorted(map(repr, plain[name].collect()))


def test_empty_tables_pass_every_stage(spark, empty):
    assert all(df.count() == 0 for df in run_stages(spark, empty, FOLDER).values())


def test_without_labels_no_document_is_rejected(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for number, rows in enumerate((labels.limit(0), labels.withColumn("toxic", F.lit(0)).withColumn("quality", F.lit(1)), labels.select("doc_id", F.lit(None).cast("int").alias("toxic"), F.lit(None).cast("int").alias("quality")))):
        rows.write.parquet(str(tmp_path / str(number) / "labels.parquet"))
        stages = dict(corpus_pipeline.STAGES)
        for name in ("toxicity", "quality"):
            assert stages[name](spark, docs, str(tmp_path / str(number))).count() == docs.count()


def test_whole_run(spark):
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    fill = {}
    for p in pieces:
        fill[p.sequence_id] = fill.get(p.sequence_id, 0) + p.length
    assert pieces and all(n <= 4096 for n in fill.values())
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in fill.values())
    assert padding <= 0.02 * sum(fill.values())


def test_registered_names():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
