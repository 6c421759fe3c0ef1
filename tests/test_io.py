"""Readers and writers: round trips, stored results, the pipeline."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyledger.operators import result_tables, sinks
from skyledger.plans.pipeline import CSV_REPORTS, run_pipeline
from skyledger.plans.folders import shared_folder
from skyledger.schema import READINGS_COLUMNS, READINGS_SCHEMA, readings_schema
from skyledger.sources import readings as source, results, star

TEXT_ID = readings_schema(record_id=StringType())


def same_rows(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_schema():
    assert len(READINGS_COLUMNS) == 49 == len(READINGS_SCHEMA)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_readings_round_trip(spark, readings, tmp_path, fmt):
    path = str(tmp_path / fmt)
    assert sinks.write_readings(readings, path, fmt, max_rows=1000) == readings.count()
    same_rows(source.scan_readings(spark, path, fmt, TEXT_ID), readings)
    assert len(list(Path(path).glob("part-*"))) >= 6


def test_partitioned_readings(spark, readings, tmp_path):
    path = str(tmp_path / "by-year")
    sinks.write_readings(readings, path, "parquet", partition_by=["year"])
    plan = spark.read.parquet(path).filter("year = 1997").groupBy("country").count()
    assert "PartitionFilters: [isnotnull(year" in plan._jdf.queryExecution().toString()


def test_csv_with_empty_and_malformed_fields(spark, tmp_path):
    header = ",".join(READINGS_COLUMNS)
    rows = []
    for number, (pm, when) in enumerate([("12.5", "2020-01-01 03:00:00"), ("", "2020-01-01 03:00:00"), ("abc", "no time")], 1):
        values = {"record_id": str(number), "PM2_5": pm, "timestamp": when, "country": "A"}
        rows.append(",".join(values.get(c, "") for c in READINGS_COLUMNS))
    (tmp_path / "air_part_001.csv").write_text("\n".join([header, *rows[:2]]) + "\n")
    (tmp_path / "air_part_002.csv").write_text("\n".join([header, rows[2]]) + "\n")
    df = source.scan_readings(spark, str(tmp_path / "air_part_*.csv"), with_source_file=True)
    got = {r["record_id"]: (r["PM2_5"], r["timestamp"] is None, r["city"]) for r in df.collect()}
    assert got == {1: (12.5, False, None), 2: (None, False, None), 3: (None, True, None)}
    assert df.select(source.PART_COLUMN).distinct().count() == 2
    assert source.scan_profile(df).first()["row_count"] == 3


def test_unparsable_times_become_null(spark):
    df = spark.createDataFrame([("2020-02-30 00:00:00", "x"), ("2020-02-29 21:00:00", "2020-02-29")], "timestamp string, date string")
    rows = source.parse_time_columns(df).collect()
    assert rows[0]["timestamp"] is None and rows[0]["date"] is None and str(rows[1]["date"]) == "2020-02-29"


def test_write_result_replaces_and_stamps(spark, tmp_path):
    base = str(tmp_path)
    first = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "country string, avg_aqi double")
    assert sinks.write_result(first, "country_aqi_stats", base) == 2
    assert sinks.write_result(first.filter("country = 'a'"), "country_aqi_stats", base) == 1
    stored = results.read_result_table(spark, base, "country_aqi_stats")
    assert [r["country"] for r in stored.collect()] == ["a"] and stored.first()["processed_at"] is not None


def test_write_result_rejects_duplicate_keys(spark, tmp_path):
    twice = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "country string, avg_aqi double")
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.write_result(twice, "country_aqi_stats", str(tmp_path))


def test_a_rejected_table_leaves_the_old_one(spark, tmp_path):
    good = spark.createDataFrame([("a", 1.0)], "country string, avg_aqi double")
    sinks.write_result(good, "country_aqi_stats", str(tmp_path))
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.write_result(good.union(good), "country_aqi_stats", str(tmp_path))
    assert [r["country"] for r in results.read_result_table(spark, str(tmp_path), "country_aqi_stats").collect()] == ["a"]
    assert [p.name for p in tmp_path.iterdir()] == ["country_aqi_stats"]


def test_a_write_broken_before_the_pointer_leaves_the_old_table(spark, tmp_path, monkeypatch):
    from skyledger.sources import storage
    base, rows = str(tmp_path), lambda *names: spark.createDataFrame([(n, 1.0) for n in names], "country string, avg_aqi double")
    read = lambda: [r["country"] for r in results.read_result_table(spark, base, "country_aqi_stats").collect()]

    def broken(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "mark", broken)
        with pytest.raises(OSError):
            sinks.write_result(rows("first"), "country_aqi_stats", base)
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read()
        assert results.read_result_table(spark, base, "country_aqi_stats", missing_schema="country string").count() == 0
    sinks.write_result(rows("a"), "country_aqi_stats", base)
    with monkeypatch.context() as patch:
        patch.setattr(storage, "mark", broken)
        with pytest.raises(OSError):
            sinks.write_result(rows("b"), "country_aqi_stats", base)
    assert read() == ["a"]
    begun = results.read_stored(spark, base, "country_aqi_stats")
    sinks.write_result(rows("c"), "country_aqi_stats", base)
    assert read() == ["c"] and [r["country"] for r in begun.collect()] == ["a"]
    for name in "def":
        sinks.write_result(rows(name), "country_aqi_stats", base)
    folder = tmp_path / "country_aqi_stats"
    assert read() == ["f"] and len(list(folder.glob("0*"))) == 2 == len([p for p in (folder / "_current").iterdir() if p.name[0] != "."])


def test_a_broken_run_goes_on_behind_its_last_table(spark, readings, tmp_path, monkeypatch):
    """Broken at every table in turn, runs end with the tables of a run that was never broken."""
    from skyledger.plans import pipeline
    raw, tables = str(tmp_path / "raw"), dict(list(result_tables.RESULT_TABLES.items())[:3])
    sinks.write_readings(readings.withColumn("record_id", F.monotonically_increasing_id()), raw)
    monkeypatch.setattr(pipeline, "RESULT_TABLES", tables)
    run_pipeline(spark, raw, str(tmp_path / "whole"), ["clean", "tables"], at_once=1)
    base, done, write = str(tmp_path / "broken"), [], sinks.write_result

    def break_at(place):
        def job(df, name, *rest):
            if len(done) == place:
                raise RuntimeError("lost")
            done.append(name)
            return write(df, name, *rest)
        return job

    order = ["table_cube", "yearly_trends", "country_aqi_stats", "city_aqi_stats"]
    for place in range(len(order)):
        monkeypatch.setattr(sinks, "write_result", break_at(place))
        with pytest.raises(RuntimeError):
            run_pipeline(spark, raw, base, ["clean", "tables"], at_once=1)
        assert done == order[:place]
    monkeypatch.setattr(sinks, "write_result", write)
    assert [e["output_table"] for e in run_pipeline(spark, raw, base, ["clean", "tables"], at_once=1)] == order[-1:]
    assert run_pipeline(spark, raw, base, ["clean", "tables"]) == []
    for name in tables:
        same_rows(*(results.read_stored(spark, str(tmp_path / b), name).drop("processed_at") for b in ("whole", "broken")))
    logged = results.read_result_table(spark, base, "processing_log").collect()
    assert sorted(r["output_table"] for r in logged) == sorted(["cleaned_readings", *tables])
    assert len(run_pipeline(spark, raw, base, ["clean", "tables"], resume=False)) == 4
    sinks.write_readings(readings.limit(50).withColumn("record_id", F.monotonically_increasing_id()), raw)
    assert len(run_pipeline(spark, raw, base, ["clean", "tables"])) == 4


def test_reading_order(spark, tmp_path):
    df = spark.createDataFrame([("0-50",), ("50-100",), ("100-150",)], "aqi_bracket string")
    sinks.write_result(df, "health_correlations", str(tmp_path))
    got = [r["aqi_bracket"] for r in results.read_result_table(spark, str(tmp_path), "health_correlations").collect()]
    assert got == ["0-50", "100-150", "50-100"]


def test_missing_table(spark, tmp_path):
    empty = results.read_result_table(spark, str(tmp_path), "model_tuning_results", missing_schema=sinks.TUNING_SCHEMA)
    assert empty.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        results.read_result_table(spark, str(tmp_path), "model_tuning_results")


def test_log_appends(spark, tmp_path):
    entry = {"stage": "s", "records_processed": 3, "duration_seconds": 1.2345, "output_table": "t"}
    sinks.append_log(spark, entry, str(tmp_path))
    sinks.append_log(spark, [entry, entry], str(tmp_path))
    rows = results.read_result_table(spark, str(tmp_path), "processing_log").collect()
    assert len({r["id"] for r in rows}) == 3
    assert {(r["duration_seconds"], r["spark_version"]) for r in rows} == {(1.23, spark.version)}


def test_tuning_parameters_are_stored_as_json(spark, tmp_path):
    df = spark.createDataFrame([("M", {"depth": 3})], "model_name string, best_params map<string,int>")
    sinks.write_tuning_results(df, str(tmp_path))
    assert results.read_result_table(spark, str(tmp_path), sinks.TUNING_TABLE, order=[]).first()["best_params"] == '{"depth":3}'


def test_pipeline_stores_and_logs_every_table(spark, readings, tmp_path):
    base, raw = str(tmp_path / "base"), str(tmp_path / "raw")
    sinks.write_readings(readings.withColumn("record_id", F.monotonically_increasing_id()), raw)
    entries = run_pipeline(spark, raw, base, ["clean", "tables", "analysis"])
    assert [e["stage"] for e in entries[:2]] == ["ingest", "data_cleaning"]
    tables = {n: results.read_stored(spark, base, n) for n in [*(e["output_table"] for e in entries), "processing_log"]}
    catalog = {r["table_name"]: r["row_count"] for r in sinks.result_catalog(tables).collect()}
    for entry in entries:
        assert catalog[entry["output_table"]] == entry["records_processed"] > 0
    assert catalog["processing_log"] == len(entries)
    assert set(result_tables.RESULT_TABLES) <= set(catalog) and {"city_clusters", "cluster_examples", "trend_line_points"} <= set(catalog)
    for name in CSV_REPORTS:
        assert spark.read.option("header", True).csv(f"{base}/reports/{name}").count() == catalog[name]
    with pytest.raises(ValueError):
        run_pipeline(spark, raw, base, ["paint"])


def test_pipeline_tunes_models(spark, readings, tmp_path):
    entries = run_pipeline(spark, readings, str(tmp_path), ["models"])
    found = {e["output_table"]: e["records_processed"] for e in entries}
    assert found == {"model_tuning_results": 3, "feature_importance": 45, "model_comparison": 3, "model_summary": 28}
    stored = results.read_result_table(spark, str(tmp_path), sinks.TUNING_TABLE)
    assert stored.count() == 3 and stored.first()["test_r2"] > 0.8
    assert spark.read.parquet(str(tmp_path / "processing_log")).count() == 4


def test_pipeline_logs_what_was_done_before_a_failure(spark, readings, tmp_path):
    broken = readings.drop("VOC")
    with pytest.raises(Exception):
        run_pipeline(spark, broken, str(tmp_path), ["clean", "analysis"])
    assert "data_cleaning" in {r["stage"] for r in results.read_result_table(spark, str(tmp_path), "processing_log").collect()}


@pytest.mark.parametrize("threshold, join", [("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_registry_of_any_size(spark, folder, threshold, join):
    """A registry known to be small is broadcast; else both sides are shuffled, with the same rows."""
    from skyledger.operators.joins import enrich_with_registry
    enriched = enrich_with_registry(star.bare_readings(spark, folder), star.registry(spark, folder))
    before = enriched.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        again = enrich_with_registry(star.bare_readings(spark, folder), star.registry(spark, folder))
        plan = again._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "SinglePartition" not in plan and again.count() == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class _Session:
    """Only what ``shared_folder`` asks a session for."""

    def __init__(self, master, folder=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})
        self.made = []
        self.sparkContext = SimpleNamespace(**{"master": master, "applicationId": master, "setCheckpointDir": self.made.append,
                                               "getCheckpointDir": lambda: None})


def test_shared_folder_comes_from_the_session():
    remote = _Session("yarn", "hdfs://host/shared/")
    assert shared_folder(remote) == "hdfs://host/shared" and remote.made == ["hdfs://host/shared/"]
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.made[0]
    with pytest.raises(RuntimeError):
        shared_folder(_Session("yarn"))
