"""No task gets a whole month, array or table."""

import json
import os
from collections import Counter

import pytest
from tests import fixture
from tests.fixture import U, post

from pyspark.sql import functions as F
from tidelog import registry, registry_state
from tidelog.operators import checks
from tidelog.plans import views
from tidelog.schema import ENGAGEMENT
from tidelog.sources import landed, sinks


def _shots(spark, n: int):
    given = {"observed_at": F.timestamp_add("SECOND", (F.col("id") / 4).cast("int"), F.lit("2026-07-01 00:00:00").cast("timestamp_ntz")), "ts_id": (F.col("id") % 2).cast("string"), "favourites": F.col("id")}
    return spark.range(n).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENGAGEMENT.fields], F.col("id").alias("ingest_seq"))


def test_a_month_of_snapshots_lies_in_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        sinks.append_engagement(_shots(spark, 4000).orderBy(F.rand(1)), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = [f for f in os.listdir(tmp_path / "engagement" / "month=2026-07") if f.startswith("part-")]
    assert len(files) > 1
    latest = views.engagement_latest(landed.engagement(spark, str(tmp_path))).select("ts_id", "observed_at", "favourites").collect()
    # of the snapshots of a post at one instant the one ingested last
    assert {(r["ts_id"], r["observed_at"], r["favourites"]) for r in latest} == {("0", U("2026-07-01 00:16:39"), 3998), ("1", U("2026-07-01 00:16:39"), 3999)}


def test_arrays_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"text {i} {{", "en") for i in range(40)], "doc_id long, text string, lang string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(registry_state.sinks, "scratch", lambda spark: str(tmp_path / "s"))
    spark.conf.set("spark.sql.files.openCostInBytes", "134217728")
    try:
        found = registry_state.json_array_by_splits(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len([f for f in os.listdir(tmp_path / "s" / "array") if f.startswith("part-")]) == 4
    assert sorted((r["id"], r["size"]) for r in found) == [(i, len(f"text {i} {{")) for i in range(40)]


def test_costly_rows_are_dealt_to_all_cores(spark, tmp_path):
    spark.sql("SELECT id AS o_orderkey, '1-URGENT' AS o_orderpriority, timestamp_ntz'2024-01-01' AS o_orderdate FROM range(100)").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01' AS ts FROM range(100)").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    for made in (registry_state.tracker_status_pages, registry_state.check_record_rules):
        assert made(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_media_between_makes_no_arrays(spark, tmp_path):
    spark.sql("SELECT id AS o_orderkey, 1 AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority, timestamp_ntz'1997-02-01' AS o_orderdate FROM range(3)").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT id % 4 AS l_orderkey, 1 AS l_linenumber, if(id % 4 = 1, 'A', 'N') AS l_returnflag, timestamp_ntz'1997-02-01' AS l_shipdate FROM range(8)").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = registry.media_join_between(spark, str(tmp_path))
    assert {(r["type"], r["n"]) for r in found.collect()} == {("image", 2), ("video", 4)}
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_ids_of_a_check_are_dealt_to_many_tasks(spark):
    rows = [post(i, "2026-07-01 00:00") for i in range(400)]
    none = spark.createDataFrame([], "ts_id string, source string, observed_at timestamp_ntz")
    found = checks.run(fixture.posts(spark, rows + rows), none, none, fixture.runs(spark), F.lit("2026-09-11 12:00:00").cast("timestamp_ntz"))
    # the parts of the union are small: by bytes, all ids would go to one task
    by_task = Counter(r["p"] for r in found.select("code", F.spark_partition_id().alias("p")).collect() if r["code"] == "duplicate_id")
    assert sum(by_task.values()) == 400 and max(by_task.values()) < 100


class _Landed(Exception):
    pass


def _stop(*_, **__):
    raise _Landed


def _events(spark, tmp_path, monkeypatch, n: int):
    spark.sql(f"SELECT id AS event_id, id % 20 AS user_id, timestamp_ntz'2024-01-01' AS ts, 'view' AS event_type, '{{\"k\": 50}}' AS props FROM range({n})").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(registry_state.sinks, "scratch", lambda spark: str(tmp_path / "s"))
    return str(tmp_path)


def test_a_stream_lands_in_files_of_all_tasks(spark, tmp_path, monkeypatch):
    d = _events(spark, tmp_path, monkeypatch, 1200)
    monkeypatch.setattr(registry_state.micro, "run_merge", _stop)
    with pytest.raises(_Landed):
        registry_state.stream_merge(spark, d)
    found = spark.read.parquet(f"{d}/s/in").select("ts_id", "seq", F.input_file_name().alias("file")).collect()
    for part in ([r for r in found if r["seq"] < 600], [r for r in found if r["seq"] >= 600]):
        files = {r["ts_id"]: {x["file"] for x in part if x["ts_id"] == r["ts_id"]} for r in part}
        # many files, and all rows of a post in one of them
        assert len(part) == 600 and {len(f) for f in files.values()} == {1} and len({f for s in files.values() for f in s}) > 4


def test_more_events_land_as_more_pages(spark, tmp_path, monkeypatch):
    d = _events(spark, tmp_path, monkeypatch, 400)
    monkeypatch.setattr(registry_state, "PAGE", 20, raising=False)
    monkeypatch.setattr(registry_state.collect, "ingest", _stop)
    with pytest.raises(_Landed):
        registry_state.collect_observation_times(spark, d)
    pages = [len(json.loads(p.read_text())) for p in (tmp_path / "s" / "inbox" / "primary").glob("*.json")]
    assert sum(pages) == 400 + 134 + 67 and max(pages) <= 40
