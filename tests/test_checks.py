"""Integrity checks: a sound archive has no hard row; each mutation raises its code."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests import fixture
from tests.fixture import U, post

from tidelog.operators import checks, validate
from tidelog.schema import FIELDS, INSTANTS

def NOW():
    return F.lit("2026-09-11 12:00:00").cast("timestamp_ntz")



def codes(df, severity="hard"):
    return sorted({r["code"] for r in df.collect() if r["severity"] == severity})


def test_sound_archive(spark):
    rows = fixture.archive()
    present = sum(r["status"] == "present" for r in rows)
    found = checks.run(fixture.posts(spark), fixture.deletion_log(spark), fixture.snapshots(spark), fixture.runs(spark), F.lit("2026-12-02 12:00:00").cast("timestamp_ntz"), run_id="r1", statuses_count=present, tracker_total=len(rows))
    assert codes(found) == []


def test_mutations(spark):
    rows = fixture.archive()
    rows.append(dict(rows[0]))
    rows.append(post(7000, "2026-07-20 00:00", deleted_lower=U("2026-07-19 00:00"), deleted_upper=U("2026-07-18 00:00")))
    log = fixture.deletion_log(spark)
    log = log.union(log.limit(1)).union(log.limit(1).withColumn("ts_id", F.lit("9")))
    snaps = fixture.snapshots(spark)
    close = snaps.limit(1).withColumn("observed_at", F.timestamp_add("MINUTE", F.lit(59), F.col("observed_at")))
    snaps = snaps.union(close).union(snaps.limit(1).withColumn("ts_id", F.lit("8")))
    found = checks.run(fixture.posts(spark, rows), log, snaps, fixture.runs(spark), NOW(), run_id="none", statuses_count=5000, tracker_total=5000)
    assert codes(found) == ["created_after_deleted_upper", "deletion_unknown_post", "duplicate_deletion_event", "duplicate_id", "engagement_too_close", "engagement_unknown_post", "missing_run_row"]
    assert {"inverted_deletion_bounds", "present_count_drift", "tracker_total_drift"} <= set(codes(found, "soft"))


def test_stale_single_source_and_spikes(spark):
    rows = [post(i, f"2026-08-{1 + i:02d} 15:00") for i in range(28)] + [post(100 + i, "2026-08-29 15:00") for i in range(25)]
    found = checks.run(fixture.posts(spark, rows), fixture.deletion_log(spark).limit(0), fixture.snapshots(spark).limit(0), fixture.runs(spark), NOW())
    assert codes(found, "soft") == ["single_source_recent_posts", "spike_days", "stale_newest_post"]
    few = [post(i, f"2026-08-{1 + i:02d} 15:00") for i in range(28)] + [post(100 + i, "2026-08-29 15:00") for i in range(6)]
    found = checks.run(fixture.posts(spark, few), fixture.deletion_log(spark).limit(0), fixture.snapshots(spark).limit(0), fixture.runs(spark), NOW())
    assert "spike_days" not in codes(found, "soft")


def record(**change) -> dict:
    base = dict.fromkeys(FIELDS) | {
        "ts_id": "110000000000000001", "created_at_utc": "2026-07-01T00:00:00Z", "created_at_et": "2026-06-30T20:00:00-04:00", "et_date": "2026-06-30", "et_hour": 20, "et_dow": 1, "kind": "original", "status": "present",
        "first_seen_at": "2026-07-01T00:00:00Z", "updated_at": "2026-07-01T00:00:00Z", "pinned": False, "media": [], "mentions": [], "tags": [], "seen_sources": ["bulk"], "field_sources": {"kind": "bulk"},
    }
    return base | change


@pytest.mark.parametrize("change, code", [
    ({}, None), ({"ts_id": "12"}, "bad_ts_id"), ({"created_at_utc": "2026-07-01 00:00"}, "bad_timestamp"), ({"edited_at": "x"}, "bad_timestamp"), ({"created_at_et": "2026-07-01T00:00:00Z"}, "bad_timestamp"),
    ({"kind": "x"}, "bad_kind"), ({"status": None}, "bad_status"), ({"et_hour": 24}, "bad_et_hour"), ({"et_dow": 7}, "bad_et_dow"), ({"pinned": "no"}, "bad_pinned"), ({"media": "x"}, "bad_media"), ({"media": [{"type": "image"}]}, "bad_media_item"),
    ({"field_sources": []}, "bad_field_sources"), ({"field_sources": {"nope": "bulk"}}, "bad_field_sources_key"), ({"field_sources": {"kind": "x"}}, "bad_field_sources_value"),
])
def test_record_schema(spark, change, code):
    df = spark.createDataFrame([(json.dumps(record(**change)),)], "line string")
    assert {r["code"] for r in checks.schema_violations(df).collect()} == ({code} if code else set())


def test_missing_fields_end_the_look(spark):
    r = record(kind="x")
    del r["lang"]
    df = spark.createDataFrame([(json.dumps(r),)], "line string")
    assert [(x["code"], x["detail"]) for x in checks.schema_violations(df).collect()] == [("missing_fields", "lang")]


def test_files(spark):
    p = fixture.posts(spark).limit(0)
    rows = [("2026-07", 0, "5", U("2026-07-01 00:00")), ("2026-07", 1, "3", U("2026-08-01 00:00")), ("2026-08", 0, "7", U("2026-08-01 00:00"))]
    filed = spark.createDataFrame(rows, "file_month string, line_no int, ts_id string, created_at_utc timestamp_ntz")
    assert [r["detail"] for r in checks.unsorted_files(filed).collect()] == ["2026-07"]
    assert [r["ts_id"] for r in checks.wrong_month(filed).collect()] == ["3"]
    assert p.count() == 0 and INSTANTS


def test_ambiguous_handles_and_stats(spark):
    rows = [post(1, "2026-07-01 00:00", "reblog", content_text="Éa", field_sources={"reblog_of_acct": "bulk"}), post(2, "2026-07-01 00:00", "reblog", content_text=" x", field_sources={"reblog_of_acct": "bulk"}), post(3, "2026-07-01 00:00", "reblog", content_text="x", field_sources={"reblog_of_acct": "primary"})]
    p = fixture.posts(spark, rows)
    assert [r[0][-1] for r in checks.ambiguous_handles(p).collect()] == ["1"]
    found = {(r["name"], r["value"]): r["n"] for r in checks.stats(p, fixture.deletion_log(spark), fixture.snapshots(spark)).collect()}
    gone = sum(r["status"] == "deleted" for r in fixture.archive())
    assert found[("posts", "")] == 3 and found[("by_kind", "reblog")] == 3 and found[("by_source_combination", "bulk")] == 3 and found[("deletions", "")] == gone and found[("ambiguous_handles", "")] == 1


def test_two_archives(spark):
    a = fixture.posts(spark, [post(i, "2026-07-01 00:00") for i in range(5)])
    b = fixture.posts(spark, [post(i, "2026-07-01 00:00:03", "quote" if i == 4 else "original", content_text="text 3!") for i in range(3, 8)])
    assert tuple(validate.overlap(a, b).first()) == (2, 3, 3)
    assert {(r["kind_a"], r["kind_b"]): r["n"] for r in validate.confusion(a, b).collect()} == {("original", "original"): 1, ("original", "quote"): 1}
    assert validate.created_disagreements(a, b).count() == 2
    assert tuple(validate.content_agreement(a, b).first()) == (2, 1)
    ids = spark.range(1000)
    assert {r[0] for r in validate.seeded_sample(ids, "id", 50, 1).collect()} == {r[0] for r in validate.seeded_sample(ids.repartition(7), "id", 50, 1).collect()}


def test_order_across_splits(spark, tmp_path):
    """A file of many splits whose only fault lies between two slices of lines; and one of each kind elsewhere."""
    from tidelog.sources import landed

    lines = [f'{{"ts_id": "{110000000000000000 + i}", "created_at_utc": "2026-07-01T00:00:00Z"}}' for i in range(600)]
    (tmp_path / "posts").mkdir()
    (tmp_path / "posts" / "2026-06.jsonl").write_text("\n".join(lines) + "\n")
    bad = lines[:300] + lines[310:] + lines[300:310]
    (tmp_path / "posts" / "2026-07.jsonl").write_text("\n".join(bad) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "2000")
        filed = landed.filed_posts(spark, str(tmp_path))
        assert filed.rdd.getNumPartitions() > 10
        assert [r["detail"] for r in checks.unsorted_files(filed).collect()] == ["2026-07"]
        # slices as small as a line: every pair of neighbours is an edge
        numbered = filed.withColumn("line_no", F.row_number().over(Window.partitionBy("file").orderBy("line_no")))
        for size in range(7):
            assert [r["detail"] for r in checks.unsorted_files(numbered, size).collect()] == ["2026-07"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
