"""Streams keep state by bucket of posts: as many groups as buckets, however many posts."""

from tests.fixture import U, observation, observations

from tidelog.streaming import keyed, micro


def test_throttle_by_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(micro, "BUCKETS", 1, raising=False)
    inbox, schema = str(tmp_path / "in"), "ts_id string, observed_at timestamp_ntz, favourites long"
    for hours in (["00:00", "00:30"], ["00:59", "01:00", "02:30"]):
        spark.createDataFrame([(p, U(f"2026-07-01 {h}"), k) for p, k in (("p", 1), ("q", 2)) for h in hours] + [(None, None, 3)], schema).coalesce(1).write.mode("append").parquet(inbox)
        q = micro.throttled(spark.readStream.schema(schema).parquet(inbox)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        q.awaitTermination()
    found = sorted((r["ts_id"], r["observed_at"].strftime("%H:%M"), r["favourites"]) for r in spark.read.parquet(str(tmp_path / "out")).filter("ts_id is not null").collect())
    assert found == [(p, h, k) for p, k in (("p", 1), ("q", 2)) for h in ("00:00", "01:00", "02:30")]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_keyed_groups_are_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 1, raising=False)
    rows = [observation(i, "bulk", ts_id=f"{110000000000000000 + i % 3}", kind="original") for i in range(9)]
    observations(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = keyed.upserts(micro.observation_stream(spark, str(tmp_path / "in")))
    assert "bucket" in stream._jdf.queryExecution().analyzed().toString()
    keyed.run_upserts(micro.observation_stream(spark, str(tmp_path / "in")), str(tmp_path / "d"), str(tmp_path / "mark")).awaitTermination()
    assert {r["ts_id"] for r in keyed.records(spark, str(tmp_path / "d")).collect()} == {o["ts_id"] for o in rows}
