"""The merge by keyed state gives the records of the merge by aggregates, in any number of batches."""

import random

from tests.fixture import observations, posts
from tests.test_merge import some_observation

from tidelog.operators import merge as M
from tidelog.sources import store
from tidelog.streaming import keyed, micro


def test_state_equals_merge(spark, tmp_path):
    root, inbox, mark = (str(tmp_path / x) for x in ("data", "in", "mark"))
    r, rows = random.Random(12), []
    for k in range(60):
        rows += [some_observation(r, 100 * k + i) | {"ts_id": f"{110000000000000000 + k}"} for i in range(r.randint(1, 9))]
    parts = [[o for o in rows if o["seq"] % 100 in some] for some in (range(3), range(3, 5), range(5, 9))]
    want = posts(spark, [])
    for n, part in enumerate(parts):
        observations(spark, part).coalesce(1).write.mode("append").parquet(inbox)
        keyed.run_upserts(micro.observation_stream(spark, inbox), root, mark).awaitTermination()
        want = M.merge(want, observations(spark, part)).posts.drop("changed", "is_new")
        want = spark.createDataFrame(want.collect(), want.schema)
        got = {x["ts_id"]: x.asDict(True) for x in keyed.records(spark, root).collect()}
        assert got == {x["ts_id"]: x.asDict(True) for x in want.collect()}, n
    assert len(store.current(spark, root).logs[keyed.LOG]) == 3
    keyed.run_upserts(micro.observation_stream(spark, inbox), root, mark).awaitTermination()  # nothing new
    keyed.compact(spark, root)
    assert len(store.current(spark, root).logs[keyed.LOG]) == 1 and {x["ts_id"]: x.asDict(True) for x in keyed.records(spark, root).collect()} == got
