"""Versions of a data set: a merge that dies at any step, done again, leaves what an uninterrupted one leaves."""

import pytest
from tests.fixture import FIRST_ID, U, observation, observations

from tidelog import collect
from tidelog.sources import landed, sinks, store
from tidelog.streaming import micro


class Died(Exception):
    pass


def batches(spark):
    """A post of August that the second batch moves to September, one that goes, one that stays; snapshots in the second."""
    one = lambda n, seq, source, at, **more: observation(seq, source, at, ts_id=f"{FIRST_ID + n}", **more)
    first = [
        one(1, 0, "tracker", "2026-08-31 23:59", created_at_utc=U("2026-08-31 23:58"), content_html="<p>old text</p>", lang="en"), one(2, 1, "bulk", "2026-08-31 23:59", created_at_utc=U("2026-08-02 00:00"), content_text="stays"),
        one(3, 2, "primary", "2026-08-31 23:59", created_at_utc=U("2026-09-01 00:00"), content_html="<p>third</p>"),
    ]
    second = [one(1, 0, "primary", "2026-09-02 10:00", created_at_utc=U("2026-09-01 00:01")), one(3, 1, "primary", "2026-09-02 10:00", gone=True)]
    shots = spark.createDataFrame([(U("2026-09-02 10:00"), f"{FIRST_ID + 1}", "primary", 1, 2, 3, None, None, 1)], "observed_at timestamp_ntz, ts_id string, source string, replies long, reblogs long, favourites long, upvotes long, downvotes long, ingest_seq long")
    return observations(spark, first), observations(spark, second), shots


def seen(spark, root):
    plain = lambda df: sorted(map(repr, df.collect()))
    return plain(landed.posts(spark, root)), plain(landed.deletion_log(spark, root)), plain(landed.engagement(spark, root).drop("ingest_seq")), plain(landed.anomalies(spark, root))


STEPS = ("staged", "replace_months", "append", "commit")


def dying(monkeypatch, at):
    """Batch methods that die at their at-th call, even numbers before and odd ones after the work."""
    count = iter(range(1 << 20))

    def wrap(real):
        def step(*args, **kwargs):
            turn = next(count)
            if 2 * turn == at:
                raise Died
            out = real(*args, **kwargs)
            if 2 * turn + 1 == at:
                raise Died
            return out

        return step

    for name in STEPS:
        monkeypatch.setattr(store.Batch, name, wrap(getattr(store.Batch, name)))
    return count


def test_a_batch_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    first, second, shots = batches(spark)
    root = str(tmp_path / "whole")
    micro.merge_into(first, root, "b-0")
    with monkeypatch.context() as m:
        count = dying(m, -1)
        gave = micro.merge_into(second, root, "b-1", shots)
        steps = next(count)
    want = seen(spark, root)
    assert gave == {"new_posts": 0, "updated_posts": 2, "deletions_found": 1} and steps == 8
    moved = next(r for r in landed.posts(spark, root).collect() if r["ts_id"] == str(FIRST_ID + 1))
    assert (moved["first_seen_at"], moved["first_seen_source"], moved["lang"], moved["content_text"]) == (U("2026-08-31 23:59"), "tracker", "en", "old text")
    base = str(tmp_path / "base")
    micro.merge_into(first, base, "b-0")
    before = seen(spark, base)
    for at in range(2 * steps):
        with monkeypatch.context() as m:
            dying(m, at)
            with pytest.raises(Died):
                micro.merge_into(second, base, "b-1", shots)
        # a reader sees the old version, or the new one if the commit was the last thing done
        assert seen(spark, base) == (want if at == 2 * steps - 1 else before), at
    assert micro.merge_into(second, base, "b-1", shots) == gave and seen(spark, base) == want
    store.vacuum(spark, base, keep=1)
    assert seen(spark, base) == want and len(store.glob(spark, f"{base}/data/*")) == 2 and store.numbers(spark, base) == [2]


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    first, second, shots = batches(spark)
    micro.merge_into(first, root, "b-0")
    old = landed.posts(spark, root)
    names = sorted(r["ts_id"] for r in old.collect())
    late = store.Batch(spark, root, "late")
    micro.merge_into(second, root, "b-1", shots)
    assert sorted(r["ts_id"] for r in old.collect()) == names  # its folders have not changed
    with pytest.raises(RuntimeError):
        late.commit({})
    micro.merge_into(second, root, "b-2", shots)
    assert len(store.current(spark, root).logs["deletions"]) == 3 and landed.deletion_log(spark, root).count() == 1 and landed.engagement(spark, root).count() == 1
    store.compact(spark, root, "deletions", lambda paths, path: spark.read.json(paths).write.json(path))
    assert len(store.current(spark, root).logs["deletions"]) == 1 and landed.deletion_log(spark, root).count() == 1
    sinks.save_posts(landed.posts(spark, root).filter("content_text <> 'stays'"), root)
    assert landed.posts(spark, root).count() == 2


def test_rebuild_is_never_missing_or_mixed(spark, tmp_path, monkeypatch):
    """Between any two steps of a rebuild all tables can be read, and ``rebuilt`` gives those of one rebuild."""
    root, name = str(tmp_path / "data"), "swapped"
    first, second, shots = batches(spark)
    micro.merge_into(first, root, "b-0")
    try:
        assert collect.rebuild(spark, root, name) == {"posts": 3, "engagement": 0, "deletions": 0, "runs": 0, "media": 0}
        running = spark.table(f"{name}.posts").select("ts_id")
        micro.merge_into(second, root, "b-1", shots)
        seen_, sql = [], type(spark).sql

        def looked(self, text, *args, **kwargs):
            if text.startswith("ALTER TABLE"):
                for when in ("before", "after"):
                    counts = {t: spark.table(f"{name}.{t}").count() for t in ("posts", "engagement", "deletions", "runs", "media")}
                    whole = {t: df.count() for t, df in collect.rebuilt(spark, name).items()}
                    seen_.append((when, counts["engagement"], whole["engagement"], whole["deletions"], whole["posts"]))
                    if when == "before":
                        out = sql(self, text, *args, **kwargs)
                        spark.catalog.refreshTable(text.split()[2])
                return out
            return sql(self, text, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", looked)
            assert collect.rebuild(spark, root, name)["engagement"] == 1
        assert len(seen_) == 10 and {x[2:] for x in seen_} == {(1, 1, 3)} and {x[1] for x in seen_} == {0, 1}
        assert running.count() == 3  # planned on the first rebuild, whose files stay one rebuild longer
        assert collect.rebuild(spark, root, name)["deletions"] == 1
    finally:
        for t in ("posts", "engagement", "deletions", "runs", "media"):
            spark.sql(f"DROP TABLE IF EXISTS {name}.{t}")
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_plain_layout_below_a_root_of_the_same_name(spark, tmp_path):
    """A first commit takes a plain layout over where it stands; the root may be called as its parts are."""
    root = str(tmp_path / "posts")
    first, second, _ = batches(spark)
    micro.merge_into(first, str(tmp_path / "other"), "b-0")
    sinks.save_posts(landed.posts(spark, str(tmp_path / "other")), root)
    assert store.current(spark, root).posts == {"2026-08": ["posts/month=2026-08"], "2026-09": ["posts/month=2026-09"]} and landed.posts(spark, root).count() == 3
    micro.merge_into(second, root, "b-1")
    want = str(tmp_path / "other")
    micro.merge_into(second, want, "b-1")
    assert sorted(map(repr, landed.posts(spark, root).collect())) == sorted(map(repr, landed.posts(spark, want).collect()))
