import datetime as dt
import os
import re

from tidelog import control

NOW = dt.datetime(2026, 9, 11, 12, tzinfo=dt.UTC)


def test_run_ids():
    assert re.fullmatch(r"20260911T120000Z-[0-9a-f]{4}", control.new_run_id(NOW))


def test_rest():
    state = {"sources": {"bulk": {"last_fetch_at": "2026-09-11T10:00:01+00:00"}, "primary": {"reachable": False, "last_probe_at": "2026-09-11T05:00:00+00:00"}}}
    assert not control.due(state, "bulk", NOW) and control.due(state, "bulk", NOW + dt.timedelta(seconds=1)) and control.due(state, "primary", NOW)
    state["sources"]["primary"]["last_probe_at"] = "2026-09-11T07:00:00+00:00"
    assert not control.due(state, "primary", NOW) and control.due({}, "bulk", NOW) and control.due(state, "tracker", NOW)


def test_a_failing_source_does_not_stop_the_others():
    def fail():
        raise RuntimeError("no")

    out = control.run_sources({"bulk": lambda: {"new_posts": 2}, "primary": fail}, "r", lambda: NOW)
    assert [(r["source"], r["ok"], r["new_posts"]) for r in out.rows] == [("primary", False, 0), ("bulk", True, 2)] and out.exit_code == 1
    out.hard = True
    assert out.exit_code == 2 and control.Outcome().exit_code == 0


def test_lock(tmp_path):
    path = str(tmp_path / "lock")
    with control.lock(path) as mine:
        assert mine
        with control.lock(path) as other:
            assert not other
        os.utime(path, (0, 0))
        with control.lock(path) as taken:
            assert taken
    assert not os.path.exists(path)
