"""The merge against a plain fold of the same rules, written independently, over random observation sequences."""

import random

from tests.fixture import U, archive, item, observation, observations, post, posts

from tidelog.operators import merge as M
from tidelog.operators import throttle
from tidelog.schema import CREATED_RANK, MEDIA_FILL, SCALARS, SOURCE_RANK

T = "110000000000000001"


def run(spark, rows, current=(), logged=None):
    found = M.merge(posts(spark, list(current)), observations(spark, rows), logged)
    return {r["ts_id"]: r.asDict(True) for r in found.posts.collect()}, [r.asDict(True) for r in found.events.collect()], [r.asDict(True) for r in found.anomalies.collect()]


def fold(rows):
    """One record from observations in order, rule by rule."""
    rec = {"status": "present", "media": [], "content_html": "", "content_text": ""}
    src, notes = {}, []

    def offer(f, v, s, ranks=SOURCE_RANK):
        if v in (None, "", []):
            return False
        old = rec.get(f)
        if old in (None, "", []) or ranks[s] >= ranks[src.get(f, "bulk")]:
            rec[f], src[f] = v, s
            return True
        if old != v:
            notes.append(f)
        return False

    for o in rows:
        s, before = o["source"], rec["status"]
        offer("created_at_utc", o["created_at_utc"], s, CREATED_RANK)
        for f in SCALARS:
            offer(f, o[f], s)
        html = rec["content_html"]
        if offer("content_html", o["content_html"], s) and rec["content_html"] != html:
            rec["content_text"], src["content_text"] = o["content_html"], s
        if not o["content_html"] and not rec["content_html"]:
            offer("content_text", o["content_text"], s)
        held = [dict(m) for m in rec["media"]]
        if o["media"]:
            won = offer("media", o["media"], s)
            kept, other = (o["media"], held) if won else (held, o["media"])
            kept = [dict(m) for m in kept]
            if len(kept) == len(other):
                for a, b in zip(kept, other):
                    for k in MEDIA_FILL:
                        a[k] = b[k] if a[k] is None else a[k]
            rec["media"] = kept
        top = lambda *xs: max((x for x in xs if x), default=None)
        low = lambda *xs: min((x for x in xs if x), default=None)
        if o["removed"] or o["gone"]:
            rec["deleted_lower"] = top(rec.get("deleted_lower"), rec.get("last_verified_live_at"), rec.get("created_at_utc"))
            rec["deleted_upper"] = low(rec.get("deleted_upper"), o["tracker_removed_at"] if o["removed"] else o["observed_at"])
            rec.setdefault("deleted_source", "tracker" if o["removed"] else "gone")
            rec["status"] = "deleted"
            if rec["deleted_lower"] and rec["deleted_upper"] and rec["deleted_lower"] > rec["deleted_upper"]:
                notes.append("inverted_bounds")
        elif s == "primary":
            rec["last_verified_live_at"] = top(rec.get("last_verified_live_at"), o["observed_at"])
            rec["status"] = "present"
            if before == "deleted":
                notes.append("resurrected")
        if s == "tracker":
            rec["tracker_id"] = o["tracker_id"] if o["tracker_id"] is not None else rec.get("tracker_id")
            rec.setdefault("tracker_removed_at", None)
            rec["tracker_removed_at"] = rec["tracker_removed_at"] or o["tracker_removed_at"]
    return rec, src, sorted(notes)


def some_observation(r, seq):
    s = r.choice(["primary", "tracker", "bulk"])
    at = f"2026-07-{r.randint(1, 28):02d} {r.randint(0, 23):02d}:00"
    removed = s == "tracker" and r.random() < 0.3
    return observation(
        seq, s, at, kind=r.choice([None, "", "original", "quote"]), lang=r.choice([None, "en", "de"]), tags=r.choice([None, [], ["a"], ["b", "c"]]), pinned=r.choice([None, True, False]),
        created_at_utc=r.choice([None, U("2026-06-01 00:00"), U("2026-06-01 00:00:01"), U("2026-06-02 00:00")]), content_html=r.choice([None, "", "x", "y"]) if s != "bulk" else None,
        content_text=r.choice([None, "", "t", "u"]) if s == "bulk" else None, media=r.choice([None, [], [item("image", width=r.choice([None, 3]), url=r.choice(["a", "b"]))], [item("video"), item("image", mirror_url="m")]]),
        removed=removed, gone=s == "primary" and r.random() < 0.3, tracker_removed_at=U(at) if removed else None, tracker_id=r.choice([None, 1, 2]) if s == "tracker" else None,
    )


def test_random_sequences(spark):
    r, rows, want = random.Random(7), [], {}
    for k in range(250):
        mine = [some_observation(r, 100 * k + i) for i in range(r.randint(1, 7))]
        for o in mine:
            o["ts_id"] = f"{110000000000000000 + k}"
        rows += mine
        want[mine[0]["ts_id"]] = fold(mine)
    got, events, notes = run(spark, rows)
    by_post = {}
    for n in notes:
        by_post.setdefault(n["ts_id"], []).append(n["code"].removesuffix("_disagreement"))
    for ts_id, (rec, src, kept) in want.items():
        g = got[ts_id]
        for f in (*SCALARS, "created_at_utc", "content_html", "content_text", "media", "status", "deleted_lower", "deleted_upper", "deleted_source", "last_verified_live_at", "tracker_id", "tracker_removed_at"):
            a, b = g[f], rec.get(f)
            assert a == b or (a in (None, "", [], False) and b in (None, "", [], False)), (ts_id, f, a, b)
        assert g["field_sources"] == src, ts_id
        mine = [o for o in rows if o["ts_id"] == ts_id]
        created = [o["created_at_utc"] for o in mine]
        near = {U("2026-06-01 00:00"), U("2026-06-01 00:00:01")}
        if not near <= set(created):  # a second apart is no disagreement
            assert sorted(by_post.get(ts_id, [])) == kept, ts_id
    keys = {(o["ts_id"], o["source"]) for o in rows if o["removed"] or o["gone"]}
    assert {(e["ts_id"], e["source"]) for e in events} == keys and len(events) == len(keys)


def test_batches_equal_one_batch(spark):
    r = random.Random(3)
    rows = [some_observation(r, i) for i in range(12)]
    whole, _, _ = run(spark, rows)
    first = M.merge(posts(spark, []), observations(spark, rows[:5]))
    then = M.merge(first.posts.drop("changed", "is_new"), observations(spark, rows[5:]), first.events)
    two = then.posts.collect()[0].asDict(True)
    skip = {"updated_run_id", "updated_at", "changed", "is_new"}
    assert {k: v for k, v in two.items() if k not in skip} == {k: v for k, v in whole[T].items() if k not in skip}
    assert not two["is_new"]


def test_repeating_an_observation_changes_nothing(spark):
    o = observation(0, "primary", created_at_utc=U("2026-07-01 00:00"), content_html="<p>a</p>", kind="original")
    first = M.merge(posts(spark, []), observations(spark, [o]))
    again = M.merge(first.posts.drop("changed", "is_new"), observations(spark, [o | {"seq": 1}]))
    r = again.posts.collect()[0]
    assert not r["changed"] and r["updated_run_id"] == "run0" and r["content_text"] == "a"


def test_untouched_records_stay(spark):
    got, events, notes = run(spark, [observation(0, "bulk", kind="original")], archive()[:3])
    assert len(got) == 3 and not events
    assert not got["110000000000000002"]["changed"] and got["110000000000000002"]["content_text"] == "text 2"


def test_late_sighting_does_not_raise_the_lower_bound(spark):
    rows = [
        observation(0, "primary", "2026-07-01 12:00", created_at_utc=U("2026-07-01 00:00")), observation(1, "primary", "2026-07-02 12:00", gone=True), observation(2, "primary", "2026-07-03 12:00"),
    ]
    got, events, notes = run(spark, rows)
    assert got[T]["deleted_lower"] == U("2026-07-01 12:00") and got[T]["deleted_upper"] == U("2026-07-02 12:00")
    assert got[T]["status"] == "present" and [n["code"] for n in notes] == ["resurrected"]


def test_candidates(spark):
    rows = [post(i, f"2026-07-0{i} 00:00", last_verified_live_at=U("2026-07-20 00:00")) for i in range(1, 8)]
    rows[4]["status"] = "deleted"
    p = posts(spark, rows)
    fetched = p.filter("ts_id in ('110000000000000002', '110000000000000006')")
    assert [r[0][-1] for r in M.deletion_candidates(p, fetched, 3).collect()] == ["3", "4"]


def test_throttle(spark):
    def kept(times, created=None, last=None):
        df = spark.createDataFrame([("p", U(t), i, created and U(created), last and U(last)) for i, t in enumerate(times)], "ts_id string, at timestamp_ntz, seq bigint, created timestamp_ntz, last timestamp_ntz")
        return sorted(r["seq"] for r in throttle.keep(df, ["ts_id"], "at", "seq", created="created", last="last").collect())

    assert kept(["2026-07-01 00:00", "2026-07-01 00:59", "2026-07-01 01:00", "2026-07-01 01:59:59"]) == [0, 2]
    assert kept(["2026-07-15 00:00", "2026-07-16 00:00"], created="2026-07-01 00:00") == [0]
    assert kept(["2026-07-14 23:59:59", "2026-07-15 00:59:59"], created="2026-07-01 00:00") == [0]
    assert kept(["2026-07-15 00:00"], created="2026-07-01 00:00", last="2026-07-02 00:00") == []
    assert kept(["2026-07-01 05:00", "2026-07-01 01:00", "2026-07-01 06:00"]) == [0, 2]
