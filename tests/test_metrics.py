"""Metrics over the generated archive, each against a plain fold over its rows."""

from __future__ import annotations

import collections
import datetime as dt
import random
import statistics
from zoneinfo import ZoneInfo

import pytest
from tests import fixture

from tidelog import cli, report
from tidelog.operators import metrics, sequences
from tidelog.plans import views

ARCHIVE = fixture.archive()
WHOLE = ("2026-01-01", "2026-12-31")
RANGES = [WHOLE, ("2026-03-07", "2026-03-09"), ("2026-10-31", "2026-11-02"), ("2026-06-01", "2026-06-30"), ("2031-01-01", "2031-01-02")]


@pytest.fixture(scope="module")
def v(spark):
    return views.register(spark, fixture.posts(spark), fixture.snapshots(spark), fixture.deletion_log(spark), fixture.runs(spark))


def rows(df):
    return [r.asDict(True) for r in df.collect()]


def local(p: dict) -> dt.datetime:
    return p["created_at_utc"].replace(tzinfo=dt.UTC).astimezone(ZoneInfo("America/New_York"))


def inside(a: str, b: str) -> list[dict]:
    """Posts of the Eastern days, in order of time and id."""
    return sorted((p for p in ARCHIVE if a <= local(p).date().isoformat() <= b), key=lambda p: (p["created_at_utc"], p["ts_id"]))


def minutes(a: dt.datetime, b: dt.datetime) -> float:
    return (b - a).total_seconds() / 60


def days(a: str, b: str) -> list[str]:
    x, y = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
    return [(x + dt.timedelta(k)).isoformat() for k in range((y - x).days + 1)]


def day_counts(some: list[dict]) -> dict:
    kinds = collections.Counter(p["kind"] for p in some)
    return {k: kinds[k] for k in ("original", "quote", "reblog", "reply")} | {"total": len(some), "deleted": sum(p["status"] == "deleted" for p in some)}


def test_views(v):
    assert v["v_posts_et"].columns == list(views.VIEW_COLUMNS)
    found = {r["ts_id"]: r for r in rows(v["v_posts_et"])}
    assert len(found) == len(ARCHIVE) and v["media"].count() == sum(len(p["media"]) for p in ARCHIVE)
    for p in ARCHIVE:
        r, at = found[p["ts_id"]], local(p)
        assert r["created_at_et"] == at.isoformat() and (r["et_date"], r["et_hour"], r["et_dow"]) == (at.date(), at.hour, at.weekday())
        assert r["media_types"] == ",".join(m["type"] for m in p["media"]) and r["content_len"] == len(p["content_text"])
        gone = p["status"] == "deleted"
        assert r["lifetime_min"] == (minutes(p["created_at_utc"], p["deleted_upper"]) if gone else None)
        assert r["deletion_window_min"] == (minutes(p["deleted_lower"], p["deleted_upper"]) if gone else None)


@pytest.mark.parametrize("a, b", RANGES)
def test_days_hours_and_nights(v, a, b):
    some, view = inside(a, b), v["v_posts_et"]
    by_day = collections.defaultdict(list)
    for p in some:
        by_day[local(p).date().isoformat()].append(p)
    found = {r.pop("et_date").isoformat(): r for r in rows(metrics.posts_by_day(view, a, b))}
    assert found == {d: day_counts(by_day[d]) for d in days(a, b)}
    hours = collections.Counter(local(p).hour for p in some)
    assert {r["et_hour"]: r["n"] for r in rows(metrics.hour_histogram(view, a, b))} == {h: hours[h] for h in range(24)}
    night = sum(local(p).hour < 6 for p in some)
    assert rows(metrics.overnight_share(view, a, b)) == [{"overnight": night, "total": len(some), "share": night / len(some) if some else None}]


def plain_bursts(some: list[dict], window: int, least: int) -> list[tuple]:
    spans = []
    for i, p in enumerate(some):
        last = max(k for k, q in enumerate(some) if minutes(p["created_at_utc"], q["created_at_utc"]) <= window)
        if last - i + 1 >= least:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = max(last, spans[-1][1])
            else:
                spans.append([i, last])
    return [(local(some[x]).isoformat(), local(some[y]).isoformat(), y - x + 1, collections.Counter(p["kind"] for p in some[x : y + 1])) for x, y in spans]


@pytest.mark.parametrize("window, least", [(10, 5), (10, 3), (30, 2), (90, 3), (2000, 4), (10, 40)])
def test_bursts(v, window, least):
    found = [(r["start_et"], r["end_et"], r["count"], r["kinds"]) for r in rows(sequences.bursts(v["v_posts_et"], window, least))]
    assert sorted(found, key=lambda x: x[:2]) == sorted(plain_bursts(inside(*WHOLE), window, least), key=lambda x: x[:2])


def test_one_dense_burst(spark):
    """A stream without a pause is one burst over many slices."""
    some = [fixture.post(k, dt.datetime(2026, 5, 1) + dt.timedelta(minutes=2 * k)) for k in range(400)]
    (r,) = rows(sequences.bursts(views.posts_et(fixture.posts(spark, some))))
    assert r["count"] == 400 and r["kinds"] == {"original": 400}


def test_gaps(v):
    some = inside(*WHOLE)
    pairs = list(zip(some, some[1:]))
    want = sorted(((minutes(a["created_at_utc"], b["created_at_utc"]), a, b) for a, b in pairs), key=lambda x: (-x[0], x[2]["created_at_utc"], x[2]["ts_id"]))
    found = rows(sequences.longest_gaps(v["v_posts_et"]))
    assert [(r["gap_min"], r["from_et"], r["to_et"]) for r in found] == [(g, local(a).isoformat(), local(b).isoformat()) for g, a, b in want[:20]]
    assert rows(sequences.longest_silence(v["v_posts_et"]))[0]["gap_min"] == want[0][0]
    assert not rows(sequences.longest_silence(v["v_posts_et"].filter(f"ts_id = '{some[0]['ts_id']}'")))
    assert {(r["ts_id"], r["gap_min"]) for r in rows(sequences.close_pairs(v["v_posts_et"]))} == {(b["ts_id"], g) for g, _, b in want if g <= 10}
    before = {r["ts_id"]: r["prev_created_at_utc"] for r in rows(v["v_posts_previous"])}
    assert before == {some[0]["ts_id"]: None} | {b["ts_id"]: a["created_at_utc"] for a, b in pairs}


def test_tops(v):
    def top(values):
        return sorted(collections.Counter(values).items(), key=lambda x: (-x[1], x[0]))[:10]

    assert [(r["account"], r["n"]) for r in rows(metrics.top_accounts(v["v_posts_et"]))] == top(p["reblog_of_acct"] for p in ARCHIVE if p["kind"] == "reblog" and p["reblog_of_acct"])
    assert [(r["domain"], r["n"]) for r in rows(metrics.link_domains(v["v_posts_et"]))] == top(p["card_domain"] for p in ARCHIVE if p["card_domain"])


def test_media(v):
    a, b = "2026-04-01", "2026-08-31"
    some = inside(a, b)
    sets = [frozenset(m["type"] for m in p["media"]) for p in some]
    found = rows(metrics.media_sets(metrics.between(v["v_posts_et"], a, b)))[0]
    want = {"no_media": sets.count(frozenset()), "image_only": sets.count(frozenset(["image"])), "video_only": sets.count(frozenset(["video"]))}
    assert found == want | {"mixed": len(some) - sum(want.values())}
    assert {r["type"]: r["n"] for r in rows(metrics.media_items_between(v["v_posts_et"], v["media"], a, b))} == collections.Counter(m["type"] for p in some for m in p["media"])


def latest() -> dict:
    out: dict = {}
    for i, row in enumerate(fixture.snapshot_rows()):
        if row[1] not in out or (row[0], i) > out[row[1]][0]:
            out[row[1]] = ((row[0], i), row)
    return {k: row for k, (_, row) in out.items()}


def test_engagement(v):
    last, kind = latest(), {p["ts_id"]: p["kind"] for p in ARCHIVE}
    found = {r["kind"]: r for r in rows(metrics.engagement_stats(v["v_posts_et"], v["v_engagement_latest"]))}
    tiles = {r["kind"]: r for r in rows(metrics.engagement_tiles(v["v_posts_et"], v["v_engagement_latest"]))}
    for k in set(kind.values()):
        mine = [r for i, r in last.items() if kind[i] == k]
        assert found[k]["n"] == len(mine)
        for at, name in ((3, "replies"), (4, "reblogs"), (5, "favourites")):
            xs = sorted(r[at] for r in mine if r[at] is not None)
            rank = lambda p: xs[-(-len(xs) * p // 100) - 1] if xs else None
            assert (found[k][f"{name}_median"], found[k][f"{name}_p90"]) == (rank(50), rank(90))
        xs = sorted(r[5] for r in mine if r[5] is not None)
        size, more = divmod(len(xs), 100)
        tile = [t for t in range(1, 101) for _ in range(size + (t <= more))]
        first = lambda p: min((x for x, t in zip(xs, tile) if t >= p), default=None)
        assert (tiles[k]["n"], tiles[k]["favourites_p50"], tiles[k]["favourites_p90"]) == (len(xs), first(50), first(90))


def test_deletions_and_edits(v):
    a, b = "2026-02-01", "2026-09-30"
    some = inside(a, b)
    gone = [(p["ts_id"], minutes(p["created_at_utc"], p["deleted_upper"]), minutes(p["deleted_lower"], p["deleted_upper"]), p["content_text"][:120]) for p in some if p["status"] == "deleted"]
    assert [(r["ts_id"], r["lifetime_min"], r["deletion_window_min"], r["snippet"]) for r in rows(metrics.deletion_listing(v["v_deletions"], a, b))] == gone
    newest = [r["ts_id"] for r in rows(metrics.deletion_listing(v["v_deletions"]))]
    assert newest == [p["ts_id"] for p in sorted((p for p in ARCHIVE if p["status"] == "deleted"), key=lambda p: (-p["created_at_utc"].timestamp(), p["ts_id"]))]
    assert [(r["ts_id"], r["edited_at"]) for r in rows(metrics.edits(v["v_posts_et"], a, b))] == [(p["ts_id"], p["edited_at"]) for p in some if p["edited_at"]]


def test_saved_queries(spark, v):
    """All of them, by value."""
    saved = cli.saved_queries()
    run = lambda name: rows(cli.run_query(spark, saved[name]))
    whole, last = inside(*WHOLE), latest()
    by_day = collections.defaultdict(list)
    for p in whole:
        by_day[local(p).date()].append(p)
    gaps = sorted(((minutes(a["created_at_utc"], b["created_at_utc"]), b) for a, b in zip(whole, whole[1:])), key=lambda x: (-x[0], x[1]["created_at_utc"]))
    kinds = collections.Counter(p["kind"] for p in ARCHIVE)
    media = collections.Counter(m["type"] for p in ARCHIVE for m in p["media"]) | {"no_media_posts": sum(not p["media"] for p in ARCHIVE)}
    night = sum(local(p).hour < 6 for p in ARCHIVE)
    assert set(saved) == {"bursts", "deletions", "engagement_percentiles", "hour_histogram", "kinds_mix", "link_domains", "longest_gaps", "media_mix", "overnight_share", "top_accounts", "volume_by_day"}
    assert [(r["ts_id"], round(float(r["gap_min"]), 4)) for r in run("bursts")] == [(b["ts_id"], round(g, 4)) for a, b in zip(whole, whole[1:]) if (g := minutes(a["created_at_utc"], b["created_at_utc"])) <= 10]
    assert [r["to_et"] for r in run("longest_gaps")] == [local(b).isoformat() for _, b in gaps[:20]]
    assert {r["et_hour"]: r["n"] for r in run("hour_histogram")} == collections.Counter(local(p).hour for p in ARCHIVE)
    assert [(r["kind"], r["n"]) for r in run("kinds_mix")] == sorted(kinds.items(), key=lambda x: (-x[1], x[0]))
    assert [r["n"] for r in run("link_domains")] == [r["n"] for r in rows(metrics.link_domains(v["v_posts_et"]))]
    assert run("top_accounts") == rows(metrics.top_accounts(v["v_posts_et"]))
    assert {r["type"]: r["n"] for r in run("media_mix")} == media
    assert run("overnight_share") == [{"overnight": night, "total": len(ARCHIVE), "share": night / len(ARCHIVE)}]
    assert {r.pop("et_date"): r for r in run("volume_by_day")} == {d: day_counts(x) for d, x in by_day.items()}
    assert [r["ts_id"] for r in run("deletions")] == [r["ts_id"] for r in rows(metrics.deletion_listing(v["v_deletions"]))]
    assert run("engagement_percentiles") == sorted(rows(metrics.engagement_tiles(v["v_posts_et"], v["v_engagement_latest"])), key=lambda r: r["kind"])
    assert sum(r["n"] for r in run("engagement_percentiles")) == sum(x[5] is not None for x in last.values())


def test_spikes(spark):
    """Against the median of the 28 days before, days without posts counted as zero."""
    some = [fixture.post(k, dt.datetime(2026, 5, 1, 16) + dt.timedelta(days=7 * k % 60, seconds=k)) for k in range(500)] + [fixture.post(900 + k, dt.datetime(2026, 6, 20, 16, k)) for k in range(45)]
    counts = collections.Counter(local(p).date() for p in some)
    first, last, want = min(counts), max(counts), []
    for k in range((last - first).days + 1):
        d = first + dt.timedelta(k)
        median = statistics.median(counts[d - dt.timedelta(j)] for j in range(1, 29))
        if median > 0 and counts[d] > 3 * median and counts[d] >= 20:
            want.append((d, counts[d], median))
    found = [(r["et_date"], r["count"], r["trailing_median"]) for r in rows(sequences.spike_days(views.posts_et(fixture.posts(spark, some))))]
    assert sorted(found) == want and want


def test_report_and_formats(spark, v, tmp_path):
    assert report.iso_week(spark, "2026-W30") == tuple(dt.date.fromisocalendar(2026, 30, d).isoformat() for d in (1, 7))
    assert report.iso_week(spark, "2027-W01") == tuple(dt.date.fromisocalendar(2027, 1, d).isoformat() for d in (1, 7))
    with pytest.raises(ValueError):
        report.iso_week(spark, "2025-W53")
    found = report.baseline(v, "2026-03-02", "2026-03-08", 3)
    assert (found["meta"]["trailing_start"], found["meta"]["trailing_end"]) == ("2026-02-09", "2026-03-01")
    text = report.markdown(found)
    assert text.count("\n## ") == 13 and f"**{len(inside('2026-03-02', '2026-03-08'))}**" in text and f"**{len(inside('2026-02-09', '2026-03-01')) / 3:.1f}**" in text
    assert len(report.write(found, str(tmp_path), "w")) == 9
    n = sum(p["kind"] == "quote" for p in ARCHIVE)
    df = cli.run_query(spark, "SELECT kind, count(*) AS n FROM v_posts_et WHERE kind = ? GROUP BY kind", ["quote"])
    assert cli.formatted(df, "csv") == f"kind,n\nquote,{n}\n"
    assert cli.formatted(df, "markdown").splitlines()[-1] == f"| quote | {n} |"
    assert cli.formatted(df, "table").splitlines()[0].split() == ["kind", "n"]


def test_slices_follow_density(spark):
    """Nine tenths of the posts in one hour: slices are about equal, and neighbours and bursts are those of one list."""
    r = random.Random(8)
    start = dt.datetime(2026, 3, 1)
    at = sorted(start + dt.timedelta(seconds=r.randrange(3600) if i % 10 else r.randrange(86_400 * 60)) for i in range(3000))
    some = [fixture.post(i, t) for i, t in enumerate(at, 1)]
    p = fixture.posts(spark, some).select("created_at_utc", "ts_id", "created_at_et", "kind")
    sizes = [x["count"] for x in sequences.ranged(p, "created_at_utc", "ts_id").groupBy("__slice").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    got = {x["ts_id"]: x["prev_ts_id"] for x in sequences.with_previous(p, "created_at_utc", "ts_id", "ts_id").collect()}
    names = [x["ts_id"] for x in some]
    assert got == dict(zip(names, [None, *names]))
    for window, least in ((10, 5), (1, 40), (10, 1), (600, 200)):
        found = sorted((x["start_et"], x["end_et"], x["count"]) for x in sequences.bursts(p, window, least).collect())
        want = sorted(x[:3] for x in plain_bursts(some, window, least))
        assert found == want, (window, least)
