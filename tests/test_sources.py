"""Landed files and payloads, sinks, and streams."""

import json
import os

from pyspark.sql import functions as F
from tests import fixture
from tests.fixture import U, observation, observations, post

from tidelog import cli
from tidelog.plans import views
from tidelog.sources import landed, sinks, tracker_html
from tidelog.streaming import micro

STATUS = {
    "id": "110000000000000001", "created_at": "2026-07-01T00:00:00.123Z", "content": "<p>hi</p>", "language": "en", "pinned": False, "account": {"acct": "own", "statuses_count": 7, "followers_count": 3, "last_status_at": "2026-07-01"},
    "media_attachments": [{"type": "image", "url": "u", "preview_url": "p", "meta": {"original": {"width": 3, "height": 4}}}], "card": {"url": "https://www.x.example:1/a", "title": "t"}, "mentions": [{"acct": "m"}, {"acct": ""}], "tags": [{"name": "g"}],
    "replies_count": 1, "reblogs_count": 2, "favourites_count": 3,
}


def test_primary_payloads(spark):
    reblog = {"id": "2", "created_at": "2026-07-02T00:00:00Z", "content": "", "reblog": {"id": "9", "created_at": "2026-06-01T00:00:00Z", "content": "<p>other</p>", "account": {"acct": "bob"}}}
    quote, reply = {"id": "3", "quote": {"id": "8", "account": {"acct": "q"}}, "quote_id": "8"}, {"id": "4", "in_reply_to_id": "7", "quote_id": "8"}
    docs = spark.createDataFrame([(json.dumps([STATUS, reblog]),), (json.dumps(quote),), (json.dumps([reply, {"content": "no id"}]),)], "value string")
    found = {r["ts_id"]: r for r in landed.primary_partials(landed.statuses(docs)).collect()}
    one = found["110000000000000001"]
    assert len(found) == 4 and one["created_at_utc"] == U("2026-07-01 00:00:00.123") and one["card_domain"] == "x.example" and one["mentions"] == ["m"] and one["tags"] == ["g"]
    assert one["media"][0]["width"] == 3 and one["engagement"]["favourites"] == 3 and one["account"]["statuses_count"] == 7 and "account" not in json.loads(one["raw_primary"])
    assert (found["2"]["kind"], found["2"]["reblog_of_acct"], found["2"]["content_html"]) == ("reblog", "bob", "<p>other</p>")
    assert (found["3"]["kind"], found["3"]["quote_id"], found["3"]["quote_of_acct"]) == ("quote", "8", "q") and found["4"]["kind"] == "reply"


def test_bulk_archive(spark, tmp_path):
    rows = [{"id": "1", "created_at": "2026-07-01T00:00:00Z", "content": "RT @ownText", "media": ["a.mp4", "b.png"], "favourites_count": 5}, {"id": "2", "created_at": "2026-07-01T00:00:00Z", "content": None}, {"id": ""}]
    (tmp_path / "bulk.json").write_text(json.dumps(rows))
    found = {r["ts_id"]: r for r in landed.bulk_partials(landed.bulk_archive(spark, str(tmp_path / "bulk.json")), "own").collect()}
    assert found["1"]["kind"] == "reblog" and found["1"]["content_text"] == "Text" and [m["type"] for m in found["1"]["media"]] == ["video", "image"]
    assert found["2"]["content_text"] == "" and len(found) == 2


def card(number, handle="own", time="2026-07-01T00:00:00Z", body="<p>hi <b>there</b></p>", inner="", more=""):
    return (
        f'<div class="status" data-status-url="https://tracker.example/statuses/{number}"><a href="#" class="status-info__meta-item">@{handle}</a><time datetime="{time}">x</time>'
        f'<a href="https://truthsocial.com/@{handle}/11000000000000{number:04d}" class="status__external-link">o</a><div class="status__content">{body}</div>{more}{inner}</div>'
    )


def test_listing(spark):
    image = '<div class="status-attachment status-attachment--image"><a href="https://m/1.jpg"><img src="https://cdn.truthsocial.com/1.jpg"></a></div>'
    video = '<div class="status-attachment status-attachment--video"><video src="v.mp4" poster="v.jpg"></video></div>'
    html = f'<div class="statuses">{card(1, more=image + video)}<div class="status__reblog-indicator"><strong>Some &amp; One</strong> ReTruthed</div>{card(2, inner="<div>" + card(3, "q") + "</div>")}</div>'
    pages = spark.createDataFrame([("p", html), ("bad", "<html></html>"), ("null", None)], "url string, html string")
    found = tracker_html.listing(pages).collect()
    ok = {r["tracker_id"]: r for r in found if r["error"] is None}
    assert sorted(r["page"] for r in found if r["error"]) == ["bad", "null"] and set(ok) == {1, 2}
    assert ok[1]["ts_id"] == "110000000000000001" and ok[1]["content_html"] == "<p>hi <b>there</b></p>" and ok[1]["kind"] == "original" and not ok[1]["reposted"]
    assert [(m["type"], m["url"], m["mirror_url"]) for m in ok[1]["media"]] == [("image", "https://cdn.truthsocial.com/1.jpg", "https://m/1.jpg"), ("video", "v.mp4", "v.jpg")]
    assert ok[2]["kind"] == "quote" and ok[2]["quote_of_acct"] == "q" and ok[2]["reposted"] and ok[2]["reposted_by"] == "Some & One"
    assert landed.of_account(tracker_html.listing(pages), "own").count() == 2


def test_status_page(spark):
    def page(rows, before=""):
        cells = "".join(f'<tr><td class="status-details-table__key"> {k} </td><td class="status-details-table__value"> {v} </td></tr>' for k, v in rows)
        return f'<meta property="og:url" content="https://tracker.example/statuses/77">{before}{card(5, "other")}<table>{cells}</table>'

    rows = [("TRUTH Social status ID", "<code>123</code>"), ("Original Post Date", "September 8, 2026, 9:10 PM EDT"), ("Capture Date", '<time datetime="2026-09-09T02:20:31Z">x</time>'), ("Removed from platform", "Yes, removed Sep 8, 2026, 10:20 PM EDT")]
    pages = spark.createDataFrame([("a", page(rows, '<div class="status__reblog-indicator">x</div>')), ("b", page([])), ("c", "x")], "url string, html string")
    found = {r["page"]: r for r in tracker_html.status_pages(pages, "own").collect()}
    a = found["a"]
    assert (a["tracker_id"], a["ts_id"], a["kind"], a["account"], a["reblog_of_acct"], a["removed"]) == (77, "123", "reblog", "own", "other", True)
    assert a["created_at_utc"] == U("2026-09-09 01:10:00") and a["tracker_removed_at"] == U("2026-09-09 02:20:31") == a["tracker_captured_at"]
    assert found["b"]["kind"] == "original" and found["b"]["ts_id"] == "110000000000000005" and not found["b"]["removed"] and found["c"]["error"]


def test_search_feed_and_stats(spark, tmp_path):
    hit = '<div class="search-result" data-status-url="https://tracker.example/statuses/{n}"><a class="status-info__meta-item">@own</a>{badge}<time datetime="2026-07-01T00:00:00Z"></time><div class="snippet-clean-content">{s}</div></div>'
    html = '1,234 results<div class="search-page__results">' + hit.format(n=1, badge='<i class="status__deleted-badge"></i>', s="RT: https://truthsocial.com/users/bob/statuses/55 x") + hit.format(n=2, badge="", s="RT @ownX") + '</div><a href="/search?a=1&amp;cursor=abc">Next Page</a>'
    pages = spark.createDataFrame([("a", html), ("b", '<p class="search-page__heading-meta">4 results</p>'), ("c", "x")], "url string, html string")
    found = tracker_html.search_results(pages, "own").collect()
    a = {r["tracker_id"]: r for r in found if r["page"] == "a"}
    assert a[1]["total"] == 1234 and a[1]["next_cursor"] == "abc" and a[1]["removed"] and (a[1]["reblog_of_acct"], a[1]["reblog_of_id"]) == ("bob", "55") and a[2]["reblog_of_acct"] == "own"
    assert [(r["total"], r["error"]) for r in found if r["page"] == "b"] == [(4, None)] and [r["error"] for r in found if r["page"] == "c"] == ["no search results"]
    (tmp_path / "feed.xml").write_text('<rss xmlns:truth="x"><channel><item><title>t</title><link>https://h/statuses/9</link><truth:originalId>123</truth:originalId><pubDate>Fri, 11 Sep 2026 01:19:51 +0000</pubDate><description>d</description></item></channel></rss>')
    (r,) = landed.feed_items(spark, str(tmp_path / "feed.xml")).collect()
    assert (r["ts_id"], r["tracker_id"], r["created_at_utc"]) == ("123", 9, U("2026-09-11 01:19:51"))
    stats = '<i class="stats-page__summary-value--total">1,200</span>' + "".join(f'<div class="stats-page__summary-card--{k}"><span class="stats-page__summary-value">{n}</span>' for k, n in (("original", "1,000"), ("quote", 150), ("reblog", 50))).replace('"><span', '">\n<span') + "<strong>Total archive coverage:</strong> February 14, 2022 – September 11, 2026</p>"
    got = spark.createDataFrame([(stats,)], "h string").select(*[c.alias(k) for k, c in landed.stats_page(F.col("h")).items()]).first()
    assert (got["total"], got["original"], got["quote"], got["reblog"], str(got["coverage_start"]), str(got["coverage_end"])) == (1200, 1000, 150, 50, "2022-02-14", "2026-09-11")


def test_round_trip_and_exports(spark, tmp_path):
    root = str(tmp_path)
    assert landed.posts(spark, root).count() == 0 and landed.engagement(spark, root).count() == 0 and landed.state(f"{root}/s.json") == {"version": 1, "sources": {}}
    p = fixture.posts(spark)
    sinks.save_posts(p, root)
    back = landed.posts(spark, root)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, p.collect())) and len([x for x in os.listdir(f"{root}/posts") if x.startswith("month=")]) == len({r["created_at_utc"].month for r in fixture.archive()})
    sinks.save_posts(back.filter("created_at_utc < timestamp_ntz'2026-07-01'"), root)
    early = [r for r in fixture.archive() if r["created_at_utc"].month < 7]
    assert landed.posts(spark, root).count() == len(early) and len([x for x in os.listdir(f"{root}/posts") if x.startswith("month=")]) == 6
    sinks.append_engagement(fixture.snapshots(spark), root)
    sinks.append_engagement(fixture.snapshots(spark), root)
    assert landed.engagement(spark, root).count() == 2 * len(fixture.snapshot_rows()) == landed.engagement(spark, root).filter("upvotes is null").count()
    sinks.append_log(fixture.deletion_log(spark), f"{root}/deletions")
    sinks.append_log(fixture.runs(spark), f"{root}/runs/2026-08")
    assert landed.deletion_log(spark, root).count() == fixture.deletion_log(spark).count() and landed.runs(spark, root).count() == 2
    sinks.export_posts(p, f"{root}/csv")
    (name,) = [x for x in os.listdir(f"{root}/csv") if x.endswith(".csv")]
    lines = open(f"{root}/csv/{name}", encoding="utf-8").read().splitlines()
    assert len(lines) == len(fixture.archive()) + 1 and lines[0].split(",") == list(sinks.EXPORT_COLUMNS)
    sinks.save_state({"b": 1}, f"{root}/s.json")
    assert landed.state(f"{root}/s.json") == {"b": 1}
    assert cli.load(spark, root)["v_posts_et"].columns == list(views.VIEW_COLUMNS)


def test_stream_merges_like_one_batch_and_repeats_nothing(spark, tmp_path):
    root, inbox, mark = str(tmp_path / "data"), str(tmp_path / "in"), str(tmp_path / "mark")
    rows = [observation(i, "primary", f"2026-07-0{1 + i} 12:00", created_at_utc=U("2026-07-01 00:00"), content_html=f"<p>{i}</p>", gone=i == 2) for i in range(4)]
    for part in (rows[:2], rows[2:]):
        observations(spark, part).coalesce(1).write.mode("append").parquet(inbox)
        micro.run_merge(micro.observation_stream(spark, inbox), root, mark).awaitTermination()
    (r,) = landed.posts(spark, root).collect()
    assert r["content_text"] == "3" and r["status"] == "present" and r["deleted_upper"] == U("2026-07-03 12:00")
    assert landed.deletion_log(spark, root).count() == 1
    micro.run_merge(micro.observation_stream(spark, inbox), root, mark).awaitTermination()
    assert landed.deletion_log(spark, root).count() == 1 and landed.posts(spark, root).count() == 1


def test_stream_throttle(spark, tmp_path):
    inbox = str(tmp_path / "in")
    schema = "ts_id string, observed_at timestamp_ntz, favourites long"
    name = "throttled_rows"
    for k, hours in enumerate((["00:00", "00:30"], ["00:59", "01:00", "02:30"])):
        spark.createDataFrame([("p", U(f"2026-07-01 {h}"), 1) for h in hours], schema).coalesce(1).write.mode("append").parquet(inbox)
        q = micro.throttled(spark.readStream.schema(schema).parquet(inbox)).writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert k < 2
    assert sorted(r["observed_at"].strftime("%H:%M") for r in spark.read.parquet(str(tmp_path / name)).collect()) == ["00:00", "01:00", "02:30"]


def test_commands(spark, tmp_path, capsys):
    root = str(tmp_path / "d")
    sinks.save_posts(fixture.posts(spark, [post(1, "2026-07-01 00:00")]), root)
    assert cli.main(["query", "--root", root, "--sql", "SELECT count(*) AS n FROM posts", "--format", "csv"]) == 0
    assert capsys.readouterr().out == "n\n1\n\n"
    assert cli.main(["weekly", "--root", root, "--week", "2026-W27", "--out", str(tmp_path / "w"), "--trailing-weeks", "1"]) == 0
    assert len(os.listdir(tmp_path / "w")) == 9
    assert cli.main(["check", "--root", root, "--now", "2026-07-01T06:00:00Z"]) == 0


def test_collect(spark, tmp_path, capsys):
    """Two runs over landed payloads: posts, a removal, a missing post, snapshots, exports and run rows."""
    root, inbox, out = str(tmp_path / "data"), tmp_path / "in", str(tmp_path / "out")
    for folder in ("primary", "bulk", "tracker/status"):
        (inbox / folder).mkdir(parents=True)
    status = lambda n, **more: STATUS | {"id": f"{110000000000000000 + n}", "created_at": f"2026-07-01T0{n}:00:00Z"} | more

    def land(name, text, day):
        (inbox / name).write_text(text)
        os.utime(inbox / name, (U(f"{day} 12:00").timestamp(),) * 2)

    land("primary/a.json", json.dumps([status(1), status(2), status(3, account={"acct": "own", "statuses_count": 3})]), "2026-07-01")
    land("bulk/a.json", json.dumps([{"id": f"{110000000000000000 + n}", "created_at": f"2026-07-01T0{n}:00:00Z", "content": "RT @bob more", "media": []} for n in (2, 4)]), "2026-07-02")
    run = lambda day, *more: cli.main(["collect", "--root", root, "--inbox", str(inbox), "--output", out, "--now", f"{day}T13:00:00Z", *more])
    assert run("2026-07-02") == 0 and "+4 posts, +0 deletions, checks ok" in capsys.readouterr().out
    found = {int(r["ts_id"][-1]): r for r in landed.posts(spark, root).collect()}
    assert set(found) == {1, 2, 3, 4} and found[2]["kind"] == "original" and found[2]["seen_sources"] == ["bulk", "primary"] and found[4]["kind"] == "reblog" and found[1]["content_text"] == "hi"
    assert landed.engagement(spark, root).count() == 5 and landed.state(f"{root}/state.json")["sources"]["primary"]["statuses_count"] in (3, 7)
    # the second page lacks the second post, a verification finds the third gone, the tracker saw the first removed
    land("primary/b.json", json.dumps([status(1), status(3)]), "2026-07-03")
    land("primary/c.json", json.dumps({"id": "110000000000000003", "error": "Record not found"}), "2026-07-04")
    land("tracker/status/d.html", f'<meta property="og:url" content="https://tracker.example/statuses/1">{card(1)}<table><tr><td class="status-details-table__key">Removed from platform</td><td class="status-details-table__value">Yes, removed Jul 4, 2026, 9:00 AM EDT</td></tr></table>', "2026-07-05")
    assert run("2026-07-05") == 0 and "+0 posts, +2 deletions" in capsys.readouterr().out
    found = {int(r["ts_id"][-1]): r for r in landed.posts(spark, root).collect()}
    assert [n for n in sorted(found) if found[n]["status"] == "deleted"] == [1, 3] and found[3]["deleted_source"] == "gone" and found[1]["deleted_upper"] == U("2026-07-04 13:00:00")
    assert landed.state(f"{root}/state.json")["sources"]["primary"]["verify"] == ["110000000000000002"]
    assert landed.deletion_log(spark, root).count() == 2 and landed.runs(spark, root).count() == 6 and landed.keyed_posts(spark, root).count() == 4
    assert {"checks.json", "posts.csv", "metrics.json"} <= set(os.listdir(out))
    assert run("2026-07-05") == 0 and "+0 posts, +0 deletions" in capsys.readouterr().out
    assert cli.main(["check", "--root", root, "--now", "2026-07-05T13:00:00Z"]) == 0
    assert cli.main(["materialize", "--root", root, "--database", "kept"]) == 0 and "posts  4" in capsys.readouterr().out
    assert spark.table("kept.posts").count() == 4
    for t in ("posts", "engagement", "deletions", "runs", "media"):
        spark.sql(f"DROP TABLE kept.{t}")
    spark.sql("DROP DATABASE kept")


def test_posts_moved_aside_are_still_there(spark, tmp_path):
    """A swap that died between its renames: readers see the old data, and the next swap goes on."""
    root = str(tmp_path)
    sinks.save_posts(fixture.posts(spark, [post(1, "2026-07-01 00:00"), post(2, "2026-08-01 00:00")]), root)
    os.rename(f"{root}/posts/month=2026-07", f"{root}/posts/month=2026-07.old")
    assert landed.posts(spark, root).count() == 2
    sinks.save_posts_of(fixture.posts(spark, [post(1, "2026-07-01 00:00"), post(3, "2026-07-02 00:00")]), root, ["2026-07"])
    assert sorted(r["ts_id"][-1] for r in landed.posts(spark, root).collect()) == ["1", "2", "3"] and not os.path.exists(f"{root}/posts/month=2026-07.old")
    os.rename(f"{root}/posts", f"{root}/posts.old")
    assert landed.posts(spark, root).count() == 3


def test_unprocessed_removals(spark):
    hits = spark.createDataFrame([(1, True), (2, False), (3, True), (3, True), (None, True)], "tracker_id int, removed boolean")
    assert [r[0] for r in landed.unprocessed(hits, spark.createDataFrame([(1,)], "tracker_id int")).collect()] == [3]


def test_statuses_and_verifications_in_one_pass(spark):
    from tidelog.functions.times import parse_instant

    raws = [
        '{"id": "1", "created_at": "2026-07-01T00:00:00Z", "content": "<p>a</p>", "account": {"acct": "own", "statuses_count": 3}, "favourites_count": 2}', '{"id": "2", "error": "Record not found"}', '{"id": "3", "error": ""}',
        '{"id": "4", "error": null, "created_at": "2026-07-01 00:00:00+02:00", "card": {"url": "https://www.a.example/x", "title": "t"}}', '{"id": "", "error": "x"}', '{"error": "x"}', '{"id": "5", "favourites_count": "many", "error": {"code": 1}}', "{}", "7", "null", '{"id": 6}', '{"id": "8", "reblog": {"id": "9", "content": "r"}, "error": 404, "created_at": "2026-07-01T00:00:00Z"}',
    ]
    raw = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "n int, raw string")
    apart = landed.primary_partials(raw, ("n",)).unionByName(landed.gone(raw, ("n",)), allowMissingColumns=True)
    once = landed.primary_rows(raw, ("n",)).select(*apart.columns)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, apart.collect())) and once.count() == 7
    # a text is parsed by one expression of the plan
    assert landed.primary_rows(raw, ("n",))._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    texts = ["2026-07-01T00:00:00Z", " 2026-07-01T00:00:00Z", "2026-07-01T00:00:00Z\n", "2026-02-30T00:00:00Z", "2026-07-01T24:00:00Z", "2026-07-01T02:00:00+02:00", "2026-07-01T00:00:00.5Z", "2026-07-01", None]
    found = [str(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(parse_instant(F.col("t"))).collect()]
    assert found == ["2026-07-01 00:00:00", "2026-07-01 00:00:00", "None", "None", "None", "2026-07-01 00:00:00", "2026-07-01 00:00:00.500000", "None", "None"]
