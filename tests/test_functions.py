"""Scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog.functions import texts, times


def apply(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("s"))).collect()]


def test_instants(spark):
    got = apply(spark, ["2026-09-09T00:53:04.960Z", "2026-09-09 00:53:04", "2026-09-09T00:53:04+02:00", "Fri, 11 Sep 2026 01:19:51 +0000", "2026-09-09", "junk", None], lambda c: times.to_iso(times.parse_instant(c)))
    assert got == ["2026-09-09T00:53:04Z", "2026-09-09T00:53:04Z", "2026-09-08T22:53:04Z", "2026-09-11T01:19:51Z", None, None, None]


def test_instants_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = apply(spark, ["2026-03-08T02:30:00Z"], lambda c: times.to_iso(times.parse_instant(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2026-03-08T02:30:00Z"]


@pytest.mark.parametrize("text, iso", [
    ("Tuesday, September 8, 2026, 09:10 pm EDT", "2026-09-09 01:10:00"), ("Sep 8, 2026, 10:20 PM EDT", "2026-09-09 02:20:00"), ("September 10, 2026, 11:48 AM", "2026-09-10 15:48:00"),
    ("Nov 1, 2026, 1:30 AM EST", "2026-11-01 06:30:00"), ("Nov 1, 2026, 1:30 AM EDT", "2026-11-01 05:30:00"), ("Nov 1, 2026, 12:30 AM", "2026-11-01 04:30:00"), ("Jul 1, 2026, 1:30 AM EST", None), ("Foo 1, 2026, 1:30 AM", None), ("", None),
])
def test_eastern_text(spark, text, iso):
    assert apply(spark, [text], times.parse_eastern_text) == [iso and dt.datetime.fromisoformat(iso)]


def test_html_to_text(spark):
    cases = {
        "<p>a<br/>b</p><p>c</p>": "a\nb\nc", '<span class="x quote-inline">RT: u</span>said  this': "said this", "a&nbsp;b&amp;c &lt;d&gt;": "a b&c <d>", "<p>a</p>\n\n\n\n<p>b</p>": "a\n\nb", None: "", "": "", "a\r\nb": "a\nb",
    }
    assert apply(spark, list(cases), texts.html_to_text) == list(cases.values())
    more = ["caf&eacute; &mdash; it&#8217;s &hellip; &amp;lt; &ltx &#x41;&nbsp;&amp;", "<div>\u2003a\u3000</div>\x85b\x1c", "a & b &amp;eacute; &unknown; &copy", "&lt;p&gt;x&lt;/p&gt;", "a<br>\n \n\xa0\n<br/>b", "<p>x</p><h3>y</h3ns><blockquote>z</blockquote >w"]

    def plain(source):  # line by line, from the rules
        import html
        import re

        for name in ("p", "div", "li", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"):
            source = re.sub(f"</{name}[ ]*>", "\n", source)
        source = html.unescape(re.sub("<[^>]*>", "", source.replace("<br>", "\n").replace("<br/>", "\n"))).replace("\xa0", " ")
        out = []
        for line in (" ".join(re.split("[ \t\f\v]+", x)).strip() for x in source.split("\n")):
            if line or (out and out[-1]):
                out.append(line)
        return "\n".join(out).strip()

    assert apply(spark, more, texts.html_to_text) == [plain(x) for x in more]
    assert apply(spark, more, texts.html_to_text)[0] == "café — it’s … &lt; <x A &"


def test_references_cut_off_by_tags(spark):
    cases = {
        "a &amp</title><style>p{x}</style>": "a &ampp{x}", "b &am</title>p{x}": "b &amp{x}", "c &lt<br>d": "c &lt\nd", "d &</b>lt e &amp;&copy f": "d &lt e &© f", "e &am<i>p;</i> &<b>#39;</b>": "e & '", "f &amp;lt<b>;</b>": "f &lt;",
    }
    assert apply(spark, list(cases), texts.html_to_text) == list(cases.values())


def test_html_is_read_once_by_tags(spark):
    cases = {"<<br/>x": "x", 'a<i title="<br>b': "ab", "a <> b": "a <> b", 'x<span class="quote-inline">y<br>z': "xy\nz", "a<b" * 20_000: "a<b" * 20_000}
    assert apply(spark, list(cases), texts.html_to_text) == list(cases.values())
    plan = spark.sql("SELECT '<p>x</p>' AS s FROM range(1)").select(texts.html_to_text(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 1 and "lambdafunction" not in plan


def test_links_and_media(spark):
    assert apply(spark, ["https://WWW.Example.com:80/a", "http://x.org/?u=y.png", "nope", None], texts.card_domain) == ["example.com", "x.org", None, None]
    assert apply(spark, ["a.MP4", "b.jpeg?x=.mov", "c", "d.qt", "e.gif"], texts.media_type_of) == ["video", "image", "unknown", "video", "image"]


def test_reposts(spark):
    got = apply(spark, ["RT @ownThe text", "RT @a_1 more\nlines", "plain", ""], lambda c: F.struct(*[v.alias(k) for k, v in texts.repost_split(c, "own").items()]))
    assert [tuple(r) for r in got] == [("reblog", "own", "The text"), ("reblog", "a_1", " more\nlines"), ("original", None, "plain"), ("original", None, "")]
    got = apply(spark, ["RT: https://truthsocial.com/users/bob/statuses/12 x", "RT @ownX", "no"], lambda c: F.struct(*[v.alias(k) for k, v in texts.snippet_repost(c, "own").items()]))
    assert [tuple(r) for r in got] == [("bob", "12"), ("own", None), (None, None)]


def test_cursor_and_accounts(spark):
    import base64
    import json

    (c,) = apply(spark, ["2026-01-01 00:00:00"], texts.encode_cursor)
    assert json.loads(base64.b64decode(c)) == {"status_created_at": "2026-01-01 00:00:00", "_pointsToNextItems": True}
    assert apply(spark, ["/x?a=1&amp;cursor=abc", "/x?page=3", "/x", None], texts.page_parameter) == ["abc", "3", None, None]
    assert apply(spark, ['{"a":[{"account":1,"b":2}],"account":{"c":1}}', "no"], lambda c: texts.without_accounts(c)) == ['{"a":[{"b":2}]}', None]


def test_prefix_agreement(spark):
    df = spark.createDataFrame([("Hello, World!", "hello world and more", True), ("abc", "xbc", False), (None, "x", True)], "a string, b string, e boolean")
    assert all(r[0] == r[1] for r in df.select(texts.prefix_agrees(F.col("a"), F.col("b")), "e").collect())
