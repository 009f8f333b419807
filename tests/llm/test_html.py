"""HTML extraction against a plain recursive version over random trees, and pages that word lists or link rules must not spoil."""

from __future__ import annotations

import math
import random
import xml.etree.ElementTree as ET

import pytest

from tidelog.llm import html_text

P = "<p>A paragraph that says enough in plain words to be taken for content of the page.</p>"
LINE = "A paragraph that says enough in plain words to be taken for content of the page."


def size(text: str | None) -> int:
    return len("".join((text or "").split()))


def counts(e: ET.Element, in_link: bool = False) -> tuple[int, int, int, int]:
    """(characters, tags below, link characters, links below or at) of an element, by recursion."""
    c, t, lc, lt = size(e.text), 0, 0, 0
    for child in e:
        cc, ct, clc, clt = counts(child, in_link or e.tag == "a")
        c, t, lc, lt = c + cc + size(child.tail), t + ct + 1, lc + clc, lt + clt
    if e.tag == "a" and not in_link:
        lc, lt = c, 1
    return c, t, lc, lt


def density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    if c == 0:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / max(t, 1) * math.log(max(1.0, c * max(t, 1) / (max(lc, 1) * max(lt, 1)))) / math.log(base + math.e - 1)


def tree(r: random.Random, depth: int = 0) -> str:
    word = lambda n: " ".join(r.choice(["one", "seven", "river", "x", "stone"]) for _ in range(n))
    parts = []
    for _ in range(r.randint(1, 4)):
        kind = r.random()
        if kind < 0.35 and depth < 4:
            parts.append(f"<div>{tree(r, depth + 1)}</div>")
        elif kind < 0.7:
            parts.append(f"<p>{word(r.randint(1, 25))}<b>{word(1)}</b></p>")
        elif kind < 0.9:
            parts.append(f"<a href='u'>{word(r.randint(1, 3))}</a>")
        else:
            parts.append(f"<span>{word(2)}</span>")
    return "".join(parts)


def test_densities_equal_plain_recursion():
    r = random.Random(9)
    for _ in range(150):
        source = f"<html><body>{tree(r)}</body></html>"
        root = ET.fromstring(source)
        body = root.find("body")
        order = list(root.iter())
        c, _, lc, _ = counts(root)
        share = lc / max(c, 1)
        want = [density(*counts(e), share) if not (e.tag == "a") else density(*counts(e), share) for e in order]
        own = []
        for e in order:
            text = size(e.text) + sum(size(x.tail) for x in e)
            link = text if e.tag == "a" else 0
            own.append(density(text, 1, link, 0, share) + sum(want[order.index(x)] for x in e))
        page = html_text._Page(source)
        dense, sums, _ = page.densities(page.cut_off(True))
        assert page.name[1:] == [e.tag for e in order]
        assert dense[1:] == pytest.approx(want) and sums[1:] == pytest.approx(own)
        # the climb, told again
        parent = {x: e for e in order for x in e}
        core = order[max(range(len(order)), key=lambda i: (sums[i + 1], -i))] if max(sums[1:]) >= sums[0] else None
        if core is None or core in (body, root):
            continue
        at, most = core, want[order.index(core)]
        while parent[at] is not body and want[order.index(parent[at])] >= html_text.HOLD * most:
            at = parent[at]
            most = max(most, want[order.index(at)])
        tops, marked = page.chosen(dense, sums)
        assert not marked and order.index(at) + 1 in tops
        assert len(tops) == 1 or all(parent[order[i - 1]] is body for i in tops)


@pytest.mark.parametrize("page, text", [
    # a form around the page, as server-side frameworks have it
    (f"<body><form id='aspnetForm'><div>{P * 3}</div></form><div><a href='/'>home</a></div></body>", "\n".join([LINE] * 3)),
    # a small form stays out
    (f"<body><div>{P * 3}<form><p>Search here</p></form></div></body>", "\n".join([LINE] * 3)),
    # a name that is the topic
    (f"<body><div class='legal-news article-body'>{P * 3}</div><div>One line.</div></body>", "\n".join([LINE] * 3)),
    (f"<body><div class='social-policy'><h1>Title</h1>{P * 3}</div></body>", "\n".join(["Title", *[LINE] * 3])),
    # names of one meaning: a long thread of comments is none of it, a wrapper with the article inside is
    (f"<body><article><h1>Title</h1><p>A short article, and that is all.</p></article><div id='comments'>{P * 9}</div></body>", "Title\nA short article, and that is all."),
    (f"<body><div class='content-sidebar'><article>{P * 3}</article></div><p>Imprint</p></body>", "\n".join([LINE] * 3)),
    # links are text of an article
    (f"<body><article>{P}<ul><li><a href='1'>Source one</a></li><li><a href='2'>Source two</a></li><li><a href='3'>Source three</a></li></ul><p><a>a</a>, <a>b</a>, <a>c</a></p></article></body>", f"{LINE}\nSource one\nSource two\nSource three\na, b, c"),
    # elsewhere a block of links alone is a menu, one with words between is not
    (f"<body><div>{P * 3}<div><a>A</a><a>B</a><a>C</a></div><p>See <a>one place</a>, <a>another place</a> and <a>a third place</a>.</p></div></body>", "\n".join([*[LINE] * 3, "See one place, another place and a third place."])),
    # a notice longer than a short article, and a page header longer than the text, are not the text
    (f"<body><div class='notice'>{P * 3}</div><article><p>Short.</p></article></body>", "Short."),
    ("<body><header><h1>The name of the site</h1></header><p>Short text.</p></body>", "Short text."),
    (f"<body><main><div class='legal-news'>{P * 3}</div><div>line</div></main></body>", "\n".join([*[LINE] * 3, "line"])),
    # comments as article elements
    (f"<body><article>{P * 2}</article><article class='comment'>{P * 5}</article></body>", "\n".join([LINE] * 2)),
])
def test_what_stays(page, text):
    assert html_text.main_text(page) == text


THREE, FIVE = "\n".join([LINE] * 3), "\n".join([LINE] * 5)


@pytest.mark.parametrize("page, text", [
    # a word inside a longer name says nothing
    (f"<body><div class='post comments-enabled'>{P * 3}</div><p>x</p></body>", THREE),
    # headlines, leads and loose text before or between what is chosen
    (f"<body><h1>Headline</h1><div>{P * 3}</div></body>", f"Headline\n{THREE}"), (f"<body><div><p>Lead.</p></div><div>{P * 5}</div></body>", f"Lead.\n{FIVE}"),
    (f"<body><div>{P * 3}</div><h2>Then</h2><div>{P * 3}</div></body>", f"{THREE}\nThen\n{THREE}"), (f"<body>Loose lead.<div>{P * 3}</div></body>", f"Loose lead.\n{THREE}"),
    (f"<body><div><a href='/'>Home</a> <a href='/a'>About us</a></div><div>{P * 3}</div></body>", THREE),
    # short texts follow the rules of long ones
    ("<body><div class='legal'><p>Short item</p></div></body>", "Short item"), ("<body><div class='legal'><p>Short item</p></div><p>x</p></body>", "Short item\nx"),
    # readers' comments, articles or not, longer than the article or not
    (f"<body><div id=content>{P * 2}</div><div class=comments>{f'<article>{P * 3}</article>' * 5}</div></body>", "\n".join([LINE] * 2)),
    (f"<body><div id=content>{P * 2}</div><div class='discussion'>{P * 9}</div></body>", "\n".join([LINE] * 2)), (f"<body><article>{P}<section id='comments-area'>{P * 9}</section></article></body>", LINE),
    (f"<body><div id=content>{P * 5}</div>" + f"<div class='c-1x'>{P}</div>" * 3 + "</body>", FIVE), (f"<body><div class=comments>{P * 3}</div></body>", THREE),
])
def test_names_and_neighbours(page, text):
    assert html_text.main_text(page) == text


def test_cutting_equals_plain_recursion():
    """Which nodes are cut by their names, told again over random trees: shares of the text without readers' parts, mains elsewhere, headings of headers."""
    r = random.Random(3)
    kinds = {"": html_text.OPEN, "story": html_text.OPEN, "legal-box": html_text.OTHER, "site-header": html_text.HEADER, "left-sidebar": html_text.SURE, "comment-list": html_text.READER}

    def made(depth: int = 0) -> str:
        out = ""
        for _ in range(r.randint(1, 4)):
            tag, name = r.choice(["div", "div", "section", "h2", "article", "p"]), r.choice(list(kinds))
            inner = made(depth + 1) if depth < 3 and tag not in ("h2", "p") and r.random() < 0.8 else "word " * r.randint(0, 12)
            out += f"<{tag} class='{name if tag not in ('article', 'p', 'h2') else ''}'>{inner}</{tag}>"
        return out

    def reader(e) -> bool:
        return kinds[e.get("class") or ""] == html_text.READER

    def chars(e, headings: bool = True) -> int:
        if not headings and e.tag == "h2":
            return 0
        return size(e.text) + sum((0 if reader(x) else chars(x, headings)) + size(x.tail) for x in e)

    def mains(e) -> int:
        whole = size(e.text) + sum((0 if reader(x) else chars(x)) + size(x.tail) for x in e)
        return int(e.tag == "article" and whole > 0) + sum(mains(x) for x in e if not reader(x))

    for _ in range(150):
        source = f"<html><body>{made()}</body></html>"
        root, off = ET.fromstring(source), {}
        total, all_mains = chars(root), mains(root)

        def walk(e, gone: bool, above: int, in_article: bool) -> None:
            mark = kinds[e.get("class") or ""]
            if mark == html_text.HEADER and in_article:
                mark = html_text.OPEN
            most, only = 2 * chars(e) > total, all_mains <= mains(e) + above
            keep = {html_text.OPEN: True, html_text.OTHER: most and only, html_text.HEADER: 2 * chars(e, False) > total and only, html_text.SURE: most and only and mains(e) > 0, html_text.READER: False}[mark]
            off[e] = gone or not keep
            for x in e:
                walk(x, off[e], above + (e.tag == "article"), in_article or e.tag == "article")

        walk(root, False, 0, False)
        assert html_text._Page(source).cut_off(True)[1:] == [off[e] for e in root.iter()], source


def test_empty_null_and_clashing(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (None, None, "", "x"), (2, "u", "<p>a</p>", "x"), (2, "u", "<p>a</p>", "x")], "page_id long, url string, html string, text string")
    got = sorted((x["page_id"] or 0, x["url"] or "", x["text"], x["n_chars"]) for x in html_text.extract(df).collect())
    assert got == [(0, "", "", 0), (1, "u", "", 0), (2, "u", "a", 1), (2, "u", "a", 1)] and html_text.extract(df.limit(0)).count() == 0
