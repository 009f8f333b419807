"""Tracker pages: listings, status pages and search results.

Blocks nest, so regular expressions alone cannot cut them out.  One event
parser builds a small tree of the page; the rest are look-ups in it.  Pages are
parsed in batches by ``mapInArrow``, a row of pages in, rows of posts out.
A page without the markup it is known by gives a row with ``error`` set.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.texts import PLATFORM, html_to_text, page_parameter, snippet_repost
from tidelog.functions.times import parse_eastern_text, parse_instant
from tidelog.schema import MEDIA_ITEM

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "classes", "children", "start", "end", "parent")

    def __init__(self, tag: str, attrs: dict, start: int, parent: Node | None) -> None:
        self.tag, self.attrs, self.start, self.end, self.parent, self.children = tag, attrs, start, start, parent, []
        self.classes = (attrs.get("class") or "").split()

    def has(self, name: str) -> bool:
        return name in self.classes

    def walk(self, into=lambda n: True):
        """Nodes below in page order; children of a node that ``into`` refuses are left out."""
        stack = self.children[::-1]
        while stack:
            n = stack.pop()
            yield n
            if into(n):
                stack += n.children[::-1]

    def find(self, test, into=lambda n: True):
        return next((n for n in self.walk(into) if test(n)), None)


class _Tree(HTMLParser):
    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=False)
        self.source = source
        self.lines = [0, *[m.end() for m in re.finditer("\n", source)]]
        self.root = self.at = Node("#root", {}, 0, None)
        self.feed(source)
        self.close()
        while self.at:
            self.at.end, self.at = len(source), self.at.parent

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        node = Node(tag, dict(attrs), self._offset() + len(self.get_starttag_text()), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, dict(attrs), self._offset(), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node and node.tag != tag:
            node = node.parent
        if node is None or node.parent is None:
            return
        here = self._offset()
        while self.at is not node.parent:
            self.at.end, self.at = here, self.at.parent

    def inner(self, node: Node | None) -> str | None:
        return None if node is None else self.source[node.start : node.end].strip()


def _media(card: Node, inside) -> list[dict]:
    found = []
    for n in card.walk(inside):
        if not n.has("status-attachment"):
            continue
        item = dict.fromkeys(MEDIA_ITEM.fieldNames())
        if n.has("status-attachment--image"):
            link, image = n.find(lambda x: x.tag == "a"), n.find(lambda x: x.tag == "img")
            source = image.attrs.get("src") if image else None
            own = bool(source and re.search(PLATFORM, source))
            item |= {"type": "image", "url": source if own else None, "preview_url": None if own else source, "mirror_url": (link.attrs.get("href") or None) if link else None}
        elif n.has("status-attachment--video") and (video := n.find(lambda x: x.tag == "video")):
            item |= {"type": "video", "url": video.attrs.get("src") or None, "mirror_url": video.attrs.get("poster") or None}
        else:
            continue
        found.append(item)
    return found


def _is_status(n: Node) -> bool:
    return n.tag == "div" and n.has("status")


def _card(tree: _Tree, card: Node, deep: bool = True) -> dict:
    """What a status block says itself; ``nested`` is the block inside it."""
    own = lambda n: not _is_status(n)
    handle = card.find(lambda n: n.has("status-info__meta-item") and tree.inner(n).startswith("@"), own)
    time = card.find(lambda n: n.tag == "time" and n.attrs.get("datetime"), own)
    link = card.find(lambda n: n.has("status__external-link"), own)
    ids = re.search(PLATFORM + r"/@([A-Za-z0-9_]+)/(\d+)", (link.attrs.get("href") or "") if link else "")
    nested = card.find(_is_status, own) if deep else None
    return {
        "account": tree.inner(handle)[1:] if handle else None, "ts_id": ids[2] if ids else None, "created": time.attrs["datetime"] if time else None,
        "content_html": tree.inner(card.find(lambda n: n.has("status__content"), own)) or "", "media": _media(card, own), "nested": _card(tree, nested, False) if nested else None,
    }


def _tracker_id(url: str | None) -> int | None:
    m = re.search(r"/statuses/(\d+)", url or "")
    return int(m[1]) if m else None


def _listing(source: str) -> list[dict]:
    tree = _Tree(source)
    box = tree.root.find(lambda n: n.tag == "div" and n.has("statuses"))
    if box is None:
        return [{"error": "no list of statuses"}]
    out, by, marked = [], None, False
    for n in box.walk(lambda n: not _is_status(n)):
        if n.has("status__reblog-indicator"):
            name = n.find(lambda x: x.tag == "strong")
            by, marked = tree.inner(name), True
        elif _is_status(n):
            card = _card(tree, n)
            nested = card.pop("nested")
            quote = {"quote_id": nested["ts_id"], "quote_of_acct": nested["account"]} if nested else {}
            out.append(card | quote | {"tracker_id": _tracker_id(n.attrs.get("data-status-url")), "kind": "quote" if nested else "original", "reposted": marked, "reposted_by": by})
            by, marked = None, False
    return out


def _status(source: str, handle: str) -> list[dict]:
    tree = _Tree(source)
    page = tree.root.find(lambda n: n.tag == "meta" and n.attrs.get("property") == "og:url")
    tracker_id = _tracker_id(page.attrs.get("content")) if page else None
    top = tree.root.find(_is_status)
    if tracker_id is None or top is None:
        return [{"error": "no status page"}]
    card = _card(tree, top)
    nested = card.pop("nested")
    repost = tree.root.find(lambda n: n.has("status__reblog-indicator")) is not None
    rows, key = {}, None
    for n in tree.root.walk():
        if n.has("status-details-table__key"):
            key = re.sub("<[^>]+>", "", tree.inner(n)).strip()
        elif n.has("status-details-table__value") and key is not None:
            rows[key], key = n, None

    def stated(name: str) -> dict:
        cell = rows.get(name)
        if cell is None:
            return {}
        time = cell.find(lambda n: n.tag == "time" and n.attrs.get("datetime"))
        return {"iso": time.attrs["datetime"]} if time else {"text": re.sub("<[^>]+>", " ", tree.inner(cell))}

    code = rows["TRUTH Social status ID"].find(lambda n: n.tag == "code") if "TRUTH Social status ID" in rows else None
    own_id = tree.inner(code) if code and tree.inner(code).isdigit() else card["ts_id"]
    created, captured, removed = stated("Original Post Date"), stated("Capture Date"), stated("Removed from platform")
    out = card | {
        "tracker_id": tracker_id, "ts_id": own_id, "created": created.get("iso") or (None if created else card["created"]), "created_text": created.get("text"),
        "captured": captured.get("iso"), "captured_text": captured.get("text"), "removed": "Removed from platform" in rows, "removed_text": removed.get("text") or removed.get("iso"),
        "kind": "reblog" if repost else "quote" if nested else "original",
    }
    if repost:
        out |= {"account": handle, "reblog_of_id": card["ts_id"], "reblog_of_acct": card["account"], "reblog_of_created": card["created"]}
    elif nested:
        out |= {"quote_id": nested["ts_id"], "quote_of_acct": nested["account"]}
    return [out]


def _search(source: str) -> list[dict]:
    tree = _Tree(source)
    total = re.search(r"([\d,]+)\s+results", source)
    link = tree.root.find(lambda n: n.tag == "a" and (tree.inner(n) or "").startswith("Next Page"))
    page = {"total": int(total[1].replace(",", "")) if total else None, "next_href": link.attrs.get("href") if link else None}
    box = tree.root.find(lambda n: n.has("search-page__results"))
    if box is None:  # a page beyond the last has a heading and no list
        return [page | ({} if "search-page__heading-meta" in source else {"error": "no search results"})]
    out = []
    for n in box.walk(lambda n: not n.has("search-result")):
        if n.has("search-result"):
            handle = n.find(lambda x: x.has("status-info__meta-item"))
            time = n.find(lambda x: x.tag == "time" and x.attrs.get("datetime"))
            clean = n.find(lambda x: x.has("snippet-clean-content"))
            out.append(page | {
                "tracker_id": _tracker_id(n.attrs.get("data-status-url")), "account": tree.inner(handle).lstrip("@") if handle else None,
                "removed": n.find(lambda x: x.has("status__deleted-badge")) is not None, "snippet_html": tree.inner(clean) or "", "created": time.attrs["datetime"] if time else None,
            })
    return out or [page]


_RAW = (
    f"page string, error string, tracker_id int, ts_id string, account string, kind string, content_html string, media array<{MEDIA_ITEM.simpleString()}>, created string, created_text string, "
    "captured string, captured_text string, removed boolean, removed_text string, reposted boolean, reposted_by string, quote_id string, quote_of_acct string, reblog_of_id string, reblog_of_acct string, "
    "reblog_of_created string, total int, next_href string, snippet_html string"
)


def _parse(pages: DataFrame, parse, page: str, html: str) -> DataFrame:
    """Rows of _RAW that parse gives for the pages."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_RAW))

    def over(batches):
        for batch in batches:
            rows = [{"page": str(p)} | {k: v for k, v in r.items() if k in schema.names} for p, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in parse(h or "")]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return pages.select(F.col(page).cast("string"), F.col(html).cast("string")).mapInArrow(over, _RAW)


def _instant(iso: str, text: str | None = None):
    found = parse_instant(F.col(iso))
    return found if text is None else F.coalesce(found, parse_eastern_text(F.col(text)))


def listing(pages: DataFrame, page: str = "url", html: str = "html") -> DataFrame:
    """Cards of listing pages.  A card after a repost mark is the reposted post itself, marked ``reposted``."""
    raw = _parse(pages, _listing, page, html)
    return raw.select(
        "page", "error", F.lit("tracker").alias("source"), "tracker_id", "ts_id", _instant("created").alias("created_at_utc"), "kind", "account", F.coalesce("reposted", F.lit(False)).alias("reposted"),
        html_to_text(F.col("reposted_by")).alias("reposted_by"), "content_html", "media", "quote_id", "quote_of_acct",
    )


def status_pages(pages: DataFrame, handle: str, page: str = "url", html: str = "html") -> DataFrame:
    """Posts of status pages.  A removal is known to the minute; a capture in the same minute gives the second."""
    raw = _parse(pages, lambda h: _status(h, handle), page, html)
    captured, removed = _instant("captured", "captured_text"), parse_eastern_text(F.col("removed_text"))
    same = F.substring(captured.cast("string"), 1, 16) == F.substring(removed.cast("string"), 1, 16)
    return raw.select(
        "page", "error", F.lit("tracker").alias("source"), "tracker_id", "ts_id", _instant("created", "created_text").alias("created_at_utc"), "kind", "account", F.coalesce("removed", F.lit(False)).alias("removed"),
        captured.alias("tracker_captured_at"), F.when(F.col("removed"), F.when(same, captured).otherwise(removed)).alias("tracker_removed_at"), "content_html", "media", "quote_id", "quote_of_acct",
        "reblog_of_id", "reblog_of_acct", _instant("reblog_of_created").alias("reblog_of_created_at"),
    )


def search_results(pages: DataFrame, handle: str, page: str = "url", html: str = "html") -> DataFrame:
    """Hits of search pages (tracker_id null for a page without any), with the page's total and next cursor."""
    raw = _parse(pages, _search, page, html)
    some = raw.withColumn("snippet_text", html_to_text(F.col("snippet_html")))
    return some.select(
        "page", "error", "total", page_parameter(F.col("next_href")).alias("next_cursor"), "tracker_id", "account", "removed", "snippet_text", _instant("created").alias("created_at_utc"),
        *[c.alias(k) for k, c in snippet_repost(F.col("snippet_text"), handle).items()],
    )
