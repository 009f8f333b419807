"""Main text of web pages by composite text density.

A page is read into a small DOM (implied end tags, void and raw-text elements,
broken markup).  Scripts, styles, navigation, page footers, asides, form
controls and what is hidden are cut off first.  Then names count, word by word
of a class or id: a name marks a block only if all its words do, or say nothing
(``comments-area`` is comments, ``comments-enabled`` is not).

* Readers' comments are cut off.
* Names of one meaning (sidebar, cookies) are cut off unless the block holds more
  than half of the page's text, with an article or main element inside.
* Names that can be a topic (legal, share) and forms are cut off unless the block
  holds more than half of the text and no article or main element stands
  elsewhere: then the name says what the text is about, or the form wraps the page.
* Page headers likewise, where headings do not count as text.

What is left has no length below which rules change.  Every other node gets its
link-adjusted characters per tag

    C/T * log(C*T / (LC*LT)) / log(log(C/NC*LC + LB/CB*C + e) + e - 1)

with C characters, T tags, LC link characters, LT link tags, NC = C - LC and
LB/CB the page's own share of link characters.  The density sum of a node adds
the densities of its children; the node of the largest sum is the core.  From
it the path to the body is climbed: to an enclosing article or main element,
or else as long as the parent's density stays above a threshold, ``HOLD`` of
the largest density on the path so far.  Where the climb ends directly below
body, its neighbours there above the same threshold stay too, and so does what
stands before or between them and is not mostly links (headlines, leads, loose
text); but not three blocks or more of one tag and class after the core, which
are readers' or teasers.  Of an article or main element all is kept; elsewhere
blocks inside the chosen subtree that are nothing but three links or more, of
density 0, go as menus.

Text: character references are decoded, white space inside a block becomes one
blank (a line break counts as white space), blocks are trimmed, empty ones go,
the others are joined by one line feed in page order.

Nulls: a null or empty html, or a page without text, gives an empty text; null
page_id and url stay null.  A page is one row in and one row out, repeated rows
too; no pages, no rows.  Other columns are ignored, whatever their names.  Where
names leave nothing, they are not believed.  Time is linear in the page; nesting is handled without recursion.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_map, texts_of

HOLD = 0.5
#: So many neighbours of one tag and class after the core are a list of something else.
REPEATED = 3

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption html legend option optgroup tbody td tfoot th thead tr dd dt li".split()) | frozenset(["li", "dd", "dt"])
#: start tag -> (open tags it ends, tags that stop the search)
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "tbody": (frozenset("thead tbody tfoot".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot".split()), frozenset(["table"])),
}
SCOPE = frozenset("table td th caption html body button object".split())

# What is no main text: by element, role and name.  Forms and page headers are judged by their share of the text.
CUT_TAGS = frozenset("nav footer aside button select input label fieldset svg canvas audio video object embed dialog menu map head".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar tablist".split())
#: Words of names: readers' comments; of one meaning; those that can also be a topic; page headers; and words that say nothing.
READER_WORDS = frozenset("comment comments commentlist respond disqus replies reply discussion discussions".split())
SURE_WORDS = frozenset(
    "ad ads adsense adbox adslot nav navs navbar navigation menu menus breadcrumb breadcrumbs topbar masthead footer footers sidebar sidebars signup login cookie cookies consent gdpr popup popups modal modals overlay toolbar "
    "pagination pager outbrain taboola".split()
)
OTHER_WORDS = frozenset("side share sharing skip copyright legal disclaimer notice notices notification notifications alert alerts subscription newsletter newsletters related social".split())
#: Beginnings of words that count as the words do.
SURE_STARTS, OTHER_STARTS = ("advert",), ("banner", "sponsor", "promo", "recommend", "subscribe")
HEADER_WORDS = frozenset("header headers widget widgets".split())
PLAIN_WORDS = frozenset(
    "area areas bar bars block blocks body bottom box boxes btn button buttons col column container content entry footer form global group holder icons inner item items left links list main outer page panel primary right row "
    "secondary section site slot small sub text thread title top unit widget wrap wrapper zone".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of an article element that is a reader's.
READERS = re.compile(r"(?:^|\s)(?:comment|reply)(?:[_-](?:body|item|content|entry))?(?=$|\s)")
#: Names that say what a block has or lacks, not what it is.
STATES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|show|hide|is|js)[-_][\w-]+")
KEEP_TAGS = frozenset(["article", "main", "body", "html"])

_TAG = re.compile(r"""<(?:(?P<c>!--)|(?P<d>[!?][^>]*>?)|(?P<e>/?)(?P<n>[a-zA-Z][^\s/>]*)(?P<a>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z)))""")
_ATTR = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/>"']|\Z)""", re.I)
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for n in RAW}


#: What a node's markup says of it: main text or anything; no main text unless it holds most, unless that without its headings, unless that with an article inside; a reader's; no main text at all.
OPEN, OTHER, HEADER, SURE, READER, CUT = range(6)


def _named(names: str) -> int:
    """The strongest mark that a class or id gives: one whose words all say so, or nothing."""
    found = OPEN
    for token in names.split():
        words = [w for w in re.split(r"[-_:.]+", token) if w and not w.isdigit()]
        marks = [READER if w in READER_WORDS else SURE if w in SURE_WORDS or w.startswith(SURE_STARTS) else OTHER if w in OTHER_WORDS or w.startswith(OTHER_STARTS) else HEADER if w in HEADER_WORDS else OPEN if w in PLAIN_WORDS else None for w in words]
        if marks and None not in marks:
            found = max(found, *marks)
    return found


def _marked(name: str, attributes: str, in_article: bool) -> tuple[int, bool, str]:
    """(how sure it is no main text, whether it is marked as main text, its class and id).  A header inside an article is the article's own."""
    if name in CUT_TAGS:
        return CUT, False, ""
    role = names = ""
    main = name in ("article", "main")
    for m in _ATTR.finditer(attributes) if len(attributes) > 3 else ():
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "role":
            role = value.strip()
        elif key == "hidden" or key == "aria-hidden" and value.strip() == "true":
            return CUT, False, ""
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return CUT, False, ""
        elif key == "itemprop":
            main |= value.strip() == "articlebody"
        else:
            names += " " + value
    if role in CUT_ROLES:
        return CUT, False, ""
    main |= role in ("main", "article")
    names = STATES.sub("", names)
    if name in KEEP_TAGS:
        return (READER, False, names) if name == "article" and READERS.search(names) else (OPEN, main, names)
    mark = _named(names)
    if mark == HEADER and in_article:
        mark = OPEN
    if name == "form" or role == "form":
        mark = max(mark, OTHER)
    if name == "header" and not in_article:
        mark = max(mark, HEADER)
    return mark, main, names


class _Page:
    """The DOM as parallel lists: a node's parent stands before it."""

    def __init__(self, source: str) -> None:
        self.name, self.parent, self.main, self.link, self.mark, self.named = ["#root"], [-1], [False], [False], [OPEN], [""]
        self.chars: list[int] = [0]
        #: (node, text) and (node, None) where a block begins or ends
        self.flow: list[tuple[int, str | None]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, cut_at, in_article, at, size = [0], 0, 0, 0, len(source)
        names = self.name
        while at < size:
            m = _TAG.search(source, at)
            if not cut_at and (m is None or m.start() > at):
                self._text(stack[-1], source[at : m.start() if m else size])
            if m is None:
                return
            at = m.end()
            if m["c"]:
                end = source.find("-->", at)
                at = size if end < 0 else end + 3
                continue
            if m["d"]:
                continue
            name = m["n"].lower()
            if m["e"]:
                depth = self._opened(stack, name)
                if depth:
                    for node in stack[depth:]:
                        in_article -= names[node] in ("article", "main")
                    del stack[depth:]
                    if name in BLOCK and not cut_at:
                        self.flow.append((stack[-1], None))
                    if cut_at and len(stack) < cut_at:
                        cut_at = 0
                continue
            if name in RAW:
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else size
                continue
            if name == "br" and not cut_at:
                self.flow.append((stack[-1], " "))
            if name in ENDS_P:
                self._close(stack, frozenset(["p"]), SCOPE)
            if name in ENDS:
                self._close(stack, *ENDS[name])
            if cut_at and len(stack) < cut_at:
                cut_at = 0
            mark, main, named = (CUT, False, "") if cut_at else _marked(name, m["a"], in_article > 0)
            if name in VOID:
                if mark < CUT and name == "hr":
                    self.flow.append((stack[-1], None))
                continue
            node = len(names)
            names.append(name), self.parent.append(stack[-1]), self.main.append(main), self.chars.append(0), self.mark.append(mark), self.named.append(named)
            self.link.append(self.link[stack[-1]] or name == "a")
            if name in BLOCK and not cut_at:
                self.flow.append((stack[-1], None))
            stack.append(node)
            in_article += name in ("article", "main")
            if mark == CUT and not cut_at:
                cut_at = len(stack)

    def _opened(self, stack: list[int], name: str) -> int:
        """Depth of the open element that an end tag ends, 0 for none; an inline one does not end blocks."""
        for depth in range(len(stack) - 1, 0, -1):
            opened = self.name[stack[depth]]
            if opened == name:
                return depth
            if name not in BLOCK and opened in BLOCK or name == "p" and opened in SCOPE:
                return 0
        return 0

    def _close(self, stack: list[int], ends: frozenset, stops: frozenset) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            opened = self.name[stack[depth]]
            if opened in ends:
                del stack[depth:]
                return
            if opened in stops or opened in ("article", "main", "section", "div", "blockquote") and "p" in ends and opened != "p":
                return

    def _text(self, node: int, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if text:
            self.chars[node] += len("".join(text.split()))
            self.flow.append((node, text))

    def cut_off(self, by_name: bool) -> list[bool]:
        """Which nodes are no main text; without by_name names, forms and headers count for nothing."""
        n = len(self.name)
        c, mains, above, heads = self.chars[:], [int(m) for m in self.main], [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            mains[i] *= c[i] > 0  # one without text is none
            if self.name[i] in HEADINGS:
                heads[i] = c[i]
            if by_name and self.mark[i] == READER:
                continue  # readers' text is no part of the page's
            p = self.parent[i]
            c[p] += c[i]
            mains[p] += mains[i]
            heads[p] += heads[i]
        off = [False] * n
        for i in range(1, n):
            p = self.parent[i]
            above[i] = above[p] + self.main[p]
            only = mains[0] <= mains[i] + above[i]
            most = 2 * c[i] > c[0]
            held = {OPEN: True, OTHER: most and only, HEADER: 2 * (c[i] - heads[i]) > c[0] and only, SURE: most and only and mains[i] > 0, READER: False, CUT: False}[self.mark[i]]
            off[i] = off[p] or self.mark[i] == CUT or by_name and not held
        return off

    def densities(self, off: list[bool]) -> tuple[list[float], list[float], list[tuple[int, int, int]]]:
        """(composite density, density sum, (characters, link characters, link tags)) of every node; 0 where cut off."""
        n = len(self.name)
        c, t, lc, lt = [0 if o else x for x, o in zip(self.chars, off)], [0] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if off[i]:
                continue
            p = self.parent[i]
            if self.link[i] and not self.link[p]:
                lc[i], lt[i] = c[i], 1
            c[p] += c[i]
            t[p] += t[i] + 1
            lc[p] += lc[i]
            lt[p] += lt[i]
        share = lc[0] / max(c[0], 1)

        def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
            if not chars:
                return 0.0
            tags, lc_, lt_ = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
            over = math.log(max(1.0, chars * tags / (lc_ * lt_)))
            return chars / tags * over / math.log(math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e) + math.e - 1)

        dense = [density(c[i], t[i], lc[i], lt[i]) for i in range(n)]
        # a node's own text counts as a child without tags
        sums = [0.0 if off[i] else density(self.chars[i], 1, self.chars[i] if self.link[i] else 0, 0) for i in range(n)]
        for i in range(1, n):
            sums[self.parent[i]] += dense[i]
        self.counts = list(zip(c, lc, lt))
        return dense, sums, self.counts

    def chosen(self, dense: list[float], sums: list[float]) -> tuple[list[int], bool]:
        """(the subtrees that are main text, whether markup says so)."""
        n = len(self.name)
        core = max(range(n), key=lambda i: (sums[i], -i))
        path, at = [core], core
        while self.parent[at] > 0:
            at = self.parent[at]
            path.append(at)
        marked = next((i for i in path if self.main[i]), None)
        if marked is not None:
            return [marked], True
        top, most = core, dense[core]
        for above in path[1:]:
            if self.name[above] in ("body", "html") or dense[above] < HOLD * most:
                break
            top, most = above, max(most, dense[above])
        if self.name[self.parent[top]] != "body":
            return [top], False
        near = [i for i in range(1, n) if self.parent[i] == self.parent[top]]
        kinds = [(self.name[i], self.named[i].split()) for i in near if i > top]
        listed = lambda i: i > top and self.named[i].strip() and self.named[i] != self.named[top] and kinds.count((self.name[i], self.named[i].split())) >= REPEATED
        taken = {i for i in near if i == top or dense[i] >= HOLD * most and not listed(i)}
        # what stands before or between the chosen belongs to them, unless it is mostly links
        before = {i for i in near if i < max(taken) and 2 * self.counts[i][1] <= self.counts[i][0] and not listed(i)}
        return sorted(taken | before), False

    def main_text(self, by_name: bool = True) -> str:
        off = self.cut_off(by_name)
        dense, sums, counts = self.densities(off)
        if not counts[0][0]:
            return ""
        tops, marked = self.chosen(dense, sums)
        n = len(self.name)
        inside = [False] * n
        for i in tops:
            inside[i] = True
        for i in range(min(tops) + 1, n):
            chars, link_chars, links = counts[i]
            menu = not marked and self.name[i] in BLOCK and links >= 3 and link_chars == chars and i not in tops
            inside[i] = (inside[i] or inside[self.parent[i]]) and not off[i] and not menu
        # loose text of body before the end of what is chosen stands between it
        over = self.parent[tops[0]] if len({self.parent[i] for i in tops}) == 1 and self.name[self.parent[tops[0]]] == "body" else -1
        last = max((k for k, (node, text) in enumerate(self.flow) if text is not None and inside[node]), default=-1)
        blocks, run = [], []
        for k, (node, text) in enumerate(self.flow):
            if off[node]:
                continue
            if node == over and text is not None and k < last:
                run.append(text)
                continue
            if text is None:
                if run:
                    blocks.append(" ".join("".join(run).split()))
                    run = []
            elif inside[node]:
                run.append(text)
        blocks.append(" ".join("".join(run).split()))
        return "\n".join(b for b in blocks if b)


def main_text(source: str | None) -> str:
    """The main text of one page.  Where names of blocks leave no text, they are not believed."""
    if not source:
        return ""
    page = _Page(source)
    return page.main_text() or page.main_text(False)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages."""
    some = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = dict(some.dtypes)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) for x in texts_of(batch, "html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return arrow_map(some, over, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint", "html")
