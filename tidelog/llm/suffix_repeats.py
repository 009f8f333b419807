"""Suffix-array dedup of byte strings, by longest-previous-factor arrays.

A suffix order of a whole corpus is cut into parts that tasks can hold:

1. Every window of ``WIDTH`` bytes has an anchor, the K-byte run of the
   smallest hash in it (the last of equals).  Equal windows have equal anchors
   at equal inner places.  Anchors that stand once in the corpus end here.
2. Windows of one anchor place form a context.  Equal contexts are one run of
   equal suffixes and need no sorting.  Of anchors with several contexts, one
   place of each is written out: at most WIDTH - K + WIDTH bytes.
3. Tasks get the contexts by anchor and build the suffix array of their window
   starts (prefix doubling), the LCP array, and from the previous and next
   smaller positions in suffix order the longest previous factor of every
   start; with order reversed, the longest later factor.  A start is repeated
   if such a factor reaches WIDTH bytes.
4. An anchor of more than ``HOT`` contexts, as at the seams of a passage that
   very many texts share, would be too much for a task.  Its suffixes are cut
   to their first WIDTH bytes and grouped by those; in a group, suffix order is
   the order of positions, so the smallest position is the previous one.

``remove`` takes away later copies and keeps the first (longest previous
factor alone), or with ``keep_first=False`` all copies.  Windows are judged on
the input, and bytes covered by several go once.

Nulls: a null text is empty.  Copies of a row repeat each other.  Texts under
WIDTH bytes lose nothing.  What is left of a text can end inside a character;
``text`` then drops the torn bytes, ``kept_sha256`` does not.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import repeats
from tidelog.llm.bits import bit_set
from tidelog.llm.common import arrow_map, cut, mix64, pair64, texts_of
from tidelog.llm.fingerprints import window_min
from tidelog.llm.wordarrays import _BYTE, _tables

WIDTH, K = 200, 64
#: Contexts of one anchor that one task sorts.
HOT = 2000
#: Bytes that one suffix array is built over.
ARRAY = 1 << 20


class Bytes:
    """The bytes of some texts with prefix sums, so that any run's hash is two steps."""

    def __init__(self, texts: list[str]) -> None:
        parts = [t.encode() for t in texts]
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.ends = np.cumsum(np.array([len(p) for p in parts], np.int64))
        self.begins = self.ends - np.array([len(p) for p in parts], np.int64)
        n = len(self.data)
        up, self.back = _tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=self.sums[1:])

    def hash(self, at: np.ndarray, size) -> np.ndarray:
        return mix64((self.sums[at + size] - self.sums[at]) * self.back[at] + np.asarray(size).astype(np.uint64))


def anchors(b: Bytes, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, anchor place, first window, number of windows) of every anchor, in order of place."""
    n = len(b.data)
    none = (np.zeros(0, np.int64),) * 5
    if n < width:
        return none[0], np.zeros(0, np.uint64), *none[2:]
    at = np.arange(n - k + 1)
    h = b.hash(at, k)
    low = np.uint64((1 << max(20, (n + 1).bit_length())) - 1)
    # smallest hash first, of equal ones the last place
    best = window_min((h & ~low) | (low - at.astype(np.uint64)), width - k + 1)
    place = (low - (best & low)).astype(np.int64)
    start = np.arange(len(place))
    owner = np.searchsorted(b.ends, start, "right")
    ok = start + width <= b.ends[owner]
    start, owner, place = start[ok], owner[ok], place[ok]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    m = np.diff(np.append(first, len(start)))
    place = place[first]
    return owner[first], h[place], place, start[first], m


def _contexts(b: Bytes, found: tuple[np.ndarray, ...], width: int) -> np.ndarray:
    _, h, place, lo, m = found
    size = m + width - 1
    return pair64(b.hash(lo, size), mix64(((place - lo) << 20).astype(np.uint64) + m.astype(np.uint64)))


def _ranks(data: np.ndarray, width: int) -> dict[int, np.ndarray]:
    """By depth 8, 16, ... up to width: the rank of what stands at every place, to that depth."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | wide[i : i + n]
    out, depth = {}, 8
    while True:
        out[depth] = np.unique(key, return_inverse=True)[1].astype(np.int64)
        if depth * 2 > width:
            return out
        r = np.concatenate([out[depth], np.zeros(depth, np.int64)])
        key = (r[:n].astype(np.uint64) << np.uint64(32)) | r[depth : depth + n].astype(np.uint64)
        depth *= 2


def suffix_order(data: np.ndarray, starts: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of starts by their first ``width`` bytes and then by place, LCP with the one before, at most width)."""
    ranks = _ranks(data, width)
    top = max(ranks)
    order = np.lexsort((places, ranks[top][starts + width - top], ranks[top][starts]))
    s = starts[order]
    a, b = s[:-1], s[1:]
    lcp = np.zeros(len(a), np.int64)
    for depth in sorted(ranks, reverse=True):
        for _ in range(width // top if depth == top else 1):
            fits = lcp + depth <= width
            at = np.minimum(lcp, width - depth)
            lcp += depth * (fits & (ranks[depth][a + at] == ranks[depth][b + at]))
    for _ in range(7):
        at = np.minimum(lcp, width - 1)
        lcp += (lcp < width) & (data[a + at] == data[b + at])
    same = (ranks[top][a] == ranks[top][b]) & (ranks[top][a + width - top] == ranks[top][b + width - top])
    return order, np.concatenate([[0], np.where(same, width, np.minimum(lcp, width - 1))]).astype(np.int64)


def previous_factor(position: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factor by suffix rank, from the previous and the next smaller position.

    position and lcp are in suffix order.  A pointer starts at the neighbour
    and follows that one's own pointer while it stands at a larger position;
    the LCP on the way is the smallest passed.  Where it falls below ``least``
    the search ends: such factors are not asked for and given as passed.
    """

    def side(p: np.ndarray, near: np.ndarray) -> np.ndarray:
        n = len(p)
        to, common = np.arange(n) - 1, near.copy()
        active = np.flatnonzero((to >= 0) & (common >= least))
        while True:
            active = active[p[to[active]] > p[active]]
            if not len(active):
                break
            via = to[active]
            hop, reach = to[via], np.minimum(common[active], common[via])
            to[active], common[active] = hop, reach
            active = active[(hop >= 0) & (reach >= least)]
        smaller = (to >= 0) & (p[np.maximum(to, 0)] < p)
        return np.where(smaller, common, 0)

    before = side(position, lcp)
    after = side(position[::-1], np.append(lcp[1:], 0)[::-1])[::-1]
    return np.maximum(before, after)


def _sorted_parts(pieces: DataFrame, width: int, keep_first: bool) -> DataFrame:
    """(tk, lo, m): runs of repeated windows of pieces (h, ord, tk, lo, m, piece), decided anchor by anchor."""
    dealt = pieces.repartition("h").sortWithinPartitions("h")

    def decide(t: pa.Table) -> pa.RecordBatch:
        parts = t.column("piece").to_pylist()
        m, lo = t.column("m").to_numpy(), t.column("lo").to_numpy()
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) for p in parts], np.int64)
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(parts)), m)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(m) - m, m)
        order_of = list(zip(t.column("ord").to_pylist(), t.column("tk").to_pylist()))
        rank = {x: i for i, x in enumerate(sorted(set(order_of)))}
        text = np.array([rank[x] for x in order_of], np.int64)
        places = np.lexsort((lo[owner] + inner, text[owner]))
        position = np.empty(len(places), np.int64)
        position[places] = np.arange(len(places))
        order, lcp = suffix_order(data, base[owner] + inner, position, width)
        p = position[order]
        again = previous_factor(p, lcp, width) >= width
        if not keep_first:
            again |= previous_factor(-p, lcp, width) >= width
        flag = np.zeros(len(owner), bool)
        flag[order] = again
        edge = np.ones(len(owner), bool)
        edge[1:] = (owner[1:] != owner[:-1]) | (flag[1:] != flag[:-1])
        first = np.flatnonzero(edge)
        count = np.diff(np.append(first, len(owner)))
        on = flag[first]
        first, count = first[on], count[on]
        return pa.RecordBatch.from_arrays([t.column("tk").combine_chunks().take(pa.array(owner[first])), pa.array((lo[owner[first]] + inner[first]).astype(np.int32)), pa.array(count.astype(np.int32))], names=["tk", "lo", "m"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            t = pa.Table.from_batches(held).combine_chunks()
            h = t.column("h").to_numpy()
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            stop = len(t) if last else int(starts[-1])  # the last anchor may go on
            bytes_ = np.array([len(x) for x in t.column("piece").to_pylist()], np.int64)
            ends = np.append(starts[1:], len(t))
            total, at = np.cumsum(bytes_), 0
            groups = [(int(a), int(b)) for a, b in zip(starts, ends) if b <= stop]
            while at < len(groups):
                a = groups[at][0]
                before = total[a - 1] if a else 0
                upto = at + 1
                while upto < len(groups) and total[groups[upto][1] - 1] - before <= ARRAY:
                    upto += 1
                yield decide(t.slice(a, groups[upto - 1][1] - a))
                at = upto
            rest = t.slice(stop)
            held, size = rest.to_batches(), int(bytes_[stop:].sum())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
                if size > 4 * ARRAY:
                    yield from ready(False)
        if held and sum(b.num_rows for b in held):
            yield from ready(True)

    return dealt.mapInArrow(over, "tk binary, lo int, m int")


def _runs(docs: DataFrame, width: int, k: int, keep_first: bool, hot: int) -> list[DataFrame]:
    def hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        h = anchors(Bytes(texts), width, k)[1]
        return h, np.ones(len(h), bool)

    twice = repeats.repeated(docs, hashes)

    def some(texts: list[str]) -> tuple:
        b = Bytes(texts)
        found = anchors(b, width, k)
        found = tuple(x[twice.maybe(found[1])] for x in found)
        c = _contexts(b, found, width)
        return b, found, c

    def scan(texts: list[str]) -> tuple[np.ndarray, ...]:
        b, (owner, h, _, lo, m), c = some(texts)
        return owner, h, c, lo - b.begins[owner], m

    whole, part = repeats.split(cut(repeats.contexts(docs, scan)), keep_first)
    few, many = part.filter(F.col("kinds") <= hot), part.filter(F.col("kinds") > hot)
    key = repeats.context_key().alias("k")
    out = [whole]
    n_few, n_many = few.count(), many.count()
    if n_few:
        open_ = bit_set(few.select(key), "k", n_few)

        def write(batch: pa.RecordBatch) -> pa.RecordBatch:
            b, (owner, h, _, lo, m), c = some(texts_of(batch, "text"))
            ok = open_.maybe(repeats.context_key_of(h, c, repeats.places(batch.column("tk"), owner, lo - b.begins[owner])))
            owner, h, c, lo, m = owner[ok], h[ok], c[ok], lo[ok], m[ok]
            raw = b.data.tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), batch.column("ord").take(pa.array(owner)), batch.column("tk").take(pa.array(owner)),
                    pa.array((lo - b.begins[owner]).astype(np.int32)), pa.array(m.astype(np.int32)), pa.array([raw[x:y] for x, y in zip(lo.tolist(), (lo + m + width - 1).tolist())], pa.binary()),
                ],
                names=["h", "c", "ord", "tk", "lo", "m", "piece"],
            )

        pieces = arrow_map(repeats.keyed(docs), write, "h bigint, c bigint, ord bigint, tk binary, lo int, m int, piece binary", "text", 1 << 19)
        # of equal contexts the first place stands for all; copies of a text are equal contexts
        pieces = pieces.groupBy("h", "c").agg(F.min(F.struct("ord", "tk", "lo", "m", "piece")).alias("p")).select("h", "p.*")
        out.append(cut(_sorted_parts(pieces, width, keep_first)))
        open_.free()
    if n_many:
        crowd = bit_set(many.select(key), "k", n_many)

        def each(texts: list[str], tk: pa.Array) -> tuple[np.ndarray, ...]:
            b, (owner, h, _, lo, m), c = some(texts)
            ok = crowd.maybe(repeats.context_key_of(h, c, repeats.places(tk, owner, lo - b.begins[owner])))
            owner, lo, m = owner[ok], lo[ok], m[ok]
            at = np.repeat(lo, m) + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            owner = np.repeat(owner, m)
            half = width // 2
            return owner, at - b.begins[owner], b.hash(at, width), pair64(b.hash(at, half), b.hash(at + half, width - half))

        out.append(repeats.equal_windows(cut(repeats.window_rows(docs, each)), keep_first))
        crowd.free()
    twice.free()
    repeats.discard(part)
    return out


def remove(docs: DataFrame, *keep: str, width: int = WIDTH, k: int = K, keep_first: bool = True, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Per row: keep..., n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and the kept text if asked for."""
    if k > width or width < 8:
        raise ValueError("an anchor must fit into a window of 8 bytes or more")
    keep = keep or ("doc_id",)

    def finish(text: str, lows: np.ndarray, counts: np.ndarray) -> tuple:
        raw = text.encode()
        left, spans = raw, 0
        if len(lows):
            gone = repeats.covered(len(raw), width, lows, counts)
            spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
            left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out = len(raw), len(raw) - len(left), spans, repeats.sha256(left)
        return (*out, left.decode("utf-8", "ignore")) if with_text else out

    schema = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * with_text
    runs = _runs(docs, width, k, keep_first, hot)
    marks = cut(repeats.marked(docs, *runs))
    repeats.discard(*runs)
    return repeats.applied(docs, marks, finish, schema, keep, keep_first)


def keep_first(docs: DataFrame) -> DataFrame:
    """Rows of docs, all their columns, with later copies cut out of text (and n_chars set anew, if there is one).

    A text of which nothing is left goes; an input text that is null or empty stays as it is.
    """
    columns = docs.columns
    held = docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)], "doc_id", "text")
    left = remove(held, *[f"__c{i}" for i in range(len(columns))], with_text=True)
    left = left.filter("n_bytes = 0 or kept_text <> ''")
    out = []
    for i, c in enumerate(columns):
        kept = F.when(F.col("n_removed") == 0, F.col(f"__c{i}"))
        if c == "text":
            out.append(kept.otherwise(F.col("kept_text")).alias(c))
        elif c == "n_chars":
            out.append(kept.otherwise(F.length("kept_text").cast(docs.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(f"__c{i}").alias(c))
    return left.select(*out)
