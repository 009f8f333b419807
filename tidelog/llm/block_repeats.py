"""Substring dedup on words, by fixed-block anchors.

Index: the non-overlapping blocks of ``BLOCK`` words of every text (words 0-17,
18-35, ...), as a bit set, and then exactly: only a hash with an indexed place
counts as an anchor.  Any window of ``WIDTH`` = 2 * BLOCK - 1 words or
more holds a whole block, so if it also starts elsewhere, the other place has
that block at the same inner place.  Every rolling block-long window of every
text probes the index; those that hit are anchors.  Around an anchor that
stands twice or more, the hit is extended: all windows that hold the block are
compared with those of the other places, whole contexts first and the
differing ones window by window, and neighbouring repeated windows run
together into maximal exact repeats.

The result removes all places of a repeat, the first included.

Nulls: a null text has no words.  Copies of a row repeat each other.  Texts
under WIDTH words lose nothing.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import repeats
from tidelog.llm.bits import MOST, BitSet, bit_set
from tidelog.llm.common import WORD, arrow_map, mix64, pair64, texts_of
from tidelog.llm.wordarrays import Words, windows, words

WIDTH, BLOCK = 35, 18


def _blocks(texts: list[str], block: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, hash of each rolling block, its start as a word number), blocks inside one text only."""
    w = words(texts, fold=False)
    runs = windows(w.hash, block)
    at = np.flatnonzero(w.owner[: len(runs)] == w.owner[block - 1 : block - 1 + len(runs)])
    return w, runs[at], at


def _index(docs: DataFrame, block: int) -> BitSet:
    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, h, at = _blocks(texts_of(batch, "text"), block)
        aligned = (at - w.first[w.owner[at]]) % block == 0
        return pa.RecordBatch.from_arrays([pa.array(h[aligned].view(np.int64))], names=["h"])

    found = arrow_map(docs.select(F.col("text").cast("string").alias("text")), over, "h bigint", "text", 1 << 19)
    return bit_set(found, "h", 1 << MOST, probes=1)


def _contexts(w: Words, at: np.ndarray, h: np.ndarray, width: int, block: int) -> tuple[np.ndarray, ...]:
    """(text, h, c, lo, m) around blocks that start at word ``at``."""
    owner = w.owner[at]
    begin, end = w.first[owner], w.first[owner + 1]
    lo = np.maximum(begin, at - (width - block))
    m = np.minimum(at, end - width) - lo + 1
    ok = m > 0
    at, owner, begin, lo, m, h = (x[ok] for x in (at, owner, begin, lo, m, h))
    size = m + width - 1
    c = np.zeros(len(at), np.uint64)
    if len(at):
        # a context is width..2*width-block words long: two overlapping windows of the width cover it
        run = windows(w.hash, width)
        c = mix64(pair64(run[lo], run[lo + size - width]) ^ (((at - lo) << 16) + m).astype(np.uint64))
    return owner, h, c, lo - begin, m


def remove(docs: DataFrame, *keep: str, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Per row: keep..., n_words, n_removed, kept_sha256 (of the kept words joined by one blank)."""
    if width < 2 * block - 1:
        raise ValueError("a window must hold a whole block: width >= 2 * block - 1")
    keep = keep or ("doc_id",)
    index = _index(docs, block)

    def hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        w, h, at = _blocks(texts, block)
        ok = index.maybe(h)
        return h[ok], ((at - w.first[w.owner[at]]) % block == 0)[ok]

    twice = repeats.repeated(docs, hashes)  # exact: a hash with a place that is a block of the index
    index.free()

    def scan(texts: list[str]) -> tuple[np.ndarray, ...]:
        w, h, at = _blocks(texts, block)
        ok = twice.maybe(h)
        return _contexts(w, at[ok], h[ok], width, block)

    found = repeats.cut(repeats.contexts(docs, scan))
    whole, part = repeats.split(found)
    open_ = bit_set(part.select(repeats.context_key().alias("k")), "k", part.count())
    repeats.discard(part)

    def each(texts: list[str], tk: pa.Array) -> tuple[np.ndarray, ...]:
        w, h, at = _blocks(texts, block)
        ok = twice.maybe(h)
        owner, h, c, lo, m = _contexts(w, at[ok], h[ok], width, block)
        some = open_.maybe(repeats.context_key_of(h, c, repeats.places(tk, owner, lo)))
        run = windows(w.hash, width)
        flag = np.zeros(len(run) + 1, np.int64)
        start = lo[some] + w.first[owner[some]]
        np.add.at(flag, start, 1)
        np.add.at(flag, start + m[some], -1)
        s = np.flatnonzero(np.cumsum(flag) > 0)
        return w.owner[s], s - w.first[w.owner[s]], run[s], mix64(w.hash[s] ^ (w.hash[s + width - 1] << np.uint64(1)))

    single = repeats.equal_windows(repeats.cut(repeats.window_rows(docs, each)))
    twice.free(), open_.free()

    def finish(text: str, lows: np.ndarray, counts: np.ndarray) -> tuple[int, int, str]:
        ws = WORD.findall(text)
        if len(lows) and ws:
            gone = repeats.covered(len(ws), width, lows, counts)
            left = [x for x, g in zip(ws, gone.tolist()) if not g]
        else:
            left = ws
        return len(ws), len(ws) - len(left), repeats.sha256(" ".join(left).encode())

    marks = repeats.cut(repeats.marked(docs, whole, single))
    repeats.discard(whole, single)
    return repeats.applied(docs, marks, finish, "n_words bigint, n_removed bigint, kept_sha256 string", keep)
