"""What the two repeat removers share.

A *context* is a run of m windows (of a fixed width) that hold one anchor; it
starts at window ``lo`` of a text and has the anchor's hash h and a hash c of
all that its windows cover.  Windows that are equal hold equal anchors at
equal places, so a repeated window shows as

* two places of one (h, c): the whole contexts are equal, all their windows
  repeat ("whole"), or
* several c under one h: the contexts differ somewhere; one place of each, its
  representative, is looked at window by window ("part").

Anchors seen once are nearly all of them.  Their contexts are not shuffled: a
first pass counts anchor hashes, a bit set of the repeated ones goes to the
tasks (bounded, see bits.py), and a second pass gives only contexts of those.

Texts are known by a 128-bit digest, so copies of a text are one place; that a
text has copies is counted apart and marks all of its windows.

Places are in order of (doc_id, digest, start), doc_ids that are null or no
integers last; of copies the smallest doc_id counts.  With ``keep_first`` a place is marked only if an
equal window stands at an earlier one, and a copy only if it is not the first.
Rows alike in doc_id and text are one place for ``keep_first``, and copies of
each other otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bits import BitSet, bit_set
from tidelog.llm.common import arrow_map, cut, discard, join_counted, mix64, text_key, texts_of

#: Given texts: arrays (text number, anchor hash, context hash, lo, m) of all anchors.
Scan = Callable[[list[str]], tuple[np.ndarray, ...]]

CONTEXT = "tk binary, ord bigint, h bigint, c bigint, lo int, m int, p bigint"
LAST = (1 << 63) - 1


def places(tk: pa.Array, owner: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A 64-bit hash of (text, start)."""
    head = np.frombuffer(b"".join(tk.to_pylist()), np.uint64)[::2] if len(tk) else np.zeros(0, np.uint64)
    return mix64(head[owner] + mix64(lo.astype(np.uint64) + np.uint64(1)))


def keyed(docs: DataFrame, *keep: str) -> DataFrame:
    order = F.coalesce(F.col("doc_id").try_cast("bigint"), F.lit(LAST)).alias("ord")
    return docs.select(*keep, text_key(F.col("text")).alias("tk"), order, F.col("text").cast("string").alias("text"))


def repeated(docs: DataFrame, hashes: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> BitSet:
    """Bit set of the anchor hashes that stand at two places or more (copies of a text count), one of them marked.

    hashes gives the hashes and marks of some texts; a hash and a mark are all that is shuffled of a place.
    """

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, mark = hashes(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(mark)], names=["h", "mark"])

    light = arrow_map(docs.select(F.col("text").cast("string").alias("text")), over, "h bigint, mark boolean", "text", 1 << 19)
    twice = cut(light.groupBy("h").agg(F.count("*").alias("n"), F.bool_or("mark").alias("mark")).filter("n > 1 and mark").select("h"))
    found = bit_set(twice, "h", twice.count())
    discard(twice)
    return found


def contexts(docs: DataFrame, scan: Scan) -> DataFrame:
    """Contexts that scan gives, of all rows."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, h, c, lo, m = scan(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("tk").take(pa.array(owner)), batch.column("ord").take(pa.array(owner)), pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array(m.astype(np.int32)), pa.array(places(batch.column("tk"), owner, lo).view(np.int64))],
            names=["tk", "ord", "h", "c", "lo", "m", "p"],
        )

    return arrow_map(keyed(docs), over, CONTEXT, "text", 1 << 19)


def split(found: DataFrame, keep_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(whole, part) of contexts found (a table of ``cut``, used up): (tk, lo, m) whose windows all repeat; (h, c, rep, kinds) still to be looked at.

    rep is the place hash of the representative (the first place, if asked
    for), kinds the number of distinct contexts of h.  Both come from one grouping by (h, c), combined map-side.
    """
    first = F.struct("ord", "tk", "lo")
    rep = [F.min_by("p", first).alias("rep"), F.min(first).alias("f")] if keep_first else [F.min("p").alias("rep")]
    more = [F.col("f.tk").alias("ftk"), F.col("f.lo").alias("flo")] if keep_first else []
    by_context = cut(found.groupBy("h", "c").agg(F.min("p").alias("p0"), F.max("p").alias("p1"), F.count("*").alias("n"), *rep).select("h", "c", "rep", "n", (F.col("p0") != F.col("p1")).alias("twice"), *more))
    kinds = cut(by_context.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1").withColumn("n", F.col("kinds")))
    whole = join_counted(found, by_context.filter("twice").drop("twice", "rep"), ["h", "c"])
    if keep_first:
        whole = whole.filter("tk <> ftk or lo <> flo")
    whole = cut(whole.select("tk", "lo", "m"))
    part = cut(join_counted(by_context.drop("n"), kinds, ["h"]).select("h", "c", "rep", "kinds"))
    discard(found, by_context, kinds)
    return whole, part


def context_key():
    """One 64-bit hash of (h, c, rep), the same in Spark and in numpy."""
    c = F.col("c")
    return F.col("h").bitwiseXOR(F.call_function("shiftleft", c, F.lit(1))).bitwiseXOR(F.call_function("shiftrightunsigned", c, F.lit(17))).bitwiseXOR(F.col("rep"))


def context_key_of(h: np.ndarray, c: np.ndarray, p: np.ndarray) -> np.ndarray:
    return h ^ (c << np.uint64(1)) ^ (c >> np.uint64(17)) ^ p


def equal_windows(windows: DataFrame, keep_first: bool = False) -> DataFrame:
    """(tk, lo, m=1) of windows (tk, ord, lo, w, v; a table of ``cut``, used up) whose hashes (w, v) stand at another (an earlier) place too."""
    place = F.xxhash64("tk", "lo")
    first = [F.min(F.struct("ord", "tk", "lo")).alias("f")] if keep_first else []
    more = [F.col("f.tk").alias("ftk"), F.col("f.lo").alias("flo")] if keep_first else []
    same = windows.groupBy("w", "v").agg(F.min(place).alias("p0"), F.max(place).alias("p1"), F.count("*").alias("n"), *first).filter("p0 <> p1")
    same = cut(same.select("w", "v", "n", *more))
    found = join_counted(windows.select("tk", "lo", "w", "v"), same, ["w", "v"])
    if keep_first:
        found = found.filter("tk <> ftk or lo <> flo")
    found = cut(found.select("tk", "lo", F.lit(1).alias("m")))
    discard(windows, same)
    return found


def window_rows(docs: DataFrame, scan: Callable[[list[str], pa.Array], tuple[np.ndarray, ...]]) -> DataFrame:
    """(tk, ord, lo, w, v) from scan's (text number, lo, w, v); scan gets texts and digests."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, lo, w, v = scan(texts_of(batch, "text"), batch.column("tk"))
        return pa.RecordBatch.from_arrays(
            [batch.column("tk").take(pa.array(owner)), batch.column("ord").take(pa.array(owner)), pa.array(lo.astype(np.int32)), pa.array(w.view(np.int64)), pa.array(v.view(np.int64))],
            names=["tk", "ord", "lo", "w", "v"],
        )

    return arrow_map(keyed(docs), over, "tk binary, ord bigint, lo int, w bigint, v bigint", "text", 1 << 19)


def marked(docs: DataFrame, *found: DataFrame) -> DataFrame:
    """(tk, lows, counts, first): per text the repeated windows as runs; if it has copies, the first one's place in order."""
    copies = keyed(docs).select("tk", "ord").groupBy("tk").agg(F.count("*").alias("n"), F.min("ord").alias("first")).filter("n > 1")
    runs = copies.select("tk", F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("m"), "first")
    for f in found:
        runs = runs.unionByName(f.select("tk", "lo", "m", F.lit(None).cast("bigint").alias("first")))
    run = F.when(F.col("lo").isNotNull(), F.struct("lo", "m"))
    runs = runs.groupBy("tk").agg(F.collect_set(run).alias("runs"), F.max("first").alias("first"))
    return runs.select("tk", F.transform("runs", lambda r: r["lo"]).alias("lows"), F.transform("runs", lambda r: r["m"]).alias("counts"), "first")


def covered(n: int, width: int, lows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which of n units repeated windows cover; a run at -1 stands for all windows."""
    delta = np.zeros(n + 1, np.int64)
    if n >= width and (lows < 0).any():
        delta[0] += 1
        delta[n] -= 1
    ok = lows >= 0
    np.add.at(delta, lows[ok], 1)
    np.add.at(delta, lows[ok] + counts[ok] + width - 1, -1)
    return np.cumsum(delta[:-1]) > 0


def applied(docs: DataFrame, marks: DataFrame, finish: Callable[[str, np.ndarray, np.ndarray], tuple], schema: str, keep: tuple[str, ...], keep_first: bool = False) -> DataFrame:
    """keep... and what ``finish(text, lows, counts)`` gives, for every row of docs; marks is a table of ``cut``.

    Only rows whose text can have marks (by a bit set of digests) carry their
    text to the join; the others are finished where they are read.
    """
    low64 = F.xxhash64("tk")
    member = bit_set(marks.select(low64.alias("h")), "h", marks.count())
    none = np.zeros(0, np.int64)
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = dict(docs.select(*keep).dtypes)
    kept = ", ".join(f"{k} {kinds[k]}" for k in keep)

    def arrays(rows: list[tuple]) -> list[pa.Array]:
        fields = pa_types(schema)
        return [pa.array([None if r is None else r[i] for r in rows], t) for i, t in enumerate(fields)]

    def first(batch: pa.RecordBatch) -> pa.RecordBatch:
        open_ = member.maybe(batch.column("th").to_numpy().view(np.uint64))
        texts = texts_of(batch, "text")
        rows = [None if o else finish(t, none, none) for t, o in zip(texts, open_.tolist())]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in keep], batch.column("tk"), batch.column("ord"), pa.array([t if o else None for t, o in zip(texts, open_.tolist())], pa.string()), *arrays(rows)],
            names=[*keep, "tk", "__ord", "__text", *names],
        )

    def last(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        before = list(zip(*[batch.column(n).to_pylist() for n in names]))
        texts, order, firsts = (batch.column(c).to_pylist() for c in ("__text", "__ord", "first"))
        lows, counts = batch.column("lows"), batch.column("counts")
        for i, text in enumerate(texts):
            if text is None:
                rows.append(before[i])
            elif lows[i].as_py() is None:
                rows.append(finish(text, none, none))
            else:
                low, count = (x[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lows, counts))
                if firsts[i] is not None and not (keep_first and order[i] == firsts[i]):
                    low, count = np.append(low, -1), np.append(count, 0)
                rows.append(finish(text, low, count))
        return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *arrays(rows)], names=[*keep, *names])

    dealt = arrow_map(keyed(docs, *keep).withColumn("th", low64), first, f"{kept}, tk binary, __ord bigint, __text string, {schema}", "text")
    joined = dealt.join(marks, "tk", "left").select(*keep, "__text", "__ord", *names, "lows", "counts", "first")
    return arrow_map(joined, last, f"{kept}, {schema}", "__text")


def pa_types(schema: str) -> list[pa.DataType]:
    known = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return [known[x.split()[1]] for x in schema.split(", ")]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
