"""Document fingerprints from closed syncmers.

A k-mer of the text's UTF-8 bytes is an anchor if its smallest inner s-mer
stands at its first or last place.  That depends on the k-mer alone, so an
anchor survives any edit outside itself, wherever it moves to.  A fingerprint
keeps the ``SIZE`` anchors of the smallest hashes, each with its (first) place:
"hash place hash place ...", in hexadecimal, in order of place.  A text without
an anchor, or shorter than k, has one anchor for the whole of it; an empty text
has the empty fingerprint.

Likeness: of the anchors of both together, those in both and in the same order
in both (the longest increasing run of places) are common; with J their share,
likeness is 2J / (1 + J), which is near the share of text in common.  Of two
fingerprints it sees the SIZE smallest of both; ``with_edits`` has the texts at
hand and takes all their anchors.  Two empty fingerprints are alike (1), an empty and another are not (0).

``fingerprint`` works row by row.  ``with_edits`` also looks at the next
document in descending doc_id (of any type that has an order; null last, ties by
the text's digest; after the last comes the first).  Documents are dealt into
ranges of (doc_id, digest) whose bounds come from a sample of those alone and
only balance the work; the head of each range is sent to the range before it
too, so one shuffle of the texts is all.

Nulls: a null text is empty; null doc_ids come last and are dealt by digest.
Repeated rows are neighbours, in one range, and give equal results up to the
last of them.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_map, in_slices, mix64, pair64, texts_of

K, S, SIZE = 32, 16, 64
Sketch = tuple[np.ndarray, np.ndarray]  # hashes ascending, places


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def byte_hashes(data: np.ndarray, *widths: int) -> list[np.ndarray]:
    """Hashes of every run of each width (powers of two, ascending) of the bytes."""
    h, have, out = mix64(data.astype(np.uint64) + np.uint64(1)), 1, []
    for width in widths:
        while have < width:
            h = pair64(h[: len(h) - have], h[have:]) if len(h) > have else h[:0]
            have *= 2
        out.append(h)
    return out


def sketches(texts: list[str], k: int = K, s: int = S, size: int | None = SIZE) -> list[Sketch]:
    """The ``size`` smallest anchors of each text; all without a size."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(lengths)
    none = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    found: list[Sketch] = [none] * len(parts)
    if len(data) >= k:
        small, large = byte_hashes(data, s, k)
        low = window_min(small, k - s + 1)
        n = len(large)
        anchor = (small[:n] == low[:n]) | (small[k - s : k - s + n] == low[:n])
        at = np.nonzero(anchor)[0]
        owner = np.searchsorted(ends, at, "right")
        inside = at + k <= ends[owner]
        at, owner = at[inside], owner[inside]
        value = (large[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((at, value, owner))
        at, owner, value = at[order], owner[order], value[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        at, owner, value = at[fresh], owner[fresh], value[fresh]
        bounds = np.searchsorted(owner, np.arange(len(parts) + 1))
        for i in np.nonzero(np.diff(bounds))[0].tolist():
            a, b = bounds[i], bounds[i + 1] if size is None else min(bounds[i + 1], bounds[i] + size)
            found[i] = value[a:b], at[a:b] - (ends[i] - lengths[i])
    for i, p in enumerate(parts):
        if p and not len(found[i][0]):
            found[i] = np.array([int.from_bytes(hashlib.sha256(p).digest()[:4], "big")], np.uint32), np.zeros(1, np.int64)
    return found


def to_text(sketch: Sketch) -> str:
    sketch = sketch[0][:SIZE], sketch[1][:SIZE]
    order = np.argsort(sketch[1], kind="stable")
    return " ".join([f"{h:08x} {p:x}" for h, p in zip(sketch[0][order].tolist(), sketch[1][order].tolist())])


def from_text(fingerprint: str) -> Sketch:
    parts = [int(x, 16) for x in fingerprint.split()]
    h, p = np.array(parts[::2], np.uint32), np.array(parts[1::2], np.int64)
    order = np.argsort(h)
    return h[order], p[order]


def likeness(a: Sketch, b: Sketch, size: int | None = SIZE) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    total = len(a[0]) + len(b[0]) - len(common)
    if size is not None and total > size:
        n = np.searchsorted(common, np.union1d(a[0], b[0])[size - 1], "right")
        i, j, total = i[:n], j[:n], size
    tails: list[int] = []
    for p in b[1][j][np.argsort(a[1][i])].tolist():
        at = bisect_left(tails, p)
        tails[at : at + 1] = [p]
    share = len(tails) / total
    return 2 * share / (1 + share)


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    some = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([to_text(x) for x in sketches(texts_of(batch, "text"))], pa.string())], names=["doc_id", "fingerprint"])

    return arrow_map(some, over, f"doc_id {dict(some.dtypes)['doc_id']}, fingerprint string", "text")


#: Ranges for each shuffle partition of the session, and sampled keys for each range; no more ranges than MOST_RANGES.
RANGES, SAMPLED, MOST_RANGES = 4, 8, 20_000


def _turned(text) -> Column:
    """The text's digest with its digits turned round, so that largest first is the digest's own order."""
    return F.translate(F.md5(F.coalesce(text, F.lit(""))), "0123456789abcdef", "fedcba9876543210")


def _place(doc_id, turned: str) -> tuple:
    """Sorts as (doc_id, turned) does in Spark, null first; documents follow each other from the largest down."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, turned)


def _bounds(keys: DataFrame) -> list[tuple]:
    """Ascending bounds of ranges of (doc_id, turned).

    They come from a sample of fixed size, the keys of the smallest hashes, so
    that reruns agree.  Where they fall decides how evenly work is dealt, not
    the result.
    """
    wanted = min(MOST_RANGES, RANGES * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = keys.orderBy(F.xxhash64("turned", F.col("doc_id").cast("string"))).limit(SAMPLED * wanted).collect()
    places = sorted(_place(r["doc_id"], r["turned"]) for r in some)
    cuts = [places[len(places) * i // wanted] for i in range(1, wanted)] if places else []
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def with_edits(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    some = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("turned", _turned(F.col("text")))
    kind = dict(some.dtypes)["doc_id"]
    bounds = _bounds(some.select("doc_id", "turned"))

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, turned: pa.Array) -> pa.Array:
        return pa.array([len(bounds) - bisect_left(bounds, _place(i, d)) for i, d in zip(ids.to_pylist(), turned.to_pylist())], pa.int32())

    ranged = some.withColumn("range", range_of("doc_id", "turned"))
    heads = sorted((r["range"], r["head"]["doc_id"], r["head"]["turned"]) for r in ranged.groupBy("range").agg(F.max(F.struct("doc_id", "turned")).alias("head")).collect())
    own = F.struct("range", F.lit(0).alias("extra"))
    places = F.array(own)
    if heads:
        # as many rows as there are ranges, MOST_RANGES at most
        rows = [(doc_id, turned, heads[i - 1][0]) for i, (_, doc_id, turned) in enumerate(heads)]
        ahead = docs.sparkSession.createDataFrame(rows, f"head {kind}, head_turned string, ahead int")
        ranged = ranged.join(F.broadcast(ahead), F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("turned") == F.col("head_turned")), "left")
        places = F.when(F.col("ahead").isNull(), places).otherwise(F.array(own, F.struct(F.col("ahead").alias("range"), F.lit(1).alias("extra"))))
    dealt = ranged.select("doc_id", "text", "turned", F.explode(places).alias("p")).select("doc_id", "text", "turned", F.col("p.range").alias("range"), F.col("p.extra").alias("extra"))
    dealt = dealt.repartition("range").sortWithinPartitions("range", "extra", F.col("doc_id").desc_nulls_last(), F.col("turned").desc()).drop("turned")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (doc_id, text, range, extra, sketch) of the row before
        for batch in in_slices(batches, "text"):
            texts = texts_of(batch, "text")
            rows = list(zip(batch.column("doc_id").to_pylist(), texts, batch.column("range").to_pylist(), batch.column("extra").to_pylist(), sketches(texts, size=None)))
            pairs = [(a, b) for a, b in zip(([last] if last else []) + rows, rows if last else rows[1:]) if a[2] == b[2] and not a[3]]
            last = rows[-1]
            if not pairs:
                continue
            edited = [a[1][: len(a[1]) - len(a[1]) // 3] + b[1][: len(a[1]) // 3] for a, b in pairs]
            after = sketches(edited, size=None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[0] for a, _ in pairs], batch.schema.field("doc_id").type),
                    pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                    pa.array([to_text(a[4]) for a, _ in pairs], pa.string()),
                    pa.array([to_text(e) for e in after], pa.string()),
                    pa.array([likeness(a[4], e, None) for (a, _), e in zip(pairs, after)], pa.float64()),
                    pa.array([likeness(a[4], b[4], None) for a, b in pairs], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.mapInArrow(over, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
