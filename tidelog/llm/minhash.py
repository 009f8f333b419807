"""Near duplicates by min-max hashing.

Sets: distinct 5-word shingles (A-Z lower-cased) of whole texts; fewer words
make one shingle of all; no words, no set.  Each of ``PERMUTATIONS`` hash
functions is evaluated once per shingle and gives two values of the signature,
the smallest and the largest, so 128 evaluations make 256 values.

1. Texts of equal sets are one node (a 128-bit digest of the set).
2. ``BANDS`` bands of ``ROWS`` values each: nodes that share a band are in a
   bucket.  At a similarity of 0.85 a pair misses all buckets with probability
   (1 - 0.85^4)^16, under 10^-5.  A lower threshold takes as many bands as keep
   its pairs under that too (22 at 0.80), from the same signature.
3. Every bucket's hub is its member with the most company over all bands, as
   an original is among its copies.  Members are linked to their hub where the
   exact check on full sets says so, and linked nodes form components.
4. What is left are pairs inside a bucket but in different components.  Those
   are not written out: blocks of a bucket meet in tasks, save two blocks of
   one component, and drop pairs which cannot be linked, by size, by the triangle inequality of the Jaccard
   distance over the hub (exact distances), by having met in an earlier band, by the shingles that a set shares
   with any other set at hand (no pair has more in common than the poorer of
   the two shares at all), and by a signature estimate (unbiased: what short
   values share by chance is taken off) more than five standard errors below the
   threshold.  Of what is left, the ``TRIALS`` most promising
   pairs of two components in a task are checked on full sets first and
   components formed again, for one link of two large components saves all
   their other pairs; then all remaining pairs are checked.

No bucket is capped: a large one meets itself block by block in many tasks.

Nulls: a null text is empty and linked with nothing; its component is itself.
Null doc_ids take part in links but never name a component (null if a
component has no other).  Rows of equal doc_id and text are alike in the
result.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.bits import bit_set
from tidelog.llm.common import arrow_map, cut, discard, mix64, pair64, row_key, text_key, texts_of
from tidelog.llm.components import components
from tidelog.llm.wordarrays import windows, words

SHINGLE = 5
PERMUTATIONS, BANDS, ROWS = 128, 16, 4
PERCENT = 85
#: Probability at most that a pair at the threshold shares no bucket.
MISS = 1e-5
#: Standard errors between the threshold and an estimate that rules a pair out.
ERRORS = 5.0
BLOCK = 1024
TRIALS = 3
#: Pairs of one node that meet its set in one task.
MEET = 1024

_A = mix64(np.arange(PERMUTATIONS, dtype=np.uint64) + np.uint64(11)) | np.uint64(1)
_B = mix64(np.arange(PERMUTATIONS, dtype=np.uint64) + np.uint64(1011))


def shingle_sets(texts: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of distinct shingles, ascending within each text; first index of each text and one more)."""
    w = words(texts, fold=True)
    runs = windows(w.hash, width)
    at = np.arange(len(runs))
    inside = w.owner[at] == w.owner[at + width - 1] if len(runs) else np.zeros(0, bool)
    owner, value = w.owner[at[inside]], runs[inside]
    counts = np.diff(w.first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = []
        for i in short.tolist():
            h = np.array([counts[i]], np.uint64)
            for x in range(w.first[i], w.first[i + 1]):
                h = pair64(h, w.hash[x : x + 1])
            whole.append(h[0])
        owner, value = np.concatenate([owner, short]), np.concatenate([value, np.array(whole, np.uint64)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The 2 * PERMUTATIONS min-max values of every non-empty set, uint64."""
    starts = first[:-1][np.diff(first) > 0]
    out = np.zeros((len(starts), 2 * PERMUTATIONS), np.uint64)
    for p in range(PERMUTATIONS if len(starts) else 0):
        v = value * _A[p] + _B[p]
        v ^= v >> np.uint64(32)
        out[:, 2 * p] = np.minimum.reduceat(v, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(v, starts)
    return out


def _digest(value: np.ndarray, starts: np.ndarray) -> list[bytes]:
    if not len(starts):
        return []
    both = np.stack([np.add.reduceat(mix64(value ^ np.uint64(c)), starts) for c in (0x1234567, 0xABCDEF0123)], 1)
    return [x.tobytes() for x in both]


def bands_for(percent: int) -> int:
    """Bands, ``BANDS`` at least, by which a pair at the threshold misses all buckets with a probability under ``MISS``, as far as the signature goes."""
    return min(max(BANDS, math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))), 2 * PERMUTATIONS // ROWS)


def _describe(docs: DataFrame, keep: tuple[str, ...], n_bands: int = BANDS) -> DataFrame:
    """(keep..., tk, n, node, sig, bands) of every row; node, sig and bands null for an empty set."""
    some = docs.select(*keep, text_key(F.col("text")).alias("tk"), F.col("text").cast("string").alias("text"))

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        value, first = shingle_sets(texts_of(batch, "text"))
        sizes = np.diff(first)
        full = np.flatnonzero(sizes > 0)
        sig = signatures(value, first)
        bands = [mix64(windows(sig[:, b * ROWS : (b + 1) * ROWS].reshape(-1), ROWS)[::ROWS] + np.uint64(b)) for b in range(n_bands)] if len(full) else []
        bands = np.stack(bands, 1).view(np.int64) if len(full) else np.zeros((0, n_bands), np.int64)
        where = pa.array(np.where(sizes > 0, np.cumsum(sizes > 0) - 1, 0), mask=sizes == 0)
        short = (sig >> np.uint64(17)).astype(np.uint8)
        made = [pa.array(_digest(value, first[:-1][full]), pa.binary()), pa.array([x.tobytes() for x in short], pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * n_bands, pa.int32()), pa.array(bands.reshape(-1)))]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in keep], batch.column("tk"), pa.array(sizes.astype(np.int64)), *[x.take(where) for x in made]],
            names=[*keep, "tk", "n", "node", "sig", "bands"],
        )

    kinds = dict(some.dtypes)
    return arrow_map(some, over, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", tk binary, n bigint, node binary, sig binary, bands array<bigint>", "text")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, members): the sorted shingle hashes, as bytes, of the nodes in wanted (node, tk)."""
    some = docs.select(text_key(F.col("text")).alias("tk"), F.col("text").cast("string").alias("text")).join(wanted, "tk").select("node", "text")

    def over(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        nodes = batch.column("node").to_pylist()
        fresh = list({n: i for i, n in enumerate(nodes)}.values())  # copies of a text are neighbours here
        batch = batch.take(pa.array(fresh))
        value, first = shingle_sets(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array([value[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())], names=["node", "members"])

    found = arrow_map(some, over, "node binary, members binary", "text")
    return found.groupBy("node").agg(F.first("members").alias("members"))


def _meeting(edges: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """edges (a, b) with the columns of left (by a) and right (by b); a hub's many pairs are dealt into parts, and its row goes to each part."""
    edges = edges.select("a", "b")
    parts = edges.groupBy("b").agg(F.ceil(F.count("*") / MEET).cast("int").alias("parts"))
    dealt = edges.join(parts, "b").select("a", "b", F.pmod(F.hash("a"), F.col("parts")).alias("part"))
    spread = right.join(parts.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "b")
    return dealt.join(left, "a").join(spread, ["b", "part"])


def _checked(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, similarity, linked) of edges (a, b), on full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    both = _meeting(edges, left, right).select("a", "b", "ma", "mb")

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        share, linked = [], []
        for x, y in zip(batch.column("ma"), batch.column("mb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            union = len(x) + len(y) - common
            share.append(common / union)
            linked.append(100 * common >= percent * union)
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(share, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "similarity", "linked"])

    return arrow_map(both, over, "a binary, b binary, similarity double, linked boolean", "ma", 8 << 20)


def _least_estimate(percent: int, values: int = 2 * PERMUTATIONS) -> float:
    """The share of equal signature bytes, ERRORS standard errors below what a pair at the threshold is expected to have.

    Bytes of different values are equal by chance once in 256.
    """
    j = percent / 100
    equal = j + (1 - j) / 256
    return equal - ERRORS * (equal * (1 - equal) / values) ** 0.5


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _promising(edges: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Edges whose sizes and half signatures leave a link possible."""
    half = F.substring("sig", 1, PERMUTATIONS)
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), half.alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), half.alias("sb"))
    both = _meeting(edges, a, b).filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")
    least = _least_estimate(percent, PERMUTATIONS)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = (_bytes(batch.column("sa")) == _bytes(batch.column("sb"))).mean(1)
        return batch.select(["a", "b"]).filter(pa.array(same >= least))

    return arrow_map(both, over, "a binary, b binary")


def _pairs_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j inside each of the neighbouring groups."""
    starts = np.cumsum(sizes) - sizes
    i, j = [], []
    for m in np.unique(sizes[sizes > 1]).tolist():
        a, b = np.triu_indices(m, 1)
        base = starts[sizes == m][:, None]
        i.append((base + a).ravel())
        j.append((base + b).ravel())
    return (np.concatenate(i), np.concatenate(j)) if i else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _shared(sets: DataFrame) -> DataFrame:
    """(node, s): how many shingles of each set stand in another set too; a few more at most, never fewer."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column("members").to_pylist()), np.int64))], names=["h"])

    twice = cut(arrow_map(sets.select("members"), each, "h bigint", "members").groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h"))
    there = bit_set(twice, "h", twice.count())

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [np.frombuffer(x, np.uint64) for x in batch.column("members").to_pylist()]
        known = np.append(0, np.cumsum(there.maybe(np.concatenate(parts))))
        ends = np.cumsum([len(x) for x in parts])
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(known[ends] - known[ends - np.array([len(x) for x in parts])], pa.int64())], names=["node", "s"])

    return arrow_map(sets, count, "node binary, s bigint", "members")


def _residual(members: DataFrame, nodes: DataFrame, label: DataFrame, percent: int, block: int, trials: int | None) -> DataFrame:
    """Distinct (a, b) that the bounds leave, from members (bucket, node, hub_similarity) and nodes (node, n, s, sig, bands).

    With trials, so many for each two components in a task, those of the best
    estimate.  Signatures are joined last, to members of buckets of several components.
    """
    placed = members.join(label, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    # components beyond a block have blocks of their own, which come first; the others share the rest
    alone = F.when(F.col("k") > block, F.ceil(F.col("k") / block)).otherwise(0)
    crowd = sizes.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.sum(alone).alias("big"), F.ceil(F.sum(F.when(F.col("k") <= block, F.col("k")).otherwise(0)) / block).alias("mixed"))
    crowd = crowd.filter("c0 <> c1").select("bucket", F.col("big").cast("int").alias("big"), F.col("mixed").cast("int").alias("mixed"))
    upto = F.sum("own").over(Window.partitionBy("bucket").orderBy("comp").rowsBetween(Window.unboundedPreceding, 0))
    large = sizes.filter(F.col("k") > block).select("bucket", "comp", F.ceil(F.col("k") / block).cast("int").alias("own")).withColumn("first", (upto - F.col("own")).cast("int"))
    some = placed.join(crowd, "bucket").join(large, ["bucket", "comp"], "left").join(nodes, "node")
    is_large, every = F.col("own").isNotNull(), F.sequence(F.lit(0), F.col("big") + F.col("mixed") - 1)
    mine = F.when(is_large, F.col("first") + F.pmod(F.hash("node"), F.col("own"))).otherwise(F.col("big") + F.pmod(F.hash("node"), F.greatest("mixed", F.lit(1))))
    others = F.filter(every, lambda o: ~is_large | (o < F.col("first")) | (o >= F.col("first") + F.col("own")))
    meet = F.transform(others, lambda o: F.struct(F.least(F.col("mine"), o).alias("x"), F.greatest(F.col("mine"), o).alias("y")))
    dealt = some.withColumn("mine", mine).select("bucket", "node", "comp", "n", "s", "sig", "bands", "hub_similarity", "mine", F.explode(meet).alias("p"))
    dealt = dealt.select("bucket", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "mine", "node", "comp", "n", "s", "sig", "bands", "hub_similarity")
    dealt = dealt.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    least, apart = _least_estimate(percent), 1 - percent / 100 + 1e-9

    def test(b: pa.RecordBatch | pa.Table, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        comp = np.unique(np.array(b.column("comp").to_pylist(), object), return_inverse=True)[1]
        n, s, hub = b.column("n").to_numpy(), b.column("s").to_numpy(), b.column("hub_similarity").to_numpy(zero_copy_only=False)
        mine, x, y = (b.column(k).to_numpy() for k in ("mine", "x", "y"))
        sig = _bytes(b.column("sig").combine_chunks() if isinstance(b, pa.Table) else b.column("sig"))
        ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        most = np.minimum(s[i], s[j])
        ok &= 100 * most >= percent * (n[i] + n[j] - most)
        ok &= (mine[i] != mine[j]) | (x[i] == y[i])  # two blocks: only across; one block with itself: all
        with np.errstate(invalid="ignore"):
            ok &= ~(np.abs(hub[i] - hub[j]) > apart)
        i, j = i[ok], j[ok]
        lists = b.column("bands").combine_chunks() if isinstance(b, pa.Table) else b.column("bands")
        bands, bucket = lists.flatten().to_numpy().reshape(len(lists), -1), b.column("bucket").to_numpy()
        once = [bands[p, (bands[p] == bands[q]).argmax(1)] == bucket[p] for p, q in ((i[k : k + 65536], j[k : k + 65536]) for k in range(0, len(i), 65536))]
        once = np.concatenate(once) if once else np.zeros(0, bool)
        i, j = i[once], j[once]
        near = np.concatenate([(sig[i[k : k + 65536]] == sig[j[k : k + 65536]]).mean(1) for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        kept = np.flatnonzero(near >= least)
        if trials is not None and len(kept):
            x, y = comp[i[kept]], comp[j[kept]]
            both = np.minimum(x, y) * (comp.max() + 1) + np.maximum(x, y)
            order = np.lexsort((-near[kept], both))
            new = np.append(True, both[order][1:] != both[order][:-1])
            place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            kept = kept[order[place < trials]]
        nodes = b.column("node").to_pylist()
        pairs = {tuple(sorted((nodes[p], nodes[q]))) for p, q in zip(i[kept].tolist(), j[kept].tolist())}
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.binary()), pa.array([q for _, q in pairs], pa.binary())], names=["a", "b"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _ending(batches):
            table = pa.Table.from_batches([x for x in (held, batch) if x is not None]) if batch is not None or held is not None else None
            if table is None:
                return
            table = table.combine_chunks()
            keys = [table.column(k).to_numpy() for k in ("bucket", "x", "y")]
            new = np.ones(len(table), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            starts = np.flatnonzero(new)
            stop = len(table) if batch is None else int(starts[-1])  # the last group may go on
            held = table.slice(stop).to_batches()[0] if stop < len(table) else None
            starts = starts[starts < stop]
            sizes = np.diff(np.append(starts, stop))
            at = 0
            while at < len(sizes):  # about two million pairs at a time
                upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:] ** 2), 4_000_000, "right")) + at)
                lo, hi = int(starts[at]), int(starts[at] + sizes[at:upto].sum())
                some = table.slice(lo, hi - lo)
                yield test(some, sizes[at:upto], *_pairs_of(sizes[at:upto]))
                at = upto

    return dealt.mapInArrow(over, "a binary, b binary").distinct()


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def near_duplicates(docs: DataFrame, *keep: str, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(keep..., n_shingles, comp, component_id) of every row of docs; doc_id is among keep.

    component_id is the smallest doc_id that links reach; comp stands for the
    component and is null for a row without a set.
    """
    keep = keep or ("doc_id",)
    rows = cut(_describe(docs, keep, bands_for(percent)))
    full = rows.filter(F.col("node").isNotNull())
    banded = full.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("bucket")
    pairs = cut(banded.join(shared, "bucket").distinct())
    sized = pairs.join(pairs.groupBy("bucket").agg(F.count("*").alias("m")), "bucket")
    weight = sized.groupBy("node").agg(F.sum("m").alias("w"))
    hubs = pairs.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("w", "node")).alias("h")).select("bucket", F.col("h.node").alias("hub"))
    members = cut(pairs.join(hubs, "bucket"))
    discard(pairs)
    involved = members.select("node").distinct()
    # copies of a set are combined map-side before they meet
    once = full.groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.min("tk").alias("tk"))
    nodes = cut(once.join(involved, "node", "left_semi"))
    stars = members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = cut(_promising(stars, nodes, percent))
    # a node without a promising edge cannot be linked by its hub, but may be by others: sets are kept for all involved
    sets = cut(_sets(docs, nodes.select("node", "tk")))
    first = cut(_checked(stars, sets, percent))
    label = components(first.filter("linked").select("a", "b"))
    known = first.select(F.col("a").alias("node"), F.col("b").alias("hub"), F.col("similarity").alias("hub_similarity"))
    # a set that shares too little with all others has no link at all
    fit = cut(nodes.select("node", "n", "sig", "bands").join(_shared(sets), "node").filter(100 * F.col("s") >= percent * F.col("n")))
    sure = F.when(F.col("node") == F.col("hub"), 1.0).otherwise(F.coalesce("hub_similarity", F.lit(float("nan"))))
    open_ = cut(members.join(fit.select("node"), "node", "left_semi").join(known, ["node", "hub"], "left").select("bucket", "node", sure.alias("hub_similarity")))
    discard(members, stars)
    linked, used = first.filter("linked").select("a", "b"), [first]
    for trials in (TRIALS, None):
        rest = cut(_residual(open_, fit, label, percent, block, trials))
        if rest.isEmpty():
            break
        more = cut(_checked(rest, sets, percent).filter("linked").select("a", "b"))
        discard(rest)
        used.append(more)
        if not more.isEmpty():
            linked = linked.unionByName(more)
            label = components(linked)
    discard(sets, open_, fit, nodes, *used)
    least = full.groupBy("node").agg(F.min("doc_id").alias("least")).join(label, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    named = least.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = least.select("node", "comp").join(named, "comp").select("node", "comp", "component_id")
    found = full.select(*keep, "n", "node").join(named, "node").select(*keep, F.col("n").alias("n_shingles"), "comp", "component_id")
    alone = rows.filter(F.col("node").isNull()).select(*keep, F.col("n").alias("n_shingles"), F.col("node").alias("comp"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(docs, "doc_id")
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of docs, all their columns: one of each component at percent, of the smallest doc_id; rows without a set all stay."""
    key = row_key(F.col("doc_id"), F.col("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = cut(near_duplicates(docs.select("doc_id", "text", key.alias("__key")), "doc_id", "__key", percent=percent))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key"))
    stay = found.filter(F.col("comp").isNotNull()).groupBy("comp").agg(first.alias("f")).select(F.col("f.__key").alias("__key"), F.lit(True).alias("__one"))
    stay = stay.unionByName(found.filter(F.col("comp").isNull()).select("__key", F.lit(False).alias("__one")).distinct())
    kept = docs.withColumn("__key", key).join(stay, "__key")
    # rows alike in doc_id and text share the key; of those that have a set one stays
    number = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return kept.withColumn("__number", number).filter("not __one or __number = 1").select(*columns)
