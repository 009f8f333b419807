"""Engagement throttle: which snapshots of a post to keep.

Whether a snapshot is kept depends on the last one that was kept, not on the
one before, so this is a fold, not a window.  Posts are independent; tasks get
the rows sorted by post and fold them as they stream by, with one instant as
state, so a long history is no array anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.times import epoch_micros

GAP_SECONDS = 60 * 60
OLD_SECONDS = 14 * 24 * 60 * 60


def keep(rows: DataFrame, key: list[str], at: str, seq: str, *, gap_seconds: int = GAP_SECONDS, old_seconds: int | None = OLD_SECONDS, created: str | None = None, last: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Kept rows: key, at, seq and carry.

    In order of seq, a row passes if it stands at least the gap after the last
    kept one (``last``: the latest already stored).  A post that is
    ``old_seconds`` old gets a row only if it has none.  A null ``created``
    counts as young.  A row before the last kept one is dropped.
    """
    carry = carry or []
    us = epoch_micros(F.col(at))
    old = F.lit(False)
    if created is not None and old_seconds is not None:
        old = F.coalesce(us - epoch_micros(F.col(created)) >= old_seconds * 1_000_000, F.lit(False))
    before = epoch_micros(F.col(last)) if last is not None else F.lit(None).cast("bigint")
    some = rows.select(*key, at, seq, *carry, us.alias("__us"), old.alias("__old"), before.alias("__before"))
    dealt = some.repartition(*key).sortWithinPartitions(*key, seq)
    out = some.drop("__us", "__old", "__before").schema
    names, gap = out.fieldNames(), gap_seconds * 1_000_000

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        post, stood = None, None
        for batch in batches:
            passes = []
            keys = zip(*[batch.column(k).to_pylist() for k in key])
            for k, t, aged, known in zip(keys, *[batch.column(c).to_pylist() for c in ("__us", "__old", "__before")]):
                if k != post:
                    post, stood = k, known
                ok = stood is None or not aged and t is not None and t - stood >= gap
                stood = t if ok else stood
                passes.append(ok)
            yield batch.select(names).filter(pa.array(passes, pa.bool_()))

    return dealt.mapInArrow(over, out)


def filter_engagement(candidates: DataFrame, stored: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows of candidates (with ingest_seq) to append to stored: latest stored time and creation time are joined first."""
    latest = stored.groupBy("ts_id").agg(F.max("observed_at").alias("__last"))
    born = posts.select("ts_id", F.col("created_at_utc").alias("__created"))
    rest = [c for c in candidates.columns if c not in ("ts_id", "observed_at", "ingest_seq")]
    both = candidates.join(latest, "ts_id", "left").join(born, "ts_id", "left")
    return keep(both, ["ts_id"], "observed_at", "ingest_seq", created="__created", last="__last", carry=rest).select(*candidates.columns)
