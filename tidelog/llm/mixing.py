"""Mixing sources to target weights (DataFrame functions only).

Targets: the sources, by code point with null last, weigh 5, 2, 1 and again,
and share 150 % of all words; no target exceeds twice its source's size, the
excess goes to the others by weight.  That is one water level: with sources
ordered by cap / weight, the first k are capped and the level is
(total - their caps) / (weights left), so a window over the per-source sums
finds it without a loop.

Taking: every document gets a hash-random key.  Within a source, documents in
key order form an endless tape; a whole epoch takes every document once and
the rest of the budget is cut from the tape's start at the exact word.  Places
on the tape come from a two-level prefix sum: sums by (source, key range),
prefix sums over ranges, and a window inside each range only, so no task holds
a whole source.  Only the targets, three numbers a source, meet in one task,
for the level is one number of all sources; it sorts and spills like any other.

Nulls: a null text has size 0 and takes 0; a null source is a source of its
own; a null doc_id is a value like others.  Repeated rows share a key and are
laid side by side; which of two identical rows the cut falls on is no
difference.  Empty tables give empty results.  Reruns agree: keys come from
content only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BLANKS

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
#: Hexadecimal digits of the key that name a range: 4,096 ranges, about 250,000 documents each of a source of 10^9.
DIGITS = 3


def n_words(text: Column) -> Column:
    """Number of runs of non-blanks, without building the words: a word starts where a blank-to-word edge is."""
    spaced = F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " " * len(BLANKS))
    return F.when(F.length(F.trim(spaced)) == 0, F.lit(0)).otherwise(F.size(F.split(F.trim(spaced), " +"))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target double) from (source, source_size): one row for each source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("__w", F.get(weigh, ((F.row_number().over(order) - 1) % len(weights)).cast("int")).cast("bigint"))
    cap = F.col("source_size") * most
    by_ratio = Window.orderBy((cap / F.col("__w")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = ranked.withColumns({
        "__capped": F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "__left": F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(before), F.lit(0)),
        "__total": F.sum("source_size").over(whole) * F.lit(share),
    })
    level = (F.col("__total") - F.col("__capped")) / F.col("__left")
    # the first source in ratio order whose cap the level does not exceed sets the level for itself and all after it
    found = found.withColumn("__level", F.when(level * F.col("__w") <= cap, level))
    first = F.first("__level", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found = found.withColumn("__water", first)
    return found.select("source", "source_size", F.when(F.col("__level").isNull(), cap.cast("double")).otherwise(F.least(F.col("__water") * F.col("__w"), cap.cast("double"))).alias("target"))


def take(docs: DataFrame, *keep: str, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS, seed: int = 0) -> DataFrame:
    """Per row: keep..., size, source_size, target, taken (words, repeats counted)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        *keep,
        F.col("source").alias("__source"),
        n_words(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text)).alias("__key"),
    ).withColumn("__range", F.conv(F.substring("__key", 1, DIGITS), 16, 10).cast("int"))
    by_range = sized.groupBy("__source", "__range").agg(F.sum("size").alias("__in"))
    per_source = by_range.groupBy("__source").agg(F.sum("__in").alias("source_size")).withColumnRenamed("__source", "source")
    goal = targets(per_source, weights, share, most).withColumnRenamed("source", "__s")
    over = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_range.withColumn("__base", F.coalesce(F.sum("__in").over(over), F.lit(0))).drop("__in")
    starts = starts.join(goal, starts["__source"].eqNullSafe(goal["__s"])).drop("__s").withColumnsRenamed({"__source": "__s", "__range": "__r"})
    inside = Window.partitionBy("__source", "__range").orderBy("__key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("__at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, placed["__source"].eqNullSafe(starts["__s"]) & (placed["__range"] == starts["__r"]))
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = budget - epochs * F.col("source_size")
    cut_at = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - (F.col("__base") + F.col("__at"))))
    return placed.select(*keep, "size", "source_size", "target", (epochs * F.col("size") + cut_at).cast("bigint").alias("taken"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of docs, all their columns, as often as the mix takes them.

    A document is laid out once for each whole time it is taken and once more
    for a begun one, so that no text is cut; of a text without words nothing is
    taken.  First copies and second ones are parts of a union, so that no two
    copies of a document are neighbours.
    """
    columns = docs.columns
    held = [f"`{c}`" for c in columns]
    taken = take(docs.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)], F.col("doc_id"), F.col("text"), F.col("source")), *[f"__c{i}" for i in range(len(columns))], seed=seed)
    times = F.ceil(F.col("taken") / F.col("size"))
    whole = None
    for k in range(MOST_EPOCHS):
        layer = taken.filter((F.col("taken") > 0) & (times > k))
        whole = layer if whole is None else whole.unionByName(layer)
    return whole.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)]).select(*held)
