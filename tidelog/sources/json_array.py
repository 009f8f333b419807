"""One huge JSON array, read in parallel.

A file is cut where braces close, by the text reader with } for a line end, so
splits are byte ranges that any number of tasks read.  Whether a piece begins
inside a string, and how deep in braces, depends on all that stands before it:
each split is summed up for both cases of a string, the splits' sums (a row
each) are scanned in order, and a running sum inside a split gives the rest.
Pieces that begin at depth 0 begin an object; those of an object, also of one
that lies across splits, are put together by where it begins.

Elements that are no objects are left out; files may as well hold objects one
after the other (a line each).  A file that ends inside an object gives what is
there, which is no JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, at (its time), block and turn (ascending in a file) and value of each object directly inside the arrays of JSON files."""
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", "}").text(paths).select(
        meta["file_path"].alias("file"), meta["file_modification_time"].cast("timestamp_ntz").alias("at"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("turn"), "value",
    )
    # without escaped characters, every other run between quotes is outside of strings
    runs = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    outside = lambda odd: F.array_join(F.filter(runs, lambda x, i: i % 2 == odd), "")
    braces = lambda s: F.char_length(s) - F.char_length(F.replace(s, F.lit("{")))
    sized = pieces.select("*", (F.size(runs) - 1).alias("quotes"), braces(outside(0)).alias("even"), braces(outside(1)).alias("odd"))
    inside = Window.partitionBy("file", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = sized.withColumn("parity", F.sum("quotes").over(inside) % 2).withColumn("before", F.abs(F.col("parity") - F.col("quotes")) % 2)

    def step(start: int):
        """Braces opened less the one closed, if the split begins outside (0) or inside (1) of a string."""
        opened = F.when(F.col("before") == start, F.col("even")).otherwise(F.col("odd"))
        return opened - F.when(F.col("parity") == start, 1).otherwise(0)

    steps = sized.withColumns({"step0": step(0), "step1": step(1)}).withColumns({"depth0": F.sum("step0").over(inside), "depth1": F.sum("step1").over(inside)})
    splits = steps.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.sum("step0").alias("total0"), F.sum("step1").alias("total1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("string", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    total = F.when(F.col("string") == 0, F.col("total0")).otherwise(F.col("total1"))
    starts = starts.withColumn("depth", F.coalesce(F.sum(total).over(earlier), F.lit(0))).select("file", "block", "string", "depth")
    placed = steps.join(starts, ["file", "block"])
    own = lambda name: F.when(F.col("string") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    begins = F.col("depth") + own("depth") - own("step") == 0
    known = placed.select("file", "at", "block", "turn", "value", F.when(begins, F.struct("block", "turn")).alias("start"))
    # the last start of the splits before, for the pieces that a split begins with
    lasts = known.groupBy("file", "block").agg(F.max("start").alias("last"))
    lasts = lasts.select("file", "block", F.max("last").over(earlier).alias("carried"))
    whole = known.join(lasts, ["file", "block"]).withColumn("start", F.coalesce(F.max("start").over(inside), "carried"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "turn", "value"))), lambda x: x["value"]), "}")
    made = whole.groupBy("file", "at", "start").agg(F.concat(text, F.lit("}")).alias("value"))
    # what stands before an object's brace: the bracket or comma, blanks, and elements that are no objects
    found = made.withColumn("value", F.substring("value", F.locate("{", "value"), F.lit((1 << 31) - 1))).filter(F.locate("{", "value") > 0)
    return found.select("file", "at", F.col("start.block").alias("block"), F.col("start.turn").alias("turn"), "value")
