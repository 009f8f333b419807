"""Secret scan by corpus-wide ownership, native.

Candidates are the contract's three patterns and, beside them, long runs of
mixed characters that no pattern covers.  Values (what follows the name in an
assignment, else the whole span) are hashed and counted over the corpus by
distinct repositories and owners: a value that many owners have is a widely
copied example, one that few have looks live.  All spans of the contract's
patterns stay; a mixed run is a span of kind ``owned`` only if its value is
specific to its owners.

An owner is a document's source, a repository the document itself, unless the
caller names other columns; a null counts as one owner or repository of its own.
Texts are scanned where they are read; only values' hashes are shuffled.  Null
text is empty.  Rows alike each come out; a document without spans has '' in
spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import cut, join_counted

# The contract's patterns (letters of either case are spelled out, for folding differs between engines) and least lengths.
_NAMES = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST_ASSIGN = 12
#: Runs of the other two are taken whole, so a least length in the pattern finds what dropping short matches leaves.  Mixed runs have both cases and digits.
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}", "owned": "[A-Za-z0-9+/_-]{24,}"}
KINDS = tuple(PATTERNS)
OWNED = KINDS.index("owned")
#: Least number of different characters of a mixed run.
MIXED_KINDS = 12
#: A value of so many owners or more is widely copied.
WIDE = 3


def hits(text: Column, kind: int, pattern: str) -> Column:
    """kind, i, gap and match of each match in order: gap is what stands between it and the one before, so places are running sums."""
    both = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    some = F.filter(F.transform(both, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["match"].alias("match"))), lambda x: x["match"].isNotNull())
    return F.when(text.rlike(pattern), some).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,match:string>>"))


def _mixed(value: Column) -> Column:
    return value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]") & (F.size(F.array_distinct(F.split(value, ""))) >= MIXED_KINDS)


def candidates(rows: DataFrame) -> DataFrame:
    """row, owner, repository, kind, start, stop and value of the candidates in rows (row, owner, repository, hits).

    Windows are by document, so a text with any number of matches costs a sort.
    """
    each = rows.select("row", "owner", "repository", F.inline("hits")).repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("match").cast("bigint")
    placed = each.withColumn("stop", F.sum(F.col("gap") + size).over(so_far)).withColumn("start", F.col("stop") - size)
    placed = placed.withColumn("value", F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match")))
    named = F.col("kind") < OWNED
    placed = placed.filter(F.when(F.col("kind") == 0, F.char_length("value") >= LEAST_ASSIGN).when(named, F.lit(True)).otherwise(_mixed(F.col("value"))))
    # a mixed run counts where no span of a pattern touches it
    by_start = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(named, F.col("stop"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(F.when(named, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    placed = placed.withColumn("__free", F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("stop"), F.lit(True)))
    return placed.filter(named | F.col("__free")).select("row", "owner", "repository", "kind", "start", "stop", F.unhex(F.md5(F.col("value").cast("binary"))).alias("value"))


def ownership(found: DataFrame) -> DataFrame:
    """value, n (rows), n_repositories and n_owners of found (value, repository, owner); counted by repository, then by owner, so a value that all have is summed where it stands."""
    by_repository = found.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("n_repositories"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n"), F.sum("n_repositories").alias("n_repositories"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source", wide: int = WIDE) -> DataFrame:
    """doc_id and its spans, an array of (start, kind, stop, n_repositories, n_owners, live) in order; places count code points.

    kind is a place in KINDS.  live: fewer than ``wide`` owners have the value.
    A repository counts once for each owner that has it.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select("doc_id", F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner"), text.alias("text"))
    # written once, so the numbers of rows stay what they are if a task runs again
    found = F.concat(*(hits(F.col("text"), k, PATTERNS[name]) for k, name in enumerate(KINDS)))
    rows = cut(some.select("doc_id", "repository", "owner", found.alias("hits")).withColumn("row", F.monotonically_increasing_id()))
    values = cut(candidates(rows))
    judged = join_counted(values.select("row", "kind", "start", "stop", "value"), cut(ownership(values)), ["value"])
    live = F.col("n_owners") < wide
    judged = judged.filter((F.col("kind") < OWNED) | live)
    by_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "n_repositories", "n_owners", live.alias("live")))).alias("spans"))
    none = F.array().cast(by_row.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:stop of spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and n_owned, n_live, n_copied (contract spans that look live, that are widely copied).

    A span is the whole match; the value of an assignment is its second group.
    """

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("bigint")

    def of_kind(k: int) -> Column:
        return count(lambda s: s["kind"] == k)

    return scan(docs).select(
        "doc_id", *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:OWNED])],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < OWNED)).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        of_kind(OWNED).alias("n_owned"), count(lambda s: (s["kind"] < OWNED) & s["live"]).alias("n_live"), count(lambda s: (s["kind"] < OWNED) & ~s["live"]).alias("n_copied"),
    )
