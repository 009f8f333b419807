"""Prefix trie of conversations by chained digests.

A turn is its role and text; the digest of a prefix is the digest of the prefix
before it and of its last turn, so equal (depth, digest) is equal turns.  Every
prefix of every conversation is a row, and rows are grouped by (depth, digest)
into nodes with their members.

Sums over subtrees come from exploding nodes to their ancestors.  Nodes with the
same smallest member are one run down that member's path (a node's other
members part from it further down), so a run is exploded at once, with the sum
over it, to the runs above: to each the depth at which its path leaves that run.
These rows are never more than the turns, where all pairs of node and ancestor
grow with the square of the depth.  Sums along a run are then a window by run.

Digests of member lists are sequential by nature: ids are sorted over the
cluster and joined in pieces of PIECE ids, and a node's pieces run through its
digest one after the other.

Turns are in order of turn (null first), ties by role, then digest of the text.
Rows without conv_id belong to no conversation.  Null roles and texts are
empty.  No conversation, no rows.  Codes: a node is (owner, depth), owner being
its smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import cut, join_counted

PIECE = 4096
#: Of which conversation the first turns come, and how many.
PREFIX_OF, PREFIX_UP_TO = 100, 6


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place from 0), digest, chars of each turn."""
    role, text = F.coalesce("role", F.lit("")).cast("string"), F.coalesce("text", F.lit("")).cast("string")
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    some = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), F.char_length(text).alias("chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return some.select("conv_id", (F.row_number().over(order) - 1).alias("i"), "digest", "chars")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a rebuilt conversation takes from conv_id - conv_id % 100."""
    return F.crc32(conv_id.cast("string").cast("binary")) % PREFIX_UP_TO


def rebuilt(found: DataFrame) -> DataFrame:
    """Turns with each conversation's first ones replaced by those of its hundred's first; i may leave gaps."""
    convs = found.select("conv_id").distinct()
    own = found.filter(F.col("i") >= shared_turns(F.col("conv_id")))
    heads = found.filter((F.col("i") < PREFIX_UP_TO) & (F.col("conv_id") % PREFIX_OF == 0)).withColumnRenamed("conv_id", "base")
    taken = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % PREFIX_OF).join(heads, "base").filter(F.col("i") < shared_turns(F.col("conv_id")))
    return own.unionByName(taken.select(*own.columns))


def prefixes(found: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), digest of the chained prefix, chars of its last turn, is_end; found has conv_id, i, digest, chars."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row waits until it is known whether the conversation goes on
        for batch in batches:
            out = []
            for conv, digest, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "chars"))):
                before = held if held is not None and held[0] == conv else (conv, 0, b"")
                if held is not None:
                    out.append((*held, held[0] != conv))
                held = (conv, before[1] + 1, hashlib.sha256(before[2] + digest).digest(), chars)
            yield _batch(out)
        if held is not None:
            yield _batch([(*held, True)])

    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("digest", pa.binary()), ("chars", pa.int64()), ("is_end", pa.bool_())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    dealt = found.select("conv_id", "i", "digest", "chars").repartition("conv_id").sortWithinPartitions("conv_id", "i")
    return dealt.mapInArrow(chain, "conv_id long, depth int, digest binary, chars long, is_end boolean")


def _pieces(ends: DataFrame) -> DataFrame:
    """owner, depth, first, ids (joined) in runs of the sorted ids."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, node, ids = [], None, []
            for owner, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "conv_id"))):
                if (owner, depth) != node or len(ids) == PIECE:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (owner, depth), []
                ids.append(conv)
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=["owner", "depth", "first", "ids"])

    return ends.repartitionByRange("owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id").mapInArrow(join, "owner long, depth int, first long, ids string")


def _digests(pieces: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256: a node's pieces in order through one digest, whose state is all that is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for owner, depth, ids in zip(*(batch.column(c) for c in ("owner", "depth", "ids"))):
                at, text = (owner.as_py(), depth.as_py()), ids.as_py().encode()
                if at != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(text)
                else:
                    state.update(b",")
                    state.update(text)
            if out:
                yield _rows(out)
                out = []
        if node is not None:
            yield _rows([(*node, state.hexdigest())])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.string()))], names=["owner", "depth", "ends_sha256"])

    return pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(run, "owner long, depth int, ends_sha256 string")


def trie(conv_ids: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes of the trie over conversations: conv_ids (conv_id, each once) and their turns (conv_id, i, digest, chars).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of each node, the root included.
    """
    rows = prefixes(found)
    # the root is every conversation's prefix of depth 0, and the end of those without turns
    with_turns = found.select("conv_id").distinct().withColumn("__some", F.lit(True))
    roots = conv_ids.join(with_turns, "conv_id", "left").select("conv_id", F.lit(0).alias("depth"), F.lit(b"").alias("digest"), F.lit(0).cast("bigint").alias("chars"), F.col("__some").isNull().alias("is_end"))
    rows = cut(rows.unionByName(roots))
    nodes = cut(rows.groupBy("depth", "digest").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")))
    # what is true of a node's rows stands beside each of them; nodes of many rows are broadcast, see join_counted
    paths = cut(join_counted(rows, nodes.withColumn("members", F.col("n_convs")), ["depth", "digest"], "n_convs").drop("digest"))
    own = paths.filter("conv_id = owner")
    above = Window.partitionBy("conv_id").orderBy("depth")
    owners = paths.join(own.select("conv_id").distinct(), "conv_id", "left_semi").withColumn("parent", F.lag("owner").over(above)).filter("conv_id = owner")
    children = owners.filter("parent is not null").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    made = owners.select("owner", "depth", "parent", "members", ((F.col("members") - 1) * F.col("chars")).alias("saved")).join(children, ["owner", "depth"], "left")
    made = cut(made.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))).withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")))
    runs = made.groupBy("owner").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")).withColumnRenamed("owner", "conv_id")
    passed = paths.filter("conv_id <> owner").groupBy("conv_id", "owner").agg(F.max("depth").alias("depth")).join(runs, "conv_id")
    below = passed.groupBy("owner", "depth").agg(F.sum("saved").alias("saved_below"), F.sum("leaf").alias("leaf_below"))
    down = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    sums = made.join(below, ["owner", "depth"], "left").select(
        "owner", "depth", "parent", "members", "n_children",
        F.sum(F.col("leaf") + F.coalesce("leaf_below", zero)).over(down).alias("n_leaves"), F.sum(F.col("saved") + F.coalesce("saved_below", zero)).over(down).alias("saved_tokens"),
    )
    ends = _digests(_pieces(paths.filter("is_end").select("owner", "depth", "conv_id")))
    none = hashlib.sha256(b"").hexdigest()
    return sums.join(ends, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def of_conversations(conversations: DataFrame) -> DataFrame:
    """The trie over conversations (conv_id, turn, role, text) as they stand."""
    found = cut(turns(conversations))
    return trie(found.select("conv_id").distinct(), found)


def of_rebuilt(conversations: DataFrame) -> DataFrame:
    """The trie over rebuilt conversations."""
    found = cut(turns(conversations))
    return trie(found.select("conv_id").distinct(), rebuilt(found))
