"""Merkle manifest of a table: a radix-ranked trie by group, and a tree over the groups.

Ranks without a global sort: rows are counted by the digits of their id (12
bits each, from the highest in which ids differ), coarser histograms are sums of
finer ones, and a row's rank is the sum of what stands before it at each level.
No window holds more rows than a digit has values.  Rows alike in everything
are one row with a number of copies until the end; rows of one id go on by
digits of their digests.

The digits of a rank in base ``fanout`` then key the trie's nodes.  Nodes are
reduced by longest prefix: a task takes the nodes that share all but their last
digits (a block of at most BLOCK), reduces it to one node, and the next round
does so with what came out; 10^12 rows take four rounds.  Paths come down the
same way, a block at a time.

A row's leaf covers ``columns``; groups are ordered by value (null first, UTF-8
bytewise), rows by id (null first), then digest.  Empty tables give no rows.
The table of groups, one row each, is ranked in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import cut

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Most nodes of a block; its levels are as many digits as fit.
BLOCK = 1024
DIGIT = 12


def digest_of(values: list[Column]) -> Column:
    """Hex SHA-256 of values: - for null, else UTF-8 byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, path: Column, places: Column) -> Column:
    """The root that a leaf and the siblings on its path give: at each level the node stands at its place among them."""

    def up(node: Column, step: Column) -> Column:
        before = F.substring(step["siblings"], F.lit(1), step["place"] * 64)
        after = F.substring(step["siblings"], step["place"] * 64 + 1, F.length(step["siblings"]))
        return F.sha2(F.concat(before, node, after).cast("binary"), 256)

    return F.aggregate(F.arrays_zip(path.alias("siblings"), places.alias("place")), leaf, up)


# -- ranks -------------------------------------------------------------------


def _digits(found: DataFrame) -> list[Column]:
    """Digits of the ids in found, the highest first: of the bits in which any two differ."""
    ordered = F.col("id").bitwiseXOR(F.lit(-(1 << 63)))  # as unsigned numbers in order
    least = found.agg(F.min("id"), F.max("id")).first()
    bits = 0 if least[0] is None else ((least[0] ^ least[1]) & ((1 << 64) - 1)).bit_length()
    shifts = range((max(bits, 1) - 1) // DIGIT * DIGIT, -1, -DIGIT)
    return [F.coalesce(F.call_function("shiftrightunsigned", ordered, F.lit(s)).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int"), F.lit(-1)) for s in shifts]


def ranked(found: DataFrame) -> DataFrame:
    """found (grp, id, leaf, copies, ...), each (grp, id, leaf) once, with first, the rank of its first copy in grp, and total, the rows of grp."""
    digits = [*_digits(found), F.conv(F.substring("leaf", 1, DIGIT // 4), 16, 10).cast("int")]
    names = [f"__d{i}" for i in range(len(digits))]
    rows = found.withColumns(dict(zip(names, digits)))
    counts = [rows.groupBy("grp", *names).agg(F.sum("copies").alias("copies"))]
    for i in range(len(names) - 1, 0, -1):
        counts.insert(0, counts[0].groupBy("grp", *names[:i]).agg(F.sum("copies").alias("copies")))

    def before(part: list[str], order: str) -> Column:
        return F.coalesce(F.sum("copies").over(Window.partitionBy("grp", *part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    above = counts[0].select("grp", names[0], before([], names[0]).alias("__before"), F.sum("copies").over(Window.partitionBy("grp")).alias("total"))
    for i in range(1, len(names)):
        own = counts[i].withColumn("__own", before(names[:i], names[i]))
        above = own.join(above, ["grp", *names[:i]]).select("grp", *names[: i + 1], (F.col("__before") + F.col("__own")).alias("__before"), "total")
    rows = rows.withColumn("__own", before(names, "leaf")).join(above, ["grp", *names])
    return rows.withColumn("first", F.col("__before") + F.col("__own")).drop("__before", "__own", *names)


# -- the trie, a block of nodes at a time ------------------------------------


@dataclass(frozen=True)
class Shape:
    """Nodes under one, and levels of a block."""

    fanout: int
    depth: int

    @classmethod
    def of(cls, fanout: int, block: int) -> Shape:
        depth = 1
        while fanout ** (depth + 1) <= block:
            depth += 1
        return cls(fanout, depth)

    @property
    def span(self) -> int:
        return self.fanout**self.depth


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("bigint"))


def _height(total: int, fanout: int) -> int:
    height, wide = 0, 1
    while wide < total:
        height, wide = height + 1, wide * fanout
    return height


def _levels(nodes: list[str], height: int, fanout: int) -> list[list[str]]:
    """A block's nodes, level by level up to the one that is left."""
    out = [nodes]
    for _ in range(height):
        out.append([hashlib.sha256("".join(out[-1][i : i + fanout]).encode()).hexdigest() for i in range(0, len(out[-1]), fanout)])
    return out


def _block(table: pa.Table, shape: Shape, turn: int) -> tuple[list[list[str]], np.ndarray]:
    """Levels of a block in round ``turn``, and the row of the table that each of its nodes comes from."""
    order = np.argsort(table.column("first").to_numpy(), kind="stable")
    rows = np.repeat(order, table.column("copies").to_numpy()[order])
    digests = table.column("leaf").to_pylist()
    height = min(shape.depth, max(0, _height(table.column("total")[0].as_py(), shape.fanout) - shape.depth * turn))
    return _levels([digests[i] for i in rows.tolist()], height, shape.fanout), rows


def _reduced(nodes: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """The next round's nodes: one of each block."""

    def one(table: pa.Table) -> pa.Table:
        levels, _ = _block(table, shape, turn)
        return pa.table({"grp": table.column("grp")[:1], "total": table.column("total")[:1], "first": table.column("block")[:1], "leaf": [levels[-1][0]]})

    made = nodes.select("grp", "block", "total", "first", "copies", "leaf").groupBy("grp", "block").applyInArrow(one, "grp string, total long, first long, leaf string")
    return made.select("grp", "total", "first", F.lit(1).cast("bigint").alias("copies"), "leaf", _div(F.col("first"), shape.span).alias("block"))


def _spread(nodes: DataFrame, above: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """grp, place (rank in this round), payload, leaf, subroot, root, path and places of each node; above has the last four of each block."""
    payload = nodes.schema["payload"].dataType if "payload" in nodes.columns else None
    tail = [T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType()), T.StructField("path", T.ArrayType(T.StringType())), T.StructField("places", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([T.StructField("grp", T.StringType()), T.StructField("place", T.LongType()), T.StructField("leaf", T.StringType()), *([T.StructField("payload", payload)] if payload else []), *tail])

    def one(table: pa.Table, over: pa.Table) -> pa.Table:
        levels, rows = _block(table, shape, turn)
        fanout = shape.fanout
        known = over.to_pylist()[0]
        paths, places = [], []
        for i in range(len(rows)):
            path, at = [], []
            for level in levels[:-1]:
                low, place = i // fanout * fanout, i % fanout
                run = level[low : low + fanout]
                path.append("".join(run[:place] + run[place + 1 :]))
                at.append(place)
                i //= fanout
            paths.append(path + known["path"])
            places.append(at + known["places"])
        n, first = len(rows), int(table.column("first").to_numpy().min())
        out = {"grp": pa.array([known["grp"]] * n), "place": pa.array(range(first, first + n), pa.int64()), "leaf": pa.array(levels[0])}
        if payload:
            out["payload"] = table.column("payload").combine_chunks().take(pa.array(rows))
        out |= {"subroot": pa.array([known["subroot"]] * n, pa.string()), "root": pa.array([known["root"]] * n, pa.string()), "path": pa.array(paths, pa.list_(pa.string())), "places": pa.array(places, pa.list_(pa.int32()))}
        return pa.table(out)

    given = nodes.select("grp", "block", "total", "first", "copies", "leaf", *(["payload"] if payload else []))
    return given.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(one, schema)


def _tree(nodes: DataFrame, shape: Shape) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of nodes from the leaves up, and (grp, leaf) of each group's top."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    rounds = [nodes]
    while shape.span ** len(rounds) < most:
        rounds.append(cut(_reduced(rounds[-1], shape, len(rounds) - 1)))
    return rounds, cut(_reduced(rounds[-1], shape, len(rounds) - 1).select("grp", "leaf"))


def _paths(rounds: list[DataFrame], above: DataFrame, shape: Shape) -> DataFrame:
    """What ``_spread`` gives of the leaves; above has a row for each group."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for turn in range(len(rounds) - 1, 0, -1):
        above = _spread(rounds[turn], above, shape, turn).withColumnRenamed("place", "block").drop("leaf")
    return _spread(rounds[0], above, shape, 0)


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", group: str = "lang", fanout: int = FANOUT, block: int = BLOCK, carry: dict[str, Column] | None = None) -> DataFrame:
    """key, group, place (rank in the group), leaf, subroot, root, path, places and carry of each row of docs.

    path has the siblings (hex, concatenated, left to right) of the leaf and of
    each node above it, up to the root over all groups; places has the node's
    number among them.  key is a number; carry holds expressions over
    ``columns``.  Rows alike in all columns each have a place of their own.
    """
    value = F.col(group).cast("string")
    carried = {"key": F.col(key), "group": F.col(group)} | {f"c_{k}": v for k, v in (carry or {}).items()}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias("grp"), F.col(key).cast("bigint").alias("id"), digest_of([F.col(c) for c in columns]).alias("leaf"), F.struct(*[v.alias(k) for k, v in carried.items()]).alias("payload"),
    )
    found = cut(leaves.groupBy("grp", "id", "leaf").agg(F.first("payload").alias("payload"), F.count("*").alias("copies")))
    shape = Shape.of(fanout, block)
    span = shape.span
    last = F.col("first") + F.col("copies") - 1
    # a run of copies is cut where blocks end
    pieces = ranked(found).select("*", F.explode(F.sequence(_div(F.col("first"), span), _div(last, span))).alias("block"))
    start = F.greatest(F.col("first"), F.col("block") * span)
    nodes = cut(pieces.select("grp", "block", "total", start.alias("first"), (F.least(last, F.col("block") * span + span - 1) - start + 1).alias("copies"), "leaf", "payload"))
    rounds, tops = _tree(nodes, shape)
    # the groups are the leaves of one more tree
    number, all_ = F.row_number().over(Window.orderBy("grp")) - 1, F.count("*").over(Window.partitionBy())
    groups = tops.select(F.col("grp").alias("payload"), number.cast("bigint").alias("first"), all_.alias("total"), F.lit(1).cast("bigint").alias("copies"), "leaf")
    groups = cut(groups.select(F.lit("").alias("grp"), _div(F.col("first"), span).alias("block"), "total", "first", "copies", "leaf", "payload"))
    over, top = _tree(groups, shape)
    none = top.select("grp", F.lit(None).cast("string").alias("subroot"), F.col("leaf").alias("root"), F.array().cast("array<string>").alias("path"), F.array().cast("array<int>").alias("places"))
    by_group = cut(_paths(over, none, shape).select(F.col("payload").alias("grp"), F.col("leaf").alias("subroot"), "root", "path", "places"))
    made = _paths(rounds, by_group, shape)
    return made.select(F.col("payload.key").alias(key), F.col("payload.group").alias(group), "place", "leaf", "subroot", "root", "path", "places", *[F.col(f"payload.c_{k}").alias(k) for k in carry or {}])


def audit(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each document (integer doc_id, null first).

    Where 7 divides the CRC-32 of the decimal doc_id, the leaf of the document
    with one character more is folded instead; no doc_id or no n_chars: nothing
    is altered.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    values = {c: F.col(c) for c in COLUMNS} | {"n_chars": F.col("n_chars") + 1}
    made = manifest(docs, block=block, carry={"altered": F.when(hit, digest_of(list(values.values())))})
    folded = fold(F.coalesce("altered", "leaf"), F.col("path"), F.col("places"))
    some = made.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", "").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return some.withColumn("verified", F.col("folded_root") == F.col("root"))
