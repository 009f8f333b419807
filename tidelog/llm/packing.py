"""Best-fit packing of token sequences: bounded-space online best fit.

A document is its token ids and one end id.  One of more than ``length`` ids is
cut into pieces of ``length`` from its end, so that its first piece may be
shorter; full pieces are sequences of their own.  The other pieces stream
through a packer that keeps a fixed number of open bins.  The bins stand in a
bitset keyed by free space: the fullest bin that still takes a piece is the
lowest set bit at or above the piece's size, found by two machine-word tricks
on one integer.  If no open bin takes it a bin opens, and where that would be
one too many, the fullest closes first.

Pieces come in the order of the rows, ``ahead`` of them at a time (rounded up
to whole slices of rows), the largest of those first: a look-ahead of fixed
size, which an ``ahead`` of 1 turns off.  Each task packs what it reads, so
no text is shuffled.  What is open at a task's end is packed once more: the open
bins of TASKS tasks at a time, each bin as one piece, by the same packer; what
then is open closes.  Sequences are numbered by task, and a bin that moves into
another takes its number and stands behind what that has.  The pieces are
written once, so a task that is run again changes no number.

Nulls: a null text is empty and packs as its end id alone; a null doc_id stays
null.  Repeated rows are packed row by row.  An empty table gives an empty
result.  Columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.llm.common import cut, in_slices, texts_of
from tidelog.llm.tokens import default_vocabulary, encoder

LENGTH = 2048
END_ID = 0
#: Pieces looked at together, and bins open at a time: fewer than those pieces fill, so that bins close on the way.
AHEAD, OPEN_BINS = 1024, 256
#: How many tasks' open bins are packed together: at most TASKS * OPEN_BINS bins.
TASKS = 64
SCHEMA = "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Packer:
    """Online best fit over at most ``most`` open bins of ``length``."""

    def __init__(self, length: int, most: int, first_id: int) -> None:
        self.length, self.most, self.next_id = length, most, first_id
        self.bits, self.open = 0, 0
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]  # ids of the open bins by free space

    def new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _take(self, free: int) -> int:
        there = self.bins[free]
        got = there.pop()
        if not there:
            self.bits &= ~(1 << free)
        self.open -= 1
        return got

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of the next piece."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.length, self.new_id()
        left = free - size
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.length - free


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS, ahead: int = AHEAD) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    vocabulary = vocabulary or default_vocabulary()
    some = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(some.dtypes)["doc_id"]

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = encoder(vocabulary)
        row, piece, start, size, crc = [], [], [], [], []
        for i, text in enumerate(texts_of(batch, "text")):
            ids = np.append(code.ids(text), np.uint32(END_ID)).astype("<u4")
            cuts = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                row.append(i), piece.append(p), start.append(a), size.append(b - a)
                crc.append(zlib.crc32(ids[a:b].tobytes()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, size, crc)]],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    def placed(held: list[pa.RecordBatch], packer: Packer) -> Iterator[pa.RecordBatch]:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
            size = batch.column("length").to_numpy()
            number, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.argsort(-size, kind="stable").tolist() if ahead > 1 else range(len(size)):
                number[k], offset[k] = packer.place(int(size[k]))
            yield batch.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held = Packer(length, open_bins, TaskContext.get().partitionId() << 40), []
        for batch in in_slices(batches, "text"):
            held.append(pieces(batch))
            if sum(x.num_rows for x in held) >= ahead:
                yield from placed(held, packer)
                held = []
        if held:
            yield from placed(held, packer)
        # the bins that are still open, as rows without a piece: their number, and how full they are
        open_ = [(number, length - free) for free, there in enumerate(packer.bins) for number in there]
        if open_:
            null = {f.name: pa.nulls(len(open_), f.type) for f in schema}
            null |= {"sequence_id": pa.array([x[0] for x in open_], pa.int64()), "length": pa.array([x[1] for x in open_], pa.int64())}
            yield pa.RecordBatch.from_arrays([null[f.name] for f in schema], schema=schema)

    schema = pa.schema([("doc_id", to_arrow_type(some.schema["doc_id"].dataType)), ("piece", pa.int32()), *[(n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")]])
    packed = cut(some.mapInArrow(over, f"doc_id {kind}, {SCHEMA}"))
    moved = _packed_again(packed.filter("piece IS NULL").select("sequence_id", "length"), length, open_bins)
    both = packed.filter("piece IS NOT NULL").join(moved, "sequence_id", "left")
    named = F.coalesce("into", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")
    return both.select("doc_id", "piece", "start", "length", "ids_crc32", *named)


def _packed_again(bins: DataFrame, length: int, open_bins: int) -> DataFrame:
    """sequence_id, into and shift of open bins (sequence_id, length): the number each has from now on, and what stands before it there.

    The fullest come first, so bins that nothing fits into do not wait in the packer.
    """

    def over(table: pa.Table) -> pa.Table:
        numbers, sizes = table.column("sequence_id").to_numpy(), table.column("length").to_numpy()
        packer, into, shift = Packer(length, open_bins, 0), np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        first: dict[int, int] = {}
        for k in np.lexsort((numbers, -sizes)).tolist():
            number, shift[k] = packer.place(int(sizes[k]))
            into[k] = first.setdefault(number, int(numbers[k]))
        return pa.table({"sequence_id": numbers, "into": into, "shift": shift})

    group = F.shiftright("sequence_id", 40 + TASKS.bit_length() - 1)
    return bins.groupBy(group.alias("tasks")).applyInArrow(over, "sequence_id bigint, into bigint, shift bigint")
