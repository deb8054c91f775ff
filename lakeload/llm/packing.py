"""Hierarchical packing of documents into sequences of several lengths."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.tokens import encoder, packed

TIERS = (1024, 512, 256, 128)
#: A sequence number is the partition's number times this, plus a count within the partition.
SEQUENCES_PER_PARTITION = 1 << 33


class Packer:
    """Packs the documents of one task, one bounded group after another.

    ``emit(sequence, length, step, pieces)`` gets each sequence; a piece is (document, start,
    length, offset).  Windows of a group that found no filler wait for the next one.
    """

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, emit: Callable):
        if any(t & (t - 1) for t in tiers) or sorted(tiers, reverse=True) != list(tiers):
            raise ValueError("tiers are powers of two, the longest first")
        self.tiers, self.step_tokens, self.emit = tiers, step_tokens, emit
        self.full: list[tuple[int, list]] = []  # (length, pieces) of closed windows
        self.tails: list[list] = [[] for _ in range(tiers[0] + 1)]  # by length
        self.sequences = self.steps = 0

    def add(self, doc: int, tokens: int) -> None:
        """Whole longest windows are closed at once; the tail waits in its tier."""
        long = self.tiers[0]
        for start in range(0, tokens - long + 1, long):
            self.full.append((long, [(doc, start, long)]))
        if tokens % long:
            self.tails[tokens % long].append((doc, tokens - tokens % long))

    def _longest_up_to(self, size: int) -> int:
        return next((n for n in range(size, 0, -1) if self.tails[n]), 0)

    def pack(self) -> None:
        """Packs each tier, longest first; gaps take whole tails of shorter tiers, then a cut one."""
        for tier, shorter in zip(self.tiers, [*self.tiers[1:], 0]):
            for size in range(tier, shorter, -1):
                while self.tails[size]:
                    doc, start = self.tails[size].pop()
                    pieces, gap = [(doc, start, size)], tier - size
                    while gap and (n := self._longest_up_to(gap)):
                        pieces.append((*self.tails[n].pop(), n))
                        gap -= n
                    if gap and (n := self._longest_up_to(tier)):
                        # Nothing fits whole: the head of a longer tail does.
                        doc, start = self.tails[n].pop()
                        pieces.append((doc, start, gap))
                        self.tails[n - gap].append((doc, start + gap))
                        gap = 0
                    if gap:
                        # Only here every tail is used up.
                        for doc, start, length in pieces:
                            self.tails[length].append((doc, start))
                        return
                    self.full.append((tier, pieces))

    def finish(self) -> None:
        """What is left is cut into windows of powers of two, so nothing is padded."""
        rest = [(*piece, n) for n, found in enumerate(self.tails) for piece in found]
        left, at, used = sum(r[2] for r in rest), 0, 0
        while left:
            window = min(self.tiers[0], 1 << (left.bit_length() - 1))
            pieces, gap = [], window
            while gap:
                doc, start, length = rest[at]
                take = min(gap, length - used)
                pieces.append((doc, start + used, take))
                used, gap = used + take, gap - take
                if used == length:
                    at, used = at + 1, 0
            self.full.append((window, pieces))
            left -= window
        self.tails = [[] for _ in self.tails]
        self.balance(last=True)

    def balance(self, last: bool = False) -> None:
        """Deals the closed windows to steps: the longest first, each to the step with the least
        attention work that still has room, so steps hold alike mixes of lengths.  Where none has
        room another step is opened."""
        total = sum(n for n, _ in self.full)
        steps = max(1, -(-total // self.step_tokens)) if total else 0
        heap = [(0, 0, k) for k in range(steps)]
        dealt: list[list] = [[] for _ in range(steps)]
        for length, pieces in sorted(self.full, key=lambda w: -w[0]):
            full = []
            while heap and heap[0][1] + length > self.step_tokens:
                full.append(heapq.heappop(heap))
            if heap:
                work, tokens, k = heapq.heappop(heap)
            else:
                work, tokens, k = 0, 0, len(dealt)
                dealt.append([])
            dealt[k].append((length, pieces))
            # A step without room for this window may have some for a shorter one.
            for step in [*full, (work + length * length, tokens + length, k)]:
                if step[1] < self.step_tokens:
                    heapq.heappush(heap, step)
        for k, windows in enumerate(dealt):
            for length, pieces in windows:
                offset, placed = 0, []
                for doc, start, n in pieces:
                    placed.append((doc, start, n, offset))
                    offset += n
                self.emit(self.sequences, length, self.steps + k, placed)
                self.sequences += 1
        self.steps += len(dealt)
        self.full = []


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    tiers: tuple[int, ...] = TIERS,
    group_tokens: int = 1 << 20,
    step_tokens: int = 1 << 14,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``tier`` (the sequence's length) and ``step_group``.

    A document is its ids and ``end_id``.  Whole windows of the longest tier are cut off; the tail
    goes to the smallest tier that holds it.  Each tier is packed, the gaps of longer windows are
    filled from shorter tiers, the last gap by the head of a longer tail.  Every sequence is filled
    to a power of two: no padding at all.  Tasks pack what they read, in groups of about
    ``group_tokens``, so nothing is shuffled and memory is bounded by a group and the longest
    document; the shorter sequences left over are at most a few per task.

    Null and empty texts are documents of one token.  Repeated rows are packed each, null ids are
    carried, an empty table gives no rows, other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = packed([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # number in this task -> (id, ids, tokens not yet placed)
        rows: list[tuple] = []
        base = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        id_type: list[pa.DataType] = []

        def emit(sequence, length, step, pieces):
            for doc, start, n, offset in pieces:
                name, ids, left = held[doc]
                rows.append((name, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4, base + sequence, offset, length, base + step))
                if left == n:
                    del held[doc]
                else:
                    held[doc] = (name, ids, left - n)

        def out():
            size = 20_000
            for at in range(0, len(rows), size):
                columns = list(zip(*rows[at : at + size], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [id_type[0], *_PIECE_TYPES], strict=True)], names=[id_col, *_PIECE_NAMES]
                )
            rows.clear()

        packer = Packer(tiers, step_tokens, emit)
        number = waiting = 0
        for batch in batches:
            id_type[:] = [batch.schema.field(0).type]
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and size < 4 * group_tokens:
                    size += len(texts[upto])
                    upto += 1
                for name, ids in zip(names[at:upto], encoder(path).encode(texts[at:upto])):
                    ids += end
                    held[number] = (name, ids, len(ids) // 4)
                    packer.add(number, len(ids) // 4)
                    waiting += len(ids) // 4
                    number += 1
                at = upto
                if waiting >= group_tokens:
                    packer.pack()
                    packer.balance()
                    yield from out()
                    waiting = 0
        packer.pack()
        packer.finish()
        if rows:
            yield from out()

    return source.mapInArrow(
        run, f"{id_col} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
    )


_PIECE_NAMES = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
_PIECE_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
