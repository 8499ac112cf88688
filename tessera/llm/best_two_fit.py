"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A bin is filled greedily with the longest documents that fit; then its smallest document is
replaced by the two unpacked documents that fill its expanded gap most tightly, if any two
fill it better.  Lengths are whole numbers up to the capacity, so a plan over their counts
packs all documents: the bin that the rule makes next stays the same until one of its
lengths runs short, and is then repeated that many times at once.  The plan's size is
bounded by the capacity, never by the number of documents.

Documents meet their places by rank: each is the r-th of its length, and the plan gives
the ranks of a length to sequences in runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import byte_level
from .common import buffers, small_batches, steps, written

CAPACITY = 1024
END_ID = 2
#: (task, length) pairs up to which their first ranks are broadcast (about 24 bytes each); a shuffle join beyond.
BROADCAST_STARTS = 500_000

PIECES = "task long, rank long, doc_id long, piece int, start long, length long, ids binary"


@dataclass(frozen=True)
class Run:
    """``times`` bins of one pattern: ids ``first``, ``first`` + 1, ...  ``pattern``: (length, how many of it in a bin, offset of the first one)."""

    first: int
    times: int
    pattern: tuple[tuple[int, int, int], ...]


def _fill(counts: list[int], there: int, capacity: int) -> tuple[list[int], list[int]]:
    """The next bin's lengths, longest first, and every length it had on the way.  ``there``: a bit for each length that is left."""
    bin_, gap = [], capacity
    taken: dict[int, int] = {}

    def take(length: int) -> None:
        nonlocal there
        taken[length] = taken.get(length, 0) + 1
        if taken[length] == counts[length]:
            there &= ~(1 << length)

    while (found := (there & ((1 << (gap + 1)) - 1)).bit_length() - 1) > 0:
        bin_.append(found)
        take(found)
        gap -= found
    used = list(bin_)
    if gap and len(bin_):
        smallest = bin_[-1]
        room = gap + smallest
        best, pair = smallest, None
        mask = there & ((1 << room) - 1)
        while mask:
            a = mask.bit_length() - 1
            if 2 * a <= best:
                break
            mask &= ~(1 << a)
            rest = there if counts[a] - taken.get(a, 0) > 1 else there & ~(1 << a)
            b = (rest & ((1 << (min(a, room - a) + 1)) - 1)).bit_length() - 1
            if b > 0 and a + b > best:
                best, pair = a + b, (a, b)
                if best == room:
                    break
        if pair:
            bin_[-1:] = pair
            used += pair
    return bin_, used


def plan(counts: list[int], capacity: int = CAPACITY) -> list[Run]:
    """Bins for ``counts[l]`` documents of each length l (0 < l <= capacity)."""
    counts = list(counts)
    there = sum(1 << length for length, n in enumerate(counts) if n and length)
    runs, first = [], 0
    while there:
        lengths, used = _fill(counts, there, capacity)
        needed: dict[int, int] = {}
        for length in used:
            needed[length] = needed.get(length, 0) + 1
        # The bin comes out the same as long as every length it looked at is still there.
        times = max(1, min(counts[length] // n for length, n in needed.items()))
        pattern, offset = [], 0
        for length in sorted(set(lengths), reverse=True):
            many = lengths.count(length)
            pattern.append((length, many, offset))
            offset += length * many
            counts[length] -= many * times
            if not counts[length]:
                there &= ~(1 << length)
        runs.append(Run(first, times, tuple(pattern)))
        first += times
    return runs


class Places:
    """Where the r-th document of a length goes."""

    def __init__(self, runs: list[Run], capacity: int):
        rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 1)]
        given = [0] * (capacity + 1)
        for run in runs:
            for length, many, offset in run.pattern:
                rows[length].append((given[length], run.first, many, offset))
                given[length] += many * run.times
        self.tables = [np.array(r, np.int64).reshape(-1, 4) for r in rows]

    def __call__(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each."""
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            at, length = order[a:b], int(lengths[order[a]])
            table = self.tables[length]
            first, base, many, start = table[np.searchsorted(table[:, 0], ranks[at], "right") - 1].T
            sequence[at] = base + (ranks[at] - first) // many
            offset[at] = start + (ranks[at] - first) % many * length
        return sequence, offset


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole but for the first, which has what is over."""
    if total <= capacity:
        return [(0, total)]
    head = total % capacity
    return ([(0, head)] if head else []) + [(i, capacity) for i in range(head, total, capacity)]


def tokenised(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every text as in :data:`PIECES`: ``task`` made it, and it was its ``rank``-th of that length there."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("task", pa.int64()), ("rank", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = byte_level(tokenizer_file), TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = np.array([end_id], np.uint32).tobytes()
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for i, j in steps(offsets):
                ids, at = encode(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                data, rows = ids.tobytes(), []
                for doc_id, a, b in zip(doc_ids[i:j], at[:-1].tolist(), at[1:].tolist()):
                    own = data[4 * a:4 * b] + end
                    for k, (start, length) in enumerate(cut(b - a + 1, capacity)):
                        rows.append((task, seen[length], doc_id, k, start, length, own[4 * start:4 * (start + length)]))
                        seen[length] += 1
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack every row of ``docs``: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    A document longer than ``capacity`` ids is cut into pieces of ``capacity``, the first one
    shorter; others stay whole.  A null or empty text is the end id alone; a null document id
    stays null; equal rows are packed one by one; ties among equally long documents go by the
    order in which tasks met them; an empty table gives no rows.  Other columns play no part.

    Texts are tokenised once, into a table of the shared folder.  The driver sees the count of
    each length.  Memory of a task: the ids of one step of text and the store of chunks.
    """
    pieces = written(tokenised(docs, tokenizer_file, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id), "pack-pieces")
    by_task = written(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "pack-lengths")
    counts = [0] * (capacity + 1)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length
        counts[r["length"]] = r["n"]
    places = Places(plan(counts, capacity), capacity)
    # A length's ranks: the tasks before, then within the task.  A window holds a row for each task.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    starts = F.broadcast(starts) if by_task.count() <= BROADCAST_STARTS else starts

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = pieces.join(starts, ["task", "length"]).withColumn("at", place(F.col("length"), F.col("rank") + F.col("first")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")
