"""Operator 8: best-fit packing planned over a histogram of lengths.

Texts are encoded, end with ``end_id`` and are cut in pieces of at most
``capacity`` ids.  Best fit then runs on the driver over counts of lengths, not
over pieces: at most ``capacity`` lengths, whatever the corpus.  It yields slots
for runs of ranks within a length, and pieces take them by joining on the rank
among the pieces of their length.  A rank is a piece's place within its task
and length, counted as it is written, plus the counts of the tasks before, so
no length's pieces meet in one task.

Cases: a null or empty text is a piece that holds only the end id; a null
doc_id stays null; repeated rows are packed each; a text of any length is cut,
never dropped; an empty table gives an empty result.  Other columns of the
input are left out.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habitra.llm.common import map_batches, materialise, strings, text_of
from habitra.llm.tokenizing import ChunkEncoder, encoder


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths.

    Gives runs ``(length, first rank, pieces, first sequence, offset)``: the
    pieces of that length with these ranks go, one each, to as many sequences
    that follow each other, all at the same offset.
    """
    room: dict[int, list[list[int]]] = {}  # free ids -> runs [first sequence, sequences]
    rooms: list[int] = []  # the keys of room in order
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def free(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append([first, n])

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                left = rooms[k]
                run = room[left][-1]
                n = min(todo, run[1])
                first = run[0]
                run[0] += n
                run[1] -= n
                if not run[1]:
                    room[left].pop()
                    if not room[left]:
                        del room[left], rooms[k]
            else:  # as many new sequences as these pieces fill; the last may stay open
                left = capacity
                n = max(1, todo // (capacity // length))
                first, sequences = sequences, sequences + n
            runs.append((length, rank, n, first, capacity - left))
            free(left - length, first, n)
            rank += n
            todo -= n
    return runs


def pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, in the shared folder: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (binary, unsigned 32-bit), ``ids_crc32``, ``task`` and ``place`` within the task and length."""

    def make():
        from pyspark import TaskContext

        enc = encoder(ChunkEncoder, tokenizer)
        end, task, seen = struct.pack("<I", end_id), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)

        def cut(b: pa.RecordBatch) -> dict:
            out: dict[str, list] = {x: [] for x in ("doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "place")}
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode_texts(strings(b, "text"))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    for name, value in zip(out, (doc, k, at // 4, n, part, zlib.crc32(part), task, int(seen[n]))):
                        out[name].append(value)
                    seen[n] += 1
            return out

        return cut

    return materialise(map_batches(text_of(df, id_col, text_col), make, "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, task int, place long"), "pieces")


def assign(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """The slot of every piece: all of ``pieces`` but ``ids``, ``task`` and ``place``, plus ``sequence_id`` and ``offset``.

    Only these short rows are shuffled, never ids.  The plan goes to the
    executors: a row for each run, of which each length makes one for every
    room it fills, so capacity * capacity / 2 at the very most and in practice
    a few for each length.
    """
    spark = cut.sparkSession
    by_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs: dict[int, tuple[np.ndarray, ...]] = {}
    for length, rank, _, first, offset in plan(counts, capacity):
        runs.setdefault(length, ([], [], []))  # type: ignore[arg-type]
        for values, x in zip(runs[length], (rank, first, offset)):
            values.append(x)  # type: ignore[attr-defined]
    runs = {k: tuple(np.array(x, np.int64) for x in v) for k, v in runs.items()}
    sent = spark.sparkContext.broadcast(runs)

    def make():
        plan_of = sent.value

        def slots(b: pa.RecordBatch) -> dict:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                ranks, firsts, offsets = plan_of[int(n)]
                k = np.searchsorted(ranks, rank[at], side="right") - 1
                sequence[at] = firsts[k] + rank[at] - ranks[k]
                offset[at] = offsets[k]
            return {x: b.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")} | {"sequence_id": sequence, "offset": offset}

        return slots

    ranked = cut.join(before, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank"))
    return map_batches(ranked, make, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", rows=20_000)


def sequences(cut: DataFrame, slots: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (binary), from ``pieces`` and ``assign``; a sequence holds at most ``capacity`` ids.

    Rows that repeat a doc_id and its text hold equal ids, so either may stand for the other.
    """
    ids = cut.groupBy("doc_id", "piece", "ids_crc32", "length").agg(F.first("ids").alias("ids"))
    same = [slots[c].eqNullSafe(ids[c]) for c in ("doc_id", "piece", "ids_crc32", "length")]
    joined = slots.join(ids, same).select("sequence_id", "offset", ids["ids"])
    return joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select("sequence_id", F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids"))


def pack(df: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces and slots of all documents; see ``pieces`` and ``assign``."""
    return assign(pieces(df, tokenizer, end_id, capacity, id_col, text_col), capacity)
