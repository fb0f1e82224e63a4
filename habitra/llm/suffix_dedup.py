"""Operator 7: removal of repeated byte strings by refined suffix buckets.

Suffixes that share their first bytes share a bucket.  Buckets of 8 bytes are
refined by the bucket identifiers of later offsets: a suffix's identifier at 16
bytes comes from those at 8 bytes of itself and of the suffix 8 bytes on, then
32 from 16 and ``LENGTH`` from 32, each level reusing the one before.
Identifiers are hashes, so that all machines name a bucket alike without one
global sort, and only suffixes whose bucket is still shared are refined on:

1. Of each ``LENGTH``-byte string the 16-byte bucket with the least identifier is its
   anchor.  Equal strings have equal anchors, and a run of strings has one
   anchor, about every 17 bytes.  A posting is an anchor with the identifier of
   its context (all strings that have this anchor), sorted in buckets.  Equal
   contexts are settled here: every document but the least one loses them.
2. Contexts that differ from another document's but share the anchor and 17
   bytes on a side are refined to their single strings, sorted again in buckets
   of their own identifiers; a block sends one for each distinct string.

An anchor with more postings than a bucket should hold is hot: its postings are
dealt by context instead, and all its contexts are refined.  Hot anchors are
found in every ``HOT_STRIDE``-th block or fewer; which ones are found changes the
plan, never the result.

Blocks of whole documents go to the shared folder; a block sends one posting
for each distinct context, so hot passages are aggregated before the shuffle,
and gets back two bits for each posting.  No task holds more than a block or
one bucket of postings; a context or a string has at most one posting for each
block.  Matches never cross documents.

Cases: a null or empty text has no strings and stays (null stays null in
``text``); texts shorter than ``LENGTH`` lose nothing; a null doc_id counts as greater
than any other; rows with equal doc_ids take nothing from each other; repeated
strings within one document stay; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habitra.llm.common import input_bytes, materialise, release, small_batches

LENGTH = 50
Q = 16
SIDE = (LENGTH - Q) // 2  # a string holds at least so many bytes on one side of its anchor
#: Least bytes of text in a block (a longer document makes its own) and behind a bucket of postings, up to ``GROWTH`` times as many
#: with the square root of the input beyond ``SMALL_INPUT``: there are blocks times buckets pieces.  And bytes of a slice of the scan.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 12 << 20
SMALL_INPUT = 1 << 30
GROWTH = 4
SLICE_BYTES = 1 << 19
#: Hot anchors are looked for in one of so many blocks, and in about ``HOT_BLOCKS`` at most.
HOT_STRIDE, HOT_BLOCKS = 32, 1024
NO_ID = (1 << 63) - 1
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of the bucket whose halves have the identifiers a and b."""
    x = a * _A
    x += b
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def refine(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the 16-byte and the ``LENGTH``-byte buckets of all suffixes that are long enough."""
    h = data.astype(np.uint64)
    for k in (1, 2, 4):  # buckets of 2, 4, 8 bytes: the bytes themselves
        h = h[:-k] | h[k:] << np.uint64(8 * k)
    h16 = mix(h[:-8], h[8:])
    h16 *= _C
    h32 = mix(h16[:-16], h16[16:])
    return h16, mix(h32[: len(h32) - (LENGTH - 32)], h32[LENGTH - 32 :])


def least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value (by its upper half) among ``width`` ones from each place on."""
    value = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        value = np.minimum(value[:-step], value[step:])
        span += step
    return (value & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Scan:
    """Anchors and postings of a block: the same texts give the same arrays in the same order."""

    def __init__(self, texts: list[bytes], doc_ids: list[int], buckets: int, hot: np.ndarray = np.zeros(0, np.uint64)):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.ids = np.array(doc_ids, np.int64)
        self.h = np.zeros(len(self.data), np.uint64)
        starts = np.concatenate([[0], self.ends[:-1]]) if len(texts) else np.zeros(0, np.int64)
        found: list[list[np.ndarray]] = [[] for _ in range(7)]
        i = 0
        while i < len(texts):  # slices end with documents, or cut a long one with an overlap
            j = i + 1
            while j < len(texts) and self.ends[j] - starts[i] <= SLICE_BYTES:
                j += 1
            lo, hi = int(starts[i]), int(self.ends[j - 1])
            at = lo
            while at < hi and hi - at >= LENGTH:
                # a string's anchor and its sides lie within the string; so a cut needs this overlap only
                to = min(hi, at + 2 * SLICE_BYTES)
                for parts, x in zip(found, self._anchors(at, to, lo, hi, i, j)):
                    parts.append(x)
                if to == hi:
                    break
                at = to - LENGTH + 1
            i = j
        self.left, self.right, self.doc, key, context, before, after = (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(found, (np.int64, np.int64, np.int64, np.uint64, np.uint32, np.uint16, np.uint16)))
        doc_id = self.ids[self.doc]
        whole = whole_context(context, before, after)
        anchor = key
        if len(hot):  # their contexts take the place of the anchor, and an even side says so
            is_hot = np.isin(key, hot)
            key = np.where(is_hot, mix(key, whole) >> np.uint64(16), key)
            before = np.where(is_hot, np.maximum(before & np.uint16(0xFFFE), np.uint16(2)), before)
            whole = whole_context(context, before, after)
        # anchors come in the documents' order, which a stable sort keeps
        order = np.lexsort((whole, key) if (np.diff(self.ids) >= 0).all() else (doc_id, whole, key))
        k, w = key[order], whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
        first = np.flatnonzero(new)
        self.key, self.anchor, self.context, self.before, self.after = (x[order[first]] for x in (key, anchor, context, before, after))
        self.bucket = bucket_of(self.key, buckets)
        self.least_id = doc_id[order][first]
        self.of_least = order[first]  # an anchor with the least document
        self.posting = np.zeros(len(order), np.int64)  # of each anchor
        self.posting[order] = np.cumsum(new) - 1

    def _anchors(self, at: int, to: int, lo: int, hi: int, i: int, j: int) -> tuple[np.ndarray, ...]:
        data = self.data[max(lo, at - LENGTH) : min(hi, to + LENGTH)]
        off = max(lo, at - LENGTH)
        h16, h = refine(data)
        self.h[off : off + len(h)] = h
        place = least(h16, LENGTH - Q + 1)[: len(h)]
        # strings that start in each document of the slice and end in it
        ends = np.minimum(self.ends[i:j], to)
        starts = np.maximum(np.concatenate([[lo], self.ends[i : j - 1]]), at)
        n = np.maximum(ends - starts - LENGTH + 1, 0)
        doc = np.repeat(np.arange(i, j), n)
        p = np.arange(int(n.sum())) + np.repeat(starts - np.cumsum(n) + n, n)
        anchor = place[p - off]
        new = np.ones(len(p), bool)
        if len(p):
            new[1:] = (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)
        k = np.flatnonzero(new)
        left, right = p[k], p[np.append(k[1:], len(p)) - 1] if len(k) else p[:0]
        doc, a = doc[k], anchor[k]
        starts = np.concatenate([[0], self.ends])[doc]
        key = mix(h16[a], h16[a]) >> np.uint64(16)
        context = (mix(h[left - off], h[right - off] + (right - left).astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        side = lambda x: (mix(h16[x], h16[x + 1]) & np.uint64(0xFFFF)).astype(np.uint16)
        has_before, has_after = a - SIDE + off >= starts, a + Q + SIDE + off <= self.ends[doc]
        before, after = np.zeros(len(a), np.uint16), np.zeros(len(a), np.uint16)
        before[has_before] = side(a[has_before] - SIDE) | np.uint16(1)
        after[has_after] = side(a[has_after] + Q) | np.uint16(1)
        return left, right, doc, key, context, before, after

    def windows(self, contested: np.ndarray, buckets: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Single strings of the contested postings.

        Of each distinct one: bucket, identifier, anchor and least document, in
        order; and of all: number of the distinct one, if the document is a
        later one than its least, posting and start.
        """
        anchors = self.of_least[contested]
        n = self.right[anchors] - self.left[anchors] + 1
        row = np.repeat(np.arange(len(anchors)), n)
        start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + self.left[anchors][row]
        string, key, doc_id = self.h[start], self.anchor[contested][row], self.least_id[contested][row]
        order = np.lexsort((doc_id, key, string))
        string, key, doc_id = string[order], key[order], doc_id[order]
        new = np.ones(len(order), bool)
        new[1:] = (string[1:] != string[:-1]) | (key[1:] != key[:-1])
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        distinct = (bucket_of(string[first] >> np.uint64(16), buckets), string[first], key[first], doc_id[first])
        return distinct, (group, doc_id > doc_id[first][group], contested[row][order], start[order])


def whole_context(context: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return context.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64) << np.uint64(16) | after


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of 48-bit identifiers, in their order."""
    return (key >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as byte planes, compressed; the first is in ascending order and stored as differences."""
    parts = []
    for k, x in enumerate(arrays):
        x = np.diff(x, prepend=x[:1] * 0) if k == 0 else x
        parts.append(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())
    return struct.pack("<Q", len(arrays[0])) + zstandard.compress(b"".join(parts), 1)


def unpack(data: bytes, *types: type) -> list[np.ndarray]:
    n = struct.unpack_from("<Q", data)[0]
    raw = zstandard.decompress(data[8:], max_output_size=max(1, n * sum(np.dtype(t).itemsize for t in types)))
    out, at = [], 0
    for k, t in enumerate(types):
        size = np.dtype(t).itemsize
        x = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(t).ravel()
        out.append(np.cumsum(x, dtype=t) if k == 0 else x)
        at += n * size
    return out


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + 1)) if len(bucket) else []
    for s, e in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[s]), pack(*(x[s:e] for x in arrays))


def settle(key: np.ndarray, context: np.ndarray, before: np.ndarray, after: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all postings of a bucket: which are repeats of a lesser document's context, and which must be refined to strings."""
    whole = whole_context(context, before, after)
    order = np.lexsort((doc, whole, key))
    cols = [x[order] for x in (key, whole, before, after)]
    d = doc[order]
    new = np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    owner = d[first]  # of each distinct context the least document
    repeat = np.zeros(len(order), bool)
    repeat[order] = d > owner[np.cumsum(new) - 1] if len(order) else False
    open_ = (cols[2][first] != 0) & (cols[2][first] & np.uint16(1) == 0)  # contexts of hot anchors
    for side in (cols[2][first], cols[3][first]):  # contexts with the same anchor and side but another owner
        pair = np.lexsort((owner, side, cols[0][first]))
        k, s, o = cols[0][first][pair], side[pair], owner[pair]
        group = np.cumsum(np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]))) - 1 if len(pair) else np.zeros(0, int)
        lo, hi = np.full(len(pair), NO_ID), np.full(len(pair), -NO_ID - 1)
        np.minimum.at(lo, group, o)
        np.maximum.at(hi, group, o)
        open_[pair] |= (lo[group] != hi[group]) & (s != 0)
    contested = np.zeros(len(order), bool)
    # several blocks may hold an owner's context if doc_ids repeat or are null; each refines its own
    contested[order] = (open_[np.cumsum(new) - 1] & (d == owner[np.cumsum(new) - 1])) if len(order) else False
    return repeat, contested


def grown(least: int, total: int) -> int:
    """The size of a block or bucket for so many bytes of input."""
    return int(least * min(GROWTH, max(1.0, (total / SMALL_INPUT) ** 0.5)))


def _blocks(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Whole rows in blocks as Arrow streams, in the shared folder: ``block``, ``bytes`` (of text), ``data``."""
    small_batches(df.sparkSession)
    # the planner's estimate, from the sizes of the files: any block size gives the same result
    block_bytes = grown(BLOCK_BYTES, input_bytes(df))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def row() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            return pa.RecordBatch.from_pydict({"block": pa.array([task << 32 | k], pa.int64()), "bytes": pa.array([size], pa.int64()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(lengths[at:]), max(block_bytes - size, 1), side="left")) + 1
                to = min(batch.num_rows, at + fits)
                held.append(batch.slice(at, to - at))
                size += int(lengths[at:to].sum())
                at = to
                if size >= block_bytes:
                    yield row()
                    held, size, k = [], 0, k + 1
        if held:
            yield row()

    import pyarrow.compute  # noqa: F401

    return materialise(df.withColumns({id_col: F.col(id_col).cast("long"), text_col: F.col(text_col).cast("string")}).mapInArrow(run, "block long, bytes long, data binary"), "blocks", "none")


class _Names:
    """What the map functions of one run need to know."""

    def __init__(self, id_col: str, text_col: str, buckets: int):
        self.id_col, self.text_col, self.buckets, self.hot = id_col, text_col, buckets, np.zeros(0, np.uint64)

    def load(self, data: bytes) -> tuple[pa.RecordBatch, list[bytes], Scan]:
        with pa.ipc.open_stream(data) as r:
            table = r.read_all().combine_chunks()
        batch = table.to_batches()[0]
        texts = [x or b"" for x in batch.column(self.text_col).cast(pa.binary()).to_pylist()]
        ids = [NO_ID if x is None else x for x in batch.column(self.id_col).to_pylist()]
        return batch, texts, Scan(texts, ids, self.buckets, self.hot)


def _verdict(parts: list[dict] | None, counts: np.ndarray, column: str) -> np.ndarray:
    """Bits of a block from those of its buckets, in the buckets' order."""
    bits = {p["bucket"]: p[column] for p in parts or []}
    out = [np.unpackbits(np.frombuffer(bits[b], np.uint8), count=n).astype(bool) for b, n in zip(*counts)] if len(counts[0]) else []
    return np.concatenate(out) if out else np.zeros(0, bool)


def _counts(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(bucket, return_counts=True)


def _answers(postings: DataFrame, types: tuple[type, ...], decide, columns: tuple[str, ...]) -> DataFrame:
    """Postings meet by bucket; each block gets one row: ``block``, ``parts`` with the bits of its postings."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack(x, *types) for x in pdf["data"]]
        ends = np.cumsum([len(x[0]) for x in lists])
        verdicts = decide(*(np.concatenate(c) for c in zip(*lists)))
        cut = [[np.packbits(v[e - len(x[0]) : e]).tobytes() for x, e in zip(lists, ends)] for v in verdicts]
        del lists, verdicts
        release()
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"]} | dict(zip(columns, cut)))

    told = postings.groupBy("bucket").applyInPandas(run, "block long, bucket long, " + ", ".join(f"{c} binary" for c in columns))
    return told.groupBy("block").agg(F.collect_list(F.struct("bucket", *columns)).alias("parts"))  # as many entries as buckets


def _strings_repeat(string: np.ndarray, key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray]:
    order = np.lexsort((doc, key, string))
    s, k, d = string[order], key[order], doc[order]
    new = np.append(True, (s[1:] != s[:-1]) | (k[1:] != k[:-1])) if len(order) else np.zeros(0, bool)
    out = np.zeros(len(order), bool)
    out[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else False
    return (out,)


def _hot_anchors(blocks: DataFrame, names: _Names, count: int, limit: int) -> np.ndarray:
    """Anchors that have more than ``limit`` postings, by those of some blocks; no more than all postings over ``limit``."""
    stride = max(HOT_STRIDE, -(-count // HOT_BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("data").to_pylist():
                key, n = np.unique(names.load(data)[2].key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(n)], ["key", "n"])
        release()

    looked = blocks.where(F.pmod(F.xxhash64("block"), F.lit(stride)) == 0).select("data").mapInArrow(run, "key long, n long")
    hot = looked.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") * stride > limit).collect()
    return np.array(sorted(r["key"] for r in hot), np.uint64)


Spans = list[list[int]]


def _searched(df: DataFrame, id_col: str, text_col: str, out: T.StructType, finish: Callable[[pa.RecordBatch, list[bytes], list[Spans]], list[pa.Array]]) -> DataFrame:
    """Rows of type ``out`` that ``finish`` makes of a block's rows, its texts' bytes and the spans to remove from each."""
    blocks = _blocks(df, id_col, text_col)
    count, total = blocks.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    bucket_bytes = grown(BUCKET_BYTES, total)
    names = _Names(id_col, text_col, max(1, -(-total // bucket_bytes)))
    names.hot = _hot_anchors(blocks, names, count, bucket_bytes // SIDE)  # a posting stands for about SIDE bytes

    def rows_of(bucketed) -> pa.RecordBatch | None:
        rows = list(bucketed[1])
        if not rows:
            return None
        return pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in rows], pa.int64()), "block": pa.array([bucketed[0]] * len(rows), pa.int64()), "data": pa.array([x for _, x in rows], pa.binary())})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for i in range(b.num_rows):
                yield b.slice(i, 1).to_pylist()[0]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each(batches):
            scan = names.load(r["data"])[2]
            out = rows_of((r["block"], by_bucket(scan.bucket, scan.key, scan.context, scan.before, scan.after, scan.least_id)))
            if out:
                yield out
        release()

    def contested(scan: Scan, parts: list[dict] | None) -> np.ndarray:
        return np.flatnonzero(_verdict(parts, _counts(scan.bucket), "contested"))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in each(batches):
            scan = names.load(r["data"])[2]
            distinct, _ = scan.windows(contested(scan, r["parts"]), names.buckets)
            out = rows_of((r["block"], by_bucket(*distinct)))
            if out:
                yield out
        release()

    shape = "bucket long, block long, data binary"
    told = materialise(_answers(blocks.select("block", "data").mapInArrow(first, shape), (np.uint64, np.uint32, np.uint16, np.uint16, np.int64), settle, ("repeat", "contested")), "verdicts")
    refined = blocks.select("block", "data").join(told, "block").mapInArrow(second, shape)
    strings = _answers(refined, (np.uint64, np.uint64, np.int64), _strings_repeat, ("repeat",)).withColumnRenamed("parts", "strings")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out, prefers_large_types=False)
        for r in each(batches):
            batch, texts, scan = names.load(r["data"])
            gone = np.zeros(len(scan.data) + 1, np.int32)
            if len(scan.left):
                repeat = _verdict(r["parts"], _counts(scan.bucket), "repeat")
                whole = repeat[scan.posting] | (scan.ids[scan.doc] > scan.least_id[scan.posting])
                np.add.at(gone, scan.left[whole], 1)
                np.add.at(gone, scan.right[whole] + LENGTH, -1)
                distinct, (group, later, posting, start) = scan.windows(contested(scan, r["parts"]), names.buckets)
                single = np.flatnonzero(_verdict(r["strings"], _counts(distinct[0]), "repeat")[group] | later)
                if len(single):  # all anchors of a contested posting's least document have the same strings
                    offset = start[single] - scan.left[scan.of_least[posting[single]]]
                    order = np.argsort(scan.posting, kind="stable")
                    begin = np.searchsorted(scan.posting[order], posting[single], side="left")
                    n = np.searchsorted(scan.posting[order], posting[single], side="right") - begin
                    row = np.repeat(np.arange(len(single)), n)
                    anchor = order[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[row]]
                    mine = ~whole[anchor]
                    at = scan.left[anchor[mine]] + offset[row[mine]]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + LENGTH, -1)
            covered = np.cumsum(gone[:-1]) > 0
            spans, begin = [], 0
            for end in scan.ends.tolist():
                spans.append(np.flatnonzero(np.diff(covered[begin:end], prepend=False, append=False)).reshape(-1, 2).tolist())
                begin = end
            del scan, gone, covered
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(finish(batch, texts, spans), arrow)], schema=arrow)
        release()

    joined = blocks.select("block", "data").join(told, "block", "left").join(strings, "block", "left")
    return joined.mapInArrow(last, out)


def _typed(df: DataFrame, id_col: str, text_col: str) -> T.StructType:
    return df.withColumns({id_col: F.col(id_col).cast("long"), text_col: F.col(text_col).cast("string")}).schema


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "removed_spans", kept_col: str = "kept_bytes") -> DataFrame:
    """The rows of ``df``, all columns, with the removed spans (of the UTF-8 bytes, start and end) and the bytes kept.

    Removed is every byte covered by a ``LENGTH``-byte string that also starts in a
    document with a lesser id, judged on the input.  A column of ``df`` that is
    named like one of the two new ones gives way to it.
    """
    given = df.drop(spans_col, kept_col)
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([*_typed(given, id_col, text_col), T.StructField(spans_col, spans_type), T.StructField(kept_col, T.BinaryType())])

    def finish(batch: pa.RecordBatch, texts: list[bytes], spans: list[Spans]) -> list[pa.Array]:
        named = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return [*batch.columns, named, pa.array([without(t, x) for t, x in zip(texts, spans)], pa.binary())]

    return _searched(given, id_col, text_col, out, finish)


def without(text: bytes, spans: Spans) -> bytes:
    """The bytes outside the spans."""
    cuts = [0, *[x for s in spans for x in s], len(text)]
    return b"".join(text[s:e] for s, e in zip(cuts[::2], cuts[1::2]))


def whole_characters(text: bytes, spans: Spans) -> Spans:
    """The spans without code points that they hold in part only."""
    inner = lambda i: i < len(text) and text[i] & 0xC0 == 0x80
    out = []
    for s, e in spans:
        while inner(s):
            s += 1
        while e > s and inner(e):
            e -= 1
        if s < e:
            out.append([s, e])
    return out


def strip_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``df``, its columns only, with repeats cut from the text; characters that a repeat holds in part stay, and ``n_chars`` follows the text."""
    out = _typed(df, id_col, text_col)
    k = df.columns.index(text_col)

    def finish(batch: pa.RecordBatch, texts: list[bytes], spans: list[Spans]) -> list[pa.Array]:
        null = batch.column(k).is_null().to_pylist()
        cut = [None if n else without(t, whole_characters(t, x)) if x else t for t, x, n in zip(texts, spans, null)]
        return [pa.array(cut, pa.binary()).cast(pa.string()) if i == k else c for i, c in enumerate(batch.columns)]

    found = _searched(df, id_col, text_col, out, finish)
    return found if n_chars_col not in df.columns else found.withColumn(n_chars_col, F.length(text_col).cast(out[n_chars_col].dataType))
