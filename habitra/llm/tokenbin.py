"""Operator 4: token-id shards with Elias-Fano document boundaries.

``write`` encodes every text, deals the ids out in ranges of ascending doc_id
and packs each range in blocks.  A block is one byte string:

    magic "EFTK", version, bytes of an id (2 or 4), low bits of the lists   header, little-endian
    shard, block, ids of the shard before it, documents n, ids u
    null doc ids z, the first doc id that isn't null
    Elias-Fano list of the n - z doc ids, as distances from the first
    Elias-Fano list of the n + 1 boundaries 0..u
    ids                                                                 u integers
    CRC-32 of all before

A list holds its sizes, the low bits, the high bits
in unary, and every 64th one-bit's place, so that a value is found by a short
select: about 2 + log2(u / n) bits for each instead of 64.

Each block is a file of its own, ``{shard}-{block}.eftk``, which ``Block.open``
reads without Spark.  A task writes under another name first and moves the whole
file, so one that is run again replaces its own files by equal ones.  ``read``
opens them through Spark and selects documents.

Cases: a null or empty text holds only the end id; null doc_ids sort first and
stay null; rows with the same doc_id follow each other in the order of their
ids; a text of any length goes whole in one block; an empty table gives no
blocks.  Other columns of the input are left out.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habitra.llm.common import map_batches, materialise, shared_dir, small_batches, strings, text_of
from habitra.llm.tokenizing import ChunkEncoder, encoder

MAGIC = b"EFTK"
VERSION = 2
#: magic, version, id bytes, low bits of doc ids and of boundaries, shard, block, ids of the shard before, documents, ids, null doc ids, first doc id
HEADER = struct.Struct("<4sBBBBIIQQQQq")
SAMPLE = 64  # a place is kept for every so many one-bits
#: Ids after which a block ends (at the next document).
BLOCK_IDS = 1 << 20


class EliasFano:
    """A non-descending list of integers from 0 to ``top`` in about 2 + log2(top / n) bits each, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, places: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.places = n, low_bits, low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(bits, bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def select(self, i: int) -> int:
        """The i-th value, from the kept places around it and the bits between them."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        k = i // SAMPLE
        first = int(self.places[k]) >> 3
        last = (int(self.places[k + 1]) >> 3) + 1 if k + 1 < len(self.places) else len(self.high)
        bits = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
        one = int(bits[np.searchsorted(bits, int(self.places[k])) + i % SAMPLE])
        low = 0
        for k in range(self.low_bits):
            p = i * self.low_bits + k
            low |= (int(self.low[p >> 3]) >> (p & 7) & 1) << k
        return (one - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits) if self.low_bits else np.zeros((self.n, 0), np.uint8)
        return ((ones - np.arange(self.n)) << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def dump(self) -> bytes:
        return struct.pack("<QQQ", len(self.low), len(self.high), len(self.places)) + self.low.tobytes() + self.high.tobytes() + self.places.astype("<u4").tobytes()

    @classmethod
    def load(cls, n: int, low_bits: int, data: memoryview) -> tuple[EliasFano, int]:
        """The list of n values at the beginning of the data, and the bytes it takes."""
        a, b, c = struct.unpack_from("<QQQ", data)
        at = 24
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        places = np.frombuffer(bytes(data[at + a + b : at + a + b + 4 * c]), "<u4")
        return cls(n, low_bits, low, high, places), at + a + b + 4 * c


class Block:
    """One packed block; ``ids(i)`` and ``doc_id(i)`` select a document's without reading the others."""

    def __init__(self, data: bytes):
        if len(data) < HEADER.size + 4 or data[:4] != MAGIC or data[4] != VERSION:
            raise ValueError("not a block of token ids")
        if zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("the block is damaged")
        _, _, self.width, low, low_bounds, self.shard, self.block, self.first, self.n, self.total, self.nulls, self.base = HEADER.unpack_from(data)
        view = memoryview(data)
        self.names, used = EliasFano.load(self.n - self.nulls, low, view[HEADER.size :])
        at = HEADER.size + used
        self.bounds, used = EliasFano.load(self.n + 1, low_bounds, view[at:])
        self.values = np.frombuffer(data, f"<u{self.width}", self.total, at + used)

    @classmethod
    def open(cls, path: str) -> Block:
        """A block's file, without Spark."""
        with open(path, "rb") as f:
            return cls(f.read())

    def doc_id(self, i: int) -> int | None:
        """The i-th document's id; nulls come first."""
        return None if i < self.nulls else self.base + self.names.select(i - self.nulls)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + x for x in self.names.all().astype(np.uint64).tolist()]

    def ids(self, i: int) -> np.ndarray:
        return self.values[self.bounds.select(i) : self.bounds.select(i + 1)]

    @staticmethod
    def pack(doc_ids: list[int | None], ids: list[np.ndarray], width: int, shard: int = 0, block: int = 0, first: int = 0) -> bytes:
        """``doc_ids`` ascend, nulls first."""
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        known = [x for x in doc_ids if x is not None]
        base = known[0] if known else 0
        names, bounds = EliasFano.of(np.array([x - base for x in known], np.uint64)), EliasFano.of(ends)
        body = HEADER.pack(MAGIC, VERSION, width, names.low_bits, bounds.low_bits, shard, block, first, len(ids), int(ends[-1]), len(ids) - len(known), base)
        body += names.dump() + bounds.dump()
        body += np.concatenate(ids).astype(f"<u{width}").tobytes() if ids else b""
        return body + struct.pack("<I", zlib.crc32(body))


def write(df: DataFrame, tokenizer: str, end_id: int, id_width: int = 2, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS, folder: str | None = None) -> DataFrame:
    """Writes the blocks of all documents as files and gives a row for each: ``shard`` (in ascending doc_id order), ``block``, ``first`` (ids before it in the shard), ``n_docs``, ``n_ids``, ``path``.

    The files go to ``folder``, by default a new one in the shared folder, which
    all machines must reach by the same name.  ``id_width``: 2 for vocabularies below 65,536 ids, else 4.
    """

    def make():
        enc = encoder(ChunkEncoder, tokenizer)
        end = struct.pack("<I", end_id)

        def ids(b: pa.RecordBatch) -> dict:
            got = [np.frombuffer(x + end, "<u4") for x in enc.encode_texts(strings(b, "text"))]
            if id_width == 2 and any(x.max() > 0xFFFF for x in got):
                raise ValueError("an id needs more than 2 bytes")
            return {"doc_id": b.column("doc_id"), "ids": [x.astype(f"<u{id_width}").tobytes() for x in got]}

        return ids

    encoded = materialise(map_batches(text_of(df, id_col, text_col), make, "doc_id long, ids binary"), "token-ids")
    spark = df.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = encoded.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")

    folder = folder or f"{shared_dir(spark)}/habitra/{spark.sparkContext.applicationId}/token-files-{uuid.uuid4().hex}"
    small_batches(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = block = first = 0

        def row() -> pa.RecordBatch:
            name = f"{shard:06d}-{block:06d}.eftk"
            half = f"{root}/.{name}-{uuid.uuid4().hex}"  # names with a dot are read by nobody
            with fs.open_output_stream(half) as out:
                out.write(Block.pack(docs, held, id_width, shard, block, first))
            fs.move(half, f"{root}/{name}")
            numbers = {"first": first, "n_docs": len(docs), "n_ids": size}
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32())} | {k: pa.array([v], pa.int64()) for k, v in numbers.items()} | {"path": [f"{folder}/{name}"]})

        for b in batches:
            for doc, ids in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                docs.append(doc)
                held.append(np.frombuffer(ids, f"<u{id_width}"))
                size += len(held[-1])
                if size >= block_ids:
                    yield row()
                    docs, held, size, block, first = [], [], 0, block + 1, first + size
        if docs:
            yield row()

    return materialise(ordered.mapInArrow(pack, "shard int, block int, first long, n_docs long, n_ids long, path string"), "token-files")


def read(blocks: DataFrame) -> DataFrame:
    """Documents from the files of the rows that ``write`` gives: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (binary, unsigned 32-bit).

    A file knows the ids before it in its shard; those of the shards before come
    from a sum over shards, which is broadcast: as many rows as shuffle partitions.
    """
    from pyspark.sql import Window

    spark = blocks.sparkSession
    schema = "shard int, doc_id long, start long, ids binary"
    some = blocks.select("path").first()
    if some is None:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).withColumn("all", F.lit(0))
    before = shards.select("shard", F.coalesce(F.sum("n_ids").over(Window.partitionBy("all").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eftk").load(some["path"].rpartition("/")[0])

    def make():
        def rows(b: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"shard": [], "doc_id": [], "start": [], "ids": []}
            for data in b.column("content"):
                block = Block(data.as_py())
                ends = block.bounds.all().tolist()
                wide = block.values.astype("<u4").tobytes()
                out["shard"] += [block.shard] * block.n
                out["doc_id"] += block.doc_ids()
                out["start"] += [block.first + x for x in ends[:-1]]
                out["ids"] += [wide[4 * x : 4 * y] for x, y in zip(ends, ends[1:])]
            return out

        return rows

    docs = map_batches(files.select("content"), make, schema, rows=1)
    return docs.join(F.broadcast(before), "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"), "ids")
