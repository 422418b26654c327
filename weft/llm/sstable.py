"""Token-id output as sorted-string-table shards.

A shard holds documents in ascending key order:

    block*  index  bloom  footer
    block   entries, then crc32 of them (4 bytes, little-endian)
    entry   varint shared, varint unshared, varint size of value, key[shared:], value
            (shared: bytes that the key has in common with the one before it in the block)
    value   varint number of ids, 1 byte width (2 or 4), zstandard frame of the ids, little-endian
    index   for each block: varint size of its last key, the key, varint offset, varint size
    bloom   bits, each id set at ``HASHES`` places
    footer  8 x uint64: offset and size of index, offset and size of bloom, entries,
            ids in all, blocks, magic

A key is 0x00 for a null id, else 0x01 and the id plus 2**63 (8 bytes, big-endian);
behind it an ordinal (4 bytes, big-endian) tells repeated ids apart. A lookup asks
the Bloom filter, bisects the index and reads one block.

Shards are ranges of (id, text hash), so ascending shards are in ascending id order, their
number follows the bytes of text, and an id that very many rows repeat spreads over shards.
Each is written under a name of its own try and then renamed; a task that is run again
writes the same bytes. Files are written through Arrow's file systems (file, hdfs, s3, gs,
abfs); another scheme is refused before any work is done.
"""

from __future__ import annotations

import bisect
import math
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import id_and_text, lean, new_path
from weft.llm.tokens import library_encoder

MAGIC = 0x7765667473737431
FOOTER = struct.Struct("<8Q")
BLOCK_BYTES = 64 << 10
#: Bytes of text for which a shard is made.
SHARD_TEXT = 64 << 20
BITS_PER_KEY, HASHES = 10, 7


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def id_key(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def key_id(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:9])[0] - (1 << 63) if key[0] else None


def encode_value(ids: np.ndarray, compressor: zstandard.ZstdCompressor) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
    return varint(len(ids)) + bytes([width]) + compressor.compress(ids.astype(f"<u{width}").tobytes())


def decode_value(value: bytes, decompressor: zstandard.ZstdDecompressor) -> np.ndarray:
    n, at = read_varint(value, 0)
    width = value[at]
    return np.frombuffer(decompressor.decompress(value[at + 1 :], max_output_size=max(1, n * width)), f"<u{width}").astype("<u4")


def bloom_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h & (1 << 64) - 1, h >> 64 | 1


def bloom_places(a: int, b: int, bits: int) -> list[int]:
    return [(a + i * b) % bits for i in range(HASHES)]


class ShardWriter:
    """Writes one shard; keys must come in ascending order. It holds one block,
    the index (about 20 bytes a block) and 16 bytes for each id."""

    def __init__(self, stream):
        self.stream, self.at, self.block, self.key, self.ordinal = stream, 0, bytearray(), b"", 0
        self.index, self.hashed, self.entries, self.ids, self.blocks, self.id_of = bytearray(), array("Q"), 0, 0, 0, b""

    def add(self, doc_id: int | None, value: bytes) -> None:
        key = id_key(doc_id)
        if key < self.id_of:
            raise ValueError("keys must ascend")
        self.ordinal = self.ordinal + 1 if key == self.id_of else 0
        if not self.ordinal:
            self.hashed.extend(bloom_hash(key))
        self.id_of = key
        key += struct.pack(">I", self.ordinal)
        shared = 0
        if self.block:
            while shared < min(len(key), len(self.key)) and key[shared] == self.key[shared]:
                shared += 1
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.key = key
        self.entries += 1
        self.ids += read_varint(value, 0)[0]
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = bytes(self.block) + struct.pack("<I", zlib.crc32(self.block))
            self.index += varint(len(self.key)) + self.key + varint(self.at) + varint(len(data))
            self.stream.write(data)
            self.at += len(data)
            self.blocks += 1
            self.block = bytearray()

    def close(self) -> None:
        self.flush()
        bits = max(64, BITS_PER_KEY * (len(self.hashed) // 2) + 7 & ~7)
        bloom = bytearray(bits // 8)
        for a, b in zip(self.hashed[::2], self.hashed[1::2]):
            for p in bloom_places(a, b, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        at = self.at
        self.stream.write(bytes(self.index) + bytes(bloom) + FOOTER.pack(at, len(self.index), at + len(self.index), len(bloom), self.entries, self.ids, self.blocks, MAGIC))
        self.stream.close()


class Shard:
    """Reads a shard: ``blocks()`` in order, ``get(doc_id)`` by bisection."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        index_at, index_size, bloom_at, bloom_size, self.entries, self.ids, self.n_blocks, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard")
        index, self.bloom = self.file.read_at(index_size, index_at), self.file.read_at(bloom_size, bloom_at)
        self.last_keys, self.places, at = [], [], 0
        while at < len(index):
            n, at = read_varint(index, at)
            self.last_keys.append(index[at : at + n])
            offset, at = read_varint(index, at + n)
            length, at = read_varint(index, at)
            self.places.append((offset, length))

    def entries_of(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        offset, length = self.places[block]
        data = self.file.read_at(length, offset)
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise OSError(f"block {block} is damaged")
        at, key = 0, b""
        while at < len(data) - 4:
            shared, at = read_varint(data, at)
            own, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + data[at : at + own]
            at += own
            yield key, data[at : at + size]
            at += size

    def get(self, doc_id: int | None) -> np.ndarray | None:
        """The ids of the first document with this id, or None."""
        key = id_key(doc_id)
        if any(not self.bloom[p >> 3] >> (p & 7) & 1 for p in bloom_places(*bloom_hash(key), len(self.bloom) * 8)):
            return None
        block = bisect.bisect_left(self.last_keys, key)
        if block < len(self.places):
            for found, value in self.entries_of(block):
                if found.startswith(key) and len(found) == len(key) + 4:
                    return decode_value(value, zstandard.ZstdDecompressor())
        return None


def write_shards(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2, shards: int | None = None) -> list[tuple[str, int, int]]:
    """Encodes every whole text and writes the shards; returns (uri, documents, ids) of
    each in ascending id order, one entry a shard.

    Null text counts as empty, null ids come first, rows that repeat an id are all kept, by
    their texts' hashes and texts. A very long text is one entry. Columns other than doc_id and
    text are left out, so no name clashes. An empty table gives no shard.
    """
    pafs.FileSystem.from_uri(folder)  # tells at once whether Arrow knows the scheme
    docs = id_and_text(docs).withColumn("h", F.xxhash64("text"))
    if shards is None:
        shards = max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / SHARD_TEXT))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer = TaskContext.get().partitionId(), None
        encoder, compressor = library_encoder(vocabulary), zstandard.ZstdCompressor(3, write_content_size=False)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, ids in encoder.encode(batch.column(1)):
                if writer is None:
                    fs, base = pafs.FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    temporary = f"{base}/.{shard:06d}-{uuid.uuid4().hex}"
                    writer = ShardWriter(fs.open_output_stream(temporary))
                writer.add(doc_ids[row], encode_value(np.append(ids, np.uint32(end_id)), compressor))
        if writer is not None:
            writer.close()
            fs.move(temporary, f"{base}/shard-{shard:06d}.sst")
            done = [(shard, f"{folder}/shard-{shard:06d}.sst", writer.entries, writer.ids)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), (pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["shard", "uri", "documents", "ids"])

    order = [F.col("doc_id").asc_nulls_first(), "h"]
    rows = docs.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    told = rows.mapInArrow(lean(write, "encoders"), "shard int, uri string, documents long, ids long").collect()  # one row a shard
    return [(r.uri, r.documents, r.ids) for r in sorted(told)]


def read_shards(spark: SparkSession, shards: list[tuple[str, int, int]], with_ids: bool = False) -> DataFrame:
    """The documents of the shards in order: doc_id, start (ids before it), n_tokens, ids_crc32.
    ``shards`` is as ``write_shards`` returns it: one entry a shard, however many documents."""
    rows, before = [], 0
    for uri, _, ids in shards:
        rows.append((uri, before))
        before += ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(uri)
                for block in range(shard.n_blocks):
                    out: list[list] = [[] for _ in names]
                    for key, value in shard.entries_of(block):
                        ids = decode_value(value, decompressor)
                        data = ids.tobytes()
                        for column, x in zip(out, (key_id(key), start, len(ids), zlib.crc32(data), data)):
                            column.append(x)
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    listed = spark.createDataFrame(rows, "uri string, before long").repartition(max(1, len(rows)))
    return listed.mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Writes the shards into the shared folder and reads them back."""
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, vocabulary, new_path(spark, "sst"), end_id))
