"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Method: bounded-space online best fit. Open bins are kept in a bitset keyed by
free space; an item goes to the fullest bin it fits in (the lowest set bit at or
above its length), else into a new bin; at the limit of open bins the fullest
closes for good.

Items come in the order of a hash of id and piece, which is as good as a random order of
arrival: nothing waits for items still to come, so few bins are open half full when the limit
closes the fullest. They are dealt by that hash over as many partitions as their number asks
for. Only lengths are shuffled, never ids or texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import id_and_text, lean, written
from weft.llm.tokens import library_encoder

PARTITION_ITEMS = 500_000
#: Open bins of a partition; each is one number.
MOST_OPEN = 8192


class BestFit:
    """Bounded-space best fit: ``add(length)`` returns (bin, offset)."""

    def __init__(self, capacity: int, most_open: int):
        if capacity < 1 or most_open < 1:
            raise ValueError("capacity and most_open must be positive")
        self.capacity, self.most_open = capacity, most_open
        self.free_bits = 0
        self.by_free: dict[int, list[int]] = {}
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.free_bits ^= 1 << free
            del self.by_free[free]
        self.n_open -= 1
        return found

    def add(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"an item of {length} doesn't fit a bin of {self.capacity}")
        fitting = self.free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            if self.n_open == self.most_open:  # the fullest closes
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            self.by_free.setdefault(left, []).append(found)
            self.free_bits |= 1 << left
            self.n_open += 1
        return found, self.capacity - free


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity`` ids.

    Returns doc_id, piece, start, length, ids_crc32, and ids (binary, little-endian
    unsigned 32-bit) if ``with_ids``. Null text counts as empty: one piece, the end id.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in batches:
            doc_ids, out = batch.column(0).to_pylist(), ([], [], [], [], [], [])
            for row, ids in encoder.encode(batch.column(1)):
                data = memoryview(np.append(ids, np.uint32(end_id)).astype("<u4").tobytes())
                for piece, start in enumerate(range(0, len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc_ids[row], piece, start, len(part) // 4, zlib.crc32(part), bytes(part) if with_ids else None)):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())[: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return id_and_text(docs).mapInArrow(lean(cut, "encoders"), schema)


def pack(items: DataFrame, capacity: int, most_open: int = MOST_OPEN, items_per_partition: int = PARTITION_ITEMS) -> DataFrame:
    """Adds sequence_id long and offset long to ``items`` (doc_id, piece, length and more).

    Sequence ids are unique, not dense. The order in a partition is total but for rows
    that are equal in every column, so a lost executor's tasks give the same packing again.
    """
    kept = [c for c in items.columns if c not in ("sequence_id", "offset")]
    items = items.select(kept)
    parts = max(1, -(-items.count() // items_per_partition))
    schema = items.schema.add("sequence_id", "long").add("offset", "long")
    rest = [c for c in ("length", "ids_crc32") if c in kept]  # they spread rows of a null or repeated id
    dealt = items.withColumn("_order", F.xxhash64("doc_id", "piece", *rest)).withColumn("_part", F.pmod(F.xxhash64("_order"), F.lit(parts)).cast("int"))
    order = ["_order", F.col("doc_id").asc_nulls_first(), "piece", *rest]

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, BestFit] = {}  # hash partitioning may bring several parts together
        for batch in batches:
            lengths, of = np.asarray(batch.column("length")), np.asarray(batch.column("_part"))
            placed = [(p, *bins.setdefault(p, BestFit(capacity, most_open)).add(n)) for p, n in zip(of.tolist(), lengths.tolist())]
            ids = pa.array([(p << 40) | b for p, b, _ in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), ids, pa.array([o for _, _, o in placed], pa.int64())], names=[*kept, "sequence_id", "offset"])

    return dealt.repartition(parts, "_part").sortWithinPartitions(*order).mapInArrow(lean(fill), schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, most_open: int = MOST_OPEN) -> DataFrame:
    """Packs all documents; one row for each piece with its sequence and place there.

    Null text counts as empty, so it is a piece of one id; a very long text gives as many
    pieces as it needs. Rows with a null or a repeated doc_id are packed like any other. Pieces
    of equal length are told apart by id, piece and content; those that are equal in all share
    one order, and it doesn't matter which comes first. Columns other than doc_id and text are
    left out, so no name clashes. No rows in, no rows out.
    """
    pieces = written(token_pieces(docs, vocabulary, capacity, end_id), "pieces")
    return pack(pieces, capacity, most_open)


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens and ids (binary).

    A group is one sequence, at most ``capacity`` ids. It needs unique doc_ids.
    """
    pieces = token_pieces(docs, vocabulary, capacity, end_id, with_ids=True).select("doc_id", "piece", "ids")
    joined = packed.select("doc_id", "piece", "sequence_id", "offset", "length").join(pieces, ["doc_id", "piece"])
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.aggregate(F.transform(rows, lambda r: r["ids"]), F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
