"""Nearest vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft import share_code
from weft.operators.ranking import top_k

#: Numbers of the queries that a task holds; vectors a slice has at least, where there are several.
QUERY_NUMBERS, SLICE_ROWS = 1 << 22, 4096
#: Queries and vectors of one matrix product, vectors of a slice's first, pairs of one exact check.
QUERIES, VECTORS, FIRST, PAIRS = 1024, 2048, 256, 1 << 16


class Vectors:
    """Rows of vectors: ``ids``, ``width``, ``raw`` (a row a place, scaled by a power of two, which
    a cosine doesn't notice, so that no square overflows), ``norm``, ``unit``; ``none``: no vector (null,
    empty or with a null in it), ``nan``: without direction (zero, NaN or infinite)."""

    def __init__(self, ids: np.ndarray, lists: pa.Array, places: int | None = None):
        flat, self.ids = lists.flatten(), ids
        self.width = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.none = self.width == 0
        if flat.null_count:
            self.none[np.repeat(np.arange(len(ids)), self.width)[flat.is_null().to_numpy(zero_copy_only=False)]] = True
        numbers = flat.cast(pa.float64()).fill_null(0.0).to_numpy()
        places = int(self.width.max(initial=0)) if places is None else places
        if (self.width == places).all():
            values = numbers.reshape(len(ids), places)
        else:  # shorter ones are filled up with zeros; longer ones than any query have no similarity
            values, at = np.zeros((len(ids), places)), np.arange(len(numbers)) - np.repeat(np.cumsum(self.width) - self.width, self.width)
            values[np.repeat(np.arange(len(ids)), self.width)[at < places], at[at < places]] = numbers[at < places]
        most = np.abs(values).max(1, initial=0)
        self.nan = ~(np.isfinite(most) & (most > 0))
        values = np.ldexp(np.where(self.nan[:, None], 0.0, values), -np.frexp(np.where(self.nan, 1.0, most))[1][:, None])
        self.raw = np.ascontiguousarray(values.T)
        self.norm = np.zeros(len(ids))
        for x in self.raw:  # in order of the places, as everywhere here: a sum doesn't depend on the shape of a batch
            self.norm += x * x
        self.norm = np.where(self.nan, 1.0, np.sqrt(self.norm))
        self.unit = values / self.norm[:, None]

    def part(self, lo: int, hi: int) -> Vectors:
        own = object.__new__(Vectors)
        own.__dict__ = {k: v[:, lo:hi] if k == "raw" else v[lo:hi] for k, v in self.__dict__.items()}
        return own


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Half away from zero, as SQL has it; never -0.0."""
    scaled = x * 10.0**digits
    whole = np.trunc(scaled)
    return (whole + np.sign(scaled) * (np.abs(scaled - whole) >= 0.5)) / 10.0**digits + 0.0


def cosines(asked: Vectors, some: Vectors, q: np.ndarray, v: np.ndarray, digits: int) -> np.ndarray:
    """Rounded cosines of the pairs q, v."""
    found = np.empty(len(q))
    for lo in range(0, len(q), PAIRS):
        i, j = q[lo : lo + PAIRS], v[lo : lo + PAIRS]
        total = np.zeros(len(i))
        for x, y in zip(asked.raw, some.raw, strict=True):
            total += x[i] * y[j]
        found[lo : lo + PAIRS] = rounded(total / (asked.norm[i] * some.norm[j]), digits)
    return found


class Nearest:
    """The k first vectors of each of ``asked``, among all that ``meet`` has seen, which come by
    ascending id: of those as near as the last of k full places, later ones have lost.

    A key is the rounded cosine, inf for NaN, which SQL takes as the largest, and -inf for null, the last.
    """

    def __init__(self, asked: Vectors, k: int, digits: int):
        self.asked, self.k, self.digits = asked, k, digits
        self.q, self.key, self.id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.least = np.full(len(asked.ids), -np.inf)  # what a later vector's product must reach; NaN: none can
        self.slack = 1e-11 + asked.unit.shape[1] * 2.0**-50  # over the error of a product

    def products(self, some: Vectors) -> np.ndarray:
        asked = self.asked
        found = asked.unit @ some.unit.T
        found[:, some.nan] = np.inf
        found[asked.nan] = np.inf
        if (asked.width != asked.width[0]).any() or (some.width != asked.width[0]).any():
            found[asked.width[:, None] != some.width] = -np.inf
        found[:, some.none] = -np.inf
        found[asked.none] = -np.inf
        return found

    def meet(self, some: Vectors) -> None:
        found = self.products(some)
        own = np.flatnonzero(np.isin(some.ids, self.asked.ids))
        i, j = np.nonzero(self.asked.ids[:, None] == some.ids[own])
        least = self.least
        if not len(self.q) and len(some.ids) > self.k:
            found[i, own[j]] = -np.inf
            least = np.partition(found, -self.k, axis=1)[:, -self.k] - 10.0**-self.digits - self.slack
        found[i, own[j]] = np.nan  # no vector meets its own id
        hits = np.flatnonzero(found >= least[:, None])
        if not len(hits):
            return
        q, v = np.divmod(hits, len(some.ids))
        key = found.ravel()[hits]
        real = np.isfinite(key)
        key[real] = cosines(self.asked, some, q[real], v[real], self.digits)
        q, key, ids = np.concatenate([self.q, q]), np.concatenate([self.key, key]), np.concatenate([self.id, some.ids[v]])
        order = np.lexsort((ids, -key, q))
        at = np.arange(len(q))
        place = at - np.maximum.accumulate(np.where(np.diff(q[order], prepend=-1) != 0, at, 0))
        order, place = order[place < self.k], place[place < self.k]
        self.q, self.key, self.id = q[order], key[order], ids[order]
        last = place == self.k - 1
        key = self.key[last]
        self.least[self.q[last]] = np.where(key == np.inf, np.nan, np.where(key == -np.inf, -2.0, key + 0.5 * 10.0**-self.digits - self.slack))

    def batch(self) -> pa.RecordBatch:
        key = np.where(self.key == np.inf, np.nan, self.key)
        return pa.RecordBatch.from_arrays([pa.array(self.asked.ids[self.q]), pa.array(self.id), pa.array(key, mask=self.key == -np.inf)], names=["query", "id", "similarity"])


def nearest_in(k: int, digits: int) -> Callable:
    """For mapInArrow over side (0: a query, 1: a vector), id, v, in this order: the k nearest of each query."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, held = [], None
        for batch in batches:
            n = int(pc.sum(pc.equal(batch.column(0), 0)).as_py() or 0)
            if n:
                queries.append(batch.slice(0, n))
            if n == batch.num_rows:
                continue
            if held is None:
                if not queries:
                    return
                all_of = pa.Table.from_batches(queries).combine_chunks().to_batches()[0]
                asked, first = Vectors(all_of.column(1).to_numpy(), all_of.column(2)), FIRST
                held, queries = [Nearest(asked.part(lo, lo + QUERIES), k, digits) for lo in range(0, len(asked.ids), QUERIES)], []
            while n < batch.num_rows:
                own = batch.slice(n, first)
                some = Vectors(own.column(1).to_numpy(), own.column(2), asked.unit.shape[1])
                for x in held:
                    x.meet(some)
                n, first = n + first, VECTORS
        yield from (x.batch() for x in held or [])

    return rows


def cosine_top_k(df: DataFrame, asked: Column, key: str, vector: str, k: int, digits: int) -> DataFrame:
    """The ``k`` nearest other rows of every row of ``asked``, among all: query_id, ``key``, similarity
    (cosine, rounded to ``digits``), rank. Equally similar ones come by ``key``, a long.

    Exact: every query meets every row in products of matrices, and what may be among the first k
    is computed again in order of the places. Rows are dealt by a hash over slices, queries over groups of
    about 2**22 numbers; each pair of a slice and a group is a task that holds the group and streams
    the slice, so memory doesn't grow with the table. As the work is queries times rows, time does.

    A zero, NaN or infinite vector has similarity NaN, which comes first, as in SQL; null, an empty
    vector, one with a null in it, or one of another length has null, which comes last. Rows without
    ``key`` are left out. Rows of one ``key`` don't meet; they share the places of their id.
    """
    share_code(df.sparkSession)
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), asked.alias("asked"))
    n, n_asked, places = rows.agg(F.count("*"), F.count_if("asked"), F.max(F.when(F.col("asked"), F.size("v")))).first()
    groups = max(1, -(-n_asked * max(places or 1, 1) // QUERY_NUMBERS))
    slices = max(1, min(-(-n // SLICE_ROWS), 3 * df.sparkSession.sparkContext.defaultParallelism // groups))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    queries = rows.where("asked").select(F.lit(0).alias("side"), "id", "v", dealt(groups).alias("of"), every(slices).alias("slice"))
    vectors = rows.select(F.lit(1).alias("side"), "id", "v", dealt(slices).alias("slice"), every(groups).alias("of"))
    cells = queries.unionByName(vectors).repartitionById(groups * slices, F.col("of") * slices + F.col("slice"))
    found = cells.sortWithinPartitions("side", "id").select("side", "id", "v").mapInArrow(nearest_in(k, digits), "query long, id long, similarity double")
    return top_k(found.select(F.col("query").alias("query_id"), F.col("id").alias(key), "similarity"), ["query_id"], [F.desc("similarity"), F.col(key)], k)
