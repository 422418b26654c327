"""Homomorphic multiset fingerprints of documents, in DataFrame functions only.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed into a wide
vector, and a text's fingerprint is the sum of its paragraphs' vectors, lane by lane
modulo a power of two. So the order of paragraphs has no effect on any part of it, and a
paragraph is inserted or deleted by adding or subtracting its vector (``combine``). The lanes:

    count     elements, modulo 2**32
    exact     4 hashes of the paragraph, modulo 2**32 each
    alike     128 lanes modulo 2**30: for each element, one bit a lane of its two hashes

A paragraph's elements are itself and all its runs of three words, where each character
of a word of more than 32 counts as a word, as do those of a paragraph of fewer than three
words: paragraphs without spaces have runs too. No run leaves its paragraph. With c of n
elements in a lane, 2c - n is a sum of random signs, so the cosine of two such vectors
estimates the share of elements that the texts have in common (standard error about 0.09).

Two lanes lie in a long, 32 bits apart, with the bits between them cleared after
every addition: no lane carries into another and nothing overflows. Elements are counted 127
at a time, eight lanes of a byte in a long, before they are added there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import SPACE, id_and_text, written

RUN_UNITS, LONG_WORD = 3, 32
LANE_BITS, LANES_APART, LANES_A_LONG = 30, 32, 2
LONGS_A_HASH = 64 // LANES_A_LONG
_ONES = sum(1 << j * LANES_APART for j in range(LANES_A_LONG))
_MASK = ((1 << LANE_BITS) - 1) * _ONES
_MASK32 = (1 << 32) - 1
N_EXACT, N_HASHES = 4, 2
_BYTE_ONES, _BYTE_MOST = 0x0101010101010101, 127  # the highest byte has the sign


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column, of) -> Column:
    mask = F.lit(_MASK32).cast("long")
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, h: (a + of(h)).bitwiseAND(mask))


def seeded(seed: int):
    return lambda h: F.xxhash64(F.lit(seed), h)


def lanes_of(elements: Column) -> Column:
    """Array of longs with ``LANES_A_LONG`` lanes each, over an array of element hashes."""
    ones, mask, byte, zero = (F.lit(x).cast("long") for x in (_BYTE_ONES, _MASK, 255, 0))

    def counted(hs: Column, k: int) -> Column:
        """Byte i counts bit 8i + k of the hashes."""
        return F.aggregate(hs, zero, lambda a, h: a + F.shiftright(h, k).bitwiseAND(ones))

    def lane(sums: Column, seed: int, bit: int) -> Column:
        return F.shiftright(F.get(sums, F.lit(8 * seed + bit % 8)), bit // 8 * 8).bitwiseAND(byte)

    def widened(sums: Column) -> Column:
        lanes = ([F.shiftleft(lane(sums, seed, k + j * LONGS_A_HASH), j * LANES_APART) for j in range(LANES_A_LONG)] for seed in range(N_HASHES) for k in range(LONGS_A_HASH))
        return F.array(*(reduce(lambda x, y: x.bitwiseOR(y), parts) for parts in lanes))

    def of(some: Column) -> Column:
        return let(F.concat(*(let(F.transform(some, seeded(seed)), lambda hs: F.array(*(counted(hs, k) for k in range(8)))) for seed in range(N_HASHES))), widened)

    begins = F.sequence(F.lit(1), F.greatest(F.size(elements), F.lit(1)), F.lit(_BYTE_MOST))
    return F.aggregate(begins, F.array(*[zero] * (N_HASHES * LONGS_A_HASH)), lambda total, i: F.zip_with(total, of(F.slice(elements, i, F.lit(_BYTE_MOST))), lambda x, y: (x + y).bitwiseAND(mask)))


def elements_of(paragraph: Column) -> Column:
    """Hashes of the paragraph and of its runs."""

    def runs(units: Column) -> Column:
        first = F.slice(units, F.lit(1), F.greatest(F.size(units) - (RUN_UNITS - 1), F.lit(0)))
        return F.transform(first, lambda u, i: F.xxhash64(u, *(F.get(units, i + k) for k in range(1, RUN_UNITS))))

    def units(ws: Column) -> Column:
        long = lambda w: F.length(w) > LONG_WORD
        cut = F.flatten(F.transform(ws, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))
        return F.when(F.size(ws) < RUN_UNITS, F.split(paragraph, "")).when(F.exists(ws, long), cut).otherwise(ws)

    own = F.array(F.xxhash64(F.lit("paragraph"), paragraph))
    return F.concat(own, let(let(F.array_remove(F.split(paragraph, SPACE), ""), units), runs))


def vector(text: Column) -> Column:
    """The fingerprint as a struct: n long, exact array<long>, alike array<long>."""

    def of(ps: Column) -> Column:
        exact = F.array(*(total(ps, lambda p, k=k: F.xxhash64(F.lit(k), p).bitwiseAND(F.lit(_MASK32).cast("long"))) for k in range(N_EXACT)))
        return let(F.flatten(F.transform(ps, elements_of)), lambda es: F.struct(F.size(es).cast("long").alias("n"), exact.alias("exact"), lanes_of(es).alias("alike")))

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), of)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of the multiset union (sign 1) or difference (-1) of two."""
    def lanes(mask: int, guard: int):
        m, g = F.lit(mask).cast("long"), F.lit(guard if sign < 0 else 0).cast("long")
        return lambda x, y: (x + g + (y if sign > 0 else -y)).bitwiseAND(m)

    return F.struct(
        lanes(_MASK32, 1 << 32)(a["n"], b["n"]).alias("n"),
        F.zip_with(a["exact"], b["exact"], lanes(_MASK32, 1 << 32)).alias("exact"),
        F.zip_with(a["alike"], b["alike"], lanes(_MASK, _ONES << LANE_BITS)).alias("alike"),
    )


def as_string(v: Column) -> Column:
    parts = F.concat(F.transform(F.concat(F.array(v["n"]), v["exact"]), lambda x: F.lpad(F.hex(x), 8, "0")), F.transform(v["alike"], lambda x: F.lpad(F.hex(x), 16, "0")))
    return F.lower(F.array_join(parts, ""))


def likeness(a: Column, b: Column) -> Column:
    """Between 0 and 1, from the fingerprints alone; 1 if they are equal."""
    mask = F.lit((1 << LANE_BITS) - 1).cast("long")

    def signs(v: Column) -> Column:
        lanes = F.flatten(F.transform(v["alike"], lambda x: F.array(*(F.shiftright(x, k * LANES_APART).bitwiseAND(mask) for k in range(LANES_A_LONG)))))
        return F.transform(lanes, lambda c: (c * 2 - v["n"]).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    def cosine(x: Column, y: Column) -> Column:
        return let(dot(x, x) * dot(y, y), lambda n: F.when(n > 0, F.least(F.greatest(dot(x, y) / F.sqrt(n), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0)))

    return F.when(a == b, F.lit(1.0)).otherwise(let(signs(a), lambda x: let(signs(b), lambda y: cosine(x, y))))


def next_ids(docs: DataFrame) -> DataFrame:
    """doc_id, need, next_id for each distinct non-null id: the next id in ascending order
    (after the last: the first) and the longest prefix that a row of doc_id takes from it.

    Only ids are sorted: ranges of ids in parallel, then the first id of each range (one
    row a range) tells the last row of the range before it its successor.
    """
    spark = docs.sparkSession
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.floor(F.length(F.coalesce("text", F.lit(""))) / 4)).cast("int").alias("need"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(ids.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "ids")
    firsts = sorted(ranged.groupBy("part").agg(F.min("doc_id").alias("first")).collect())
    after = [(r.part, firsts[(k + 1) % len(firsts)].first) for k, r in enumerate(firsts)]
    edges = F.broadcast(spark.createDataFrame(after, "part int, edge long"))  # one row a range
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return ranged.withColumn("next_id", inside).join(edges, "part").select("doc_id", "need", F.coalesce("next_id", "edge").alias("next_id"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text counts as empty, which is one empty paragraph. A very long text is one row's
    work. Of rows that repeat an id, the one with the least text hash is the "next document" of
    the id before; each of them is returned. Rows with a null id have no next document: nothing
    replaces their tail and near_next is 0. A table of one id is its own next document. Columns
    other than doc_id and text are left out, so no name clashes. No rows in, no rows out.

    A text's own fingerprint is made once, before the one shuffle by id that serves both joins.
    """
    docs = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    links = next_ids(docs)
    known = docs.where("doc_id is not null").withColumn("print", vector(F.col("text")))
    given = known.join(links.select(F.col("doc_id").alias("to"), "need", F.col("next_id").alias("doc_id")), "doc_id")
    given = given.select("to", F.struct(F.xxhash64("text").alias("h"), F.expr("left(text, need)").alias("prefix"), F.col("print")).alias("next"))
    given = given.groupBy(F.col("to").alias("doc_id")).agg(F.min("next").alias("next"))
    joined = known.join(given, "doc_id")
    alone = docs.where("doc_id is null").withColumn("print", vector(F.col("text"))).withColumn("next", F.lit(None).cast(joined.schema["next"].dataType))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    tail = F.coalesce(F.substring(F.col("next.prefix"), F.lit(1), quarter), F.lit(""))
    edited = joined.unionByName(alone).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), tail))
    edited = edited.withColumn("edited_print", vector(F.col("edited")))
    return edited.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("print")).alias("fingerprint"),
        as_string(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        F.coalesce(likeness(F.col("print"), F.col("next.print")), F.lit(0.0)).alias("near_next"),
    )
