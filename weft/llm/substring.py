"""Removal of long repeated spans of words, by compaction of the corpus's de Bruijn graph.

An edge of the graph is a run of ``WINDOW`` words; consecutive edges of a document overlap
in all but one word. Nonbranching stretches are compacted as assemblers do it: edges next
to each other that share their minimizer (the run of ``KMER`` words of least hash in them,
at one place) form one path, stored by the hash of its minimizer, the hash of its words
and its source coordinates. About every seventh word begins a path, and equal edges have
equal minimizers, so only paths of equal minimizer need to meet:

1.  Paths are grouped by minimizer (combined before the shuffle). A minimizer seen once
    has no repeated edge. One whose paths are all equal is decided at once: its first
    path stays, the later ones are repeated.
2.  Paths of the other minimizers, which branch, are grouped by their words. The later
    copies of a path are repeated; the first copies are opened into edges from their
    source texts and the edges are grouped: an edge is repeated if it begins earlier
    anywhere.
3.  Repeated paths and edges that follow each other both in their document and at their source
    compact to one span with its source coordinates.
4.  The words of every span and those at its source coordinates are read from the texts. All
    that name one place must have one digest (blake2b of 128 bits); where they don't, by an
    accident of the 64-bit hashes of steps 1 and 2, a span is taken out of its document only if its
    own words have the source's digest.

Joins are by minimizer, path, edge, place or document, each skewed side against a side of one
row a key, which Spark may split. Every shuffled text is compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weft.llm.common import as_texts, drop_shuffles, forget, joined, lean, marked, packed_texts, unpack, written
from weft.llm.words import mixed, run_starts, runs_hash, word_hashes

WINDOW, KMER = 20, 8


def paths_of(hashes: np.ndarray, offsets: np.ndarray, window: int = WINDOW, kmer: int = KMER) -> tuple[np.ndarray, ...]:
    """minimizer, path hash, place of the first word, and number of edges of each path."""
    starts = run_starts(offsets, window)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), starts, starts
    places = np.arange(len(hashes) - kmer + 1)
    kmers = runs_hash(hashes, places, places + kmer)
    views = np.lib.stride_tricks.sliding_window_view(kmers, window - kmer + 1)
    least = np.empty(len(starts), np.int64)
    for k in range(0, len(starts), 1 << 16):
        some = starts[k : k + (1 << 16)]
        least[k : k + (1 << 16)] = some + views[some].argmin(1)
    text = np.searchsorted(offsets, starts, "right")
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    edges = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    return kmers[least[first]], runs_hash(hashes, begin, begin + edges + window - 1), begin, edges


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def document_paths(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """minimizer, path, doc_id, mark, start (word of the document) and edges of each path."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                hashes, offsets = word_hashes(some.column(2))
                mini, path, begin, edges = paths_of(hashes, offsets, window, kmer)
                text = np.searchsorted(offsets, begin, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [signed(mini), signed(path), *(pa.array(np.asarray(some.column(c))[text]) for c in (0, 1)), pa.array((begin - offsets[text]).astype(np.int32)), pa.array(edges.astype(np.int32))],
                    names=["minimizer", "path", "doc_id", "mark", "start", "edges"],
                )

    return docs.select("doc_id", "mark", "text").mapInArrow(lean(rows, "powers"), "minimizer long, path long, doc_id long, mark long, start int, edges int")


def edges_of(paths: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The edges of the given paths, read from the paths' source texts: e1, e2, doc_id, mark, start."""
    grouped = paths.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "edges")).alias("paths"))  # a group is a part of one document
    texts = packed_texts(docs)  # a repeated row gives its edges again, at the same places

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for doc_id, mark, data, found in zip(ids, marks, unpack(batch.column(2)), lists):
                hashes, _ = word_hashes(as_texts([data]))
                starts = np.concatenate([np.arange(p["start"], p["start"] + p["edges"]) for p in found])
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [signed(runs_hash(hashes, starts, starts + window)), signed(runs_hash(mixed(hashes, 3), starts, starts + window)), pa.array([doc_id] * n, pa.int64()), pa.array([mark] * n, pa.int64()), pa.array(starts.astype(np.int32))],
                    names=["e1", "e2", "doc_id", "mark", "start"],
                )

    return joined(texts, grouped, ["doc_id", "mark"]).mapInArrow(lean(rows, "powers"), "e1 long, e2 long, doc_id long, mark long, start int")


def first_place() -> Column:
    return F.min(F.struct("doc_id", "start", "mark")).alias("first")


def is_later() -> Column:
    return (F.col("first.doc_id") < F.col("doc_id")) | ((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.start") < F.col("start")))


def compacted(stretches: DataFrame) -> DataFrame:
    """Stretches of edges (doc_id, mark, start, edges, first) that follow each other or overlap
    in their document and equally at their source, as one."""
    at = ["doc_id", "mark", F.col("first.doc_id").alias("source"), F.col("first.mark").alias("source_mark"), (F.col("first.start") - F.col("start")).alias("shift")]
    flat = stretches.select(*at, "start", (F.col("start") + F.col("edges")).alias("end")).distinct()
    keys = ["doc_id", "mark", "source", "source_mark", "shift"]
    along = Window.partitionBy(*keys).orderBy("start", "end")  # a partition is a part of one document
    fresh = F.coalesce((F.col("start") > F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    runs = flat.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(along))
    return runs.groupBy(*keys, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def kept_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    """``words`` without the spans (start, length, digest) whose words have that digest, if it is
    given; ``words`` itself if all stay."""
    change = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        start, end = s["start"], s["start"] + s["length"]
        if s["digest"] is None or digest(words[start:end]) == s["digest"]:
            change[start] += 1
            change[end] -= 1
    return [w for w, c in zip(words, np.cumsum(change).tolist()) if not c] if change.any() else words


def digests_of_places(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """For each place (source, source_mark, at, length) that spans name: the digest of its words in
    the source (told), and the least and greatest digest of these and of all spans that name it.

    A text is read once, for its spans and for the places in it; a batch gives a place and a
    digest once, so a passage that many documents share isn't listed for each of them.
    """
    place = [F.col("source"), F.col("source_mark"), F.col("at"), F.col("length")]
    own = spans.select("doc_id", "mark", F.struct("start", *place, F.lit(False).alias("told")).alias("r"))
    there = spans.select(*place).distinct().select(F.col("source").alias("doc_id"), F.col("source_mark").alias("mark"), F.struct(F.col("at").alias("start"), *place, F.lit(True).alias("told")).alias("r"))
    asked = own.unionByName(there).groupBy("doc_id", "mark").agg(F.collect_list("r").alias("rs"))  # a group is spans and places of one document
    texts = joined(packed_texts(docs), written(asked, "places"), ["doc_id", "mark"]).select("packed", "rs")
    names = ["source", "source_mark", "at", "length", "told"]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple] = set()
            for data, asked in zip(unpack(batch.column(0)), batch.column(1).to_pylist()):
                words = data.split()
                found.update((*(r[c] for c in names), digest(words[r["start"] : r["start"] + r["length"]])) for r in asked)
            columns = list(zip(*found)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()))], names=[*names, "digest"])

    seen = texts.mapInArrow(lean(rows), "source long, source_mark long, at int, length int, told boolean, digest binary").withColumn("digest", F.hex("digest"))
    return seen.groupBy("source", "source_mark", "at", "length").agg(F.min(F.when(F.col("told"), F.col("digest"))).alias("told"), F.min("digest").alias("least"), F.max("digest").alias("most"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, mark, start and length in words of spans whose windows all begin earlier too. digest:
    null where the words of all spans that name this span's source are those of the source, else the
    source's, which tells the spans that are no repeats. ``docs`` as ``marked`` gives it."""
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null")
    stretch = lambda df: df.select("doc_id", "mark", "start", "edges", "first")

    paths = document_paths(docs, window, kmer)
    seen = paths.groupBy("minimizer").agg(F.count("*").alias("n"), F.min("path").alias("p"), F.max("path").alias("q"), first_place()).where("n > 1")
    seen = written(seen.select("minimizer", (F.col("p") != F.col("q")).alias("branches"), "first"), "minimizers")
    drop_shuffles(spark)
    met = written(joined(document_paths(docs, window, kmer), seen, "minimizer").where(F.col("branches") | is_later()), "paths")
    drop_shuffles(spark)
    straight = stretch(met.where("not branches"))

    branching = met.where("branches").drop("first")
    firsts = written(branching.groupBy("minimizer", "path").agg(first_place()), "firsts")  # written, so Spark may split the join below
    placed = written(joined(branching, firsts, ["minimizer", "path"]).withColumn("later", is_later()), "branching")
    copies = stretch(placed.where("later"))
    edges = written(edges_of(placed.where("not later").dropDuplicates(["minimizer", "path"]), docs, window), "edges")
    drop_shuffles(spark)
    known = written(edges.groupBy("e1", "e2").agg(F.count("*").alias("n"), first_place()).where("n > 1").drop("n"), "known")
    single = joined(edges, known, ["e1", "e2"]).where(is_later()).withColumn("edges", F.lit(1))
    spans = compacted(straight.unionByName(copies).unionByName(stretch(single)))
    spans = spans.select("doc_id", "mark", "start", (F.col("end") - F.col("start") + (window - 1)).alias("length"), "source", "source_mark", (F.col("start") + F.col("shift")).alias("at"))
    spans = written(spans, "spans")
    forget(seen, met, firsts, placed, edges, known)
    drop_shuffles(spark)
    wrong = written(digests_of_places(spans, docs).where("least != most").select("source", "source_mark", "at", "length", F.unhex("told").alias("digest")), "wrong")
    drop_shuffles(spark)
    if wrong.isEmpty():
        return spans.select("doc_id", "mark", "start", "length", F.lit(None).cast("binary").alias("digest"))
    return joined(spans, wrong, ["source", "source_mark", "at", "length"], "left").select("doc_id", "mark", "start", "length", "digest")


def without_repeats(docs: DataFrame, more: list[str] = [], window: int = WINDOW, kmer: int = KMER) -> DataFrame:  # noqa: B006
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), text and
    the columns ``more`` of each row. text: the kept words so joined, or the text as it was
    if it lost none (empty, if it was null).

    Null, empty and wordless texts have no words: nothing is removed. Texts of any length are
    read whole, each in one task. Rows with a null id are outside the order: they neither lose
    words nor cause others to. Rows that repeat an id are one document, so at equal places
    neither is earlier; each loses what begins earlier elsewhere. ``more`` must not name
    columns like those returned; other columns are left out. No rows in, no rows out.
    """
    docs = marked(docs, more)
    spans = repeated_spans(docs, window, kmer)
    drop_shuffles(docs.sparkSession)
    lists = spans.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "length", "digest")).alias("spans"))  # a group is a part of one document
    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string, text binary")
    for c in more:
        schema = schema.add(c, docs.schema[c].dataType)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for data, found in zip(unpack(batch.column(1)), batch.column(2).to_pylist()):
                words = data.split()
                kept = kept_words(words, found or [])
                text = b" ".join(kept)
                for column, value in zip(out, (len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text if kept is not words else data)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds)), *batch.columns[3:]], names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", *more])

    cut = joined(packed_texts(docs, more), lists, ["doc_id", "mark"], "left").select("doc_id", "packed", "spans", *more)
    return cut.mapInArrow(lean(rows), schema).withColumn("text", F.col("text").cast("string"))


def dedup_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row; cases as ``without_repeats`` states."""
    return without_repeats(docs).drop("text")
