"""N-gram Jaccard join with count vectors in R-trees.

A document's set is its distinct shingles of five words. Its count vector tells how many
of them hash into each group; the sum of two vectors' lesser coordinates bounds the sets'
overlap from above, and so does that sum over the upper corners of two R-tree boxes. Trees
index 64 groups. A larger set's vector has up to 4,096, a power of two, and is folded to
fewer groups where it meets a shorter one; pairs that pass in the tree are bounded again
over as many groups as both have. The join is exact:

1.  Documents of one set are one class; from here on a class is one node.
2.  Sets are ordered by a fixed rule (shingles of busy counters of a sketch of the whole
    corpus last, then by hash). Two sets that link share a shingle among the first
    ``n - ceil(0.75 n) + 1`` of each, so only classes that meet in such a shingle's bucket
    are compared.
3.  First round: every class enters the R-trees of the first two of its shared buckets. Second
    round: the classes enter the trees of all their buckets that still hold several
    components of the links found. A pair that links is in one component by then or
    meets here: no link is lost.
4.  A tree gives candidates as clusters: the connected parts of the graph of the pairs that
    pass the bound, so a bucket of m classes gives at most m rows, never its pairs.
5.  A cluster's sets are compared on the texts. Pairs that are connected by links already
    are skipped, so at most one link less than it has members comes out of it.
6.  Components of all links, by their least document.

A bucket of more than ``PAGE`` shingles is cut into pages, by component, size and hash; two pages
meet in a task of their own unless no pair of theirs can link (sizes too far apart, or all
of one component). So no task holds more than two pages, whatever the bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import as_texts, drop_shuffles, forget, joined, lean, marked, packed_texts, unpack, whole_groups, written
from weft.llm.components import components
from weft.llm.words import mixed, run_starts, runs_hash, word_hashes

SHINGLE_WORDS = 5
#: Two sets link when NUMERATOR * union <= DENOMINATOR * intersection.
NUMERATOR, DENOMINATOR = 75, 100
GROUPS, MOST_GROUPS, LEAF, COUNTERS = 64, 4096, 32, 1 << 16
#: Buckets that a class enters in the first round.
FIRST_BUCKETS = 2
#: Shingles that a page holds, as far as one set isn't larger.
PAGE = 1 << 20
#: Sets whose bands (logarithms of their sizes to this base) are more than one apart can't link.
BAND = 1.34

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(data: bytes) -> set:
    """The exact set of a text's bytes, for verification."""
    words = data.translate(_LOWER).split()
    if not words:
        return set()
    return set(zip(*(words[k:] for k in range(SHINGLE_WORDS)))) if len(words) >= SHINGLE_WORDS else {tuple(words)}


def links(a: set, b: set) -> bool:
    both = len(a & b)
    return bool(a) and bool(b) and DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both)


def set_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their offsets."""
    hashes, offsets = word_hashes(texts, lower=True)
    starts = run_starts(offsets, SHINGLE_WORDS)
    sizes = np.diff(offsets)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE_WORDS))
    begin = np.concatenate([starts, offsets[short]])
    end = np.concatenate([starts + SHINGLE_WORDS, offsets[short + 1]])
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    found, text = runs_hash(hashes, begin, end), np.searchsorted(offsets, begin, "right") - 1
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (text[1:] != text[:-1])])
    found, text = found[new], text[new]
    return found, np.searchsorted(text, np.arange(len(texts) + 1))


def groups_of(n):
    """Groups of the count vector of a set of size n: the power of two from n on."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(n, 1))).clip(0).astype(np.int64), GROUPS, MOST_GROUPS)


def count_vector(shingles: np.ndarray, compressor: zstandard.ZstdCompressor) -> bytes:
    """Counts as unsigned 8-bit numbers, or 32-bit ones if one is too large; most are 0 or 1, so
    they are compressed to about 0.3 bytes a shingle."""
    groups = int(groups_of(len(shingles)))
    counts = np.bincount((shingles % groups).astype(np.int64), minlength=groups)
    return compressor.compress(counts.astype("u1" if counts.max() < 256 else "<u4").tobytes())


class Vectors:
    """Count vectors of several widths."""

    def __init__(self, column: pa.Array, sizes: np.ndarray):
        self.groups, self.row = groups_of(sizes), np.zeros(len(sizes), np.int64)
        decompressor, self.matrix = zstandard.ZstdDecompressor(), {}
        data = [decompressor.decompress(x) for x in column.to_pylist()]
        for g in np.unique(self.groups).tolist():
            at = np.flatnonzero(self.groups == g)
            self.row[at] = np.arange(len(at))
            own = [data[k] for k in at]
            if all(len(x) == g for x in own):
                self.matrix[g] = np.frombuffer(b"".join(own), np.uint8).reshape(-1, g)
            else:
                self.matrix[g] = np.stack([np.frombuffer(x, np.uint8 if len(x) == g else "<u4").astype(np.uint32) for x in own])

    def folded(self, rows: np.ndarray, width: int, groups: int) -> np.ndarray:
        found = self.matrix[groups][self.row[rows]]
        return found if width == groups else found.reshape(len(rows), -1, width).sum(1, dtype=np.uint32)

    def narrow(self) -> np.ndarray:
        out = np.zeros((len(self.row), GROUPS), np.uint32)
        for g in self.matrix:
            at = np.flatnonzero(self.groups == g)
            out[at] = self.folded(at, GROUPS, g)
        return out

    def least(self, p: np.ndarray, other: Vectors, q: np.ndarray) -> np.ndarray:
        """For each pair the sum of the lesser counts over the groups that both have."""
        out, a, b = np.zeros(len(p), np.int64), self.groups[p], other.groups[q]
        for x in self.matrix:
            for y in other.matrix:
                at = np.flatnonzero((a == x) & (b == y))
                for k in range(0, len(at), 8192):
                    some, width = at[k : k + 8192], min(x, y)
                    out[some] = np.minimum(self.folded(p[some], width, x), other.folded(q[some], width, y)).sum(1, dtype=np.int64)
        return out


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def names_of(found: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    """64 bits that name each set of hashes."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(found, seed))])
    return mixed(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64), seed).view(np.int64)


def set_features(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n (set size), h1, h2 (128 bits that name the set) and its count vector."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(1)
        for batch in in_slices(batches):
            found, offsets = set_hashes(batch.column(2))
            vectors = [count_vector(found[lo:hi], compressor) for lo, hi in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()), *(pa.array(names_of(found, offsets, seed)) for seed in (11, 12)), pa.array(vectors, pa.binary())], names=["doc_id", "mark", "n", "h1", "h2", "vector"])

    return docs.select("doc_id", "mark", "text").mapInArrow(lean(rows, "powers"), "doc_id long, mark long, n long, h1 long, h2 long, vector binary")


def counters(docs: DataFrame) -> np.ndarray:
    """For each of ``COUNTERS`` counters how busy it is: 0 up to a tenth above the mean count of
    shingles, else by powers of sqrt 2. The sketch covers all rows and has a fixed size."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in in_slices(batches):
            total += np.bincount((set_hashes(batch.column(1))[0] >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["counter", "n"])

    found = docs.select(F.lit(0).alias("_"), "text").mapInArrow(lean(rows, "powers"), "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()  # at most COUNTERS rows
    total = np.zeros(COUNTERS)
    total[found["counter"]] = found["n"]
    mean = max(1.0, total.mean())
    over = total / (1.1 * mean + 8)
    return np.where(over > 1, np.ceil(2 * np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def postings(docs: DataFrame, busy: np.ndarray) -> DataFrame:
    """bucket (shingle hash) and h1 for the prefix of each text's set; a set that comes again
    within a batch, as those of large groups of copies do, is listed once."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 2000):
            found, offsets = set_hashes(batch.column(1))
            n = np.diff(offsets)
            h1 = names_of(found, offsets, 11)
            fresh = np.zeros(len(n), bool)
            fresh[np.unique(h1, return_index=True)[1]] = True
            text = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((found, busy[(found >> np.uint64(48)).astype(np.int64)], text))
            prefix = np.where(fresh, n - -(-NUMERATOR * n // DENOMINATOR) + 1, 0)
            rank = np.arange(len(found)) - np.repeat(offsets[:-1], n)
            keep = rank < np.repeat(prefix, n)
            yield pa.RecordBatch.from_arrays([pa.array(found[order][keep].view(np.int64)), pa.array(np.repeat(h1, n)[keep])], names=["bucket", "h1"])

    return docs.select(F.lit(0).alias("_"), "text").mapInArrow(lean(rows, "powers"), "bucket long, h1 long")


def bound_passes(n_a, n_b, least_sum):
    """Whether sets of these sizes could link, given an upper bound of their overlap."""
    return (NUMERATOR + DENOMINATOR) * least_sum >= NUMERATOR * (n_a + n_b)


def sizes_pass(less, more):
    """Whether a set of size ``less`` is large enough to link with one of size ``more``."""
    return DENOMINATOR * less >= NUMERATOR * more


class CountVectorTree:
    """An R-tree over count vectors, bulk-loaded by halving the widest coordinate.

    ``pairs()`` yields the places of pairs of points that pass the bound and differ in every
    label, by descending both trees at once; a box carries the greatest count of each group,
    its least and greatest size, and each label that all its points have. ``labels`` is a
    list of arrays; -1 differs from -1 too. ``part``, if given, is read anew for each pair of
    leaves: points of one part aren't paired, so a caller may unite parts on the way.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, labels: list[np.ndarray], part: np.ndarray | None = None):
        self.vectors, self.sizes, self.labels, self.part = vectors.astype(np.int32), sizes, labels, part
        self.root = self._build(np.arange(len(sizes))) if len(sizes) else None

    def _build(self, points: np.ndarray) -> dict:
        v, n = self.vectors[points], self.sizes[points]
        same = [int(x[points[0]]) if (x[points] == x[points[0]]).all() else -1 for x in self.labels]
        node = {"points": points, "most": v.max(0), "least_n": int(n.min()), "most_n": int(n.max()), "labels": same, "kids": ()}
        if len(points) > LEAF:
            spread = np.concatenate([v.max(0) - v.min(0), [np.ptp(self.sizes[points])]])
            k = int(spread.argmax())
            order = np.argsort(self.sizes[points] if k == v.shape[1] else v[:, k], kind="stable")
            half = len(points) // 2
            node["kids"] = (self._build(points[order[:half]]), self._build(points[order[half:]]))
        return node

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        stack = [(self.root, self.root)] if self.root else []
        while stack:
            a, b = stack.pop()
            if any(x == y != -1 for x, y in zip(a["labels"], b["labels"])):
                continue
            if not (sizes_pass(a["most_n"], b["least_n"]) and sizes_pass(b["most_n"], a["least_n"])):
                continue
            if not bound_passes(a["least_n"], b["least_n"], int(np.minimum(a["most"], b["most"]).sum())):
                continue
            if a["kids"] and (len(a["points"]) >= len(b["points"]) or not b["kids"]):
                if a is b:
                    x, y = a["kids"]
                    stack += [(x, x), (x, y), (y, y)]
                else:
                    stack += [(kid, b) for kid in a["kids"]]
            elif b["kids"]:
                stack += [(a, kid) for kid in b["kids"]]
            else:
                p, q = a["points"], b["points"]
                open_ = True if self.part is None else self.part[p][:, None] != self.part[q][None, :]
                if not np.any(open_):
                    continue
                least = np.minimum(self.vectors[p][:, None, :], self.vectors[q][None, :, :]).sum(2)
                ok = bound_passes(self.sizes[p][:, None], self.sizes[q][None, :], least) & open_
                for x in self.labels:
                    ok &= (x[p][:, None] != x[q][None, :]) | (x[p][:, None] == -1)
                if a is b:
                    ok = np.triu(ok, 1)
                i, j = np.nonzero(ok)
                if len(i):
                    yield p[i], q[j]


def leaf_pairs(bucket: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, labels: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``CountVectorTree.pairs`` finds in buckets of one leaf, for many sorted buckets of up
    to ``most`` points at once: point k meets points k + 1, k + 2, ... of its bucket."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, most):
        i = np.flatnonzero(bucket[:-d] == bucket[d:])
        for x in labels:
            i = i[(x[i] != x[i + d]) | (x[i] == -1)]
        i = i[sizes_pass(np.minimum(sizes[i], sizes[i + d]), np.maximum(sizes[i], sizes[i + d]))]
        i = i[bound_passes(sizes[i], sizes[i + d], np.minimum(vectors[i], vectors[i + d]).sum(1, dtype=np.int64))]
        left.append(i)
        right.append(i + d)
    return np.concatenate(left), np.concatenate(right)


def unite(part: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Gives the parts that the pairs connect their least number, in place."""
    while len(p):
        low = np.minimum(part[p], part[q])
        np.minimum.at(part, part[p], low)
        np.minimum.at(part, part[q], low)
        while not np.array_equal(part, up := part[part]):
            part[:] = up
        open_ = part[p] != part[q]
        p, q = p[open_], q[open_]


def clusters_of(points: DataFrame) -> DataFrame:
    """cluster, h1, component: the connected parts of the pairs of different components that
    pass the bound within a cell. A cluster is named by its members, so cells that hold the same
    one give it once.

    ``points``: cell, side, h1, component, before, n, vector. Points of one side other than -1
    don't meet. ``before`` is the next lesser bucket of the set: points that have it in common
    met there already. A task reads cell after cell: those of one leaf many at a time, each
    larger one as a tree of its own.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cell, h1, sizes, component = (np.asarray(table[c]) for c in ("cell", "h1", "n", "component"))
            labels = [component, np.unique(np.asarray(table["before"].fill_null(0)), return_inverse=True)[1], np.asarray(table["side"]).astype(np.int64)]
            labels[1][np.asarray(table["before"].is_null())] = -1
            wide = Vectors(table["vector"].combine_chunks(), sizes)
            vectors, part = wide.narrow(), np.arange(len(cell))

            def take(p: np.ndarray, q: np.ndarray) -> None:
                ok = bound_passes(sizes[p], sizes[q], wide.least(p, wide, q))
                unite(part, p[ok], q[ok])

            cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            counts = np.diff(cuts)
            small = np.flatnonzero(np.repeat(counts, counts) <= LEAF)
            p, q = leaf_pairs(cell[small], vectors[small], sizes[small], [x[small] for x in labels], int(counts[counts <= LEAF].max(initial=1)))
            take(small[p], small[q])
            for k in np.flatnonzero(counts > LEAF):
                lo, own = cuts[k], slice(cuts[k], cuts[k + 1])
                joined = np.arange(counts[k])  # the tree's view of ``part``
                for p, q in CountVectorTree(vectors[own], sizes[own], [x[own] for x in labels], joined).pairs():
                    first = np.concatenate([[True], p[1:] != p[:-1]])  # one pair a point mostly unites all
                    take(p[first] + lo, q[first] + lo)
                    rest = ~first & (part[p + lo] != part[q + lo])
                    take(p[rest] + lo, q[rest] + lo)
                    joined[:] = part[own] - lo
            members = np.flatnonzero(np.bincount(part, minlength=len(part))[part] > 1)
            sums = np.zeros(len(part), np.uint64)
            np.add.at(sums, part[members], mixed(h1[members].view(np.uint64), 21))
            yield pa.RecordBatch.from_arrays([pa.array(mixed(sums[part[members]], 22).view(np.int64)), pa.array(h1[members]), pa.array(component[members])], names=["cluster", "h1", "component"])

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.select("cell", "side", "h1", "component", "before", "n", "vector").repartition(parts, "cell").sortWithinPartitions("cell", "n", "h1")
    return dealt.mapInArrow(lean(rows), "cluster long, h1 long, component long").distinct()


def cluster_links(nodes: np.ndarray, component: np.ndarray, found: list[np.ndarray], text: list[bytes], spanning: bool) -> Iterator[tuple[int, int]]:
    """Pairs of nodes of one cluster that link; with ``spanning`` only those that connect what
    was not connected yet by components or by the links before."""
    sizes = np.array([len(f) for f in found])
    of = np.repeat(np.arange(len(found)), sizes)
    vectors = np.bincount(of * GROUPS + (np.concatenate(found) % np.uint64(GROUPS)).astype(np.int64), minlength=len(found) * GROUPS).reshape(-1, GROUPS)
    part = np.unique(component, return_inverse=True)[1] if spanning else np.arange(len(found))
    sets: dict[int, set] = {}

    def exact(k: int) -> set:
        if k not in sets:
            if len(sets) > LEAF:
                sets.clear()
            sets[k] = shingle_set(text[k])
        return sets[k]

    for p, q in CountVectorTree(vectors, sizes, [], part).pairs():
        for i, j in zip(p.tolist(), q.tolist()):
            if spanning and part[i] == part[j]:
                continue
            both = len(np.intersect1d(found[i], found[j], assume_unique=True))
            if DENOMINATOR * both >= NUMERATOR * (sizes[i] + sizes[j] - both) and links(exact(i), exact(j)):
                if spanning:
                    part[part == part[i]] = part[j]
                yield nodes[i], nodes[j]


def verified(clusters: DataFrame, classes: DataFrame, docs: DataFrame, spanning: bool = True) -> DataFrame:
    """Links (a, b: nodes) within the clusters, by the texts' exact sets. Pairs are chosen by
    their sets' 64-bit shingle hashes; one that links by these is compared word by word."""
    members = written(joined(clusters, classes.select("h1", "node", "doc_id", "mark"), "h1").select("cluster", "component", "node", "doc_id", "mark"), "members")
    needed = members.select("doc_id", "mark").distinct()
    texts = joined(packed_texts(docs), needed, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cluster"):
            cluster, node, component = (np.asarray(table[c]) for c in ("cluster", "node", "component"))
            text = unpack(table["packed"].combine_chunks())
            cuts = np.concatenate([[0], np.flatnonzero(cluster[1:] != cluster[:-1]) + 1, [len(cluster)]])
            hashes, offsets = set_hashes(as_texts(text))
            found = [hashes[lo:hi] for lo, hi in zip(offsets[:-1], offsets[1:])]
            pairs = [pair for lo, hi in zip(cuts[:-1], cuts[1:]) for pair in cluster_links(node[lo:hi], component[lo:hi], found[lo:hi], text[lo:hi], spanning)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = joined(members, texts, ["doc_id", "mark"]).select("cluster", "component", "node", "packed").repartition(parts, "cluster").sortWithinPartitions("cluster", "node")
    return dealt.mapInArrow(lean(rows, "powers"), "a long, b long").distinct()


def in_cells(points: DataFrame, weights: DataFrame, page: int) -> DataFrame:
    """cell and side for each point (``weights``: the written table of its column w): a bucket is a cell, but one of more than ``page`` shingles
    (column w) is cut into pages and each two pages that may hold a link are a cell."""
    plain = points.where(F.col("w") <= page).withColumns({"cell": F.col("bucket"), "side": F.lit(-1)})
    if weights.where(F.col("w") > page).isEmpty():
        return plain
    wide = points.where(F.col("w") > page)
    own = written(wide.groupBy("bucket", "component").agg(F.sum("n").alias("own")).where(F.col("own") > page), "wide")
    of = F.when(F.col("own").isNotNull(), F.col("component"))
    parts = F.ceil(F.coalesce("own", "w") / page)
    band = F.floor(F.log(F.col("n")) / float(np.log(BAND)))
    place = F.struct(band.alias("band"), of.alias("of"), F.pmod(F.xxhash64(F.when(F.col("own").isNull(), F.col("component")).otherwise(F.col("h1"))), parts).alias("page"))
    placed = wide.join(own, ["bucket", "component"], "left").withColumn("place", place).drop("own")
    pages = written(placed.select("bucket", "place").distinct(), "pages")
    near = (F.col("y.place.band") - F.col("x.place.band")).between(0, 1) & (F.col("x.place") <= F.col("y.place")) & F.coalesce(F.col("x.place.of") != F.col("y.place.of"), F.lit(True))
    pairs = written(pages.alias("x").join(pages.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & near).select("x.bucket", F.col("x.place").alias("p"), F.col("y.place").alias("q"), F.xxhash64("x.bucket", "x.place", "y.place").alias("cell")), "page-pairs")
    sides = pairs.select("bucket", "cell", F.explode(F.when(F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("place"), F.lit(-1).alias("side")))).otherwise(F.array(F.struct(F.col("p").alias("place"), F.lit(0).alias("side")), F.struct(F.col("q").alias("place"), F.lit(1).alias("side"))))).alias("s"))
    sides = sides.select("bucket", "cell", F.to_json("s.place").alias("place"), "s.side")
    cut = placed.withColumn("place", F.to_json("place")).join(sides, ["bucket", "place"]).drop("place")
    return plain.unionByName(cut)


def joined_in_trees(points: DataFrame, weights: DataFrame, classes: DataFrame, docs: DataFrame, page: int, spanning: bool = True) -> DataFrame:
    """Links (a, b: nodes) among ``points``: bucket, w, h1, component, before, n."""
    spark = docs.sparkSession
    cells = joined(in_cells(points, weights, page), classes.select("h1", "vector"), "h1")
    clusters = written(clusters_of(cells), "clusters")
    drop_shuffles(spark)
    found = written(verified(clusters, classes, docs, spanning), "links")
    forget(clusters)
    drop_shuffles(spark)
    return found


def shared_postings(docs: DataFrame) -> DataFrame:
    """bucket, h1 of the buckets that two sets or more share."""
    entries = written(postings(docs, counters(docs)), "postings")
    shared = written(entries.groupBy("bucket").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x != y").select("bucket"), "shared")
    drop_shuffles(docs.sparkSession)
    met = written(joined(entries, shared, "bucket").select("bucket", "h1").distinct(), "buckets")
    forget(entries, shared)
    drop_shuffles(docs.sparkSession)
    return met


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each row's set is (as ``set_features`` tells), and its classes: h1, h2, n, node (a
    number of its own), doc_id and mark of its least document, vector."""
    features = written(set_features(docs), "sets")
    known = features.where("doc_id is not null and n > 0")
    grouped = known.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "mark")).alias("least"), F.min("vector").alias("vector"))
    classes = grouped.select("h1", "h2", "n", F.monotonically_increasing_id().alias("node"), "least.doc_id", "least.mark", "vector")
    return features, written(classes, "classes")  # written, so a node's number stays


def open_points(met: DataFrame, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """bucket, w (its shingles), h1, component, before, n in the buckets that hold several
    components; and the table of these buckets and w."""
    labels = written(joined(met, labelled, "h1"), "bucket-labels")
    held = written(labels.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.sum("n").alias("w")).where("x != y").select("bucket", "w"), "mixed")
    before = F.lag("bucket").over(Window.partitionBy("h1").orderBy("bucket"))  # a partition is a part of one set's prefix
    return joined(labels, held, "bucket").withColumn("before", before), held


def near_duplicate_rows(docs: DataFrame, page: int = PAGE) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, leads for each row; see ``near_duplicates``.
    mark: xxhash64 of the text. leads: the row's id and mark are the least of its group."""
    spark = docs.sparkSession
    docs = marked(docs)
    features, classes = classes_of(docs)
    usable = docs.where("doc_id is not null")
    met = shared_postings(usable)

    labelled = classes.select("h1", "n", F.col("node").alias("component"))
    first = F.row_number().over(Window.partitionBy("h1").orderBy("bucket"))  # a partition is a part of one set's prefix
    chosen = met.withColumn("r", first).where(F.col("r") <= FIRST_BUCKETS).drop("r")
    chosen = written(joined(chosen, labelled, "h1").withColumn("before", F.lit(None).cast("long")), "first")
    weights = written(chosen.groupBy("bucket").agg(F.sum("n").alias("w"), F.count("*").alias("m")).where("m > 1").drop("m"), "weights")
    found = joined_in_trees(joined(chosen, weights, "bucket"), weights, classes, usable, page)
    drop_shuffles(spark)

    settled = components(found)
    labelled = written(joined(classes.select("h1", "n", "node"), settled, "node", "left").select("h1", "n", F.coalesce("component", "node").alias("component")), "labels")
    rest = joined_in_trees(*open_points(met, labelled), classes, usable, page)
    forget(met, labelled, chosen, weights)
    stars = settled.select(F.col("node").alias("a"), F.col("component").alias("b"))  # as connected as the links they come from
    merged = settled if rest.isEmpty() else components(stars.unionByName(rest))

    of_class = joined(classes.select("h1", "h2", "n", "node", F.struct("doc_id", "mark").alias("least")), merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_class = written(of_class.select("h1", "h2", "n", "component", "least"), "of-class")
    leads = written(of_class.groupBy("component").agg(F.min("least").alias("lead")), "leads")
    named = written(joined(of_class, leads, "component").select("h1", "h2", "n", "lead"), "named")
    known = joined(features.where("doc_id is not null and n > 0"), named, ["h1", "h2", "n"])
    lead = (F.col("doc_id") == F.col("lead.doc_id")) & (F.col("mark") == F.col("lead.mark"))
    placed = known.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("lead.doc_id").alias("component_id"), lead.alias("leads"))
    alone = features.where("doc_id is null or n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("leads"))
    return placed.unionByName(alone)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row.

    Null, empty and wordless texts have an empty set and link with nothing. Rows with a null id
    are compared with nothing and have a null component. Of rows that repeat an id each has the
    component of its own text: equal ids alone are no link, and different texts under one id
    may be in different groups. Very long texts are one set each, whole. Columns other than
    doc_id and text are left out, so no name clashes. No rows in, no rows out.
    """
    return near_duplicate_rows(docs).select("doc_id", "n_shingles", "component_id")


def linked_pairs(docs: DataFrame, page: int = PAGE) -> tuple[DataFrame, DataFrame]:
    """All links: pairs (a, b) of nodes of different sets that link, and the members of each
    node (node, doc_id, mark). The pairs are as many as there are links, so a large group of
    near copies has many; ``near_duplicates`` needs only enough of them to connect it.
    """
    docs = marked(docs)
    features, classes = classes_of(docs)
    usable = docs.where("doc_id is not null")
    points, weights = open_points(shared_postings(usable), classes.select("h1", "n", F.col("node").alias("component")))
    members = joined(features.where("doc_id is not null and n > 0"), classes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"]).select("node", "doc_id", "mark")
    found = joined_in_trees(points, weights, classes, usable, page, spanning=False)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), members
