"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned. Boosting goes round the features in a cycle; each step
fits a shallow tree (up to four leaves) of one feature to the log loss's gradient and
adds its leaves to that feature's lookup table. Then the pairs that explain most of what
is left are boosted in the same way, each step cutting both features once. A score is
the logistic function of a sum of table entries, one for each feature and pair: a few
vectorised additions for a batch.

Features look at the text alone. The model is fitted on the driver, on at most
``MOST_ROWS`` labelled rows (those with the least hash of their id).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from weft.llm.common import id_and_text, id_remainder, lean, with_text

MOST_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = [
    "log_words", "chars_per_word", "upper", "symbols", "punctuation", "exclamations", "digits", "non_ascii", "white", "distinct_words", "repeated_next", "top_word", "lines_per_word", "dup_lines", "punctuated_words", "compressed",
]

_CLASSES = np.zeros((256, 7))
for _k, _bytes in enumerate((range(65, 91), b"#*$%&|<>@^~_=+\\{}[]", b".,;:'\"()-?", b"!", range(48, 58), range(128, 256), b" \t\n\x0b\x0c\r")):
    _CLASSES[list(_bytes), _k] = 1


def features(text: str | None, compressor: zstandard.ZstdCompressor) -> list[float]:
    """The features of a whole text; null and empty texts have zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * len(FEATURES)
    upper, symbols, punctuation, exclamations, digits, other, white = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / len(data)
    words = data.split()
    n = max(1, len(words))
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    ended = sum(w[-1] in b"#*$%&|!.,;:?" for w in words)
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / n, upper, symbols, punctuation, exclamations, digits, other, white, len(count) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, max(count.values(), default=0) / n, len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)), ended / n, len(compressor.compress(data)) / len(data),
    ]


class AdditiveModel:
    """Lookup tables a feature and a pair of features."""

    def __init__(self, bins: int = 32, rounds: int = 150, pairs: int = 8, pair_rounds: int = 60, rate: float = 0.15, ridge: float = 1.0):
        self.bins, self.rounds, self.n_pairs, self.pair_rounds, self.rate, self.ridge = bins, rounds, pairs, pair_rounds, rate, ridge
        self.cuts: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        self.start = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], 1) if len(self.cuts) else np.zeros((len(x), 0), np.int64)

    def raw(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.start)
        for k, t in enumerate(self.tables):
            out += t[b[:, k]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.binned(np.asarray(x, float).reshape(len(x), -1))), -30, 30)))

    def _gain(self, g, h):
        return g * g / (h + self.ridge)

    def _best_cut(self, g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
        """Gain and place of the best cut of bins into [0, place) and [place, end)."""
        if len(g) < 2:
            return 0.0, 0
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = self._gain(gl, hl) + self._gain(g.sum() - gl, h.sum() - hl) - self._gain(g.sum(), h.sum())
        k = int(np.argmax(gains))
        return float(gains[k]), k + 1

    def _tree(self, g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
        """Leaf values by bin of a tree grown best gain first."""
        cuts = [0, len(g)]
        while len(cuts) <= leaves:
            found = [(gain, a + k) for a, b in zip(cuts, cuts[1:]) for gain, k in [self._best_cut(g[a:b], h[a:b])] if gain > 1e-9]
            if not found:
                break
            cuts = sorted([*cuts, max(found)[1]])
        out = np.zeros(len(g))
        for a, b in zip(cuts, cuts[1:]):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + self.ridge)
        return out

    def _quadrants(self, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """The best tree that cuts both features once, with a second-feature cut of its own on either side."""
        best, out = 0.0, np.zeros_like(g)
        for a in range(1, len(g)):
            gain, values = 0.0, np.zeros_like(g)
            for rows in (slice(0, a), slice(a, len(g))):
                gs, hs = g[rows].sum(0), h[rows].sum(0)
                more, k = self._best_cut(gs, hs)
                gain += more + self._gain(gs.sum(), hs.sum())
                for columns in (slice(0, k), slice(k, len(gs))):
                    values[rows, columns] = gs[columns].sum() / (hs[columns].sum() + self.ridge)
            if gain > best:
                best, out = gain, values
        return best - float(self._gain(g.sum(), h.sum())), out

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """With no rows scores are 0.5; with one class only, close to it."""
        if not len(x):
            return self
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = self.binned(x)
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.start = float(np.log(rate / (1 - rate)))
        sizes = [len(c) + 1 for c in self.cuts]
        self.tables = [np.zeros(n) for n in sizes]
        f = np.full(len(y), self.start)

        def gradient() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for k, n in enumerate(sizes):
                g, h = gradient()
                step = self.rate * self._tree(np.bincount(b[:, k], g, n), np.bincount(b[:, k], h, n))
                self.tables[k] += step
                f += step[b[:, k]]

        def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
            g, h = gradient()
            at, n = b[:, i] * sizes[j] + b[:, j], sizes[i] * sizes[j]
            return np.bincount(at, g, n).reshape(sizes[i], sizes[j]), np.bincount(at, h, n).reshape(sizes[i], sizes[j])

        ranked = sorted(((self._quadrants(*sums(i, j))[0], (i, j)) for i, j in combinations(range(len(sizes)), 2)), reverse=True)
        self.pairs = [p for gain, p in ranked[: self.n_pairs] if gain > 0]
        self.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in self.pairs]
        for _ in range(self.pair_rounds):
            for (i, j), table in zip(self.pairs, self.pair_tables):
                step = self.rate * self._quadrants(*sums(i, j))[1]
                table += step
                f += step[b[:, i], b[:, j]]
        return self


def text_features(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and features (array of double) of each whole text."""
    chosen, at = with_text(docs, columns, "text")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(1)
        for batch in batches:
            found = [features(t.as_py(), compressor) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(found, pa.list_(pa.float64()))], names=[*columns, "features"])

    return chosen.mapInArrow(lean(rows), docs.select(*columns).schema.add("features", ArrayType(DoubleType())))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> AdditiveModel:
    """Fits on labelled rows that are not held out. The sample is at most ``most_rows`` ids and
    labels, so it may be broadcast; each row of ``docs`` with such an id is used (the first
    ``2 * most_rows`` by id and features where ids repeat)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(most_rows)
    rows = text_features(id_and_text(docs).join(F.broadcast(sample), "doc_id"), ["doc_id", "quality"])
    found = rows.orderBy("doc_id", "features").limit(2 * most_rows).collect()
    return AdditiveModel().fit(np.array([r["features"] for r in found]), np.array([r["quality"] for r in found]))


def held_out(doc_id):
    return id_remainder(doc_id, 5) == 0


def score_texts(docs: DataFrame, model: AdditiveModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and score for each whole text."""
    chosen, at = with_text(docs, columns, text)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(1)
        for batch in batches:
            x = np.array([features(t.as_py(), compressor) for t in batch.column(at)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(model.score(x), pa.float64())], names=[*columns, "score"])

    return chosen.mapInArrow(lean(rows), docs.select(*columns).schema.add("score", "double"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.3).

    Null text is scored as the empty one; a very long text is read whole, in one task. Rows
    with a null id count as held out. Without labels every score is 0.5. Repeated rows are scored
    each. Of two labels on one id the greater counts; labels other than 0 and 1 don't. Columns
    other than doc_id and text are left out, so no name clashes. No rows in, no rows out.
    """
    scored = score_texts(id_and_text(docs), train(docs, labels), ["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(True)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
