"""Language identification by compression.

Each language has a raw-content zstandard dictionary: normalised text of a bounded
sample of its labelled documents. A text is cut into blocks, every block is compressed
with every language's dictionary, and the language with the smallest sum of sizes wins.
Blocks keep a long text from being matched with itself rather than with the dictionary;
all blocks of the whole text count. Where the second language is nearly as small (a
narrow margin) the document is rejected.

The sample: ``docs_per_lang`` documents a language by least hash of the id, and of each whole
normalised text ``bytes_per_doc`` bytes at a place that the hash chooses. The languages are the
``most_languages`` with most labelled rows. So a model has a fixed size at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import id_and_text, id_remainder, lean, with_text

UNKNOWN = "und"
DOCS_PER_LANG, BYTES_PER_DOC, MOST_LANGUAGES = 256, 512, 256
BLOCK_BYTES, LEVEL = 1024, 12
#: The least share by which the second smallest must exceed the smallest.
MARGIN = 0.01
SHARPNESS = 60.0

_ASCII = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    """Lower case, ASCII other than letters taken for white space, single spaces."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_ASCII).split())


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def piece_of(text: str, h: int, size: int) -> bytes:
    """``size`` bytes of the whole normalised text, at a place that ``h`` chooses."""
    data = normalised(text)
    at = h % max(1, len(data) - size + 1)
    return data[at : at + size]


def learn(docs: DataFrame, use: Column, docs_per_lang: int = DOCS_PER_LANG, bytes_per_doc: int = BYTES_PER_DOC, most_languages: int = MOST_LANGUAGES) -> dict[str, bytes]:
    """Dictionaries by language from the rows where ``use`` holds and text and lang are known.

    A language's rows are thinned by a hash of their id to about three times the bound
    before they are ranked, so no task ranks a whole language.
    """
    usable = docs.where(use).where("text is not null and lang is not null")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    shares = counts.select("lang", (F.least(F.lit(1.0), 3 * docs_per_lang / F.col("n")) * (1 << 30)).alias("share"))
    h = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30))
    thinned = usable.withColumn("h", h).join(F.broadcast(shares), "lang").where(F.col("h") <= F.col("share"))  # at most ``most_languages`` rows

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [piece_of(t.as_py(), x, bytes_per_doc) for t, x in zip(batch.column(3), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], names=["lang", "h", "doc_id", "piece"])

    cut = thinned.select("lang", "h", "doc_id", "text").mapInArrow(lean(pieces), "lang string, h long, doc_id long, piece binary")
    ranked = cut.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "piece"))).where(F.col("r") <= docs_per_lang)
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for r in ranked.collect():  # at most docs_per_lang rows a language
        parts.setdefault(r["lang"], []).append((r["r"], bytes(r["piece"])))
    return {lang: b" ".join(t for _, t in sorted(found)).ljust(64) for lang, found in sorted(parts.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = normalised(text)
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; ``und`` with 0, 0 for null, no letter or no model."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        best = sizes[order[0]]
        score = 1 / sum(math.exp(-SHARPNESS * (s - best) / max(best, 1)) for s in sizes)
        margin = 1.0 if len(sizes) == 1 else (sizes[order[1]] - best) / max(sizes[order[1]], 1)
        return self.languages[order[0]], score, margin


def classify_texts(docs: DataFrame, dictionaries: dict[str, bytes], columns: list[str], margin: float = MARGIN, text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` with lang_pred, score, margin and rejected for each whole text."""
    added = {"lang_pred": pa.string(), "score": pa.float64(), "margin": pa.float64(), "rejected": pa.bool_()}
    chosen, at = with_text(docs, columns, text)
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double").add("margin", "double").add("rejected", "boolean")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries)
        for batch in batches:
            found = [(lang, score, m, lang == UNKNOWN or m < margin) for lang, score, m in (model.classify(t.as_py()) for t in batch.column(at))]
            arrays = [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 4, added.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *arrays], names=[*columns, *added])

    return chosen.mapInArrow(lean(rows), schema)


def in_training(doc_id: Column) -> Column:
    return id_remainder(doc_id, 4) != 2


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, margin, rejected; learned from the rows not held out.

    Null, empty and letterless texts are ``und`` with score 0 and rejected. A very long text is
    compressed block by block, all of it. Rows with a null id count as held out; repeated rows
    are predicted each. Without any labelled row every document is ``und``. Ties go to the
    language first in code-point order, with margin 0, and are rejected. Columns other than
    doc_id, text and lang are left out, so no name clashes. No rows in, no rows out.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    dictionaries = learn(rows, in_training(F.col("doc_id")))
    found = classify_texts(id_and_text(docs), dictionaries, ["doc_id"])
    return found.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(True)).alias("held_out"), "lang_pred", "score", "margin", "rejected")
