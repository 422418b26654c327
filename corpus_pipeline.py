"""Documents to packed training sequences: language, quality, near duplicates, repeated
spans, packing. Each stage is written as Parquet and read again as the next one's input.

Rows keep the columns of ``documents`` and any others up to the last stage, whatever their
names. Null, empty and letterless texts have no language and go in the first stage. Rows with a
null id pass the stages that compare documents unchanged. Rows that are equal in every column
count once from the near-duplicate stage on. Very long texts are read whole by every stage.
Without labels no text scores under the threshold and all stay. No rows in, no rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import langid, ngram_join, packing, quality, substring
from weft.llm.common import new_path, ready
from weft.llm.queries import table, vocabulary


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ..., which clash with nothing an operator adds, and the
    new name of each old one."""
    new = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*new), dict(zip(docs.columns, new))


def back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(new).alias(old) for old, new in names.items()))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised by a clear margin."""
    ready(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    dictionaries = langid.learn(rows, langid.in_training(F.col("doc_id")))
    plain, names = renamed(docs)
    found = langid.classify_texts(plain, dictionaries, plain.columns, text=names["text"])
    return back(found.where("not rejected"), names)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ready(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    plain, names = renamed(docs)
    return back(quality.score_texts(plain, model, plain.columns, text=names["text"]).where(F.col("score") >= quality.THRESHOLD), names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every group of near duplicates; of several texts under that id
    one, by the text's hash. Texts under one id that don't link are different documents."""
    ready(spark)
    leads = ngram_join.near_duplicate_rows(docs).where("leads").select("doc_id", "mark").distinct()
    plain, names = renamed(docs)
    i, mark = F.col(names["doc_id"]), F.xxhash64(F.coalesce(F.col(names["text"]).cast("string"), F.lit("")))
    kept = plain.join(leads, (i.cast("long") == F.col("doc_id")) & (mark == F.col("mark")), "left_semi").dropDuplicates()
    return back(kept.unionByName(plain.where(i.isNull())), names)


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the words of spans that begin earlier; n_chars follows. A null text becomes empty."""
    ready(spark)
    plain, names = renamed(docs)
    rest = [new for old, new in names.items() if old not in ("doc_id", "text")]
    cut = substring.without_repeats(plain.withColumnsRenamed({names["doc_id"]: "doc_id", names["text"]: "text"}), rest)
    kinds = dict(docs.dtypes)
    return cut.select(*(F.col(old if old in ("doc_id", "text") else new).alias(old) if old != "n_chars" else F.length("text").cast(kinds[old]).alias(old) for old, new in names.items()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and place of every piece of the documents' tokens."""
    ready(spark)
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language_id", known_language),
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeated_spans),
    ("best_fit_packing", packed),
]

#: SQL can express neither the compression nor the tokenizer; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
