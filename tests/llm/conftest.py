import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 7001}" for i in range(30_000))
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty twenty-one"
    return [
        (5, "The cat sat on the mat.\nIt slept there all day long.", "en", "a", 50),
        (5, "The cat sat on the mat.\nIt slept there all day long.", "en", "a", 50),
        (7, None, None, None, None),
        (8, "", "en", None, 0),
        (9, " \t\n ", None, "a", 4),
        (10, long, "en", "b", len(long)),
        (11, long, "en", "b", len(long)),
        (12, line, "en", "b", len(line)),
        (13, f"Before {line} after", "en", None, None),
        (14, "GNU General Public License, MIT license; SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause", "en", "b", 9),
        (None, "a row without an id " * 9, "en", "b", 9),
        (None, None, None, None, None),
        (15, "Ünïcödé ʼtext’ 日本語 <|endoftext|> 🙂 don't", "fr", "c", 9),
        (16, "### $$$ ***" * 50, "en", "c", 9),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    """With more columns, named like what the operators add."""
    from pyspark.sql import functions as F

    names = ["score", "n_words", "mark", "packed", "sequence_id", "offset", "n", "h1", "h2", "vector", "bucket", "start", "length", "labels", "kept", "print", "next", "_text", "features", "shard", "value", "component_id", "lang_pred", "piece", "c0", "rejected", "fence"]
    return odd.withColumns({c: F.lit(None).cast("string") for c in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
