"""Every stage against a brute-force version of its decision on its own input."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weft.llm import langid, packing, quality
from weft.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """name -> (input, output), each written."""
    from weft.llm.common import written

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, sf_dir), "test")
        out[name] = (docs, made)
        docs = made
    return out


def as_dict(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for name, (_, made) in list(stages.items())[:-1]:
        assert made.columns == COLUMNS, name


def test_language_stage(stages):
    docs, made = stages["language_id"]
    model = langid.Classifier(langid.learn(docs, langid.in_training(F.col("doc_id"))))
    want = {i for i, r in as_dict(docs).items() if (found := model.classify(r.text))[0] != "und" and found[2] >= langid.MARGIN}
    got = as_dict(made)
    assert set(got) == want and len(want) > 0.9 * docs.count()
    assert all(tuple(r) == tuple(as_dict(docs)[i]) for i, r in list(got.items())[:3])


def test_quality_stage(spark, sf_dir, stages):
    import zstandard

    docs, made = stages["quality_classifier"]
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    compressor = zstandard.ZstdCompressor(1)
    want = {i for i, r in as_dict(docs).items() if model.score([quality.features(r.text, compressor)])[0] >= 0.3}
    assert set(as_dict(made)) == want


def test_near_duplicate_stage(stages):
    docs, made = stages["ngram_jaccard_join"]
    found = brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])
    assert set(as_dict(made)) == {i for i, _, c in found if i == c}


def test_span_stage(stages):
    docs, made = stages["substring_dedup"]
    before, after = as_dict(docs), as_dict(made)
    want = brute.without_repeats([(i, r.text) for i, r in before.items()])
    assert set(before) == set(after)
    for i, _, removed, _ in want:
        assert (after[i].text == before[i].text) == (removed == 0)
        assert after[i].n_chars == len(after[i].text) and after[i].lang == before[i].lang
        assert len(brute.words(before[i].text)) - len(brute.words(after[i].text)) == removed


def test_packing_stage(spark, sf_dir, stages):
    docs, made = stages["best_fit_packing"]
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = packing.token_pieces(docs, vocabulary(), 4096, 1).select(key).collect()
    assert sorted(map(tuple, made.select(key).collect())) == sorted(map(tuple, want))
    assert made.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_near_duplicate_stage_keeps_other_texts_under_a_repeated_id(spark, sf_dir):
    base, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"x{k}" for k in range(40))
    rows = [(1, base, "en", "a", 1), (2, other, "en", "a", 1), (2, base + " tail", "en", "b", 2), (3, other, "en", "a", 1), (3, "alone " * 9, None, None, None)]
    made = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), sf_dir)
    assert sorted(map(tuple, made.collect()), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)


def test_run(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages["best_fit_packing"][1].count()


def test_odd_rows_pass_through(spark, sf_dir, clashing, empty):
    for first in (clashing, empty):
        docs = first
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, sf_dir)
            if name != "best_fit_packing":
                assert made.columns == first.columns
            made.count()
            docs = made
