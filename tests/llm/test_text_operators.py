import hashlib
import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weft.llm import bpe_trie, fingerprint, langid, license, packing, quality, rules, sstable
from weft.llm.common import new_path
from weft.llm.tokens import library_encoder


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


ODD_TEXTS = [
    "", "  ", "Hello, wörld! <|endoftext|> it's 42 İ x́  ", "ΑΣ ΣΑΣ. ὈΔΥΣΣΕΎΣ, don't 'street !'s a.'s b,'t x'RE", "日本語テスト。한국어 한 é, á. ́b", "a\x0bb\x0cc\x1cd\x85e\xa0f g​h",
    "<|startoftext|>x<|endoftext|><|endoftext|", "🙂🙂 🙂, 12.5 ½ Ⅷ ²x", "word.,!?x.y z", "ſ K Å ǅ ß ẞ.", "don't.' 's 'll' rock'n'roll'", "x" * 5000, "THE!!\tTHE!!\r\nthe", "naïve,café. Ÿ Ā, ẹ́, ﬁ",
]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoders_equal_the_library(tokenizer, vocabulary, rows):
    texts = ODD_TEXTS + [t for _, t in rows]
    want = [ids_of(tokenizer, t) for t in texts]
    array = pa.array([*texts, None])
    assert [ids.tolist() for _, ids in library_encoder(vocabulary).encode(array)] == [*want, []]
    got = list(bpe_trie.codec(vocabulary).texts.encode_and_decode(array))
    assert [ids.tolist() for ids, _ in got] == [*want, []]
    assert [d.decode() for _, d in got] == [tokenizer.decode(i, skip_special_tokens=False) for i in [*want, []]]


def mixed_scripts(n, seed=11):
    """Texts of characters of many scripts, marks and cases, spaces and punctuation."""
    r = np.random.default_rng(seed)
    blocks = [(0x21, 0x7F), (0x61, 0x7B), (0xA1, 0x180), (0x130, 0x132), (0x1C4, 0x1F0), (0x300, 0x36F), (0x370, 0x3FF), (0x400, 0x4FF), (0x5D0, 0x5EA), (0x620, 0x650), (0x915, 0x950), (0x1E00, 0x1FFF), (0x2010, 0x2030), (0x2160, 0x2188), (0x4E00, 0x4E40), (0xAC00, 0xAC40), (0x1F600, 0x1F640)]
    out = []
    for _ in range(n):
        chars = []
        for _ in range(r.integers(1, 24)):
            kind = r.random()
            lo, hi = blocks[r.integers(len(blocks))]
            chars.append(" " if kind < 0.1 else ".,!?'-#\""[r.integers(8)] if kind < 0.35 else chr(r.integers(lo, hi)))
        out.append("".join(chars))
    return out


def test_encoders_equal_the_library_on_mixed_scripts(tokenizer, vocabulary):
    texts = ["İ.", "xİ! İ,y", "ﬁİ.'s", "I\u0307.", "ẞ.", "ǰ.", "ΐ,", *mixed_scripts(6000)]
    want = [ids_of(tokenizer, t) for t in texts]
    array = pa.array(texts)
    assert [ids.tolist() for _, ids in library_encoder(vocabulary).encode(array)] == want
    got = list(bpe_trie.codec(vocabulary).texts.encode_and_decode(array))
    assert [ids.tolist() for ids, _ in got] == want
    assert [d.decode() for _, d in got] == [tokenizer.decode(i, skip_special_tokens=False) for i in want]


def test_trie_query(documents, odd, clashing, empty, tokenizer, vocabulary, odd_rows, rows):
    def want(doc_id, text):
        ids = ids_of(tokenizer, text)
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    for df, known in ((documents, rows), (clashing, [r[:2] for r in odd_rows]), (empty, [])):
        assert sorted(map(tuple, bpe_trie.encode_documents(df, vocabulary).collect()), key=str) == sorted((want(*r) for r in known), key=str)
    out = bpe_trie.encode_documents(odd, vocabulary, with_output=True).where("doc_id = 5").first()
    assert np.frombuffer(out.ids, "<u4").tolist() == ids_of(tokenizer, odd_rows[0][1]) and out.decoded.startswith("the</w> cat</w>")


@pytest.mark.parametrize("kind", ["documents", "clashing", "empty"])
def test_shards_give_back_what_was_written(request, spark, kind, tokenizer, vocabulary):
    df = request.getfixturevalue(kind)
    known = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    shards = sstable.write_shards(df, vocabulary, new_path(spark, "sst"))
    got = sorted(sstable.read_shards(spark, shards, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in known]
    before = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), zlib.crc32(r.ids))
        before += len(ids)
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got if r.doc_id is not None) == sorted((i, [*ids_of(tokenizer, t), 2]) for i, t in known if i is not None)
    for uri, _, _ in shards[:2]:
        shard = sstable.Shard(uri)
        keys = [sstable.key_id(k) for b in range(shard.n_blocks) for k, _ in shard.entries_of(b)]
        first = keys[len(keys) // 2]
        assert shard.get(first).tolist() in [[*ids_of(tokenizer, t), 2] for i, t in known if i == first]
        assert shard.get(1 << 50) is None


@pytest.mark.parametrize("kind", ["documents", "clashing", "empty"])
def test_packing(request, kind, tokenizer, vocabulary):
    df = request.getfixturevalue(kind)
    got = packing.pack_documents(df, vocabulary).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    for r in df.collect():
        ids = np.array([*ids_of(tokenizer, r.text), 1], "<u4")
        want = [(k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
        own = {(p.piece, p.start, p.length, p.ids_crc32) for p in by_doc[r.doc_id]}
        assert set(want) <= own
    if got:
        assert len(by_sequence) <= 1.02 * sum(r.length for r in got) / 4096 + 2


def test_sequences_hold_the_ids(documents, tokenizer, vocabulary):
    packed = packing.pack_documents(documents, vocabulary).cache()
    made = packing.sequences(documents, packed, vocabulary)
    assert made.agg(F.sum("n_tokens")).first()[0] == packed.agg(F.sum("length")).first()[0]
    one = made.first()
    assert len(one.ids) == 4 * one.n_tokens


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.add(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.BestFit(10, 2)
    assert [bins.add(n) for n in (6, 7, 8, 2, 3)] == [(0, 0), (1, 0), (2, 0), (2, 8), (0, 6)]  # bin 1 closed when 2 opened


def test_best_fit_equals_a_plain_version():
    """Against a list of open bins that is searched from end to end."""
    r = np.random.default_rng(3)
    for most_open in (1, 5, 40):
        bins, open_bins, n = packing.BestFit(100, most_open), [], 0  # open: (free, number), the latest last
        for length in r.integers(1, 101, 2000).tolist():
            fitting = [b for b in open_bins if b[0] >= length]
            if fitting:
                least = min(b[0] for b in fitting)
                free, number = [b for b in fitting if b[0] == least][-1]
                open_bins.remove((free, number))
            else:
                free, number, n = 100, n, n + 1
            assert bins.add(length) == (number, 100 - free)
            if free > length:
                if len(open_bins) == most_open:
                    least = min(b[0] for b in open_bins)
                    open_bins.remove([b for b in open_bins if b[0] == least][-1])
                open_bins.append((free - length, number))


def test_hot_ids_are_dealt_over_all_partitions(spark):
    items = spark.createDataFrame([(None if k % 3 else 7, 0, k % 50 + 1) for k in range(3000)], "doc_id long, piece int, length long")
    got = packing.pack(items, 100, items_per_partition=300)
    assert got.groupBy(F.shiftright("sequence_id", 40).alias("p")).count().count() == 10
    assert got.count() == 3000 and got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 100").count() == 0


@pytest.mark.parametrize("kind", ["lognormal", "uniform"])
def test_packing_stays_tight_on_large_tables(spark, kind):
    r = np.random.default_rng(5)
    lengths = np.clip(r.lognormal(6, 1, 300_000), 1, 4096).astype(int) if kind == "lognormal" else r.integers(1, 4097, 300_000)
    items = spark.createDataFrame(pa.table({"doc_id": np.arange(len(lengths)), "piece": np.zeros(len(lengths), np.int32), "length": lengths}))
    by_sequence = packing.pack(items, 4096).groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.count("*").alias("sequences"), F.sum("n").alias("total"), F.max("n").alias("most")).first()
    assert by_sequence.total == lengths.sum() and by_sequence.most <= 4096
    assert by_sequence.sequences <= 1.01 * max(lengths.sum() / 4096, (lengths > 2048).sum())


def edited(rows):
    """(doc_id, n_chars, sha256) by doc_id order, for distinct ids."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for k, (i, t) in enumerate(rows):
        q = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - q] + rows[(k + 1) % len(rows)][1][:q]).encode()).hexdigest()))
    return out


def test_fingerprints(documents, clashing, empty, odd_rows, rows):
    got = fingerprint.fingerprint_documents(documents).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == edited(rows)
    by_text = defaultdict(set)
    text = dict(rows)
    for r in got:
        by_text[text[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(f) == 1 for f in by_text.values())
    assert len({next(iter(f)) for f in by_text.values()}) == len(by_text)
    longer = [r for r in got if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in longer]) > 0.97
    assert abs(np.mean([r.near_edited for r in longer]) - 0.72) < 0.08
    odd = fingerprint.fingerprint_documents(clashing).collect()
    assert len(odd) == len(odd_rows)
    assert sorted({(r.doc_id, r.n_chars, r.edited_sha256) for r in odd if r.doc_id is not None}) == edited({r[:2] for r in odd_rows if r[0] is not None})
    assert fingerprint.fingerprint_documents(empty).count() == 0


def test_fingerprint_is_a_sum_over_paragraphs(spark):
    """Permutation, insertion and deletion of paragraphs, on the whole fingerprint."""
    long = " ".join(f"w{k}" for k in range(300))
    parts = ["one two three four", "x", "", long, "日本語のテキスト", "five six seven", "x"]
    texts = ["\n".join(parts), "\n".join(parts[::-1]), "\n".join(parts[2:] + parts[:2]), *parts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("p", fingerprint.vector(F.col("text")))
    prints = {r.i: (r.s, r.p) for r in df.select("i", fingerprint.as_string(F.col("p")).alias("s"), "p").collect()}
    kind = df.schema["p"].dataType.simpleString()

    def combined(x, y, sign=1):
        pair = spark.createDataFrame([(x, y)], f"x {kind}, y {kind}").select(fingerprint.combine(F.col("x"), F.col("y"), sign).alias("p"))
        return pair.select(fingerprint.as_string(F.col("p")).alias("s"), "p").first()

    assert len({prints[i][0] for i in (0, 1, 2)}) == 1
    made = (None, prints[3][1])
    for i in range(4, 3 + len(parts)):
        made = combined(made[1], prints[i][1])
    assert made[0] == prints[0][0]
    rest = spark.createDataFrame([("\n".join(parts[:3] + parts[4:]),)], "text string").select(fingerprint.as_string(fingerprint.vector(F.col("text")))).first()[0]
    assert combined(prints[0][1], prints[6][1], -1)[0] == rest != prints[0][0]


def test_short_texts_keep_their_likeness(spark):
    r = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in r.integers(0, 5000, n)) for n in np.tile(np.arange(5, 51), 8)]
    texts += ["".join(chr(0x4E00 + k) for k in r.integers(0, 3000, n)) for n in range(20, 80, 5)]  # no spaces
    data = list(enumerate(texts))
    got = sorted(fingerprint.fingerprint_documents(spark.createDataFrame(data, "doc_id long, text string")).collect())
    sizes = [len(t.split()) if " " in t else len(t) for t in texts]
    assert all(g.near_edited > g.near_next for g, n in zip(got, sizes) if n >= 10)
    assert np.mean([g.near_edited > g.near_next for g in got]) > 0.97
    assert np.mean([g.near_edited < 0.3 for g, n in zip(got, sizes) if 10 <= n < 20]) < 0.05


def test_short_documents_keep_their_likeness(spark, rows):
    """Texts under 100 characters: of the table, and made ones of several paragraphs."""
    r = np.random.default_rng(4)
    made = ["\n".join(" ".join(f"w{k}" for k in r.integers(0, 900, 5)) for _ in range(4))[:99] for _ in range(60)]
    texts = [t for _, t in rows if t and 40 <= len(t) < 100 and len(set(t.split())) > 5] + made
    got = fingerprint.fingerprint_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert np.mean([g.near_edited > g.near_next for g in got]) > 0.95
    assert np.mean([g.near_edited for g in got]) > 0.5


def test_lanes_hold_the_counts_of_very_long_texts(spark):
    df = spark.createDataFrame([("\n",), ("x\n",)], "t string").select("t", fingerprint.vector(F.expr("repeat(t, 1100000)")).alias("p")).cache()
    pair = df.alias("x").join(df.alias("y"), F.col("x.t") < F.col("y.t"))
    assert pair.select(fingerprint.likeness(F.col("x.p"), F.col("y.p"))).first()[0] < 0.5
    df.unpersist()


def test_rules_base_counts(documents, clashing, empty, odd_rows, rows):
    for df, known in ((documents, rows), (clashing, [r[:2] for r in odd_rows]), (empty, [])):
        got = rules.apply_rules(df).collect()
        want = [(i, *brute.base_counts(t)) for i, t in known]
        assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == sorted(want, key=str)
        for r in got:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_rules_keep_clean_documents_and_drop_junk(documents, rows):
    kept = {r.doc_id: r.kept for r in rules.apply_rules(documents).collect()}
    junk = [i for i, t in rows if len(re.findall(r"[#$%&*|]", t)) > 0.5 * len(t.split()) or sum(c.isupper() for c in t) > 0.5 * len(t)]
    clean = [i for i, t in rows if i not in junk and not re.search(r"[#$%&*|<>]", t) and len(t.split()) >= 20 and brute.base_counts(t)[4] == 0 and brute.base_counts(t)[3] == 0]
    assert junk and clean
    assert np.mean([not kept[i] for i in junk]) > 0.9
    assert np.mean([kept[i] for i in clean]) > 0.98


def test_rules_verdict_equals_exact_quantiles(documents):
    """``kept`` against fences from exact quantiles, but for rows within a sketch's error of a fence."""
    measured = rules.measured(documents.select("doc_id", "text", "lang", "source")).toPandas()
    got = {r.doc_id: r.kept for r in rules.apply_rules(documents).collect()}
    failed = (measured["n_words"] < 20) | (100 * measured["n_repeat_words"] > 30 * measured["n_words"])
    fine = measured[~failed]

    def fences(df):
        q = lambda m, r: np.quantile(df[m], r, method="inverted_cdf")
        return {m: max(q(m, 0.75) + rules.REACH * (q(m, 0.75) - q(m, 0.25)), q(m, 0.5) + slack) for m, slack in rules.MEASURES.items()}

    pooled, wrong = fences(fine), 0
    by_lang = {lang: (len(df), fences(df)) for lang, df in fine.groupby("lang")}
    own = {key: (len(df), fences(df)) for key, df in fine.groupby(["lang", "source"])}
    mix = lambda n, a, b: a * n / (n + rules.INERTIA) + b * rules.INERTIA / (n + rules.INERTIA)
    for r, base in zip(measured.itertuples(), failed):
        want = not base
        if want:
            (n, f), (k, g) = own[r.lang, r.source], by_lang[r.lang]
            want = all(getattr(r, m) <= mix(n, f[m], mix(k, g[m], pooled[m])) for m in rules.MEASURES)
        wrong += want != got[r.doc_id]
    assert wrong <= 0.01 * len(measured)


def test_no_number_of_rows_is_a_border(spark):
    """A group's fences change little with one more row."""
    data = [(k, " ".join(f"#{j}word{k}" for j in range(40)), "en", "tags") for k in range(101)] + [(1000 + k, " ".join(f"word{j + k}" for j in range(40)), "en", "prose") for k in range(900)]
    fences = []
    for n in (98, 99, 100, 101):
        rows = rules.measured(spark.createDataFrame([r for r in data if r[0] >= 1000 or r[0] < n], "doc_id long, text string, lang string, source string"))
        fences.append(rules.thresholds(rows).where("source = 'tags'").first().fence["symbols_per_word"])
    assert np.ptp(fences) < 0.02 * fences[0] and fences[0] > 0.7


def test_rules_thresholds_follow_their_group(spark):
    """The same text passes in a source of its kind and fails in another."""
    plain = " ".join(f"word{k}" for k in range(40))
    busy = " ".join(f"#{k}word" for k in range(40))
    data = [(k, busy if k < 300 else plain, "en", "tags" if k < 300 else "prose") for k in range(600)] + [(900, busy, "en", "prose")]
    got = {r.doc_id: r.kept for r in rules.apply_rules(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()}
    assert got[5] and got[500] and not got[900]


def test_language_id(documents, clashing, empty, spark, rows):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    got = langid.identify_documents(documents).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    odd = {r.doc_id: r for r in langid.identify_documents(clashing).collect()}
    assert [odd[i].lang_pred for i in (7, 8, 9, 16)] == ["und"] * 4 and odd[7].score == 0
    assert langid.identify_documents(empty).count() == 0
    unknown = langid.identify_documents(documents.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}


def test_language_dictionaries_come_from_whole_texts(spark, documents):
    """A long head without letters on every text hides nothing."""
    headed = documents.withColumn("text", F.concat(F.expr("repeat('0123456789 ', 300)"), F.coalesce("text", F.lit(""))))
    lang = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in langid.identify_documents(headed).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert langid.piece_of("ABC def. " * 100, 5, 10) == langid.normalised("ABC def. " * 100)[5:15]


def test_language_equals_a_plain_version(documents):
    """The smallest of all sizes, with a fresh compressor for each block and no reuse."""
    import zstandard

    dictionaries = langid.learn(documents, langid.in_training(F.col("doc_id")))
    got = {r.doc_id: r for r in langid.identify_documents(documents).collect()}
    for r in documents.where("doc_id % 5 = 0").collect():
        data = re.sub(rb"[^a-z\x80-\xff]+", b" ", (r.text or "").lower().encode()).strip()
        blocks = [data[i : i + langid.BLOCK_BYTES] for i in range(0, len(data), langid.BLOCK_BYTES)]
        sizes = {}
        for lang, content in dictionaries.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=langid.LEVEL)
            sizes[lang] = sum(len(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(b)) for b in blocks)
        want = min(sorted(sizes), key=sizes.get) if data else "und"
        assert got[r.doc_id].lang_pred == want


def test_language_and_quality_do_not_read_labels(documents):
    """Changing what held-out rows say of themselves changes no score."""
    base = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_documents(documents).collect()}
    other = documents.withColumn("lang", F.when(~langid.in_training(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_documents(other).collect()} == base


def test_quality(spark, documents, clashing, empty, sf_dir):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    known = [(r.quality, got[r.doc_id].score) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for q, s in known if q], [s for q, s in known if not q]
    assert np.mean([[a > b for b in bad] for a in good]) > 0.95
    assert all((r.score >= 0.3) == (r.predicted == 1) for r in got.values())
    assert {i for i, r in got.items() if r.held_out} == {i for i in got if zlib.crc32(str(i).encode()) % 5 == 0}
    assert quality.score_documents(clashing, labels).count() == 14
    assert quality.score_documents(empty, labels).count() == 0
    none = quality.score_documents(clashing, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    odd = spark.createDataFrame([(None, 1, 0), (5, None, 0), (6, 7, 0), (14, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.score_documents(clashing, odd).collect())


def test_quality_is_the_sum_of_its_tables(documents, sf_dir, spark):
    """Scores against entries that are looked up one by one."""
    import zstandard

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model, compressor = quality.train(documents, labels), zstandard.ZstdCompressor(1)
    got = {r.doc_id: r.score for r in quality.score_documents(documents, labels).collect()}
    assert model.pairs
    for r in documents.collect():
        x = quality.features(r.text, compressor)
        bins = [sum(v >= c for c in cuts) for v, cuts in zip(x, model.cuts)]
        raw = model.start + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[bins[i]][bins[j]] for (i, j), t in zip(model.pairs, model.pair_tables))
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-raw))) < 1e-9


def license_labels(text):
    """All labels: phrases on the words; identifiers behind tags, whose expressions here have no error."""
    found = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text))) + " "
    labels = {label for phrase, label in (license.BASE | license.MORE).items() if f" {phrase} " in found}
    for said in re.findall(r"(?i)spdx-license-identifier:([^\r\n]*)", text or ""):
        said = re.match(r"[A-Za-z0-9.\-+() \t]*", said)[0]
        said = re.sub(r"(?i)\bwith\s+\S+", "", said)
        tokens = re.findall(r"[A-Za-z0-9][A-Za-z0-9.\-]*", said)
        for k, t in enumerate(tokens):
            if k and tokens[k - 1].lower() not in ("and", "or") and t.lower() not in ("and", "or"):
                break  # a sentence goes on behind the expression
            labels.add(license.label_of(t))
    return ",".join(sorted(labels - {""}))


def test_license_labels(spark, documents, rows):
    made = [(1, "x SPDX-License-Identifier: MIT OR (Apache-2.0 AND BSD-3-Clause)\nmore"), (2, "spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND ISC"), (3, "// SPDX-License-Identifier:MPL-2.0 is it\n# spdx-License-identifier:  EPL-2.0"), (4, "SPDX License Identifier MIT"), (5, "Mozilla Public License, the Unlicense; all rights reserved.")]
    for df, known in ((documents, rows), (spark.createDataFrame(made, "doc_id long, text string"), made)):
        assert {r.doc_id: r.labels for r in license.scan_licenses(df).collect()} == {i: license_labels(t) for i, t in known}


def license_places(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text))
    places, labels = [], set()
    for phrase, label in license.BASE.items():
        p = phrase.split()
        for i in range(len(found) - len(p) + 1):
            if found[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses(spark, documents, clashing, empty, odd_rows, rows):
    tricky = [(1, "MIT license mit license.  mit\nLicense CC-BY cc by 4"), (2, "gnu general public license license apache license"), (3, "mité license Mit Licenseé"), (4, "apache_license Apache\x00License")]
    made = spark.createDataFrame(tricky, "doc_id long, text string")
    for df, known in ((documents, rows), (clashing, [r[:2] for r in odd_rows]), (empty, []), (made, tricky)):
        got = license.scan_licenses(df).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(((i, *license_places(t)) for i, t in known), key=str)
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert {r.labels for r in license.scan_licenses(clashing).where("doc_id = 14").collect()} == {"apache,bsd,gpl,mit"}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("MIT", [{"mit"}]),
        ("MIT OR Apache-2.0 AND BSD-3-Clause", [{"mit"}, {"apache", "bsd"}]),
        ("(MIT OR Apache-2.0) AND BSD-3-Clause", [{"mit", "bsd"}, {"apache", "bsd"}]),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT */", [{"gpl"}, {"mit"}]),
        ("(MIT", None),
        ("OR MIT", None),
        ("MIT AND", None),
        ("", None),
    ],
)
def test_expressions(text, want):
    got = license.choices(text)
    assert (got and [set(s) for s in got]) == want


def test_labels_do_not_depend_on_the_number_of_choices():
    known = ["GPL-2.0", "MIT", "Apache-2.0", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "ISC"]
    said = " AND ".join(f"({k} OR x{k})" for k in known)
    found = license.scan(f"SPDX-License-Identifier: {said}", license.automaton())
    assert found[5] == "apache,bsd,epl,gpl,isc,mit,mpl" and found[6] == 0.75 and found[7] == [said]
    assert license.labels_of(license.postfix("GPL-2.0 WITH LGPL-3.0-linking-exception OR MIT")) == {"gpl", "mit"}
