import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weft.llm import ngram_join, substring, words
from weft.llm.components import components


def made_rows(seed=3, n=120):
    """Copies with few and many edits, shared passages, runs of one word, short texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    texts = []
    for k in range(n):
        kind = r.random()
        if texts and kind < 0.5:
            w = r.choice(texts).split()
            for _ in range(r.choice([0, 1, 2, 3, 8, 20])):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocabulary)
        elif kind < 0.6:
            w = [r.choice(vocabulary)] * r.randrange(1, 70)
        elif kind < 0.7:
            w = [r.choice(vocabulary) for _ in range(r.randrange(0, 6))]
        else:
            w = [r.choice(vocabulary) for _ in range(r.randrange(20, 200))]
            if kind > 0.85:
                at = r.randrange(len(w))
                w[at:at] = passage
        texts.append(" ".join(w) if kind < 0.9 else "\n".join(w).upper())
    return [(1000 - k, t) for k, t in enumerate(texts)]


def near(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def cut(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_near_duplicates_made(spark):
    rows = made_rows(3) + [(i + 2000, t) for i, t in made_rows(4, 80)]
    assert near(ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute.near_duplicates(rows), key=str)


def test_near_duplicates_of_one_id_with_several_texts(spark):
    base = [f"w{k}" for k in range(60)]
    other = " ".join(f"x{k}" for k in range(40))
    rows = [(1, " ".join(base)), (2, other), (2, " ".join([*base, "tail"])), (3, other + " tail"), (4, ""), (4, "a b c d e"), (5, "A B c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicate_rows(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.near_duplicates(rows))
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.leads) == [(1, 56), (2, 36), (4, 0), (4, 1)]


def test_near_duplicates_in_pages(spark):
    """Buckets cut into pages lose no link: copies of one text with up to a third of it changed."""
    r, page = random.Random(150), 150
    base = [f"w{k}" for k in range(80)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(20, 80)] = f"y{r.randrange(40)}"
        rows.append((k * 3 % 151, " ".join(w[: r.randrange(45, 81)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near(ngram_join.near_duplicate_rows(df, page)) == sorted(brute.near_duplicates(rows), key=str)


def test_linked_pairs_are_all_links(spark):
    rows = made_rows(5, 80)
    pairs, members = ngram_join.linked_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    of = {r.doc_id: r.node for r in members.collect()}
    sets = {i: ngram_join.shingle_set((t or "").encode()) for i, t in rows}
    want = {(min(of[i], of[j]), max(of[i], of[j])) for i in of for j in of if of[i] != of[j] and ngram_join.links(sets[i], sets[j])}
    assert set(of) == {i for i, s in sets.items() if s}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


def test_near_duplicates_documents(documents, rows):
    assert near(ngram_join.near_duplicates(documents)) == sorted(brute.near_duplicates(rows), key=str)


def test_near_duplicates_odd(clashing, odd_rows, empty):
    known = [(r[0], r[1]) for r in odd_rows if r[0] is not None]
    got = ngram_join.near_duplicates(clashing)
    assert near(got.where("doc_id is not null")) == sorted(brute.near_duplicates(known), key=str)
    assert [r.component_id for r in got.where("doc_id is null").collect()] == [None, None]
    assert near(ngram_join.near_duplicates(empty)) == []


def test_spans_made(spark):
    rows = made_rows(3) + [(i + 2000, t) for i, t in made_rows(4, 80)]
    assert cut(substring.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute.without_repeats(rows), key=str)


def test_spans_documents(documents, rows):
    assert cut(substring.dedup_documents(documents)) == sorted(brute.without_repeats(rows), key=str)


def test_spans_odd(clashing, odd_rows, empty):
    known = [(r[0], r[1]) for r in odd_rows if r[0] is not None]
    got = substring.dedup_documents(clashing)
    assert cut(got.where("doc_id is not null")) == sorted(brute.without_repeats(known), key=str)
    assert [r.n_removed for r in got.where("doc_id is null").collect()] == [0, 0]
    assert cut(substring.dedup_documents(empty)) == []


def test_only_words_equal_to_their_source_are_taken_out():
    words = [f"w{k}".encode() for k in range(50)]
    true, false = {"start": 5, "length": 20, "digest": substring.digest(words[5:25])}, {"start": 22, "length": 24, "digest": substring.digest(words[:24])}
    assert substring.kept_words(words, [true, false]) == words[:5] + words[25:]
    assert substring.kept_words(words, [false]) is words


def test_places_whose_spans_differ_are_told(spark):
    """A span that names a source with other words, as after a collision of hashes."""
    from weft.llm.common import marked

    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "aac")
    docs = marked(spark.createDataFrame([(1, a), (2, b), (3, c)], "doc_id long, text string"))
    mark = {r.doc_id: r.mark for r in docs.collect()}
    spans = spark.createDataFrame([(2, mark[2], 0, 25, 1, mark[1], 0), (3, mark[3], 0, 25, 1, mark[1], 0), (2, mark[2], 2, 22, 1, mark[1], 2)], "doc_id long, mark long, start int, length int, source long, source_mark long, at int")
    got = {(r.at, r.length): (r.least == r.most, bytes.fromhex(r.told)) for r in substring.digests_of_places(spans, docs).collect()}
    words = a.encode().split()
    assert got == {(0, 25): (False, substring.digest(words[:25])), (2, 22): (True, substring.digest(words[2:24]))}


def test_long_repeats_compact_to_one_span(spark):
    from weft.llm.common import marked

    passage = [f"p{k}" for k in range(200)]
    rows = [(1, " ".join(["a"] * 3 + passage)), (2, " ".join(passage[20:180] + ["b"] * 5)), (3, " ".join(["c"] + passage[20:90] + ["d"] + passage[90:150]))]
    got = substring.repeated_spans(marked(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert sorted((r.doc_id, r.start, r.length) for r in got) == [(2, 0, 160), (3, 1, 70), (3, 72, 60)]


def test_unchanged_texts_keep_their_form(spark):
    df = spark.createDataFrame([(1, "a  b\n c", "x")], "doc_id long, text string, lang string")
    assert [tuple(r) for r in substring.without_repeats(df, ["lang"]).select("text", "lang").collect()] == [("a  b\n c", "x")]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {k: 1 for k in range(1, 41)} | {90: 90, 100: 90}
    assert components(links.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=25, unique=True), st.integers(0, 3), st.integers(-1, 2)), min_size=1, max_size=90))
def test_tree_finds_what_all_pairs_find(points):
    vectors = np.zeros((len(points), ngram_join.GROUPS), np.uint32)
    for k, (items, _, _) in enumerate(points):
        np.add.at(vectors[k], items, 1)
    sizes, labels = np.array([len(p[0]) for p in points]), [np.array([p[k] for p in points]) for k in (1, 2)]
    got = {(min(i, j), max(i, j)) for p, q in ngram_join.CountVectorTree(vectors, sizes, labels).pairs() for i, j in zip(p.tolist(), q.tolist())}
    every = ngram_join.leaf_pairs(np.zeros(len(points)), vectors, sizes, labels, len(points))
    want = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points)) if all(x[i] != x[j] or x[i] == -1 for x in labels) and ngram_join.sizes_pass(min(sizes[i], sizes[j]), max(sizes[i], sizes[j])) and ngram_join.bound_passes(sizes[i], sizes[j], int(np.minimum(vectors[i], vectors[j]).sum()))}
    assert got == want
    assert set(zip(every[0].tolist(), every[1].tolist())) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \nÄ\x85", max_size=40), max_size=6))
def test_word_hashes_are_those_of_the_words(texts):
    import pyarrow as pa

    hashes, offsets = words.word_hashes(pa.array(texts, pa.string()))
    found = [brute.words(t) for t in texts]
    assert np.diff(offsets).tolist() == [len(w) for w in found]
    alone = {w: words.word_hashes(pa.array([w]))[0][0] for ws in found for w in ws}
    assert hashes.tolist() == [alone[w] for ws in found for w in ws]
    assert len(set(alone.values())) == len(alone)
