"""Quality rules with thresholds that follow the corpus, in DataFrame functions only.

Each text is measured once. For every language and source a mergeable quantile sketch
(KLL) of each measure is built; the sketches are merged to one a language and one for
all. A measure fails beyond a fence: ``reach`` interquartile ranges above the upper quartile,
and at least ``slack`` above the median, so that a group of equal clean texts has no
fence at its own value. Quartiles bear up to a quarter of junk in a group. The fence of a
group of n rows has the weight n / (n + ``inertia``), the rest is its language's, which
is weighed against that of all rows in the same way: small groups lean on larger ones, and
no number of rows is a border.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.common import SPACE, WORD, id_and_text, written

#: Measures, each worse the higher it is, and their slack.
MEASURES = {"symbols_per_word": 0.2, "dup_line_share": 0.5, "same_next_share": 0.2, "upper_share": 0.3, "chars_per_word": 4.0, "words_per_char": 0.15}
REACH, INERTIA, SKETCH_K, WINDOW_WORDS = 4.0, 50.0, 400, 8


def let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """repeat: words in windows of ``size`` words that the text holds twice or more, the first
    included; same: words equal to the one before.

    Windows are compared by 64-bit hashes within one text. Only texts with an equal pair
    sort their windows; the words of the starts found are then counted gap by gap.
    """

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(pairs, lambda ps: F.transform(F.filter(ps, lambda p, j: F.coalesce(F.get(ps, j - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(ps, j + 1)["h"] == p["h"], F.lit(False))), lambda p: p["i"]))
        return let(F.sort_array(found), lambda at: F.aggregate(F.transform(at, lambda i, j: F.least(F.coalesce(F.get(at, j + 1) - i, F.lit(size)), F.lit(size))), F.lit(0), lambda a, x: a + x))

    def again(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))))
        return F.when(F.size(hashes) < size, F.lit(0)).otherwise(let(windows, lambda ws: F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(covered(ws))))

    def of(hashes: Column) -> Column:
        same = F.size(F.filter(hashes, lambda h, i: (i > 0) & (F.get(hashes, i - 1) == h)))
        return F.struct(again(hashes).cast("long").alias("repeat"), same.cast("long").alias("same"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts and the measures of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    counts = let(words, lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"), repeat_words(ws).alias("r")))
    counted = docs.select(
        "doc_id", "lang", "source", counts.alias("c"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_upper"),
        let(lines, lambda ls: F.struct(F.size(ls).cast("long").alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("l"),
    )
    counted = counted.select("doc_id", "lang", "source", "c.n_words", "c.word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), F.col("c.r.repeat").alias("n_repeat_words"), F.col("c.r.same").alias("n_same_next"), "n_upper", F.col("l.n").alias("n_lines"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))
    return counted.withColumns({
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "same_next_share": share("n_same_next", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "chars_per_word": share("word_chars", "n_words"),
        "words_per_char": share("n_words", "word_chars"),
    })


def thresholds(rows: DataFrame, inertia: float = INERTIA, reach: float = REACH) -> DataFrame:
    """lang, source and a fence for each measure; one row a language and source.

    ``rows`` are those that pass the base rules. The three levels come from one pass:
    sketches a language and source, merged to one a language, merged to one for all.
    """
    sketches = rows.groupBy("lang", "source").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(m, SKETCH_K).alias(m) for m in MEASURES))
    sketches = written(sketches, "sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(m, SKETCH_K).alias(m) for m in MEASURES)]
    everything = sketches.agg(*merged)

    def fences(df: DataFrame, tag: str, keys: list[str]) -> DataFrame:
        def fence(m: str) -> Column:
            q = lambda r: F.kll_sketch_get_quantile_double(m, F.lit(r))
            return F.greatest(q(0.75) + (q(0.75) - q(0.25)) * reach, q(0.5) + MEASURES[m])

        return df.select(*keys, F.col("n").alias(f"n_{tag}"), F.struct(*(F.when(F.col("n") > 0, fence(m)).alias(m) for m in MEASURES)).alias(tag))

    own = fences(sketches, "own", ["lang", "source"])
    by_lang = fences(sketches.groupBy("lang").agg(*merged), "by_lang", ["lang"]).withColumnRenamed("lang", "_lang")
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").crossJoin(F.broadcast(fences(everything, "pooled", [])))  # pooled: one row

    def blended(m: str) -> Column:
        def weigh(n: str, own: Column, other: Column) -> Column:
            weight = F.col(n) / (F.col(n) + inertia)
            return F.when(F.col(n) > 0, own * weight + other * (1 - weight)).otherwise(other)

        return weigh("n_own", F.col("own")[m], weigh("n_by_lang", F.col("by_lang")[m], F.col("pooled")[m]))

    return joined.select("lang", "source", F.struct(*(blended(m).alias(m) for m in MEASURES)).alias("fence"))


def apply_rules(docs: DataFrame, inertia: float = INERTIA, reach: float = REACH) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and ``failed`` (the measures beyond their fence).

    Null, empty and wordless texts have no words and fail the base rules. A very long text is one
    row's work. Null lang or source is a group of its own. Repeated rows and null ids are
    measured like any other. A measure equal to its fence passes. Thresholds come from the rows
    that pass the base rules; rows of a group that has none fail these rules, so need none.
    Columns other than doc_id, text, lang and source are left out, so no name clashes. No rows
    in, no rows out.
    """
    keys = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keys)
    rows = measured(docs).withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
    rows = written(rows, "measures")
    fences = thresholds(rows.where(~F.col("base_failed")), inertia, reach).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(fences, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    beyond = F.filter(F.array(*(F.when(F.col(m) > F.col("fence")[m], F.lit(m)) for m in MEASURES)), lambda x: x.isNotNull())
    joined = joined.withColumn("failed", beyond)
    kept = reduce(lambda a, b: a & b, [~F.col("base_failed"), F.size("failed") == 0])
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "failed")
