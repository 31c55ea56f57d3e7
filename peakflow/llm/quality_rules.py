"""Quality rules with DataFrame functions only: repetition, and divergence from the language.

Base rules look at the text alone. The method compares two histograms of a document with those of all
documents of its language: classes of characters, and the language's `COMMON` most frequent words with one
class for all others. A document is rejected when a Jensen-Shannon distance (base 2, between 0 and 1) is over
its limit; a guard leaves texts alone that are too short for their histogram to mean anything, as well
as languages whose reference rests on little text.

Input: columns doc_id, text and lang, others are ignored. A null text has no words. Rows without lang are a
language of their own. Repeated rows get equal results; documents are told apart by doc_id (null
included) and a hash of their text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakflow.sources.staging import stage

COMMON = 50
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_SHARE = 30  # per cent
CHAR_LIMIT, CHAR_GUARD = 0.32, 200  # distance, characters
WORD_LIMIT, WORD_GUARD = 0.40, 100  # distance, words
REFERENCE_WORDS = 1_000  # words of a language below which it is no reference
BROADCAST_ROWS = 100_000
LONG = 32  # bytes from which common words are looked up together
SPACES = r"[\x20\x09-\x0D]+"
# character classes, besides white space and what none of them matches (mostly small letters); none of them has a character of _PLAIN
_PLAIN = r"[a-z\x20\x09-\x0D]+"
_CLASSES = {"upper": r"[A-Z]+", "digit": r"[0-9]+", "punct": r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+", "wide": r"[^\x00-\x7F]+"}
CHARS = ("lower", *_CLASSES, "space")


def _without(text: Column, pattern: str) -> Column:
    """Number of code points that a pattern matches."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _joined_hashes(array: str, step: int) -> Column:
    return F.transform(array, lambda x, i: F.xxhash64(x, F.get(array, i + step)))


def _repeated(docs: DataFrame, size: int) -> DataFrame:
    """Adds n_repeat_words: words in windows of `size` that the text `w` has at least twice.

    Only texts with an equal pair of window hashes sort them; the columns in between keep each array
    from being computed more than once."""
    n = F.size("w") - size + 1
    hashed, width = docs.withColumn("_h1", F.transform("w", lambda x: F.xxhash64(x))), 1
    while width < size:  # hashes of windows twice as wide from pairs that adjoin or overlap
        step = min(width, size - width)
        wider = _joined_hashes(f"_h{width}", step)
        if width + step == size:  # a window found twice begins with a narrower one found twice
            wider = F.when(F.size(F.array_distinct(f"_h{width}")) < F.size(f"_h{width}"), wider)
        hashed = hashed.withColumn(f"_h{width + step}", wider)
        width += step
    hashed = hashed.withColumn("_h", F.when(n > 0, F.slice(f"_h{size}", F.lit(1), n)))
    twice = hashed.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = twice.withColumn("_p", F.sort_array(F.transform(F.filter(
        F.transform("_s", lambda x, k: F.struct(x["i"].alias("i"), (x["h"].eqNullSafe(F.get("_s", k - 1)["h"]) | x["h"].eqNullSafe(F.get("_s", k + 1)["h"])).alias("again"))),
        lambda x: x["again"]), lambda x: x["i"])))
    m = F.size("_p")
    steps = F.zip_with(F.slice("_p", F.lit(1), m - 1), F.slice("_p", F.lit(2), m - 1), lambda a, b: F.least(b - a, F.lit(size)))
    covered = F.when(m > 0, F.aggregate(steps, F.lit(0), lambda a, x: a + x) + size).otherwise(0)
    return places.withColumn("n_repeat_words", covered.cast("long")).select(*docs.columns, "n_repeat_words")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, the base counts and the character classes of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"), _words(text).alias("w"))
    rows = _repeated(rows, REPEAT_WINDOW)
    lines = rows.withColumn("_l", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    # one pass over the whole text; classes and symbols are told apart in the little it leaves
    lines = lines.withColumn("_o", F.regexp_replace("text", _PLAIN, ""))
    base = lines.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "lang", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _without(F.col("_o"), r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.char_length("text").cast("long").alias("n_chars"), *(_without(F.col("_o"), p).cast("long").alias(c) for c, p in _CLASSES.items()))
    space = F.col("n_chars") - F.col("word_chars")
    return base.withColumn("space", space).withColumn("lower", F.col("n_chars") - space - reduce(lambda a, b: a + b, map(F.col, _CLASSES)))


def _term(p: Column, q: Column) -> Column:
    """A class's share of the Jensen-Shannon divergence, doubled."""
    m = (p + q) / 2
    one = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    return one + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)


def _distance(pairs: list[tuple[Column, Column]]) -> Column:
    return F.sqrt(F.greatest(reduce(lambda a, b: a + b, (_term(p, q) for p, q in pairs)) / 2, F.lit(0.0)))


def common_words(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """lang, word, rank and count of each language's most frequent words (ties by word).

    Counts are map-side sums over all words of all documents; each task then hands on its best ranks only."""
    each = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.explode(_words(F.coalesce("text", F.lit("")))).alias("word"))
    counts = each.groupBy("lang", "word").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
    return ranked.where(F.col("rank") <= common)


def _length(word: Column) -> Column:
    return F.least(F.octet_length(word), F.lit(LONG))


def _rank(same: Column, word: Column) -> Column:
    """Rank of a word among the common words of its length, null if it is none of them."""
    return F.get(same["rank"], F.array_position(same["word"], word) - 1)


def _word_distances(docs: DataFrame, reference: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang and word_distance of every row whose language has a reference.

    A row's words become sorted ranks, whose runs are its counts; nothing is shuffled but the result."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.coalesce("lang", F.lit("")).alias("lang"), _words(text).alias("w"))
    rows = rows.join(reference, "lang").where("size(w) > 0")
    ranks = F.transform("w", lambda x: _rank(F.get("common", _length(x)), x))
    rows = rows.withColumn("n", F.size("w")).withColumn("_s", F.sort_array(F.filter(ranks, lambda r: r > 0)))
    ends = F.filter(F.transform("_s", lambda r, i: F.struct(r.cast("int").alias("r"), (i + 1).alias("upto"), (~r.eqNullSafe(F.get("_s", i + 1))).alias("last"))), lambda e: e["last"])
    rows = rows.withColumn("_e", ends)
    counts = F.transform("_e", lambda e, i: F.struct(
        ((e["upto"] - F.coalesce(F.get("_e", i - 1)["upto"], F.lit(0))) / F.col("n")).alias("p"), (F.get("common_n", e["r"] - 1) / F.col("ref_n_words")).alias("q")))
    rows = rows.withColumn("_c", counts)
    listed = F.aggregate("common_n", F.lit(0.0), lambda a, x: a + x / F.col("ref_n_words"))
    own = F.aggregate("_c", F.lit(0.0), lambda a, c: a + c["p"])
    # a listed word that a text lacks adds its share of the language
    present = F.aggregate("_c", F.lit(0.0), lambda a, c: a + _term(c["p"], c["q"]) - c["q"])
    rows = rows.withColumn("_d", present + listed + _term(F.greatest(1 - own, F.lit(0.0)), F.greatest(1 - listed, F.lit(0.0))))
    distance = F.sqrt(F.greatest(F.col("_d") / 2, F.lit(0.0))).alias("word_distance")
    return rows.groupBy("doc_id", "text_hash", "lang").agg(F.max(distance).alias("word_distance"))


def divergence(docs: DataFrame) -> DataFrame:
    """The measures of every row with char_distance and word_distance (null without a reference)."""
    base = stage(measures(docs), "measures")
    rows = ("n_words", "n_chars", *CHARS)
    totals = base.groupBy("lang").agg(*(F.sum(c).alias(f"ref_{c}") for c in rows)).where(F.col("ref_n_words") >= REFERENCE_WORDS)
    top = stage(common_words(docs), "common")
    small = top.count() <= BROADCAST_ROWS
    # each language's words, dealt out by their length, and their shares in one row of bounded size
    listed = F.sort_array(F.collect_list(F.struct("rank", "word", "n")))
    dealt = F.transform(F.sequence(F.lit(0), F.lit(LONG)), lambda k: F.filter("_l", lambda x: _length(x["word"]) == k))
    words_of = top.groupBy("lang").agg(listed.alias("_l")).select(
        "lang", F.transform(dealt, lambda x: F.struct(x["rank"].alias("rank"), x["word"].alias("word"))).alias("common"), F.col("_l.n").alias("common_n"))
    reference = stage(totals.join(words_of, "lang"), "reference")
    reference = F.broadcast(reference) if small else reference
    words = _word_distances(docs, reference.select("lang", "common", "common_n", "ref_n_words"))
    chars = [(F.col(c) / F.col("n_chars"), F.col(f"ref_{c}") / F.col("ref_n_chars")) for c in CHARS]
    measured = base.join(reference.select("lang", *(f"ref_{c}" for c in rows)), "lang", "left").withColumn(
        "char_distance", F.when((F.col("n_chars") > 0) & F.col("ref_n_chars").isNotNull(), _distance(chars))).select(*base.columns, "char_distance")
    words = words.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "lang": "_lang"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("lang") == F.col("_lang"))
    return measured.join(words, same, "left").drop("_id", "_hash", "_lang")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, the base counts, both distances, base_failed and kept of every row."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    far = F.coalesce((F.col("n_chars") >= CHAR_GUARD) & (F.col("char_distance") > CHAR_LIMIT), F.lit(False)) \
        | F.coalesce((F.col("n_words") >= WORD_GUARD) & (F.col("word_distance") > WORD_LIMIT), F.lit(False))
    return divergence(docs).withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged."""
    bad = judge(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"), F.col("lang").alias("_bad_lang")).distinct()
    text, lang = (F.coalesce(docs[c], F.lit("")) for c in ("text", "lang"))
    same = docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(text) == bad["_bad_hash"]) & (lang == bad["_bad_lang"])
    return docs.join(bad, same, "left_anti")


def op2_quality_divergence(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
