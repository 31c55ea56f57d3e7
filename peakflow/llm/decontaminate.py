"""Benchmark decontamination with DataFrame functions only.

Windows of `WINDOW` normalised words of all benchmark items (an item of fewer words is one window) form a hash
table. Every window of every document is looked up in it and a hit is verified by comparing the words
themselves. The table is broadcast if its measured size is under a bound; beyond it hashes and places of the
windows meet it in a shuffle join, where adaptive execution splits a passage that very many documents hold, and the
places that match are compared with the words of their document.

Input: documents (doc_id, text) and benchmark (item_id, text). A null text has no words. Equal
item_ids are one item. Rows that repeat a document give equal results each; documents are told apart by
doc_id (null included) and a hash of their text. Empty tables are allowed on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakflow.llm.names import free_names
from peakflow.sources.staging import stage

WINDOW = 10
BROADCAST_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Normalised words of a text: A-Z folded, all other ASCII but digits and letters taken as gaps."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Different windows of all items: length, hash, words and the items that have them."""
    each = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    n = F.least(F.size("w"), F.lit(size))
    cut = each.select("item_id", n.alias("length"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("window"))
    hashed = cut.withColumn("h", F.xxhash64(*(F.get("window", F.lit(k)) for k in range(size))))
    return hashed.groupBy("length", "h", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Occurrences of benchmark windows: doc_id, text_hash, start (0-based word), length and items."""
    table = stage(benchmark_windows(benchmark, size), "windows")
    width = F.aggregate("window", F.lit(0), lambda a, x: a + F.octet_length(x) + 16) + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 16) + 64
    lengths, total = table.agg(F.collect_set("length"), F.sum(width)).first()
    small = (total or 0) <= broadcast_bytes
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    out = None
    for length in sorted(lengths or [size]):
        # outer, so that no filter on the array repeats the work that makes it; a null place matches nothing
        starts = F.when(F.size("w") >= length, F.sequence(F.lit(0), F.size("w") - length))
        place = each.select("*", F.explode_outer(starts).alias("start"))
        window = [F.get("w", F.col("start") + k) for k in range(length)]
        keyed = place.withColumn("h", F.xxhash64(*window))
        own = table.where(F.col("length") == length).select(F.col("h").alias("bh"), F.col("window").alias("bw"), "items")
        if not small:
            # hashes and places are shuffled, and the few that match fetch their words: a place once, so copies of a row do not multiply
            keyed = keyed.select("doc_id", "text_hash", "start", "h").where("start is not null")
            near = keyed.join(own, F.col("h") == F.col("bh")).select(
                F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "start", "bw", "items").dropDuplicates(["_d", "_t", "start", "bw"])
            found = each.join(near, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")))
            found = found.where(F.slice("w", F.col("start") + 1, length) == F.col("bw"))
            found = found.select("doc_id", "text_hash", "start", F.lit(length).alias("length"), "items")
            out = found if out is None else out.unionAll(found)
            continue
        # joined by the hash alone; the words are compared where it matches
        differs = F.greatest(*((x != F.get("bw", F.lit(k))).cast("int") for k, x in enumerate(window)), F.lit(0))
        found = keyed.join(F.broadcast(own), (F.col("h") == F.col("bh")) & (differs == 0))
        found = found.select("doc_id", "text_hash", "start", F.lit(length).alias("length"), "items")
        out = found if out is None else out.unionAll(found)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """All columns of `docs`, and n_words, n_hit, n_items, items_sha256, contaminated and the hit spans
    (start and stop in words, merged). A column named like one of these is replaced."""
    docs = docs.select(*(c for c in docs.columns if c not in _RESULTS))
    by_doc = hits(docs, benchmark, size).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"))
    empty = F.lit(None).cast("array<struct<start:int,stop:int>>")
    grown = F.aggregate(
        "_hits", F.coalesce(empty, F.array().cast("array<struct<start:int,stop:int>>")),
        lambda spans, x: F.when((F.size(spans) > 0) & (x["start"] <= F.element_at(spans, -1)["stop"]),
                                F.concat(F.slice(spans, 1, F.size(spans) - 1),
                                         F.array(F.struct(F.element_at(spans, -1)["start"].alias("start"),
                                                          F.greatest(F.element_at(spans, -1)["stop"], x["start"] + x["length"]).alias("stop")))))
        .otherwise(F.concat(spans, F.array(F.struct(x["start"].alias("start"), (x["start"] + x["length"]).alias("stop"))))))
    ident, own, items, spans, h, n = free_names(docs.columns, "_id", "_hash", "_items", "_spans", "_h", "_n")
    by_doc = by_doc.select("_id", "_hash", "_items", grown).toDF(ident, own, items, spans)
    hashed = docs.withColumn(h, F.xxhash64("text")).withColumn(n, F.size(words(F.col("text"))).cast("long"))
    joined = hashed.join(by_doc, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(h) == F.col(own)), "left")
    n_hit = F.coalesce(F.aggregate(spans, F.lit(0), lambda a, s: a + s["stop"] - s["start"]), F.lit(0))
    return joined.select(
        *docs.columns, F.col(n).alias("n_words"), n_hit.cast("long").alias("n_hit"),
        F.coalesce(F.size(items), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(items, ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(n_hit > 0, F.lit(False)).alias("contaminated"), F.col(spans).alias("spans"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of `docs`, unchanged, in which no window of a benchmark item occurs."""
    bad = hits(docs, benchmark, size).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_hash"]), "left_anti")


def op1_benchmark_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS l, w[i:i + least(len(w), {WINDOW}) - 1] AS win
       FROM b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT l FROM bw),
hit AS (SELECT s.doc_id, s.i, s.l, bw.item_id
        FROM (SELECT doc_id, i, l, w[i:i + l - 1] AS win FROM d, lens, unnest(range(1, len(w) - l + 2)) AS t(i)) s
        JOIN bw ON s.l = bw.l AND s.win = bw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + l)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
