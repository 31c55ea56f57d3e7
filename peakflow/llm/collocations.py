"""Phrases whose words occur together far more often than apart, from sorted count streams.

The layout is that of external language model estimation. Words become numbers, the frequent ones first; a block of
texts is a row of numbers. Each block counts its word pairs and triples in prefix order (by first word, then second,
then third) and hands on packed, sorted stretches of that stream, which are merged slice by slice. Left counts are
then read off in prefix order and right counts in suffix order (by last word, then the one before), both by
merge joins of sorted streams: pairs meet their first and their second words, triples their first and their last two
words, and the counts of one-word extensions meet the pairs inside them. No table of n-grams is held in memory, and
n-grams are compared as they are, never as hashes.

A word that occurs less than `least` times is part of no candidate and of no count that one needs, so it
only parts its neighbours. The number of a slice follows from an n-gram as a whole, so frequent words or pairs do not gather
anywhere: a block adds one entry for an n-gram at most.

Input: columns lang and text; others, whatever their names, are ignored. A null text is empty, a null language `und`. Texts are
read whole, of any length. Repeated rows count once each. Equal scores are ordered by count and phrase, equal
cuts take the shorter first part. A language without candidates has no rows, an empty table none at all."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.sources.staging import stage

LEAST = 10  # occurrences of a candidate
INSIDE = 50  # hundredths of its occurrences from which a longer phrase stands for a candidate
TOP = 2000
_BLOCK = 1 << 20  # words of a block, about; a longer text is one block
_SLICE = 1 << 20  # words of the corpus for each slice of a stream
_WORD_BYTES = 16  # bytes of different words that count as one word of a block, so that very long words fill it too
_LISTED, _RUN = 1 << 13, 1 << 15  # different words and places in a row of a block
_BATCH_BYTES = 2 << 20  # texts, rows of blocks and stretches handed to Python at a time, about
_OUT_BYTES, _OUT_ROWS = 1 << 20, 1 << 16  # stretches and counts handed back at a time
_READ_ROWS = 16  # rows of blocks, or texts, that a task reads at a time
_BLANK, _BREAK = (0x20, 0x09), (*b".,;:!?", *range(0x0A, 0x0E))  # fixed values
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANK)], _KIND[list(_BREAK)] = 1, 2


def pieces_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of a text column, begin and end of its words, and the number of each word's piece."""
    data, offsets = X.bytes_of(column)
    kind = _KIND[data]
    inside, edge = kind == 0, np.zeros(len(data) + 1, np.int64)
    edge[offsets[:-1]] = 1  # a text begins a piece
    first = edge[:-1].astype(bool)
    starts = np.flatnonzero(inside & (first | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (np.append(first[1:], True) | ~np.append(inside[1:], False))) + 1
    piece = np.cumsum((kind == 2) + edge[:-1])[starts]
    return X.lowered(data), starts, ends, piece


def _one(values: pa.Array) -> pa.ListArray:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts of one language as numbers: different words with their counts, and `tokens`, the place of each word among
    them, with -1 between pieces. A block is several short rows, numbered by `part`: the executors hold few of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def block(lang: str) -> Iterator[pa.RecordBatch]:
            own, lengths, placed = zip(*held.pop(lang), strict=True)
            del size[lang]
            data, ends = np.concatenate(own), np.cumsum(np.concatenate(lengths))
            starts = ends - np.concatenate(lengths)
            where, like = X.distinct_spans(data, starts, ends)
            at, flat = 0, []
            for n, tokens in zip(map(len, lengths), placed, strict=True):
                flat.append(np.append(like[at:at + n], -1).astype(np.int32)[tokens])
                at += n
            tokens = np.concatenate(flat)
            counts = np.bincount(tokens[tokens >= 0], minlength=len(where))
            starts, sizes, number = starts[where], (ends - starts)[where], uuid.uuid4().int >> 65
            for k in range(max(-(-len(where) // _LISTED), -(-len(tokens) // _RUN))):
                some, run = slice(k * _LISTED, (k + 1) * _LISTED), tokens[k * _RUN:(k + 1) * _RUN]
                offsets = np.append(0, np.cumsum(sizes[some])).astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[X.ragged(starts[some], sizes[some])])])
                yield pa.record_batch([pa.array([number]), pa.array([lang]), pa.array([k], pa.int32()), _one(words), _one(pa.array(counts[some])), _one(pa.array(run))],
                                      names=["block", "lang", "part", "words", "counts", "tokens"])

        for part in X.slices(batches):
            langs = part.column("lang").dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                rows = pa.array(np.flatnonzero(langs.indices.to_numpy() == k))
                data, starts, ends, piece = pieces_of(part.column("text").take(rows))
                if not len(starts):
                    continue
                where, inverse = X.distinct_spans(data, starts, ends)
                lengths = (ends - starts)[where]
                own = data[X.ragged(starts[where], lengths)]
                last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), len(piece) - 1) + 1
                tokens = np.insert(inverse.astype(np.int32), last, len(lengths))
                held.setdefault(lang, []).append((own, lengths, tokens))
                size[lang] = size.get(lang, 0) + max(len(tokens), len(own) // _WORD_BYTES)
                if size[lang] >= _BLOCK:
                    yield from block(lang)
        for lang in list(held):
            yield from block(lang)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "block long, lang string, part int, words array<binary>, counts array<long>, tokens array<int>")


def _numbered(blocks: DataFrame, least: int) -> DataFrame:
    """Frequent words with their count and a number from 0, more frequent ones first: id, lang, word, f."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    counted = each.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("f")).where(F.col("f") >= least)
    placed = stage(counted.orderBy(F.desc("f"), "lang", "word").withColumn("at", F.monotonically_increasing_id()), "frequent", read_rows=_READ_ROWS)
    part = F.shiftrightunsigned("at", 33)  # sorted partitions follow each other; only their sizes reach the driver
    offset, offsets = 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((r["part"], offset))
        offset += r["count"]
    if offset >= 1 << 32:
        raise ValueError("more than 2**32 frequent words")
    parts, begins = zip(*offsets, strict=True) if offsets else ((), ())
    begin = placed.sparkSession.createDataFrame(  # from rows it would start Python workers of another kind beside the others
        pa.table({"part": pa.array(parts, pa.int64()), "begin": pa.array(begins, pa.int64())}))
    return stage(placed.withColumn("part", part).join(F.broadcast(begin), "part").select(
        (F.col("begin") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("id"), "lang", "word", "f"), "words")


def _planes(columns: list[np.ndarray]) -> bytes:
    """Columns of 32-bit numbers, the bytes of equal weight together."""
    return np.ascontiguousarray(np.stack(columns).astype("<u4").view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)).tobytes()


def _entries(raw: memoryview, order: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """N-grams of a stretch, the first two words as one number and the third word, and their counts."""
    columns = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(order + 1, 4, -1).transpose(0, 2, 1)).view("<u4").reshape(order + 1, -1)
    pairs = np.cumsum(columns[0], dtype=np.uint64) << np.uint64(32) | columns[1]
    return pairs, columns[2].copy() if order == 3 else None, columns[-1].copy()


def _summed(stretches: list[tuple], order: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Equal n-grams of all stretches merged, in prefix order, with the sums of their counts."""
    pairs, thirds, counts = (np.concatenate(c) if c[0] is not None else None for c in zip(*stretches, strict=True))
    stretches.clear()
    by = np.argsort(pairs, kind="stable") if order == 2 else np.lexsort((thirds, pairs))
    pairs, thirds = pairs[by], thirds[by] if order == 3 else None
    new = np.ones(len(by), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    if order == 3:
        new[1:] |= thirds[1:] != thirds[:-1]
    begin = np.flatnonzero(new)
    return pairs[begin], thirds[begin] if order == 3 else None, np.add.reduceat(counts[by], begin, dtype=np.int64)


def _streams(blocks: DataFrame, words: DataFrame, slices: int) -> DataFrame:
    """Packed stretches, in prefix order, of the pair and triple counts of each block."""

    def emit(order: int, number: np.ndarray, columns: list[np.ndarray], counts: np.ndarray):
        by = np.argsort(number, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(number[by]) != 0)), len(by))
        columns = [c.astype(np.uint32, copy=False) for c in columns]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            rows = by[a:b]
            lead = columns[0][rows]
            yield order, int(number[rows[0]]), _planes([np.diff(lead, prepend=0), *[c[rows] for c in columns[1:]], counts[rows]])

    def packed(tokens: np.ndarray, places: np.ndarray, ids: np.ndarray):
        number = np.full(max(int(tokens.max()), int(places.max())) + 2, -1, np.int64)  # the last one is that of the piece ends, -1
        number[places] = ids
        t = number[tokens]
        pair = np.flatnonzero((t[:-1] >= 0) & (t[1:] >= 0))
        if not len(pair):
            return
        keys = (t[pair].astype(np.uint64) << np.uint64(32)) | t[pair + 1].astype(np.uint64)
        own, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        first, second = (own >> np.uint64(32)).astype(np.uint32), (own & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        del keys
        hashed = X.mix(own)
        yield from emit(2, (hashed % np.uint64(slices)).astype(np.int32), [first, second], counts)
        triple = np.flatnonzero((pair + 2 < len(t)) & (t[np.minimum(pair + 2, len(t) - 1)] >= 0))
        if not len(triple):
            return
        keys = (inverse[triple].astype(np.uint64) << np.uint64(32)) | t[pair[triple] + 2].astype(np.uint64)
        del inverse, pair, triple, t
        keys, counts = np.unique(keys, return_counts=True)
        lead, third = (keys >> np.uint64(32)).astype(np.int32), keys & np.uint64(0xFFFFFFFF)
        del keys
        number = (X.mix(hashed[lead] + third) % np.uint64(slices)).astype(np.int32)
        yield from emit(3, number, [first[lead], second[lead], third.astype(np.uint32)], counts)

    def meet(texts: pa.Table, listed: pa.Table) -> pa.Table:
        fields, out, held, size = pa.schema([("order", pa.int32()), ("slice", pa.int64()), ("raw", pa.binary())]), [], [], 0
        if listed.num_rows:
            parts = {k: v.values for batch in texts.to_batches() for k, v in zip(batch.column("part").to_pylist(), batch.column("tokens"), strict=True)}
            tokens = np.concatenate([parts.pop(k).to_numpy() for k in sorted(parts)])
            entries = listed.column("w").chunk(0)[0].values.to_numpy()
            for stretch in packed(tokens, entries & ((1 << 31) - 1), entries >> 31):
                held.append(stretch)
                size += len(stretch[2])
                if size >= _OUT_BYTES:
                    out.append(pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), fields.types, strict=True)], schema=fields))
                    held, size = [], 0
        if held:
            out.append(pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*held, strict=True), fields.types, strict=True)], schema=fields))
        return pa.Table.from_batches(out, fields)

    known = blocks.select("block", "lang", "part", F.posexplode("words").alias("place", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    entry = F.shiftleft("id", 31).bitwiseOR(F.col("part").cast("long") * _LISTED + F.col("place"))  # ids are below 2**32
    listed = known.groupBy("block").agg(F.collect_list(entry).alias("w")).select(F.col("block").alias("of"), "w")  # words of a block, bounded by its size
    return blocks.select("block", "part", "tokens").groupBy("block").cogroup(listed.groupBy("of")).applyInArrow(meet, "order int, slice long, raw binary")


def _merged(streams: DataFrame, least: int, slices: int) -> DataFrame:
    """Counts of the n-grams from `least` on, slice by slice: w1, w2, w3 (null for pairs), f.

    About as many tasks as slices: adaptive execution would put several into one, whose rows come in one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def counted() -> Iterator[pa.RecordBatch]:
            pairs, thirds, f = _summed(held, at[0])
            often = f >= least
            columns = [(pairs >> np.uint64(32))[often], (pairs & np.uint64(0xFFFFFFFF))[often], thirds[often] if at[0] == 3 else None, f[often]]
            del pairs, thirds, f
            for a in range(0, len(columns[0]), _OUT_ROWS):
                rows = [c if c is None else c[a:a + _OUT_ROWS].astype(np.int64) for c in columns]
                yield pa.record_batch([pa.nulls(len(rows[0]), pa.int64()) if c is None else pa.array(c) for c in rows], names=["w1", "w2", "w3", "f"])

        for batch in batches:
            for order, number, raw in zip(batch.column("order").to_pylist(), batch.column("slice").to_pylist(), batch.column("raw"), strict=True):
                if at is not None and at != (order, number):
                    yield from counted()
                at = order, number
                held.append(_entries(raw.as_buffer(), order))
        if held:
            yield from counted()

    dealt = streams.repartition(2 * slices, "order", "slice").sortWithinPartitions("order", "slice")
    return dealt.mapInArrow(run, "w1 long, w2 long, w3 long, f long")


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = [f"cast({x} as decimal(20,0))" for x in (a, left, right)]
    return f"(cast(1000000 as decimal(38,0)) * {wide[0]} * {wide[0]}) div ({wide[1]} * {wide[2]})"


def candidates(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of two and three words that occur `least` times or more in their language: lang, phrase, a, the
    counts l and r of their lowest-scoring cut, score, and `longer`, the highest count of a triple that holds a pair;
    and all words of each language: lang, n."""
    blocks = stage(_blocks(docs), "blocks", _BATCH_BYTES, _READ_ROWS)
    total = blocks.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (s, c) -> s + c)")).alias("n"))
    total = stage(total, "totals", read_rows=_READ_ROWS)
    words = _numbered(blocks, least)
    slices = 1 + (total.agg(F.sum("n")).first()[0] or 0) // _SLICE
    ngrams = stage(_merged(_streams(blocks, words, slices), least, slices), "ngrams", _BATCH_BYTES, _READ_ROWS)
    word = words.withColumn("word", F.col("word").cast("string"))
    # prefix order: pairs and their first word; suffix order: pairs and their last word
    pairs = ngrams.where("w3 is null").select("w1", "w2", "f").hint("merge").join(
        word.select(F.col("id").alias("w1"), "lang", F.col("word").alias("x1"), F.col("f").alias("f1")), "w1").hint("merge").join(
        word.select(F.col("id").alias("w2"), F.col("word").alias("x2"), F.col("f").alias("f2")), "w2")
    pairs = stage(pairs, "pairs")
    triples = ngrams.where("w3 is not null").withColumnRenamed("f", "a")
    # prefix order: triples and their first two words; suffix order: triples and their last two
    both = triples.hint("merge").join(pairs.select("w1", "w2", "lang", "x1", "x2", "f1", F.col("f").alias("f12")), ["w1", "w2"]).hint("merge").join(
        pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("x2").alias("x3"), F.col("f").alias("f23"), F.col("f2").alias("f3")), ["w2", "w3"])
    cut = both.withColumn("s1", F.expr(_score("a", "f1", "f23"))).withColumn("s2", F.expr(_score("a", "f12", "f3")))
    late = F.col("s2") < F.col("s1")
    of_three = cut.select("lang", F.concat_ws(" ", "x1", "x2", "x3").alias("phrase"), "a", F.when(late, F.col("f12")).otherwise(F.col("f1")).alias("l"),
                          F.when(late, F.col("f3")).otherwise(F.col("f23")).alias("r"), F.least("s1", "s2").alias("score"), F.lit(None).cast("long").alias("longer"))
    extended = triples.select("w1", "w2", "a").unionAll(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    of_two = pairs.hint("merge").join(extended, ["w1", "w2"], "left").select(
        "lang", F.concat_ws(" ", "x1", "x2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"),
        F.expr(_score("f", "f1", "f2")).alias("score"), "longer")
    return of_two.unionByName(of_three), total


def top_phrases(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The best `top` candidates of each language, without those that a longer candidate stands for."""
    found, total = candidates(docs, least)
    kept = found.where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))  # first within parts of a language, so that no task sorts one whole
    first = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir):
    return top_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP11_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
    from documents),
tokens as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) g
    from tokens, (select unnest([1, 2, 3]) k) where len(w) >= k),
f as (select lang, g, count(*) f from grams group by all),
totals as (select lang, sum(f)::bigint n from f where len(g) = 1 group by lang),
cuts as (
    select c.lang, c.g, c.f a, k, x.f l, y.f r, (1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f) score
    from (select *, unnest(range(1, len(g))) k from f where f >= 10 and len(g) > 1) c
    join f x on x.lang = c.lang and x.g = c.g[1:k] join f y on y.lang = c.lang and y.g = c.g[k + 1:]),
scored as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
longer as (
    select lang, g, max(a) longer from (
        select lang, g[1:2] g, a from scored where len(g) = 3 union all select lang, g[2:3], a from scored where len(g) = 3) group by all),
kept as (
    select s.lang, array_to_string(s.g, ' ') phrase, a, l, r, score
    from scored s left join longer e on e.lang = s.lang and e.g = s.g where longer is null or 100 * longer < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) rank, phrase, a, l, r, n, score::bigint score
from kept join totals using (lang) qualify rank <= 2000
"""
