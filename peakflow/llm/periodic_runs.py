"""Runs: stretches of a text's words that repeat with a period, and the text without the repetitions.

Two equal stretches of words, i and j = i + q, with different words before them and after them, are a maximal pair. The
stretch from i to the end of the second one has period q and no neighbouring word extends it, so maximal
pairs of length L at a distance q <= L are the runs; one of them for each multiple of the period, of which the
smallest counts. They are enumerated over the tree of LCP intervals of the suffix array, from the bottom up: an interval
holds its places in order and, for each word before them, the places after that word. When two intervals join,
a place of the smaller one is paired with places of the larger one that follow another word and are near enough.
As a run has twice its period and `shortest` words at least, pairs are shorter than half of that in no
run, and only places whose first words in that number occur again need a place in the suffix array.

Input: columns doc_id and text; others, whatever their names, are ignored. Null and empty texts have no
words and no runs. Texts are read whole; one text is worked on in one task, in arrays of a few times its
size. Repeated rows and null ids come back once per row; of equal results nothing depends on order. An empty
table gives an empty result."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X

SHORTEST = 12  # words of a run
_RUNS = "array<struct<start:long,length:long,period:long>>"


def suffixes(words: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all texts whose first `least` words occur again in their text, sorted within each text,
    and how many words each has in common with the one before it (0 where another text begins).

    Ranks of stretches of 1, 2, 4, ... words are made from ranks of halves; the common length of two
    neighbours is read from the same ranks, longest stretches first."""
    n, text = len(words), np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words up to the end of the text
    ranks, size, kept = [], 1, np.arange(n)
    rank = np.unique(text * (int(words.max(initial=0)) + 1) + words, return_inverse=True)[1]
    while True:
        ranks.append(rank.astype(np.int32))
        count = np.bincount(rank[kept], minlength=1) if len(kept) else np.zeros(1, int)
        if size <= least:  # a stretch of no more than the least length that is alone rules its place out
            kept = kept[count[rank[kept]] > 1]
            again = len(kept) > 0
        else:
            again = len(kept) > 0 and count.max() > 1
        if not again:
            break
        second = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > size)
        second[inside] = rank[inside + size] + 1
        rank = np.unique(rank.astype(np.int64) * (n + 1) + second, return_inverse=True)[1]
        size *= 2
    order = kept[np.argsort(rank[kept], kind="stable")]
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            level = np.append(ranks[k], -1)  # ranks of different texts differ, and no two suffixes of a text end together
            same = np.flatnonzero((level[a] == level[b]) & (a < n))
            length[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        common[1:] = np.where(text[order[1:]] == text[order[:-1]], length, 0)
    return order, common


class _Interval:
    """Places below a node of the tree: in order, and by the word before them."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, word: int):
        self.places, self.classes = [place], {word: [place]}


def _pairs(small: _Interval, large: _Interval, length: int, least: int, words, begin: int, out: list) -> None:
    """Maximal pairs between two intervals: another word before, and a distance from `least` to `length`."""
    all_places, classes = large.places, large.classes
    for word, places in small.classes.items():
        for x in places:
            lo, hi = bisect_left(all_places, x - length), bisect_right(all_places, x + length)
            if lo == hi:
                continue
            if hi - lo <= len(classes):
                near = (y for y in all_places[lo:hi] if (words[y - 1] if y > begin else -1) != word)
            else:
                near = (y for other, there in classes.items() if other != word
                        for y in there[bisect_left(there, x - length):bisect_right(there, x + length)])
            for y in near:
                q = abs(x - y)
                if q >= least:
                    out.append((min(x, y), q + length, q))


def _joined(a: _Interval, b: _Interval) -> _Interval:
    small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
    for place in small.places:
        insort(large.places, place)
    for word, places in small.classes.items():
        there = large.classes.setdefault(word, [])
        for place in places:
            insort(there, place)
    return large


def runs_of(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts as rows (start from the first word of all texts, length, period), by start and
    period, and the offsets of the texts in them. `words` are numbers, equal for equal words."""
    least = (shortest + 1) // 2
    texts = _with_repeats(words, first, least)
    sizes = np.diff(first)[texts]
    at = X.ragged(first[:-1][texts], sizes)
    rows = _runs(words[at], np.append(0, np.cumsum(sizes)), shortest)
    rows[:, 0] = at[rows[:, 0]]
    return rows, np.searchsorted(rows[:, 0], first)


def _with_repeats(words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Texts in which some stretch of `size` words occurs again (and, by chance of equal hashes, perhaps others)."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    here = np.flatnonzero(X.complete(first, size))
    hashes = X.mix(X.windows(words.astype(np.uint64), size)[here] + text[here].astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    again = hashes[order[1:]] == hashes[order[:-1]]
    return np.unique(text[here[order[1:][again]]])


def _runs(words: np.ndarray, first: np.ndarray, shortest: int) -> np.ndarray:
    least = (shortest + 1) // 2
    order, common = suffixes(words, first, least)
    found: list[tuple[int, int, int]] = []
    inside = common >= least
    # neighbours with enough in common form a tree each; most hold two places far apart
    head = np.flatnonzero(inside & ~np.append(False, inside[:-1])) - 1
    tail = np.flatnonzero(inside & ~np.append(inside[1:], False))
    value, begins = words.tolist(), np.repeat(first[:-1], np.diff(first))
    for h, t in zip(head.tolist(), tail.tolist(), strict=True):
        places, shared = order[h:t + 1], common[h + 1:t + 1]
        if np.diff(np.sort(places)).min() > shared.max():
            continue
        begin = int(begins[places[0]])
        places, shared = places.tolist(), shared.tolist()
        open_: list[tuple[int, _Interval]] = []  # common length with what comes next, and the interval

        def leaf(x, begin=begin):
            return _Interval(x, value[x - 1] if x > begin else -1)

        def close(down_to, open_=open_, begin=begin):
            """Join intervals on the stack that have more in common than what follows."""
            while len(open_) > 1 and open_[-2][0] > down_to:
                length, a = open_[-2]
                above, b = open_[-1]
                small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
                _pairs(small, large, length, max(1, shortest - length), value, begin, found)
                open_[-2:] = [(above, _joined(a, b))]

        for x, length in zip(places, [*shared, 0], strict=True):
            open_.append((length, leaf(x)))
            close(length)
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.array(found, np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))]  # the smallest period of a stretch
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, `runs` (start, length, period; by start, then period) and `collapsed`, the words that
    no run has after its first period, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            words = X.words_of(part.column("text"))
            number = X.distinct_spans(words.data, words.starts, words.ends)[1]
            rows, at = runs_of(number, words.first, shortest)
            step = np.zeros(len(number) + 1, np.int64)
            np.add.at(step, rows[:, 0] + rows[:, 2], 1)
            np.add.at(step, rows[:, 0] + rows[:, 1], -1)
            keep = np.flatnonzero(np.cumsum(step[:-1]) == 0)
            begins, sizes = words.starts[keep], words.ends[keep] - words.starts[keep]
            flat = np.full(int(sizes.sum()) + len(keep), 0x20, np.uint8)  # each word and the space after it
            upto = np.cumsum(sizes + 1)
            flat[X.ragged(upto - sizes - 1, sizes)] = words.data[X.ragged(begins, sizes)]
            cut = np.append(0, upto)[np.searchsorted(keep, words.first)].tolist()
            raw = flat.tobytes()
            texts = [raw[a:max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
            start = rows[:, 0] - np.repeat(words.first[:-1], np.diff(at))
            items = pa.StructArray.from_arrays([pa.array(start), pa.array(rows[:, 1]), pa.array(rows[:, 2])], names=["start", "length", "period"])
            yield pa.record_batch([part.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), items), pa.array(texts, pa.string())],
                                  names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def planted(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text of a document as the query op12 takes it: in one of ten, by the checksum of its id, the words from a
    certain place on repeat the first of them."""
    g = f"(crc32(cast(cast({doc_id} as string) as binary)) div 10)"
    a = f"cast({g} % size(ws) as int)"
    p = f"cast(1 + ((size(ws) - {a}) div (3 + {g} % 8)) as int)"
    repeated = f"array_join(transform(sequence(0, size(ws) - 1), i -> ws[if(i < {a}, i, {a} + (i - {a}) % {p})]), ' ')"
    words = f"filter(split({text}, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), w -> w <> '')"
    each = F.expr(f"transform(array({words}), ws -> if(size(ws) = 0, '', {repeated}))[0]")
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.when(h % 10 == 0, each).otherwise(F.col(text))


def op12_periodic_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", planted().alias("text"))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return periodic_runs(docs).withColumn("_b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_b.s")).alias("start"), F.col("_b.length").alias("length"),
        (-F.col("_b.p")).alias("period"), F.expr("1000 * _b.length div -_b.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
