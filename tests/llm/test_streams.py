"""Phrase collocations, periodic runs, byte-level BPE: each against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakflow.llm import byte_bpe, collocations, periodic_runs, text
from peakflow.llm.byte_bpe import op13_byte_bpe
from peakflow.llm.periodic_runs import op12_periodic_runs

SF, DOC = "/root/testdata/sf0.001", "doc_id long, text string, lang string"


# ---------------------------------------------------------------- phrases

def plain_phrases(rows, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                for k in range(len(w) - size + 1):
                    f[lang, tuple(w[k:k + size])] += 1
    out = []
    for (lang, g), a in f.items():
        if len(g) == 1 or a < least:
            continue
        if len(g) == 2 and any(100 * b >= inside * a for (x, h), b in f.items() if x == lang and len(h) == 3 and b >= least and g in (h[:2], h[1:])):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    result, rank = set(), Counter()
    for lang, s, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.add((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -s))
    return result


def phrase_rows(seed=1):
    rng, rows = random.Random(seed), []
    for _ in range(300):
        words = [f"w{int(rng.paretovariate(0.8)) % 40}" for _ in range(rng.randint(0, 60))]
        t = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".", "\x01 ", "　", "\n"]) for w in words)
        rows.append((rng.choice(["a", "b", None, "und"]), t + rng.choice(["New York City", "a b c d", "É É É", "", "x x x x x"])))
    return rows + [("a", None), (None, None), ("c", ""), ("c", "..."), rows[0], rows[0], ("a", "la " * 20_000), ("z", "p q " * 9)]


@pytest.mark.parametrize("block, slices", [(1 << 20, 1 << 21), (300, 200)])
def test_phrases_equal_brute_force(spark, monkeypatch, block, slices):
    monkeypatch.setattr(collocations, "_BLOCK", block)
    monkeypatch.setattr(collocations, "_SLICE", slices)
    rows = phrase_rows()
    docs = spark.createDataFrame([(None, t, x) for x, t in rows], DOC).withColumns({"word": F.lit("clash"), "f": F.lit(1), "block": F.lit("x")})
    got = collocations.top_phrases(docs.repartition(3))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain_phrases(rows)
    few = collocations.top_phrases(docs, top=3)
    assert {tuple(r) for r in few.collect()} == plain_phrases(rows, top=3)


def test_rows_of_a_block_are_short(spark):
    """A block was one row of all its words and places, and 1,000,000 places made buffers of many megabytes."""
    t = " ".join(f"w{k % 20_000}" for k in range(100_000)) + ". x"
    rows = collocations._blocks(spark.createDataFrame([(None, t, "a"), (None, "y. z", None)], DOC).coalesce(1)).collect()
    assert max(len(r.tokens) for r in rows) <= 1 << 15 and max(len(r.words) for r in rows) <= 1 << 13
    assert len({r.block for r in rows}) == 2 and all(len(r.words) == len(r.counts) for r in rows)
    for lang, want in (("a", t), ("und", "y. z")):
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: r.part)
        words, tokens = [bytes(w) for r in own for w in r.words], [k for r in own for k in r.tokens]
        assert b" ".join(b"." if k < 0 else words[k] for k in tokens).decode() == want.replace(".", " .") + " ."
        counts = [c for r in own for c in r.counts]
        assert Counter(k for k in tokens if k >= 0) == Counter(dict(enumerate(counts))) and len(set(words)) == len(words)


def test_long_words_fill_a_block(spark, monkeypatch):
    """Only words were counted, so a block held long ones without a bound."""
    monkeypatch.setattr(collocations, "_BLOCK", 300)
    docs = spark.createDataFrame([(None, chr(97 + k) * 40_000, "a") for k in range(5)], DOC).coalesce(1)
    monkeypatch.setattr(text.slices, "__defaults__", ("text", 1000))
    assert collocations._blocks(docs).select("block").distinct().count() == 5


def test_phrases_over_many_rows_of_a_block(spark, monkeypatch):
    for name, value in (("_LISTED", 3), ("_RUN", 5), ("_OUT_BYTES", 100), ("_OUT_ROWS", 2)):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows(2)
    got = collocations.top_phrases(spark.createDataFrame([(None, t, x) for x, t in rows], DOC).repartition(2))
    assert {tuple(r) for r in got.collect()} == plain_phrases(rows)


def test_slices_of_a_stream_are_not_gathered_in_one_task(spark):
    """Adaptive execution put many slices into a task, whose rows then came in one batch."""
    raw = collocations._planes([np.array([1, 0, 4]), np.array([2, 3, 1]), np.array([5, 6, 7])])  # pairs (1, 2), (1, 3), (5, 1)
    streams = spark.createDataFrame([(2, k, raw) for k in range(40) for _ in range(2)], "order int, slice long, raw binary")
    merged = collocations._merged(streams, 11, 40).withColumn("task", F.spark_partition_id()).collect()
    assert {(r.w1, r.w2, r.w3, r.f) for r in merged} == {(1, 3, None, 12), (5, 1, None, 14)}
    assert len(merged) == 80 and max(Counter(r.task for r in merged).values()) < 20


def test_phrases_of_large_counts_are_exact(spark):
    row = spark.sql(f"select {collocations._score('a', 'l', 'r')} s from values (999999999999L, 1000000000000L, 999999999999L) t(a, l, r)").first()
    assert row.s == 10**6 * 999_999_999_999**2 // (10**12 * 999_999_999_999)


def test_phrases_of_an_empty_table(spark):
    assert collocations.top_phrases(spark.createDataFrame([], DOC)).collect() == []


# ---------------------------------------------------------------- runs

def plain_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted_words(doc_id, t):
    w = re.findall("[^\x20\x09-\x0d]+", t or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_digest(w):
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@given(st.lists(st.lists(st.integers(0, 2), max_size=50), max_size=4), st.sampled_from([2, 5, 12]))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(texts, shortest):
    first = np.cumsum([0, *map(len, texts)])
    rows, at = periodic_runs.runs_of(np.array([x for t in texts for x in t], np.int64), first, shortest)
    for k, t in enumerate(texts):
        got = [(int(s - first[k]), int(n), int(q)) for s, n, q in rows[at[k]:at[k + 1]]]
        assert got == plain_runs(t, shortest)


@pytest.mark.parametrize("words, runs", [
    ([0] * 30_000, 1), ([0, 1, 2] * 10_000, 1), (list(range(6_000)) * 2, 1), (([0] * 14 + [1]) * 900, 901), ([7, 8, 9, 7, 8, 9, 7], 0),
])
def test_runs_of_long_texts(words, runs):
    rows, _ = periodic_runs.runs_of(np.array(words), np.array([0, len(words)]))
    assert len(rows) == runs


def test_runs_of_a_query_equal_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r[0]: tuple(r[1:]) for r in op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == docs.keys() and any(g[0] for g in got.values())
    for i, t in docs.items():
        assert got[i] == run_digest(planted_words(i, t)), i


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "la " * 30, "x " + "a b\x0bc\r" * 9 + "end", "É é " * 10, "a b " * 40_000]
    rows = [(k, t, None) for k, t in enumerate(texts)] * 2 + [(None, "la " * 30, "x")]
    df = spark.createDataFrame(rows, DOC).withColumns({"runs": F.lit("clash"), "n_words": F.lit("clash"), "start": F.lit(0)})
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.periodic_runs(df).collect())
    want = Counter()
    for i, t, _ in rows:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = [(0, 80_000, 2)] if i == 7 else plain_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, len(w), tuple(runs), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    assert got == want
    assert periodic_runs.periodic_runs(df.limit(0)).collect() == []
    planted = df.select("doc_id", periodic_runs.planted().alias("t"), "text").collect()
    split = re.compile("[^\x20\x09-\x0d]+")
    assert all(split.findall(r.t or "") == planted_words(r.doc_id, r.text) for r in planted)


# ---------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    ranks = byte_bpe.load_ranks(byte_bpe.rank_path())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(byte_bpe.load_ranks(byte_bpe.rank_path()), byte_bpe.class_runs())


def check(coder, library, texts):
    ids, first = coder.encode(pa.array(texts, pa.string()))
    ends = coder.ends(ids, first)
    for k, t in enumerate(texts):
        own, raw = ids[first[k]:first[k + 1]], (t or "").encode()
        assert own.tolist() == library.encode_ordinary(t or ""), repr(t)
        assert coder.decode(own) == raw
        cuts = [0, *ends[first[k]:first[k + 1]].tolist()]
        assert [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == [library.decode_single_token_bytes(i) for i in own]


ODD = "  \t\n\r\x0b\x85\xa0 　''''srtvlelmdaZé9٣½x!?-_́\U0001F600中ǅʼ‍\x00<|>"


@given(st.lists(st.one_of(st.none(), st.text(alphabet=ODD, max_size=40), st.text(max_size=20)), max_size=8))
@settings(max_examples=400, deadline=None)
def test_ids_equal_the_library(coder, library, texts):
    check(coder, library, texts)


def test_ids_of_long_texts(coder, library):
    rng = random.Random(2)
    texts = ["a" * 9_000, " " * 5_000, "'re" * 3_000, "".join(rng.choice("abcdefgh") for _ in range(5_000)), "\n\n x" * 2_000, "中文字" * 999]
    check(coder, library, [*texts, None, "", " ".join(texts)])


def test_every_class_of_the_table(coder, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    check(coder, library, ["".join(f"a{c}1{c}{c} {c}!" for c in points[k:k + 200]) for k in range(0, len(points), 200)])


def test_scan_equals_folding():
    generator, products, images, _ = byte_bpe.automaton()
    rng = np.random.default_rng(1)
    for n in (1, 64, 65, 5_000, 70_001):
        symbols = generator[rng.integers(0, len(generator), n)]
        state, want = 0, []
        for e in symbols.tolist():
            state = images[e][state]
            want.append(state)
        assert images[byte_bpe.scan(symbols, products), 0].tolist() == want


def test_spans_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(text, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    data, starts = np.frombuffer(b"aabbaabc", np.uint8), np.array([0, 2, 4, 6])
    first, inverse = text.distinct_spans(data, starts, starts + 2)
    assert first.tolist() == [0, 1, 3] and inverse.tolist() == [0, 1, 0, 2]


def test_coding_of_a_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r[0]: tuple(r[1:]) for r in op13_byte_bpe(spark, SF).collect()}
    assert got == {i: (len(ids := library.encode_ordinary(t)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                   for i, t in docs.items()}


def test_coding_of_odd_rows(spark, library):
    path = byte_bpe.rank_path()
    rows = [(1, "it's  a <|endoftext|> \n", "x"), (1, "it's  a <|endoftext|> \n", "x"), (None, "é", None), (2, None, None), (3, "", None), (4, "word " * 30_000, None)]
    df = spark.createDataFrame(rows, DOC).withColumns({"ids": F.lit("clash"), "ends": F.lit(1), "decoded": F.lit(2)})
    coded = byte_bpe.encode(df, path)
    assert coded.columns == ["doc_id", "ids", "ends"]
    back = byte_bpe.decode(coded.withColumn("decoded", F.lit("clash")), path)
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in back.collect())
    assert got == Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows)
    assert byte_bpe.decode(byte_bpe.encode(df.limit(0), path), path).collect() == []
    assert byte_bpe.decode(coded.limit(1).withColumn("ids", F.lit(None).cast("binary")), path).first().decoded is None
