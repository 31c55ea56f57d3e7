"""Substring deduplication, Jaccard groups and components against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peakflow.llm import graph, jaccard_join, substring_dedup
from peakflow.llm import text as X
from tests.llm import brute

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    return brute.documents()


@pytest.fixture(params=[10_000, 7])
def batches(spark, request):
    """Results must not depend on where Arrow batches end."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield request.param
    spark.conf.set(key, before)


@pytest.mark.parametrize("share", [0.005, 0.0])
def test_cut_spans_equal_brute_force(spark, rows, batches, monkeypatch, share):
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)  # 0: anchors of more than a few documents are salted
    got = substring_dedup.parse(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(i, len(brute.words(t)), len(brute.words(t)) - len(k), hashlib.sha256(b" ".join(k)).hexdigest())
            for (i, t), k in zip(rows, brute.kept_words(rows), strict=True)]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)
    assert any(r.n_removed for r in got)
    text = dict(r for r in rows if r[0] is not None)
    for r in got:  # each factor stands in its source, and factors do not overlap
        at = 0
        for f in r.factors:
            assert f.start >= at and f.ref_doc < r.doc_id
            at = f.start + f.length
            assert brute.words(r.text)[f.start:at] == brute.words(text[f.ref_doc])[f.ref_start:f.ref_start + f.length]


@pytest.mark.parametrize("share", [0.005, 0.0])
def test_windows_that_agree_in_half_their_hash_differ(spark, monkeypatch, share):
    """Windows of one anchor and equal top 32 bits of their hashes, of which nothing must be cut."""
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)
    shared, lasts = " ".join(f"c{k}" for k in range(12)), [f"v{k}" for k in range(300_000)]
    _, hashes, anchors = substring_dedup._anchored(X.words_of(pa.array([f"{shared} {w}" for w in lasts])), 13)
    kinds, n = np.unique(anchors, return_counts=True)
    usual = np.flatnonzero(anchors == kinds[n.argmax()])
    top = hashes[usual] >> np.uint64(32)
    order = np.argsort(top)
    at = order[np.flatnonzero(top[order][1:] == top[order][:-1])[0]:][:2]
    rows = [(k, f"{shared} {lasts[usual[i]]}") for k, i in enumerate([*range(8), *at]) if k > 7 or i not in at]
    assert hashes[usual[at[0]]] != hashes[usual[at[1]]]
    got = substring_dedup.parse(spark.createDataFrame([*rows, (90, rows[-1][1])], SCHEMA)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 0 for i, _ in rows} | {90: 13}


def test_a_hot_window_is_one_row_of_a_document(spark, monkeypatch):
    """A document of one word repeated has one row for its window, with all places, and all of them are found."""
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 0.0)
    long = "w " * 3_000
    rows = [(k, f"x{k} " + long + f"y{k}") for k in range(30)]
    staged = {}
    monkeypatch.setattr(substring_dedup, "stage", lambda df, name: staged.setdefault(name, df.cache()))
    found = substring_dedup.parse(spark.createDataFrame(rows, SCHEMA).withColumns({"_seeds": F.lit("a"), "_DOC": F.lit(1)}))
    got = {r.doc_id: (r.n_removed, r._seeds, r._DOC) for r in found.collect()}
    assert got == {k: (3_000 if k else 0, "a", 1) for k, _ in rows}
    hot = staged["seeds"].where("hot_h is not null")
    assert hot.groupBy("hot_h", "hot_w", "doc_id").count().where("count > 1").count() == 0 < hot.count()
    assert hot.agg(F.max(F.size("starts"))).first()[0] == 3_000 - 12


def test_cut_documents_keeps_other_columns(spark):
    long = " ".join(f"a{k}" for k in range(20))
    docs = spark.createDataFrame([(1, long, 7, "x", "k"), (2, "b " + long, 9, "y", "l"), (3, "  b\nc ", 5, None, "m"), (4, long, 1, "z", "n"), (5, None, None, None, None)],
                                 "doc_id long, text string, n_chars int, n_words string, _seeds string")
    got = {r.doc_id: r for r in substring_dedup.cut_documents(docs).collect()}
    assert set(got) == {1, 2, 3, 5} and got[2].asDict() == {"doc_id": 2, "text": "b", "n_chars": 1, "n_words": "y", "_seeds": "l"}
    assert got[3].text == "  b\nc " and got[1].n_words == "x"


@pytest.mark.parametrize("size,num", [(3, 90), (5, 80), (1, 50)])
def test_groups_equal_brute_force(spark, rows, batches, size, num):
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA), size, num).collect()
    want = brute.groups(rows, size, num)
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert any(r.component_id != r.doc_id for r in got)


def test_groups_of_repeated_rows(spark, batches):
    """Two tokens of different documents must not be taken for one when every row is repeated."""
    rng = random.Random(2)
    while True:
        w = [f"q{rng.randrange(10**6)}" for _ in range(21)]
        docs = [w, ["first", *w[1:]], [*w[:-1], "last"], [*w[:10], "middle", *w[11:]]]
        values, first = jaccard_join._sets(pa.array([" ".join(d) for d in docs]), 3)
        z, a, c, b = (values[i:j][:2].tolist() for i, j in zip(first[:-1], first[1:], strict=True))
        if z == b and not set(z) <= set(a) and not set(z) <= set(c) and set(z) & set(a) and set(z) & set(c) and set(z) & set(a) != set(z) & set(c):
            break
    rows = [(k + 1, " ".join(d)) for k, d in enumerate(docs)] * 2
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA), 3, 90).collect()
    assert len(got) == 8 and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.groups(rows, 3, 90)
    assert brute.groups(rows, 3, 90)[3] == (19, 1)


@pytest.mark.parametrize("tile, dense, edits", [(16, 1, 3), (8, 0, 4), (32, 0, 6)])
def test_groups_over_many_tiles(spark, monkeypatch, tile, dense, edits):
    """A dense group over several blocks: forests, blocks that meet later, exact tiles."""
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    rng = random.Random(5)
    base = brute.prose(rng, 60, 5_000).split()
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(10_000)}"
        rows.append((i, " ".join(w[:60 - i % 3])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA), 3, 90).collect()}
    assert got == brute.groups(rows, 3, 90)


def test_similar_but_unlinked_documents_end_in_two_rounds(spark, monkeypatch):
    """2,000 documents of a similarity of 0.85 to 0.89, and a few true links among them."""
    staged = []
    monkeypatch.setattr(jaccard_join, "stage", lambda df, name, real=jaccard_join.stage: (staged.append(name), real(df, name))[1])
    rng = random.Random(8)
    rows = [(i, " ".join([f"b{k}" for k in range(300)] + [f"u{rng.randrange(10**9)}" for _ in range(20)])) for i in range(2_000)]
    rows += [(2_000 + i, rows[7 * i][1] + " end") for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA), 3, 90).collect()}
    assert got == {i: i for i in range(2_000)} | {2_000 + i: 7 * i for i in range(40)}
    assert staged.count("found") == 2 and staged.count("dense") == 1


def test_true_links_equal_brute_force():
    rng = np.random.default_rng(3)
    arrays = [np.sort(rng.choice(60, rng.integers(1, 50), replace=False)).astype(np.uint64) for _ in range(40)]
    comp, side = rng.integers(0, 30, 40), np.zeros(40, int)
    links = jaccard_join.true_links(arrays, comp, side, 60, 100)

    def classes(pairs):
        up = list(range(30))
        for a, b in pairs:
            x, y = up[comp[a]], up[comp[b]]
            up = [y if u == x else u for u in up]
        return [up.index(u) for u in up]

    every = [(a, b) for a in range(40) for b in range(a) if 100 * len(c := np.intersect1d(arrays[a], arrays[b])) >= 60 * (len(arrays[a]) + len(arrays[b]) - len(c))]
    assert set(map(tuple, np.sort(links, axis=1)[:, ::-1].tolist())) <= set(every) and classes(links) == classes(every)


def test_keep_one_of_each_group(spark):
    rng = random.Random(1)
    text, other = brute.prose(rng, 50), brute.prose(rng, 50)
    rows = [(4, text, 1), (2, text + " end", 2), (9, None, 3), (None, text, 4), (5, other, 5), (5, other, 5), (None, other + " x", 6), (None, other + " x", 6),
            (2, brute.prose(rng, 50), 7), (None, brute.prose(rng, 50), 8), (None, None, 9), (9, None, 3), (6, " ", 10)]
    docs = spark.createDataFrame(rows, SCHEMA + ", component_id int").withColumns({"_node": F.lit("x"), "c0": F.lit("y"), "n": F.lit(1)})
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = sorted(r.component_id for r in kept.collect())
    assert left in ([2, 3, 3, 5, 7, 8, 9, 10],)
    copies = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], SCHEMA)
    assert [r.doc_id for r in jaccard_join.keep_one(copies).collect()] == [1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.parse(none).count() == jaccard_join.similar_groups(none).count() == 0


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
