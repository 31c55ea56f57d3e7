"""Language model, language identification, co-training and URL rules."""

import gc
import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from peakflow.llm import cotraining, langid, ngram_lm, url_rules
from tests.llm import brute

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"


@pytest.mark.parametrize("slice_bytes", [3_000, 8 << 20])
def test_base_scores_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(ngram_lm, "PART_BYTES", 4_000)
    monkeypatch.setattr(ngram_lm, "SLICE_BYTES", slice_bytes)
    rows = brute.documents()
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    got = ngram_lm.score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).collect()
    counts: Counter = Counter()
    tokens = [(i, brute.words(t, lower=True) + [None], zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2) for i, t in rows]
    for _, w, held in tokens:
        counts.update([] if held else w)
    total = sum(counts.values())
    want = Counter((i, held, len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + len(counts) + 1)) for x in w), 6)) for i, w, held in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


@pytest.mark.parametrize("slice_bytes", [1, 3_000, 8 << 20])
def test_every_word_has_its_own_contexts_and_bigrams(spark, monkeypatch, slice_bytes):
    """Scores equal brute force however many slices and parts there are."""
    monkeypatch.setattr(ngram_lm, "PART_BYTES", 4_000)
    monkeypatch.setattr(ngram_lm, "SLICE_BYTES", slice_bytes)
    rows = [*brute.documents(), *((1000 + k, f"red{k % 7} green{k % 7} blue red{k % 3} green{k % 3}") for k in range(120))]
    got = ngram_lm.score(spark.createDataFrame(rows, DOC).repartition(3), F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).collect()
    name = {i: "" if i is None else str(i) for i, _ in rows}
    tokens = [(i, ["<s>", *brute.words(t, lower=True), None], zlib.crc32(name[i].encode()) % 7 == 2, zlib.crc32(f"deleted:{name[i]}".encode()) % 10 == 0) for i, t in rows]

    def counts(use):
        uni, con, bi = Counter(), Counter(), Counter()
        for _, w, held, deleted in tokens:
            if use(held, deleted):
                uni.update(w[1:])
                con.update(w[:-1])
                bi.update(zip(w[:-1], w[1:], strict=True))
        return uni, con, bi, sum(uni.values()) + len(uni) + 1

    uni, con, bi, norm = counts(lambda held, deleted: not held and not deleted)
    cells = Counter()
    for _, w, held, deleted in tokens:
        for a, b in zip(w[:-1], w[1:], strict=True) if deleted and not held else ():
            ratio = bi[a, b] / max(con[a], 1) / ((uni[b] + 1) / norm)
            cells[int(con[a]).bit_length(), int(np.clip(np.round(np.log(ratio) / ngram_lm._BIN) + ngram_lm._BINS // 3, 1, ngram_lm._BINS - 1)) if bi[a, b] else 0] += 1
    lam = ngram_lm.weights(cells)
    uni, con, bi, norm = counts(lambda held, deleted: not held)
    want = Counter()
    for i, w, _, _ in tokens:
        at = [(lam[int(con[a]).bit_length()], bi[a, b] / max(con[a], 1), (uni[b] + 1) / norm) for a, b in zip(w[:-1], w[1:], strict=True)]
        want[i, len(w) - 1, round(sum(math.log10(x * p + (1 - x) * q) for x, p, q in at), 5)] += 1
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 5)) for r in got) == want


def test_probabilities_sum_to_one():
    """After any context the words and the mass of an unseen one make one."""
    words, lam = np.array([5, 3, 2, 4]), np.full(64, 0.3)
    lam[0] = 0
    norm = words.sum() + len(words) + 1.0
    for after in ([2, 0, 3, 0], [1, 1, 1, 1], [0, 0, 0, 0]):
        seen = np.array(after)
        context = np.full(4, seen.sum())
        unseen = ngram_lm.mixed(lam, np.zeros(1), context[:1], np.zeros(1), norm)
        assert ngram_lm.mixed(lam, seen, context, words, norm).sum() + unseen.sum() == pytest.approx(1)


def test_bigram_in_every_document_and_odd_columns(spark, monkeypatch):
    """A bigram of every document, repeated rows, one very long text and columns with names of the operator's own."""
    monkeypatch.setattr(ngram_lm, "SLICE_BYTES", 2_000)
    rows = [(k, "of the " + ("word%d " % (k % 5)) * 3, k, "x") for k in range(200)] * 2 + [(900, "of the " * 30_000, 0, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, DOC + ", slice long, body string").repartition(4)
    got = ngram_lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {400 * 6 + 60_001 + 1}
    assert next(r.n_tokens for r in got if r.doc_id == 900) == 60_001
    assert all(len({r.score for r in got if r.doc_id == k}) == 1 for k in (0, 7, 199))
    assert next(r for r in got if r.doc_id == 900).score > 0.1 * next(r for r in got if r.doc_id == 900).base_score


def test_questions_and_answers_take_little_memory(monkeypatch):
    """Peaks of asking and of meeting the answers, as multiples of a slice's text (14.7 each before)."""

    class Frame:
        def __getattr__(self, name):
            return lambda *args: tasks.extend(x for x in args if callable(x)) or self

    tasks: list = []
    monkeypatch.setattr(ngram_lm, "stage", lambda df, *args: df)
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"word{k}" for k in range(50_000)])
    texts = [" ".join(vocabulary[rng.zipf(1.3, 600) % 50_000]) for _ in range(1_000)]
    size = sum(map(len, texts))
    batch = pa.record_batch([pa.array(range(1_000)), pa.array(np.arange(1_000) % 3, pa.int8()), pa.array(texts)], names=["doc_id", "role", "text"])
    body = pa.record_batch([pa.array([7]), pa.array([ngram_lm._pack(batch)], pa.binary())], names=["slice", "body"])

    def peak(work):
        gc.collect()
        tracemalloc.start()
        try:
            out = work()
            return out, tracemalloc.get_traced_memory()[1] / size
        finally:
            tracemalloc.stop()

    frame = Frame()
    ngram_lm._answers(frame, 2)
    ngram_lm._counted(frame, frame, 2, 1e6)
    ask, answer, meet = tasks
    asked, asking = peak(lambda: pa.Table.from_batches(ask(iter([body]))))
    told = pa.concat_tables([answer(asked.filter(pc.equal(asked.column("part"), part))) for part in pc.unique(asked.column("part"))])
    counted, meeting = peak(lambda: meet(pa.Table.from_batches([body]), told.filter(pc.is_valid(told.column("slice")))))
    assert counted.num_rows == 1
    assert asking < 8 and meeting < 9


def test_slices_come_in_batches_of_bounded_bytes(spark, monkeypatch):
    """Rows of long texts make no large Arrow batch, and the session keeps its setting."""
    key, seen, real = "spark.sql.execution.arrow.maxBytesPerBatch", spark.sparkContext.accumulator(0), ngram_lm.X.slices
    before = spark.conf.get(key, None)

    def slices(batches, **named):
        for batch in batches:
            seen.add(int(batch.nbytes > 80_000))
            yield from real(iter([batch]), **named)

    monkeypatch.setattr(ngram_lm.X, "slices", slices)
    monkeypatch.setattr(ngram_lm, "SLICE_BYTES", 50_000)
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a bc "), 500).alias("text"))
    assert ngram_lm._sliced(docs, F.lit(False)).count() > 15
    assert seen.value == 0 and spark.conf.get(key, None) == before


def test_model_beats_base_on_held_out(spark):
    got = ngram_lm.op4_deleted_interpolation(spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.95 * got[1]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOC)
    got = ngram_lm.score(docs, F.lit(True)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert ngram_lm.score(docs.limit(0), F.lit(True)).count() == 0


def test_weights_follow_the_held_out_counts():
    lam = ngram_lm.weights({(3, ngram_lm._BINS // 3 + 40): 99, (3, 0): 1, (5, 0): 50, (5, 200): 1})
    assert lam[3] > 0.9 and lam[5] < 0.1 and lam[0] == 0


def test_language_accuracy_on_held_out(spark):
    found = langid.op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n, right = found.where("held_out").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert right / n > 0.98 and found.where("score < 0 or score > 1 or score is null").count() == 0


def test_undetermined_texts(spark):
    rows = [(k, "the cat and the dog " * 3, "en") for k in range(8)] + [(k, "der hund und die katze " * 3, "de") for k in range(8, 16)]
    odd = [(20, None, "en"), (21, "", None), (22, "12 + 3\n", "de"), (23, "のに", None), (24, "x", None), (None, "der die und", None)]
    model = langid.train(spark.createDataFrame(rows + odd, DOC + ", lang string"), F.lit(True))
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(rows + odd, DOC + ", lang string"), model).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (20, 21, 22))
    assert all(got[k].lang_pred in ("en", "de") for k in (23, 24)) and got[None].lang_pred == "de" and got[3].lang_pred == "en"
    nothing = langid.train(spark.createDataFrame(odd, DOC + ", lang string"), F.lit(False))
    assert {r.lang_pred for r in langid.predict(spark.createDataFrame(odd, DOC + ", lang string"), nothing).collect()} == {"und"}


def test_cotraining_accuracy(spark):
    got = cotraining.op6_cotraining(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    by = {r.quality: r.rate for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert by[1] > 0.97 and by[0] < 0.2


def test_cotraining_accuracy_on_labels_it_did_not_see(spark):
    """Trained on the labels of two thirds of the documents, judged on those of the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source", "lang", "n_chars")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = cotraining.classify(docs, labels.where(~unseen), rounds=2).join(labels.where(unseen), "doc_id").collect()
    right = [(r.score >= 0.5) == (r.quality == 1) for r in got]
    assert len(right) > 50 and sum(right) / len(right) > 0.9


def test_most_confident_labels_are_exchanged(spark, monkeypatch):
    """One round by hand: of the unlabelled documents the surest of each view and class go to the other view."""
    given = []
    monkeypatch.setattr(cotraining, "_features", lambda df, real=cotraining._features: (given.append({(r.doc_id, r.y) for r in df.select("doc_id", "y").collect()}), real(df))[1])
    scored = []
    monkeypatch.setattr(cotraining, "_scored", lambda *a, real=cotraining._scored: (scored.append(real(*a)), scored[-1])[1])
    monkeypatch.setattr(cotraining, "CONFIDENT", 0.6)
    rows = [(k, ("good words in a row " * (1 + k % 5)) if k % 2 else "!!! ### $$$ " * (1 + k % 7), "s" if k % 2 else "t", "en", 5 + k % 9) for k in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, k % 2) for k in range(24)] + [(900, 1)] * 3, "doc_id long, quality int")
    cotraining.classify(docs, labels, sample=24, rounds=1, pseudo=6)
    assert len(given[0]) == 24  # labels without a document do not take a place in the sample
    free = [r for r in scored[0].collect() if r.doc_id >= 24]
    want = [set(), set()]
    for k, name in enumerate(("content_score", "metadata_score")):
        for y in (1.0, 0.0):
            sure = sorted((r[name] if y else 1 - r[name] for r in free), reverse=True)
            cut = sure[5]
            chosen = {r.doc_id for r in free if (r[name] if y else 1 - r[name]) >= max(cut, 0.6)}
            want[1 - k] |= {(i, y) for i in chosen}
    for view in (0, 1):
        assert given[1 + view] <= want[view] and len({y for _, y in given[1 + view]}) == 2
        assert all(sum(y == c for _, y in given[1 + view]) == min(6, sum(y == c for _, y in want[view])) for c in (0.0, 1.0))


DOCS = DOC + ", source string, lang string, n_chars long"


def test_cotraining_edges(spark):
    rows = [(k, "good words in a row" if k % 2 else "!!! ### $$$", None, "en", 5) for k in range(40)] + [(50, None, "s", None, None), (50, None, "s", None, None), (None, "good", "s", "x", 1)]
    docs, label = spark.createDataFrame(rows, DOCS), "doc_id long, quality int"
    got = {r.doc_id: r.score for r in cotraining.classify(docs, spark.createDataFrame([(k, k % 2) for k in range(24)] + [(None, 1), (30, None), (999, 0)], label), rounds=1).collect()}
    assert len(got) == 42 and got[31] > 0.5 > got[30]
    one = cotraining.classify(docs, spark.createDataFrame([(k, 1) for k in range(9)], label)).collect()
    assert len(one) == 43 and {r.score for r in one} == {1.0}
    assert {r.score for r in cotraining.classify(docs, spark.createDataFrame([], label)).collect()} == {0.5}
    assert cotraining.classify(docs.limit(0), spark.createDataFrame([], label)).count() == 0


def test_listed_rules_equal_brute_force(spark):
    urls = ["http://net/x", "https://A.Example.NET/en/1?q", "http://example.net/en", "http://example.com/de/2", "http://m.example.com/fr/", "ftp://x.org/fr/#a", "http://xnet/", "net/", None,
            "", "http://example.net", "http://a.net?x=/en/", "x://example.org/fr/?a://b", "http://user@org/fr/", "http://example.net/en/\nz"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(1, urls[1]), (None, urls[0])], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")

    def want(url):
        host = path = ""
        if url and "://" in url:
            after = url.split("://", 1)[1]
            cut = min([after.find(c) for c in "/?#" if c in after] or [len(after)])
            host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in after[:cut]), after[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"

    got = url_rules.judge(pages, labels).collect()
    assert len(got) == len(urls) + 2
    assert all((r.host, r.path, r.rule, r.verdict) == want(urls[r.page_id if r.page_id is not None else 0]) for r in got)
    assert url_rules.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_block(spark):
    rows = [(k, f"http://spam.site{k % 7}.test/win/{k}") for k in range(40)] + [(k, f"http://www.site{k % 7}.test/en/{k}") for k in range(40, 120)] \
        + [(200, "http://spam.other.test/win/9"), (201, "http://www.other.test/en/9"), (202, "http://spam.other.test/en/9"), (203, None)]
    labels = spark.createDataFrame([(k, int(k >= 40), None) for k in range(110)] + [(None, 0, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"), labels, rules=()).collect()}
    assert got[200].verdict == "block" and got[201].verdict == "allow" and got[203].verdict == "allow" and got[3].mined_rule
    for r in got.values():  # what is blocked has every token of its rule
        if r.mined_rule:
            assert all(t.split(":")[1] in (r.host + r.path) for t in r.mined_rule.split())


def test_mined_rules_equal_brute_force(spark):
    """All token sets of at least 20 labelled URLs that block well above the base rate, unless one within is as good."""
    rng, rows = random.Random(4), []
    for _ in range(400):
        words = [w for w in ("win", "cash", "news", "shop", "blog", "2024x") if rng.random() < 0.35]
        bad = rng.random() < (0.95 if {"win", "cash"} <= set(words) else 0.8 if "shop" in words and "blog" not in words else 0.25)
        rows.append(("http://" + rng.choice("ab") + ".test/" + "/".join(words), bad))
    rules = {tuple(sorted(r.tokens)): (r.confidence, r.support) for r in url_rules.mine(spark.createDataFrame(rows, "url string, blocked boolean")).collect()}
    sets = [frozenset(["h:" + u[7], *("p:" + w for w in u[14:].split("/") if w)]) for u, _ in rows]
    base = sum(b for _, b in rows) / len(rows)
    tokens = sorted({t for s in sets for t in s})
    good = {}
    for size in range(1, len(tokens) + 1):
        for c in itertools.combinations(tokens, size):
            hit = [b for s, (_, b) in zip(sets, rows, strict=True) if s >= set(c)]
            if sum(hit) >= 20 and sum(hit) / len(hit) > base + (1 - base) / 3 and sum(hit) / len(hit) >= 0.5:
                good[c] = sum(hit) / len(hit)
    best = {c: x for c, x in good.items() if not any(set(o) < set(c) and y >= x for o, y in good.items())}
    assert rules.keys() == best.keys() and len(best) > 2
    assert all(abs(rules[c][0] - x) < 1e-9 for c, x in best.items())


def test_rules_at_every_size_and_base_rate(spark):
    page, label = "page_id long, url string", "doc_id long, quality int, toxic int"
    few = spark.createDataFrame([(k, f"http://x{k}.test/only{k}") for k in range(30)], page)
    got = url_rules.judge(few, spark.createDataFrame([(k, 0, None) for k in range(15)] + [(k, 1, None) for k in range(15, 30)], label), rules=())
    assert got.where("mined_rule is not null").count() == 0  # no rule from a single URL
    many = spark.createDataFrame([(k, f"http://{'spam' if k < 350 else 'fine'}.test/{k}") for k in range(400)], page)
    for labels in ([(k, int(k >= 350), None) for k in range(400)], [(k, None, int(k < 350)) for k in range(400)]):
        verdicts = {r.page_id: r.verdict for r in url_rules.judge(many, spark.createDataFrame(labels, label), rules=()).collect()}
        assert verdicts == {k: "block" if k < 350 else "allow" for k in range(400)}
