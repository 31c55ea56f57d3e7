import re
"""Decontamination, quality rules, WARC archives, packing and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import database, rows_of
from peakflow.llm import decontaminate, packing, quality_rules, text, warc
from peakflow.llm.queries import oracle_sql, queries
from tests.helpers import plan_of
from tests.llm import brute

SF, DOC = "/root/testdata/sf0.001", "doc_id long, text string"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    df = queries()[name](spark, SF)
    result = database(SF).execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1c\xa0aBcÉ\u3000", max_size=12)), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_of_columns(texts):
    import pyarrow as pa

    w = text.words_of(pa.array(texts, pa.string()), lower=True)
    got = [[bytes(w.data[s:e]) for s, e in zip(w.starts[a:b], w.ends[a:b], strict=True)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [brute.words(t, lower=True) for t in texts]
    flat = [x for t in got for x in t]
    assert len(set(zip(flat, w.hashes().tolist(), strict=True))) == len(set(flat)) == len(set(w.hashes().tolist()))


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (12, "alpha BETA-gamma delta epsilon zeta eta theta iota kappa"), (3, "short item"), (4, None), (5, "!!"), (3, "short item")]
TEXTS = [(1, "x Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda y"), (2, "a short item, short ITEM short"), (3, None), (4, ""), (5, "alpha beta"), (1, "x Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda y"),
         (None, "short item"), (1, "another text"), (9, "é1 " * 5_000 + "short item")]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate.hits, "__defaults__", (10, limit))
    docs, items = spark.createDataFrame(TEXTS, DOC).withColumn("n_hit", F.lit("clash")), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in decontaminate.contamination(docs, items).collect())
    want = Counter()
    for i, t in TEXTS:
        n, hit, sha = brute.contaminated(t, ITEMS)
        want[i, n, hit, sha, hit > 0] += 1
    assert got == want
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3", "4", "5"]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination_keeps_columns_with_underscores(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate.hits, "__defaults__", (10, limit))
    clash = {c: F.lit(c) for c in ("_id", "_HASH", "_items", "_spans", "_h", "_n", "_d", "_t", "start", "w", "h")}
    docs = spark.createDataFrame([(1, "a short item"), (2, "b"), (None, "short item"), (None, "short item")], DOC).withColumns(clash)
    found = decontaminate.contamination(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert found.columns[:len(docs.columns)] == docs.columns
    assert sorted(str((r.doc_id, r.n_hit)) for r in found.collect()) == ["(1, 2)", "(2, 0)", "(None, 2)", "(None, 2)"]
    assert all(r[c] == c for r in found.collect() for c in clash)


def test_contamination_plan_is_native_and_scans_few_columns(spark):
    plan = plan_of(decontaminate.op1_benchmark_decontamination(spark, SF))
    assert "BroadcastHashJoin" in plan and not any(w in plan for w in ("Python", "InArrow", "CartesianProduct"))


def test_no_benchmark_or_documents(spark):
    docs, items = spark.createDataFrame(TEXTS, DOC), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, items).where("contaminated or n_items > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_quality_base_and_distances(spark):
    rows = [(i, t, "xx" if i is None or i % 3 else None) for i, t in brute.documents()] + [(99, "A,A\n1 é\tB|\n \nA,A\n1 é\tB|" + " q w e r t z u i" * 3, "yy")]
    got = quality_rules.judge(spark.createDataFrame(rows, DOC + ", lang string")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = Counter((i, *brute.quality_base(t)) for i, t, _ in rows)
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in got) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    total = Counter(w for _, t, lang in rows if lang == "xx" for w in (t or "").encode().split())
    common = {w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:quality_rules.COMMON]}
    texts = {i: t for i, t, lang in rows if lang == "xx"}
    for r in got:
        if r.lang == "xx" and r.n_words and r.doc_id is not None:
            own = Counter(w if w in common else None for w in texts[r.doc_id].encode().split())
            assert r.word_distance == pytest.approx(brute.distance(own, Counter({w: total[w] for w in common} | {None: sum(n for w, n in total.items() if w not in common)})), abs=1e-6)
        if r.lang == "yy":
            assert r.word_distance is None and r.char_distance is None


def test_quality_looks_only_where_it_must(spark):
    """Words are looked up among those of their length; 8-word windows are hashed where 4-word windows repeat."""
    same = F.struct(F.array(F.lit(3), F.lit(5)).alias("rank"), F.array(F.lit("bb"), F.lit("cc")).alias("word"))
    row = spark.range(1).select(*(quality_rules._rank(same, F.lit(w)) for w in ("bb", "cc", "dd")), *(quality_rules._length(F.lit(w)) for w in ("bb", "x" * 90))).first()
    assert tuple(row) == (3, 5, None, 2, quality_rules.LONG)
    docs = spark.createDataFrame([(["a"] * 9,), (list("abcdxabcdy"),), (list("abcdefgh") * 2,)], "w array<string>")
    got = quality_rules._repeated(docs, 8)
    assert sorted(r.n_repeat_words for r in got.collect()) == [0, 9, 16]
    assert "array_distinct(_h4" in got._jdf.queryExecution().analyzed().toString()


def test_quality_keeps_columns_and_rejects_far_texts(spark):
    prose = " ".join(f"the word{k} of a thing" for k in range(200))
    rows = [(k, prose + f" end{k}", "en", k) for k in range(30)] + [(40, " ".join(f"QQ{k}!!" for k in range(400)), "en", 1), (41, None, "en", 2), (None, prose + " x", None, 3)]
    docs = spark.createDataFrame(rows, DOC + ", lang string, kept int")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(30), None}
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def test_quality_plan_is_native(spark):
    plan = plan_of(quality_rules.op2_quality_divergence(spark, SF))
    assert not any(w in plan for w in ("Python", "InArrow", "CartesianProduct", "NestedLoop"))


PAGES = [(1, "http://a/x?q=1#f", "x" * 200), (2, None, "x" * 200), (2, None, "x" * 200), (None, "v", "x" * 200), (5, "http://a/\r\nb?c", None), (6, "z", ""), (7, "q", "é\x00WARC/1.1\r\n\r\n" * 30), (8, "s", "short"), (9, "s", "short")]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    assert {r["record_type"]: r["count"] for r in records.dropDuplicates(["record_id"]).groupBy("record_type").count().collect()} == {"response": 6, "revisit": 3, "request": 9, "metadata": 9}
    rows = warc.pages_of(warc.assemble(records)).collect()
    assert sorted(str(r.page_id) for r in rows) == sorted(str(r[0]) for r in PAGES)  # a record for every row
    got = {r.page_id: r for r in rows}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in got.items()} == {
        1: ("response", None, 200), 2: ("revisit", 1, 200), None: ("revisit", 1, 200), 5: ("response", None, 0), 6: ("response", None, 0),
        7: ("response", None, len(PAGES[6][2].encode())), 8: ("response", None, 5), 9: ("response", None, 5)}
    payload = {r.record_id: bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert PAGES[6][2].encode() in payload.values()


def test_repeated_pages_have_records_of_their_own(spark, tmp_path):
    """Equal rows with and without id, as response and as revisit, and payloads of which no page has an id."""
    long, other = "y" * 300, "z" * 300
    rows = [(3, "u", long)] * 4 + [(8, "u", long)] * 3 + [(None, "u", long)] * 2 + [(None, "w", other)] * 2 + [(4, "n", None)] * 2 + [(9, "o", "tiny")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit("clash"), "number": F.lit("clash"), "n": F.lit(1)})
    warc.write_archive(pages, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    assert records.count() == records.select("record_id").distinct().count() == 3 * len(rows)
    got = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.pages_of(warc.assemble(records)).collect())
    assert got == {(3, "response", None, 300): 4, (8, "revisit", 3, 300): 3, (None, "revisit", 3, 300): 2, (None, "response", None, 300): 2,
                   (4, "response", None, 0): 2, (9, "response", None, 4): 1}


def test_usual_layout_needs_no_tracing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_traced", None)
    warc.write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), str(tmp_path / "w"))
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "w")))
    assert all(len(r.requests) == len(r.metadata) == 1 and not r.others and r.requests[0].concurrent_to == [r.capture_id] for r in captures.collect())


def test_assembly_follows_identifiers(spark):
    blank = dict.fromkeys(("target_uri", "date", "refers_to", "payload_digest", "payload_sha256", "fields", "payload"))
    rows = [{"record_id": i, "record_type": k, "concurrent_to": c, "payload_bytes": 0, **blank} for i, k, c in (
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]), ("r2", "response", []), ("m2", "metadata", ["r2"]), ("m2", "metadata", ["r2"]), ("lost", "request", ["gone"]), ("odd", "conversion", None))]
    got = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(rows, warc._RECORDS)).collect()}
    assert set(got) == {"r1", "r2", "gone", "odd"} and got["gone"].response is None
    assert [m.record_id for m in got["r1"].metadata] == ["m1"] and [q.record_id for q in got["r1"].requests] == ["q1"] and len(got["r2"].metadata) == 1


def test_empty_archive(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.pages_of(warc.assemble(warc.read_records(spark, str(tmp_path / "w")))).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.tokenizer_path())
    found.encode_special_tokens = True
    return found


@given(st.lists(st.text(alphabet=" \n\t\x1c\x85\xa0\u3000\u2028aé1'st²!的😀<|endotx|>", max_size=14), max_size=8))
@settings(max_examples=60, deadline=None)
def test_ids_equal_the_library(library, texts):
    import pyarrow as pa

    flat, first = _encoder().ids(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endo", "ftext|>", "<", "|>", " ", "  ", "\n", "a", "é", "'s", "1"]), max_size=8).map("".join), max_size=6))
@settings(max_examples=100, deadline=None)
def test_added_tokens_equal_the_library_by_default(texts):
    import pyarrow as pa
    from tokenizers import Tokenizer

    default, texts = Tokenizer.from_file(packing.tokenizer_path()), ["a <|endoftext|> b", "a  <|endoftext|><|endoftext|>", "<|endo", "ftext|>", *texts]
    flat, first = _encoder().ids(pa.array(texts, pa.string()))
    assert flat[:4].tolist() == [64, 220, 50256, 275]
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in default.encode_batch(texts, add_special_tokens=False)]


def _encoder(cache=[]):  # noqa: B006
    if not cache:
        cache.append(packing.Encoder(packing.tokenizer_path()))
    return cache[0]


def packed_well(rows, texts, library, capacity):
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [packing.END], "<u4") for i, t in texts}
    by: dict = {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    cut = Counter(r.doc_id for r in rows)
    assert all(r.length == capacity or r.piece == 0 for r in rows if cut[r.doc_id] > 1)
    return len(by)


def test_packing_of_odd_documents(spark, library):
    texts = [(i, t) for i, t in brute.documents() if i is not None]
    texts = list(dict(texts).items())
    rows = packing.pack(spark.createDataFrame(texts + [(None, "x")], DOC), packing.tokenizer_path(), capacity=64).collect()
    n = len({r.sequence_id for r in rows})
    total = sum(r.length for r in rows)
    assert sum(r.length for r in rows) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts + [(None, "x")])
    assert n <= 1.05 * total / 64 + 1
    assert packing.pack(spark.createDataFrame([], DOC), packing.tokenizer_path()).count() == 0


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=12))
@settings(max_examples=80, deadline=None)
def test_arrangements_use_every_piece_once(counts):
    used: Counter = Counter()
    for own, times in packing.arrange(counts, 32):
        assert 0 < sum(own) <= 32 and times > 0
        for size in own:
            used[size] += times
    assert used == Counter(counts)


def test_best_two_fit_exchanges_the_smallest():
    # greedy gives 6 + 3 and a gap of 1; the 3 gives way to 2 + 2
    assert sorted(packing.arrange({6: 1, 3: 1, 2: 2}, 10)[0][0]) == [2, 2, 6]


def test_pipeline_equals_brute_force(spark, library):
    """Every stage on the small scale against plain Python on the rows of the stage before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF)
        result = rows.collect()
        if name != "best_fit_packing":
            assert rows.columns == names
            after = {r.doc_id: r.text for r in result}
        if name == "quality_rules":
            assert all(before[i] == t for i, t in after.items())
            failed = {i for i, t in before.items() for n, _, _, _, again in [brute.quality_base(t)] if n < 20 or 100 * again > 30 * n}
            assert failed and not failed & set(after)
        elif name == "ngram_jaccard_join":
            assert set(after) == {i for i, (_, g) in brute.groups(list(before.items()), 5, 80).items() if i == g}
        elif name == "substring_dedup":
            left = brute.kept_words(list(before.items()))
            assert {i: brute.words(t) for i, t in after.items()} == {i: w for (i, t), w in zip(before.items(), left, strict=True) if w or not brute.words(t)}
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, t in before.items() if not brute.contaminated(t, items)[1]}
        else:
            total = sum(r.length for r in result)
            assert {r.doc_id for r in result} == set(before) and packed_well(result, list(before.items()), library, 1024) <= 1.03 * total / 1024 + 1
        docs, before = spark.createDataFrame(result, rows.schema), after


def test_classes_are_told_apart_in_one_pass_over_the_text(spark):
    texts = ["ab C1! é\x00 #$", "", " \t\x0b\n\x0c\r\n x", "ÀÀ a|b <c>\n \x0b\n\x85 z\n\x85 z", "{~}\x7f9"]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    measured = quality_rules.measures(docs)
    for r in measured.collect():
        t = texts[r.doc_id]
        n = {"upper": "[A-Z]", "digit": "[0-9]", "punct": r"[!-/:-@\[-`{-~]", "wide": r"[^\x00-\x7F]", "n_symbols": r"[#*$%&|<>]", "space": r"[\x20\x09-\x0D]"}
        assert all(r[c] == len(re.findall(p, t)) for c, p in n.items())
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.lower == len(t) - sum(r[c] for c in n if c != "n_symbols")
    assert len(re.findall(r"regexp_replace\(text#", measured._jdf.queryExecution().optimizedPlan().toString())) == 1
