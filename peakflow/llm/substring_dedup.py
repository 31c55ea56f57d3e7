"""Substring deduplication by relative Lempel-Ziv parsing.

A document is parsed greedily into factors, each the longest run of its words that also stands in a
reference block: any window of `size` words that starts in a document with a smaller id. Words under
such a window are duplicates. Windows that straddle two factors are matched like all others, so the
parse covers exactly the words of all matching windows.

The index is built and probed in one shuffle. Two equal windows hold the same minimizer (the smallest
hash among their word 6-grams), so rows are dealt by that anchor, about one for every four or five
words, and carry the 64-bit hash of each of their windows: windows are equal if the 64-bit anchor and
this hash are. Rows arrive ordered by document, and one pass that remembers the first owner of each
window of the current anchor marks the later ones. Anchors of very many documents are found
beforehand and salted; the few first owners per salt are then compared by a map-side minimum.

Input: columns doc_id and text, others pass through untouched (one named like a result column is
replaced). A null text has no words. A null
doc_id is neither a reference nor cut. Rows that repeat a doc_id are the same document and repeat its
text: they never remove from each other. An empty table gives an empty result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.llm.hot import frequent
from peakflow.llm.names import free_names
from peakflow.sources.staging import stage

WINDOW = 13
ANCHOR = 6
HOT_SHARE = 0.005  # an anchor in about this share of the documents or more is salted
SALTS = 64

#: A run of windows: anchor, document, salt and start in one number, the windows' hashes.
_RUNS = "h long, doc_id long, place long, w binary"
_SEEDS = "doc_id long, start int, n int, ref_doc long, ref_start int, hot_h long, hot_w long, starts array<int>"
_PARSED = "n_words long, n_removed long, kept_sha256 string, kept_text string, " \
          "factors array<struct<start:int,length:int,ref_doc:long,ref_start:int>>"

_RESULTS = ("n_words", "n_removed", "kept_sha256", "kept_text", "factors")


def _minimizers(grams: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every `size` consecutive values, by doubling."""
    out, width = grams, 1
    while width < size:
        step = min(width, size - width)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        width += step
    return out


def _anchored(words: X.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window within a text: its start among all words, hash and anchor."""
    hashes = words.hashes()
    keep = np.flatnonzero(X.complete(words.first, size))
    anchor = min(ANCHOR, size)
    anchors = _minimizers(X.windows(hashes, anchor), size - anchor + 1)
    return keep, X.windows(hashes, size)[keep], anchors[keep]


def _runs_of(words: X.Words, size: int):
    """Runs of consecutive windows with one anchor: (text, start in the text, count, first, hashes, anchors)."""
    at, hashes, anchors = _anchored(words, size)
    text = words.text_of[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return text[first], at[first] - words.first[text[first]], count, first, hashes, anchors[first]


def _anchors_of(size: int):
    def values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        text, _, _, _, _, anchors = _runs_of(X.words_of(column), size)
        return text, anchors

    return values


def _runs(docs: DataFrame, size: int, hot: np.ndarray) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            text, start, _, first, hashes, anchors = _runs_of(X.words_of(part.column("text")), size)
            doc, h = ids[text], X.signed(anchors)
            salt = np.where(np.isin(h, hot), (X.mix(doc.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int64) + 1, 0)
            ends = np.append(first, len(hashes)).astype(np.int32) * 8
            w = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(hashes))])
            columns = [pa.array(h), pa.array(doc.astype(np.int64)), pa.array(salt << 32 | start.astype(np.int64)), w]
            yield pa.record_batch(columns, names=["h", "doc_id", "place", "w"])

    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, _RUNS)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose hash an earlier document of the same anchor and salt has; rows come ordered.

    Of the last anchor only the first owner of each different window is carried to the next batch."""
    held = None  # key, window, doc, start of the first owners in the last group
    for batch in batches:
        if not batch.num_rows:
            continue
        h, doc, place = (batch.column(k).to_numpy() for k in range(3))
        salt, start = place >> 32, place & 0xFFFFFFFF
        offsets = np.frombuffer(batch.column(3).buffers()[1], np.int32)[batch.column(3).offset:][:len(h) + 1]
        n, data = np.diff(offsets) // 8, np.frombuffer(batch.column(3).buffers()[2] or b"", np.uint64)
        key = np.stack([h, salt])
        new = np.ones(len(h), bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        group = np.cumsum(new)
        if held is not None and (held[0] == key[:, 0]).all():
            group -= 1
        size = np.bincount(group, minlength=group[-1] + 1)
        last = group == group[-1]
        use = np.flatnonzero((size[group] > 1) | (group == 0) | last | (salt > 0))
        row = np.repeat(use, n[use])
        within = np.arange(len(row)) - np.repeat(np.cumsum(n[use]) - n[use], n[use])
        window = data[offsets[row] // 8 + within]
        g, d, s, hh, sa = group[row], doc[row], start[row] + within, h[row], salt[row]
        n_held = 0
        if held is not None and group[0] == 0:
            n_held = len(held[1])
            g, d, s = np.append(np.zeros(n_held, int), g), np.append(held[2], d), np.append(held[3], s)
            window = np.append(held[1], window)
            hh, sa, row = np.append(np.full(n_held, h[0]), hh), np.append(np.full(n_held, salt[0]), sa), np.append(np.full(n_held, -1), row)
        order = np.argsort(window, kind="stable")  # groups ascend before, so equal windows of one stay together
        lead = np.ones(len(order), bool)
        lead[1:] = (window[order][1:] != window[order][:-1]) | (g[order][1:] != g[order][:-1])
        owner = np.empty(len(order), np.int64)
        owner[order] = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        later = d > d[owner]
        later[:n_held] = False
        firsts = np.zeros(len(order), bool)
        firsts[order[lead]] = True
        firsts &= g == group[-1]
        held = (key[:, -1].copy(), window[firsts].copy(), d[firsts].copy(), s[firsts].copy())
        # consecutive windows of a row with one source are one seed
        k = np.flatnonzero(later)
        ref_doc, shift = d[owner[k]], s[owner[k]] - s[k]
        cut = np.ones(len(k), bool)
        cut[1:] = (row[k][1:] != row[k][:-1]) | (s[k][1:] != s[k][:-1] + 1) | (ref_doc[1:] != ref_doc[:-1]) | (shift[1:] != shift[:-1])
        f = np.flatnonzero(cut)
        count = np.diff(np.append(f, len(k)))
        every = np.flatnonzero(~later & (sa > 0) & (row >= 0))  # first owners within a salt
        every = every[np.lexsort((s[every], d[every], window[every], g[every]))]
        own = np.ones(len(every), bool)  # all places of a window in its document are one row
        own[1:] = np.any([x[every][1:] != x[every][:-1] for x in (g, window, d)], axis=0)
        own = np.flatnonzero(own)
        c = every[own]
        places = pa.ListArray.from_arrays(pa.array(np.append(own, len(every)), pa.int32()), pa.array(s[every], pa.int32()))
        none = pa.nulls(len(f), pa.int64())
        yield pa.record_batch([
            pa.concat_arrays([pa.array(d[k][f]), pa.array(d[c])]),
            pa.array(np.append(s[k][f], s[c]).astype(np.int32)),
            pa.array(np.append(count, np.ones(len(c))).astype(np.int32)),
            pa.concat_arrays([pa.array(ref_doc[f]), pa.nulls(len(c), pa.int64())]),
            pa.concat_arrays([pa.array((s[k] + shift)[f].astype(np.int32)), pa.nulls(len(c), pa.int32())]),
            pa.concat_arrays([none, pa.array(hh[c])]),
            pa.concat_arrays([none, pa.array(X.signed(window[c]))]),
            pa.concat_arrays([pa.nulls(len(f), places.type), places]),
        ], names=["doc_id", "start", "n", "ref_doc", "ref_start", "hot_h", "hot_w", "starts"])


def seeds(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Runs of windows that start in an earlier document: doc_id, start, n, ref_doc, ref_start."""
    runs = _runs(docs, size, frequent(docs, _anchors_of(size), HOT_SHARE))
    salt = F.shiftright("place", 32)
    ordered = runs.repartition("h", salt).sortWithinPartitions("h", salt, "doc_id", "place")
    marked = stage(ordered.mapInArrow(_mark, _SEEDS), "seeds")
    names = ["doc_id", "start", "n", "ref_doc", "ref_start"]
    split = marked.where(F.col("hot_h").isNotNull())
    first = split.groupBy("hot_h", "hot_w").agg(F.min("doc_id").alias("ref"), F.min(F.struct("doc_id", "start")).alias("at"))
    across = split.select("hot_h", "hot_w", "doc_id", "n", "starts").join(first, ["hot_h", "hot_w"]).where(F.col("doc_id") > F.col("ref")).select(
        "doc_id", F.explode("starts").alias("start"), "n", F.col("ref").alias("ref_doc"), F.col("at.start").alias("ref_start"))
    return marked.where(F.col("hot_h").isNull()).select(*names).unionByName(across)


def factorise(start: np.ndarray, n: np.ndarray, ref_doc: np.ndarray, ref_start: np.ndarray, n_words: int, size: int) -> list[dict]:
    """Greedy parse of one document from its seeds: at each place the factor that reaches furthest."""
    shift = ref_start.astype(np.int64) - start
    order = np.lexsort((start, shift, ref_doc))
    begin, end, shift, ref = start[order], (start + n)[order] + size - 1, shift[order], ref_doc[order]
    new = np.ones(len(order), bool)  # seeds of one source and shift that follow or overlap are one match
    new[1:] = (ref[1:] != ref[:-1]) | (shift[1:] != shift[:-1]) | (begin[1:] > end[:-1])
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(end, first) if len(first) else end
    spans = sorted(zip(begin[first].tolist(), end.tolist(), ref[first].tolist(), shift[first].tolist(), strict=True))
    out, at, k = [], 0, 0
    while k < len(spans) or at is not None:
        best = None
        while k < len(spans) and spans[k][0] <= at:
            if best is None or spans[k][1] > best[1]:
                best = spans[k]
            k += 1
        if best is not None and best[1] > at:
            out.append({"start": at, "length": min(best[1], n_words) - at, "ref_doc": best[2], "ref_start": at + best[3]})
            # spans that start inside this factor are looked at from its end
            at = best[1]
        elif k < len(spans):
            at = max(at, spans[k][0])
        else:
            break
    return [f for f in out if f["length"] > 0]


def parse(docs: DataFrame, size: int = WINDOW, with_text: bool = True) -> DataFrame:
    """All columns of `docs`, and n_words, n_removed, kept_sha256, kept_text (kept words joined by one
    space; null unless `with_text`) and the factors (start and length in words, source)."""
    docs = docs.select(*(c for c in docs.columns if c not in _RESULTS))
    names = docs.columns
    own_id, places = free_names(names, "_doc", "_seeds")
    by_doc = seeds(docs, size).groupBy(F.col("doc_id").alias(own_id)).agg(
        F.collect_list(F.struct("start", "n", "ref_doc", "ref_start")).alias(places))
    joined = docs.join(by_doc, docs["doc_id"].cast("long") == by_doc[own_id], "left").select(*(docs[c] for c in names), by_doc[places])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            rows = []
            found = part.column(places).fill_null([])
            own, first = found.flatten(), np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
            fields = [own.field(k).to_numpy() for k in range(4)]
            for row, text in enumerate(part.column("text")):
                words = (text.as_py() or "").encode().split()
                at = slice(first[row], first[row + 1])
                factors = factorise(*(f[at] for f in fields), len(words), size) if first[row + 1] > first[row] else []
                kept, at = [], 0
                for f in factors:
                    kept += words[at:f["start"]]
                    at = f["start"] + f["length"]
                joined_words = b" ".join(kept + words[at:])
                rows.append({"n_words": len(words), "n_removed": sum(f["length"] for f in factors),
                             "kept_sha256": hashlib.sha256(joined_words).hexdigest(),
                             "kept_text": joined_words.decode() if with_text else None, "factors": factors})
            made = pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string()),
                ("factors", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])))]))
            kept_columns = names if with_text else [c for c in names if c != "text"]
            yield pa.record_batch([part.column(c) for c in kept_columns] + made.columns, names=kept_columns + made.schema.names)

    passed = [f for f in docs.schema.fields if with_text or f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in passed), _PARSED])
    return joined.mapInArrow(cut, schema)


def cut_documents(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The columns of `docs` with duplicate spans cut from the texts (and n_chars, where there is one, set
    anew). A text without a duplicate stays as it is; one of which no word is left goes."""
    others = {c: f"_x{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    parsed = parse(docs.withColumnsRenamed(others), size).where("n_words = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    made = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col(x) for c, x in others.items()}
    if "n_chars" in made:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(made["n_chars"])
    return parsed.select(*(made[c].alias(c) for c in docs.columns))


def op10_substring_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return parse(docs, WINDOW, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
