"""A word bigram model by deleted interpolation, and the log10 probability it gives every document.

Maximum-likelihood bigram estimates are mixed with add-one unigram estimates. The weight of the mixture
depends on how often the context was seen (buckets by the power of two of its count) and is learned by expectation-
maximisation on a part of the training documents that is deleted from the counts for it; the final counts are
those of all training documents. Every word has its own counts as a context and in bigrams. The
probabilities of all words after a context sum to one, with the mass of an unseen word kept by the add-one estimate.

Texts are packed into slices of a few megabytes first, a written table with one row per slice. Each slice asks for its
different words and bigrams: it sends their hashes with their counts of its own, in order, to parts (ranges of the hashes) whose number follows
the size of the corpus. So a bigram that makes up a third of all tokens is one entry per slice. A part adds the counts up and
answers every slice with whole counts in the order it was asked, which needs no names: texts and answers meet on the slice, and
there every token finds the counts of its word and its bigram; those of its context are its predecessor's. That
table is written; weights are learned from the histogram (bucket by likelihood ratio) of its deleted documents, and
scores are a plain pass over it. Entries are shuffled once, counts for learning and for scoring come in one answer.
Only sums and the histogram reach the driver; both are bounded. Words and bigrams are told apart by 64-bit hashes.

Input: columns doc_id and text; others, whatever their names, are ignored. A null text or one without words is the end token
alone. A null doc_id counts as the empty text in the split. Texts are read whole, a very long one is a slice of its own.
Repeated rows count as often as they occur and get equal scores. There are no ties: no word or bigram is chosen before
another. An empty table gives an empty result, and without training documents all probabilities are one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.sources.staging import stage

SLICE_BYTES = 8 << 20  # text of a slice
PART_BYTES = 16 << 20  # text whose words and bigrams one part counts, about
HASH_BYTES = 512 << 10  # text hashed at a time
BATCH_BYTES = 2 << 20  # packed slices, questions and answers handed to Python at a time, about
BATCH_KEYS = 1 << 18  # keys of a batch of questions, about
PIECE_TOKENS = 1 << 18  # tokens scored at a time, about
DELETED = 10  # one training document in so many is deleted from the counts while weights are learned
_END_HASH = np.uint64(0x45AC1F0D9A3B7C11)
_START_HASH = np.uint64(0x1F83D9ABFB41BD6B)
_PAIR = np.uint64(0xD1342543DE82EF95)
_TEST, _KEPT, _DELETED = 0, 1, 2
_BIN, _BINS = 0.1, 400  # steps of the logarithm of the likelihood ratio, the first is for ratio zero

_SLICES = "slice long, body binary"
_ASKED = "part long, slice long, keys binary, kept binary, deleted binary"
_ANSWERS = "slice long, part long, whole binary, kept binary, n long, different long, n_kept long, different_kept long"
_COUNTED = "docs binary, tokens binary, cells binary, times binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(body: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(body.as_buffer()).read_next_batch()


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them all."""
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


def _wide(raw: bytes, n: int) -> np.ndarray:
    """Those counts again, in the type they were written in."""
    return np.frombuffer(raw, f"u{len(raw) // n}") if n else np.empty(0, np.uint8)


def _joined(counts: list[np.ndarray]) -> np.ndarray:
    """One array of all of them, in the widest of their types."""
    return np.concatenate([np.empty(0, np.uint8), *counts])


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each followed by the end token, and the offsets of the texts.

    Hashing takes much more memory than its text, so it goes by small pieces."""
    tokens, sizes = [], []
    for piece in X.slices([part], limit=HASH_BYTES):
        words = X.words_of(piece.column("text"), lower=True)
        first = words.first + np.arange(len(words.first))
        own = np.full(first[-1], _END_HASH, np.uint64)
        own[np.arange(len(words.starts)) + words.text_of] = words.hashes()
        tokens.append(own)
        sizes.append(np.diff(first))
    return np.concatenate(tokens), np.cumsum(np.concatenate([[0], *sizes]))


@dataclass
class _Asked:
    """Different hashes of a slice, in order, and the place of every token's among them.

    Parts are equal ranges of the hashes, so this is the order of the parts too."""

    keys: np.ndarray
    parts: int
    place: np.ndarray
    kept: np.ndarray
    deleted: np.ndarray

    @property
    def spans(self) -> list[tuple[int, int, int]]:
        """Every part that has keys, where they begin and where they end."""
        part = (self.keys >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(part)) + 1
        begins = np.append(0, cuts)
        return list(zip(part[begins].tolist(), begins.tolist(), [*cuts.tolist(), len(part)], strict=True))


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the hashes, where each different one begins in it, and the number of every hash's among these."""
    order = np.argsort(hashes)
    new = np.ones(len(order), bool)
    ranked = hashes[order]
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    del ranked
    small = np.min_scalar_type(len(order))
    place = np.empty(len(order), small)
    place[order] = np.cumsum(new, dtype=small) - small.type(1)
    return order, np.flatnonzero(new), place


def _asked(hashes: np.ndarray, role: np.ndarray, parts: int) -> _Asked:
    order, begins, place = _grouped(hashes)
    role, keys = role[order], hashes[order[begins]]
    del order
    kept, deleted = (np.add.reduceat(role == r, begins, dtype=np.min_scalar_type(len(role))) for r in (_KEPT, _DELETED))
    return _Asked(keys, parts, place, kept, deleted)


def _paired(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of every token and the one before."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _START_HASH
    before *= _PAIR
    before += tokens
    return X.mix(before)


def _tokens_and_roles(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a slice, the offsets of its texts, and the role of every token."""
    tokens, first = _tokens(batch)
    return tokens, first, np.repeat(batch.column("role").to_numpy(), np.diff(first))


def _sliced(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per slice of texts with their ids and roles. Its number is only a name."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    kept = F.crc32(F.concat(F.lit("deleted:"), name).cast("binary")) % DELETED != 0
    role = F.when(F.coalesce(held_out, F.lit(False)), _TEST).when(kept, _KEPT).otherwise(_DELETED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in X.slices(batches, limit=SLICE_BYTES):
            yield pa.record_batch([pa.array([number], pa.int64()), pa.array([_pack(part)], pa.binary())], names=["slice", "body"])
            number += 1

    rows = docs.select(F.col("doc_id").cast("long"), role.cast("byte").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return stage(rows.mapInArrow(run, _SLICES), "slices", SLICE_BYTES)


def _answers(slices: DataFrame, parts: int) -> DataFrame:
    """Whole counts by slice and part in the order asked, and a row of sums (no slice) for each part of words.

    Bigrams are in parts from 0, words in parts below 0. Counts of kept documents go to those keys only that a deleted
    document of the slice has."""

    types = {"part": pa.int64(), "slice": pa.int64(), "keys": pa.binary(), "kept": pa.binary(), "deleted": pa.binary()}

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)], names=list(types))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("slice").to_pylist(), batch.column("body"), strict=True):
                tokens, first, role = _tokens_and_roles(_unpack(body))
                for word in (True, False):  # one after the other, each with its own memory
                    asked = _asked(tokens if word else _paired(tokens, first), role, parts)
                    rows, held = [], 0
                    for part, a, b in asked.spans:
                        rows.append((-1 - part if word else part, number, asked.keys[a:b].tobytes(),
                                     _narrow(asked.kept[a:b]).tobytes(), _narrow(asked.deleted[a:b]).tobytes()))
                        held += b - a
                        if held >= BATCH_KEYS:
                            yield told(rows)
                            rows, held = [], 0
                    if rows:
                        yield told(rows)
                    del asked, rows

    def answer(table: pa.Table) -> pa.Table:
        part, number = table.column("part")[0].as_py(), table.column("slice").to_pylist()
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
        cuts = np.cumsum([0, *(len(k.as_buffer()) // 8 for k in table.column("keys"))])
        spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        kept, deleted = (_joined([_wide(r.as_py(), s.stop - s.start) for r, s in zip(table.column(c), spans, strict=True)]) for c in ("kept", "deleted"))
        order, begins, at = _grouped(keys)
        mine = deleted > 0
        all_kept = np.add.reduceat(kept[order], begins, dtype=np.int64)
        whole = np.add.reduceat(deleted[order], begins, dtype=np.int64) + all_kept
        del keys, kept, deleted, order, begins
        sums = [int(x) for x in (whole.sum(), (whole > 0).sum(), all_kept.sum(), (all_kept > 0).sum())]
        counts = [_narrow(whole[at[s]]).tobytes() for s in spans]
        learned = [_narrow(all_kept[at[s][mine[s]]]).tobytes() for s in spans]
        own = [None] * len(number)
        rows = [number, [part] * len(number), counts, learned, *[own] * 4]
        if part < 0:
            rows = [[*c, x] for c, x in zip(rows, (None, part, None, None, *sums), strict=True)]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4)
        return pa.table([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)],
                        names=["slice", "part", "whole", "kept", "n", "different", "n_kept", "different_kept"])

    return stage(slices.mapInArrow(ask, _ASKED).groupBy("part").applyInArrow(answer, _ANSWERS), "answers", BATCH_BYTES)


def shifted(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Counts of the contexts: of the token before, and of the start, which occurs as often as the end, the last token."""
    out = np.empty_like(counts)
    out[1:] = counts[:-1]
    out[first[:-1]] = counts[-1]
    return out


def _counted(slices: DataFrame, answers: DataFrame, parts: int, kept_norm: float) -> DataFrame:
    """Of every slice its documents, the whole counts of each token's word and bigram, and the histogram of its deleted
    documents by the counts of the kept ones."""

    def filled(hashes: np.ndarray, role: np.ndarray, told: dict) -> tuple[np.ndarray, np.ndarray]:
        asked = _asked(hashes, role, parts)
        whole, kept = [], []
        for part, a, b in asked.spans:
            w, k = told[part]
            whole.append(_wide(w, b - a))
            mine = np.flatnonzero(asked.deleted[a:b])
            counts = _wide(k, len(mine))
            kept.append(np.zeros(b - a, counts.dtype))
            kept[-1][mine] = counts
        return _joined(whole)[asked.place], _joined(kept)[asked.place]

    def meet(own: pa.Table, told: pa.Table) -> pa.Table:
        batch = _unpack(own.column("body")[0])
        tokens, first, role = _tokens_and_roles(batch)
        answer = dict(zip(told.column("part").to_pylist(), zip(told.column("whole").to_pylist(), told.column("kept").to_pylist(), strict=True), strict=True))
        word, word_kept = filled(tokens, role, {-1 - p: x for p, x in answer.items() if p < 0})
        pair, pair_kept = filled(_paired(tokens, first), role, {p: x for p, x in answer.items() if p >= 0})
        del tokens
        # every text ends with the end token, which has a kept count if the slice has deleted documents
        ends = first[1:] - 1
        gone = ends[role[ends] == _DELETED]
        context = shifted(word_kept, first)
        context[first[:-1]] = word_kept[gone[0]] if len(gone) else 0
        mine = role == _DELETED
        cell, times = _cells(*(x[mine].astype(np.int64) for x in (pair_kept, context)), (word_kept[mine] + 1.0) / kept_norm)
        docs = pa.record_batch([batch.column("doc_id"), batch.column("role"), pa.array(np.diff(first))], names=["doc_id", "role", "tokens"])
        tokens = pa.record_batch([pa.array(_narrow(word)), pa.array(_narrow(pair))], names=["word", "pair"])
        return pa.table([pa.array([x], pa.binary()) for x in (_pack(docs), _pack(tokens), cell.tobytes(), times.tobytes())],
                        names=["docs", "tokens", "cells", "times"])

    asked = answers.where("slice is not null").select("slice", "part", "whole", "kept")
    return stage(slices.groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(meet, _COUNTED), "counted", BATCH_BYTES)


def bucket(contexts: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for a context never seen, else its power of two and one."""
    return np.where(contexts > 0, np.log2(np.maximum(contexts, 1)).astype(np.int64) + 1, 0)


def weights(histogram: dict[tuple[int, int], int], rounds: int = 60) -> np.ndarray:
    """Weight of the bigram estimate by bucket, by expectation-maximisation on binned likelihood ratios."""
    ratio = np.exp((np.arange(_BINS) - _BINS // 3) * _BIN)
    ratio[0] = 0.0
    out = np.zeros(64)
    everything = np.zeros(_BINS)
    table = np.zeros((64, _BINS))
    for (b, k), n in histogram.items():
        table[b, k] += n
        everything[k] += n if b else 0
    for b in range(1, 64):
        own = table[b] if table[b].sum() else everything
        lam = 0.5
        for _ in range(rounds if own.sum() else 0):
            lam = float((own * lam * ratio / (lam * ratio + 1 - lam)).sum() / own.sum())
            lam = min(max(lam, 1e-6), 1 - 1e-6)
        out[b] = lam
    return out


def _cells(seen: np.ndarray, c: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the histogram (bucket and likelihood ratio) and how many deleted tokens are in each."""
    ratio = seen / np.maximum(c, 1) / mass
    k = np.where(seen > 0, np.clip(np.round(np.log(np.maximum(ratio, 1e-300)) / _BIN) + _BINS // 3, 1, _BINS - 1), 0).astype(np.int64)
    cell, times = np.unique(bucket(c) * _BINS + k, return_counts=True)
    return cell, times.astype(np.int64)


def mixed(lam: np.ndarray, seen: np.ndarray, context: np.ndarray, word: np.ndarray, norm: float) -> np.ndarray:
    """Probability of a word after its context by the counts of bigram, context and word."""
    weight = lam[bucket(context)]
    return weight * seen / np.maximum(context, 1) + (1 - weight) * (word + 1) / norm


def _learned(counted: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64)) for c in ("cells", "times")], names=["cell", "n"])

    sums = counted.select("cells", "times").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return weights({(r["cell"] // _BINS, r["cell"] % _BINS): r["n"] for r in sums})


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    `held_out` says which rows must not be learned from."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))
    slices = _sliced(docs, held_out)
    answers = _answers(slices, parts)
    sums = answers.where("slice is null").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "different", "n_kept", "different_kept"))).first()
    total, norm, kept_norm = sums[0], sums[0] + sums[1] + 1.0, sums[2] + sums[3] + 1.0
    counted = _counted(slices, answers, parts, kept_norm)
    lam = _learned(counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, body in zip(batch.column("docs"), batch.column("tokens"), strict=True):
                about, tokens = _unpack(own), _unpack(body)
                sizes = about.column("tokens").to_numpy()
                upto, at = np.cumsum([0, *sizes]), 0
                while at < len(sizes):  # documents by the piece: each ends with the end token, as the slice does
                    end = max(at + 1, int(np.searchsorted(upto, upto[at] + PIECE_TOKENS, side="right")) - 1)
                    n, first = sizes[at:end], upto[at:end + 1] - upto[at]
                    word, seen = (tokens.column(c).slice(upto[at], first[-1]).to_numpy().astype(np.int64) for c in ("word", "pair"))
                    p = np.log10(mixed(lam, seen, shifted(word, first), word, norm))
                    base = np.add.reduceat(np.log10(word + 1.0), first[:-1]) - n * np.log10(norm)
                    yield pa.record_batch([about.column("doc_id").slice(at, len(n)), pa.array(about.column("role").to_numpy()[at:end] == _TEST), pa.array(n),
                                           pa.array(np.add.reduceat((word > 0).astype(np.int64), first[:-1])), pa.array(np.full(len(n), total, np.int64)),
                                           pa.array(base), pa.array(np.add.reduceat(p, first[:-1]))],
                                          names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                    at = end

    return counted.select("docs", "tokens").mapInArrow(run, _SCORES)


def op4_deleted_interpolation(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return score(docs, rest == 2)
