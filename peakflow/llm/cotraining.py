"""Quality classification by co-training on two views of a document.

The content view sees the text (hashed words and a few measures of its form), the metadata view the
columns beside it (source, language, length). Both are logistic models, fitted on a bounded sample
of labelled rows. In each round all unlabelled documents are scored by both; each view hands its most
confident predictions, at most `PSEUDO` per class and round, to the other as labels. At the end both views
are calibrated on labelled rows kept apart, and a logistic combination of the two scores all documents.

Input: documents (doc_id, text, source, lang, n_chars) and labels (doc_id, quality 0 or 1). Nulls in
any column are values of their own; a null text is empty. Labels without document or value are not
used, and with labels of one class only every score is that class's rate. Repeated rows score alike."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.sources.staging import stage

SAMPLE = 6_000
PSEUDO = 300
ROUNDS = 3
CONFIDENT = 0.95
_WORDS = 1 << 14
_FORM = 8  # measures of form after the word buckets
_META = 1 << 10
_CLASSES = [np.isin(np.arange(256), [*x]) for x in (range(0x41, 0x5B), range(0x30, 0x3A), b"#*$%&|<>", b".,;:!?")]

Rows = tuple[np.ndarray, np.ndarray, np.ndarray]  # columns, values, offsets of the rows in them


def content(column: pa.Array) -> Rows:
    """Word buckets weighted by the logarithm of their count, of unit length; then the form."""
    words = X.words_of(column, lower=True)
    hashes, text, n = words.hashes(), words.text_of, words.counts
    rows = len(column)
    cell, count = np.unique(text * _WORDS + (hashes % np.uint64(_WORDS)).astype(np.int64), return_counts=True)
    first = np.searchsorted(cell, _WORDS * np.arange(rows + 1))
    value = np.log1p(count)
    row = cell // _WORDS
    value /= np.sqrt(np.bincount(row, value**2, minlength=rows))[row]
    raw, offsets = X.bytes_of(column)
    size = np.maximum(np.diff(offsets), 1)
    shares = []
    for inside in _CLASSES:
        total = np.concatenate([[0], np.cumsum(inside[raw])])
        shares.append(np.diff(total[offsets]) / size)
    order = np.lexsort((hashes, text))
    new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1]))[:len(order)]
    distinct = np.bincount(text[order][new], minlength=rows) / np.maximum(n, 1)
    again = np.zeros(len(text), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    repeated = np.bincount(text, again, minlength=rows) / np.maximum(n, 1)
    form = np.stack([*(np.minimum(10 * s, 3) for s in shares), distinct, 3 * repeated, np.log1p(n) / 5, size / np.maximum(n, 1) / 10], axis=1)
    out_first = first + _FORM * np.arange(rows + 1)
    keys, values = np.empty(out_first[-1], np.int64), np.empty(out_first[-1])
    place = np.arange(len(cell)) + _FORM * row
    keys[place], values[place] = cell % _WORDS, value
    tail = (out_first[1:] - _FORM)[:, None] + np.arange(_FORM)
    keys[tail], values[tail] = _WORDS + np.arange(_FORM), np.minimum(form, 5)
    return keys, values, out_first


def metadata(source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> Rows:
    """One-hot source, language and power of two of the length, hashed."""
    names = [f"{k}={v}" for row in zip(source.to_pylist(), lang.to_pylist(), ("-" if v is None else str(int(v).bit_length()) for v in n_chars.to_pylist()), strict=True)
             for k, v in zip(("source", "lang", "length"), row, strict=True)]
    data = X.words_of(pa.array([n.replace(" ", "_") for n in names], pa.string()))
    keys = (X.span_hashes(data.data, data.starts, data.ends) % np.uint64(_META)).astype(np.int64)
    return keys, np.ones(len(keys)), 3 * np.arange(len(source) + 1)


def joined(parts: list[Rows]) -> Rows:
    keys, values = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    return keys, values, np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[2]) for p in parts]))])


@dataclass
class Logistic:
    weights: np.ndarray
    bias: float

    def logits(self, rows: Rows) -> np.ndarray:
        keys, values, first = rows
        total = np.concatenate([[0.0], np.cumsum(values * self.weights[keys])])
        return total[first[1:]] - total[first[:-1]] + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: Rows, y: np.ndarray, width: int, steps: int = 200, decay: float = 1e-4) -> Logistic:
    """Logistic regression by full-batch Adam."""
    keys, values, first = rows
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[-1] = np.log(rate / (1 - rate))
    for t in range(1, steps + 1):
        error = sigmoid(Logistic(w[:-1], w[-1]).logits(rows)) - y
        grad = np.append(np.bincount(keys, values * error[owner], minlength=width), error.sum()) / len(y)
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Logistic(w[:-1], float(w[-1]))


_VIEW = ("source", "lang", "n_chars")


def _features(docs: DataFrame) -> list[tuple[float, Rows, Rows]]:
    """Both views of a bounded set of rows with their label `y`, on the driver; each has at most a fixed number of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            c, m = content(part.column("text")), metadata(*(part.column(k) for k in _VIEW))
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x)) for keys, values, first in (c, m) for x in (keys.astype(np.int32), values.astype(np.float32))]
            yield pa.record_batch([part.column("y"), *lists], names=["y", "ck", "cv", "mk", "mv"])

    rows = docs.select("text", *_VIEW, "y").mapInArrow(run, "y double, ck array<int>, cv array<float>, mk array<int>, mv array<float>")

    def one(k, v):
        return np.array(k, np.int64), np.array(v), np.array([0, len(k)])

    return [(r.y, one(r.ck, r.cv), one(r.mk, r.mv)) for r in rows.toLocalIterator()]


def _scored(docs: DataFrame, views: tuple[Logistic, Logistic], combine: np.ndarray | None = None) -> DataFrame:
    """doc_id with the probability of each view; with `combine` calibrated, and the combined score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            z = [views[0].logits(content(part.column("text"))), views[1].logits(metadata(*(part.column(k) for k in _VIEW)))]
            if combine is not None:
                z = [combine[0, 0] * z[0] + combine[0, 1], combine[1, 0] * z[1] + combine[1, 1]]
                z.append(combine[2, 0] * z[0] + combine[2, 1] * z[1] + combine[2, 2])
            else:
                z.append(z[0])
            yield pa.record_batch([part.column("doc_id"), *(pa.array(sigmoid(x)) for x in z)], names=["doc_id", "content_score", "metadata_score", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text", *_VIEW).mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double")


def _dense(x: np.ndarray) -> Rows:
    return np.tile(np.arange(x.shape[1]), len(x)), x.ravel(), x.shape[1] * np.arange(len(x) + 1)


def calibrate(logits: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> np.ndarray:
    """Slope and offset of both views (Platt) and the weights of their combination."""
    out = np.zeros((3, 3))
    for k, z in enumerate(logits):
        own = fit(_dense(z[:, None]), y, 1, steps=400)
        out[k, :2] = own.weights[0], own.bias
    z = np.stack([out[k, 0] * z + out[k, 1] for k, z in enumerate(logits)], axis=1)
    both = fit(_dense(z), y, 2, steps=400)
    out[2] = *both.weights, both.bias
    return out


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, pseudo: int = PSEUDO) -> DataFrame:
    """doc_id, content_score, metadata_score and score (probability of good quality) of every row."""
    by_hash = (F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id"))
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = stage(known.join(present, "doc_id", "left_semi").orderBy(*by_hash).limit(sample), "labelled")
    rows = _features(docs.join(F.broadcast(chosen), "doc_id"))  # at most `sample` ids and labels
    # every fourth row of either class is kept for the calibration
    classes = [[r for r in rows if (r[0] >= 0.5) == good] for good in (False, True)]
    train, held = ([r for c in classes for k, r in enumerate(c) if (k % 4 == 0) == out] for out in (False, True))
    if not all(classes) or len({r[0] >= 0.5 for r in train}) < 2:
        rate = float(np.mean([r[0] for r in rows])) if rows else 0.5
        return docs.select(F.col("doc_id").cast("long"), *(F.lit(rate).alias(c) for c in ("content_score", "metadata_score", "score")))
    extra: list[list[tuple]] = [[], []]  # pseudo-labelled rows for each view
    widths = (_WORDS + _FORM, _META)

    def models() -> tuple[Logistic, Logistic]:
        sets = [train + extra[k] for k in (0, 1)]
        return tuple(fit(joined([r[1 + k] for r in own]), np.array([r[0] for r in own]), widths[k]) for k, own in enumerate(sets))

    views = models()
    given: set[int] = set()
    for _ in range(rounds):
        # the texts stay where they are; only scores meet the labels
        scores = stage(_scored(docs, views).where("doc_id is not null").join(known.select("doc_id"), "doc_id", "left_anti"), "scores")
        fresh = []
        for k, name in enumerate(("content_score", "metadata_score")):
            for y, sure in ((1.0, F.col(name)), (0.0, 1 - F.col(name))):
                # the most confident ones, ties by hash; ids given before are passed over
                best = scores.where(sure >= CONFIDENT).groupBy("doc_id").agg(F.max(sure).alias("sure"))
                found = best.orderBy(F.desc("sure"), *by_hash).limit(pseudo + len(given)).collect()
                fresh += [(r.doc_id, 1 - k, y) for r in [r for r in found if r.doc_id not in given][:pseudo]]
        if not fresh:
            break
        # at most 4 * pseudo rows
        table = docs.sparkSession.createDataFrame(fresh, "doc_id long, view int, y double")
        for view in (0, 1):
            extra[view] += _features(docs.join(F.broadcast(table.where(F.col("view") == view).drop("view")), "doc_id"))
        given |= {r[0] for r in fresh}
        views = models()
    y = np.array([r[0] for r in held])
    logits = tuple(views[k].logits(joined([r[1 + k] for r in held])) for k in (0, 1))
    return _scored(docs, views, calibrate(logits, y))


def op6_cotraining(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang", "n_chars")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return classify(docs, labels).withColumn("kept", F.col("score") >= 0.5)
