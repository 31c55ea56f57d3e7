"""Language identification by averaged subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte 2-, 3- and 4-grams (A-Z folded, white space as
one byte); a softmax layer on it tells the languages apart. Embeddings and layer are trained together by stochastic
gradient descent on a bounded sample of labelled texts (`SAMPLE` rows, fewest first by a hash of
their id; at most `BUCKETS` numbers of each reach the driver). A part of the sample is kept to fit
the temperature that calibrates the probabilities and the threshold below which a prediction is
marked as rejected. The trained model is one score per bucket and language, a table of fixed size.

Input: columns doc_id, text and lang. A null text or one without a letter is `und` with score 0. Rows
without lang are not learned from. With nothing to learn from, every text is `und`."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X

BUCKETS = 1 << 14
WIDTH = 16
SAMPLE = 4_000
UNDETERMINED = "und"
_SIZES = (2, 3, 4)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def subwords(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the bucket of every n-gram within a text, and the offsets of the texts."""
    data, offsets = X.bytes_of(column)
    folded = X.folded(data).astype(np.uint32)
    end = np.repeat(offsets[1:], np.diff(offsets))
    gram = folded.copy()
    for size in range(2, max(_SIZES) + 1):
        gram = (gram[:-1] << np.uint32(8)) | folded[size - 1:] if len(gram) > 1 else gram[:0]
        if size in _SIZES:
            keep = np.arange(len(gram)) + size <= end[:len(gram)]
            h = (gram[keep] ^ np.uint32(size)) * np.uint32(2654435761)
            yield (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), np.concatenate([[0], np.cumsum(keep)])[np.minimum(offsets, len(keep))]


def _has_letter(column: pa.Array) -> np.ndarray:
    data, offsets = X.bytes_of(column)
    plain = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[row] = any(c.isalpha() for c in column[int(row)].as_py())
    return found


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket by language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _bags(docs: DataFrame) -> DataFrame:
    """lang and the bucket counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches, limit=X.SLICE_BYTES // 4):
            cells = np.concatenate([h + BUCKETS * np.repeat(np.arange(part.num_rows), np.diff(first)) for h, first in subwords(part.column("text"))])
            cell, n = np.unique(cells, return_counts=True)
            first = np.searchsorted(cell, BUCKETS * np.arange(part.num_rows + 1))
            k = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array((cell % BUCKETS).astype(np.int32)))
            v = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(n.astype(np.int32)))
            yield pa.record_batch([part.column("lang"), k, v], names=["lang", "k", "v"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, k array<int>, v array<int>")


def train(docs: DataFrame, learn_from: Column, sample: int = SAMPLE, epochs: int = 6, accepted: float = 0.995, seed: int = 7) -> Model:
    """Learns from up to `sample` rows with a language for which `learn_from` holds."""
    labelled = docs.where(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # about twice the sample by the hash alone, so that tasks hand on few texts; then exactly the first
    by = F.xxhash64(F.col("doc_id").cast("string"))
    share = min(1.0, 2.0 * sample / max(1, labelled.count()))
    chosen = labelled.where(by <= min(int(share * 2**64) - 2**63, 2**63 - 1)).orderBy(by, "doc_id", "text").limit(sample)
    rows = [(lang, np.array(k, np.int64), np.array(v, np.float64) / sum(v)) for lang, k, v in _bags(chosen).toLocalIterator() if len(k)]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held, rows = rows[:len(rows) // 5], rows[len(rows) // 5:]
    embedding = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    layer, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            lang, k, v = rows[i]
            rate = 0.5 * (1 - step / steps)
            step += 1
            hidden = v @ embedding[k]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[languages.index(lang)] -= 1
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            bias -= rate * p
            embedding[k] -= rate * np.outer(v, back) * min(len(k), 100)
    model = Model(languages, embedding @ layer, bias)
    known = [(r, languages.index(r[0])) for r in held]
    if known:
        logits = np.array([r[2] @ model.scores[r[1]] for r, _ in known])
        truth = np.array([t for _, t in known])

        def loss(temperature: float) -> float:
            model.temperature = temperature
            return -float(np.log(np.maximum(model.probabilities(logits)[np.arange(len(truth)), truth], 1e-12)).mean())

        model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
        p = model.probabilities(logits)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(order) + 1)
        enough = np.flatnonzero(right >= accepted)
        model.threshold = float(p.max(axis=1)[order][enough[-1]]) if len(enough) else 1.0
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row; only the text decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            column = part.column("text")
            total, n = np.zeros((part.num_rows, len(model.languages))), np.zeros(part.num_rows)
            for h, first in subwords(column):
                n += np.diff(first)
                for c in range(len(model.languages)):
                    sums = np.concatenate([[0.0], np.cumsum(model.scores[:, c][h])])
                    total[:, c] += sums[first[1:]] - sums[first[:-1]]
            known = _has_letter(column) & bool(model.languages)
            names = np.array([*model.languages, UNDETERMINED], object)
            best, score = np.full(part.num_rows, len(model.languages)), np.zeros(part.num_rows)
            if model.languages:
                p = model.probabilities(total / np.maximum(n, 1)[:, None])
                best, score = np.where(known, p.argmax(axis=1), best), np.where(known, p.max(axis=1), 0.0)
            yield pa.record_batch([part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(score < model.threshold)],
                                  names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def op8_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    found = predict(docs, train(docs, rest != 1))
    return found.select("doc_id", (rest == 1).alias("held_out"), "lang_pred", "score", "rejected")
