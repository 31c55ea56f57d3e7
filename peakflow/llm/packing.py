"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-two-fit: a sequence is opened by the longest piece left and filled greedily with the longest that
fits. While a gap remains, its smallest piece is exchanged for two unpacked ones that fill the expanded gap
more tightly. Pieces of one length are interchangeable, so the choice needs only the number of pieces of
each length, a table of at most `capacity` numbers, and each arrangement is used as often as its pieces
last. Spark counts the lengths, ranks the pieces of each length in buckets and looks their places up.

Input: columns doc_id and text, others are ignored. A null or empty text is the end token alone.
Repeated rows and null ids are packed like all others. An empty table gives an empty result."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.sources.staging import stage

CAPACITY = 1024
END = 2
_CACHE = 200_000
_BUCKET = 10_000  # pieces ranked together, about

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACES = _PIECES + ", sequence_id long, offset long"


def byte_values() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_FOLLOWS = np.zeros(256, bool)  # bytes that begin a character other than white space, as far as one byte tells
_FOLLOWS[0x21:0x7F] = True
_FOLLOWS[0xC3:0xE1] = True
_FOLLOWS[0xE4:0xF5] = True
_BREAKS = np.zeros(256, bool)
_BREAKS[[0x20, 0x09, 0x0A, 0x0D]] = True


class Encoder:
    """Ids of texts by a byte-level BPE file of the `tokenizers` library.

    Added tokens of the file are found in the text first, as that library does by default, and what is between
    them is encoded by itself. The pre-tokenizer never joins anything across a space that stands right before a
    word. Texts are split there, and each different piece is encoded once per few megabytes and remembered for a while."""

    def __init__(self, path: str):
        import re

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_values(), {t["content"] for t in spec["added_tokens"]}
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that depend on what is around them")
        self._added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self._any_added = re.compile(b"|".join(map(re.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None
        vocab = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        order = [model["vocab"][m.replace(" ", "")] for m in merges]
        if order != sorted(order):
            raise ValueError(f"{path} numbers its tokens in another order than its merges")
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self._encode = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=vocab, special_tokens={}).encode_ordinary
        self._clear()

    def _clear(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids: list[int] = []
        self._ends: list[int] = [0]

    def _added_in(self, whole: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Begin and end of the added tokens within the texts, the longest at each place."""
        if self._any_added is None or not self._any_added.search(whole):
            return []
        texts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        return [m.span() for a, b in texts for m in self._any_added.finditer(whole, a, b)]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts in them."""
        data, offsets = X.bytes_of(column)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        whole = data.tobytes()
        begins = np.zeros(len(data), bool)
        begins[:-1] = _BREAKS[data[:-1]] & _FOLLOWS[data[1:]]
        last = offsets[1:][np.diff(offsets) > 0] - 1
        begins[last] = False  # what follows belongs to the next text
        added = self._added_in(whole, offsets)
        for a, b in added:
            begins[max(a - 1, 0):b] = False
        for a, b in added:
            begins[[a, b] if b < len(data) else a] = True
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        _, where, inverse = np.unique(X.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._known) > _CACHE:
            self._clear()
        known, ids, upto = self._known, self._ids, self._ends
        at = []
        for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True):
            piece = whole[a:b]
            k = known.get(piece)
            if k is None:
                k = known[piece] = len(upto) - 1
                ids.extend([self._added[piece]] if piece in self._added else self._encode(piece.decode("utf-8", "replace")))
                upto.append(len(ids))
            at.append(k)
        store, bounds, at = np.array(ids, np.uint32), np.array(upto), np.array(at)
        begin, size = bounds[at][inverse], (bounds[at + 1] - bounds[at])[inverse]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = store[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        return flat, total[np.searchsorted(starts, offsets)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for part in X.slices(batches):
            flat, first = encoder.ids(part.column("text"))
            out = []
            for doc, a, b in zip(part.column("doc_id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                ids = np.append(flat[a:b], np.uint32(end)).astype("<u4")
                cut = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                out += [(doc, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def arrange(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Arrangements of lengths and how often each is used, by best-two-fit. Uses every piece once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while left.any():
        rest = left.copy()
        own: list[int] = []

        def longest(limit: int) -> int:
            found = np.flatnonzero(rest[1:limit + 1])
            return int(found[-1]) + 1 if len(found) else 0

        gap = capacity
        while gap and (size := longest(gap)):
            own.append(size)
            rest[size] -= 1
            gap -= size
        while gap and len(own) > 1:
            small = min(own)
            pair = _closest_pair(rest, gap + small)
            if sum(pair) <= small:
                break
            own.remove(small)
            rest[small] += 1
            for size in pair:
                own.append(size)
                rest[size] -= 1
            gap += small - sum(pair)
        sizes, times = np.unique(own, return_counts=True)
        repeat = int((left[sizes] // times).min())
        left[sizes] -= repeat * times
        out.append((own, repeat))
    return out


def _closest_pair(rest: np.ndarray, limit: int) -> tuple[int, int]:
    """Two pieces left whose sum comes closest to the limit from below (0, 0 if there are none)."""
    sizes = np.flatnonzero(rest[:limit])
    sizes = sizes[sizes > 0]
    if not len(sizes):
        return 0, 0
    partner = np.searchsorted(sizes, limit - sizes, side="right") - 1
    ok = partner >= 0
    same = ok & (sizes[partner] == sizes) & (rest[sizes] < 2)
    partner[same] -= 1
    ok &= partner >= 0
    if not ok.any():
        return 0, 0
    k = np.flatnonzero(ok)
    best = k[np.argmax(sizes[k] + sizes[partner[k]])]
    return int(sizes[best]), int(sizes[partner[best]])


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece. `cut` should be a stored table, as it is read three times."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, upto, base, per, offsets, first, sequence, used = [], [], [], [], [], [], 0, dict.fromkeys(histogram, 0)
    for own, repeat in arrange(histogram, capacity):
        at = np.concatenate([[0], np.cumsum(own)])
        for size in sorted(set(own)):
            slots = [int(at[k]) for k, s in enumerate(own) if s == size]
            keys.append(size << 40 | used[size])
            base.append(sequence)
            per.append(len(slots))
            first.append(len(offsets))
            offsets += slots
            used[size] += repeat * len(slots)
            upto.append(used[size])
        sequence += repeat
    order = np.argsort(np.array(keys, np.int64))
    keys, base, per, first = (np.array(x, np.int64)[order] for x in (keys, base, per, first))
    offsets = np.array(offsets, np.int64)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            k = np.searchsorted(keys, size << 40 | rank, side="right") - 1
            nth = rank - (keys[k] & ((1 << 40) - 1))
            found = [pa.array(base[k] + nth // per[k]), pa.array(offsets[first[k] + nth % per[k]])]
            yield pa.record_batch(batch.columns[:5] + found, names=batch.schema.names[:5] + ["sequence_id", "offset"])

    buckets = max(8, min(1 << 16, sum(histogram.values()) // _BUCKET))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(within) - 1).join(before, ["length", "bucket"])
    return ranked.select(*cut.columns, (F.col("before") + F.col("nth")).alias("rank")).mapInArrow(look_up, _PLACES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents with sequence_id and offset, gapless from 0 in every sequence."""
    return place(stage(pieces(docs, tokenizer, capacity, end), "pieces"), capacity)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_best_two_fit_packing(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), tokenizer_path())
