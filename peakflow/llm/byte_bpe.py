"""Byte-level BPE without regular expressions: encoding to ids with offsets, and decoding.

Pre-tokenisation works on arrays of code point classes. The pattern's matches are found by a small automaton; what a
character does to the automaton's state is a function of states, and composing such functions is associative.
There are only a few dozen different compositions (the transition monoid), so a character is one small number, a
table multiplies two of them, and a blocked prefix scan gives the state at every character at once. A table over the
states before and after a character, and a look at the next one, tells where a piece begins. Each different
piece of a few megabytes is merged once by its ranks and remembered for a while.

Input: columns doc_id and text; others, whatever their names, are ignored. A null or empty text has no ids. Texts of any length are
read whole; a text is worked on in one task, in arrays of a few times its size, and a piece of n bytes is merged in n log n steps. Repeated
rows and null ids come back once per row, ties between equal ranks go to the left, an empty table gives
an empty result."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X

# fixed values: the pattern's contractions ('s 't 'm 'd 're 've 'll) and its blank
_ONE_LETTER, _TWO_LETTERS = "stmd", ("re", "ve", "ll")

# classes of code points
LETTER, ENDS, R, V, L, E, NUMBER, OTHER, QUOTE, BLANK, SPACE = range(11)
_CLASSES = 11  # a class plus this one stands for a first character of a text
# states: what the piece of the last character is so far
START, WORD, DIGITS, SIGNS, AFTER_BLANK, AFTER_SPACE, QUOTED, SEEN_R, SEEN_V, SEEN_L, DONE = range(11)
_STATES = 11
# what a pair of states says about a boundary between them
_JOINED, _CUT, _CUT_UNLESS_DONE, _CUT_BEFORE_LAST = range(4)

_CACHE = 1 << 18  # different pieces remembered
_SHORT = 32  # bytes of a piece up to which pieces are merged side by side
_NONE = np.iinfo(np.int32).max
_BLOCK = 1 << 10  # characters folded one after the other; blocks of them side by side


def _after(state: int, kind: int) -> int:
    """State after a character of a class."""
    if kind <= E:
        if state == QUOTED:
            return {ENDS: DONE, R: SEEN_R, V: SEEN_V, L: SEEN_L}.get(kind, WORD)
        return DONE if (state, kind) in ((SEEN_R, E), (SEEN_V, E), (SEEN_L, L)) else WORD
    if kind == QUOTE:
        return SIGNS if state in (SIGNS, QUOTED, AFTER_BLANK) else QUOTED
    return {NUMBER: DIGITS, OTHER: SIGNS, BLANK: AFTER_BLANK, SPACE: AFTER_SPACE}[kind]


def _boundary(before: int, state: int) -> int:
    """Whether a piece begins at a character, by the states before and after it."""
    spaces = (AFTER_BLANK, AFTER_SPACE)
    if state in spaces:
        return _CUT_BEFORE_LAST if before in spaces else _CUT
    if before == AFTER_BLANK or state == DONE:
        return _JOINED
    if state in (SEEN_R, SEEN_V, SEEN_L):
        return _CUT_UNLESS_DONE
    if state == WORD:
        return _JOINED if before in (WORD, SEEN_R, SEEN_V, SEEN_L) else _CUT
    return _JOINED if (state, before) in ((DIGITS, DIGITS), (SIGNS, SIGNS), (SIGNS, QUOTED)) else _CUT


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The generator of each symbol, products of monoid elements, what each element makes of a state, boundaries."""
    one = [tuple(_after(s, k) for s in range(_STATES)) for k in range(_CLASSES)]
    one += [(f[START],) * _STATES for f in one]  # a first character forgets what was before
    elements = {f: k for k, f in enumerate(dict.fromkeys([tuple(range(_STATES)), *one]))}
    work = list(elements)
    while work:
        f = work.pop()
        for g in one:
            product = tuple(g[s] for s in f)
            if product not in elements:
                elements[product] = len(elements)
                work.append(product)
    images = np.array(list(elements), np.uint8)
    products = np.array([[elements[tuple(b[a].tolist())] for b in images] for a in images], np.int16)
    edges = np.array([[_boundary(a, b) for b in range(_STATES)] for a in range(_STATES)], np.uint8)
    return np.array([elements[f] for f in one], np.int16), products, images, edges


@cache
def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """First code point and class of every stretch of code points of one class.

    Letters, numbers and white space are those of the tokenizer library's own tables, asked for once."""
    import tiktoken

    points = np.r_[0:0xD800, 0xE000:0x110000]
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, points.tolist()))
    single = {bytes([b]): b for b in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        found = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = kind
    for c in _ONE_LETTER:
        table[ord(c)] = ENDS
    for c, kind in (("r", R), ("v", V), ("l", L), ("e", E), ("'", QUOTE), (" ", BLANK)):
        table[ord(c)] = kind
    begins = np.flatnonzero(np.append(True, table[1:] != table[:-1]))
    return begins, table[begins]


def scan(elements: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Products of each element with all before it, by an associative scan.

    Blocks are folded side by side; the totals of the blocks are scanned alike and multiplied in front."""
    if len(elements) <= 64:
        out = elements.copy()
        for k in range(1, len(out)):
            out[k] = products[out[k - 1], out[k]]
        return out
    width = min(_BLOCK, int(len(elements) ** 0.5) + 1)
    rows = -(-len(elements) // width)
    padded = np.zeros(rows * width, elements.dtype)  # element 0 changes nothing
    padded[:len(elements)] = elements
    columns = padded.reshape(rows, width).T.copy()
    for k in range(1, width):
        columns[k] = products[columns[k - 1], columns[k]]
    before = np.zeros(rows, elements.dtype)
    before[1:] = scan(columns[-1], products)[:-1]
    return products[before[:, None], columns.T].ravel()[:len(elements)]


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters of several bytes that begin at `at`."""
    lead, last = data[at].astype(np.int64), len(data) - 1
    two, three, four = (data[np.minimum(at + k, last)] & 0x3F for k in (1, 2, 3))
    point = ((lead & 0x1F) << 6) | two
    wide = (((lead & 0x0F) << 12) | (two.astype(np.int64) << 6)) | three
    widest = (((lead & 0x07) << 18) | (two.astype(np.int64) << 12)) | (three.astype(np.int64) << 6) | four
    return np.minimum(np.where(lead >= 0xF0, widest, np.where(lead >= 0xE0, wide, point)), 0x10FFFF)


def piece_starts(data: np.ndarray, offsets: np.ndarray, runs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Byte places where the pieces of all texts begin."""
    begins, kinds = runs
    at = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    if not len(at):
        return np.flatnonzero(first[:-1])
    low = np.repeat(kinds, np.diff(np.append(begins, 0x110000)))[:0x80]
    kind = low[np.minimum(data[at], 0x7F)]
    wide = np.flatnonzero(data[at] >= 0x80)
    kind[wide] = kinds[np.searchsorted(begins, _code_points(data, at[wide]), side="right") - 1]
    generator, products, images, edges = automaton()
    new = first[at]
    state = images[scan(generator[kind + _CLASSES * new], products), START]
    before = np.append(np.uint8(START), state[:-1])
    edge = edges[before, state]
    following = np.append(state[1:], np.uint8(START))
    ends_here = np.append(new[1:], True)
    plain = ~ends_here & (following != AFTER_BLANK) & (following != AFTER_SPACE)
    cut = new | (edge == _CUT) | ((edge == _CUT_UNLESS_DONE) & ((following != DONE) | ends_here)) | ((edge == _CUT_BEFORE_LAST) & plain)
    return at[cut]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class Coder:
    """Encoder and decoder by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], runs: tuple[np.ndarray, np.ndarray]):
        self._ranks, self._runs = ranks, runs
        tokens = sorted((i, t) for t, i in ranks.items())
        self._stored = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
        sizes = np.zeros(tokens[-1][0] + 1, np.int64)
        sizes[[i for i, _ in tokens]] = [len(t) for _, t in tokens]
        self._sizes, self._places = sizes, np.cumsum(sizes) - sizes
        self._bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = sorted((ranks[a] * len(sizes) + ranks[b], r) for t, r in ranks.items() for k in range(1, len(t))
                       if (a := t[:k]) in ranks and (b := t[k:]) in ranks)
        self._pairs, self._ranked = np.array([k for k, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int32)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._store, self._bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make together."""
        key = a.astype(np.int64) * len(self._sizes) + b
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where((self._pairs[at] == key) & (a >= 0) & (b >= 0), self._ranked[at], _NONE)

    def _side_by_side(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of short pieces: in each round every piece joins its leftmost pair of lowest rank."""
        width, sizes = max(map(len, pieces)), np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        ids[:, :width] = np.where(np.arange(width) < sizes[:, None], self._bytes[raw], -1)
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        rows, column = np.arange(len(pieces)), np.arange(width)
        done = ids.copy()
        while len(rows):
            k = ranks.argmin(axis=1)
            own = np.arange(len(rows))
            lowest = ranks[own, k]
            ended = lowest == _NONE
            done[rows[ended]] = ids[ended]
            live = ~ended
            rows, ids, ranks, k, lowest, own = rows[live], ids[live], ranks[live], k[live], lowest[live], np.arange(live.sum())
            moved = column > k[:, None]
            ids[:, :-1] = np.where(moved, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(moved[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ids[:, -1] = -1
            ranks[:, -1] = _NONE
            ids[own, k] = lowest
            ranks[own, k] = self._rank(lowest, ids[own, k + 1])
            left = k > 0
            ranks[own[left], k[left] - 1] = self._rank(ids[own[left], k[left] - 1], lowest[left])
        return [row[:n] for row, n in zip(done, (done >= 0).sum(axis=1).tolist(), strict=True)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Merge pieces not seen before, and remember them."""
        found: list = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self._ranks.get(piece)) is not None:
                found[k] = (whole,)
            elif len(piece) > _SHORT:
                found[k] = self.merged(piece)
            else:
                by_size.setdefault((len(piece) + 3) // 4, []).append(k)
        for places in by_size.values():
            for k, ids in zip(places, self._side_by_side([pieces[k] for k in places]), strict=True):
                found[k] = ids
        self._known.update(zip(pieces, range(len(self._bounds) - 1, len(self._bounds) - 1 + len(pieces)), strict=True))
        self._store = np.concatenate([self._store, *[np.asarray(x, np.uint32) for x in found]])
        self._bounds = np.append(self._bounds, self._bounds[-1] + np.cumsum([len(x) for x in found]))

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece: always the pair of lowest rank is joined, the leftmost of equals."""
        ranks = self._ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
        heap = [(r, k, 2) for k in range(n - 1) if (r := ranks.get(piece[k:k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, length = heapq.heappop(heap)
            m = after[k]
            if not size[k] or m >= n or size[k] + size[m] != length:
                continue  # one of the two has been joined to something else since
            size[k], size[m], after[k] = length, 0, after[m]
            if after[k] < n:
                before[after[k]] = k
                both = length + size[after[k]]
                if (r := ranks.get(piece[k:k + both])) is not None:
                    heapq.heappush(heap, (r, k, both))
            if (p := before[k]) >= 0:
                both = size[p] + length
                if (r := ranks.get(piece[p:p + both])) is not None:
                    heapq.heappush(heap, (r, p, both))
        out, k = [], 0
        while k < n:
            out.append(ranks[piece[k:k + size[k]]])
            k += size[k]
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts in them."""
        data, offsets = X.bytes_of(column)
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        starts = piece_starts(data, np.append(offsets[:-1][np.diff(offsets) > 0], offsets[-1]), self._runs)
        ends = np.append(starts[1:], len(data))
        where, inverse = X.distinct_spans(data, starts, ends)
        if len(self._known) > _CACHE:
            self._forget()
        whole = data.tobytes()
        pieces = [whole[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        if unknown := [p for p in pieces if p not in self._known]:
            self._learn(unknown)
        store, bounds, at = self._store, self._bounds, np.array([self._known[p] for p in pieces])
        size = (bounds[at + 1] - bounds[at])[inverse]
        flat = store[X.ragged(bounds[at][inverse], size)]
        return flat, np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]

    def ends(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Byte place within its text where each token ends."""
        upto = np.append(0, np.cumsum(self._sizes[ids]))
        return upto[1:] - np.repeat(upto[first[:-1]], np.diff(first))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids; an id without a token is an error."""
        if len(ids) and (ids.max() >= len(self._sizes) or not self._sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return self._stored[X.ragged(self._places[ids], self._sizes[ids])].tobytes()


@cache
def _coder(path: str, begins: bytes, kinds: bytes) -> Coder:
    return Coder(load_ranks(path), (np.frombuffer(begins, np.int64), np.frombuffer(kinds, np.uint8)))


def rank_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, `ids` (little-endian unsigned 32-bit numbers) and `ends` (the same, the byte place in the
    text where each token ends) of every row."""
    begins, kinds = class_runs()
    key = path, begins.astype(np.int64).tobytes(), kinds.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*key)
        for part in X.slices(batches):
            ids, first = coder.encode(part.column("text"))
            places = (first * 4).tolist()

            def packed(values):
                raw = values.astype("<u4").tobytes()
                return pa.array([raw[a:b] for a, b in zip(places[:-1], places[1:], strict=True)], pa.binary())

            yield pa.record_batch([part.column("doc_id"), packed(ids), packed(coder.ends(ids, first))], names=["doc_id", "ids", "ends"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids binary, ends binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` and `decoded`, the bytes that its `ids` stand for (null for null)."""
    begins, kinds = class_runs()
    key = path, begins.astype(np.int64).tobytes(), kinds.tobytes()
    plain = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*key)
        for batch in batches:
            out = [None if (raw := x.as_py()) is None else coder.decode(np.frombuffer(raw, "<u4")) for x in batch.column("ids")]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return plain.mapInArrow(run, schema)


def op13_byte_bpe(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = rank_path()
    coded = decode(encode(docs, path).drop("ends"), path)
    return coded.select("doc_id", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
