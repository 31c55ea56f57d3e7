"""Jaccard self-join on word shingles, and the groups of similar documents that it links.

Documents with equal shingle sets form a class first, and one document stands for it. Of each set the
rarest shingles that any partner must share (the prefix of its length) deal it to tiles: documents
with a prefix shingle in common and sizes within the threshold of each other. Within a tile a hashed
bitmap of each set bounds every overlap from above, since a bit of one set that the other lacks stands for at
least one element it lacks. Pairs that pass are intersected as sorted arrays, exactly.

The work ends after two rounds of tiles. In the first, blocks of a long stretch meet themselves and the next one.
A tile with few passing pairs hands on all of them; a dense one, in a large group of near copies, hands on a
spanning forest of them, best bounds first. The second round looks at dense tiles again and at all other pairs of
blocks whose sizes can meet, but only at pairs of documents still in different components, and not at
all at blocks that lie in one component. A tile that is dense even then, among documents similar but not similar enough, gets
the sorted arrays of its documents and intersects them in place: products of 0/1 columns of their
shingles count all its overlaps exactly, and a spanning forest of its true links is handed on. So no
component is missed, no tile emits all its pairs, and there is no third round.

Input: columns doc_id and text; others, whatever their names, are ignored. A null text or one without words has an empty set, which
links with nothing. A null doc_id links with nothing and has a null component. Rows that repeat a doc_id are one
node. Texts are read whole. Which of equal shingles or pairs comes first changes no result. An empty
table gives an empty result. Sets are compared by 64-bit shingle hashes, classes by 128 bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakflow.llm import text as X
from peakflow.llm.graph import components
from peakflow.llm.hot import frequent
from peakflow.sources.staging import stage

TILE = 1024  # rows of a tile's side
DENSE = 16  # candidate pairs per row up to which a tile hands on all
_COLUMNS = 4096  # shingles counted together in a dense tile
_BITS = 2  # bitmap bits per element, rounded down to a power of two
_FILTER = 1 << 23  # bits of the filter of wanted documents

_SUMMARY = "doc_id long, n long, s1 long, s2 long, prefix array<long>, bitmap binary"


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted, and the offsets of the texts in them."""
    words = X.words_of(column, lower=True)
    hashes = words.hashes()
    keep = np.flatnonzero(X.complete(words.first, size))
    text, shingles = words.text_of[keep], X.windows(hashes, size)[keep]
    counts = words.counts
    for few in range(1, size):  # the whole sequence is one shingle
        rows = np.flatnonzero(counts == few)
        if len(rows):
            whole = X.mix(X.windows(hashes, few)[words.first[rows]] + np.uint64(few))
            text, shingles = np.append(text, rows), np.append(shingles, whole)
    order = np.lexsort((shingles, text))
    text, shingles = text[order], shingles[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingles[1:] != shingles[:-1])
    text, shingles = text[new], shingles[new]
    return shingles, np.searchsorted(text, np.arange(len(column) + 1))


def bitmap(values: np.ndarray) -> np.ndarray:
    """Bits of a set of hashes, in a width that follows its size. A wider one folds into a narrower one."""
    width = max(64, 1 << (int(_BITS * len(values)).bit_length() - 1))
    bits = np.zeros(width, np.uint8)
    bits[values & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _summaries(docs: DataFrame, size: int, num: int, den: int, hot: np.ndarray) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in X.slices(batches):
            values, first = _sets(part.column("text"), size)
            n = np.diff(first)
            s1 = np.concatenate([[0], np.cumsum(X.mix(values ^ np.uint64(0x5851F42D4C957F2D)))]).astype(np.uint64)
            s2 = np.concatenate([[0], np.cumsum(X.mix(values + np.uint64(0x14057B7EF767814F)))]).astype(np.uint64)
            often = np.isin(X.signed(values), hot)
            prefix, bits = [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                own = values[a:b]
                length = (b - a) - -(-num * (b - a) // den) + 1 if b > a else 0
                ranked = np.concatenate([own[~often[a:b]], own[often[a:b]]]) if often[a:b].any() else own
                prefix.append(X.signed(ranked[:length]))
                bits.append(bitmap(own).tobytes() if b > a else b"")
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, prefix)]), pa.int32()),
                                             pa.array(np.concatenate(prefix) if prefix else [], pa.int64()))
            yield pa.record_batch([part.column("doc_id"), pa.array(n), pa.array(X.signed(s1[first[1:]] - s1[first[:-1]])),
                                   pa.array(X.signed(s2[first[1:]] - s2[first[:-1]])), lists, pa.array(bits, pa.binary())],
                                  names=["doc_id", "n", "s1", "s2", "prefix", "bitmap"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, _SUMMARY)


def _shared(num: int, den: int):
    """Different rows, ordered by token and size, that have a neighbour of the same token within the threshold's size.

    Each gets its place within its token, from which its block follows. One row is carried."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # token, n, doc and place of the last row, and whether it has been handed on
        for batch in batches:
            if not batch.num_rows:
                continue
            token, n, doc = (batch.column(k).to_numpy() for k in range(3))
            if held is not None:
                token, n, doc = np.append(held[0], token), np.append(held[1], n), np.append(held[2], doc)
            new = np.ones(len(token), bool)  # a document whose row is repeated counts once
            new[1:] = (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (doc[1:] != doc[:-1])
            token, n, doc = token[new], n[new], doc[new]
            near = np.zeros(len(token), bool)
            near[1:] = (token[1:] == token[:-1]) & (n[:-1] * den >= n[1:] * num) & (doc[1:] != doc[:-1])
            index = np.arange(len(token))
            base = np.maximum.accumulate(np.where(np.append(True, token[1:] != token[:-1]), index, 0))
            place = index - base
            if held is not None:
                place[base == 0] += held[3]
            keep = near.copy()
            keep[:-1] |= near[1:]
            if held is not None and held[4]:
                keep[0] = False
            yield pa.record_batch([pa.array(token[keep]), pa.array(n[keep]), pa.array(doc[keep]), pa.array(place[keep] // TILE)],
                                  names=["token", "n", "doc", "block"])
            held = (token[-1:], n[-1:], doc[-1:], int(place[-1]), bool(keep[-1]) or (len(token) == 1 and held is not None and held[4]))

    return run


def _passing(n, comp, side, bits, num: int, den: int):
    """Pairs (places of rows ordered by size) of one tile whose bound passes, and the bounds."""
    cross = (side != side[0]).any()
    widths = np.array([len(b) for b in bits])
    stacks = {w: np.stack([_fold(b, w) for b in bits if len(b) >= w]) for w in np.unique(widths).tolist()}
    row_in = {w: np.cumsum(widths >= w) - 1 for w in stacks}
    upto = np.searchsorted(n, n * den // num, side="right")
    a_out, b_out, bound_out = [], [], []
    for i in range(len(n) - 1):
        k = np.arange(i + 1, upto[i])  # sizes from n[i] up to the largest that can reach the threshold
        k = k[(comp[k] != comp[i]) & ((side[k] != side[i]) if cross else True)]
        if not len(k):
            continue
        other = stacks[widths[i]][row_in[widths[i]][k]]
        bound = np.minimum(n[i] - np.bitwise_count(bits[i] & ~other).sum(axis=1).astype(np.int64),
                           n[k] - np.bitwise_count(other & ~bits[i]).sum(axis=1).astype(np.int64))
        ok = bound * den >= num * (n[i] + n[k] - bound)
        if ok.any():
            a_out.append(np.full(ok.sum(), i))
            b_out.append(k[ok])
            bound_out.append(bound[ok] / (n[i] + n[k][ok] - bound[ok]))
    return tuple(np.concatenate(x) if x else np.empty(0, int) for x in (a_out, b_out, bound_out))


def _forest(a, b, comp, bounds) -> list[int]:
    """Edges of a spanning forest over components, best bounds first."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    chosen = []
    for e in np.argsort(-bounds, kind="stable").tolist():
        x, y = find(int(comp[a[e]])), find(int(comp[b[e]]))
        if x != y:
            root[x] = y
            chosen.append(e)
    return chosen


_TILE_KEY = ("token", "i", "j")


def _tiles(num: int, den: int, last: bool):
    """Candidate pairs of tiles, whose rows follow each other. A tile has at most two blocks of rows.

    Of a dense tile a forest comes back and a row that names it (a and b null); in the last round,
    instead, each of its rows with a candidate (b null)."""

    def tile(rows: pa.Table):
        n = rows.column("n").to_numpy()
        order = np.lexsort((rows.column("doc").to_numpy(), n))
        n, doc, comp, side = n[order], *(rows.column(c).to_numpy()[order] for c in ("doc", "comp", "side"))
        raw = rows.column("bitmap").to_pylist() if (comp != comp[0]).any() else []
        a, b, bounds = _passing(n, comp, side, [np.frombuffer(raw[i], np.uint64) for i in order], num, den) if raw else ([], [], [])
        x, y = (pa.array(doc[k] if len(k) else [], pa.int64()) for k in (a, b))
        if len(a) > DENSE * len(n):
            if last:
                x = pa.array(doc[np.unique(np.concatenate([a, b]))])
                y = pa.nulls(len(x), pa.int64())
            else:
                chosen = _forest(a, b, comp, bounds)
                x, y = (pa.concat_arrays([pa.array(doc[k[chosen]], pa.int64()), pa.nulls(1, pa.int64())]) for k in (a, b))
        return x, y, *(pa.repeat(rows.column(c)[0], len(x)) for c in _TILE_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(found):
            return pa.record_batch([pa.concat_arrays(c) for c in zip(*found, strict=True)], names=["a", "b", *_TILE_KEY])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in _TILE_KEY]
            first = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
            if held and tuple(held[-1].column(c)[0].as_py() for c in _TILE_KEY) != tuple(int(k[0]) for k in keys):
                yield out([tile(pa.Table.from_batches(held))])
                held = []
            found = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                found.append(tile(pa.Table.from_batches([*held, batch.slice(a, b - a)])))
                held = []
            if found:
                yield out(found)
            held.append(batch.slice(first[-1]))
        if held:
            yield out([tile(pa.Table.from_batches(held))])

    return run


def true_links(arrays: list[np.ndarray], comp: np.ndarray, side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest, over components, of the linked pairs of one tile."""
    size, rows = np.array(list(map(len, arrays))), len(arrays)
    _, element, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(rows), size)
    # what all rows have counts once for each pair, what only one has for none
    common = np.full((rows, rows), float((count == rows).sum()), np.float32)
    some = (count > 1) & (count < rows)
    number = np.cumsum(some) - 1
    kept = some[element]
    element, row = number[element[kept]], row[kept]
    order = np.argsort(element, kind="stable")
    element, row = element[order], row[order]
    for lo in range(0, int(some.sum()), _COLUMNS):
        a, b = np.searchsorted(element, [lo, lo + _COLUMNS])
        columns = np.zeros((rows, _COLUMNS), np.float32)
        columns[row[a:b], element[a:b] - lo] = 1
        common += columns @ columns.T
    common = common.astype(np.int64)
    linked = common * den >= num * (size[:, None] + size[None, :] - common)
    if (side != side[0]).any():
        linked &= side[:, None] != side[None, :]
    label, chosen = comp.copy(), []
    for i in range(rows):
        while len(k := np.flatnonzero(linked[i] & (label != label[i]))):
            chosen.append((i, int(k[0])))
            label[label == label[k[0]]] = label[i]
    return chosen


def _dense_tiles(num: int, den: int):
    """Links of tiles by their rows' arrays. Rows of a tile follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out():
            links = true_links([h for h, _, _ in held], *(np.array(x) for x in list(zip(*[(c, s) for _, c, s in held], strict=True))), num, den)
            docs = np.array(ids)
            return pa.record_batch([pa.array(docs[[e[k] for e in links]] if links else [], pa.int64()) for k in (0, 1)], names=["a", "b"])

        ids: list[int] = []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in _TILE_KEY), strict=True)
            for key, doc, comp, side, raw in zip(keys, *(batch.column(c).to_pylist() for c in ("doc", "comp", "side")), batch.column("hashes"), strict=True):
                if at is not None and key != at:
                    yield out()
                    held, ids = [], []
                at = key
                ids.append(doc)
                held.append((np.frombuffer(raw.as_buffer(), np.uint64), comp, side))
        if held:
            yield out()

    return run


def _verified(pairs: DataFrame, arrays: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs with `linked`: exact intersection of their sorted shingle arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(common * den >= num * (len(p) + len(q) - common))
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    left = arrays.select(F.col("doc").alias("a"), F.col("hashes").alias("x"))
    right = arrays.select(F.col("doc").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _arrays(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Sorted shingle hashes of the wanted documents, made where their texts are.

    A filter of fixed size over hashed ids tells them from most others; the few it lets through
    besides meet no pair."""
    bit = F.pmod(F.xxhash64("doc"), F.lit(_FILTER))
    cells = wanted.select((bit / 64).cast("int").alias("cell"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc), {_FILTER}) % 64 as int))").alias("b"))
    held = np.zeros(_FILTER // 64, np.uint64)
    for r in cells.groupBy("cell").agg(F.expr("bit_or(b)").alias("b")).collect():
        held[r["cell"]] = np.uint64(r["b"] % (1 << 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            mine = pa.array((held[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1)
            for part in X.slices([batch.filter(mine)]):
                values, first = _sets(part.column("text"), size)
                yield pa.record_batch([part.column("doc_id"), pa.array([values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                                      names=["doc", "hashes"])

    doc = F.col("doc_id").cast("long")
    rows = docs.where(doc.isNotNull()).select(doc.alias("doc_id"), F.pmod(F.xxhash64(doc), F.lit(_FILTER)).alias("bit"), "text")
    return rows.mapInArrow(run, "doc long, hashes binary")


def similar_groups(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; two documents are linked when
    den * |intersection| >= num * |union| of their sets of `size`-word shingles."""
    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")

    def values(column):
        sets, first = _sets(column, size)
        return np.repeat(np.arange(len(first) - 1), np.diff(first)), sets

    summary = stage(_summaries(docs, size, num, den, frequent(ids, values)), "summaries")
    key = ["s1", "s2", "n"]
    classes = stage(summary.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    rep = classes.select(*key, F.col("rep").alias("doc_id"))
    tokens = summary.join(rep, [*key, "doc_id"], "left_semi").select(F.explode("prefix").alias("token"), "n", F.col("doc_id").alias("doc"))
    shared = stage(tokens.repartition("token").sortWithinPartitions("token", "n", "doc")
                   .mapInArrow(_shared(num, den), "token long, n long, doc long, block long"), "shared")
    # tokens of the same documents make the same tile; one of them is enough. Rows of a token differ, so none cancels another
    about = shared.groupBy("token").agg(F.max("block").alias("last"), F.count("*").alias("rows"),
                                        F.expr("bit_xor(xxhash64(doc))").alias("x"), F.expr("bit_xor(xxhash64(doc, n, block))").alias("y"))
    one = about.groupBy("rows", "x", "y").agg(F.min("token").alias("token"), F.max("last").alias("last")).select("token", "last")
    rows = stage(shared.join(one.select("token"), "token").select("token", "n", "doc", "block"), "rows")
    bitmaps = summary.join(rep, [*key, "doc_id"], "left_semi").select(F.col("doc_id").alias("doc"), "bitmap")
    tiles = "token long, i long, j long"

    def told(pairs: DataFrame, comps: DataFrame | None) -> DataFrame:
        """Rows of the wanted pairs of blocks, with their components."""
        ends = pairs.select(*_TILE_KEY, F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
        out = rows.join(ends, ["token", "block"]).withColumnRenamed("block", "side")
        if comps is None:
            return out.withColumn("comp", F.col("doc"))
        return out.join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")

    def searched(pairs: DataFrame, comps: DataFrame | None) -> DataFrame:
        columns = [*_TILE_KEY, "side", "n", "doc", "comp", "bitmap"]
        dealt = told(pairs, comps).join(bitmaps, "doc").select(*columns).repartition(*_TILE_KEY).sortWithinPartitions(*_TILE_KEY)
        return stage(dealt.mapInArrow(_tiles(num, den, comps is not None), f"a long, b long, {tiles}"), "found")

    def exact(found: DataFrame) -> DataFrame:
        pairs = stage(found.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
        wanted = pairs.select(F.col("a").alias("doc")).unionAll(pairs.select("b")).distinct()
        return stage(_verified(pairs, stage(_arrays(docs, wanted, size), "shingles"), num, den), "tested").where("linked").select("a", "b")

    near = F.explode(F.sequence(F.col("block"), F.least(F.col("block") + 1, F.col("last")))).alias("j")
    blocks = rows.groupBy("token", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    spans = stage(blocks.join(one, "token"), "spans")
    first_pairs = spans.select("token", F.col("block").alias("i"), near)
    found = searched(first_pairs, None)
    links = exact(found)
    comps = stage(components(links), "components")
    # blocks within the size of each other that were dense, or have not met
    long = spans.where("last > 1").select("token", "block", "lo", "hi")
    x, y = long.alias("x"), long.alias("y")
    apart = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.block") > F.col("x.block") + 1) & (F.col("y.lo") * num <= F.col("x.hi") * den))
    more = found.where("a is null").select(*_TILE_KEY).unionAll(apart.select("x.token", F.col("x.block").alias("i"), F.col("y.block").alias("j")))
    unsure = rows.join(more.select("token").distinct(), "token", "left_semi").join(comps.withColumnRenamed("node", "doc"), "doc", "left")
    own = F.coalesce("component", "doc")
    pure = unsure.groupBy("token", "block").agg(F.min(own).alias("least"), F.max(own).alias("most"))
    left, right = (pure.select("token", *[F.col(c).alias(f"{c}_{k}") for c in ("least", "most")], F.col("block").alias(k)) for k in ("i", "j"))
    mixed = (F.least("least_i", "least_j") != F.greatest("most_i", "most_j"))
    open_ = stage(more.join(left, ["token", "i"]).join(right, ["token", "j"]).where(mixed).select(*_TILE_KEY), "open")
    if open_.take(1):
        found = searched(open_, comps)
        dense = found.where("b is null").select(*_TILE_KEY, F.col("a").alias("doc"))
        links = comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(exact(found))
        if dense.take(1):
            arrays = stage(_arrays(docs, dense.select("doc").distinct(), size), "shingles")
            dealt = told(dense.select(*_TILE_KEY).distinct(), comps).join(dense, [*_TILE_KEY, "doc"], "left_semi").join(arrays, "doc")
            dealt = dealt.select(*_TILE_KEY, "side", "doc", "comp", "hashes").repartition(*_TILE_KEY).sortWithinPartitions(*_TILE_KEY)
            links = links.unionAll(stage(dealt.mapInArrow(_dense_tiles(num, den), "a long, b long"), "dense"))
        comps = stage(components(links), "components")
    labelled = summary.select("doc_id", *key).join(classes, key, "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    return labelled.select("doc_id", F.col("n").alias("n_shingles"),
                           F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group: that of its smallest doc_id, and one of several with that id.

    Different texts under one id are documents of their own, and so are texts without an id; these count as larger than
    all ids. Rows of one id (or of none) and one text are copies. Documents without words are in no
    group, so those with an id all stay, once per row."""
    own, n = F.xxhash64("text"), docs.columns
    text = f"c{n.index('text')}"
    hashed = docs.select(F.col("doc_id").cast("long").alias("_id"), own.alias("_own"))
    seen = hashed.groupBy("_id").agg(F.count("*").alias("_rows"), F.min("_own").alias("_least"), F.max("_own").alias("_most"))
    # ids that say less than one row each; known by its size, so texts are moved only if there are many
    several = stage(seen.where("_rows > 1 or _id is null"), "several")
    kept_columns = [F.col(c).alias(f"c{k}") for k, c in enumerate(n)]
    marked = docs.select(*kept_columns, F.col("doc_id").cast("long").alias("_id"), own.alias("_own"))
    marked = marked.alias("d").join(several.alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")), "left").drop(F.col("s._id"))
    node = F.when(F.col("_rows").isNull() | (F.col("_id").isNotNull() & (F.col("_own") == F.col("_least"))), F.col("_id")).otherwise(
        F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("_id", text), 2))
    nodes = marked.withColumn("_node", node)
    groups = similar_groups(nodes.select(F.col("_node").alias("doc_id"), F.col(text).alias("text")), size, num, den)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_node")).distinct()
    left = nodes.join(gone, "_node", "left_anti")
    back = [F.col(f"c{k}").alias(c) for k, c in enumerate(n)]
    again = F.col("_rows").isNotNull() & F.col(text).rlike("[^ \\t-\\r]")
    once = left.where(again).groupBy("_node").agg(F.first(F.struct(*[f"c{k}" for k in range(len(n))])).alias("r")).select("r.*")
    return left.where(~F.coalesce(again, F.lit(False))).select(*back).unionAll(once.select(*back))


def op5_ngram_jaccard_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_groups(docs, size=3, num=90, den=100)
