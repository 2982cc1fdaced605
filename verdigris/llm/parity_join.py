"""N-gram Jaccard join by parity sketches: a pigeonhole join on blocks, then bit sketches, then exact sets.

A document's set of shingles is cut into blocks by a hash of the shingle, and each block is the XOR of
its shingles' hashes. One shingle in one set alone changes one block, so two sets differ in
at most as many blocks as their symmetric difference has shingles. Sets with a Jaccard
similarity of t or more differ in at most (1 - t) / (1 + t) * (|A| + |B|) shingles: with more
non-empty blocks than that, they have an equal one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm import dealing
from verdigris.llm.shared import components, id_filter, listed, stored, with_hash
from verdigris.llm.words import SPACES, Hasher, constants, mix, ngrams, slices

SHINGLE = 5
#: Similarity in percent from which two sets are linked.
PERCENT = 75
#: A band holds sizes from its least one to just under that times WIDE; bands start at powers of STEP.
#: WIDE >= STEP * 100 / PERCENT, so any two sizes that can be linked have a band in common.
STEP = (4 / 3) ** 2
WIDE = (4 / 3) ** 3
#: Block layouts tried, by seed, for sets with too few non-empty blocks; at the end single shingles are keys.
SEEDS = 3
BUCKET_KEYS = 3_000_000


@lru_cache(maxsize=None)
def band_range(band: int) -> tuple[int, int]:
    """Sizes of a band: least and below."""
    return math.ceil(STEP**band - 1e-9), math.ceil(STEP**band * WIDE - 1e-9)


def bands_of(size: int) -> list[int]:
    top = int(math.log(size) / math.log(STEP) + 1e-9) + 1
    return [b for b in range(max(0, top - 3), top + 1) if band_range(b)[0] <= size < band_range(b)[1]]


def difference(size: int, below: int) -> int:
    """Most shingles in which a set of ``size`` differs from a linked one of its band that is as large or larger."""
    larger = min(size * 100 // PERCENT, below - 1)
    return (size + larger) * (100 - PERCENT) // (100 + PERCENT)


@lru_cache(maxsize=None)
def blocks(band: int) -> int:
    """Number of blocks of a band: enough that sets of nearly all its sizes have more non-empty ones than they may differ in."""
    least, below = band_range(band)
    n = 1
    while True:
        short = False
        for size in {least, (least + below) // 2, below - 1}:
            full = n * (1 - (1 - 1 / n) ** size)
            empty = n - full
            if full - 2 * math.sqrt(min(full, empty)) < difference(size, below) + 1:
                short = True
        if not short or n >= 6 * below:
            return n
        n += max(1, n // 50)


#: Low bits of a key that tell its layout: the last bits of its band, of which a set has two that follow each other, and its seed.
_LAYOUT_BITS = 4
_LAYOUT_MASK = (1 << _LAYOUT_BITS) - 1


def _layouts(values: np.ndarray, hot: np.ndarray | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(band, seed, shingles, block of each, non-empty blocks) of the layouts that a set tries; without blocks where single shingles are the keys."""
    cold = values
    if hot is not None and len(hot) and len(values):
        cold = values[hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] != values]
    none = np.empty(0, dtype=np.int64)
    for band in bands_of(len(values)) if len(values) else ():
        n = blocks(band)
        allowed = difference(len(values), band_range(band)[1])
        for seed in range(SEEDS):
            used = values if seed else cold
            place = ((mix(used ^ constants(3, 100 + band * 8 + seed)[0]) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            place = place.astype(np.int64)
            full = np.flatnonzero(np.bincount(place, minlength=n))
            yield band, seed, used, place, full
            if len(full) > allowed:
                break
        else:
            # two sets that both come here are linked only if they share a shingle
            yield band, SEEDS, values, none, none


def _layout(band: int, seed: int) -> int:
    return (band & 3) * 4 + seed


def set_keys(values: np.ndarray, hot: np.ndarray | None = None) -> np.ndarray:
    """Join keys of one set of shingle hashes; linked sets have one in common, or are equal.

    Leaving the same shingles out of both sets changes no more blocks, so the first layout is without ``hot`` ones
    (sorted hashes): passages of many documents would make alike blocks in all of them.
    A set with too few non-empty blocks to be sure of an equal one tries other layouts, of all its shingles.
    """
    out = []
    for band, seed, used, place, full in _layouts(values, hot):
        factors = constants(3, 100 + band * 8 + seed)
        if seed == SEEDS:
            keys = mix(used + factors[0])
        else:
            parity = np.zeros(blocks(band), dtype=np.uint64)
            np.bitwise_xor.at(parity, place, mix(used + factors[1]))
            keys = mix(parity[full] + (full.astype(np.uint64) + np.uint64(1)) * factors[2])
        out.append(keys & ~np.uint64(_LAYOUT_MASK) | np.uint64(_layout(band, seed)))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def keys_in_common(values: np.ndarray, hot: np.ndarray | None = None) -> list[int]:
    """For each layout of a set, how many of its keys a linked set has at least, if that set tries this layout too and not fewer; above _LAYOUT_BITS bits that tell the layout.

    0 where nothing is sure of the layout.
    """
    out = []
    for band, seed, _, _, full in _layouts(values, hot):
        sure = max(0, len(full) - difference(len(values), band_range(band)[1]))
        out.append(sure << _LAYOUT_BITS | _layout(band, seed))
    return out


def sketch(values: np.ndarray, words: int) -> np.ndarray:
    """Parity of the shingles that fall on each of ``64 * words`` bits."""
    bits = np.bincount((mix(values) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


#: Words of 64 bits of the largest sketch and of the least.
SKETCH_WORDS, LEAST_WORDS = 32, 2
#: The same where pairs are told apart: as many bits as shingles at least, as a fuller sketch lets unlike sets through.
PAIR_WORDS = 4096
PAIR_BITS = 2


def sketch_words(size: int, most: int = SKETCH_WORDS, bits: int = 1) -> int:
    """Words of a set's sketch: a power of two, with so many bits for each shingle as far as there are so many words."""
    words = LEAST_WORDS
    while words < most and 64 * words < bits * size:
        words *= 2
    return words


class _Rows:
    """Sketches of one size, of those rows alone that have one, by the number of the row."""

    def __init__(self, rows: np.ndarray, values: np.ndarray, total: int) -> None:
        self.rows, self.values = rows, values
        self.place = np.full(total, -1, dtype=np.int64)
        self.place[rows] = np.arange(len(rows))

    def __getitem__(self, i: int | np.ndarray) -> np.ndarray:
        return self.values[self.place[i]]


class Sketches:
    """Sketches of several sizes. One of twice the words is folded to the size of another by the XOR of its halves."""

    def __init__(self, column: list[bytes]) -> None:
        self.words = np.array([len(c) // 8 for c in column], dtype=np.int64)
        self.at: dict[int, _Rows] = {}
        words = int(self.words.max(initial=LEAST_WORDS))
        while words >= LEAST_WORDS:
            own = np.flatnonzero(self.words == words)
            values = np.frombuffer(b"".join(column[i] for i in own), dtype="<u8").reshape(len(own), words)
            if 2 * words in self.at:
                larger = self.at[2 * words]
                own = np.concatenate([own, larger.rows])
                values = np.concatenate([values, larger.values[:, :words] ^ larger.values[:, words:]])
            self.at[words] = _Rows(own, values, len(column))
            words //= 2


#: Words of sketches compared in one step.
_STEP_WORDS = 1 << 20


def apart(one: Sketches, i: np.ndarray, other: Sketches, j: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, at the lesser size of each two: at most their sets' symmetric difference."""
    words = np.minimum(one.words[i], other.words[j])
    out = np.zeros(len(i), dtype=np.int64)
    for size in np.unique(words).tolist():
        on = np.flatnonzero(words == size)
        step = max(1, _STEP_WORDS // size)
        for start in range(0, len(on), step):
            part = on[start : start + step]
            out[part] = np.bitwise_count(one.at[size][i[part]] ^ other.at[size][j[part]]).sum(axis=1, dtype=np.int64)
    return out


def shingle_sets(texts: list[bytes], hasher: Hasher) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, cuts = hasher.words(texts)
    grams = ngrams(hashes, SHINGLE)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        else:
            out.append(ngrams(hashes[a:b], b - a) if b > a else np.empty(0, dtype=np.uint64))
    return out


#: A shingle is hot if this share of all rows has it, but at least so many; found from counts of
#: parts of the input, so that a rarer one may be missed, which costs time but no link.
HOT_SHARE = 0.001
HOT_LEAST = 20
_PART_SHINGLES = 2_000_000
_PART_LEAST = 4


def set_sizes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(kind, id, n_shingles, h1, h2). Kind 0: size of each row's set and 128 bits that tell sets apart, null where empty.
    Kind 1: a shingle h1 that n_shingles sets of one part of the input have."""
    names = ["kind", "id", "n_shingles", "h1", "h2"]

    def frequent(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        values, counts = values[counts >= _PART_LEAST], counts[counts >= _PART_LEAST]
        none = pa.nulls(len(values), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([1] * len(values), pa.int32()), none, pa.array(counts, pa.int64()), pa.array(values.view(np.int64)), none], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES, lower=True)
        held: list[np.ndarray] = []
        size = 0
        for batch, texts in slices(batches):
            sets = shingle_sets(texts, hasher)
            h1 = [int(np.bitwise_xor.reduce(mix(s)).astype(np.int64)) if len(s) else None for s in sets]
            h2 = [int(np.add.reduce(mix(s + np.uint64(77))).astype(np.int64)) if len(s) else None for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            kind = pa.array([0] * len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays([kind, batch.column(0), sizes, pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=names)
            held.extend(sets)
            size += sum(map(len, sets))
            if size >= _PART_SHINGLES:
                yield frequent(held)
                held, size = [], 0
        if held:
            yield frequent(held)

    source = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    return source.mapInArrow(run, "kind int, id long, n_shingles long, h1 long, h2 long")


def hot_shingles(measured: DataFrame, rows: int) -> np.ndarray:
    """Sorted hashes of the hot shingles: at most the mean set size / HOT_SHARE of them, whatever the number of rows."""
    least = max(HOT_LEAST, rows * HOT_SHARE)
    found = measured.where("kind = 1").groupBy("h1").agg(F.sum("n_shingles").alias("n")).where(F.col("n") >= least).select("h1")
    return np.sort(np.array([r.h1 for r in found.collect()], dtype=np.int64).view(np.uint64))


#: Bits of a tag that hold the size of its set; larger sizes count as the largest that fits.
_SIZE_BITS = 20
_SIZE_MASK = (1 << _SIZE_BITS) - 1


def _tag(values: np.ndarray) -> int:
    """Tells a set from others: a hash of it above its size."""
    if not len(values):
        return 0
    whole = int(np.bitwise_xor.reduce(mix(values)))
    return ((whole >> (_SIZE_BITS + 1)) << _SIZE_BITS) | min(len(values), _SIZE_MASK)


def _sizes_allow(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sets of these tags can be linked by their sizes."""
    a, b = one & _SIZE_MASK, other & _SIZE_MASK
    return (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)) | (np.maximum(a, b) == _SIZE_MASK)


def _block_keys(source: DataFrame, n: int, hot) -> DataFrame:
    """Packed keys of the sets; of equal sets in one part of the input only that of the smallest id is sent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES, lower=True)
        for batch, texts in slices(batches):
            sets = shingle_sets(texts, hasher)
            ids = batch.column(0).to_numpy()
            tags = np.array([_tag(s) for s in sets], dtype=np.int64)
            order = np.lexsort((ids, tags))
            keep = np.zeros(len(sets), dtype=bool)
            keep[order[np.append(True, tags[order][1:] != tags[order][:-1])]] = True
            keys = [set_keys(s, hot.value) if k else np.empty(0, dtype=np.uint64) for s, k in zip(sets, keep)]
            owner = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
            if len(owner):
                yield dealing.pack(np.concatenate(keys), owner, ids, tags, n)

    return source.mapInArrow(run, dealing.SCHEMA)


#: Up to so many sets with one key are compared each with each; more in steps.
SMALL_GROUP = 12


def _shared(packed: DataFrame) -> DataFrame:
    """Who has a key in common. Small groups: pairs (a, b), b < a, that their sizes allow, each once per bucket; larger ones: (key, a) with null b."""

    def run(table: pa.Table) -> pa.Table:
        keys, ids, tags = dealing.shared_keys(*dealing.unpack(table), with_tags=True)
        new = np.flatnonzero(np.diff(keys, prepend=keys[0] ^ np.uint64(1))) if len(keys) else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.append(new, len(keys)))
        found = [np.empty((0, 2), dtype=np.int64)]
        for m in range(2, SMALL_GROUP + 1):
            at = new[sizes == m][:, None] + np.arange(m)
            rows, kinds = ids[at], tags[at]
            for i in range(m - 1):
                for j in range(i + 1, m):
                    on = _sizes_allow(kinds[:, i], kinds[:, j])
                    found.append(np.stack([rows[on, j], rows[on, i]], axis=1))
            if len(rows):
                found = [np.unique(np.concatenate(found), axis=0)]
        pairs = np.unique(np.concatenate(found), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        large = np.repeat(sizes > SMALL_GROUP, sizes)
        marks = keys[large] + (np.uint64(table.column("bucket")[0].as_py()) << np.uint64(8 * dealing.KEY_BYTES))
        members = ids[large]
        columns = [
            pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(marks.view(np.int64))]),
            pa.array(np.concatenate([pairs[:, 0], members])),
            pa.concat_arrays([pa.array(np.ascontiguousarray(pairs[:, 1])), pa.nulls(len(members), pa.int64())]),
        ]
        return pa.table(columns, names=["key", "a", "b"])

    return packed.groupBy("bucket").applyInArrow(run, "key long, a long, b long")


#: Bytes kept of each shingle hash where whole sets are compared: 48 bits tell the shingles of two sets apart.
_SHINGLE_BYTES = 6


def _set_table(texts: DataFrame, ids: DataFrame, whole: bool, hot=None) -> DataFrame:
    """(id, n, sketch, common), or (id, shingles), of the rows (id, text) with an id of ``ids``, and of a few others.
    ``common``: see ``keys_in_common``.

    One Python step: two in a row would hold two Python processes for each task.
    """
    test = id_filter(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES, lower=True)
        for batch, parts in slices(listed(batches, test)):
            sets = shingle_sets(parts, hasher)
            if whole:
                low = [np.sort(s & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SHINGLE_BYTES].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low, pa.binary())], names=["id", "shingles"])
            else:
                drawn = pa.array([sketch(s, sketch_words(len(s), PAIR_WORDS, PAIR_BITS)).tobytes() for s in sets], pa.binary())
                common = pa.array([keys_in_common(s, hot.value if hot else None) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), drawn, common], names=["id", "n", "sketch", "common"])

    return with_hash(texts, "id").mapInArrow(run, "id long, shingles binary" if whole else "id long, n long, sketch binary, common array<long>")


def _shingles(data: pa.Buffer) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, _SHINGLE_BYTES)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :_SHINGLE_BYTES] = raw
    return out.view("<u8").ravel()


def _near_size(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Whether sizes allow a link."""
    return 100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)


def _near(n1: np.ndarray, n2: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether sizes, and the bits in which sketches differ, allow a link."""
    return ((100 + PERCENT) * bits <= (100 - PERCENT) * (n1 + n2)) & _near_size(n1, n2)


def _near_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of pairs (a, b) with sizes na and nb those whose sketches allow a link."""
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, sa, nb, sb = batch.columns
            every = np.arange(batch.num_rows)
            ok = _near(na.to_numpy(), nb.to_numpy(), apart(Sketches(sa.to_pylist()), every, Sketches(sb.to_pylist()), every))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(ok))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "sa", "nb", "sb")
    return joined.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, source: DataFrame) -> DataFrame:
    """Of stored pairs (a, b) those that are linked, by the whole sets of their texts in ``source``."""
    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(_set_table(source, involved, whole=True), "sets").dropDuplicates(["id"])
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, other = _shingles(x.as_buffer()), _shingles(y.as_buffer())
                small, large = (one, other) if len(one) <= len(other) else (other, one)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                ok.append(100 * common >= PERCENT * (len(one) + len(other) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def _in_doubt(large: DataFrame, drawn: DataFrame) -> DataFrame:
    """The rows (key, id) of keys of many sets that are needed for every link that shows in no key of few.

    A linked set has so many of a set's keys as ``common`` says. So all but its last keys, one fewer than these, are enough if all
    sets have theirs in one order: of two linked sets the first key in common is among both. Keys of few come first, where the
    pair is compared already; then smaller keys before larger ones. Of the texts of one id the least number counts.
    """
    layout = F.col("key").bitwiseAND(_LAYOUT_MASK)
    said = drawn.select("id", F.explode("common").alias("c"))
    least = said.groupBy("id", F.col("c").bitwiseAND(_LAYOUT_MASK).alias("layout")).agg(F.min(F.shiftright("c", _LAYOUT_BITS)).alias("least"))
    sizes = large.groupBy("key").agg(F.count("*").alias("size"))
    own = Window.partitionBy("id", "layout")
    placed = (
        large.join(sizes, "key")
        .select("id", layout.alias("layout"), "key", F.struct("size", "key").alias("order"))
        .withColumns({"place": F.row_number().over(own.orderBy("order")), "keys": F.count("*").over(own)})
    )
    spare = F.greatest(F.coalesce("least", F.lit(0)) - 1, F.lit(0))
    return placed.join(least, ["id", "layout"], "left").where(F.col("place") <= F.col("keys") - spare).select("key", "id")


#: Side of the square of pairs compared at once, and rows of one key in one task.
TILE = 512


def _rest_pairs(members: DataFrame) -> DataFrame:
    """Pairs of one key and of different components whose sketches allow a link, tile by tile.

    A key's rows are dealt into groups by a hash of the id, about TILE in each; a task has two of the groups.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("groups"))
    own = F.pmod(F.xxhash64("id"), F.col("groups")).cast("int")
    # group g meets group h in the tile of (smaller, larger); each row goes to one tile per group
    tiled = members.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    tiled = tiled.select("key", F.least("own", "other").alias("g"), F.greatest("own", "other").alias("h"), "own", "id", "component", "n", "sketch")
    # many small tiles in one call of Python
    dealt = tiled.withColumn("bin", F.pmod(F.xxhash64("key", "g", "h"), F.lit(1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            g, h, own, ids, comp, n = (table.column(c).to_numpy() for c in ("g", "h", "own", "id", "component", "n"))
            keys = table.column("key").to_numpy()
            sketches = Sketches(table.column("sketch").to_pylist())
            edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(g) != 0) | (np.diff(h) != 0)) + 1
            found = []
            for part in np.split(np.arange(len(keys)), edges):
                if len(part) < 2:
                    continue
                one = part if g[part[0]] == h[part[0]] else part[own[part] == g[part[0]]]
                two = part if g[part[0]] == h[part[0]] else part[own[part] == h[part[0]]]
                for start in range(0, len(one), 64):
                    rows = one[start : start + 64]
                    i, j = np.nonzero((comp[rows][:, None] != comp[two][None, :]) & _near_size(n[rows][:, None], n[two][None, :]))
                    i, j = rows[i], two[j]
                    ok = _near(n[i], n[j], apart(sketches, i, sketches, j))
                    x, y = ids[i[ok]], ids[j[ok]]
                    found.append(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1))
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 20_000:
                table = pa.Table.from_batches(held)
                last = table.num_rows - 1
                tail = [table.column(c)[last].as_py() for c in ("key", "g", "h")]
                cut = last
                keys, g, h = (table.column(c).to_numpy() for c in ("key", "g", "h"))
                same = (keys == tail[0]) & (g == tail[1]) & (h == tail[2])
                cut = int(np.argmax(same))
                if cut:
                    yield from done(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    sorted_rows = dealt.repartition("bin").sortWithinPartitions("key", "g", "h").drop("bin")
    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles and component_id, the smallest id reachable by links.

    Two rows are linked when the Jaccard similarity of their sets of 5-word shingles (A-Z lowered;
    fewer words: the sequence as one) is 0.75 or more. Null and empty texts have empty sets
    and are linked with nothing; their component is their own id. A row without id has no links
    and a null component. Rows that share an id are one node. Ids are integers. An empty table
    gives no rows; other columns are not read.

    Equal sets are one node before the join. Few rows with one key are compared each with each; many
    with their smallest one: components are then known for most, and only pairs in
    different components are compared further, in tiles of a set size. Sizes and sketches come before whole sets.
    """
    measured = stored(set_sizes(docs, id_column, text_column), "set-sizes")
    base = measured.where("kind = 0").select("id", "n_shingles", "h1", "h2")
    whole = base.where("h1 IS NOT NULL AND id IS NOT NULL")
    nodes = stored(whole.groupBy("n_shingles", "h1", "h2").agg(F.min("id").alias("node")), "nodes")
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    n = max(1, -(-int(total) // BUCKET_KEYS))
    source = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    hot = docs.sparkSession.sparkContext.broadcast(hot_shingles(measured, base.count()))
    shared = stored(_shared(_block_keys(source, n, hot)), "shared-keys")
    involved = shared.select(F.col("a").alias("id")).union(shared.where("b IS NOT NULL").select("b")).distinct()
    drawn = stored(_set_table(source, involved, whole=False, hot=hot), "sketches")
    sketches = drawn.select("id", "n", "sketch").dropDuplicates(["id"])
    members = stored(_in_doubt(shared.where("b IS NULL").select("key", F.col("a").alias("id")), drawn), "members")
    least = members.groupBy("key").agg(F.min("id").alias("b"))
    stars = members.join(least, "key").where("id <> b").select(F.col("id").alias("a"), "b")
    pairs = shared.where("b IS NOT NULL").select("a", "b").union(stars).distinct()
    sizes = nodes.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"))
    na, nb = (sizes.select(F.col("id").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    near_size = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    sized = stored(pairs.join(na, "a").join(nb, "b").where(near_size), "pairs")
    links = stored(_verified(stored(_near_pairs(sized, sketches), "near-pairs"), source), "links")
    # rows with equal sets or equal ids are linked from the start
    equal = whole.join(nodes, ["n_shingles", "h1", "h2"]).where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    edges = stored(links.union(equal), "links-and-copies")
    reached = stored(components(edges), "components")
    grouped = members.join(reached.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = grouped.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    rest = grouped.join(mixed, "key").dropDuplicates(["key", "id"])
    untried = stored(_rest_pairs(rest.join(sketches, "id")), "rest")
    if untried.take(1):
        more = stored(_verified(untried, source), "more-links")
        if more.take(1):
            reached = stored(components(edges.union(more)), "components")
    return (
        base.join(reached.withColumnRenamed("node", "id"), "id", "left")
        .select(F.col("id").alias(id_column), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    )
