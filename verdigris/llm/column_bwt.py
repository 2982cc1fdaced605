"""Byte-wise substring de-duplication by a column-wise Burrows-Wheeler transform of many strings.

One symbol of every string is inserted each round, from the last to the first: the last-to-first mapping of the
transform so far tells each new suffix its place, and range minima of the common prefixes so far its common prefix with
its neighbours. Transform and prefixes are rewritten in one sequential pass a round (Bauer, Cox, Rosone;
Cox, Garofalo, Rosone, Sciortino). As many rounds as the longest string has bytes: so not documents are inserted, but
the stretches of them that can hold a repeat.

These are found by anchors: of the ANCHOR-byte strings in a window of WINDOW bytes, that with the smallest hash. Equal
windows have equal anchors. Consecutive windows with one anchor make a stretch of 100 to 163 bytes; stretches whose anchor
no other has are unique, and the others meet in a task by anchor. The transform of such a task's stretches has equal windows
side by side, with a common prefix of a window or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.llm.shared import MOST_BITS, stored, where_listed
from verdigris.llm.words import constants, mix, slices

WINDOW = 100
ANCHOR = 37
#: Windows in one stretch at most: places of an anchor in a window, one bit of a mask each.
PLACES = WINDOW - ANCHOR + 1
#: Bytes beside an anchor that a window has on one side at least.
HALF = (WINDOW - ANCHOR + 1) // 2
#: Bytes of text hashed together; a longer text is looked at in parts that overlap.
PART_BYTES = 1 << 18
#: Stretches in one transform, about.
TOGETHER = 1500
#: Different stretches of one anchor at most; those of a more frequent one are taken window by window.
MOST_STRETCHES = 16384

_LOW = np.uint64(PLACES - 1)
_VALUES = constants(256, 21)
_BASE = int(constants(1, 22)[0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class Stretches:
    """The stretches of some texts: text, first window, number of windows, anchor and its offset, hash of the bytes, whether an anchor is there twice."""

    up = down = np.empty(0, dtype=np.uint64)

    def __init__(self, parts: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(p for _, _, p in parts), dtype=np.uint8)
        size = len(data)
        if size + 1 > len(Stretches.up):
            Stretches.up, Stretches.down = _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1)
        self.data = data
        self.total = np.zeros(size + 1, dtype=np.uint64)
        values = _VALUES[data]
        values *= self.up[:size]
        np.cumsum(values, out=self.total[1:])
        hashes = self.total[ANCHOR:] - self.total[:-ANCHOR]
        hashes *= self.down[: len(hashes)]
        hashes = mix(hashes)
        hashes &= ~_LOW
        place = np.arange(len(hashes), dtype=np.uint64) & _LOW
        least = self._least(hashes | place)
        # another order of places: where it finds another one, the least hash is there twice
        other = self._least(hashes | (_LOW - place))
        found = (least & _LOW).astype(np.uint8)
        twice = found != (_LOW - (other & _LOW)).astype(np.uint8)
        # the anchor's place in each window
        offset = (found - place[: len(least)].astype(np.uint8)) & np.uint8(PLACES - 1)
        lengths = np.array([len(p) for _, _, p in parts])
        ends = np.cumsum(lengths)
        inside = np.ones(len(least), dtype=bool)
        for end in ends[:-1].tolist():
            inside[max(0, end - WINDOW + 1) : end] = False
        new = np.ones(len(least), dtype=bool)
        new[1:] = (offset[1:] + np.uint8(1) != offset[:-1]) | (inside[1:] != inside[:-1])
        runs = np.flatnonzero(new)
        windows = np.diff(np.append(runs, len(least)))
        twice = np.logical_or.reduceat(twice, runs)
        on = inside[runs]
        self.first, self.windows, self.twice = runs[on], windows[on], twice[on]
        self.anchor, self.offset = least[self.first] >> np.uint64(6), offset[self.first]
        self.sum = self._hash(self.first, self.windows + WINDOW - 1)
        part = np.searchsorted(ends, self.first, side="right")
        self.text = np.array([t for t, _, _ in parts])[part]
        self.start = self.first - (ends - lengths)[part] + np.array([o for _, o, _ in parts])[part]

    def _hash(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.total[first + size] - self.total[first]) * self.down[first] + np.asarray(size).astype(np.uint64) * np.uint64(_BASE))

    @staticmethod
    def _least(values: np.ndarray) -> np.ndarray:
        step = 1
        while step < PLACES:
            values = np.minimum(values[:-step], values[step:])
            step *= 2
        return values

    def bytes(self, i: int) -> bytes:
        return self.data[self.first[i] : self.first[i] + self.windows[i] + WINDOW - 1].tobytes()


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, bytes) to look at together; every window is in one of them."""
    held, size = [], 0
    step = PART_BYTES // 2
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - WINDOW + 1), step):
            part = text[offset : offset + step + WINDOW - 1]
            if len(part) < WINDOW:
                continue
            held.append((number, offset, part))
            size += len(part)
            if size >= PART_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _bit_filter(spark: SparkSession, places: DataFrame, count: int) -> Callable[[np.ndarray], np.ndarray]:
    """A test for hashes: true for all of the column ``p``, and a few others, the more of them the more there are."""
    bits = 1 << 16
    while bits < min(32 * count, MOST_BITS):
        bits *= 2
    words = places.select(F.pmod("p", F.lit(bits)).alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v")).toArrow()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[found.column("w").to_numpy()] = found.column("v").to_numpy()
    sent = spark.sparkContext.broadcast(table)

    def test(hashes: np.ndarray) -> np.ndarray:
        at = np.mod(hashes.view(np.int64), bits)
        return ((sent.value[at // 64] >> (at % 64)) & 1) == 1

    return test


def _repeated_anchors(source: DataFrame) -> DataFrame:
    """(p): 32 bits of each anchor that two stretches have, or one twice; a few others have the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            for parts in _parts(texts):
                made = Stretches(parts)
                bits, counts = np.unique((made.anchor & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
                twice = np.isin(bits, (made.anchor[made.twice] & np.uint64(0xFFFFFFFF)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(bits), pa.array(np.minimum(counts + twice, 2).astype(np.int32))], names=["p", "n"])

    return source.select("text").mapInArrow(run, "p long, n int").groupBy("p").agg(F.sum("n").alias("n")).where("n > 1").select("p")


PLACED = "anchor long, sum long, id long, text_key long, start long, windows int, twice boolean"


def _placed(source: DataFrame, test: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(anchor, sum, id, text_key, start, windows, twice) of stretches whose anchor's 32 bits pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for parts in _parts(texts):
                made = Stretches(parts)
                on = np.flatnonzero(test(made.anchor & np.uint64(0xFFFFFFFF)))
                text = made.text[on]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.anchor[on].view(np.int64)), pa.array(made.sum[on].view(np.int64)), pa.array(ids[text]), pa.array(keys[text]), pa.array(made.start[on]), pa.array(made.windows[on].astype(np.int32)), pa.array(made.twice[on])],
                    names=["anchor", "sum", "id", "text_key", "start", "windows", "twice"],
                )

    return source.mapInArrow(run, PLACED)


def _single_windows(source: DataFrame, test: Callable[[np.ndarray], np.ndarray], passed: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """As ``_placed``, the windows of stretches with a frequent anchor, each its own stretch and by its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for parts in _parts(texts):
                made = Stretches(parts)
                on = np.flatnonzero(test(made.anchor & np.uint64(0xFFFFFFFF)) & passed(made.anchor))
                own = made.windows[on]
                extra = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
                text, first = np.repeat(made.text[on], own), np.repeat(made.first[on], own) + extra
                sums = made._hash(first, WINDOW)
                one = np.ones(len(first), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(sums ^ np.uint64(_BASE)).view(np.int64)), pa.array(sums.view(np.int64)), pa.array(ids[text]), pa.array(keys[text]), pa.array(np.repeat(made.start[on], own) + extra), pa.array(one), pa.array(one == 0)],
                    names=["anchor", "sum", "id", "text_key", "start", "windows", "twice"],
                )

    return source.mapInArrow(run, PLACED)


def _mark(anchor: np.ndarray, total: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(mix(mix(anchor + total) + ids.view(np.uint64)) + start.astype(np.uint64))


def _marks(firsts: DataFrame) -> DataFrame:
    """(p): hashes of the first places of stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, total, ids, start = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(_mark(anchor.view(np.uint64), total.view(np.uint64), ids, start).view(np.int64))], names=["p"])

    return firsts.select("anchor", "sum", "id", "start").mapInArrow(run, "p long")


STRETCHES = "anchor long, sum long, id long, start long, offset int, twice boolean, body binary"


def _bodies(source: DataFrame, test: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Bytes of the stretches that the filter of first places lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids = batch.column(0).to_numpy()
            for parts in _parts(texts):
                made = Stretches(parts)
                on = np.flatnonzero(test(_mark(made.anchor, made.sum, ids[made.text], made.start)))
                bodies = pa.array([made.bytes(i) for i in on], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made.anchor[on].view(np.int64)), pa.array(made.sum[on].view(np.int64)), pa.array(ids[made.text[on]]), pa.array(made.start[on]), pa.array(made.offset[on].astype(np.int32)), pa.array(made.twice[on]), bodies],
                    names=["anchor", "sum", "id", "start", "offset", "twice", "body"],
                )

    return source.mapInArrow(run, STRETCHES)


class Transform:
    """Burrows-Wheeler transform and common prefixes of a collection, made column by column.

    ``symbols``: the symbol before each suffix, 0 before a whole string. ``common``: symbols that a suffix shares with
    the one above it. ``strings`` are arrays of symbols from 1 to 255, of at most 254 each.
    """

    def __init__(self, strings: list[np.ndarray]) -> None:
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        n = len(strings)
        width = int(self.lengths.max(initial=0))
        columns = np.zeros((width + 1, n), dtype=np.uint8)
        for i, s in enumerate(strings):
            columns[: len(s), i] = s[::-1]
        self.symbols = columns[0].copy()
        self.common = np.zeros(n, dtype=np.uint8)
        active = np.flatnonzero(self.lengths)
        place = active
        for size in range(1, width + 1):
            place = self._insert(place, columns[size, active], n)
            on = self.lengths[active] > size
            place, active = place[on], active[on]

    def _order(self) -> tuple[np.ndarray, np.ndarray]:
        """Places by the symbol before their suffix, and each one's rank: with the symbol in front, that is the order of the suffixes."""
        order = np.argsort(self.symbols, kind="stable")
        # nothing stands before whole strings, and no suffix comes of them
        order = order[np.count_nonzero(self.symbols == 0) :]
        rank = np.empty(len(self.symbols), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return order, rank

    def _insert(self, place: np.ndarray, following: np.ndarray, n: int) -> np.ndarray:
        """Extends the suffixes at ``place`` by the symbols before them; returns the places of the new ones."""
        symbols, common = self.symbols, self.common
        size = len(symbols)
        order, rank = self._order()
        own = rank[place].astype(np.int64)
        # the n empty suffixes come first
        new = n + own
        above, below = np.split(self._shared(order, np.concatenate([own, own + 1])), 2)
        kept = np.ones(size + len(place), dtype=bool)
        kept[new] = False
        for name, old, inserted in (("symbols", symbols, following), ("common", common, above)):
            wide = np.empty(len(kept), dtype=np.uint8)
            wide[kept] = old
            wide[new] = inserted
            setattr(self, name, wide)
        # the suffix after a new one has a new neighbour
        inside = new + 1 < len(kept)
        self.common[new[inside] + 1] = below[inside]
        return new

    def _shared(self, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Symbols shared by the extended suffixes of these ranks with those above them.

        That is one more than the least common prefix between their places: the lesser of two overlapping stretches of 1, 2, 4, ...
        entries, whose minima are made as far as they are asked for.
        """
        out = np.zeros(len(rank), dtype=np.uint8)
        there = np.flatnonzero((rank > 0) & (rank < len(order)))
        low, high = order[rank[there] - 1], order[rank[there]]
        same = self.symbols[low] == self.symbols[high]
        there, low, high = there[same], low[same] + 1, high[same]
        level = np.frexp((high - low + 1).astype(np.float32))[1] - 1
        size, levels = len(self.common), int(level.max(initial=0)) + 1
        minima = np.empty((levels, size), dtype=np.uint8)
        minima[0] = self.common
        for k in range(1, levels):
            half = 1 << (k - 1)
            np.minimum(minima[k - 1, : size - half], minima[k - 1, half:], out=minima[k, : size - half])
        flat = minima.ravel()
        row = level.astype(np.int64) * size
        out[there] = np.minimum(flat[row + low], flat[row + high + 1 - (1 << level)]) + np.uint8(1)
        return out

    def places(self, least: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, strings, places): where the suffixes of each size from ``least`` on stand, by steps of the last-to-first mapping."""
        n = len(self.lengths)
        _, rank = self._order()
        owner = np.arange(n)
        place = owner
        for size in range(int(self.lengths.max(initial=-1)) + 1):
            if size:
                on = self.lengths[owner] >= size
                owner, place = owner[on], place[on]
                place = n + rank[place]
            if size >= least:
                yield size, owner, place


#: Stands for the anchor in the transform; UTF-8 has no byte from 0xF8 on.
_ANCHOR_SYMBOL = 255
#: Symbols of a window with its anchor as one.
_SHORT = WINDOW - ANCHOR + 1


def repeated_windows(strings: list[bytes], offsets: np.ndarray, ids: np.ndarray, starts: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """A mask for each stretch: its windows, by bit, that are also somewhere before it by (id, start) of the window.

    ``offsets``: where the anchor stands in each. It is one symbol in the transform, as all windows of a stretch hold it; equal
    windows of unlike anchors are told apart after. A window that has its least hash ``twice`` may have either place as its anchor:
    stretches with such ones are compared as they are, too.
    """
    symbols = [np.frombuffer(string, dtype=np.uint8) + np.uint8(1) for string in strings]
    number: dict[bytes, int] = {}
    anchors = np.array([number.setdefault(string[at : at + ANCHOR], len(number)) for string, at in zip(strings, offsets.tolist())], dtype=np.int64)
    one = np.full(1, _ANCHOR_SYMBOL, dtype=np.uint8)
    short = [np.concatenate([x[:at], one, x[at + ANCHOR :]]) for x, at in zip(symbols, offsets.tolist())]
    masks = _later_windows(short, _SHORT, anchors, ids, starts)
    again = np.flatnonzero(twice)
    if len(again):
        masks[again] |= _later_windows([symbols[i] for i in again], WINDOW, np.zeros(len(again), dtype=np.int64), ids[again], starts[again])
    return masks


def _later_windows(strings: list[np.ndarray], least_common: int, kinds: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """As ``repeated_windows``, for strings of symbols whose windows have ``least_common`` of them; of strings of one kind."""
    made = Transform(strings)
    equal = made.common >= least_common
    grouped = equal.copy()
    grouped[:-1] |= equal[1:]
    runs = np.cumsum(~equal)
    parts = []
    for size, owner, place in made.places(least_common):
        on = grouped[place]
        owner = owner[on]
        parts.append((owner, made.lengths[owner] - size, runs[place[on]]))
    masks = np.zeros(len(strings), dtype=np.uint64)
    if not parts:
        return masks
    owner, offset, run = (np.concatenate(x) for x in zip(*parts))
    run = run * (int(kinds.max()) + 1) + kinds[owner]
    document, window = ids[owner], starts[owner] + offset
    order = np.lexsort((window, document, run))
    owner, offset, run, document, window = (x[order] for x in (owner, offset, run, document, window))
    least = np.ones(len(run), dtype=bool)
    least[1:] = run[1:] != run[:-1]
    head = np.maximum.accumulate(np.where(least, np.arange(len(run)), 0))
    later = (document != document[head]) | (window != window[head])
    np.bitwise_or.at(masks, owner[later], np.uint64(1) << offset[later].astype(np.uint64))
    return masks


def _may_share(rows: list[tuple]) -> list[tuple]:
    """Stretches that can have a window in common with another one.

    Beside its anchor a window has HALF bytes on one side at least: equal ones then share these with the anchor. Of a window that
    has its least hash twice the anchor may be either place, so stretches with such ones all stay.
    """
    sides: dict[tuple, int] = {}
    keys = []
    for row in rows:
        at, body = row[4], row[6]
        left = (row[0], body[at - HALF : at + ANCHOR]) if at >= HALF else None
        right = (row[0], body[at : at + ANCHOR + HALF], 1) if len(body) - at - ANCHOR >= HALF else None
        keys.append((left, right))
        for key in (left, right):
            if key is not None:
                sides[key] = sides.get(key, 0) + 1
    return [row for row, pair in zip(rows, keys) if row[5] or any(k is not None and sides[k] > 1 for k in pair)]


def _masks(bodies: DataFrame, tasks: int) -> DataFrame:
    """(anchor, sum, mask) of stretches with windows that are in an earlier one, or earlier in itself."""

    def solved(held: list[tuple]) -> pa.RecordBatch:
        # the filter may let a stretch through at a later place; repeated rows bring it twice
        best: dict[tuple[int, int], tuple] = {}
        for row in held:
            key = (row[0], row[1])
            if key not in best or (row[2], row[3]) < (best[key][2], best[key][3]):
                best[key] = row
        rows = _may_share(list(best.values()))
        masks = repeated_windows([r[6] for r in rows], *(np.array([r[k] for r in rows]) for k in (4, 2, 3, 5)))
        on = np.flatnonzero(masks)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in on], pa.int64()), pa.array([rows[i][1] for i in on], pa.int64()), pa.array(masks[on].view(np.int64))], names=["anchor", "sum", "mask"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= TOGETHER and row[0] != held[-1][0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    routed = bodies.repartition(tasks, "anchor").sortWithinPartitions("anchor")
    return routed.mapInArrow(run, "anchor long, sum long, mask long")


def _cut(marked: DataFrame) -> DataFrame:
    """(id, sha, n_removed, n_spans, kept_sha256, kept) from texts with their windows to remove."""
    names = ["id", "sha", "n_removed", "n_spans", "kept_sha256", "kept"]
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = []
            lists = batch.column(2)
            marks = lists.flatten()
            start, windows, mask = (marks.field(k) for k in range(3))
            whole, bits = mask.is_null().to_numpy(zero_copy_only=False), mask.fill_null(0).to_numpy()
            start, windows = start.to_numpy(), windows.to_numpy().astype(np.int64)
            cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            for number, data, low, high in zip(batch.column(0).to_pylist(), texts, cuts[:-1], cuts[1:]):
                first, every = start[low:high], whole[low:high]
                row, place = np.nonzero(np.unpackbits(bits[low:high].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                begins = np.concatenate([first[every], first[row] + place])
                ends = np.concatenate([first[every] + windows[low:high][every] + WINDOW - 1, first[row] + place + WINDOW])
                edges = np.bincount(begins, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
                gone = np.cumsum(edges)[:-1] > 0
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                rows.append((number, hashlib.sha256(data).hexdigest(), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return marked.mapInArrow(run, "id long, sha string, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (null where nothing was removed).

    Texts are UTF-8 bytes. Each byte in a WINDOW-byte string goes that also starts in a document with a smaller id, or
    earlier in the same one, overlaps included; strings are judged on the input. Ids are integers. Rows of one id are one document: of
    them only an earlier start counts, so repeated rows are all alike. A row without id is neither changed nor a source. Null,
    empty and short texts keep all they have; an empty table gives no rows; other columns are not read. A text of any length is
    hashed in parts.

    A document that has the text of a smaller one goes whole. Equal stretches are one in the search, told apart by 122
    bits of hashes, and only the first place of each is sent with its bytes; stretches of an anchor that has too many are taken
    window by window, so that equal ones meet in a count and not in a task. Texts with something to remove are shuffled once.
    """
    spark = docs.sparkSession
    text = docs[text_column].cast("string")
    source = docs.select(docs[id_column].cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    base = stored(source.select("id", "text_key", size.alias("n_bytes"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")), "measured")
    source = source.where(f"id IS NOT NULL AND octet_length(text) >= {WINDOW}")
    least = base.where(f"n_bytes >= {WINDOW} AND id IS NOT NULL").groupBy("sha").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    copies = base.where("id IS NOT NULL").join(least, "sha").where("id > least").select("id", "text_key", "sha").distinct()

    repeated = stored(_repeated_anchors(source), "anchors")
    test = _bit_filter(spark, repeated, repeated.count())
    placed = stored(_placed(source, test), "placed")
    firsts = stored(_first_places(placed), "firsts")
    spread = firsts.groupBy("anchor").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 OR twice").select("anchor", "n")
    spread = stored(spread, "spread")
    # by itself, so that its own size tells whether it can be sent to all tasks
    hot = stored(spread.where(F.col("n") > MOST_STRETCHES).select("anchor").coalesce(1), "frequent-anchors")
    hot_count = hot.count()
    if hot_count:
        passed = _bit_filter(spark, hot.select(F.col("anchor").alias("p")), hot_count)
        holders = where_listed(source, "id", placed.join(hot, "anchor", "left_semi").select("id").distinct())
        # of an anchor that the filter lets through in vain there are windows and stretches: both tell the same
        single = stored(_single_windows(holders, test, passed), "windows")
        placed = placed.join(hot, "anchor", "left_anti").unionByName(single)
        firsts = stored(firsts.join(hot, "anchor", "left_anti").unionByName(_first_places(single)), "firsts-again")
    # stretches that have something to be compared with
    met = stored(firsts.join(spread.where(F.col("n") <= MOST_STRETCHES), "anchor", "left_semi").select("anchor", "sum", "id", "start"), "met")
    number = met.count()
    bodies = _bodies(source.drop("text_key"), _bit_filter(spark, _marks(met), number))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-number // (20 * TOGETHER)))
    masks = _masks(bodies, tasks)
    decided = firsts.join(masks, ["anchor", "sum"], "left").select("anchor", "sum", F.col("id").alias("first_id"), F.col("start").alias("first_start"), "mask", "places").where("places > 1 OR mask IS NOT NULL")
    first = (F.col("id") == F.col("first_id")) & (F.col("start") == F.col("first_start"))
    marks = (
        placed.join(decided, ["anchor", "sum"])
        .where(~first | F.col("mask").isNotNull())
        .select("id", "text_key", F.struct("start", "windows", F.when(first, F.col("mask")).alias("mask")).alias("mark"))
        .join(copies, ["id", "text_key"], "left_anti")
        .groupBy("id", "text_key")
        .agg(F.collect_set("mark").alias("marks"))
    )
    marks = stored(marks, "marks")
    removed = where_listed(source, "id", marks.select("id").distinct()).join(marks, ["id", "text_key"]).select("id", "text", "marks")
    found = _cut(removed).dropDuplicates(["id", "sha"])
    nothing = hashlib.sha256(b"").hexdigest()
    whole = F.col("copy")
    zero = F.lit(0).cast("long")
    return (
        base.join(copies.select("id", "sha", F.lit(True).alias("copy")), ["id", "sha"], "left")
        .join(found, ["id", "sha"], "left")
        .select(
            F.col("id").alias(id_column),
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
            F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
            F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
            F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        )
    )


def _first_places(placed: DataFrame) -> DataFrame:
    """(anchor, sum, id, start, windows, twice, places): each different stretch, with its first place."""
    return (
        placed.groupBy("anchor", "sum")
        .agg(F.min(F.struct("id", "start")).alias("first"), F.first("windows").alias("windows"), F.max("twice").alias("twice"), F.count("*").alias("places"))
        .select("anchor", "sum", "first.id", "first.start", "windows", "twice", "places")
    )


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
windows AS (
    SELECT doc_id, p, md5(h[2 * p + 1 : 2 * p + 200]) AS g
    FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM d WHERE n >= 100)
),
later AS (SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
edges AS (SELECT doc_id, p, coalesce(p > lag(p) OVER w + 100, true) AS new FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM edges),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, k),
pieces AS (
    SELECT doc_id, a, b, h[2 * coalesce(lag(b) OVER w, 0) + 1 : 2 * a] AS before, h[2 * b + 1 :] AS rest,
        lead(a) OVER w IS NULL AS last
    FROM spans JOIN d USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY a)
),
cut AS (
    SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
        string_agg(before || CASE WHEN last THEN rest ELSE '' END, '' ORDER BY a) AS body
    FROM pieces GROUP BY doc_id
)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(body, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
