"""Benchmark decontamination by winnowed word k-grams, extended to shared spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.words import NOT_WORD, Hasher, ngrams, slices, utf8, window_minima

#: Words of a window, and of the k-grams that are winnowed: each window holds
#: WINDOW - GRAM + 1 k-grams, the smallest hash of which is a fingerprint of any text with that window.
WINDOW = 13
GRAM = 6
#: Bytes of benchmark text in one block; each block is sent to all tasks.
BLOCK_BYTES = 8_000_000


@dataclass
class Block:
    """Fingerprints of some benchmark items; all arrays are parallel or sorted as said."""

    names: list[str]
    words: np.ndarray  # hashes of the words of all items of WINDOW words or more, one after the other
    ends: np.ndarray  # for each of those words, where its item ends
    starts: np.ndarray  # and where it starts
    prints: np.ndarray  # sorted fingerprint hashes
    places: np.ndarray  # and the word where each begins
    owner: np.ndarray  # and its item
    short: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # by words: sorted hashes, items


def build_block(items: list[tuple[str, str | None]]) -> Block:
    hasher = Hasher(NOT_WORD, lower=True)
    hashes, cuts = hasher.words([utf8(text) for _, text in items])
    kept, starts, ends, prints, places, owner = [], [], [], [], [], []
    short: dict[int, list[tuple[int, int]]] = {}
    at = 0
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        own = hashes[a:b]
        if not len(own):
            continue
        if len(own) < WINDOW:
            short.setdefault(len(own), []).append((int(ngrams(own, len(own))[0]), i))
            continue
        grams = ngrams(own, GRAM)
        chosen = np.unique(window_minima(grams, WINDOW - GRAM + 1))
        prints.append(grams[chosen])
        places.append(chosen + at)
        owner.append(np.full(len(chosen), i))
        kept.append(own)
        starts.append(np.full(len(own), at))
        ends.append(np.full(len(own), at + len(own)))
        at += len(own)

    def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty(0, dtype=kind)

    values = joined(prints, np.uint64)
    order = np.argsort(values, kind="stable")
    small = {}
    for size, pairs in short.items():
        pairs.sort()
        small[size] = np.array([h for h, _ in pairs], dtype=np.uint64), np.array([i for _, i in pairs])
    return Block(
        [name for name, _ in items],
        joined(kept, np.uint64),
        joined(ends, np.int64),
        joined(starts, np.int64),
        values[order],
        joined(places, np.int64)[order],
        joined(owner, np.int64)[order],
        small,
    )


def _pairs(sorted_values: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probe, entry) for every entry of the sorted values that equals a probe."""
    low = np.searchsorted(sorted_values, probes, side="left")
    # most probes equal nothing: the end of a run is looked up for the others only
    hit = np.flatnonzero(sorted_values[np.minimum(low, len(sorted_values) - 1)] == probes) if len(sorted_values) else np.empty(0, int)
    low = low[hit]
    count = np.searchsorted(sorted_values, probes[hit], side="right") - low
    entry = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return np.repeat(hit, count), entry


def find_spans(hashes: np.ndarray, cuts: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared spans in texts given as word hashes: (first word, end, item), not merged."""
    sizes = np.diff(cuts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    found = []
    if len(block.prints) and len(hashes) >= WINDOW:
        grams = ngrams(hashes, GRAM)
        minima = window_minima(grams, WINDOW - GRAM + 1)
        whole = text[: len(minima)] == text[WINDOW - 1 :]
        marked = np.zeros(len(grams), dtype=bool)
        marked[minima[whole]] = True
        places = np.flatnonzero(marked)
        probe, entry = _pairs(block.prints, grams[places])
        p, q = places[probe], block.places[entry]
        low, high = cuts[text[p]], cuts[text[p] + 1]
        left, right = np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64)
        on = np.ones(len(p), dtype=bool)
        for _ in range(WINDOW):
            on &= (p + right < high) & (q + right < block.ends[q])
            at = np.flatnonzero(on)
            on[at] = hashes[p[at] + right[at]] == block.words[q[at] + right[at]]
            right[on] += 1
        on = np.ones(len(p), dtype=bool)
        for _ in range(WINDOW - 1):
            on &= (p - left > low) & (q - left > block.starts[q])
            at = np.flatnonzero(on)
            on[at] = hashes[p[at] - left[at] - 1] == block.words[q[at] - left[at] - 1]
            left[on] += 1
        long = left + right >= WINDOW
        found.append((p[long] - left[long], p[long] + right[long], block.owner[entry[long]]))
    for size, (values, items) in block.short.items():
        if len(hashes) < size:
            continue
        probe, entry = _pairs(values, ngrams(hashes, size))
        inside = text[probe] == text[probe + size - 1]
        found.append((probe[inside], probe[inside] + size, items[entry[inside]]))
    if not found:
        return (np.empty(0, dtype=np.int64),) * 3
    first, end, item = (np.concatenate(c) for c in zip(*found))
    return first, end, item


def _lists(values: list, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _pass(rows: DataFrame, block, text_column: str, number: int, keep_text: bool) -> DataFrame:
    """``rows`` and what the block has in common with their texts, in columns of this pass's number."""
    kept = [f for f in rows.schema.fields if keep_text or f.name != text_column]
    names = [f.name for f in kept] + [f"_{c}{number}" for c in ("words", "firsts", "ends", "items")]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + [f"_words{number} long, _firsts{number} array<long>, _ends{number} array<long>, _items{number} array<string>"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(NOT_WORD, lower=True)
        for batch, texts in slices(batches, text_column):
            hashes, cuts = hasher.words(texts)
            n = len(texts)
            first, end, item = find_spans(hashes, cuts, block.value)
            owner = np.searchsorted(cuts, first, side="right") - 1
            change = np.bincount(first, minlength=len(hashes) + 1) - np.bincount(end, minlength=len(hashes) + 1)
            covered = np.cumsum(change)[: len(hashes)] > 0
            # runs of covered words, cut where a text begins
            begins = np.zeros(len(hashes) + 1, dtype=bool)
            begins[cuts[:-1]] = True
            before = np.concatenate(([False], covered[:-1])) if len(hashes) else covered
            opens = np.flatnonzero(covered & (~before | begins[: len(hashes)]))
            after = np.concatenate((covered[1:], [False])) if len(hashes) else covered
            closes = np.flatnonzero(covered & (~after | begins[1:])) + 1
            whose = np.searchsorted(cuts, opens, side="right") - 1
            pairs = np.unique(np.stack([owner, item], axis=1), axis=0) if len(owner) else np.empty((0, 2), dtype=np.int64)
            found = [block.value.names[i] for i in pairs[:, 1]]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [
                pa.array(np.diff(cuts), pa.int64()),
                _lists(opens - cuts[whose], whose, n, pa.int64()),
                _lists(closes - cuts[whose], whose, n, pa.int64()),
                _lists(found, pairs[:, 0], n, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated; columns of these names are replaced.

    A window is 13 consecutive item words; an item of fewer is one window. Fingerprints are
    the smallest 6-gram hash of each 13 words, so that texts with a common window have a common fingerprint;
    equal fingerprints are extended word by word (by 64-bit word hashes) to the shared span.

    The benchmark is cut into blocks of about ``block_bytes`` of text by a hash of the row; each
    block is broadcast, whatever the size of the whole, and meets every row in a step of
    its own. Nothing is shuffled.

    Null or empty texts have no words and no hits; null ids and repeated rows stay. An item without words can't occur,
    one with a null id is called ``null``. Empty tables: no documents give no rows, no benchmark no hits.
    """
    spark = docs.sparkSession
    results = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    rows = docs.drop(*(c for c in results if c != text_column))
    own = [c for c in rows.columns if keep_text or c != text_column]
    items = benchmark.select(F.coalesce(benchmark[item_column].cast("string"), F.lit("null")).alias("name"), benchmark[item_text_column].alias("body"))
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    number = F.pmod(F.xxhash64("name", "body"), F.lit(blocks))
    for b in range(blocks):
        part = items.where(number == b).collect()  # one block
        block = spark.sparkContext.broadcast(build_block([(r.name, r.body) for r in part]))
        rows = _pass(rows, block, text_column, b, keep_text or b < blocks - 1)
    every = [F.concat(*[F.col(f"_{c}{b}") for b in range(blocks)]) for c in ("firsts", "ends", "items")]
    spans = rows.select(*[F.col(f"`{c}`") for c in own], F.col("_words0").alias("n_words"), *[e.alias(a) for e, a in zip(every, ("_firsts", "_ends", "_items"))])
    nothing = F.lit(0).cast("long")
    united = F.aggregate(
        F.array_sort(F.arrays_zip("_firsts", "_ends")),
        F.struct(nothing.alias("total"), nothing.alias("until")),
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(nothing, s["_ends"] - F.greatest(s["_firsts"], acc["until"]))).alias("total"),
            F.greatest(acc["until"], s["_ends"]).alias("until"),
        ),
        lambda acc: acc["total"],
    )
    names = F.array_sort(F.array_distinct("_items"))
    return (
        spans.withColumn("n_hit", united)
        .withColumn("n_items", F.size(names).cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(names, ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("_firsts", "_ends", "_items")
    )


def winnow(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: the id and what ``mark_contamination`` finds."""
    narrow = docs.select(docs[id_column], docs[text_column].alias("_text"))
    return mark_contamination(narrow, benchmark, "_text", block_bytes=block_bytes, keep_text=False)
