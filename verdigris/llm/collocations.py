"""Collocations by language: phrases counted by a multikey three-way quicksort of suffix pointers.

A suffix is a place in a piece with the words that follow, up to the longest phrase. Suffixes are sent to
tasks by their leading words, so that the parts of a task's sort that are equal to some depth are all the
places of a phrase, and their sizes its count; parts with fewer places than a candidate needs are left
unsorted. Counts of leading words, taken first, keep suffixes at home that can't be candidates and
split the leading words that are in too many places for one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.shared import stored
from verdigris.llm.words import constants, mix

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
SHARE = 80
REPORTED = 2000
#: Bytes of text that a task looks at together, but for longer texts.
PART_BYTES = 2_000_000
#: Suffixes in one task's sort, about.
TASK_SUFFIXES = 1_000_000
#: Leading words whose suffixes are split over tasks, at most: the most frequent ones, 16 bytes each.
MOST_SPLIT = 1 << 20
#: Bits of the map of frequent leading words at most: 8 MB.
MOST_BITS = 1 << 26

_TABLE = bytearray(range(256))
for _byte in range(65, 91):
    _TABLE[_byte] = _byte + 32
for _byte in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_byte] = 10
_TABLE[9] = 32
_CHANGED = bytes(_TABLE)
_TURNS = constants(LONGEST, 11)


class Places:
    """The words of some texts of one language: ``ids`` into ``words`` in order, -1 between pieces."""

    def __init__(self, lang: str, texts: list[bytes]) -> None:
        data = b"\n".join(texts).translate(_CHANGED).replace(b"\n", b" \n ")
        whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], dtype="<i8")), pa.py_buffer(data))
        coded = pc.split_pattern(whole, " ").flatten().dictionary_encode()
        self.lang, self.words = lang, coded.dictionary.cast(pa.large_string())
        names = self.words.to_pylist()
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        no_word, between = (names.index(x) if x in names else -2 for x in ("", "\n"))
        ids = ids[ids != no_word]
        self.ids = np.where(ids == between, -1, ids)
        seed = xxhash.xxh64_intdigest(lang.encode())
        # the last one stands for no word
        self.hashes = np.array([*(xxhash.xxh64_intdigest(w.encode(), seed) for w in names), 0], dtype=np.uint64)

    def leading(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with a word behind them in their piece, and a hash of the two words."""
        at = np.flatnonzero((self.ids[:-1] >= 0) & (self.ids[1:] >= 0))
        return at, mix(self.hashes[self.ids[at]] * _TURNS[0] + self.hashes[self.ids[at + 1]] * _TURNS[1])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[Places]:
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            held.setdefault(lang, []).append(data)
            size += len(data) + 1
            if size >= PART_BYTES:
                yield from (Places(lang, texts) for lang, texts in held.items())
                held, size = {}, 0
    yield from (Places(lang, texts) for lang, texts in held.items())


def _counted(texts: DataFrame) -> DataFrame:
    """(lang, word, key, n): places of each word, of each hash of two words (word null), and of all words (both null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _places(batches):
            ids = places.ids[places.ids >= 0]
            counts = np.bincount(ids, minlength=len(places.words))
            used = np.flatnonzero(counts)
            keys, pairs = np.unique(places.leading()[1], return_counts=True)
            none = np.full(len(keys) + 1, -1)
            words = places.words.take(pa.array(np.concatenate([used, none]), mask=np.concatenate([used, none]) < 0))
            keyed = np.concatenate([np.zeros(len(used) + 1, dtype=np.uint64), keys]).view(np.int64)
            no_key = np.arange(len(keyed)) <= len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array([places.lang] * len(keyed)), words.cast(pa.string()), pa.array(keyed, mask=no_key), pa.array(np.concatenate([counts[used], [len(ids)], pairs]))],
                names=["lang", "word", "key", "n"],
            )

    return texts.mapInArrow(run, "lang string, word string, key long, n long").groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _key_filter(keys: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test that holds for all hashes of the column ``key``, and a few others, the more the more there are: these cost time only."""
    bits = 1 << 16
    wanted = 32 * keys.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    place = F.pmod(F.col("key"), F.lit(bits))
    found = keys.select(place.alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v")).toArrow()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[found.column("w").to_numpy()] = found.column("v").to_numpy()
    sent = keys.sparkSession.sparkContext.broadcast(table)

    def test(hashes: np.ndarray) -> np.ndarray:
        at = np.mod(hashes.view(np.int64), bits)
        return ((sent.value[at // 64] >> (at % 64)) & 1) == 1

    return test


def _suffixes(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, n, route, split): words from each place on, as far as each two in a row may be frequent, equal ones of a part together.

    ``route`` goes by the first two words, and in ``split`` ones by all.
    """
    test = _key_filter(frequent)
    hot = frequent.where(F.col("n") > TASK_SUFFIXES // 4).orderBy(F.desc("n"), "key").limit(MOST_SPLIT).select("key", F.ceil(F.col("n") / (TASK_SUFFIXES // 4)).alias("salts")).toArrow()
    order = np.argsort(hot.column("key").to_numpy())
    sent = texts.sparkSession.sparkContext.broadcast((hot.column("key").to_numpy()[order], hot.column("salts").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_keys, salts = sent.value
        for places in _places(batches):
            at, keys = places.leading()
            passed = test(keys)
            at, keys = at[passed], keys[passed]
            if not len(at):
                continue
            goes_on = np.zeros(len(places.ids) + LONGEST, dtype=bool)
            goes_on[at] = True
            ids = np.concatenate([places.ids, np.full(LONGEST, -1)])
            columns, follows = [ids[at], ids[at + 1]], np.ones(len(at), dtype=bool)
            for depth in range(2, LONGEST):
                follows = follows & goes_on[at + depth - 1]
                columns.append(np.where(follows, ids[at + depth], -1))
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.ones(len(order), dtype=bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(order)))
            columns, route = [c[first] for c in columns], keys[order][first]
            split = np.zeros(len(first), dtype=bool)
            if len(hot_keys):
                found = np.minimum(np.searchsorted(hot_keys, route.view(np.int64)), len(hot_keys) - 1)
                split = hot_keys[found] == route.view(np.int64)
                rest = sum((places.hashes[c] * t for c, t in zip(columns[2:], _TURNS[2:])), np.zeros(len(first), dtype=np.uint64))
                salted = mix(route + np.uint64(1) + mix(rest) % salts[found].astype(np.uint64))
                route = np.where(split, salted, route)
            words = [places.words.take(pa.array(c, mask=c < 0)) for c in columns]
            phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()), null_handling="skip")
            yield pa.RecordBatch.from_arrays(
                [pa.array([places.lang] * len(first)), phrase.cast(pa.string()), pa.array(counts.astype(np.int64)), pa.array(route.view(np.int64)), pa.array(split)],
                names=["lang", "phrase", "n", "route", "split"],
            )

    return texts.mapInArrow(run, "lang string, phrase string, n long, route long, split boolean")


def sorted_parts(symbols: np.ndarray, weights: np.ndarray, least: list[int]) -> list[tuple[int, int, int]]:
    """(row, depth, count) of each part of rows that are equal in their first ``depth`` symbols, if they weigh ``least[depth - 1]``.

    A three-way quicksort by the symbol at a depth; the equal part goes on with the next one. 0 ends a row. Parts that
    weigh less than any part of them must are left as they are.
    """
    pointers, out = np.arange(len(symbols)), []
    todo = [(0, len(symbols), 0)]
    depths = symbols.shape[1]
    while todo:
        low, high, depth = todo.pop()
        part = pointers[low:high]
        own = symbols[part, depth]
        half = len(part) // 2
        pivot = np.partition(own, half)[half]
        less, more = own < pivot, own > pivot
        same = ~(less | more)
        part_less, part_same, part_more = part[less], part[same], part[more]
        pointers[low:high] = np.concatenate((part_less, part_same, part_more))
        a, b = low + len(part_less), high - len(part_more)
        needed = least[depth]
        if a > low and weights[part_less].sum() >= needed:
            todo.append((low, a, depth))
        if high > b and weights[part_more].sum() >= needed:
            todo.append((b, high, depth))
        count = int(weights[part_same].sum())
        if pivot and count >= needed:
            out.append((int(part_same[0]), depth + 1, count))
            if depth + 1 < depths:
                todo.append((a, b, depth + 1))
    return out


def _phrases(suffixes: DataFrame, tasks: int) -> DataFrame:
    """(lang, phrase, size, f): phrases of two words and more in LEAST places, from one sort in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=schema)
        if not table.num_rows:
            return
        lists = pc.split_pattern(table.column("phrase").combine_chunks().cast(pa.large_string()), " ")
        sizes = pc.list_value_length(lists).to_numpy()
        words = lists.flatten().dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        symbols = np.zeros((len(lists), LONGEST), dtype=np.int64)
        rows = np.repeat(np.arange(len(lists)), sizes)
        starts = np.cumsum(sizes) - sizes
        symbols[rows, np.arange(len(rows)) - starts[rows]] = words.indices.to_numpy() + 1
        own = symbols.copy()
        symbols[:, 0] += langs.indices.to_numpy().astype(np.int64) * (len(words.dictionary) + 1)
        weights, split = table.column("n").to_numpy(), table.column("split").to_numpy()
        # of leading words that are split, a task has all places of the longest phrases only
        for chosen, least in ((~split, [LEAST] * LONGEST), (split, [1] * (LONGEST - 1) + [LEAST])):
            at = np.flatnonzero(chosen)
            if not len(at):
                continue
            found = [p for p in sorted_parts(symbols[at], weights[at], least) if p[1] > 1]
            if not found:
                continue
            row, depth, count = (np.array(x) for x in zip(*found))
            row = at[row]
            cut = [words.dictionary.take(pa.array(np.maximum(own[row, k] - 1, 0), mask=depth <= k)) for k in range(LONGEST)]
            phrase = pc.binary_join_element_wise(*cut, pa.scalar(" ", pa.large_string()), null_handling="skip")
            lang = langs.dictionary.take(pa.array(langs.indices.to_numpy()[row]))
            yield pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(depth.astype(np.int32)), pa.array(count.astype(np.int64))], names=["lang", "phrase", "size", "f"])

    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()), ("split", pa.bool_())])
    routed = suffixes.repartition(tasks, "route").select("lang", "phrase", "n", "split")
    found = routed.mapInArrow(run, "lang string, phrase string, size int, f long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST)


def collocations(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the REPORTED best phrases of each language.

    Texts without a language are of `und`, null and empty ones have no words, and a language without candidates
    (an empty table too) gives no rows. Ties go by count and then by phrase, repeated rows count each time, other columns are
    not read. A text is taken whole; texts are looked at PART_BYTES together.

    Words and hashes of two words are counted first. Then suffixes go to tasks by their leading words; those
    that would be too many for a task are dealt by all their words, and their counts added up after.
    """
    texts = docs.select(F.coalesce(docs[lang_column].cast("string"), F.lit("und")).alias("lang"), docs[text_column].cast("string").alias("text"))
    counted = stored(_counted(texts).where((F.col("n") >= LEAST) | (F.col("word").isNull() & F.col("key").isNull())), "leading-words")
    totals = counted.where("word IS NULL AND key IS NULL").select("lang", F.col("n"))
    pairs = counted.where("key IS NOT NULL").select("key", "n")
    places = pairs.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(places) // TASK_SUFFIXES))
    long = stored(_phrases(_suffixes(texts, pairs), tasks), "phrases")
    known = long.select("lang", "phrase", "f").union(counted.where("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), F.col("n").alias("f")))
    return _reported(long, known, totals)


def _reported(long: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    words = F.split("phrase", " ")

    def part(start: Column, size: Column) -> Column:
        return F.array_join(F.slice(words, start, size), " ")

    cuts = long.select("lang", "phrase", "size", "f", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    score = F.expr(f"(cast(a as decimal(28,0)) * {SCALE}BD) div (cast(l as decimal(28,0)) + cast(r as decimal(28,0)))")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # phrases inside longer ones, with the most that a longer one has
    spans = F.expr("flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> struct(i as i, s as s))))")
    inner = long.where("size > 2").select("lang", "phrase", "f", F.explode(spans).alias("at")).select("lang", part(F.col("at.i"), F.col("at.s")).alias("phrase"), "f")
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where("longest IS NULL OR cast(longest as decimal(28,0)) * 100 < cast(a as decimal(28,0)) * 80".replace("80", str(SHARE)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each of some parts of a language gives its best ones, and these meet
    dealt = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).where(F.col("_rank") <= REPORTED)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= REPORTED)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrases AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM places, (SELECT unnest([1, 2, 3, 4]) AS size) s WHERE i + size - 1 <= len(w) GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM phrases WHERE size > 1 AND f >= 30),
cuts AS (
    SELECT lang, phrase, f, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM candidates
),
scored AS (
    SELECT c.lang, c.phrase, c.f AS a, k, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.f) // (h.f + t.f) AS BIGINT) AS score
    FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = array_to_string(w[1:k], ' ')
    JOIN phrases t ON t.lang = c.lang AND t.phrase = array_to_string(w[k + 1:], ' ')
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
    SELECT lang, f, string_split(phrase, ' ') AS w, size, s, unnest(range(1, size - s + 2)) AS i
    FROM candidates, (SELECT unnest([2, 3]) AS s) z WHERE s < size
),
longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longest FROM inner_parts GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
WHERE longest IS NULL OR 100 * CAST(longest AS HUGEINT) < 80 * CAST(a AS HUGEINT)
QUALIFY rank <= 2000
"""
