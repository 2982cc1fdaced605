"""Substring de-duplication: matching statistics of documents in suffix automata of reference shards.

Broadcasting automata of the whole corpus and streaming every document past each is quadratic, so the
shards are not sent to all documents. Hashes of all windows find, for each, the smallest document
that has it; the spans concerned then meet the automaton of just those documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm import dealing
from verdigris.llm.shared import stored, where_listed
from verdigris.llm.words import SPACES, Hasher, mix, ngrams, slices, utf8

WINDOW = 13
#: Window hashes in one bucket, about: what one task sorts.
BUCKET_KEYS = 4_000_000
#: Bytes of reference and of streamed words in one shard, about.
SHARD_BYTES = 4_000_000


class SuffixAutomaton:
    """Of several word sequences; each state knows the smallest source in which its sequences occur."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.source: list[int | None] = [None]

    def add(self, words: list[bytes], source: int) -> None:
        nxt, link, length, least = self.next, self.link, self.length, self.source
        last = 0
        for word in words:
            state = nxt[last].get(word)
            if state is not None and length[state] == length[last] + 1:
                last = state  # the sequence is there already
                if source < least[state]:
                    least[state] = source
                continue
            if state is not None:
                last = self._clone(last, state, word)
                if source < least[last]:
                    least[last] = source
                continue
            new = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            least.append(source)
            link.append(0)
            at = last
            while at != -1 and word not in nxt[at]:
                nxt[at][word] = new
                at = link[at]
            if at != -1:
                state = nxt[at][word]
                link[new] = state if length[state] == length[at] + 1 else self._clone(at, state, word)
            last = new

    def _clone(self, at: int, state: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[state]))
        length.append(length[at] + 1)
        link.append(link[state])
        self.source.append(self.source[state])
        link[state] = copy
        while at != -1 and nxt[at].get(word) == state:
            nxt[at][word] = copy
            at = link[at]
        return copy

    def finish(self) -> None:
        """Hands the smallest sources on to the suffixes; call once, after the last sequence."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            above = self.link[state]
            if above > 0 and self.source[state] < self.source[above]:
                self.source[above] = self.source[state]

    def spans(self, words: list[bytes], window: int, newest: int) -> list[tuple[int, int]]:
        """Maximal spans of words covered by windows that occur in a source up to ``newest``."""
        nxt, link, length, least = self.next, self.link, self.length, self.source
        out: list[list[int]] = []
        state, matched = 0, 0
        for end, word in enumerate(words, 1):
            while state and word not in nxt[state]:
                state = link[state]
                matched = length[state]
            step = nxt[state].get(word)
            if step is None:
                matched = 0
                continue
            state = step
            matched += 1
            if matched < window:
                continue
            holder = state
            while length[link[holder]] >= window:
                holder = link[holder]
            # longer matches are of no use: go on with the window alone
            state, matched = holder, window
            if least[holder] <= newest:
                if out and out[-1][1] >= end - window:
                    out[-1][1] = end
                else:
                    out.append([end - window, end])
        return [(a, b) for a, b in out]


def measured(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, n_words, sha): the checksum of all words joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            words = [t.split() for t in texts]
            sums = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(sums)], names=["id", "n_words", "sha"])

    return docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text")).mapInArrow(run, "id long, n_words long, sha string")


def _window_keys(source: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES, lower=False)
        for batch, texts in slices(batches):
            hashes, cuts = hasher.words(texts)
            if len(hashes) < WINDOW:
                continue
            owner = np.repeat(np.arange(len(texts)), np.diff(cuts))
            whole = owner[: len(owner) - WINDOW + 1] == owner[WINDOW - 1 :]
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield dealing.pack(ngrams(hashes, WINDOW)[whole], owner[: len(whole)][whole], ids, tags, n)

    return source.mapInArrow(run, dealing.SCHEMA)


def _first_sources(packed: DataFrame, n: int) -> DataFrame:
    """(id, marks, sources, repeats): windows that several texts have, with the smallest id that has each.

    ``repeats``: whether one of them is of another id. Packed by part of the ids, then one row for each id.
    """

    def parts_of(ids: np.ndarray) -> np.ndarray:
        return (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64)

    def search(table: pa.Table) -> pa.Table:
        keys, ids = dealing.shared_keys(*dealing.unpack(table))
        sources = ids[dealing.group_starts(keys)]
        marks = keys + (np.uint64(table.column("bucket")[0].as_py()) << np.uint64(8 * dealing.KEY_BYTES))
        rows = [(p, ids[at].tobytes(), marks[at].tobytes(), sources[at].tobytes()) for p, at in dealing.by_id(parts_of(ids))]
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "ids", "marks", "sources"])

    def gather(table: pa.Table) -> pa.Table:
        ids, marks, sources = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t) for c, t in (("ids", "<i8"), ("marks", "<u8"), ("sources", "<i8")))
        rows = [(i, marks[at].tobytes(), sources[at].tobytes(), bool((sources[at] != i).any())) for i, at in dealing.by_id(ids)]
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.bool_())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "marks", "sources", "repeats"])

    found = packed.groupBy("bucket").applyInArrow(search, "part int, ids binary, marks binary, sources binary")
    return found.groupBy("part").applyInArrow(gather, "id long, marks binary, sources binary, repeats boolean")


def _pieces(marked: DataFrame, n: int) -> DataFrame:
    """Spans of consecutive windows with one first source: (source, id, key, start, is_reference, words)."""
    names = ["source", "id", "text_key", "start", "reference", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(SPACES, lower=False)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(at, 256)
                rows: list[tuple] = []
                for number, key, text, mark, first_ids in zip(*(c.to_pylist() for c in batch.columns)):
                    data = utf8(text)
                    hashes, _ = hasher.words([data])
                    if len(hashes) < WINDOW:
                        continue
                    marks = dealing.marks_of(ngrams(hashes, WINDOW), n)
                    known, source = np.frombuffer(mark, dtype="<u8"), np.frombuffer(first_ids, dtype="<i8")
                    order = np.argsort(known)
                    known, source = known[order], source[order]
                    place = np.minimum(np.searchsorted(known, marks), len(known) - 1)
                    hit = known[place] == marks
                    where = np.where(hit, source[place], 0)
                    words = data.split()
                    edges = np.flatnonzero(np.diff(where, prepend=where[0] - 1) | np.diff(hit.astype(np.int8), prepend=2))
                    for a, b in zip(edges, np.append(edges[1:], len(where))):
                        if hit[a]:
                            first = int(where[a])
                            rows.append((first, number, key, int(a), first == number, b" ".join(words[a : b + WINDOW - 1])))
                columns = list(zip(*rows)) if rows else [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "source long, id long, text_key long, start int, reference boolean, words binary"
    return marked.select("id", "text_key", "text", "marks", "sources").mapInArrow(run, schema)


def _verified(pieces: DataFrame) -> DataFrame:
    """(source, piece, firsts, ends): spans of each distinct piece that its sources' automaton knows."""
    # equal pieces of many documents are streamed once
    queries = pieces.where(~F.col("reference")).groupBy("source", "piece").agg(F.first("words").alias("words"))
    references = pieces.where("reference").select("source", "words").distinct()
    weight = F.sum(F.octet_length("words").cast("long"))
    total = references.agg(weight).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    # a source of many queries gets several tasks, each with its own automaton
    tasks = queries.groupBy("source").agg(F.ceil(weight / SHARD_BYTES).cast("int").alias("salts"))
    shard = F.pmod(F.xxhash64("source"), F.lit(shards))
    dealt = queries.join(tasks, "source").select(
        shard.alias("shard"), F.pmod(F.xxhash64("piece"), F.col("salts")).cast("int").alias("salt"), "source", "piece", "words"
    )
    copied = references.join(tasks, "source").select(
        shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "source", F.lit(None).cast("binary").alias("piece"), "words"
    )

    def run(table: pa.Table) -> pa.Table:
        sources, pieces, words = (table.column(c).to_pylist() for c in ("source", "piece", "words"))
        automaton = SuffixAutomaton()
        for source, piece, text in sorted(((s, p, w) for s, p, w in zip(sources, pieces, words) if p is None), key=lambda r: r[0]):
            automaton.add(text.split(b" "), source)
        automaton.finish()
        rows = []
        for source, piece, text in zip(sources, pieces, words):
            if piece is not None:
                spans = automaton.spans(text.split(b" "), WINDOW, source)
                rows.append((source, piece, [a for a, _ in spans], [b for _, b in spans]))
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["source", "piece", "firsts", "ends"])

    return dealt.union(copied).groupBy("shard", "salt").applyInArrow(run, "source long, piece binary, firsts array<int>, ends array<int>")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 and ``kept_text`` (null where nothing was removed).

    A window is 13 consecutive words; every word in a window that also starts in a document with a
    smaller id goes, judged on the input. Ids are integers. A document with the words of a
    smaller one goes whole, if it has 13 words, and takes no part in the search. Rows with one id
    don't count as repeats of each other. A row without id is neither changed nor a source. Null and empty
    texts have no words; an empty table gives no rows; other columns are not read.

    Window hashes travel packed, in buckets of a set number of keys; equal spans are
    verified once per source, and sources with much to verify are split over tasks. The
    texts concerned are shuffled by id, twice.
    """
    base = stored(measured(docs, id_column, text_column), "words")
    total = base.agg(F.sum("n_words")).first()[0] or 0
    n = max(1, -(-int(total) // BUCKET_KEYS))
    source = docs.select(docs[id_column].cast("long").alias("id"), F.xxhash64(docs[text_column]).alias("text_key"), docs[text_column].alias("text")).where("id IS NOT NULL")
    marks = stored(_first_sources(_window_keys(source, n), n), "marks")
    texts = where_listed(source.where("text IS NOT NULL"), "id", marks.select("id"))
    marked = stored(texts.join(marks, "id").select("id", "text_key", "text", "marks", "sources", "repeats"), "marked")
    pieces = stored(_pieces(marked, n).withColumn("piece", F.unhex(F.md5("words"))), "pieces")
    found = (
        pieces.where(~F.col("reference"))
        .select("source", "piece", "id", "text_key", "start")
        .join(_verified(pieces), ["source", "piece"])
        .where(F.size("firsts") > 0)
        .groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("start", "firsts", "ends")).alias("spans"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                words = utf8(text).split()
                gone = np.zeros(len(words), dtype=bool)
                for s in spans:
                    for a, b in zip(s["firsts"], s["ends"]):
                        gone[s["start"] + a : s["start"] + b] = True
                kept = b" ".join(words[i] for i in np.flatnonzero(~gone))
                rows.append((number, hashlib.sha256(b" ".join(words)).hexdigest(), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "sha", "n_removed", "kept_sha256", "kept_text"])

    removed = (
        marked.where("repeats")
        .select("id", "text_key", "text")
        .join(found, ["id", "text_key"])
        .select("id", "text", "spans")
        .mapInArrow(run, "id long, sha string, n_removed long, kept_sha256 string, kept_text string")
        .dropDuplicates(["id", "sha"])
    )
    least = base.where(f"n_words >= {WINDOW} AND id IS NOT NULL").groupBy("sha").agg(F.min("id").alias("least"), F.count("*").alias("copies")).where("copies > 1")
    whole = F.col("id") > F.col("least")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        base.join(least, "sha", "left")
        .join(removed, ["id", "sha"], "left")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
            F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        )
    )
