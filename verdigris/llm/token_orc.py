"""Token ids in ORC: sorted, indexed files that are written and read stripe by stripe."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.llm.shared import kept_in_worker, stored
from verdigris.llm.words import WordTable, slices
from verdigris.session import scratch_path

END_ID = 1
#: Distinct words whose ids a worker keeps; when there are more, those used most stay, two thirds as many.
WORDS_KEPT = 450_000
#: New letter or sign runs that the tokenizer gets as one text.
ATOMS_A_CALL = 200
#: A run of Latin letters and the run of signs after it: two words for the pre-tokenizer, whatever
#: surrounds them. No apostrophe (contractions), no mark (composition).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}


class WordEncoder:
    """Ids of whole texts from a tokenizer that never joins characters across a blank.

    The tokenizer's pre-tokenizer drops white space and splits there, so a text has the ids of its
    words between blanks and line feeds, one after the other. Each distinct word
    is encoded once. Most are a letter run and signs, which are
    shared by words that differ in case or end; the library encodes those runs, and any other word whole.
    """

    def __init__(self, path: str):
        # one thread: a task has one core, and each more thread holds memory of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends_word[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.table, self.atoms = WordTable(), WordTable()
        self.uses = np.empty(0, dtype=np.int64)

    def make_room(self) -> None:
        """Words that were met most stay; runs that they are made of are learnt again where new words have them."""
        stay = 2 * WORDS_KEPT // 3
        on = np.sort(np.argpartition(-self.uses, stay)[:stay])
        self.table.keep(on)
        self.uses = self.uses[on]
        if len(self.atoms.number) > WORDS_KEPT:
            self.atoms = WordTable()

    def _atoms(self, atoms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letter runs and sign runs, and how many each has: each ends at its first id with a word end."""
        lines = [" ".join(atoms[i : i + ATOMS_A_CALL]) for i in range(0, len(atoms), ATOMS_A_CALL)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in encoded), dtype=np.int32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        assert len(ends) == len(atoms), "a letter run or a sign run has become more than one word"
        return ids, np.diff(ends, prepend=0)

    def learn(self, words: list[str]) -> None:
        cut = [_PLAIN.fullmatch(w) for w in words]
        # any other word is an atom by itself, behind a blank, which no run has
        atoms = [((m[1].lower(), m[2]) if m[2] else (m[1].lower(),)) if m else (" " + w,) for m, w in zip(cut, words)]
        runs = self.atoms.numbers([a for a, m in zip(atoms, cut) if m])[2]
        self.atoms.add(*self._atoms(runs))
        rest = self.atoms.numbers([a for a, m in zip(atoms, cut) if not m])[2]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast([w[1:] for w in rest], add_special_tokens=False)] if rest else []
        sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        self.atoms.add(np.fromiter(chain.from_iterable(encoded), dtype=np.int32), sizes)
        numbers, count, _ = self.atoms.numbers(atoms)
        ids, ends = self.atoms.put_together(numbers, count, [])
        self.table.add(ids, np.diff(ends))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and where each text starts (one entry more)."""
        if len(self.table.number) > WORDS_KEPT:
            self.make_room()
        numbers, count, fresh = self.table.numbers([t.replace("\n", " ").split(" ") for t in texts])
        if fresh:
            self.learn(fresh)
        uses = np.bincount(numbers, minlength=len(self.table.number))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return self.table.put_together(numbers, count, [END_ID])


def with_ids(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text and the end id; a null text has the end id alone."""
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(("word encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        for batch, texts in slices(batches):
            ids, starts = encoder.encode([t.decode("utf-8", "surrogatepass") for t in texts])
            column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """ORC files below ``path`` in ascending doc_id order: ``part`` and ``row`` give the place of each row.

    The texts are dealt out by ranges of doc_id (nulls first) and tokenized after the exchange, so
    that ids are never shuffled; tasks grow in number with the input. ORC stores the ids as
    run-length encoded integers, with row indexes and a Bloom filter on doc_id in each stripe.
    """
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    narrow = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    dealt = narrow.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    placed = with_ids(dealt, tokenizer_path).select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
        "doc_id",
        "ids",
    )
    placed.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; with ``ids`` the row indexes and Bloom filters prune stripes and row groups."""
    df = spark.read.schema("part int, row long, doc_id long, ids array<int>").orc(path)
    return df if ids is None else df.where(F.col("doc_id").isin(ids))


def summarise(tokens: DataFrame) -> DataFrame:
    """Per row: ids of all rows before it, its number of ids, and their checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offsets = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets).astype("int64")), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])

    # kept, so that the ids are read once
    rows = stored(tokens.mapInArrow(run, "part int, row long, doc_id long, n_tokens long, ids_crc32 long"), "token-counts")
    # one row for each part, as many as the files have writers
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.coalesce(inside, F.lit(0))).alias("start"), "n_tokens", "ids_crc32"
    )


def token_orc(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """Encodes whole texts, writes them as ORC in doc_id order and returns (doc_id, start, n_tokens, ids_crc32) as read back.

    A null text is empty (the end id alone). Null ids come first; rows with the same id keep
    one order, that of the files. An empty table gives no rows. Other columns are
    not read. A text of any length is one row.
    """
    target = path or scratch_path(docs.sparkSession, "token-orc")
    write_tokens(docs, target, tokenizer_path, id_column, text_column)
    return summarise(read_tokens(docs.sparkSession, target))
