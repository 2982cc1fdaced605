"""Quality rules: word and line counts, and bands of the zstandard ratio."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from verdigris.llm.words import SPACES, utf8

#: Bytes of a whole text below which a row of limits holds, lowest and highest ratio
#: (bytes / compressed bytes) allowed. A short text hardly compresses at all, a long one
#: always does: the frame costs a dozen bytes and the window has more to refer to.
#: Base64 and hexadecimal noise stay at 1.33 and 2.0, prose of any length between 1.4 and 3.
BANDS = (
    (200, 0.0, 2.8),
    (400, 1.05, 3.0),
    (1_600, 1.2, 3.2),
    (25_600, 1.38, 3.6),
    (float("inf"), 1.38, 4.2),
)


@dataclass(frozen=True)
class Limits:
    """``chunk``: bytes of a chunk; of a text's chunks at most ``chunk_share`` may be outside their band."""

    bands: Sequence[tuple[float, float, float]] = BANDS
    level: int = 3
    chunk: int = 4_096
    chunk_low: float = 1.38
    chunk_high: float = 4.5
    chunk_share: float = 0.25
    least_words: int = 50
    repeat_percent: int = 50


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, ratio double, n_chunks long, n_bad_chunks long, reason string"
)
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: Sequence[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    size = len(ids) - width + 1
    window = ids[:size]
    for offset in range(1, width):
        # numbered anew at each step, so that the products never overflow
        _, window = np.unique(window * len(number) + ids[offset : offset + size], return_inverse=True)
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for offset in range(width):
        covered[offset : offset + size] |= again
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def ratio_verdict(data: bytes, limits: Limits, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, str | None]:
    """Ratio of the whole text, its chunks, those outside the band, and why it is rejected (None: it isn't).

    A text longer than a chunk is covered by as few chunks as can hold it, all of full size, the first at its
    start, the last at its end, those between at even steps: each byte is judged, and both ends count alike.
    """
    if not data:
        return 0.0, 0, 0, None
    ratio = len(data) / len(compressor.compress(data))
    low, high = next((lo, hi) for below, lo, hi in limits.bands if len(data) < below)
    chunks = -(-len(data) // limits.chunk) if len(data) > limits.chunk else 0
    bad = 0
    for k in range(chunks):
        start = k * (len(data) - limits.chunk) // (chunks - 1)
        part = data[start : start + limits.chunk]
        bad += not limits.chunk_low <= len(part) / len(compressor.compress(part)) <= limits.chunk_high
    reason = "repetitive" if ratio > high else "incompressible" if ratio < low else None
    if reason is None and bad > limits.chunk_share * chunks:
        reason = "chunks"
    return ratio, chunks, bad, reason


def measure(text: str | None, limits: Limits, compressor: zstandard.ZstdCompressor) -> tuple:
    data = utf8(text)
    words = data.split()
    repeats = repeated_words(words)
    failed = len(words) < limits.least_words or 100 * repeats > limits.repeat_percent * len(words)
    chars = len(text or "") - sum(data.count(bytes([s])) for s in SPACES)
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    ratio, chunks, bad, reason = ratio_verdict(data, limits, compressor)
    return len(words), chars, symbols, duplicate_lines(data), repeats, failed, not failed and reason is None, ratio, chunks, bad, reason


def compression_bands(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limits: Limits | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, counts, base verdict, ratios and the final verdict ``kept``.

    Work is per row in the scan's stage: no shuffle. A null text counts as empty:
    no words, ratio 0, ``base_failed``. A null id stays null, repeated rows give repeated
    rows, an empty table gives none; other columns are not read. The texts of one
    Arrow batch are in memory, whole, however long.
    """
    limits = limits or Limits()
    schema = f"{docs.select(id_column).schema[0].simpleString().replace(':', ' ', 1)}, {COLUMNS}"
    source = docs.select(docs[id_column], docs[text_column].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=limits.level)
        kinds = (pa.int64(),) * 5 + (pa.bool_(),) * 2 + (pa.float64(), pa.int64(), pa.int64(), pa.string())
        names = [part.split()[0] for part in COLUMNS.split(", ")]
        for batch in batches:
            rows = [measure(t, limits, compressor) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            arrays = [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_column, *names])

    return source.mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_column: str = "text", limits: Limits | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are. No shuffle; nulls as in ``compression_bands``."""
    limits = limits or Limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=limits.level)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            yield batch.filter(pa.array([measure(t, limits, compressor)[6] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
