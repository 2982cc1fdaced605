"""SentencePiece encoding and decoding by a Viterbi search in numpy, words of one length together.

The public model is of the BPE kind. Its segmentation is not the best sum of scores, so a
search by scores gives other ids; but it is the one path on which every two neighbours are
compatible, that is, on which merging their characters by rank ends in just these two pieces. The search keeps,
for each end in a word, the piece that ends there and is compatible with the piece kept at its start; incompatible
paths count as worst, so that the maximum is the one valid path.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verdigris.llm.words import WordTable, constants, mix, slices

SPACE = "▁"
#: Distinct words whose ids a task keeps.
WORDS_KEPT = 300_000
#: Pairs of neighbours whose verdict a task keeps.
PAIRS_KEPT = 1_000_000
#: Words of one length that advance together, times that length, at most.
CELLS = 200_000
#: Bytes of text encoded at once: enough for many words of one length, few for the memory of a task.
SLICE_BYTES = 2_000_000
#: Before a word that has no blank of its own before it. A text with this character is cut by _WORD.
_BARE = "\x02"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """The pieces of a model file: sorted hash keys, ids, and how merges by rank build each.

    Made once and sent to the tasks: some thousand pieces, whatever the input.
    """

    def __init__(self, path: str):
        self.path = path
        processor = self.processor()
        self.size = processor.get_piece_size()
        self.pieces = [processor.id_to_piece(i) for i in range(self.size)]
        self.unknown = processor.unk_id()
        self.control = [i for i in range(self.size) if processor.is_control(i)]
        self.bytes = np.full(256, self.unknown, dtype=np.int64)
        ordinary = []
        for i, piece in enumerate(self.pieces):
            if processor.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (i in self.control or processor.is_unknown(i) or processor.is_unused(i)):
                ordinary.append(i)
        self.number = {self.pieces[i]: i for i in ordinary}
        scores = {i: processor.get_score(i) for i in ordinary}
        self.longest = max(len(self.pieces[i]) for i in ordinary)
        self.factors = constants(self.longest, 50)
        # rank of the merge that makes a piece; -1: a single character, never merged
        self.rank = np.full(self.size, -1, dtype=np.int64)
        for k, i in enumerate(sorted((i for i in ordinary if len(self.pieces[i]) > 1), key=lambda i: -scores[i])):
            self.rank[i] = k
        # left and right part of that merge; pieces that their own characters don't merge to are left out
        self.left, self.right = np.full(self.size, -1, dtype=np.int64), np.full(self.size, -1, dtype=np.int64)
        usable = []
        for i in ordinary:
            ids, last = self._merged(self.pieces[i])
            if ids == [i]:
                usable.append(i)
                if last:
                    self.left[i], self.right[i] = last
        keys = np.array([self._key(self.pieces[i]) for i in usable], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable)[order]
        assert len(np.unique(keys)) == len(keys), "two pieces have one hash"
        self.perhaps = np.zeros(1 << 19, dtype=bool)
        self.perhaps[(keys & np.uint64((1 << 19) - 1)).astype(np.int64)] = True
        # every two pieces that together are a piece, and the rank of that merge
        merges = [
            (self.number[p[:k]] * self.size + self.number[p[k:]], int(self.rank[i]))
            for p, i in self.number.items()
            for k in range(1, len(p))
            if p[:k] in self.number and p[k:] in self.number
        ]
        merges.sort()
        self.merge_pairs, self.merge_ranks = (np.array(c, dtype=np.int64) for c in zip(*merges))
        self.known_pairs: dict[int, bool] = {}

    def processor(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def _key(self, piece: str) -> int:
        codes = np.array([ord(c) for c in piece], dtype=np.uint64)
        total = np.add.reduce(mix(codes) * self.factors[: len(codes)])
        return int(mix(np.array([total]) + np.uint64(len(codes)))[0])

    def _merged(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """The pieces that the characters of a piece merge to by rank, and the parts of the last merge."""
        parts, last = list(text), None
        while len(parts) > 1:
            ranked = [(int(self.rank[i]), k) for k in range(len(parts) - 1) if (i := self.number.get(parts[k] + parts[k + 1])) is not None]
            if not ranked:
                break
            at = min(ranked)[1]
            last = self.number.get(parts[at], -1), self.number.get(parts[at + 1], -1)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.number.get(p, -1) for p in parts], last

    def _stand_together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of both pieces by rank ends in these two.

        Goes back in time from the finished pieces, undoing the later merge of the two at the border.
        While two parts stood side by side, until the merge just undone, their own merge must not have been due.
        """
        good = np.ones(len(a), dtype=bool)
        due = np.full(len(a), np.iinfo(np.int64).max)
        left = np.arange(len(a))
        while len(left):
            x, y = a[left], b[left]
            pair = x * self.size + y
            at = np.minimum(np.searchsorted(self.merge_pairs, pair), len(self.merge_pairs) - 1)
            bad = (self.merge_pairs[at] == pair) & (self.merge_ranks[at] < due[left])
            good[left[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            left = left[~bad & ((rx >= 0) | (ry >= 0))]
            x, y = a[left], b[left]
            rx, ry = self.rank[x], self.rank[y]
            first = rx > ry
            # of equal merges the left one comes first, so the border's would come before that of y
            due[left] = np.where(first, rx, ry + 1)
            a[left] = np.where(first, self.right[x], x)
            b[left] = np.where(first, y, self.left[y])
        return good

    def compatible(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may follow the one before it; -1 is a word's start."""
        wanted, place = np.unique(before * self.size + piece, return_inverse=True)
        if len(self.known_pairs) > PAIRS_KEPT:
            self.known_pairs = {}
        known = self.known_pairs
        fresh = np.array([p for p in wanted.tolist() if p >= 0 and p not in known], dtype=np.int64)
        if len(fresh):
            known.update(zip(fresh.tolist(), self._stand_together(fresh // self.size, fresh % self.size).tolist()))
        fits = np.fromiter((p < 0 or known[p] for p in wanted.tolist()), dtype=bool, count=len(wanted))
        return fits[place]

    def segment(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as rows of code points, all of one length and known characters; and how many each has."""
        n, size = codes.shape
        hashed = mix(codes.astype(np.uint64))
        last = np.full((n, size + 1), -2, dtype=np.int64)  # the piece that ends here; -1: start, -2: none
        back = np.zeros((n, size + 1), dtype=np.int64)
        last[:, 0] = -1
        sums = np.zeros((n, size), dtype=np.uint64)
        # matched[l - 1][:, s]: the piece of l characters from s on, or -1
        matched = []
        for length in range(1, min(self.longest, size) + 1):
            width = size - length + 1
            sums = sums[:, :width] + hashed[:, length - 1 :] * self.factors[length - 1]
            key = mix(sums + np.uint64(length))
            found = np.full(key.shape, -1, dtype=np.int32)
            maybe = self.perhaps[(key & np.uint64(len(self.perhaps) - 1)).astype(np.int64)]
            probes = key[maybe]
            at = np.minimum(np.searchsorted(self.keys, probes), len(self.keys) - 1)
            found[maybe] = np.where(self.keys[at] == probes, self.ids[at], -1)
            matched.append(found)
        for end in range(1, size + 1):
            for length in range(min(self.longest, end), 0, -1):
                piece = matched[length - 1][:, end - length].astype(np.int64)
                before = last[:, end - length]
                try_it = np.flatnonzero((piece >= 0) & (before != -2) & (last[:, end] == -2))
                if len(try_it):
                    good = try_it[self.compatible(before[try_it], piece[try_it])]
                    last[good, end] = piece[good]
                    back[good, end] = end - length
        steps = []
        rows, ends = np.arange(n), np.full(n, size)
        while len(rows):
            steps.append((rows, last[rows, ends]))
            ends = back[rows, ends]
            rows, ends = rows[ends > 0], ends[ends > 0]
        # the steps go from the last piece to the first
        word = np.concatenate([r for r, _ in reversed(steps)])
        ids = np.concatenate([i for _, i in reversed(steps)])
        order = np.argsort(word, kind="stable")
        return ids[order].astype(np.int32), np.bincount(word, minlength=n)


class Encoder:
    """Ids of whole texts, each distinct word segmented once while there is room."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.normalize = model.processor().normalize
        self.table = WordTable()

    def words(self, text: str) -> list[str]:
        """A text cut where no piece goes on: before blanks and around line feeds.

        A word stands for itself behind one blank; those that don't are marked by _BARE.
        """
        normal = self.normalize(text) if text else ""
        if _BARE in normal or SPACE * 2 in normal or not normal.startswith(SPACE):
            return [_BARE + w for w in _WORD.findall(normal)]
        return normal[1:].replace("\n", f"{SPACE}{_BARE}\n{SPACE}{_BARE}").split(SPACE)

    def _runs(self, word: str) -> list[tuple[str, bool]]:
        """A word in runs of known characters, and single others."""
        number = self.model.number
        if all(map(number.__contains__, word)):
            return [(word, True)] if word else []
        out, start = [], 0
        for i, c in enumerate(word):
            if c not in number:
                if i > start:
                    out.append((word[start:i], True))
                out.append((c, False))
                start = i + 1
        if start < len(word):
            out.append((word[start:], True))
        return out

    def learn(self, words: list[str]) -> None:
        runs = [self._runs(w[1:] if w.startswith(_BARE) else SPACE + w) for w in words]
        by_length: dict[int, list[str]] = {}
        for run in {r for own in runs for r, ordinary in own if ordinary}:
            by_length.setdefault(len(run), []).append(run)
        done: dict[str, np.ndarray] = {}
        for size, group_of_size in by_length.items():
            step = max(1, CELLS // size)
            for at in range(0, len(group_of_size), step):
                group = group_of_size[at : at + step]
                codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(group), size)
                ids, counts = self.model.segment(codes)
                done.update(zip(group, np.split(ids, np.cumsum(counts)[:-1])))
        none = np.empty(0, dtype=np.int32)
        parts = [
            done[own[0][0]]
            if len(own) == 1 and own[0][1]
            else np.concatenate([none, *(done[r] if ordinary else self.model.bytes[list(r.encode("utf-8", "surrogatepass"))].astype(np.int32) for r, ordinary in own)])
            for own in runs
        ]
        self.table.add(np.concatenate(parts), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin (one entry more)."""
        if len(self.table.number) > WORDS_KEPT:
            self.table = WordTable()
        numbers, count, fresh = self.table.numbers([self.words(t) for t in texts])
        if fresh:
            self.learn(fresh)
        return self.table.put_together(numbers, count, [])


class Decoder:
    """Texts of ids: the pieces' characters, bytes joined to characters, marks to blanks, without the first."""

    def __init__(self, model: PieceModel):
        value = {int(i): bytes([b]) for b, i in enumerate(model.bytes.tolist()) if i != model.unknown}
        self.parts = [value.get(i, piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")) for i, piece in enumerate(model.pieces)]
        for i in model.control:
            self.parts[i] = b""

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.parts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, model_path: str, text_column: str = "text", ids_column: str = "piece_ids") -> DataFrame:
    """``docs`` and, for each row, ``ids_column``: the ids of the whole text.

    A null text has null ids, an empty one none. A character that no piece has becomes its UTF-8 bytes.
    All other columns stay; one with the name of the new column is replaced. Rows are not
    shuffled; repeated rows stay, an empty table gives none.
    """
    plain = docs.drop(ids_column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields) + f", `{ids_column}` array<int>"
    names = [*plain.columns, ids_column]

    model = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch, texts in slices(batches, text_column, SLICE_BYTES):
            ids, starts = encoder.encode([t.decode("utf-8", "surrogatepass") for t in texts])
            missing = batch.column(batch.schema.get_field_index(text_column)).is_null()
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids), mask=missing)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=names)

    return plain.mapInArrow(run, schema)


def decode_documents(tokens: DataFrame, model_path: str, ids_column: str = "piece_ids", text_column: str = "decoded") -> DataFrame:
    """``tokens`` with ``text_column``: the text of the ids; null for null ids, empty for none."""
    plain = tokens.drop(text_column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields) + f", `{text_column}` string"
    names = [*plain.columns, text_column]

    model = tokens.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_column))
            texts = [None if not v.is_valid else decoder.decode(v.values.to_numpy(zero_copy_only=False)) for v in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return plain.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), and whether decoding gives the text back.

    A null text counts as empty: no pieces, checksum 0, ``same`` true. Encoding and decoding share one pass
    over the texts; no shuffle. Other columns are not read.
    """
    schema = f"{docs.select(id_column).schema[0].simpleString().replace(':', ' ', 1)}, n_pieces long, ids_crc32 long, same boolean"
    source = docs.select(docs[id_column], docs[text_column].alias("text"))

    model = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        decoder = Decoder(model.value)
        for batch, data in slices(batches, size=SLICE_BYTES):
            texts = [t.decode("utf-8", "surrogatepass") for t in data]
            ids, starts = encoder.encode(texts)
            parts = [ids[a:b] for a, b in zip(starts[:-1], starts[1:])]
            sums = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
            same = [decoder.decode(p) == t for p, t in zip(parts, texts)]
            columns = [batch.column(0), pa.array(np.diff(starts), pa.int64()), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_pieces", "ids_crc32", "same"])

    return source.mapInArrow(run, schema)
