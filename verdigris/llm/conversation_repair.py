"""Cheapest repair of damaged conversations: an edit distance to `(s?(ua)+)?`, by tables of whole blocks of rows.

The repair is a shortest path over four states. What the rows to the right cost from each state is a
vector; less its smallest entry it is one of a few vectors, found once. A table tells, for each of them
and each block of BLOCK symbols, the vector before the block: blocks are taken from right to left by
lookup, and expanded symbol by symbol, again from the right, where the path is traced.

A conversation is a sorted run of rows that may lie in several partitions. It is cut in segments; each
tells what it makes of every vector and state, and two scans over the segments, of a few hundred bytes
each, join them. So no task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.shared import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the role that each asks for and where it leads.
WANTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
#: Symbols: initials s, u, a and any other, each whole or truncated; the last is a row that must go.
INITIALS = "sua"
GONE = 8
SYMBOLS = 9
LEGAL = (b"su", b"ua", b"au")
#: Symbols in one block of the table.
BLOCK = 3
#: Rows in one segment at most.
SEGMENT_ROWS = 1024
#: Cells of one matrix of segments at most.
CELLS = 1 << 20
LAST = (0, 10, 5, 0)


def _kept(state: int, symbol: int) -> tuple[int, int] | None:
    """(cost, next state) of keeping the row, where the state allows it."""
    kind, cut = symbol % 4, symbol // 4
    if kind == 3 or (kind == 0 and state != 0) or (kind != 0 and WANTED[state][0] != INITIALS[kind]):
        return None
    return KEEP + TRUNCATED * cut, 1 if kind == 0 else AFTER[state]


def _before(vector: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs from each state with the symbol in front of what ``vector`` stands for. A row that must go costs nothing here."""
    if symbol == GONE:
        return vector
    out = []
    for state in range(4):
        best = DELETE + vector[state]
        kept = _kept(state, symbol)
        if kept:
            best = min(best, kept[0] + vector[kept[1]])
        best = min(best, REROLE + TRUNCATED * (symbol // 4) + vector[AFTER[state]])
        out.append(best)
    for _ in range(3):
        out = [min(cost, INSERT + out[AFTER[state]]) for state, cost in enumerate(out)]
    return tuple(out)


def _path(vector: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with the symbol, and the state after them."""
    if symbol == GONE:
        return "D", state
    before, acts = _before(vector, symbol), ""
    while True:
        if before[state] == DELETE + vector[state]:
            return acts + "D", state
        if before[state] == INSERT + before[AFTER[state]]:
            acts, state = acts + "I", AFTER[state]
            continue
        kept = _kept(state, symbol)
        if kept and before[state] == kept[0] + vector[kept[1]]:
            return acts + "K", kept[1]
        return acts + "R", AFTER[state]


class Tables:
    """Normalised vectors, their steps by symbol and by block, and the traced edits of one step."""

    def __init__(self) -> None:
        self.vectors = [LAST]
        number = {LAST: 0}
        step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows as new ones are found
            row = []
            for symbol in range(SYMBOLS):
                after = _before(vector, symbol)
                least = min(after)
                normal = tuple(c - least for c in after)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], least))
            step.append(row)
        self.step = np.array([[v for v, _ in row] for row in step], dtype=np.uint8)
        cost = np.array([[c for _, c in row] for row in step], dtype=np.int64)
        blocks = list(product(range(SYMBOLS), repeat=BLOCK))
        self.block = np.empty((len(self.vectors), len(blocks)), dtype=np.uint8)
        self.block_cost = np.empty(self.block.shape, dtype=np.int64)
        for b, symbols in enumerate(blocks):
            at, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), dtype=np.int64)
            for symbol in reversed(symbols):
                total = total + cost[at, symbol]
                at = self.step[at, symbol]
            self.block[:, b], self.block_cost[:, b] = at, total
        self.texts: list[str] = []
        found: dict[str, int] = {}
        shape = (len(self.vectors), SYMBOLS, 4)
        self.acts, self.next = np.empty(shape, dtype=np.uint16), np.empty(shape, dtype=np.uint8)
        for v, symbol, state in np.ndindex(shape):
            acts, after = _path(self.vectors[v], symbol, state)
            if acts not in found:
                found[acts] = len(self.texts)
                self.texts.append(acts)
            self.acts[v, symbol, state], self.next[v, symbol, state] = found[acts], after

    def boundaries(self, codes: np.ndarray, right: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Vectors right of each block of the rows of ``codes``, from the last block on, with that before the first; and the costs."""
        digits = codes.reshape(len(codes), -1, BLOCK).astype(np.int64)
        numbers = np.zeros(digits.shape[:2], dtype=np.int64)
        for k in range(BLOCK):
            numbers = numbers * SYMBOLS + digits[:, :, k]
        at, total, out = right, np.zeros(right.shape, dtype=np.int64), [right]
        for k in reversed(range(numbers.shape[1])):
            block = numbers[:, k] if right.ndim == 1 else numbers[:, k, None]
            total = total + self.block_cost[at, block]
            at = self.block[at, block]
            out.append(at)
        return out, total

    def trace(self, codes: np.ndarray, right: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the edits of each symbol, from the given states on, and the states after."""
        outer, _ = self.boundaries(codes, right)
        inner = np.empty(codes.shape, dtype=np.uint8)
        for block in range(codes.shape[1] // BLOCK):
            at = outer[codes.shape[1] // BLOCK - 1 - block]
            for k in reversed(range(block * BLOCK, (block + 1) * BLOCK)):
                inner[:, k] = at
                at = self.step[at, codes[:, k]]
        acts, state = np.empty(codes.shape, dtype=np.uint16), entry
        for k in range(codes.shape[1]):
            acts[:, k] = self.acts[inner[:, k], codes[:, k], state]
            state = self.next[inner[:, k], codes[:, k], state]
        return acts, state


@cache
def tables() -> Tables:
    return Tables()


def matrices(codes: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, symbols): sequences of like lengths as matrices, filled in front with rows that must go, which change nothing."""
    lengths = np.array([len(c) for c in codes])
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end + 1 - start) * lengths[order[end]] <= CELLS and lengths[order[end]] <= 2 * lengths[order[start]] + 8:
            end += 1
        width = -(-max(1, int(lengths[order[end - 1]])) // BLOCK) * BLOCK
        out = np.full((end - start, width), GONE, dtype=np.uint8)
        for row, i in enumerate(order[start:end]):
            if codes[i]:
                out[row, width - len(codes[i]) :] = np.frombuffer(codes[i], dtype=np.uint8)
        yield order[start:end], out
        start = end


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, body, n): the rows after damage, by a checksum of `conv_id:turn`; n counts a row and its copy.

    Nulls in conv_id and turn count as a space in the checksum, nulls in role and text are a space. ``conv`` is the
    id as text, null apart from all texts.
    """
    conv, turn = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, body = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("role", "text"))
    fate = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return conversations.select(
        conv_key(conversations).alias("conv"),
        conversations["turn"].cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias("body"),
        F.when(fate == 3, 2).otherwise(1).cast("long").alias("n"),
        fate.alias("fate"),
    ).where("fate <> 0").drop("fate")


def conv_key(conversations: DataFrame) -> Any:
    return F.coalesce(F.concat(F.lit("="), conversations["conv_id"].cast("string")), F.lit("null"))


def _judged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, n, code, blank): distinct rows without their text."""
    seen = F.rtrim(F.translate("body", "\t\n\x0b\x0c\r", "     "))
    light = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2("body", 256)).alias("digest"), "n",
        (seen == "").alias("blank"), F.when(F.right(seen, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1).alias("cut"),
    )
    distinct = light.groupBy("conv", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    # the least turn of each role and text; nulls come first
    least = distinct.where("NOT blank").groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("least"))
    first = F.col("turn").eqNullSafe(F.col("least.turn"))
    kind = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    kind = F.when(F.col("role") == "", 3).otherwise(kind)
    code = F.when(F.col("blank") | ~first, F.lit(GONE)).otherwise(kind + 4 * F.col("cut")).cast("int")
    return distinct.join(least, ["conv", "role", "digest"], "left").select("conv", "turn", "role", "digest", "n", code.alias("code"), "blank")


SEGMENTS = "conv string, part long, codes binary, heads binary, turns array<long>, roles array<string>, digests array<binary>, counts array<long>, blank long, duplicate long, truncated long, illegal long"


def _segments(judged: DataFrame) -> DataFrame:
    """Runs of one conversation in a range partition, SEGMENT_ROWS at most each; ``part`` orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv", pa.string()), ("part", pa.int64()), ("codes", pa.binary()), ("heads", pa.binary()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
             ("digests", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())]
        )
        part = TaskContext.get().partitionId() << 40
        held: pa.Table | None = None

        def made(table: pa.Table) -> list:
            nonlocal part
            part += 1
            conv, turn, role, digest, n, code, blank = (table.column(c).to_pylist() for c in ("conv", "turn", "role", "digest", "n", "code", "blank"))
            blanks = sum(k for k, b in zip(n, blank) if b)
            extra = sum(k if c == GONE else k - 1 for k, c in zip(n, code))
            heads = bytes(ord(r[:1]) if r[:1] in ("s", "u", "a") else 120 for r in role)
            cut = sum(4 <= c < GONE for c in code)
            # copies of a row follow it at once, and no initial may follow itself
            illegal = sum(n) - len(n) + sum(heads[i : i + 2] not in LEGAL for i in range(len(heads) - 1))
            return [conv[0], part, bytes(code), heads, turn, role, digest, n, blanks, extra - blanks, cut, illegal]

        def flush(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            conv = table.column("conv").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                while b - a > SEGMENT_ROWS or (b < len(conv) and b > a):
                    size = min(SEGMENT_ROWS, b - a)
                    rows.append(made(table.slice(a, size)))
                    a += size
            held = table.slice(a).combine_chunks()  # the last run may go on
            if rows:
                yield flush(rows)
        if held is not None and held.num_rows:
            yield flush([made(held)])

    ordered = judged.repartitionByRange("conv", "turn", "role", "digest").sortWithinPartitions("conv", "turn", "role", "digest")
    return ordered.mapInArrow(run, SEGMENTS)


def _scan(rows: DataFrame, descending: bool, start: int, name: str) -> DataFrame:
    """(conv, part, name): the state before each segment when states go through ``map`` of each in order. One row a segment is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, start
        for batch in batches:
            out = []
            for conv, table in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != last:
                    last, state = conv, start
                out.append(state)
                state = table[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int32())], names=["conv", "part", name])

    by = F.col("part").desc() if descending else F.col("part")
    return rows.select("conv", "part", "map").repartition("conv").sortWithinPartitions("conv", by).mapInArrow(run, f"conv string, part long, {name} int")


def _maps(segments: DataFrame) -> DataFrame:
    """(conv, part, map): the vector before a segment for each vector after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        every = np.arange(len(table.vectors))
        for batch in batches:
            codes = batch.column(2).to_pylist()
            out: list[bytes] = [b""] * len(codes)
            for rows, symbols in matrices(codes):
                before = table.boundaries(symbols, np.broadcast_to(every, (len(rows), len(every))))[0][-1].astype(np.uint8)
                for i, r in enumerate(rows):
                    out[r] = before[i].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["conv", "part", "map"])

    return segments.select("conv", "part", "codes").mapInArrow(run, "conv string, part long, map binary")


def _exits(segments: DataFrame) -> DataFrame:
    """(conv, part, map): the state after a segment for each state before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        for batch in batches:
            codes, right = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            out: list[bytes] = [b""] * len(codes)
            for rows, symbols in matrices(codes):
                after = np.stack([table.trace(symbols, right[rows], np.full(len(rows), state, dtype=np.uint8))[1] for state in range(4)], axis=1)
                for i, r in enumerate(rows):
                    out[r] = after[i].astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["conv", "part", "map"])

    return segments.select("conv", "part", "codes", "right").mapInArrow(run, "conv string, part long, map binary")


def _edits(segments: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, acts, n): the edits of each distinct row; rows beyond the first of it go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()
        for batch in batches:
            codes, right, entry = batch.column(2).to_pylist(), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            out: list[list[str]] = [[]] * len(codes)
            for rows, symbols in matrices(codes):
                acts, _ = table.trace(symbols, right[rows], entry[rows].astype(np.uint8))
                for i, r in enumerate(rows):
                    out[r] = [table.texts[k] for k in acts[i, symbols.shape[1] - len(codes[r]) :]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], names=["conv", "part", "acts"])

    traced = segments.select("conv", "part", "codes", "right", "entry").mapInArrow(run, "conv string, part long, acts array<string>")
    zipped = F.arrays_zip("turns", "roles", "digests", "counts", "acts")
    return (
        traced.join(segments.select("conv", "part", "turns", "roles", "digests", "counts"), ["conv", "part"])
        .select("conv", F.explode(zipped).alias("r"))
        .select("conv", F.col("r.turns").alias("turn"), F.col("r.roles").alias("role"), F.col("r.digests").alias("digest"), F.col("r.acts").alias("acts"), F.col("r.counts").alias("n"))
    )


def _faults(segments: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal). Segments, not rows, are put in order to see the pairs between them."""
    order = Window.partitionBy("conv").orderBy("part")
    head, tail = F.expr("substring(heads, 1, 1)"), F.expr("substring(heads, -1, 1)")
    pair = F.concat(F.lag(tail).over(order), head)
    between = F.when(pair.isNotNull() & ~pair.isin(*LEGAL), 1).otherwise(0)
    joined = segments.select("conv", "part", "heads", "blank", "duplicate", "truncated", "illegal").withColumn("illegal", F.col("illegal") + between)
    return joined.groupBy("conv").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))


class Repaired:
    """The repaired rows of one conversation, one at a time."""

    def __init__(self) -> None:
        self.audit: list[str] = []
        self.sum = hashlib.sha256()
        self.cost, self.state, self.empty = 0, 0, True

    def line(self, role: str, text: str) -> None:
        self.sum.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def row(self, acts: str, role: str, text: str, cut: bool) -> None:
        for act in acts:
            if act == "D":
                self.cost += DELETE
                continue
            wanted, after = WANTED[self.state], AFTER[self.state]
            if act == "I":
                self.line(wanted, "")
                self.cost += INSERT
            else:
                if act == "K" and role[:1] == "s":
                    after = 1
                self.line(role if act == "K" else wanted, text)
                self.cost += (KEEP if act == "K" else REROLE) + TRUNCATED * cut
            self.state = after
        self.audit.append(acts)

    def end(self) -> tuple[int, str, str]:
        while LAST[self.state]:
            self.row("I", "", "", False)
        return self.cost, "".join(self.audit), self.sum.hexdigest()


def _written(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, cost, audit, repaired_sha256), read in order; one row is held at a time, and the audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "cost", "audit", "repaired_sha256"]
        types = (pa.string(), pa.int64(), pa.string(), pa.string())
        conv, one, row = None, Repaired(), ("", 0)
        for batch in batches:
            done: list[tuple] = []
            for c, role, cut, acts, n, body in zip(*(batch.column(k).to_pylist() for k in ("conv", "role", "cut", "acts", "n", "body"))):
                if c != conv:
                    if conv is not None:
                        done.append((conv, *one.end()))
                    conv, one = c, Repaired()
                if acts is not None:
                    row = (acts, n)
                elif row[1]:  # the first of equal rows; the others are counted in n
                    one.row(row[0], role, body, bool(cut))
                    one.row("D" * (row[1] - 1), "", "", False)
                    row = ("", 0)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names=names)
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((conv, *one.end()), types)], names=names)

    seen = F.rtrim(F.translate("body", "\t\n\x0b\x0c\r", "     "))
    none = F.lit(None)
    texts = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2("body", 256)).alias("digest"), F.lit(1).alias("kind"), (~F.right(seen, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        none.cast("string").alias("acts"), none.cast("long").alias("n"), "body",
    )
    plans = edits.select("conv", "turn", "role", "digest", F.lit(0).alias("kind"), none.cast("boolean").alias("cut"), "acts", "n", none.cast("string").alias("body"))
    ordered = texts.union(plans).repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind")
    return ordered.mapInArrow(run, "conv string, cost long, audit string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """Per original conv_id (null is one): faults of its damaged rows, and the cheapest repair.

    Rows go by turn, nulls first; rows of one turn by role and then by the SHA-256 of their text, and equal rows
    are one after the other, so repeated rows are duplicates. Empty and blank texts are blank; an empty table gives no
    rows, an id without rows after damage zeros. A role whose first letter is not s, u or a, or an empty one, can't be
    kept. Texts may be of any length: only their checksums take part in the search, and they are read once, sorted, for
    repaired_sha256. Columns beside conv_id, turn, role and text are not read.
    """
    rows = damaged(conversations)
    segments = stored(_segments(_judged(rows)), "segments")
    rights = _scan(_maps(segments), True, 0, "right")
    righted = stored(segments.join(rights, ["conv", "part"]).select("conv", "part", "codes", "right", "turns", "roles", "digests", "counts"), "righted")
    entries = _scan(_exits(righted), False, 0, "entry")
    edits = _edits(stored(righted.join(entries, ["conv", "part"]), "entered"))
    turns = rows.groupBy("conv").agg(F.min("turn").alias("least"), F.max("turn").alias("most"))
    distinct = rows.where("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv").agg(F.count("*").alias("turns"))
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    faults = _faults(segments)
    empty = hashlib.sha256(b"").hexdigest()
    known = conversations.select(conversations["conv_id"].alias("conv_id"), conv_key(conversations).alias("conv")).distinct()
    zero = F.lit(0).cast("long")
    counted = [F.coalesce(c, zero).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        known.join(turns, "conv", "left").join(distinct, "conv", "left").join(faults, "conv", "left").join(_written(rows, edits), "conv", "left")
        .select("conv_id", F.coalesce(gaps, zero).cast("long").alias("gaps"), *counted, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
    )
