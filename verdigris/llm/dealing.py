"""Hash keys dealt out in packed blocks: one row for many keys, so that an exchange moves bytes, not rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of a key beside its bucket's number.
KEY_BYTES = 6
KEY_MASK = np.uint64((1 << (8 * KEY_BYTES)) - 1)
SCHEMA = "bucket int, ids binary, tags binary, counts binary, keys binary"
_FIELDS = ("bucket", "ids", "tags", "counts", "keys")
_TYPES = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket from the upper half of each hash; the key is its lower KEY_BYTES."""
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def marks_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """What a key and its bucket tell of a hash, as one number."""
    return (hashes & KEY_MASK) + (buckets_of(hashes, n) << np.uint64(8 * KEY_BYTES))


def pack(hashes: np.ndarray, owner: np.ndarray, ids: np.ndarray, tags: np.ndarray, n: int) -> pa.RecordBatch:
    """One row per bucket. ``owner``: ascending index into ids and tags of each hash."""
    bucket = buckets_of(hashes, n).astype(np.uint16 if n <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    raw = (hashes[order] & KEY_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    # a run: the keys of one owner in one bucket
    change = np.flatnonzero((np.diff(bucket.astype(np.int64), prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    lengths = np.diff(np.append(change, len(bucket))).astype("<i4")
    run_ids, run_tags = ids[owner[change]].astype("<i8"), tags[owner[change]].astype("<i8")
    present = np.flatnonzero(np.diff(bucket[change].astype(np.int64), prepend=-1))
    runs = np.append(present, len(change))
    keys = np.append(change[present], len(bucket)) if len(change) else np.array([0])
    rows: list[list] = [[] for _ in _FIELDS]
    for k in range(len(present)):
        a, b = runs[k], runs[k + 1]
        rows[0].append(int(bucket[change[a]]))
        rows[1].append(run_ids[a:b].tobytes())
        rows[2].append(run_tags[a:b].tobytes())
        rows[3].append(lengths[a:b].tobytes())
        rows[4].append(raw[keys[k] : keys[k + 1]].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _TYPES)], names=list(_FIELDS))


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, ids, tags) of all rows of one bucket, parallel."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)

    counts = joined("counts", "<i4")
    raw = joined("keys", "u1").reshape(-1, KEY_BYTES)
    keys = np.zeros((len(raw), 8), dtype=np.uint8)
    keys[:, :KEY_BYTES] = raw
    return keys.view("<u8").ravel(), np.repeat(joined("ids", "<i8"), counts), np.repeat(joined("tags", "<i8"), counts)


def shared_keys(keys: np.ndarray, ids: np.ndarray, tags: np.ndarray, with_tags: bool = False) -> tuple[np.ndarray, ...]:
    """(keys, ids) of keys that two different tags have, sorted by key and id; of each tag only the smallest id. The tags too, if asked for."""
    order = np.argsort(keys)
    keys = keys[order]
    alone = np.ones(len(keys), dtype=bool)
    same = keys[1:] == keys[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    order, keys = order[~alone], keys[~alone]
    ids, tags = ids[order], tags[order]
    order = np.lexsort((ids, tags, keys))
    keys, ids, tags = keys[order], ids[order], tags[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (tags[1:] != tags[:-1])
    keys, ids, tags = keys[first], ids[first], tags[first]
    several = np.zeros(len(keys), dtype=bool)
    same = keys[1:] == keys[:-1]
    several[1:] |= same
    several[:-1] |= same
    keys, ids, tags = keys[several], ids[several], tags[several]
    order = np.lexsort((ids, keys))
    return (keys[order], ids[order], tags[order]) if with_tags else (keys[order], ids[order])


def group_starts(keys: np.ndarray) -> np.ndarray:
    """For each entry of sorted keys, the index of the first entry with its key."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(keys) else np.empty(0, dtype=np.int64)


def by_id(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(id, indexes of its entries) for each id."""
    order = np.argsort(ids, kind="stable")
    cuts = np.flatnonzero(np.diff(ids[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(ids[part[0]]), part
