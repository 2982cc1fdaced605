"""Change-tracking snapshots."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def open_history(incoming: DataFrame, stamp: str) -> DataFrame:
    """First load: every row is valid from its own stamp on."""
    kind = incoming.schema[stamp].dataType
    return incoming.withColumns({VALID_FROM: F.col(stamp), VALID_TO: F.lit(None).cast(kind)})


def track_changes(history: DataFrame, incoming: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Type-2 merge: a newer stamp closes the open row and opens another.

    One full outer join of open rows with the incoming ones; each pair yields up
    to two rows. Closed rows pass by untouched, and a key that is no longer
    delivered stays open.
    """
    fields = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    closed = history.filter(F.col(VALID_TO).isNotNull())
    current = history.filter(F.col(VALID_TO).isNull()).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*history.columns).alias("__old")
    )
    fresh = incoming.select(
        *[F.col(k).alias(f"__n{i}") for i, k in enumerate(keys)], F.struct(*fields).alias("__new")
    )
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"__k{i}").eqNullSafe(F.col(f"__n{i}"))
    pairs = current.join(fresh, same, "full_outer")

    old, new = F.col("__old"), F.col("__new")
    changed = old.isNull() | (new[stamp] > old[stamp])
    opens = F.coalesce(new.isNotNull() & changed, F.lit(False))
    stamp_type = history.schema[VALID_TO].dataType

    def version(source: Column, start: Column, end: Column) -> Column:
        return F.struct(*[source[c].alias(c) for c in fields], start.alias(VALID_FROM), end.alias(VALID_TO))

    kept = F.when(old.isNotNull(), version(old, old[VALID_FROM], F.when(opens, new[stamp]).cast(stamp_type)))
    added = F.when(opens, version(new, new[stamp].cast(stamp_type), F.lit(None).cast(stamp_type)))
    rows = pairs.select(F.explode(F.array_compact(F.array(kept, added))).alias("__row")).select("__row.*")
    return closed.unionByName(rows)


def merged_history(before: DataFrame | None, incoming: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """The history after a load; ``before`` is None for the first one."""
    return open_history(incoming, stamp) if before is None else track_changes(before, incoming, keys, stamp)


def refresh_by_version(
    listed: DataFrame, stored: DataFrame, key: str, version: str, stamp: str, flag: str = "refreshed"
) -> DataFrame:
    """Pair listed rows with stored ones and flag those that must be rebuilt.

    A row is rebuilt if unknown, if its version grew, or if its parsed update
    time is later (a stored time that cannot be read also counts as older).
    Stored columns come back under the prefix ``old_``; keys no longer listed
    drop out. Keys are unique on both sides.
    """
    before = stored.select(*[F.col(c).alias(f"old_{c}") for c in stored.columns])
    paired = listed.join(before, F.col(key) == F.col(f"old_{key}"), "left")
    then, now = F.try_to_timestamp(F.col(f"old_{stamp}")), F.try_to_timestamp(F.col(stamp))
    newer = now.isNotNull() & (then.isNull() | (now > then))
    grown = F.col(version) > F.coalesce(F.col(f"old_{version}"), F.lit(0))
    return paired.withColumn(flag, F.col(f"old_{key}").isNull() | F.coalesce(grown, F.lit(False)) | newer)
