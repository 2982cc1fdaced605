"""Joins that stay distributed when one key holds much of the data.

Joins are plain equi-joins: Catalyst broadcasts what its statistics prove small, and AQE turns a join
around or splits a partition once it has seen sizes. Where a key is known or counted to be hot before
the exchange (:func:`hot_keys`), :func:`lookup` and :func:`exclude` deal its rows, and no others, over sub-keys.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: A key with more than this part of the rows is hot; each of its sub-keys gets about this part.
HOT_SHARE = 1 / 64
#: Entries that one sketch keeps for each key that can be hot: counts are wrong by a few hundredths of the share at most.
_ENTRIES = 64
#: Sketches are merged in this many groups first, and then those of the groups.
_GROUPS = 64
#: Equal rows that stand together as one through the exchange.
_TOGETHER = 1 << 16
_SALT = "__salt"

#: Sub-keys by the hash of a hot key.
HotKeys = Mapping[int, int]


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def hot_keys(df: DataFrame, on: str | Sequence[str], share: float = HOT_SHARE) -> HotKeys:
    """Keys with more than ``share`` of the rows of ``df``, and how many sub-keys each needs.

    One pass over the key columns with frequent-item sketches, merged in two steps, so that no task merges
    those of all tasks. Keys with a NULL never meet a partner and are left out. At most 2 / share numbers
    come to the driver. A key a little below the share may be among them, one above it is never missing.
    """
    keys = _keys(on)
    most = int(2 / share)
    tracked = min(most * _ENTRIES, 100_000)
    known = df.select(*keys).dropna()
    hashed = known.select(F.xxhash64(*keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("g"))
    # one NULL, counted apart, so that there is a sketch to merge where there are no rows
    hashed = hashed.union(df.sparkSession.range(1).select(F.lit(None).cast("long"), F.lit(0)))
    parts = hashed.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"), F.count("h").alias("n"))
    row = parts.agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {most + 1})").alias("top"), F.sum("n").alias("n")).first()
    if not row["n"]:
        return {}
    limit = share * row["n"]
    return {item["item"]: max(2, -(-item["count"] // max(1, int(limit)))) for item in row["top"] if item["item"] is not None and item["count"] >= 0.9 * limit}


def sub_keys(keys: Sequence[Column | str], hot: HotKeys) -> Column:
    """How many sub-keys the key of a row has: 1 but for hot ones."""
    table = F.create_map(*[F.lit(v) for h, n in sorted(hot.items()) for v in (h, n)])
    return F.coalesce(F.element_at(table, F.xxhash64(*keys)), F.lit(1))


def _varied(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """A few columns that tell rows of one key apart and are the same whenever a task runs again.

    Numbers and times that are exact, or else texts: a floating sum may come out otherwise in another order. Few,
    because hashed columns must be read even where nothing else needs them.
    """
    others = [f for f in df.schema.fields if f.name not in keys]
    exact = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)
    steady = [f.name for f in others if isinstance(f.dataType, exact)]
    return steady[:4] or [f.name for f in others if isinstance(f.dataType, T.StringType)][:2]


def _dealt(fact: DataFrame, keys: Sequence[str], hot: HotKeys) -> tuple[DataFrame, bool]:
    """``fact`` with a sub-key for each row, and whether equal rows were put together for it."""
    varied = _varied(fact, keys)
    if varied:
        return fact.withColumn(_SALT, F.pmod(F.xxhash64(*varied), sub_keys(keys, hot)).cast("int")), False
    # nothing tells the rows of a key apart: count them, and deal pieces of the count
    counted = fact.groupBy(*fact.columns).agg(F.count("*").alias("__n"))
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / _TOGETHER)))
    pieces = counted.withColumn("__piece", piece)
    rows = F.least(F.lit(_TOGETHER).cast("long"), F.col("__n") - F.col("__piece") * _TOGETHER)
    salted = pieces.withColumn(_SALT, F.pmod("__piece", sub_keys(keys, hot)).cast("int")).withColumn("__rows", rows)
    return salted.drop("__n", "__piece"), True


def copied(dim: DataFrame, keys: Sequence[str], hot: HotKeys) -> DataFrame:
    """``dim`` with each row of a hot key once for each of its sub-keys."""
    return dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), sub_keys(keys, hot) - 1)))


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Attach ``dim`` to ``fact`` by equal keys (``left`` or ``inner``).

    An equi-join. With ``hot`` (see :func:`hot_keys`) facts of these keys go to as many tasks as they have
    sub-keys, by a hash of other columns, and rows of ``dim`` of these keys are copied for them; all other rows
    are joined by their keys. Facts that consist of their keys are counted, dealt and repeated after the join.
    """
    keys = _keys(on)
    if how not in ("left", "inner"):
        raise ValueError("lookup keeps the fact side: use left or inner")
    left, right, together = fact, dim, False
    if hot:
        left, together = _dealt(fact, keys, hot)
        right = copied(dim, keys, hot)
    renamed = {key: f"__dim_{key}" for key in [*keys, _SALT]}
    right = right.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for key in keys:
        a, b = F.col(key), F.col(renamed[key])
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    if hot:
        condition = condition & (F.col(_SALT) == F.col(renamed[_SALT]))
    joined = left.join(right, condition, how).drop(*renamed.values(), _SALT)
    if together:
        joined = joined.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__rows")))).drop("__row", "__rows")
    return joined


def exclude(df: DataFrame, listed: DataFrame, on: str | Sequence[str], hot: HotKeys | None = None) -> DataFrame:
    """Rows without a partner in ``listed``; rows with a NULL key stay. ``hot`` as in :func:`lookup`."""
    keys = _keys(on)
    partners = listed.select(*keys).distinct()
    if not hot:
        return df.join(partners, keys, "left_anti")
    left, together = _dealt(df, keys, hot)
    kept = left.join(copied(partners, keys, hot), [*keys, _SALT], "left_anti")
    if together:
        kept = kept.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__rows"))))
    return kept.select(*df.columns)


def spread_over_all(totals: DataFrame, shares: DataFrame, slices: int | None = None) -> DataFrame:
    """Every total paired with every share row, as an equi-join on slices.

    The output is the product by definition. Totals are dealt into slices, as many as the session has shuffle
    partitions, and each share row is repeated once per slice, so the work is split by key rather than done as one
    nested loop.
    """
    slices = slices or int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = totals.withColumn("__slice", F.pmod(F.xxhash64(*totals.columns), F.lit(slices)).cast("int"))
    repeated = shares.withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return dealt.join(repeated, "__slice").drop("__slice")
