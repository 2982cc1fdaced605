"""Longest substring match against a pattern table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.operators.dedup import keep_first
from verdigris.operators.joins import lookup

# up to here the patterns become one CASE expression inside the scan's stage
CASE_LIMIT = 256
# characters of an indexed substring
GRAM = 3


def longest_match(
    df: DataFrame,
    text: str,
    patterns: DataFrame,
    pattern: str,
    label: str,
    result: str,
    default: str = "misc.",
    case_limit: int = CASE_LIMIT,
) -> DataFrame:
    """Label of the longest pattern contained in the lower-cased text.

    Patterns are LIKE patterns as written. Equal lengths go to the alphabetically
    first pattern, then label. A small table (its size is counted, never assumed)
    becomes a CASE in order of length: no join and no shuffle. A larger one is
    joined by equality on rare substrings, see :func:`_by_rarest_gram`.
    """
    usable = patterns.select(F.col(pattern).alias("__pattern"), F.col(label).alias("__label")).filter(
        F.col("__pattern").isNotNull()
    )
    head = usable.limit(case_limit + 1).collect()
    if len(head) > case_limit:
        return _by_rarest_gram(df, text, usable, result, default)
    ranked = sorted(head, key=lambda row: (-len(row[0]), row[0], row[1] is None, row[1] or ""))
    if not ranked:
        return df.withColumn(result, F.lit(default))
    lowered = F.lower(F.col(text))
    case = None
    for row in ranked:
        hit, found = lowered.like(f"%{row[0]}%"), F.lit(row[1]).cast("string")
        case = F.when(hit, found) if case is None else case.when(hit, found)
    return df.withColumn(result, F.coalesce(case, F.lit(default)))


def _literal_runs(pattern: Column) -> Column:
    """Runs of a LIKE pattern without wildcards; a sign after a backslash stands for itself."""
    runs = F.split(pattern, r"(?<!\\)(?:\\\\)*[%_]")
    return F.filter(F.transform(runs, lambda r: F.regexp_replace(r, r"\\(.)", "$1")), lambda r: r != "")


def _grams(text: Column, size: Column | int) -> Column:
    """Substrings of ``size`` characters; none of a shorter text."""
    length = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - length + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, length))).otherwise(
        F.array().cast("array<string>")
    )


def _by_rarest_gram(df: DataFrame, text: str, patterns: DataFrame, result: str, default: str) -> DataFrame:
    """Match distinct texts to many patterns by an equi-join on each pattern's rarest substring, exactly.

    A pattern is indexed by that GRAM-character substring of its literal runs which the fewest texts have (shorter runs by
    themselves), so the candidates are few more than the hits. A pattern with a substring that no text has can't match and is dropped.
    Texts offer their substrings of those lengths, as far as a pattern has them. Candidates are verified with LIKE; the best one is
    joined back to the rows. Patterns of wildcards alone match by a text's length.
    """
    texts = df.select(F.lower(F.col(text)).alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    split = patterns.withColumn("__runs", _literal_runs(F.col("__pattern")))
    hits = _candidates(texts, split).filter(F.like(F.col("__text"), F.concat(F.lit("%"), F.col("__pattern"), F.lit("%"))))
    found = hits.select("__text", "__pattern", "__label").unionByName(_by_length(texts, split.filter(F.size("__runs") == 0)))
    best = keep_first(
        found, ["__text"], [F.length("__pattern").desc(), F.asc("__pattern"), F.asc_nulls_last("__label")]
    ).select("__text", "__label")
    tagged = lookup(df.withColumn("__text", F.lower(F.col(text))), best, "__text")
    return tagged.withColumn(result, F.coalesce("__label", F.lit(default))).drop("__text", "__label")


def _candidates(texts: DataFrame, split: DataFrame) -> DataFrame:
    """(__text, __pattern, __label, __gram): texts that have the rarest substring of a pattern."""
    longest = F.array_max(F.transform("__runs", F.length))
    sized = split.filter(F.size("__runs") > 0).withColumn("__size", F.least(longest, F.lit(GRAM)))
    parts = sized.withColumn("__grams", F.flatten(F.transform("__runs", lambda r: _grams(r, F.col("__size")))))
    keyed = parts.select("__pattern", "__label", F.explode(F.array_distinct("__grams")).alias("__gram"))

    wanted = keyed.select("__gram").distinct()
    sizes = wanted.agg(F.collect_set(F.length("__gram")).alias("s")).scalar()
    offered = F.flatten(F.transform("__sizes", lambda size: _grams(F.col("__text"), size)))
    grams = texts.withColumn("__sizes", sizes).select("__text", F.explode(F.array_distinct(offered)).alias("__gram"))
    grams = grams.join(wanted, "__gram", "left_semi")

    counts = grams.groupBy("__gram").agg(F.count("*").alias("__n"))
    rarest = (
        lookup(keyed, counts, "__gram")
        .groupBy("__pattern", "__label")
        .agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram").alias("gram"))).alias("__least"))
        .filter("__least.n > 0")
        .select("__pattern", "__label", F.col("__least.gram").alias("__gram"))
    )
    return lookup(grams, rarest, "__gram", how="inner")


def _by_length(texts: DataFrame, wild: DataFrame) -> DataFrame:
    """The best pattern of wildcards alone for each text: it asks for as many characters as it has underscores.

    Of each number of underscores one pattern is kept, so the list is as long as there are numbers.
    """
    needs = wild.withColumn("__needs", F.length(F.regexp_replace("__pattern", "[^_]", "")))
    one = keep_first(needs, ["__needs"], [F.length("__pattern").desc(), F.asc("__pattern"), F.asc_nulls_last("__label")])
    entry = F.struct("__needs", (-F.length("__pattern")).alias("o"), F.col("__pattern").alias("p"), F.col("__label").isNull().alias("z"), F.col("__label").alias("l"))
    listed = one.agg(F.collect_list(entry).alias("w")).scalar()
    fitting = F.filter("__wild", lambda w: w["__needs"] <= F.length("__text"))
    ranked = F.array_min(F.transform(fitting, lambda w: F.struct(w["o"].alias("o"), w["p"].alias("p"), w["z"].alias("z"), w["l"].alias("l"))))
    chosen = texts.withColumn("__wild", listed).withColumn("__best", ranked).filter(F.col("__best").isNotNull())
    return chosen.select("__text", F.col("__best.p").alias("__pattern"), F.col("__best.l").alias("__label"))
