"""Applying an expensive function once per distinct text."""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.text import joined_words
from verdigris.operators.joins import lookup

Scorer = Callable[[pd.Series], Sequence]


def score_distinct(
    df: DataFrame, columns: Sequence[str], scorer: Scorer | Callable[[Column], Column], result: str, kind: str = "string", native: bool = False
) -> DataFrame:
    """Join the words of ``columns`` into a title and score each distinct title once.

    ``scorer`` maps a batch of titles to scores (an Arrow batch at a time), or is
    a Column function with ``native=True``. Titles are de-duplicated before the
    call; scores come back over a join that tolerates a very frequent title.
    """
    titled = df.withColumn("__title", joined_words(columns))
    if native:
        return titled.withColumn(result, scorer(F.col("__title"))).drop("__title")

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"__title": frame["__title"], result: scorer(frame["__title"])})

    scored = titled.select("__title").distinct().mapInPandas(batches, f"__title string, `{result}` {kind}")
    return lookup(titled, scored, "__title").drop("__title")
