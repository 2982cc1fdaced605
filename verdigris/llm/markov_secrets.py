"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything runs as column expressions: no Python on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's patterns. A run of hexadecimal digits or of an access key's
#: characters is as long as it can be, so its least length can stand in the pattern.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: What the models judge: runs of token characters with a digit in them.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Mean log-likelihood ratio of a transition, in nats, from which a candidate is a secret.
THRESHOLD = 0.9
#: Documents of which ordinary identifiers are taken to train on, and random strings of each kind.
TRAIN_DOCUMENTS = 2_000
TRAIN_STRINGS = 5_000
_FIRST, _SIGNS = 32, 96  # the characters of ASCII from the blank on


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratio of each transition, row by row of the first character."""

    ratios: tuple[float, ...]
    threshold: float = THRESHOLD

    @staticmethod
    def fit(ordinary: DataFrame, random: DataFrame, smoothing: float = 0.5) -> MarkovModels:
        """From samples of two labels, each a column ``text``; at most 96 * 96 counts come to the driver."""

        def counts(sample: DataFrame) -> dict[str, int]:
            places = F.sequence(F.lit(1), F.length("text") - 1)
            pairs = sample.where(F.length("text") > 1).select(F.explode(F.transform(places, lambda i: F.col("text").substr(i, F.lit(2)))).alias("pair"))
            pairs = pairs.where(F.col("pair").rlike(r"^[\x20-\x7F]{2}$"))
            return {r.pair: r.n for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}

        def logs(found: dict[str, int]) -> list[float]:
            total = [0.0] * _SIGNS
            for pair, n in found.items():
                total[ord(pair[0]) - _FIRST] += n
            return [
                math.log((found.get(chr(a + _FIRST) + chr(b + _FIRST), 0) + smoothing) / (total[a] + smoothing * _SIGNS))
                for a in range(_SIGNS)
                for b in range(_SIGNS)
            ]

        return MarkovModels(tuple(round(r - o, 3) for r, o in zip(logs(counts(random)), logs(counts(ordinary)))))

    def score(self, text: Column) -> Column:
        """Mean ratio over the transitions of a string of ASCII characters."""
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<double>")

        def code(i: Column) -> Column:
            return F.ascii(text.substr(i, F.lit(1))) - _FIRST

        steps = F.sequence(F.lit(1), F.length(text) - 1)
        total = F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.get(table, code(i) * _SIGNS + code(i + 1)))
        return total / (F.length(text) - 1)


def training_samples(docs: DataFrame, text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(ordinary, random): words of about TRAIN_DOCUMENTS documents chosen by a hash, without those that the
    fixed patterns match; and strings made by hashes, in Base64, alphanumeric and hexadecimal."""
    spark = docs.sparkSession
    text = docs.select(docs[text_column].alias("body")).where("body IS NOT NULL")
    # one of so many texts that about TRAIN_DOCUMENTS remain; copies count once
    every = max(1, docs.count() // TRAIN_DOCUMENTS)
    chosen = text.where(F.pmod(F.xxhash64("body"), F.lit(every)) == 0).distinct()
    bare = chosen.select(F.regexp_replace(F.regexp_replace("body", ASSIGN, " "), f"{ACCESS}|{HEX}", " ").alias("body"))
    words = F.regexp_extract_all("body", F.lit("([A-Za-z0-9_+/=-]{4,})"), 1)
    # an identifier often ends in a number of a few digits, or joins words
    word = bare.select(F.explode(words).alias("text"))
    joined = word.select(F.concat("text", F.lit("_"), F.pmod(F.xxhash64("text"), F.lit(2100)).cast("string")).alias("text"))
    digest = spark.range(TRAIN_STRINGS).select(F.sha2(F.col("id").cast("string"), 512).alias("h"))
    base64 = F.regexp_replace(F.base64(F.unhex("h")), r"\s", "")
    random = digest.select(base64.alias("text")).union(digest.select(F.regexp_replace(base64, "[+/=]", "").alias("text"))).union(digest.select("h"))
    return word.union(joined), random


def train(docs: DataFrame, text_column: str = "text") -> MarkovModels:
    return MarkovModels.fit(*training_samples(docs, text_column))


def _spans(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 0) -> Column:
    """Spans (start, rank, end, value) of all leftmost matches whose group has ``least`` characters.

    Spark tells the matches but not their places: these follow from the text between them.
    """
    rank = KINDS.index(kind)
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,rank:int,end:int,value:string>>")
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(f"({pattern})" if not value_group else pattern), 0).alias("whole"),
        F.regexp_extract_all(text, F.lit(f"({pattern})" if not value_group else pattern), value_group).alias("value"),
    )

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.coalesce(F.length(m["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), m["value"].alias("value"))
        return F.struct(
            end.alias("at"), F.when(F.length(m["value"]) >= max(1, least), F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found")
        )

    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(zipped, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_secrets(docs: DataFrame, models: MarkovModels, text_column: str = "text") -> DataFrame:
    """``docs`` with one column more, ``_secrets``: spans (start, rank of the kind, end, value), by start and kind.

    Code points, end exclusive. Spans of the models overlap no span of a fixed pattern. A null text
    has none. No shuffle; all columns of ``docs`` stay.
    """
    text = F.coalesce(docs[text_column], F.lit(""))
    base = F.concat(
        _spans(text, ASSIGN, "assign", 2, ASSIGN_LEAST),
        _spans(text, ACCESS, "access"),
        _spans(text, HEX, "hex"),
    )
    staged = docs.withColumn("_base_secrets", base).withColumn("_candidates", _spans(text, CANDIDATE, "markov"))
    kept = F.filter(
        "_candidates",
        lambda c: (~F.exists("_base_secrets", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))) & (models.score(c["value"]) >= models.threshold),
    )
    return staged.withColumn("_secrets", F.array_sort(F.concat("_base_secrets", kept))).drop("_base_secrets", "_candidates")


def secret_report(docs: DataFrame, models: MarkovModels | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, counts by kind, spans as text and the checksum of those of the fixed patterns.

    Null and empty texts have no spans; null ids and repeated rows stay; an empty table gives no
    rows (and untrained models, which nothing meets). Other columns are not read. No shuffle.
    """
    models = models or train(docs, text_column)
    narrow = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text"))
    found = find_secrets(narrow, models, "_text")

    def number(kind: str) -> Column:
        return F.size(F.filter("_secrets", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("_secrets", lambda s: s["rank"] < KINDS.index("markov"))
    return found.select(
        F.col("_id").alias(id_column),
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(F.col("_secrets")).alias("spans"),
        number("markov"),
    )


def redact(docs: DataFrame, models: MarkovModels | None = None, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; a text without secrets, or null, is unchanged.

    Spans that overlap are replaced as one. All other columns stay as they are.
    """
    models = models or train(docs, text_column)
    found = find_secrets(docs, models, text_column)
    text = F.col(text_column)

    def step(acc: Column, s: Column) -> Column:
        gap = text.substr(acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("_secrets", start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))
    return found.withColumn(text_column, F.when(F.size("_secrets") > 0, cleaned).otherwise(text)).drop("_secrets").select(*docs.columns)


def load_models(spark: SparkSession, path: str) -> MarkovModels:
    row = spark.read.parquet(path).first()
    return MarkovModels(tuple(row.ratios), row.threshold)


def save_models(spark: SparkSession, models: MarkovModels, path: str) -> None:
    spark.createDataFrame([(list(models.ratios), models.threshold)], "ratios array<double>, threshold double").write.parquet(path)
