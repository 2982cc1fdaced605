"""The operators over the whole tables, as the queries of the driver's contract, and their checking SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verdigris.llm.collocations import SQL as COLLOCATION_SQL
from verdigris.llm.collocations import collocations
from verdigris.llm.column_bwt import SQL as REPEATED_BYTES_SQL
from verdigris.llm.column_bwt import remove_repeated_bytes
from verdigris.llm.compression_bands import compression_bands
from verdigris.llm.conversation_repair import repair
from verdigris.llm.conversation_sql import SQL as REPAIR_SQL
from verdigris.llm.html_templates import extract_main_text
from verdigris.llm.license_scan import license_scan
from verdigris.llm.markov_secrets import secret_report
from verdigris.llm.parity_join import jaccard_components
from verdigris.llm.sentencepiece_viterbi import round_trip
from verdigris.llm.shared import documents, pages
from verdigris.llm.suffix_dedup import remove_repeats
from verdigris.llm.token_orc import token_orc
from verdigris.llm.warc import archive_pages
from verdigris.llm.winnowing import winnow


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; the folder is that of its package unless VERDIGRIS_TOKENIZERS names another."""
    folder = os.environ.get("VERDIGRIS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands(documents(spark, sf_dir))


def op2_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(pages(spark, sf_dir))


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def op5_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op7_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(pages(spark, sf_dir))


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir)).drop("kept")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compression_bands,
        op2_parity_join,
        op3_warc,
        op4_markov_secrets,
        op5_sentencepiece_viterbi,
        op6_token_orc,
        op7_html_templates,
        op8_winnowing,
        op9_license_scan,
        op10_suffix_dedup,
        op11_collocations,
        op12_column_bwt,
        op13_conversation_repair,
    )
}

#: Words of the contract as DuckDB patterns.
_BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LETTER_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_parity_join": f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce({_BLANK_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, []) AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)
),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, y FROM reach JOIN links ON links.x = reach.other)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.other) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY 1
""",
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha256(h) AS d FROM p),
f AS (SELECT d, min(page_id) AS first FROM q WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, q.d AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM q LEFT JOIN f ON f.d = q.d
""",
    "op8_winnowing": f"""
WITH d AS (SELECT doc_id, coalesce({_LETTER_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id, {_LETTER_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM item_windows),
places AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size
),
hits AS (
    SELECT doc_id, i, p.size, item_id
    FROM places p JOIN item_windows k ON k.size = p.size AND k.g = array_to_string(w[i:i + p.size - 1], ' ')
),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY 1),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op10_suffix_dedup": f"""
WITH d AS (SELECT doc_id, coalesce({_BLANK_WORDS.format("text")}, []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
firsts AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
gone AS (
    SELECT doc_id, list(DISTINCT j) AS js
    FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN firsts USING (g) WHERE first < doc_id)
    GROUP BY 1
),
kept AS (
    SELECT d.doc_id, string_agg(word, ' ' ORDER BY i) AS body
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) d LEFT JOIN gone USING (doc_id)
    WHERE js IS NULL OR NOT list_contains(js, i)
    GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op11_collocations": COLLOCATION_SQL,
    "op12_column_bwt": REPEATED_BYTES_SQL,
    "op13_conversation_repair": REPAIR_SQL,
}
