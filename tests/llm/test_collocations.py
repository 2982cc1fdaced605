"""Collocations against plain counting, and the sort against counting of prefixes."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from verdigris.llm import collocations

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, _rank long"


def plain(rows, reported=2000):
    counts, out = {}, []
    for _, text, lang, *_ in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        candidates = {w: c for w, c in f.items() if len(w) > 1 and c >= 30}
        inside = Counter()
        for w, c in candidates.items():
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    inside[w[i : i + k]] = max(inside[w[i : i + k]], c)
        found = []
        for w, a in candidates.items():
            score, k = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k) for k in range(1, len(w)))
            if 100 * inside[w] < 80 * a:
                found.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def made(seed=2):
    r = random.Random(seed)
    words = ["the", "Of", "été", "x-y", "'q'", "🙂", "a", "b", "ß", "\x1f", "New", "York", "city"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(500):
        text = "".join(r.choice(words[: r.choice([6, 53])]) + r.choice([" ", " ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for _ in range(r.randint(0, 60)))
        rows.append((i, text if i % 3 else "New York City hall " + text, r.choice(["en", "fr", None, "und", ""]), "clash", 1, 2))
    rows += [(1000, None, "en", None, 0, 0), (1001, "", "none", None, 0, 0), (1002, "a " * 30_000, "en", None, 0, 0), (None, "the " + "b a " * 500, None, None, 0, 0)]
    return rows + rows[5:40] + [(2000 + i, "one common passage stands here", "fr", None, 0, 0) for i in range(300)]


@pytest.mark.parametrize("settings", [{}, {"TASK_SUFFIXES": 200, "PART_BYTES": 500}, {"REPORTED": 7, "PART_BYTES": 3000}])
def test_collocations_equal_plain_counts(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(collocations, name, value)
    rows = made()
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, settings.get("REPORTED", 2000))


def test_without_rows_or_candidates(spark):
    df = spark.createDataFrame([(1, "only a few words", "en", "", 0, 0)], SCHEMA)
    assert collocations.collocations(df).collect() == []
    assert collocations.collocations(df.where("false")).collect() == []


def test_sorted_parts_are_the_frequent_prefixes():
    r = np.random.default_rng(4)
    symbols = np.where(r.random((4000, 4)) < 0.1, 0, r.zipf(1.4, (4000, 4)) % 50 + 1)
    for depth in range(1, 4):  # nothing stands behind an end
        symbols[:, depth] = np.where(symbols[:, depth - 1] == 0, 0, symbols[:, depth])
    symbols[symbols[:, 0] == 0, 0] = 7
    weights = r.integers(1, 4, 4000)
    counts = Counter()
    for row, weight in zip(symbols.tolist(), weights.tolist()):
        for depth in range(1, 5):
            if row[depth - 1]:
                counts[tuple(row[:depth])] += weight
    found = collocations.sorted_parts(symbols, weights, [30] * 4)
    assert {tuple(symbols[row, :depth].tolist()): count for row, depth, count in found} == {k: c for k, c in counts.items() if c >= 30}
    assert len(found) == len({tuple(symbols[row, :depth].tolist()) for row, depth, _ in found})


def test_exact_score_beyond_64_bits(spark):
    big = 4 * 10**15
    long = spark.createDataFrame([("en", "a b", 2, big - 1), ("en", "c d", 2, 30)], "lang string, phrase string, size int, f long")
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7), ("en", "c", 31), ("en", "d", 30)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    out = collocations._reported(long, long.select("lang", "phrase", "f").union(words), totals)
    assert {r["phrase"]: r["score"] for r in out.collect()} == {"a b": 2_000_000 * (big - 1) // (2 * big + 7), "c d": 2_000_000 * 30 // 61}
