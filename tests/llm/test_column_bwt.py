"""Byte-wise de-duplication against a search of all windows, and the transform against sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from verdigris.llm import column_bwt

SCHEMA = "doc_id long, text string, id long, start long, anchor string"


def plain(rows):
    """Windows in order of (id, start); rows of one id count as one document."""
    first = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for number, data in texts:
        for p in range(len(data) - 99) if number is not None else ():
            w = data[p : p + 100]
            if w not in first or (number, p) < first[w]:
                first[w] = (number, p)
    out = []
    for number, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - 99) if number is not None else ():
            if first[data[p : p + 100]] < (number, p):
                gone[p : p + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((number, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed=3):
    r = random.Random(seed)

    def words(k):
        return " ".join("".join(r.choices("aeiourstlnmdé", k=r.randint(2, 8))) for _ in range(k))

    passages = [words(40) for _ in range(4)]
    line = words(9)[:60]
    rows = [(0, None), (1, ""), (2, "short"), (3, "x" * 99), (4, "x" * 100), (5, "x" * 350), (6, "ab" * 200 + "c" + "ab" * 90), (None, passages[0]), (7, "🙂é" * 80)]
    for i in range(8, 90):
        text = words(r.randint(1, 60))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 60)
            at = r.randint(0, len(text))
            text = text[:at] + p[a : a + r.randint(60, 200)] + text[at:]
        if i % 4 == 0:  # one line that many share, shorter than a window
            text += line + words(30)
        rows.append((i, text))
    copy = rows[20][1] + words(50)
    rows += [(100 + i, copy) for i in range(30)]
    edited = words(120)
    rows += [(200 + i, edited[: 20 * i] + "#" + edited[20 * i :]) for i in range(20)]
    rows.append((300, (words(200) + passages[1] + words(900) + passages[2]) * 2))
    r.shuffle(rows)
    rows += [rows[3], rows[40], (41, words(40) + passages[3])]
    return [(*row, i, -i, "clash") for i, row in enumerate(rows)]


@pytest.mark.parametrize("settings", [{}, {"MOST_STRETCHES": 2, "TOGETHER": 3}, {"PART_BYTES": 512, "TOGETHER": 40}])
def test_equals_a_search_of_all_windows(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(column_bwt, name, value)
    rows = made()
    out = column_bwt.remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    found = out.collect()
    assert sorted((tuple(r[:5]) for r in found), key=str) == plain(rows)
    assert all(r["kept"] is None or hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)


def test_long_text_and_empty_table(spark):
    r = random.Random(8)
    once = "".join(r.choices("abcdefgh ", k=700_000))
    rows = [(1, once + "|" + once[200_000:400_000], 0, 0, ""), (2, "z" * 300_000, 0, 0, "")]
    out = {x["doc_id"]: tuple(x[1:4]) for x in column_bwt.remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {1: (900_001, 200_000, 1), 2: (300_000, 299_999, 1)}
    assert column_bwt.remove_repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n,longest,letters", [(1, 3, 1), (5, 12, 2), (30, 40, 2), (40, 60, 4), (9, 160, 1)])
def test_transform_equals_sorted_suffixes(n, longest, letters):
    r = random.Random(n)
    strings = [bytes(r.choices(range(97, 97 + letters), k=r.randint(0, longest))) for _ in range(n)]
    made = column_bwt.Transform([np.frombuffer(s, dtype=np.uint8) for s in strings])
    want = sorted((s[i:], k) for k, s in enumerate(strings) for i in range(len(s) + 1))
    found = {int(p): (strings[k][len(strings[k]) - size :], int(k)) for size, owner, place in made.places() for k, p in zip(owner, place)}
    assert [found[p] for p in range(len(want))] == want

    def shared(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    assert made.common.tolist() == [0] + [shared(a[0], b[0]) for a, b in zip(want, want[1:])]
    assert made.symbols.tolist() == [strings[k][len(strings[k]) - len(s) - 1] if len(s) < len(strings[k]) else 0 for s, k in want]


def test_masks_name_later_windows():
    r = random.Random(5)
    base = bytes(r.choices(range(97, 105), k=160))
    strings = [base[:130], base[20:160], b"x" * 163, base[:130], base[:60] + b"zz" + base[62:130]]
    # the anchor stands at 60 of the text, in the last one it is another one
    masks = column_bwt.repeated_windows(strings, np.array([60, 40, 63, 60, 60]), np.array([2, 1, 3, 2, 0]), np.array([0, 50, 9, 0, 0]), np.array([0, 0, 1, 0, 1]))
    # the second stands first: windows 20 to 30 of the first and the fourth are in it
    assert masks.tolist()[0] == sum(1 << k for k in range(20, 31)) and masks[1] == 0
    assert masks[2] == (1 << 64) - 2 and masks[3] == masks[0] and masks[4] == 0


def test_stretches_that_can_not_share_a_window_are_left_out():
    anchor, r = b"a" * column_bwt.ANCHOR, random.Random(6)

    def row(left, right, twice=False):
        return (7, r.random(), 0, 0, len(left), twice, left + anchor + right)

    def own(n):
        return bytes(r.choices(range(98, 120), k=n))

    left, right = own(32), own(32)
    near = [row(own(8) + left, own(31)), row(own(20) + left, own(40)), row(own(31), right + own(5)), row(own(40), right)]
    far = [row(own(63), own(63)), row(own(5) + left[1:], own(32)), row(own(31), own(32))]
    assert column_bwt._may_share(near + far) == near
    tied = row(own(63), own(63), True)
    assert column_bwt._may_share([tied, *far]) == [tied]
