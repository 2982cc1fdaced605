"""The word encoder's table stays right when words are dropped from it."""

from __future__ import annotations

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from verdigris.llm import shared, token_orc  # noqa: E402


def test_words_that_are_dropped_and_met_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_orc, "WORDS_KEPT", 20)
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), token_orc.WordEncoder(path)
    r = random.Random(1)
    words = ["the", "The,", "été!", "x1y", "🙂", "don't", "A" * 50, "--", "(a)", ""] + ["".join(r.choices("abcdeé", k=r.randint(1, 7))) + r.choice(["", ".", "%%%"]) for _ in range(90)]
    for _ in range(60):
        texts = [" ".join(r.choices(words[: r.choice([10, 100])], k=r.randint(0, 12))) for _ in range(4)]
        ids, starts = encoder.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids + [token_orc.END_ID] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == want
    assert len(encoder.uses) == len(encoder.table.number) and len(encoder.atoms.number) < 200


def test_kept_in_worker_makes_once():
    made = []
    key = ("test", object())
    assert [shared.kept_in_worker(key, lambda: made.append(1) or "x") for _ in range(3)] == ["x"] * 3 and made == [1]
