"""License scans: phrases and SPDX tags by Aho-Corasick, expressions by a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from verdigris.llm.words import NOT_WORD, utf8

#: The phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: More phrases of notices, each with the label that the method adds.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "creative commons attribution": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "isc license": "isc",
    "unlicense": "unlicense",
}
#: The identifier tag, as words of the lower-cased text.
TAG = "spdx license identifier"

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)).translate(
    bytes(32 if b in NOT_WORD else b for b in range(256))
)
_EXPRESSION = re.compile(r"spdx-license-identifier\s*:[ \t]*", re.IGNORECASE)
_TOKEN = re.compile(r"[()\r\n]|[A-Za-z0-9][A-Za-z0-9.+-]*")
_OPERATORS = {"or": 1, "and": 2, "with": 3}

#: A licence (with its exception), or an operator, ``or`` or ``and``, between two trees.
Tree = str | tuple[str, "Tree", "Tree"]
Choices = frozenset[frozenset[str]]


def licences(tree: Tree) -> set[str]:
    """All licences named in a tree: its leaves."""
    found: set[str] = set()
    stack = [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            found.add(node)
        else:
            stack.extend(node[1:])
    return found


def parse(text: str, at: int = 0) -> Tree | None:
    """The tree of the SPDX expression that starts at ``at``, whatever its length; None if it is malformed.

    ``with`` adds an exception to the licence before it; it binds most, ``or`` least. Reading
    stops at the end of the line and at the first word that can't go on, as a comment's end.
    """
    output: list[Tree] = []
    stack: list[str] = []

    def apply() -> bool:
        name = stack.pop()
        if name == "(" or len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        if name == "with":
            named, exception = licences(left), licences(right)
            if len(named) != 1 or len(exception) != 1:
                return False
            output.append(f"{min(named)} with {min(exception)}")
        else:
            output.append((name, left, right))
        return True

    operand = False  # whether the last token ended an operand
    for token in _TOKEN.finditer(text, at):
        word = token[0].lower()
        if word in "\r\n":
            break
        if word == "(":
            if operand:
                break
            stack.append(word)
        elif word == ")":
            if not operand or "(" not in stack:
                break
            while stack[-1] != "(":
                if not apply():
                    return None
            stack.pop()
        elif word in _OPERATORS:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[word]:
                if not apply():
                    return None
            stack.append(word)
            operand = False
        else:
            if operand:
                break
            output.append(word)
            operand = True
    if not operand or "(" in stack:
        return None
    while stack:
        if not apply():
            return None
    return output[0] if len(output) == 1 else None


def evaluate(expression: str) -> Choices | None:
    """The sets of licences that satisfy an SPDX expression; None if it is malformed.

    ``or`` joins the choices, ``and`` unites each choice of one side with each of the other. Each
    ``and`` of alternatives multiplies the choices; the tree of ``parse`` says the same in the expression's length.
    """
    tree = parse(expression)
    if tree is None:
        return None
    output: list[Choices] = []
    stack: list[tuple[Tree, bool]] = [(tree, False)]
    while stack:
        node, ready = stack.pop()
        if isinstance(node, str):
            output.append(frozenset([frozenset([node])]))
        elif not ready:
            stack += [(node, True), (node[2], False), (node[1], False)]
        else:
            right, left = output.pop(), output.pop()
            output.append(left | right if node[0] == "or" else frozenset(a | b for a in left for b in right))
    return output[0]


def build_automaton():
    import ahocorasick

    found: dict[str, list[tuple[str, str, int]]] = {}
    for kind, phrases in (("base", BASE_PHRASES), ("more", MORE_PHRASES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            found.setdefault(f" {phrase} ", []).append((kind, label, phrase.count(" ") + 1))
    automaton = ahocorasick.Automaton()
    for phrase, entries in found.items():
        automaton.add_word(phrase, (len(phrase), entries))
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton) -> tuple:
    """One text: n_words, n_base, first and last place, base labels, all labels, score, expressions."""
    words = utf8(text).translate(_TO_WORDS).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, 0
    line = b" " + b" ".join(words) + b" "
    line = line.decode("utf-8", "surrogatepass")
    places: list[int] = []
    base: set[str] = set()
    more: set[str] = set()
    tags = 0
    at, seen = 0, 0  # blanks before ``at``
    for end, (size, entries) in automaton.iter(line):
        start = end - size + 1
        # matches come by their ends, so a start may lie before the last one
        seen += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        for kind, label, _ in entries:
            if kind == "base":
                places.append(seen)
                base.add(label)
            elif kind == "more":
                more.add(label)
            else:
                tags += 1
    score = 0.9 if base else 0.6 if more else 0.0
    valid = 0
    if tags:
        for match in _EXPRESSION.finditer(text):
            tree = parse(text, match.end())
            if tree is not None:
                valid += 1
                more |= licences(tree)
        score = 1.0 if valid else max(score, 0.3)
    first, last = (min(places), max(places)) if places else (None, None)
    labels = base | {label.replace(",", "") for label in more}
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, valid


COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_expressions long"
)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: words, places of the base phrases, labels and a score.

    Words are runs of 0-9, a-z (A-Z lowered) and characters from U+0080 on; a phrase counts where
    its words stand one after the other, whatever separates them. Score: 1 with a valid identifier
    expression, 0.9 with a base phrase, 0.6 with another phrase, 0.3 with a tag
    whose expression can't be read, else 0. Expressions are read to their end, each of several in a line. A null or empty text has no words,
    null places, empty labels, score 0. Null ids and repeated rows stay as they
    are; an empty table gives none. No shuffle; other columns are not read.
    """
    schema = f"{docs.select(id_column).schema[0].simpleString().replace(':', ' ', 1)}, {COLUMNS}"
    source = docs.select(docs[id_column], docs[text_column].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        kinds = (pa.int64(),) * 4 + (pa.string(),) * 2 + (pa.float64(), pa.int64())
        names = [part.split()[0] for part in COLUMNS.split(", ")]
        for batch in batches:
            rows = [scan(t, automaton) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            arrays = [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_column, *names])

    return source.mapInArrow(run, schema)
