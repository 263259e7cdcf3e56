"""License scans: phrases by Aho-Corasick, licence expressions by a shunting-yard parser.

One automaton finds base phrases, notice phrases and identifier tags in the normalised words of a
document in a single pass; the text after each ``SPDX-License-Identifier:`` tag is then parsed as an
expression of licence ids with AND, OR, WITH and parentheses.

Defined results: null text is empty (no words, no labels, score 0); an expression that does not parse
gives its first word, if that is an id; words that are no ids (``MIT and see below``) give no labels; an empty
table gives no rows; a text of any length is scanned whole, in time that grows with its length; repeated rows are scanned alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER_ASCII, WORD

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notice phrases (as normalised words) of well-known licences and their labels.
NOTICES = {
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
#: An expression is read from the tag to the end of its line.
_TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)")
_PIECE = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*(?::[a-z0-9][a-z0-9.+-]*)?")
_WORDS = re.compile(WORD).findall
# Operators of licence expressions, the tighter the higher.
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
# What an id's family is called among the labels.
FAMILIES = {"mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "mpl": "mpl"}


# First parts of licence ids; a word of a tag line with neither a digit nor such a part is no id.
KNOWN = set(
    "afl agpl apache artistic beerware bsd bsl cc cddl cecill curl ecl epl eupl gfdl gpl ipl isc lgpl libpng licenseref mit mpl ms "
    "mulanpsl ncsa ntp odbl ofl openssl osl pddl php postgresql psf python ruby unlicense upl vim wtfpl zlib zpl".split()
)
# First parts of the ids of licences without a duty to share changes.
PERMISSIVE = set(
    "0bsd afl apache beerware bsd bsl cc0 curl ecl isc libpng mit ncsa ntp openssl php postgresql psf python unlicense upl vim w3c wtfpl x11 zlib".split()
)


def is_id(word: str) -> bool:
    """Whether a word after a tag can be a licence id."""
    return any(c.isdigit() for c in word) or re.split(r"[-.+:]", word)[0] in KNOWN


def is_permissive(word: str) -> bool:
    return re.split(r"[-.+:]", word)[0] in PERMISSIVE


def parse(expression: str) -> tuple | None:
    """Shunting-yard: nested (operator, left, right) tuples over ids, or None if it is not an expression.

    Reads pieces until something that cannot continue the expression; comment ends are not pieces.
    """
    values: list = []
    operators: list[str] = []

    def reduce() -> bool:
        if len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        values.append((operators.pop(), left, right))
        return True

    wants_value = True
    for piece in _PIECE.findall(expression):
        if piece == "(":
            if not wants_value:
                break
            operators.append(piece)
        elif piece == ")":
            if wants_value:
                return None
            while operators and operators[-1] != "(":
                if not reduce():
                    return None
            if not operators:
                break
            operators.pop()
        elif piece in PRECEDENCE:
            if wants_value:
                return None
            while operators and operators[-1] != "(" and PRECEDENCE[operators[-1]] >= PRECEDENCE[piece]:
                if not reduce():
                    return None
            operators.append(piece)
            wants_value = True
        else:
            if not wants_value:
                break
            values.append(piece)
            wants_value = False
    while operators:
        if operators[-1] == "(" or not reduce():
            return None
    return values[0] if len(values) == 1 else None


def ids(tree) -> list[str]:
    """Licence ids of a parsed expression, from left to right; exceptions after WITH are no licences."""
    found, left = [], [tree]
    while left:
        tree = left.pop()
        if isinstance(tree, str):
            found.append(tree)
            continue
        operator, one, other = tree
        if operator != "with":
            left.append(other)
        left.append(one)
    return found


def written(tree) -> str:
    """A parsed expression in normal form: single spaces, no parentheses beyond those it needs."""
    found, left = [], [(tree, 0)]
    while left:
        tree, around = left.pop()
        if isinstance(tree, str):
            found.append(tree)
            continue
        operator, one, other = tree
        own = PRECEDENCE[operator]
        parts = [(one, own), (f" {operator} ", 0), (other, own + (operator == "with"))]
        left += reversed([("(", 0), *parts, (")", 0)] if own < around else parts)
    return "".join(found)


def choices(tree) -> list[frozenset[str]]:
    """Evaluates an expression: the sets of licences (id, or id with exception) that satisfy it, fewest first.

    Their number may grow as two to the number of alternatives, so scans do not ask for them.
    """
    values: list[set[frozenset[str]]] = []
    left = [(tree, False)]
    while left:
        tree, ready = left.pop()
        if isinstance(tree, str):
            values.append({frozenset([tree])})
            continue
        operator, one, other = tree
        if not ready:
            left += [(tree, True), (one, False)] if operator == "with" else [(tree, True), (other, False), (one, False)]
        elif operator == "with":
            values.append({frozenset(f"{x}-with-{written(other)}" for x in s) for s in values.pop()})
        else:
            right = values.pop()
            values.append(values.pop() | right if operator == "or" else {a | b for a in values.pop() for b in right})
    return sorted(values[0], key=lambda s: (len(s), sorted(s)))


def allows(tree, accepted: Callable[[str], bool]) -> bool:
    """Evaluates an expression: whether accepted licences alone satisfy it. An exception after WITH takes nothing away."""
    values: list[bool] = []
    left = [(tree, False)]
    while left:
        tree, ready = left.pop()
        if isinstance(tree, str):
            values.append(accepted(tree))
        elif tree[0] == "with":
            left.append((tree[1], False))
        elif not ready:
            left += [(tree, True), (tree[2], False), (tree[1], False)]
        else:
            right, first = values.pop(), values.pop()
            values.append(first or right if tree[0] == "or" else first and right)
    return values[0]


@cache
def _automaton() -> ahocorasick.Automaton:
    """Phrases between spaces -> (is a base phrase, label, words)."""
    a = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, TAG: None}:
        a.add_word(f" {phrase} ", (BASE.get(phrase), NOTICES.get(phrase), phrase == TAG))
    a.make_automaton()
    return a


def scan(text: str | None) -> dict:
    """All findings of one text: base places, labels, expressions, and a score that grows with the evidence."""
    lowered = (text or "").translate(LOWER_ASCII)
    found = _WORDS(lowered)
    joined = f" {' '.join(found)} "
    places, base, labels, tagged, notices = [], set(), set(), False, 0
    at, counted = 0, -1  # words begun before character ``at`` of joined
    for end, (own, notice, tag) in _automaton().iter(joined):
        if own:
            labels.add(own)
            base.add(own)
            phrase = next(p for p, label in BASE.items() if label == own)
            begin = end - len(phrase) - 1
            if begin < at:
                at, counted = 0, -1
            counted += joined.count(" ", at, begin + 1)
            at = begin + 1
            places.append(counted)
        if notice:
            labels.add(notice)
            notices += 1
        tagged |= tag
    expressions = []
    if tagged:
        for line in _TAG_LINE.findall(lowered):
            tree = parse(line)
            named = ids(tree) if tree is not None else [p for p in _PIECE.findall(line)[:1] if p not in {*PRECEDENCE, "(", ")"}]
            named = [one for one in named if is_id(one)]
            if tree is not None and named:
                expressions.append(tree)
            for one in named:
                labels.add(one)
                family = FAMILIES.get(re.split(r"[-.0-9+]", one)[0])
                if family:
                    labels.add(family)
    evidence = len(places) + notices + 2 * len(expressions)
    return {
        "n_words": len(found), "places": places, "base_labels": sorted(base), "labels": sorted(labels),
        "expressions": [written(t) for t in expressions],
        "permissive": all(allows(t, is_permissive) for t in expressions) if expressions else None,
        "score": 1 - 0.5**evidence if labels else 0.0,
    }


_SCHEMA = (
    "struct<n_words:bigint,places:array<bigint>,base_labels:array<string>,labels:array<string>,"
    "expressions:array<string>,permissive:boolean,score:double>"
)


def with_licenses(docs: DataFrame, text: str = "text", into: str = "licenses") -> DataFrame:
    """Adds a struct column: n_words, places of base phrases (word numbers), labels, expressions, permissive, score.

    ``permissive`` says whether permissive licences alone satisfy every expression of the text; null without one.
    """
    if into.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column already there: {into}")
    kind = pa.struct(
        [("n_words", pa.int64()), ("places", pa.list_(pa.int64())), ("base_labels", pa.list_(pa.string())),
         ("labels", pa.list_(pa.string())), ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_()), ("score", pa.float64())]
    )

    @F.arrow_udf(_SCHEMA)
    def infer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([scan(t.as_py()) for t in texts], kind)

    return docs.withColumn(into, infer(F.col(text).cast("string")))
