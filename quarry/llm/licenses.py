"""Licence scan: Aho-Corasick for tags and notices, shunting-yard for expressions.

One automaton holds the notice phrases (as words between single spaces) and one
the identifier tags. The text after an identifier tag is read as an expression
of licence ids with ``and``, ``or``, ``with`` and parentheses, by Dijkstra's
shunting-yard algorithm; its ids become labels when the expression is well formed.
Where the whole line is not, its longest well-formed beginning is the expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The base phrases of the contract and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# The method's own notice phrases.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:", "licence-identifier:")

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
GAP = re.compile(r"[\s\"'`]*")
CUT = re.compile(r"[\w:]")
RANK = {"or": 1, "and": 2, "with": 3}


def parse(expression: str) -> tuple[list[str], bool] | None:
    """(sorted licence ids, whether one licence can be chosen freely) of an expression.

    The ids after ``with`` are exceptions and no licences. None if it is not well formed.
    """
    out: list[tuple[frozenset, bool]] = []
    stack: list[str] = []

    def apply(op: str) -> bool:
        if len(out) < 2:
            return False
        b, a = out.pop(), out.pop()
        out.append((a[0], a[1]) if op == "with" else (a[0] | b[0], op == "or" or a[1] or b[1]))
        return True

    operand = False  # the last token ended an operand
    for m in TOKEN.finditer(expression):
        token = m[0]
        if token == "(":
            if operand:
                return None
            stack.append(token)
        elif token == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                if not apply(stack.pop()):
                    return None
            if not stack:
                return None
            stack.pop()
        elif token in RANK:
            if not operand:
                return None
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[token]:
                if not apply(stack.pop()):
                    return None
            stack.append(token)
            operand = False
        else:
            if operand:
                return None
            out.append((frozenset([token.rstrip(".")]), False))
            operand = True
    if not operand:
        return None
    while stack:
        op = stack.pop()
        if op == "(" or not apply(op):
            return None
    return sorted(out[0][0]), out[0][1]


def beginning(line: str) -> str:
    """The longest well-formed expression at the begin of ``line``; empty if none.

    It ends before the first token that cannot continue it, and at a full stop or
    other mark; what is cut off an id (``x_y``, ``x:y``) is no token.
    """
    first = at = end = depth = 0
    operand = False
    for k, m in enumerate(TOKEN.finditer(line)):
        token = m[0]
        if k == 0:
            first = m.start()
        elif GAP.fullmatch(line, at, m.start()) is None:
            break
        at = m.end()
        if token == "(":
            if operand:
                break
            depth += 1
        elif token == ")":
            if not operand or not depth:
                break
            depth -= 1
        elif token in RANK:
            if not operand:
                break
            operand = False
        else:
            if operand or CUT.match(line, at):
                break
            operand = True
        if operand and not depth:
            end = at
        if token[-1] == ".":
            break
    return line[first:end]


@lru_cache(maxsize=1)
def _automata():
    import ahocorasick

    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**BASE, **NOTICES}.items():
        phrases.add_word(f" {phrase} ", (phrase, label))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan(text: str | None) -> tuple:
    """The result columns of one text."""
    low = (text or "").encode("utf-8", "replace").lower().decode()  # bytes: A-Z only
    words = WORD.findall(low)
    plain = f" {' '.join(words)} "
    phrases, tags = _automata()
    places: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    expressions: list[str] = []
    at = counted = 0
    for end, (phrase, label) in phrases.iter(plain):
        start = end - len(phrase) - 1
        if start > at:  # places come by their ends, so mostly forward
            counted += plain.count(" ", at, start)
            at = start
            index = counted
        else:
            index = counted - plain.count(" ", start, at)
        labels.add(label)
        if phrase in BASE:
            base.add(label)
            places.append(index)
    if ":" in low:
        for end, _ in tags.iter(low):
            stop = low.find("\n", end)
            line = low[end + 1:] if stop < 0 else low[end + 1:stop]
            found = parse(line)
            if not found:
                line = beginning(line)
                found = parse(line)
            if found:
                labels.update(found[0])
                expressions.append(line.strip().rstrip("."))
    score = 1.0 if expressions else min(1.0, 0.6 + 0.1 * len(places)) if base else 0.5 if labels else 0.0
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, ";".join(expressions))


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("expressions", T.StringType())])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` (``SCHEMA``).

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are
    their least and greatest word numbers (null if none). A null text counts as
    empty. Other columns are ignored.
    """
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*found, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]], names=SCHEMA.names)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(run, SCHEMA)
