"""Licence scans (operator 8).

One Aho-Corasick automaton finds licence phrases in the words of a text and
another one finds identifier tags (``SPDX-License-Identifier:``). The expression
after a tag is parsed by the shunting-yard method, with the precedence ``with``
over ``and`` over ``or``, and evaluated: it names licences, and it is permissive
if a permissive choice satisfies it.

Labels are those of the base phrases, those of further notice phrases, and
``spdx:`` with an identifier for each licence that a tag names. The score is the
evidence for a licence notice: 1 - 0.5 ^ (phrase places + 2 * tags).

Defined cases: a null or empty text has no words, no labels and score 0; an
expression that cannot be parsed gives the label ``spdx:invalid``; overlapping
places of one phrase all count; texts are read whole at any length; repeated
rows are kept; an empty table gives an empty one. Input columns with the name of
a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from tillwatch.llm.shared import without

# The base phrases and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Further notices: phrase and label.
NOTICES = {
    "mit license": "mit",
    "apache license": "apache",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons": "cc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
PERMISSIVE = ("0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc0-1.0", "cc-by-4.0", "isc", "mit", "unlicense",
              "zlib")
TAG = "spdx-license-identifier:"
# End of the fixed values.

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+|[\r\n]")
STRUCTURE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SCHEMA = (
    StructField("n_words", LongType()),
    StructField("n_base", LongType()),
    StructField("first_word", LongType()),
    StructField("last_word", LongType()),
    StructField("base_labels", StringType()),
    StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("permissive", BooleanType()),
)


def postfix(text: str, start: int = 0) -> list[str] | None:
    """Tokens of the expression at ``start`` in postfix order by the shunting-yard method; None if not well formed.

    The expression ends with its line. Tokens are read as they are needed, so that a long line with many tags is not
    read once for each of them.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in (found[0].lower() for found in TOKEN.finditer(text, start)):
        if token in "\r\n":
            break
        if token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in PRECEDENCE:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif not operand_next:
            break  # prose after the expression
        else:
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluated(text: str, start: int = 0) -> tuple[set[str], bool] | None:
    """Licences that the expression at ``start`` names, and whether a permissive choice satisfies it.

    None if it is not well formed.
    """
    order = postfix(text, start)
    if order is None:
        return None
    stack: list[tuple[set[str], bool]] = []
    for token in order:
        if token not in PRECEDENCE:
            stack.append(({token}, token.rstrip("+") in PERMISSIVE))
            continue
        (right, right_ok), (left, left_ok) = stack.pop(), stack.pop()
        if token == "with":  # an exception adds to what its licence allows and is no licence
            stack.append((left, left_ok))
        else:
            stack.append((left | right, left_ok and right_ok if token == "and" else left_ok or right_ok))
    return stack.pop()


def automaton(phrases: dict[str, object]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for phrase, value in phrases.items():
        built.add_word(phrase, (phrase, value))
    built.make_automaton()
    return built


class Scanner:
    """Both automata; made in each task."""

    def __init__(self) -> None:
        self.notices = automaton({f" {p} ": (label, p in BASE) for p, label in {**NOTICES, **BASE}.items()})
        self.tags = automaton({TAG: None})

    def scan(self, text: str | None) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(STRUCTURE).split(b" ")
        words = [w for w in words if w]
        joined = f" {b' '.join(words).decode('utf-8', 'replace')} "
        labels, base = set(), set()
        places = n_base = 0
        first, last = len(joined), -1  # characters before the blank that opens a base phrase
        for end, (phrase, (label, is_base)) in self.notices.iter(joined):
            places += 1
            labels.add(label)
            if is_base:
                base.add(label)
                n_base += 1
                first, last = min(first, end - len(phrase) + 1), max(last, end - len(phrase) + 1)
        tags, allowed = 0, []
        lowered = raw.translate(LOWER).decode("utf-8", "replace")
        for end, _ in self.tags.iter(lowered):
            tags += 1
            found = evaluated(lowered, end + 1)
            labels |= {"spdx:invalid"} if found is None else {f"spdx:{name}" for name in found[0]}
            allowed.append(found is not None and found[1])
        return (
            len(words), n_base, joined.count(" ", 0, first) if n_base else None,
            joined.count(" ", 0, last) if n_base else None, ",".join(sorted(base)),
            ",".join(sorted(labels | base)), 1 - 0.5 ** min(places + 2 * tags, 60), all(allowed) if allowed else None)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with the columns of ``SCHEMA``."""
    docs = without(docs, *[f.name for f in SCHEMA])
    names = docs.columns
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            found = zip(*map(scanner.scan, (t.as_py() for t in batch.column(names.index("text")))))
            made = [pa.array(list(values), kind) for values, kind in zip(found, kinds)]
            if made:
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, *[f.name for f in SCHEMA]])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *SCHEMA]))
