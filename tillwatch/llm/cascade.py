"""Quality rules in a short-circuit cascade (operator 7).

A rule rejects texts by one statistic. Each is timed and its share of rejections
counted on a sample; rules then run in order of rejections per second, each on
the texts that the ones before it let pass. The order decides the time alone: a
text is kept if no rule rejects it.

The sample is drawn by a hash of the id, with ``SAMPLE_ROWS`` rows expected; it
serves the order of the rules and nothing else.

Defined cases: a null or empty text has no words, so it fails the base rule and
is not kept; texts of any length are read whole; repeated rows are judged alike;
with an empty table the rules keep their order. Input columns with the name of a
result column are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tillwatch.llm.arrays import LINE_FEED, Piece, pieces, segment_sums
from tillwatch.llm.shared import unit_hash, without

SAMPLE_ROWS = 1000
WINDOW = 5
MIN_WORDS = 10
MOST_REPEATED = 20  # percent of the words
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FLAGS = ("base_failed", "kept")

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def n_words(p: Piece) -> np.ndarray:
    return np.diff(p.word_offsets)


def word_chars(p: Piece) -> np.ndarray:
    return p.per_text(p.in_word & ((p.data & 0xC0) != 0x80))


def n_symbols(p: Piece) -> np.ndarray:
    return p.per_text(IS_SYMBOL[p.data])


def lines(p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the lines that hold a word."""
    starts, ends = p.runs(p.data != LINE_FEED)
    words = np.zeros(len(p.data) + 1, np.int64)
    np.cumsum(p.in_word, out=words[1:])
    held = words[ends] > words[starts]
    starts, ends = starts[held], ends[held]
    return starts, ends, np.searchsorted(p.offsets, starts, "right") - 1


def n_dup_lines(p: Piece) -> np.ndarray:
    starts, ends, texts = lines(p)
    hashes = p.span_hashes(starts, ends)
    order = np.lexsort((hashes, texts))
    again = (hashes[order][1:] == hashes[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    return np.bincount(texts[order][1:][again], minlength=len(p))


def n_repeat_words(p: Piece) -> np.ndarray:
    hashes, first, texts = p.windows(WINDOW)
    order = np.lexsort((hashes, texts))
    again = (hashes[order][1:] == hashes[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:][again]] = True
    repeated[order[:-1][again]] = True
    edges = np.zeros(len(p.word_hashes) + 1, np.int64)
    np.add.at(edges, first[repeated], 1)
    np.add.at(edges, first[repeated] + WINDOW, -1)
    return segment_sums(np.cumsum(edges[:-1]) > 0, p.word_offsets)


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes a piece and says for each of its texts whether it goes."""

    name: str
    rejects: Callable[[Piece], np.ndarray]


def many_symbols(p: Piece) -> np.ndarray:
    """Over 30 symbols for 100 words."""
    return 100 * n_symbols(p) > 30 * n_words(p)


def odd_words(p: Piece) -> np.ndarray:
    """Words of less than 2 or more than 20 characters on average."""
    chars, words = word_chars(p), n_words(p)
    return (chars < 2 * words) | (chars > 20 * words)


def many_equal_lines(p: Piece) -> np.ndarray:
    """Over 30 % of the lines equal an earlier one."""
    n = np.bincount(lines(p)[2], minlength=len(p))
    return 100 * n_dup_lines(p) > 30 * n


def few_letters(p: Piece) -> np.ndarray:
    """Under 80 % of the words have an ASCII letter or a character beyond ASCII."""
    letters = np.zeros(len(p.data) + 1, np.int64)
    np.cumsum(IS_LETTER[p.data], out=letters[1:])
    starts, ends = p.words
    with_letter = segment_sums(letters[ends] > letters[starts], p.word_offsets)
    return 100 * with_letter < 80 * n_words(p)


RULES = (
    Rule("many_symbols", many_symbols),
    Rule("odd_words", odd_words),
    Rule("many_equal_lines", many_equal_lines),
    Rule("few_letters", few_letters),
)


def subset(p: Piece, rows: np.ndarray) -> Piece:
    """A piece of the texts in ``rows`` alone."""
    lengths = np.diff(p.offsets)
    chosen = np.zeros(len(p), bool)
    chosen[rows] = True
    return Piece(p.data[np.repeat(chosen, lengths)], np.concatenate(([0], np.cumsum(lengths[chosen]))))


def verdicts(p: Piece, rules: Sequence[Rule], kept: np.ndarray | None = None) -> np.ndarray:
    """Whether each text passes all the rules; a rule sees what those before it let pass."""
    kept = np.ones(len(p), bool) if kept is None else kept.copy()
    rows, left = np.flatnonzero(kept), p
    for rule in rules:
        if not len(rows):
            break
        if len(rows) < len(left):
            left = subset(p, rows)
        out = rule.rejects(left)
        kept[rows[out]] = False
        rows = rows[~out]
    return kept


def measured(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds, rows and rejections of every rule on a sample of ``docs`` (doc_id, text)."""
    share = sample_rows / max(docs.count(), 1)
    sample = docs.filter(unit_hash(F.col("doc_id"), "rules") < share).select("text")

    def time_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, piece in pieces(batch.column(0)):
                for i, rule in enumerate(rules):
                    fresh = Piece(piece.data, piece.offsets)  # without what another rule has worked out
                    began = time.perf_counter()
                    rejected = int(rule.rejects(fresh).sum())
                    seconds = time.perf_counter() - began
                    yield pa.RecordBatch.from_pydict(
                        {"rule": [i], "seconds": [seconds], "n": [len(piece)], "rejected": [rejected]})

    timed = sample.mapInArrow(time_rules, "rule long, seconds double, n long, rejected long")
    sums = timed.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n"),
                                     F.sum("rejected").alias("rejected"))
    return [row.asDict() for row in sums.collect()]


def ordered(rules: Sequence[Rule], figures: Sequence[dict]) -> list[Rule]:
    """The rules by rejections per second, most first; without figures they keep their places."""
    rate = {f["rule"]: f["rejected"] / max(f["seconds"], 1e-9) for f in figures}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-rate.get(i, 0.0), i))]


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the counts, ``base_failed`` and ``kept``."""
    docs = without(docs, *COUNTS, *FLAGS)
    cascade = ordered(rules, measured(docs, rules, sample_rows))
    names = docs.columns
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in COUNTS],
                         *[StructField(c, BooleanType()) for c in FLAGS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in pieces(batch.column(names.index("text"))):
                counts = [f(piece) for f in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)]
                failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MOST_REPEATED * counts[0])
                kept = verdicts(piece, cascade, ~failed)
                part = batch.slice(row, len(piece))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(c.astype(np.int64)) for c in counts], pa.array(failed), pa.array(kept)],
                    names=[*names, *COUNTS, *FLAGS])

    return docs.mapInArrow(run, schema)


SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 4] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1)
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, cast(len(words) AS bigint) AS n_words,
    cast(length(array_to_string(words, '')) AS bigint) AS word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) AS bigint) AS n_symbols,
    cast(len(lines) AS bigint) AS n_lines,
    cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
    cast(coalesce(n, 0) AS bigint) AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered
  FROM split LEFT JOIN repeated USING (doc_id)),
based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > 30 * n_words) AND word_chars BETWEEN 2 * n_words AND 20 * n_words
    AND NOT (100 * n_dup_lines > 30 * n_lines) AND NOT (100 * n_lettered < 80 * n_words) AS kept
FROM based
"""
