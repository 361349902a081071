"""Language identification with bit-sliced Bloom filters of n-grams (operator 2).

The filters of all languages lie side by side: a row of the table has a bit for
each language, so one look-up with three hashes gives all languages that know an
n-gram. The bits are counted by language over all n-grams of a text; counts are
corrected for the false positives of each filter, and the highest share of known
n-grams decides.

The n-grams are four bytes of the UTF-8 text, ASCII letters in lower case and all
other ASCII characters as blanks. A language knows an n-gram that at least
``MIN_SHARE`` of its texts have, unless the share of another language's texts is
``MOST_RATIO`` times as high. The filters are learned from at most about ``SAMPLE_ROWS``
labelled texts of each language, drawn by a hash of the id.

Defined cases: a null text and one without a letter is ``und`` with score 0; so
is every text if nothing was learned; equal shares go to the language first in
code point order; texts are read whole at any length; repeated rows are kept; an
empty table gives an empty one. Input columns with the name of a result column
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillwatch.llm.arrays import Piece, mixed, pieces
from tillwatch.llm.shared import set_aside, unit_hash, without

SAMPLE_ROWS = 3000  # of each language
MIN_SHARE = 1e-3  # of the texts: bounds what is learned to 1,000 times the n-grams of a text
MOST_RATIO = 20
MOST_BROADCAST = 10_000  # languages, with their number of rows
HASHES = 3
ROWS_PER_GRAM = 8
SLICE = 64  # languages in a table
UNKNOWN = "und"
LEAST_SCORE = 0.1  # texts of no learned language stay below, and short ones of a thinly learned language above
COLUMNS = ("lang_pred", "score")

FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Filters:
    """``tables`` has a table for every 64 languages; ``rates`` the share of false positives of each language."""

    languages: list[str]
    tables: list[np.ndarray]
    rates: np.ndarray


def grams(p: Piece) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a piece as 32-bit numbers, and the offsets of each text's. Two blanks go around a text."""
    n, lengths = len(p), np.diff(p.offsets)
    padded = np.full(len(p.data) + 2 * n + 2, 0x20, np.uint8)
    padded[np.arange(len(p.data)) + np.repeat(2 * np.arange(1, n + 1), lengths)] = FOLD[p.data]
    wide = padded.astype(np.uint32)
    packed = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    # The text and its four blanks have length + 1 n-grams; the one after them would reach into the next text.
    inside = np.ones(len(packed) + 1, bool)
    starts = p.offsets + 2 * np.arange(n + 1)
    inside[starts[1:] - 1] = False
    return packed[inside[:-1]], p.offsets + np.arange(n + 1)


def rows_of(values: np.ndarray, size: int) -> list[np.ndarray]:
    """The table rows of n-grams, one array for each hash; ``size`` is a power of two."""
    first = mixed(values.astype(np.uint64) + np.uint64(1))
    bits = size.bit_length() - 1
    return [((first >> np.uint64(i * 21)) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def labelled(id_column: Column, lang: Column, folds: int = 5) -> Column:
    return lang.isNotNull() & ~held_out(id_column, folds)


def held_out(id_column: Column, folds: int = 5, fold: int = 0) -> Column:
    remainder = F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % folds
    return remainder == fold


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, text) as (lang, gram, n), the number of texts with the n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
            for row, piece in pieces(batch.column(1)):
                packed, offsets = grams(piece)
                of = np.repeat(np.arange(len(piece), dtype=np.uint64), np.diff(offsets))
                once = np.unique(of << np.uint64(32) | packed)
                lang = codes[row:row + len(piece)][(once >> np.uint64(32)).astype(np.int64)]
                keys, n = np.unique(lang << np.uint64(32) | once & np.uint64(0xFFFFFFFF), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array((keys >> np.uint64(32)).astype(np.int32))),
                     pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, min_share: float = MIN_SHARE) -> Filters:
    """Filters from ``docs`` (doc_id, lang, text); rows without a language are left out."""
    docs = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    sizes = docs.groupBy("lang").agg(F.count("*").alias("_n"))
    if sizes.count() <= MOST_BROADCAST:
        sizes = F.broadcast(sizes)
    drawn = docs.join(sizes, "lang").filter(unit_hash(F.col("doc_id"), "lang") < F.lit(sample_rows) / F.col("_n"))
    counts = counted(drawn)
    totals = drawn.groupBy("lang").agg(F.count("*").alias("_total"))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("_total"))
    top = shares.groupBy("gram").agg(F.max("share").alias("_top"))
    known = (
        shares.filter(F.col("share") >= min_share).join(top, "gram")
        .filter(F.col("share") * MOST_RATIO >= F.col("_top")).select("lang", "gram").toPandas()
    )
    return built(known["lang"].to_numpy(), known["gram"].to_numpy())


def built(langs: np.ndarray, values: np.ndarray) -> Filters:
    languages = sorted(set(langs))
    code = {lang: i for i, lang in enumerate(languages)}
    codes = np.array([code[lang] for lang in langs], np.int64)
    most = int(np.bincount(codes).max()) if len(codes) else 1
    size = max(1 << 10, 1 << int(np.ceil(np.log2(most * ROWS_PER_GRAM))))
    tables = []
    for first in range(0, len(languages), SLICE):
        width = min(SLICE, len(languages) - first)
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if width <= np.iinfo(k).bits)
        table = np.zeros(size, kind)
        here = (codes >= first) & (codes < first + SLICE)
        bits = np.left_shift(np.ones(here.sum(), kind), (codes[here] - first).astype(kind), dtype=kind)
        for rows in rows_of(values[here], size):
            np.bitwise_or.at(table, rows, bits)
        tables.append(table)
    slices = [tables[i // SLICE] for i in range(len(languages))]
    filled = [np.mean((t >> t.dtype.type(i % SLICE)) & t.dtype.type(1)) for i, t in enumerate(slices)]
    return Filters(languages, tables, np.array(filled) ** HASHES)


def shares(p: Piece, filters: Filters) -> np.ndarray:
    """For each text and language, the share of n-grams that the language knows, corrected for false positives."""
    packed, offsets = grams(p)
    rows = rows_of(packed, len(filters.tables[0]))
    n = np.diff(offsets)
    counts = np.empty((len(p), len(filters.languages)))
    for first, table in zip(range(0, len(filters.languages), SLICE), filters.tables):
        found = table[rows[0]]
        for more in rows[1:]:
            found &= table[more]
        for i in range(first, min(first + SLICE, len(filters.languages))):
            sums = np.zeros(len(found) + 1, np.int32)
            np.cumsum((found >> table.dtype.type(i - first)) & table.dtype.type(1), out=sums[1:], dtype=np.int32)
            counts[:, i] = sums[offsets[1:]] - sums[offsets[:-1]]
    known = (counts - n[:, None] * filters.rates) / (1 - np.minimum(filters.rates, 0.99))
    return np.clip(known / n[:, None], 0, 1)


def lettered(p: Piece) -> np.ndarray:
    """Whether each text has a letter."""
    ascii_letter = (FOLD[p.data] >= 0x61) & (FOLD[p.data] < 0x80)
    found = p.per_text(ascii_letter) > 0
    for i in np.flatnonzero(~found & (p.per_text(p.data >= 0x80) > 0)):
        text = p.data[p.offsets[i]:p.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` (text, ...) with ``lang_pred`` and ``score``, the share of n-grams that the language knows."""
    docs = without(docs, *COLUMNS)
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # 8 to 16 bytes for each n-gram learned, at most
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        labels = pa.array([*known.languages, UNKNOWN])
        for batch in batches:
            for row, piece in pieces(batch.column(names.index("text"))):
                best, score = np.full(len(piece), len(known.languages)), np.zeros(len(piece))
                if known.languages:
                    found = shares(piece, known)
                    some = lettered(piece)
                    best = np.where(some, found.argmax(1), best)
                    score = np.where(some, found.max(1), 0.0)
                part = batch.slice(row, len(piece))
                yield pa.RecordBatch.from_arrays([*part.columns, labels.take(pa.array(best)), pa.array(score)],
                                                 names=[*names, *COLUMNS])

    return docs.mapInArrow(run, schema)


def identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` whose language is told by at least ``least_score`` of their n-grams, after learning from them."""
    filters = learn(docs.filter(labelled(F.col("doc_id"), F.col("lang"))))
    plain, back = set_aside(docs, *COLUMNS)
    judged = predict(plain, filters).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return judged.select(*plain.columns).withColumnsRenamed(back)
