"""Language-model scoring by masked pseudo-likelihood (operator 5).

A small network predicts every token of a text from the tokens on both sides.
The sum of the logarithms of these conditional probabilities is the text's
pseudo-likelihood, its score.

The words of all texts are counted in a table that grows with the corpus. A word
with at least ``OWN_SHARE`` of all occurrences is a class of its own, so there
are at most 1 / ``OWN_SHARE`` of these; the others share ``CLASSES`` classes by
their last bytes. The network predicts the class of a token from those of its
neighbours, and the table the word within its class:
P(word | sides) = P(class | sides) * count(word) / count(class).

The network sees every position of every text. All it needs of them is how often
each class stands between each pair of classes; Spark counts these exactly, and
numpy fits the weights to the counts, whose number has a bound that the input
does not move. So neither the cut into tasks nor the order of rows changes a
score: logarithms are added as whole millionths.

Defined cases: null texts and those without words have no tokens, a sum of 0 and
a null mean; a text of one word is predicted from the margins alone; a word that
was not counted is taken as counted once; texts are read whole at any length;
repeated rows count each; an empty table gives an untrained network and an empty
result. Input columns with the name of a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tillwatch.llm.arrays import Piece, pieces, segment_sums
from tillwatch.llm.shared import set_aside, staged, without

OWN_SHARE = 0.005  # of all words, from which on a word is a class of its own
CLASSES = 64  # of all other words
WIDTH = 24
STEPS = 200
RATE = 0.03
UNITS = 1_000_000  # logarithms are added in these parts of one
HELD = 1 << 20  # tokens that a task counts at a time
COLUMNS = ("n_tokens", "log_prob", "mean_log_prob")
INNER = ("_row", "_units", "_words", "_times", "_within")

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Model:
    own: np.ndarray  # hashes of the words that are classes, ascending
    units: np.ndarray  # [left, right, class]: logarithm of the class's probability
    sizes: np.ndarray  # [class]: logarithm of the words counted in it; 0 for words of their own
    counts: DataFrame  # (word, within): logarithm of the count, for the others that were counted twice or more

    @property
    def n_classes(self) -> int:
        return len(self.own) + CLASSES


def endings(p: Piece) -> np.ndarray:
    """The class of each word among those that share classes."""
    starts, ends = p.words
    return (p.span_hashes(np.maximum(starts, ends - 3), ends) % np.uint64(CLASSES)).astype(np.int64)


def classes_of(p: Piece, own: np.ndarray) -> np.ndarray:
    shared = len(own) + endings(p)
    if not len(own):
        return shared
    at = np.minimum(np.searchsorted(own, p.word_hashes), len(own) - 1)
    return np.where(own[at] == p.word_hashes, at, shared)


def sides(tokens: np.ndarray, texts: np.ndarray, margin: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens left and right of each place; the margin beyond the ends of its text."""
    left, right = np.full(len(tokens), margin, np.int64), np.full(len(tokens), margin, np.int64)
    same = texts[1:] == texts[:-1]
    left[1:][same] = tokens[:-1][same]
    right[:-1][same] = tokens[1:][same]
    return left, right


def tallied(parts: Iterator[tuple[np.ndarray, ...]], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Distinct keys with what goes with them and their number, for about ``HELD`` keys at a time."""
    waiting: list[tuple[np.ndarray, ...]] = []

    def counted() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*waiting)]
        waiting.clear()
        _, first, n = np.unique(columns[0], return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in columns), pa.array(n)], names=[*names, "n"])

    for part in parts:
        waiting.append(part)
        if sum(len(w[0]) for w in waiting) >= HELD:
            yield counted()
    if waiting:
        yield counted()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, ending, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((p.word_hashes.view(np.int64), endings(p)) for b in batches for _, p in pieces(b.column(0)))
        yield from tallied(found, ["word", "ending"])

    rows = docs.select("text").mapInArrow(run, "word long, ending long, n long")
    return rows.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def count_places(docs: DataFrame, own: np.ndarray) -> np.ndarray:
    """[left, right, class]: number of places over all texts."""
    n = len(own) + CLASSES
    shared = docs.sparkSession.sparkContext.broadcast(own)  # at most 1 / OWN_SHARE words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells(p: Piece) -> tuple[np.ndarray]:
            tokens = classes_of(p, shared.value)
            left, right = sides(tokens, p.text_of_word, n)
            return ((left * (n + 1) + right) * n + tokens,)

        yield from tallied((cells(p) for b in batches for _, p in pieces(b.column(0))), ["cell"])

    sums = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # at most (n + 1) * (n + 1) * n rows
    shared.destroy()
    places = np.zeros((n + 1) * (n + 1) * n, np.float32)
    places[got["cell"].to_numpy()] = got["n"].to_numpy()
    return places.reshape(n + 1, n + 1, n)


def start(n: int, seed: int = 5) -> Weights:
    rng = np.random.default_rng(seed)
    drawn = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
    return {"left": drawn(n + 1, WIDTH), "right": drawn(n + 1, WIDTH), "bias": np.zeros(WIDTH, np.float32),
            "out": drawn(WIDTH, n), "out_bias": np.zeros(n, np.float32)}


def forward(w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values and the logarithms of all classes' probabilities, between all pairs of classes."""
    hidden = np.tanh(w["left"][:, None] + w["right"][None] + w["bias"])
    logs = hidden @ w["out"] + w["out_bias"]
    logs -= logs.max(2, keepdims=True)
    logs -= np.log(np.exp(logs).sum(2, keepdims=True))
    return hidden, logs


def gradients(w: Weights, places: np.ndarray) -> Weights:
    """Of the mean negative log-probability over all counted places."""
    hidden, logs = forward(w)
    error = (np.exp(logs) * places.sum(2, keepdims=True) - places) / max(places.sum(dtype=np.float64), 1.0)
    error = error.astype(hidden.dtype)
    back = (error @ w["out"].T) * (1 - hidden * hidden)
    return {"left": back.sum(1), "right": back.sum(0), "bias": back.sum((0, 1)),
            "out": hidden.reshape(-1, hidden.shape[2]).T @ error.reshape(-1, error.shape[2]),
            "out_bias": error.sum((0, 1))}


def train(places: np.ndarray, steps: int = STEPS) -> Weights:
    """Weights fitted to the counts by Adam; those of the start if nothing was counted."""
    w = start(places.shape[2])
    if not places.any():
        return w
    seen = places.sum((0, 1), dtype=np.float64)
    w["out_bias"] = np.log((seen + 1) / (seen + 1).sum()).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        for k, g in gradients(w, places).items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def learn(docs: DataFrame, steps: int = STEPS) -> Model:
    """The counts and the network of all texts in ``docs``."""
    counts = staged(count_words(docs), "words")
    least = OWN_SHARE * (counts.agg(F.sum("n")).first()[0] or 0)
    frequent = counts.filter(F.col("n") >= least).select("word").collect()  # at most 1 / OWN_SHARE
    own = np.sort(np.array([r.word for r in frequent], np.int64).view(np.uint64))
    others = counts.filter(F.col("n") < least)
    sizes = np.zeros(len(own) + CLASSES, np.int64)
    for r in others.groupBy("ending").agg(F.sum("n").alias("n")).collect():
        sizes[len(own) + r.ending] = round(math.log(r.n) * UNITS)
    _, logs = forward(train(count_places(docs, own), steps))
    again = others.filter("n > 1").select("word", F.round(F.log("n") * UNITS).cast("long").alias("_within"))
    return Model(own, np.rint(logs.astype(np.float64) * UNITS).astype(np.int32), sizes, again)


def score(docs: DataFrame, model: Model, carried: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (text, ...), or its columns ``carried``, with ``n_tokens``, ``log_prob`` and ``mean_log_prob``."""
    docs, back = set_aside(without(docs, *COLUMNS), *INNER)
    there = {name: inner for inner, name in back.items()}
    names = [there.get(c, c) for c in carried] if carried is not None else docs.columns
    shared = docs.sparkSession.sparkContext.broadcast((model.own, model.units, model.sizes))  # bounded, as the classes are
    schema = StructType([
        *(docs.schema[c] for c in names), StructField("_row", LongType()), StructField("n_tokens", LongType()),
        StructField("_units", LongType()), StructField("_words", ArrayType(LongType())),
        StructField("_times", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, units, sizes = shared.value
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(c)) for c in [*names, "_row"]]
            for row, p in pieces(batch.column(batch.schema.get_field_index("_text"))):
                tokens, texts = classes_of(p, own), p.text_of_word
                left, right = sides(tokens, texts, len(sizes))
                total = segment_sums(units[left, right, tokens].astype(np.int64) - sizes[tokens], p.word_offsets)
                rest = np.flatnonzero(tokens >= len(own))
                rest = rest[np.lexsort((p.word_hashes[rest], texts[rest]))]
                word, text = p.word_hashes[rest].view(np.int64), texts[rest]
                new = np.ones(len(rest), bool)
                new[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                offsets = pa.array(np.searchsorted(text[first], np.arange(len(p) + 1)).astype(np.int32))
                times = np.diff(np.append(first, len(rest))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (word[first], times)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(row, len(p)) for c in kept), pa.array(np.diff(p.word_offsets).astype(np.int64)),
                     pa.array(total), *lists], names=schema.names)

    rows = docs.select(*names, F.col("text").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    parts = staged(rows.mapInArrow(run, schema), "places")  # which fixes the row numbers
    # Words with much of all rows are classes of their own, so no word left here is a hot key.
    within = (
        parts.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("w"))
        .select("_row", F.col("w._words").alias("word"), F.col("w._times").alias("_times"))
        .join(model.counts, "word").groupBy("_row").agg(F.sum(F.col("_within") * F.col("_times")).alias("_within"))
    )
    total = (F.col("_units") + F.coalesce("_within", F.lit(0))) / F.lit(float(UNITS))
    return (
        parts.drop("_words", "_times").join(within, "_row", "left")
        .select(*names, "n_tokens", total.alias("log_prob"),
                F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_prob"))
        .withColumnsRenamed(back)
    )


def scored(docs: DataFrame, steps: int = STEPS, carried: Sequence[str] | None = None) -> DataFrame:
    """``docs`` scored by a model of their own texts."""
    return score(docs, learn(docs, steps), carried)
