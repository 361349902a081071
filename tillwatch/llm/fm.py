"""Quality classifier: a factorisation machine (operator 6).

Features of a text are its hashed words, statistics of its structure in steps,
and its length as metadata. Beside a weight each feature has a short vector; two
features interact by the product of their vectors. All pairwise interactions of
a text cost linear time by the sum-of-squares identity: half of the square of
the summed vectors less the sum of the squared ones.

It is trained in numpy by Adam on at most about ``SAMPLE_ROWS`` labelled rows,
drawn by a hash of the id; of rows with one id the least text is taken. Scoring is
spread over the table.

Defined cases: null and empty texts have only the features of empty structure
and get a score like all others; with no labelled rows every score is 0.5; texts
are read whole at any length; repeated rows are scored alike; an empty table
gives an empty one. Input columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from tillwatch.llm.arrays import Piece, pieces, segment_sums
from tillwatch.llm.cascade import IS_LETTER, IS_SYMBOL, n_dup_lines, n_repeat_words
from tillwatch.llm.shared import unit_hash, without

SAMPLE_ROWS = 8000
BUCKETS = 1 << 13
FACTORS = 8
EPOCHS = 6
LEAST_STEPS = 500  # more epochs over few rows
BATCH = 128
RATE = 0.02
DECAY = 1e-4
KEEP_AT = 0.7
COLUMNS = ("score", "predicted")

IS_DIGIT = np.zeros(256, bool)
IS_DIGIT[0x30:0x3A] = True
IS_UPPER = np.zeros(256, bool)
IS_UPPER[0x41:0x5B] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[list(b".,;:!?")] = True
STEPS = 12  # for each statistic
SHARES = (0.0, 0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8)
STATISTICS = ("symbols", "digits", "capitals", "stops", "letters", "equal lines", "repeats", "neighbours", "varied",
              "word length", "words", "characters")
SIZE = BUCKETS + len(STATISTICS) * STEPS


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def statistics(p: Piece) -> np.ndarray:
    """A row for each text: the step that each statistic falls into."""
    words = np.diff(p.word_offsets)
    some_words = np.maximum(words, 1)
    length = np.diff(p.offsets)
    some_bytes = np.maximum(length, 1)
    hashes = p.word_hashes
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (p.text_of_word[1:] == p.text_of_word[:-1])
    line_ends = p.per_text(p.data == 0x0A) + 1
    order = np.lexsort((hashes, p.text_of_word))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (p.text_of_word[order][1:] != p.text_of_word[order][:-1])
    shares = [
        *[p.per_text(kind[p.data]) / some_bytes for kind in (IS_SYMBOL, IS_DIGIT, IS_UPPER, IS_STOP, IS_LETTER)],
        n_dup_lines(p) / line_ends,
        n_repeat_words(p) / some_words,
        segment_sums(same, p.word_offsets) / some_words,
        segment_sums(new, p.word_offsets) / some_words,
    ]
    steps = [np.searchsorted(SHARES, s, "left") for s in shares]
    steps.append(np.clip((p.per_text(p.in_word) / some_words).astype(int), 0, STEPS - 1))
    steps += [np.clip(np.log2(n + 1).astype(int) - low, 0, STEPS - 1) for n, low in ((words, 1), (length, 4))]
    return np.stack(steps, 1)


def features(p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts, one after the other, and the offsets of each text's."""
    n = len(p)
    buckets = (p.word_hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    keys, counts = np.unique(p.text_of_word * BUCKETS + buckets, return_counts=True)
    text, number = keys // BUCKETS, keys % BUCKETS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(text, value * value, minlength=n))
    value = value / norm[text]
    steps = statistics(p)
    numbers = BUCKETS + np.arange(len(STATISTICS)) * STEPS + steps
    text = np.concatenate([text, np.repeat(np.arange(n), len(STATISTICS))])
    order = np.argsort(text, kind="stable")
    number = np.concatenate([number, numbers.ravel()])[order]
    value = np.concatenate([value, np.full(numbers.size, 1 / np.sqrt(len(STATISTICS)))])[order]
    return number, value.astype(np.float32), np.searchsorted(text[order], np.arange(n + 1))


def raw_scores(m: Machine, number: np.ndarray, value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every text has features of structure, so no segment is empty."""
    scaled = m.factors[number] * value[:, None]
    summed = np.add.reduceat(scaled, offsets[:-1])
    squares = np.add.reduceat((scaled * scaled).sum(1), offsets[:-1])
    linear = np.add.reduceat(m.weights[number] * value, offsets[:-1])
    return m.bias + linear + 0.5 * ((summed * summed).sum(1) - squares)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 1) -> Machine:
    """Adam over batches of ``rows`` (feature numbers, values)."""
    if not rows:
        return Machine(0.0, np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32))
    rng = np.random.default_rng(seed)
    share = np.clip(labels.mean(), 0.01, 0.99)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32),
                      rng.normal(0, 0.05, (SIZE, FACTORS)).astype(np.float32))
    parts = {"w": machine.weights[:, None], "v": machine.factors}
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    step, batches = 0, -(-len(rows) // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        for batch in np.array_split(rng.permutation(len(rows)), batches):
            step += 1
            number = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            lengths = np.array([len(rows[i][0]) for i in batch])
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            error = (logistic(raw_scores(machine, number, value, offsets)) - labels[batch]) / len(batch)
            machine.bias -= RATE * float(error.sum())
            of = np.repeat(np.arange(len(batch)), lengths)
            pull = (error[of] * value)[:, None]
            scaled = machine.factors[number] * value[:, None]
            summed = np.add.reduceat(scaled, offsets[:-1])
            grads = {"w": pull, "v": pull * (summed[of] - scaled)}
            used, place = np.unique(number, return_inverse=True)
            for k, part in parts.items():
                total = np.stack([np.bincount(place, g, minlength=len(used)) for g in grads[k].T], 1)
                total = total + DECAY * part[used]
                first[k][used] = 0.9 * first[k][used] + 0.1 * total
                second[k][used] = 0.99 * second[k][used] + 0.01 * total * total
                move = first[k][used] / (1 - 0.9**step)
                part[used] -= RATE * move / (np.sqrt(second[k][used] / (1 - 0.99**step)) + 1e-8)
    return machine


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); rows without quality are left out."""
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    share = sample_rows / max(marked.count(), 1)
    drawn = lambda df: df.filter(unit_hash(F.col("doc_id"), "quality") < share)
    # One text of each identifier, as many rows may have the same one.
    texts = drawn(docs.select("doc_id", "text")).groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.join(drawn(marked), "doc_id").select("doc_id", "quality", "text")
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("quality", IntegerType()),
                         StructField("number", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in pieces(batch.column(2)):
                number, value, offsets = features(piece)
                part = batch.slice(row, len(piece))
                lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(a))
                         for a in (number.astype(np.int32), value)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.int32()), *lists],
                                                 names=["doc_id", "quality", "number", "value"])

    taken = rows.mapInArrow(run, schema)
    got = taken.toArrow().sort_by("doc_id")  # bounded by the sample and the number of features
    pairs = list(zip(got["number"].to_numpy(), got["value"].to_numpy()))
    return train([(np.asarray(n), np.asarray(v)) for n, v in pairs], got["quality"].to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` (text, ...) with ``score``, the chance of label 1, and ``predicted``."""
    docs = without(docs, *COLUMNS)
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 300 KB, whatever the input
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()),
                         StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, piece in pieces(batch.column(names.index("text"))):
                chance = logistic(raw_scores(shared.value, *features(piece)).astype(float))
                part = batch.slice(row, len(piece))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(chance), pa.array((chance >= KEEP_AT).astype(np.int32))],
                    names=[*names, *COLUMNS])

    return docs.mapInArrow(run, schema)
