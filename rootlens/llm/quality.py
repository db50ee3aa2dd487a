"""Quality rules: fixed rules on counts, then a hashed n-gram logistic regression.

Features are runs of one and two words and of three and four bytes, hashed into
one table of weights. A document's logit is the sum over the four kinds of the
mean weight of its n-grams. The regression is fitted on a bounded sample of
labelled rows, its logit is calibrated to a probability on rows it has not
seen, and every whole text is scored in Arrow batches. The model that goes to
the executors is one table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import only, small_batches
from rootlens.llm.labelled import labelled_sample

#: Training: rows of each label value.
ROWS_PER_CLASS = 1500
#: Rows of each class that fit the calibration, one in so many.
CALIBRATE_ONE_IN = 4
BITS = 18
EPOCHS = 12
#: Bytes of text worked on at once.
SLICE_BYTES = 1 << 21

# The rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_PROBABILITY = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[off[1:]] - total[off[:-1]]


def base_counts(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    """The counts of each document, and (starts, ends, offsets, hashes) of the words."""
    starts, ends, woff = tx.words(data, off)
    hashes = tx.hash_words(data, starts, ends)
    n = np.diff(woff)
    lead = ((data & 0xC0) != 0x80) & ~tx.SPACE[data]

    # lines: cut at each \n and at the documents' edges; those with a word count
    breaks = np.flatnonzero(data == 10)
    line_starts = np.union1d(off[:-1], breaks + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    line_ends -= (line_ends > line_starts) & (data[line_ends - 1] == 10) if len(line_ends) else 0
    first_word = np.searchsorted(starts, line_starts)
    worded = first_word < np.searchsorted(starts, line_ends)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_doc = np.searchsorted(off, line_starts, "right") - 1
    # a document's empty neighbours share its offset
    line_hash = tx.hash_words(data, line_starts, line_ends)
    order, groups = tx.repeated(line_hash, line_doc)
    n_lines = np.bincount(line_doc, minlength=len(off) - 1)
    n_distinct = np.bincount(line_doc[order[groups]], minlength=len(off) - 1)

    doc = tx.docs_of(woff)
    windows = tx.window_hashes(hashes, 3)
    covered = np.zeros(len(hashes) + 2, bool)
    if len(windows):
        at = np.flatnonzero(doc[:-2] == doc[2:])
        order, groups = tx.repeated(windows[at], doc[at])
        size = np.diff(np.append(groups, len(at)))
        twice = at[order[np.repeat(size > 1, size)]]
        for j in range(3):
            covered[twice + j] = True
    counts = {
        "n_words": n,
        "word_chars": _per_doc(lead, off),
        "n_symbols": _per_doc(_SYMBOL[data], off),
        "n_dup_lines": n_lines - n_distinct,
        "n_repeat_words": _per_doc(covered[: len(hashes)], woff),
    }
    return {k: v.astype(np.int64) for k, v in counts.items()}, (woff, hashes, doc)


def _features(data: np.ndarray, off: np.ndarray, words: tuple, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of the n-grams, kind by kind."""
    woff, hashes, doc = words
    shift = tx.U64(64 - bits)
    yield (tx.mix(hashes + tx.U64(1)) >> shift).astype(np.int64), doc
    pairs = tx.window_hashes(hashes, 2)
    same = doc[:-1] == doc[1:] if len(pairs) else np.zeros(0, bool)
    yield (pairs[same] >> shift).astype(np.int64), doc[:-1][same] if len(pairs) else doc[:0]
    low = tx.LOWER[data].astype(np.uint32)
    byte_doc = tx.docs_of(off)
    for n in (3, 4):
        m = len(low) - n + 1
        if m <= 0:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        value = np.zeros(m, np.uint32)
        for j in range(n):
            value |= low[j : j + m] << np.uint32(8 * j)
        value = (value + np.uint32(n)) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x85EBCA77)
        same = byte_doc[:m] == byte_doc[n - 1 :]
        yield (value[same] >> np.uint32(32 - bits)).astype(np.int64), byte_doc[:m][same]


@dataclass
class Model:
    """Weights by bucket, and the line that turns the logit into a calibrated one."""

    weights: np.ndarray
    slope: float
    offset: float

    @property
    def bits(self) -> int:
        return int(len(self.weights)).bit_length() - 1

    def logits(self, data: np.ndarray, off: np.ndarray, words: tuple) -> np.ndarray:
        out = np.zeros(len(off) - 1)
        for bucket, doc in _features(data, off, words, self.bits):
            total = np.bincount(doc, self.weights[bucket], len(out))
            out += total / np.maximum(1, np.bincount(doc, minlength=len(out)))
        return out

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -30, 30)))


def _sparse(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for text in texts:
        data, off = tx.flat(pa.array([text]))
        starts, ends, woff = tx.words(data, off)
        words = (woff, tx.hash_words(data, starts, ends), tx.docs_of(woff))
        ids, values = [], []
        for bucket, _ in _features(data, off, words, bits):
            if len(bucket):
                found, count = np.unique(bucket, return_counts=True)
                ids.append(found)
                values.append(count / len(bucket))
        out.append((np.concatenate(ids), np.concatenate(values)) if ids else (np.zeros(0, np.int64), np.zeros(0)))
    return out


def fit(sample: dict[int, list[str]], shares: tuple[float, float] = (0.5, 0.5), bits: int = BITS, seed: int = 7) -> Model:
    """Adagrad on the logistic loss, both classes weighing the same; then a calibration
    of slope and offset on the rows left out, weighted to the classes' ``shares`` of
    all labelled rows. Without rows of both classes every probability is 1."""
    if not sample[0] or not sample[1]:
        return Model(np.zeros(1 << bits), 0.0, 30.0)
    rows = [(x, y) for y in (0, 1) for x in _sparse(sample[y], bits)]
    held = [i for y in (0, 1) for i in range(y * len(sample[0]), y * len(sample[0]) + len(sample[y])) if i % CALIBRATE_ONE_IN == 0]
    fitted = sorted(set(range(len(rows))) - set(held)) or held
    size = [max(1, sum(rows[i][1] == y for i in fitted)) for y in (0, 1)]
    weights, squares = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(EPOCHS):
        for i in rng.permutation(fitted):
            (ids, values), y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weights[ids] @ values, -30, 30)))
            step = (p - y) * values * (len(fitted) / (2 * size[y]))
            np.add.at(squares, ids, step * step)
            np.add.at(weights, ids, -0.5 * step / np.sqrt(squares[ids]))
    z = np.array([weights[rows[i][0][0]] @ rows[i][0][1] for i in held])
    y = np.array([rows[i][1] for i in held], float)
    each = np.where(y == 1, shares[1] / max(1, y.sum()), shares[0] / max(1, (1 - y).sum()))
    scale = z.std() or 1.0
    a, b = 1.0, 0.0
    target = np.where(y == 1, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):  # Newton's steps on two numbers
        p = 1 / (1 + np.exp(-np.clip(a * z / scale + b, -30, 30)))
        g = each * (p - target)
        h = each * np.maximum(p * (1 - p), 1e-6)
        x = z / scale
        jac = np.array([[h @ (x * x) + 1e-4, h @ x], [h @ x, h.sum() + 1e-9]])
        da, db = np.linalg.solve(jac, [g @ x + 1e-4 * (a - 1.0), g.sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
    return Model(weights, a / scale, b)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit on at most ``rows_per_class`` labelled rows of each class, read whole; ``docs`` has
    doc_id and text, ``labels`` doc_id and quality."""
    sample = labelled_sample(docs, labels, "quality", rows_per_class, None, F.lit(True))
    counted = labels.select(F.avg(F.col("quality").cast("double"))).first()[0]
    good = min(0.99, max(0.01, 0.5 if counted is None else counted))
    return fit(sample, (1 - good, good))


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double, base_failed boolean, kept boolean"


def assess(
    documents: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """One row per row of ``documents`` with its counts, probability and verdict.

    base_failed: fewer than 50 words, or more than half of the words repeated.
    kept: the base holds and the probability reaches ``min_probability``.

    Defined cases: a null or empty text has no words and fails the base; a null
    id stays null; repeated rows are judged each; an empty table gives no rows;
    other columns are ignored. Texts are read whole, in slices of rows.
    """
    small_batches(documents)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tx.slices(whole, "text", SLICE_BYTES):
                data, off = tx.flat(batch.column("text"))
                counts, words = base_counts(data, off)
                p = sent.value.probability(sent.value.logits(data, off, words))
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"]
                )
                columns = [batch.column("doc_id"), *(pa.array(counts[c]) for c in COUNTS), pa.array(p), pa.array(failed), pa.array(~failed & (p >= min_probability))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "probability", "base_failed", "kept"])

    return only(documents, doc_id=id_column, text=text_column).mapInArrow(judge, RESULT)
