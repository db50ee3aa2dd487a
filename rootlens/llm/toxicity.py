"""Toxicity by compression distance: one zstandard dictionary per class.

A window is a run of letters, in lower case, with its blanks. Two dictionaries
are trained on windows of a bounded sample: one on ordinary text, one on those
windows of toxic text whose beginnings toxic rows use more often. Every window
is compressed with the ordinary dictionary, and with the toxic one before it;
the bytes that the toxic one saves are the window's distance. Bytes are written
four wide, so that a match outweighs its own cost in such short inputs and the
length counts the phrases a window needs.

A text is judged by how many and what share of its windows reach each of fixed
distances, and by how many it has, through a calibration fitted on sampled rows that the dictionaries
have not seen. The model that goes to the executors has a fixed size bound;
workers remember a bounded number of windows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import id_hash, small_batches
from rootlens.llm.labelled import labelled_sample
from rootlens.llm.worker import held

#: Training: rows of each label value, ordinary windows.
ROWS_PER_CLASS = 1500
ORDINARY_WINDOWS = 600_000
#: One in so many sampled rows fits the calibration instead of the dictionaries.
CALIBRATE_ONE_IN = 3
ORDINARY_BYTES = 256 * 1024
TOXIC_BYTES = 32 * 1024
LEVEL = 16
#: Beginnings of these lengths are compared between the classes.
BEGINNINGS = range(4, 10)
MIN_TOXIC_ROWS = 4
MIN_DEVIATIONS = 4.0
#: Windows whose distance a worker remembers, and the longest one compressed in one piece.
REMEMBERED = 250_000
WINDOW_BYTES = 64
LARGEST = 13
#: Distances in saved bytes whose counts describe a text.
STEPS = (2, 4, 5, 6, 7, 8, 10)
SLICE_BYTES = 1 << 21

# Fixed value: a text counts as toxic from this score on.
THRESHOLD = 0.3

_RUN = re.compile(r"[^\W\d_]+")


def windows(text: str | None) -> list[str]:
    return _RUN.findall(text.lower()) if text else []


def counted(text: str | None) -> dict[str, int]:
    """How often the text holds each window."""
    return dict(Counter(windows(text)))


def _bytes(window: str) -> bytes:
    return b" " + window.encode() + b" "


def _wide(data: bytes) -> bytes:
    return data.decode("latin-1").encode("utf-32-le")


def _joined(found: list[str], each: int = 16) -> list[bytes]:
    return [b"".join(map(_bytes, found[i : i + each])) for i in range(0, len(found), each)]


def _dictionary(size: int, found: list[str]) -> bytes:
    """A trained dictionary; of too few windows to train on, the windows themselves."""
    samples = _joined(found)
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[:size]


class Distance:
    """Saved bytes of a window, remembered."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compressors = []
        for content in (ordinary, toxic + ordinary):
            held = zs.ZstdCompressionDict(_wide(content), dict_type=zs.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(
                zs.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)
            )
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _learn(self, missing: set[str], all_of_text: set[str]) -> None:
        """Remember the distances of a text's windows, of which ``missing`` are not known. Without
        room the older half goes; windows of the newer one that come again are not compressed again."""
        if len(self.known) + len(missing) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
            missing = all_of_text
        for w in missing:
            at = self.older.get(w)
            self.known[w] = self.of(w) if at is None else at

    def of(self, window: str) -> int:
        """The largest saving among pieces of WINDOW_BYTES, which cover the window."""
        data, best = _wide(_bytes(window)), 0
        plain, against = self.compressors
        for at in range(0, len(data), 4 * WINDOW_BYTES):
            piece = data[at : at + 4 * WINDOW_BYTES]
            best = max(best, len(plain.compress(piece)) - len(against.compress(piece)))
        return min(best, LARGEST)

    def histogram(self, text: str | None) -> np.ndarray:
        """How many windows of the text have each distance."""
        found = windows(text)
        distinct = set(found)
        self._learn(distinct.difference(self.known), distinct)
        places = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        return np.bincount(places, minlength=LARGEST + 1) if found else np.zeros(LARGEST + 1)

    def histogram_of(self, counts: dict[str, int]) -> np.ndarray:
        """The histogram of a text with these windows."""
        out = np.zeros(LARGEST + 1)
        self._learn(counts.keys() - self.known.keys(), set(counts))
        for w, n in counts.items():
            out[self.known[w]] += n
        return out


def _features(histograms: np.ndarray) -> np.ndarray:
    n = histograms.sum(1, keepdims=True) + 1
    reached = histograms[:, ::-1].cumsum(1)[:, ::-1][:, STEPS]
    return np.concatenate((np.ones((len(n), 1)), np.log1p(reached), np.sqrt(reached / n), np.log(n)), axis=1)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def scores(self, histograms: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(histograms) @ self.weights, -30, 30)))


def _drawn(texts: list[dict[str, int]]) -> list[str]:
    """At most ORDINARY_WINDOWS windows of the texts, each occurrence as likely as any other."""
    counts: Counter[str] = Counter()
    for text in texts:
        counts.update(text)
    found = sorted(counts)
    upto = np.cumsum([counts[w] for w in found], dtype=np.int64)
    total = int(upto[-1]) if found else 0
    places = np.random.Generator(np.random.PCG64(5)).choice(total, min(total, ORDINARY_WINDOWS), replace=False)
    return [found[i] for i in np.searchsorted(upto, places, "right")]


def _toxic_windows(ordinary: list[dict[str, int]], toxic: list[dict[str, int]]) -> list[str]:
    """Windows of toxic texts that begin as toxic rows' windows more often do.

    A beginning is telling if so many toxic rows hold it that the difference to
    the ordinary rows is MIN_DEVIATIONS standard errors; a window is taken by the
    rows that hold it, and at least often enough for the training to see it."""
    rows = []
    for texts in (ordinary, toxic):
        seen: Counter[str] = Counter()
        for text in texts:
            seen.update({f" {w} "[:n] for w in text for n in BEGINNINGS if len(w) + 2 >= n})
        rows.append(seen)
    n0, n1 = max(1, len(ordinary)), max(1, len(toxic))

    def telling(start: str, held: int) -> bool:
        pooled = (held + rows[0][start] + 1) / (n0 + n1)
        return (held / n1 - rows[0][start] / n0) / (pooled * (1 / n0 + 1 / n1)) ** 0.5 >= MIN_DEVIATIONS

    starts = {s for s, held in rows[1].items() if held >= MIN_TOXIC_ROWS and telling(s, held)}
    held = Counter(w for text in toxic for w in text if any(f" {w} "[:n] in starts for n in BEGINNINGS))
    out = [w for w, n in sorted(held.items()) for _ in range(max(16, n))]
    return [out[i] for i in np.random.Generator(np.random.PCG64(3)).permutation(len(out))]


def fit(sample: dict[int, list[str]], toxic_share: float) -> Model:
    """``fit_counted`` from texts by label."""
    return fit_counted({y: [counted(t) for t in sample[y]] for y in (0, 1)}, toxic_share)


def fit_counted(sample: dict[int, list[dict[str, int]]], toxic_share: float) -> Model:
    """Dictionaries and calibration from the counted windows of texts by label; ``toxic_share``
    is the share of toxic rows among all labelled rows. Without toxic rows every score is 0, with only
    toxic rows it is 1."""
    size = 2 + 2 * len(STEPS)
    if not sample[0] or not sample[1]:
        return Model(b" ", b" ", np.eye(size)[0] * (30.0 if sample[1] else -30.0))
    fitted = {y: [t for i, t in enumerate(sample[y]) if i % CALIBRATE_ONE_IN] or sample[y] for y in (0, 1)}
    calibrated = {y: sample[y][::CALIBRATE_ONE_IN] for y in (0, 1)}
    ordinary = _dictionary(ORDINARY_BYTES, _drawn(fitted[0]))
    toxic = _dictionary(TOXIC_BYTES, _toxic_windows(fitted[0], fitted[1]))
    distance = Distance(ordinary, toxic)
    x = _features(np.array([distance.histogram_of(t) for y in (0, 1) for t in calibrated[y]]))
    y = np.repeat([0.0, 1.0], [len(calibrated[0]), len(calibrated[1])])
    # each class weighs as much as it does among all labelled rows
    each = np.where(y == 1, toxic_share / len(calibrated[1]), (1 - toxic_share) / len(calibrated[0])) * len(y)
    weights = np.zeros(size)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (each * (p - y)) + 0.3 * weights
        bend = (x * (each * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.3 * np.eye(size)
        weights -= np.clip(np.linalg.solve(bend, slope), -2, 2)
    return Model(ordinary, toxic, weights)


def held_out(column: str = "doc_id") -> Column:
    return F.pmod(id_hash(column), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit on at most ``rows_per_class`` labelled rows of each class that are not held out;
    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. The rows are read whole and
    leave the tasks as counted windows."""
    sample = labelled_sample(docs, labels, "toxic", rows_per_class, None, ~held_out(), counted)
    share = labels.filter(~held_out()).select(F.avg(F.col("toxic").cast("double"))).first()[0]
    return fit_counted(sample, min(0.99, max(0.01, 0.5 if share is None else share)))


def judge(
    documents: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, score, predicted, and the columns of ``keep``.

    Defined cases: a null or empty text, or one without letters, has the score
    of a text without any telling window; a null id stays null and counts as
    the empty text for held_out; repeated rows are judged each; an empty table
    gives no rows; other columns are ignored. Texts are read whole.
    """
    small_batches(documents)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    text = text_column if text_column in keep else "_text"
    rows = documents.select(
        documents[id_column].alias("doc_id"),
        held_out(id_column).alias("held_out"),
        *([] if text in keep else [documents[text_column].alias(text)]),
        *[documents[c] for c in keep],
    )
    schema = rows.select("doc_id", "held_out").schema.add("score", "double").add("predicted", "integer")
    for field in rows.schema.fields:
        if field.name in keep:
            schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        distance = held(("toxicity", model.ordinary, model.toxic), lambda: Distance(model.ordinary, model.toxic))
        for whole in batches:
            for batch in tx.slices(whole, text, SLICE_BYTES):
                texts = batch.column(text).cast(pa.large_binary()).to_pylist()
                found = [distance.histogram(None if t is None else t.decode("utf-8", "replace")) for t in texts]
                score = sent.value.scores(np.array(found))
                columns = [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                    *(batch.column(c) for c in keep),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", *keep])

    return rows.mapInArrow(run, schema)
