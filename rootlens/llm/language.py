"""Language by cross-parsing: the language whose labelled text needs fewest phrases.

For each language a suffix automaton holds every substring of a bounded sample
of its labelled text. A text is parsed greedily against it: each phrase is the
longest match from where the last one ended. Phrases times the bits that name a
place in the sample, per character, estimate the cross entropy; the least wins.

Texts are read as letters in lower case with one blank between runs of them, and
parsed in windows of fixed length that cover the whole text, so thousands of
windows advance together, one character a step, through a table of transitions.
What goes to the executors is the sample, whose size is bounded for each
language; every worker builds its automata once.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import id_hash, only, small_batches
from rootlens.llm.worker import held

#: Training: rows of a language, characters of a row, characters of a language after cleaning.
ROWS_PER_LANGUAGE = 64
CHARS_PER_ROW = 600
CHARS_PER_LANGUAGE = 24_000
#: Distinct letters told apart; the rest, rarer in the sample, share one class.
MAX_LETTERS = 250
#: Characters parsed at a stretch.
WINDOW = 256
SLICE_BYTES = 1 << 21

UNKNOWN = "und"
_PAD, _BLANK, _OTHER = 0, 1, 2


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets by document); broken bytes become U+FFFD."""
    try:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        return points, lead[off]
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)]
        sizes = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), sizes


def clean(points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters and one blank (0) after each run of them, by document."""
    low = _letters()[points]
    keep = low > 0
    after = np.zeros(len(low), bool)
    after[1:] = keep[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    after[heads] = False
    keep |= after
    return low[keep], np.concatenate(([0], np.cumsum(keep)))[off]


def shared(parts: list[np.ndarray], limit: int) -> np.ndarray:
    """The cleaned texts one after another, a blank between, each cut to the length that lets
    all of them into ``limit`` characters; shorter ones leave room to the others."""
    parts = [p for p in parts if len(p)]
    room = limit - len(parts) + 1
    most = 0
    for k, n in enumerate(sorted(map(len, parts))):
        most = max(1, room // (len(parts) - k))
        if n > most:
            break
        most, room = n, room - n
    out: list[np.ndarray] = []
    for p in parts:
        if out and out[-1][-1]:
            out.append(np.zeros(1, p.dtype))
        out.append(p[:most])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def automaton(symbols: list[int], classes: int) -> np.ndarray:
    """Transitions [state, class] of the suffix automaton of ``symbols``; -1 where there is none."""
    size = 2 * len(symbols) + 2
    step = np.full((size, classes), -1, np.int32)
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    for state, out in enumerate(nexts):
        for c, to in out.items():
            step[state, c] = to
    return step[: len(nexts)]


def _parse_table(symbols: list[int], classes: int) -> np.ndarray:
    """Flat transitions for parsing: the next state times ``classes``, shifted left by two;
    the low bits count the phrases that end at this character."""
    step = automaton(symbols, classes)
    stops = step < 0
    begins = np.where(stops[0], 0, step[0])
    # where nothing goes on, the open phrase ends and the character begins the next one;
    # a character unknown to the language is a phrase of its own
    ended = stops.astype(np.int64) + (stops & stops[0])
    ended[0] = stops[0]
    table = np.where(stops, begins, step).astype(np.int64) * classes * 4 + ended
    # the padding after a text ends an open phrase, once
    table[:, _PAD] = 1
    table[0, _PAD] = 0
    return table.ravel().astype(np.int32)


class Parser:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        cleaned: dict[str, np.ndarray] = {}
        for language, texts in sorted(samples.items()):
            points = [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in texts]
            low = shared([clean(p, np.array([0, len(p)]))[0] for p in points], CHARS_PER_LANGUAGE)
            if len(low):
                cleaned[language] = low
        seen = Counter(int(c) for low in cleaned.values() for c in low if c)
        alphabet = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:MAX_LETTERS]]
        self.classes = len(alphabet) + 3
        self.lookup = np.full(0x110000, _OTHER, np.int32)
        self.lookup[0] = _BLANK
        self.lookup[alphabet] = np.arange(3, self.classes)
        self.languages = list(cleaned)
        self.tables = [_parse_table(self.lookup[low].tolist(), self.classes) for low in cleaned.values()]
        self.bits = [math.log2(len(low) + 1) for low in cleaned.values()]

    def phrases(self, symbols: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Phrases by document and language."""
        n = np.diff(off)
        rows = -(-n // WINDOW)
        first = np.concatenate(([0], np.cumsum(rows)))
        doc = tx.docs_of(first)
        within = np.arange(len(symbols)) - np.repeat(off[:-1], n)
        # one row a step, so a step reads neighbouring memory
        steps = np.zeros((WINDOW, int(first[-1])), np.int32)
        steps[within % WINDOW, np.repeat(first[:-1], n) + within // WINDOW] = symbols
        out = np.zeros((len(n), len(self.tables)))
        for k, table in enumerate(self.tables):
            state = np.zeros(steps.shape[1], np.int32)
            count = np.zeros(steps.shape[1], np.int32)
            for row in steps:
                moved = table[state + row]
                count += moved & 3
                state = moved >> 2
            # a phrase that the window's end cuts off counts too
            out[:, k] = np.bincount(doc, count + (state > 0), len(n))
        return out

    def predict(self, data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
        points, places = _code_points(data, off)
        low, places = clean(points, places)
        lengths = np.diff(places)
        if not self.languages:
            return [UNKNOWN] * len(lengths), np.zeros(len(lengths))
        entropy = self.phrases(self.lookup[low], places) * np.array(self.bits)
        best = entropy.argmin(1)
        ranked = np.sort(entropy, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = 1 - ranked[:, 0] / ranked[:, 1] if len(self.languages) > 1 else np.ones(len(best))
        known = lengths > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def held_out(column: str = "doc_id"):
    return F.pmod(id_hash(column), F.lit(3)) == 1


def train(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> dict[str, list[str]]:
    """The labelled sample: for each language at most ROWS_PER_LANGUAGE pieces of at most
    CHARS_PER_ROW characters, of documents that are not held out and hold a letter. A piece
    begins at the first letter from a hashed place on, or else at the first letter of its text.
    Spark keeps only that many rows of a language in each task before they meet."""
    piece = rf"(?s)\p{{L}}.{{0,{CHARS_PER_ROW - 1}}}"
    rows = (
        only(documents, doc_id=id_column, text=text_column, lang=language_column)
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
        .filter(F.col("text").rlike(r"\p{L}"))
        .withColumn("order", F.xxhash64("doc_id", "text"))
        .withColumn("begins", (1 + F.pmod(F.xxhash64("order"), F.greatest(F.lit(1), F.length("text") - CHARS_PER_ROW + 1))).cast("int"))
        .withColumn("later", F.regexp_extract(F.col("text").substr(F.col("begins"), F.length("text")), piece, 0))
        .withColumn("text", F.when(F.col("later") != "", F.col("later")).otherwise(F.regexp_extract("text", piece, 0)))
        .select("lang", "doc_id", "text", "order")
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    chosen = rows.withColumn("place", place).filter(F.col("place") <= ROWS_PER_LANGUAGE)
    samples: dict[str, list[str]] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r["lang"], r["place"])):
        samples.setdefault(row["lang"], []).append(row["text"])
    return samples


def identify(
    documents: DataFrame,
    samples: dict[str, list[str]],
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``documents``: doc_id, held_out, lang_pred, score, and the columns of ``keep``.

    lang_pred is a language of ``samples`` or ``und``; score is how much shorter
    the best parse is than the second best, from 0 (a tie) to 1.

    Defined cases: a null text or one without a letter is ``und`` with score 0,
    and so is every text if nothing was learned; with one learned language its
    score is 1; ties go to the language that sorts first; a null id stays null
    and counts as the empty text for held_out; repeated rows are judged each; an
    empty table gives no rows; other columns are ignored. Texts are parsed whole.
    """
    small_batches(documents)
    sent = documents.sparkSession.sparkContext.broadcast(samples)
    key = hash(tuple((k, tuple(v)) for k, v in sorted(samples.items())))
    text = text_column if text_column in keep else "_text"
    rows = documents.select(
        documents[id_column].alias("doc_id"),
        held_out(id_column).alias("held_out"),
        *([] if text in keep else [documents[text_column].alias(text)]),
        *[documents[c] for c in keep],
    )
    kept = [f for f in rows.schema.fields if f.name in keep]
    schema = rows.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double")
    for field in kept:
        schema = schema.add(field)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = held(("language", key), lambda: Parser(sent.value))
        for whole in batches:
            for batch in tx.slices(whole, text, SLICE_BYTES):
                data, off = tx.flat(batch.column(text))
                found, score = parser.predict(data, off)
                columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.string()), pa.array(score), *(batch.column(c) for c in keep)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", *keep])

    return rows.mapInArrow(judge, schema)
