"""Phrase collocations by prefix-free parsing.

The words of a text, with the breaks between its pieces, are cut into chunks where
the text itself says so: after every three words whose hash is divisible by a
modulus. The next chunk begins with those three words again, so equal passages give equal
chunks wherever they stand, and every run of at most four words lies whole within a
chunk. Equal chunks of a language become one row of a dictionary with the number of times
they were parsed. Phrases are counted inside distinct chunks and weighted with that
number; a phrase that ends within the three words that a chunk shares with the one
before belongs to that one.

Counting in two steps. A phrase is as frequent as required only if all its parts are. First only
64-bit hashes are counted, of words and word pairs, then of longer phrases whose pairs may all be frequent.
Hashes that reach the required count are marked in a bit table of fixed size. Then the
phrases whose hash is marked are counted as text, exactly: two phrases that share a mark cost
a little work and change no result. The bit table does not grow with the input; where it
fills up, more phrases are counted as text.

Scores, the nesting rule and the ranking are joins and aggregates on the frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import Scratch, small_batches

# Phrases, the least count, the nesting rule, the report.
LONGEST = 4
LEAST_COUNT = 30
NESTED_PERCENT = 80
SCALE = 2_000_000
REPORTED = 2000

#: Words that two neighbouring chunks share; one less than the longest phrase.
OVERLAP = LONGEST - 1
#: One in so many places ends a chunk; a chunk without such a place is cut after so many words.
MODULUS = 24
LONGEST_CHUNK = 512
SLICE_BYTES = 1 << 20
#: Bits of the table of marked hashes, as a power of two: 16 MB.
MARK_BITS = 27

_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_APART = _BLANK | _BREAK
# In a chunk a byte follows each word but the last: that a piece goes on, or that it ends.
_ON, _END = ord(" "), ord(".")


# ---------------------------------------------------------------- parsing


def _numbers(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after another."""
    size = ends - starts
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(first - starts, size)


def parse(data: np.ndarray, off: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, leads, documents) of the chunks of texts given as bytes and offsets.

    ``leads`` tells the first chunk of a text, which shares no words with one before."""
    low = tx.LOWER[data]
    starts, ends, woff = tx.words(low, off, _APART)
    docs = tx.docs_of(woff)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return b"", none, none, none.astype(bool), none
    # a break stands between a word and the next one of its text
    breaks = np.concatenate(([0], np.cumsum(_BREAK[low])))
    last = np.ones(len(starts), bool)
    last[:-1] = docs[1:] != docs[:-1]
    cut = np.zeros(len(starts), bool)
    cut[:-1] = breaks[starts[1:]] > breaks[ends[:-1]]
    # words with one byte after each, which the text's last word may lack
    size = ends - starts + 1
    new_end = np.cumsum(size) - 1
    buffer = np.empty(int(size.sum()), np.uint8)
    inside = np.ones(len(buffer), bool)
    inside[new_end] = False
    buffer[inside] = low[_numbers(starts, ends)]
    buffer[new_end] = np.where(cut, _END, _ON)
    new_start = new_end - size + 1

    hashes = tx.hash_words(low, starts, ends)
    first_word = woff[docs]
    place = np.arange(len(starts)) - first_word
    closes = np.zeros(len(starts), bool)
    windows = tx.window_hashes(hashes, OVERLAP)
    closes[OVERLAP - 1 :] = windows % tx.U64(MODULUS) == 0
    closes &= place >= OVERLAP - 1
    closes |= place % LONGEST_CHUNK == LONGEST_CHUNK - 1
    closes |= last
    at = np.flatnonzero(closes)
    begin = np.empty(len(at), np.int64)
    begin[0] = 0
    begin[1:] = at[:-1] - OVERLAP + 1
    lead = np.ones(len(at), bool)
    lead[1:] = docs[at[1:]] != docs[at[:-1]]
    begin[lead] = first_word[at[lead]]
    return buffer.tobytes(), new_start[begin], new_end[at], lead, docs[at]


_CHUNKS = "lang string, lead boolean, chunk binary, times long"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct chunks of each slice, with how often they stand in it."""
    for batch in batches:
        for part in tx.slices(batch, "text", SLICE_BYTES):
            buffer, starts, ends, leads, docs = parse(*tx.flat(part.column("text")))
            langs = part.column("lang").to_pylist()
            seen: dict[tuple[str, bool, bytes], int] = {}
            for a, b, lead, doc in zip(starts.tolist(), ends.tolist(), leads.tolist(), docs.tolist(), strict=True):
                key = (langs[doc], lead, buffer[a:b])
                seen[key] = seen.get(key, 0) + 1
            columns = [pa.array(c, k) for c, k in zip(zip(*seen, strict=True), (pa.string(), pa.bool_(), pa.binary()), strict=True)] if seen else []
            if columns:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(seen.values(), pa.int64())], names=["lang", "lead", "chunk", "times"])


def dictionary(documents: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """lang, lead, chunk, times: the distinct chunks of each language and their parse frequencies."""
    small_batches(documents)
    texts = documents.select(
        F.coalesce(documents[lang_column].cast("string"), F.lit("und")).alias("lang"), documents[text_column].alias("text")
    )
    texts = texts.filter("text IS NOT NULL")
    return texts.mapInArrow(_parsed, _CHUNKS).groupBy("lang", "lead", "chunk").agg(F.sum("times").alias("times"))


# ---------------------------------------------------------------- counting


class _Phrases:
    """The phrases of a batch of chunks that count there."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, off = tx.flat(batch.column("chunk"))
        self.starts, self.ends, woff = tx.words(self.data, off, _APART)
        self.hashes = tx.hash_words(self.data, self.starts, self.ends)
        self.docs = tx.docs_of(woff)
        lead = np.asarray(batch.column("lead").to_numpy(zero_copy_only=False), bool)
        place = np.arange(len(self.starts)) - woff[self.docs]
        #: a phrase counts here if its last word is not shared with the chunk before
        self.fresh = lead[self.docs] | (place >= OVERLAP)
        # words that go on from the one before: same chunk, same piece
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[1:] = (self.docs[1:] == self.docs[:-1]) & (self.data[self.ends[:-1]] != _END)
        names, code = np.unique(np.asarray(batch.column("lang").to_pylist(), object), return_inverse=True)
        self.names = names
        self.code = code
        self.seed = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in names], np.uint64)[code]
        self.times = batch.column("times").to_numpy()

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of all phrases of n words, shared ones too."""
        if len(self.starts) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = np.ones(len(self.starts) - n + 1, bool)
        for k in range(1, n):
            whole &= self.joined[k : len(self.starts) - n + 1 + k]
        at = np.flatnonzero(whole)
        raw = tx.window_hashes(self.hashes, n)[at]
        return at, tx.mix(raw ^ self.seed[self.docs[at]] ^ tx.U64(n))

    def counted(self, n: int, marks: np.ndarray | None, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of the phrases of n words that count here and whose hash is
        marked in ``marks``, or all of whose pairs are marked in ``pairs``."""
        at, key = self.of(n)
        use = self.fresh[at + n - 1]
        if marks is not None:
            use &= marked(marks, key)
        if pairs is not None:
            first, pair = self.of(2)
            good = np.zeros(len(self.starts), bool)
            good[first] = marked(pairs, pair)
            for k in range(n - 1):
                use &= good[at + k]
        return at[use], key[use]


def _cell(key: np.ndarray) -> np.ndarray:
    return (key >> tx.U64(64 - MARK_BITS)).astype(np.int64)


def marked(marks: np.ndarray, key: np.ndarray) -> np.ndarray:
    cell = _cell(key)
    return (marks[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def _weighted(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first of each, distinct keys, summed weights)."""
    order = np.argsort(key, kind="stable")
    run = key[order]
    heads = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.zeros(0, np.int64)
    return order[heads], run[heads], np.add.reduceat(weight[order], heads) if len(heads) else weight[:0]


def _hash_counts(sizes: tuple[int, ...], pairs):
    """key, times of the phrases of the given sizes; those over two words only if all pairs are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        for batch in batches:
            for part in tx.slices(batch, "chunk", SLICE_BYTES):
                here = _Phrases(part)
                keys, weights = [], []
                for n in sizes:
                    at, key = here.counted(n, None, table)
                    keys.append(key)
                    weights.append(here.times[here.docs[at]])
                _, key, weight = _weighted(np.concatenate(keys), np.concatenate(weights))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(weight)], names=["key", "times"])

    return run


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``data`` from ``starts`` to ``ends``."""
    off = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    at = np.ones(int(off[-1]), np.int32)
    at[0] = starts[0]
    at[off[1:-1]] = starts[1:] - ends[:-1] + 1
    np.cumsum(at, out=at)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(data[at])])


def _as_text(phrases: pa.Array) -> pa.Array:
    """UTF-8 as strings; bytes that are not UTF-8 are read as U+FFFD."""
    try:
        return phrases.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([p.decode("utf-8", "replace") for p in phrases.to_pylist()], pa.string())


def _texts(marks):
    """lang, size, phrase, times of the phrases whose hash is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(marks.value, np.uint8)
        for batch in batches:
            for part in tx.slices(batch, "chunk", SLICE_BYTES):
                here = _Phrases(part)
                for n in range(1, LONGEST + 1):
                    at, _ = here.counted(n, table)
                    if not len(at):
                        continue
                    docs = here.docs[at]
                    found = pa.table({
                        "lang": pa.array(here.code[docs]),
                        "phrase": _cut(here.data, here.starts[at], here.ends[at + n - 1]),
                        "times": pa.array(here.times[docs]),
                    })
                    # equal texts become one, compared as bytes
                    found = found.group_by(["lang", "phrase"], use_threads=False).aggregate([("times", "sum")]).combine_chunks()
                    langs = pa.array(here.names, pa.string()).take(found["lang"].chunk(0))
                    columns = [langs, pa.array(np.full(len(langs), n, np.int32)), _as_text(found["phrase"].chunk(0)), found["times_sum"].chunk(0)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "times"])

    return run


def _bit_table(keys: DataFrame) -> bytes:
    """The marks of the given keys; made of words of the table, so what reaches the driver is
    bounded by the table, not by the keys."""
    cell = keys.select(F.shiftrightunsigned("key", 64 - MARK_BITS).alias("cell"))
    words = cell.select(F.shiftright("cell", 5).alias("word"), F.expr("shiftleft(1L, cast(cell & 31 AS INT))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(1 << (MARK_BITS - 5), np.uint32)
    found = words.toArrow()
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return table.tobytes()


def phrase_counts(chunks: DataFrame, scratch: Scratch, least: int = LEAST_COUNT) -> DataFrame:
    """lang, size, phrase, f of every phrase of up to four words with f >= ``least``."""
    context = chunks.sparkSession.sparkContext
    source = chunks.select("lang", "lead", "chunk", "times")

    def frequent(sizes: tuple[int, ...], pairs, name: str) -> DataFrame:
        hashed = source.mapInArrow(_hash_counts(sizes, pairs), "key long, times long")
        counts = hashed.groupBy("key").agg(F.sum("times").alias("times"))
        return scratch.store(counts.filter(F.col("times") >= least).select("key"), name)

    short = frequent((1, 2), None, "short")
    pairs = context.broadcast(_bit_table(short))
    longer = frequent(tuple(range(3, LONGEST + 1)), pairs, "longer")
    marks = context.broadcast(_bit_table(short.unionByName(longer)))
    texts = source.mapInArrow(_texts(marks), "lang string, size int, phrase string, times long")
    counts = texts.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("f"))
    return scratch.store(counts.filter(F.col("f") >= least), "phrases")


def word_totals(chunks: DataFrame) -> DataFrame:
    """lang, n: all word occurrences of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "chunk", SLICE_BYTES):
                data, off = tx.flat(part.column("chunk"))
                words = np.diff(tx.words(data, off, _APART)[2])
                lead = np.asarray(part.column("lead").to_numpy(zero_copy_only=False), bool)
                n = (words - np.where(lead, 0, OVERLAP)) * part.column("times").to_numpy()
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(n)], names=["lang", "n"])

    return chunks.select("lang", "lead", "chunk", "times").mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- scores


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def scored(counts: DataFrame, totals: DataFrame, reported: int = REPORTED) -> DataFrame:
    """The first ``reported`` phrases of each language; see collocations."""
    words = F.split("phrase", " ", -1)
    candidates = counts.filter("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    parts = counts.select("lang", "phrase", "f")

    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # a decimal div gives a long; the quotient is at most half of SCALE, as no part is rarer than the whole
    cuts = cuts.withColumn("a_exact", _exact("a")).withColumn("lr_exact", (_exact("l") + _exact("r")).cast("decimal(21,0)"))
    cuts = cuts.withColumn("score", F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * a_exact) div lr_exact"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    lowest = lowest.select("lang", "phrase", "cut.*")

    inner = F.expr(
        "explode(array_distinct(flatten(transform(sequence(2, size - 1), m -> "
        "transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))))"
    )
    nests = candidates.filter("size >= 3").withColumn("words", words).select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    nests = nests.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(nests, ["lang", "phrase"], "left")
    swallowed = F.coalesce(100 * _exact("longer") >= NESTED_PERCENT * _exact("a"), F.lit(False))
    kept = kept.filter(~swallowed)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def collocations(documents: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first 2,000 phrases of each language.

    A phrase is 2 to 4 words within a piece, a piece what stands between any of .,;:!? and line
    breaks; A-Z are lower-cased. a, l, r and n count occurrences in all texts of the language: of the
    phrase, of the parts of its weakest cut, and of all words; score is floor(2000000 a / (l + r)) at
    that cut. Phrases with a < 30, and those of which a longer phrase holds 80 %, are left out.

    Defined cases: a null text is empty; a null lang is und, together with that value; texts
    without words, and an empty table, give no rows; repeated rows count as often as they stand there;
    ties go by a, then by the bytes of the phrase; other columns are ignored."""
    scratch = Scratch(documents.sparkSession)
    chunks = scratch.store(dictionary(documents, text_column, lang_column), "chunks")
    return scored(phrase_counts(chunks, scratch), word_totals(chunks))
