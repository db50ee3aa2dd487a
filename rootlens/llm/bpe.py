"""Byte-level BPE with recursive DuckDB queries inside Spark's tasks.

Encoding: a text is cut by the pattern into words. A word that is a token is
done; the others become rows (word, position, token, next token), one for each
byte. A recursive query joins them to the merge table and contracts the leftmost
pair of least rank in each word until no word has a pair left; what stays, in
order, are a word's ids. Decoding joins ids to the vocabulary and puts
their bytes together in order, document by document.

Spark deals out the documents; nothing is shuffled. The vocabulary, whose size
is fixed, goes to the executors once. A worker remembers a bounded number of
words, and a query holds the words or the tokens of a bounded slice of text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rootlens.llm import textops as tx
from rootlens.llm.frames import small_batches
from rootlens.llm.worker import held

DEFAULT = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

SLICE_BYTES = 1 << 20
#: Tokens decoded by one query; a longer document stands alone.
SLICE_TOKENS = 1 << 18
#: Bytes of words in one recursive query, and contractions of a word before its rows are
#: taken out and put in again, so that the rows of finished steps do not pile up.
QUERY_BYTES = 1 << 17
QUERY_STEPS = 64
#: Words whose ids a worker remembers.
REMEMBERED = 300_000
MEMORY_MB = 250

ENCODE = f"""
WITH RECURSIVE step(word, pos, token, following, steps, done) AS (
  SELECT word, pos, token, following, 0, false FROM rows_in
  UNION ALL
  (
    WITH found AS (
      SELECT s.word, s.pos, s.token, s.following, s.steps, m.merged
      FROM step s LEFT JOIN merges m ON m.token = s.token AND m.following = s.following
      WHERE NOT s.done AND s.steps < {QUERY_STEPS}
    ),
    -- a merged token's id is its rank: the least id, and of it the leftmost
    least AS (SELECT word, min(merged) AS rank, arg_min(pos, merged::BIGINT << 32 | pos) AS place FROM found WHERE merged IS NOT NULL GROUP BY word)
    SELECT
      f.word,
      CASE WHEN f.pos > l.place THEN f.pos - 1 ELSE f.pos END,
      CASE WHEN f.pos = l.place + 1 THEN l.rank ELSE f.token END,
      CASE WHEN f.pos = l.place - 1 THEN l.rank ELSE f.following END,
      f.steps + 1,
      l.word IS NULL
    FROM found f LEFT JOIN least l ON l.word = f.word
    WHERE l.word IS NULL OR f.pos <> l.place
  )
)
SELECT word, token, done FROM step WHERE done OR steps = {QUERY_STEPS} ORDER BY word, pos
"""

DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS pieces
FROM tokens_in JOIN pieces ON pieces.id = tokens_in.id
GROUP BY doc
"""


@dataclass(frozen=True)
class Vocabulary:
    """Ranks by token, and the pattern that cuts a text into words."""

    ranks: dict[bytes, int]
    pattern: str


def load(path: str = DEFAULT, pattern: str = public_tokenizers.PATTERN) -> Vocabulary:
    """The vocabulary of a rank file: lines of a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return Vocabulary({base64.b64decode(p[0]): int(p[1]) for p in pairs if p}, pattern)


class Coder:
    """The vocabulary as tables of a private in-memory database, made as they are needed,
    and remembered words."""

    def __init__(self, vocabulary: Vocabulary):
        ranks = self.ranks = vocabulary.ranks
        self.pattern = regex.compile(vocabulary.pattern)
        self.database = duckdb.connect(":memory:")
        self.database.execute(f"SET threads = 1; SET memory_limit = '{MEMORY_MB}MB'")
        self.single = np.array([ranks[bytes([x])] for x in range(256)], np.int32)
        self.made: set[str] = set()
        self.known = np.zeros(max(ranks.values()) + 1, bool)
        self.known[list(ranks.values())] = True
        self.forget()

    def _merges(self) -> None:
        """The merge table: every way to put a token together from two others."""
        if "merges" in self.made:
            return
        ranks, left, right, merged = self.ranks, [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self._table("merges", token=left, following=right, merged=merged)

    def _pieces(self) -> None:
        """The bytes of every id; a byte is written as the character 256 places on, so any
        bytes make a string."""
        if "pieces" not in self.made:
            names = pa.array(["".join(chr(256 + x) for x in token) for token in self.ranks], pa.string())
            self._table("pieces", id=list(self.ranks.values()), piece=names)

    def _table(self, name: str, **columns) -> None:
        made = {k: v if isinstance(v, pa.Array) else pa.array(v, pa.int32()) for k, v in columns.items()}
        self.database.register("given", pa.table(made))
        self.database.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.database.unregister("given")
        self.made.add(name)

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids by word), by the recursive query."""
        self._merges()
        size = np.array([len(w) for w in words])
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        ids, of = [], []
        while len(word):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(np.append(first, len(word)))
            following = np.append(token[1:], -1).astype(np.int32)
            following[first + size - 1] = -1
            pos = (np.arange(len(word)) - np.repeat(first, size)).astype(np.int32)
            self.database.register("rows_in", pa.table({"word": word, "pos": pos, "token": token, "following": following}))
            found = self.database.execute(ENCODE).fetchnumpy()
            done = np.asarray(found["done"], bool)
            ids.append(np.asarray(found["token"])[done])
            of.append(np.asarray(found["word"])[done])
            # longer words go on from where they are
            word, token = np.asarray(found["word"])[~done], np.asarray(found["token"])[~done]
        of = np.concatenate(of)
        return np.concatenate(ids)[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(words))

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words that are not known yet."""
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self.forget()
            new = list(words)
        pairs = [(w, w.encode()) for w in sorted(new)]
        whole = [(w, self.ranks[b]) for w, b in pairs if b in self.ranks]
        self._remember([w for w, _ in whole], np.array([i for _, i in whole], np.int32), np.ones(len(whole), np.int64))
        rest = [(w, b) for w, b in pairs if b not in self.ranks]
        total = np.cumsum([len(b) for _, b in rest])
        at = 0
        while at < len(rest):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + QUERY_BYTES, "right")))
            self._remember([w for w, _ in rest[at:to]], *self._merge([b for _, b in rest[at:to]]))
            at = to

    def _remember(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        words = [self.pattern.findall(t) for t in texts]
        self.learn(set(chain.from_iterable(words)))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64)
        size = self.ends[at + 1] - self.ends[at]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.arange(total[-1]) + np.repeat(self.ends[at] - total[:-1], size)]
        return ids, total[np.concatenate(([0], np.cumsum([len(found) for found in words])))]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes | None]:
        """The bytes of each document; None if it has an id that is not in the vocabulary."""
        self._pieces()
        n = np.diff(off)
        rows = {"doc": tx.docs_of(off).astype(np.int32), "pos": np.arange(len(ids), dtype=np.int64), "id": ids}
        self.database.register("tokens_in", pa.table(rows))
        known = (ids >= 0) & (ids < len(self.known))
        known[known] = self.known[ids[known]]
        broken = np.bincount(rows["doc"], ~known, len(n)) > 0
        out: list[bytes | None] = [None if b else b"" for b in broken]
        for doc, pieces in self.database.execute(DECODE).fetchall():
            if not broken[doc]:
                out[doc] = np.frombuffer(pieces.encode("utf-16-le"), np.uint16).astype(np.uint8).tobytes()
        return out


def _key(vocabulary: Vocabulary) -> int:
    return hash(("bpe", vocabulary.pattern, tuple(vocabulary.ranks.items())))


def encode(documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``documents``: the columns of ``keep`` and ids, an array of int.

    Defined cases: a null text is empty and has no ids; bytes that are not UTF-8
    are read as U+FFFD; strings of special tokens are ordinary text; repeated
    rows are encoded each; an empty table gives no rows; other columns are
    ignored. Texts are encoded whole; the work on one word grows with the square
    of its length.
    """
    small_batches(documents)
    sent, key = documents.sparkSession.sparkContext.broadcast(vocabulary), _key(vocabulary)
    rows = documents.select(*[documents[c] for c in keep], documents[text_column].alias("_text"))
    schema = rows.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(key, lambda: Coder(sent.value))
        for whole in batches:
            for batch in tx.slices(whole, "_text", SLICE_BYTES):
                raw = batch.column("_text").cast(pa.large_binary()).to_pylist()
                ids, off = coder.encode(["" if t is None else t.decode("utf-8", "replace") for t in raw])
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], names=[*keep, "ids"])

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``tokens``: the columns of ``keep`` and data, the decoded bytes.

    Defined cases: null or empty ids give no bytes; an id that is null or not in
    the vocabulary makes data null; other columns are ignored.
    """
    sent, key = tokens.sparkSession.sparkContext.broadcast(vocabulary), _key(vocabulary)
    rows = tokens.select(*[tokens[c] for c in keep], tokens[ids_column].alias("_ids"))
    schema = rows.select(*keep).schema.add("data", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(key, lambda: Coder(sent.value))
        for batch in batches:
            at = 0
            lists = batch.column("_ids")
            total = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))))
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(total, total[at] + SLICE_TOKENS, "right")) - 1)
                part = batch.slice(at, to - at)
                ids = part.column("_ids").flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
                data = pa.array(coder.decode(ids, total[at : to + 1] - total[at]), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), data], names=[*keep, "data"])
                at = to

    return rows.mapInArrow(run, schema)
