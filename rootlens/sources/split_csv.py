"""Records of CSV files whose quoted cells hold line breaks, read in splits.

A reader that meets a line cannot know whether it begins a record: the answer depends on every
quote before it. But a line does only one of four things to that state (it leaves it,
turns it, or sets it to inside or outside of quotes), and so does a whole split.

1. One scan works out what each split does: one small row a split.
2. Composing those rows in file order tells every split the state it begins with.
3. A second scan cuts each split into records. Those that lie within a split leave it whole; the
   first and last piece of a record that crosses splits are joined by the record's own key.

No line travels but those of records that cross splits, at most two pieces a split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.session import scratch_dir

#: Doubled quotes and other characters up to the quote that closes a cell.
_CELL = r'(?:[^"]++|"")*+"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _opens(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside them.

    Whole quoted cells are taken away; a quote that then still stands where a
    cell begins has no partner. Quotes within an unquoted cell are plain characters."""
    rest = F.regexp_replace(line, f'(^|,)"{_CELL}', "$1x")
    return rest.rlike('(?:^|,)"')


def _stays(line: Column) -> Column:
    """Whether a line that begins inside of quotes ends inside them."""
    after = F.concat(F.lit("x"), F.regexp_replace(line, f"^{_CELL}", ""))
    return ~line.rlike(f"^{_CELL}") | _opens(after)


def _marked(lines: DataFrame) -> DataFrame:
    """With the state after each line, begun outside (``opens``) or inside (``stays``)."""
    quoted = F.contains("value", F.lit('"'))
    return lines.withColumns(
        {
            "opens": F.when(quoted, _opens(F.col("value"))).otherwise(False),
            "stays": F.when(quoted, _stays(F.col("value"))).otherwise(True),
        }
    )


# ---------------------------------------------------------------- states


def states_before(opens: np.ndarray, stays: np.ndarray, state: bool) -> np.ndarray:
    """Whether each line of a run begins inside of quotes; one entry more for what follows the run."""
    sets = opens == stays
    turns = np.concatenate(([0], np.cumsum(opens & ~stays)))
    at = np.arange(len(opens))
    # the newest line that sets the state, whatever it was
    last = np.maximum.accumulate(np.where(sets, at, -1)) if len(opens) else at
    known = last >= 0
    base = np.where(known, opens[np.maximum(last, 0)], state) if len(opens) else np.zeros(0, bool)
    since = turns[1:] - np.where(known, turns[np.maximum(last, 0) + 1], 0)
    return np.concatenate(([state], base.astype(bool) ^ (since % 2 == 1)))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block start, first row, end) of the stretches of a batch that share a split."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    at = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or starts[i] != starts[at] or files[i] != files[at]:
            yield files[at], starts[at], at, i
            at = i


def _flags(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).to_numpy(zero_copy_only=False), bool)


_SPLIT = "file string, start long, opens boolean, stays boolean, begins boolean, utf8 boolean"


def _split_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: its end state from either start, whether a record begins in it
    though it begins inside of one, and whether all its lines are UTF-8."""
    found: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        opens, stays, utf8 = (_flags(batch, c) for c in ("opens", "stays", "utf8"))
        for file, start, a, b in _runs(batch):
            here = found.setdefault((file, start), [False, True, False, True])
            here[0] = bool(states_before(opens[a:b], stays[a:b], here[0])[-1])
            inside = states_before(opens[a:b], stays[a:b], here[1])
            here[1] = bool(inside[-1])
            here[2] = here[2] or not inside[:-1].all()
            here[3] = here[3] and bool(utf8[a:b].all())
    columns = [[k[0] for k in found], [k[1] for k in found], *([v[i] for v in found.values()] for i in range(4))]
    kinds = (pa.string(), pa.int64(), *[pa.bool_()] * 4)
    names = [x.split()[0] for x in _SPLIT.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


@dataclass(frozen=True)
class Splits:
    """How the splits of the files begin: inside a cell or not, and in which split the record
    was begun that they begin in the middle of."""

    inside: dict[tuple[str, int], bool]
    owner: dict[tuple[str, int], int]
    utf8: bool


def find_splits(spark: SparkSession, path: str) -> Splits:
    """One row a split reaches the driver, which plans a task for each of them anyway."""
    marked = _marked(_lines(spark, path)).select("file", "start", "opens", "stays", F.is_valid_utf8("value").alias("utf8"))
    rows = marked.mapInArrow(_split_effects, _SPLIT).collect()
    inside: dict[tuple[str, int], bool] = {}
    owner: dict[tuple[str, int], int] = {}
    file, state, begun = None, False, 0
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, state, begun = r["file"], False, r["start"]
        key = (r["file"], r["start"])
        inside[key], owner[key] = state, begun
        if not state or r["begins"]:
            begun = r["start"]
        state = r["stays"] if state else r["opens"]
    return Splits(inside, owner, all(r["utf8"] for r in rows))


# ---------------------------------------------------------------- records

#: Pieces of a record that crosses splits have a key and a place; whole records have neither.
_RECORD = "record binary, key string, place long, first boolean"


def _cut(splits: Splits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[str, int] | None = None
        state = first = begun = False
        lines: list[bytes] = []  # of a record that is not complete yet

        def rows(records: list, keys: list, places: list, firsts: list) -> pa.RecordBatch:
            columns = zip((records, keys, places, firsts), (pa.binary(), pa.string(), pa.int64(), pa.bool_()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=["record", "key", "place", "first"])

        def piece(is_first: bool) -> tuple[bytes, str, int, bool]:
            # what a split begins with belongs to the record begun before it
            begin = here[1] if begun else splits.owner[here]
            return b"\n".join(lines), f"{here[0]}:{begin}", here[1], is_first

        for batch in batches:
            opens, stays = _flags(batch, "opens"), _flags(batch, "stays")
            values = batch.column("value")
            for file, start, a, b in _runs(batch):
                odd: list[tuple[bytes, str | None, int | None, bool]] = []
                if (file, start) != here:
                    if lines:
                        odd.append(piece(first))
                    here, lines = (file, start), []
                    state, first, begun = splits.inside[here], start == 0, False
                states = states_before(opens[a:b], stays[a:b], state)
                state = bool(states[-1])
                whole = ~states[:-1] & ~states[1:]
                if first:  # the header, which blank lines may precede, goes with a mark
                    at = next((k for k in range(b - a) if values[a + k].as_py().strip()), None)
                    if at is not None:
                        whole[at] = False
                for i in np.flatnonzero(~whole).tolist():
                    if not states[i]:
                        begun = True
                    lines.append(values[a + i].as_py())
                    if not states[i + 1]:
                        odd.append((b"\n".join(lines), None, None, first) if begun else piece(first))
                        lines, first = [], False
                if odd:
                    yield rows(*(list(c) for c in zip(*odd, strict=True)))
                plain = values.take(pa.array(a + np.flatnonzero(whole)))
                n = len(plain)
                yield pa.RecordBatch.from_arrays(
                    [plain, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(np.zeros(n, bool))],
                    names=["record", "key", "place", "first"],
                )
        if lines:
            yield rows(*([x] for x in piece(first)))

    return run


def read_records(spark: SparkSession, path: str, codes: tuple[str, str] | None = None) -> tuple[DataFrame, bool]:
    """(record): the records of the files but for each file's first one, as text, in no order;
    and whether the files are UTF-8.

    Files that are not UTF-8 are read as ISO-8859-1, with the characters ``codes`` translated.
    Records end with a line feed, a carriage return before it is dropped; within quotes
    both stay. Quotes within quotes are doubled. An open quote runs to the end of its file.
    The records are written to the shared folder: both scans must see the same splits,
    so neither is left to a later time with other settings."""
    conf, setting = spark.conf, "spark.sql.files.minPartitionNum"
    before = conf.get(setting, None)
    conf.set(setting, before or str(spark.sparkContext.defaultParallelism))
    try:
        splits = find_splits(spark, path)
        marked = _marked(_lines(spark, path)).withColumn("value", F.col("value").cast("binary"))
        cut = marked.select("value", "file", "start", "opens", "stays").mapInArrow(_cut(splits), _RECORD)
        base = scratch_dir(spark)
        cut.write.parquet(f"{base}/cut")
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)
    cut = spark.read.schema(_RECORD).parquet(f"{base}/cut")
    whole = cut.filter("key IS NULL AND NOT first").select("record")
    pieces = F.array_sort(F.collect_list(F.struct("place", F.col("record").alias("text"))))
    crossing = (
        cut.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(pieces.getField("text").alias("texts"), F.max("first").alias("first"))
        .filter("NOT first")
        .select(F.expr("aggregate(slice(texts, 2, size(texts)), texts[0], (a, b) -> concat(a, X'0A', b))").alias("record"))
    )
    both = whole.unionByName(crossing)
    text = F.col("record").cast("string") if splits.utf8 else F.decode("record", "ISO-8859-1")
    if codes and not splits.utf8:
        text = F.translate(text, *codes)
    ended = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return both.select(text.alias("record")).select(ended.alias("record")), splits.utf8


def parse_records(records: DataFrame, names: list[str], schema: str | None = None, **options) -> DataFrame:
    """The cells of ``records`` under ``names``, typed over all rows unless a schema is given."""
    spark = records.sparkSession
    if schema is None and records.isEmpty():
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    reader = spark.read.options(**options).option("columnPruning", False)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    cells = DataFrame(reader._jreader.csv(texts), spark)
    if len(cells.columns) != len(names):
        raise ValueError(f"malformed: the header names {len(names)} columns, the first record has {len(cells.columns)}")
    return cells.toDF(*names)
