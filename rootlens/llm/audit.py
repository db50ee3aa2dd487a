"""What each of five filters removes in every order: a Gray-code walk over their subsets.

The filters fail a document when
  A it has under 50 words (maximal runs other than 0x20 and 0x09 to 0x0D);
  B its distinct words, case-sensitive, are less than 65 % of its words;
  C more than 5 % of its code points are A-Z;
  D it holds any of # $ % & * |;
  E its text equals that of a document with a smaller id, anywhere in the table.

Every document becomes a mask of the filters it fails, and each part of the corpus
at most 32 cells: a mask, its documents, and how many of them are labelled good or
toxic. Over the cells the subsets of filters are walked in Gray-code order: each
step turns one filter on or off, moves the active-failure counter of the cells that
fail it, and adds or takes the cells whose counter leaves or reaches zero from the
running survivors. The 32 stored states give every step of all 120 orders as a
difference of two of them.

All work on texts is built-in column functions; what is shuffled is a row of a few
dozen bytes a document, and cells.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.llm.frames import Scratch, join_counted, only

# The filters, in the order of their bits, and their bounds.
FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "#$%&*|"

COUNTS = ("n", "good", "toxic")
_BLANKS = "\t\n\x0b\x0c\r"


def failures(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, part, text) as doc_id, part, digest, mask; the mask lacks filter E."""
    words = F.array_remove(F.split(F.translate("text", _BLANKS, " " * len(_BLANKS)), " ", -1), "")
    seen = texts.withColumn("words", words).select(
        "doc_id",
        "part",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.size("words").alias("n"),
        F.size(F.array_distinct("words")).alias("different"),
        F.length("text").alias("points"),
        F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")).alias("without_capitals"),
        F.length(F.translate("text", SYMBOLS, "")).alias("without_symbols"),
    )
    n, points = F.col("n").cast("long"), F.col("points").cast("long")
    conditions: list[Column] = [
        n < LEAST_WORDS,
        100 * F.col("different").cast("long") < DISTINCT_PERCENT * n,
        100 * (points - F.col("without_capitals")) > CAPITAL_PERCENT * points,
        points > F.col("without_symbols"),
    ]
    mask = sum((c.cast("int") * (1 << i) for i, c in enumerate(conditions)), F.lit(0))
    return seen.select("doc_id", "part", "digest", mask.alias("mask"))


def walk(masks: np.ndarray, counts: np.ndarray, filters: int = len(FILTERS)) -> np.ndarray:
    """Sums of ``counts`` (a row a cell) over the cells that each subset of filters keeps;
    row s belongs to the subset with bits s."""
    masks = np.asarray(masks, np.int64)
    states = np.zeros((1 << filters, counts.shape[1]), np.int64)
    active = np.zeros(len(masks), np.int64)
    running = counts.sum(axis=0)
    states[0] = running
    subset = 0
    for step in range(1, 1 << filters):
        bit = (step & -step).bit_length() - 1  # the bit in which neighbouring Gray codes differ
        subset ^= 1 << bit
        on = 1 if subset >> bit & 1 else -1
        fails = (masks >> bit & 1).astype(bool)
        active[fails] += on
        if on > 0:
            running = running - counts[fails & (active == 1)].sum(axis=0)
        else:
            running = running + counts[fails & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def steps(masks: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    width = len(FILTERS)
    states = walk(masks, counts)
    kept = states[:, 0]
    failing = [int(counts[(masks >> i & 1).astype(bool), 0].sum()) for i in range(width)]
    alone = [int(counts[masks == 1 << i, 0].sum()) for i in range(width)]
    shapley = [0] * width
    for i in range(width):
        for before in range(1 << width):
            if not before >> i & 1:
                orders = factorial(before.bit_count()) * factorial(width - 1 - before.bit_count())
                shapley[i] += orders * int(kept[before] - kept[before | 1 << i])
    out = []
    for order in permutations(range(width)):
        name, before = "".join(FILTERS[i] for i in order), 0
        for place, i in enumerate(order, 1):
            after = before | 1 << i
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            out.append((name, place, int(kept[after]), removed, failing[i] - removed, alone[i], good, toxic, shapley[i]))
            before = after
    return out


_STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _audit_part(cells: pa.Table) -> pa.Table:
    counts = np.stack([cells[c].to_numpy() for c in COUNTS], axis=1)
    rows = steps(cells["mask"].to_numpy(), counts)
    names = [x.split()[0] for x in _STEPS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    part = cells["part"][0].as_py()
    columns = zip(*((part, *row) for row in rows), strict=True)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def mask_cells(documents: DataFrame, labels: DataFrame, part_column: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: the documents of each part by the filters they fail."""
    scratch = Scratch(documents.sparkSession)
    docs = only(documents, doc_id="doc_id", part=part_column, text="text")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = scratch.store(failures(docs), "failures")

    # filter E: only texts that several rows have are looked up
    same = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("held"))
    same = scratch.store(same.filter("held > 1"), "same")
    several = rows.join(same.select("digest"), "digest", "left_semi")
    several = scratch.store(several, "several")
    later = join_counted(several, same, ["digest"], "held", several.count())
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << FILTERS.index("E"))
    later = later.select("doc_id", "part", (F.col("mask") + again).alias("mask"))
    single = rows.join(same.select("digest"), "digest", "left_anti").select("doc_id", "part", "mask")
    # documents of one id, part and mask are one row from here on
    judged = single.unionByName(later).groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))

    marks = only(labels, doc_id="doc_id", quality="quality", toxic="toxic")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("is_toxic"),
    )
    marks = marks.filter("doc_id IS NOT NULL AND is_good + is_toxic > 0")
    marked = judged.join(marks, "doc_id", "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )


def audit(documents: DataFrame, labels: DataFrame, part_column: str = "source") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley (see the contract's names in ``_STEPS``).

    Defined cases: a null text is the empty text, which fails A alone, and E beside an earlier
    empty text; a null part is the part ''; a row with a null id never fails E, as no id is
    smaller than none; rows that share an id and a text are each one document, and neither
    fails E through the other; an id that is labelled several times is good or toxic if any
    of its labels says so; null labels and labels of a null id say nothing; an empty table gives no
    rows; other columns are ignored, whatever their names."""
    cells = mask_cells(documents, labels, part_column)
    # a part has at most 32 cells
    return cells.groupBy("part").applyInArrow(_audit_part, _STEPS)
