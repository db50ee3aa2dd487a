"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts from the same number of copies, target over
size; its whole part is taken, the fraction is a probability. Two fractional
documents are paired: mass moves from one to the other, so that the words they
are expected to give stay the same, until one of them is at 0 or 1; which way it
moves is random with the odds that keep each probability's expectation. One
fractional document at most is left of a block. These residuals meet in a tree:
a fixed number of blocks of a source become one, until one block is left, whose
last residual is rounded at random.

Bounds: a block holds about BLOCK_ROWS rows whatever the size of a source, a
node of the tree at most FAN_IN rows; random numbers are hashes of ids, so
reruns agree. Nothing but one number per round of resharing reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import Scratch

# The shares.
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MAX_TIMES = 2

#: Rows that one task pairs at the start of the tree, and residuals that meet in one node.
BLOCK_ROWS = 8192
FAN_IN = 256
#: Copies of each source's row in a lookup.
SALTS = 16
SEED = 20240101
SLICE_BYTES = 1 << 22


def count_words(documents: DataFrame, text_column: str, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and size, the words of the whole text."""
    text = text_column if text_column in keep else "_text"
    rows = documents.select(*[documents[c] for c in keep], *([] if text in keep else [documents[text_column].alias(text)]))
    schema = rows.select(*keep).schema.add("size", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tx.slices(whole, text, SLICE_BYTES):
                _, _, off = tx.words(*tx.flat(batch.column(text)))
                columns = [*(batch.column(c) for c in keep), pa.array(np.diff(off), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "size"])

    return rows.mapInArrow(run, schema)


def ranked_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size, source_rows, weight: sources by code point, null last, weights repeating.

    Ranks come from a range partitioning: the rank within a partition plus the
    sizes of the partitions before it, so no task holds all sources."""
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("source_rows"))
    ordered = (
        totals.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
        .withColumn("at", F.monotonically_increasing_id())
    )
    ordered = scratch.store(ordered, "sources")
    # the id holds the partition above its 33rd bit
    part = F.shiftright("at", 33)
    counts = sorted((r[0], r[1]) for r in ordered.groupBy(part).count().collect())
    before, offsets = 0, []
    for number, count in counts:
        offsets += [F.lit(number), F.lit(before)]
        before += count
    start = F.create_map(*offsets)[part] if offsets else F.lit(0)
    rank = start + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(rank, F.lit(len(WEIGHTS))) + 1).cast("int"))
    return ordered.select("source", "source_size", "source_rows", weight.alias("weight"))


def source_targets(sources: DataFrame, total: float | None = None) -> DataFrame:
    """Adds target: shares of ``total`` by weight; a source above MAX_TIMES its size stops
    there and the rest is shared again among the others, until none is above.

    A round needs two sums of the sources. The level only rises, so it is over
    when a round changes nothing, after as many rounds as further sources stop."""
    everything, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = (everything or 0) * TOTAL_PERCENT / 100 if total is None else total
    cap = F.col("source_size") * MAX_TIMES

    def share(left: float, weight: int):
        return F.lit(float(left)) * F.col("weight") / F.lit(weight)

    left, weight, level = total, weights or 0, None
    while weight and (left, weight) != level:
        level = (left, weight)
        above = share(*level) > cap
        held = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(above, F.col("weight")))).first()
        left, weight = total - (held[0] or 0), weights - (held[1] or 0)
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.when(share(*level) > cap, cap.cast("double")).otherwise(share(*level)))


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    h = np.full(1, SEED, tx.U64)
    for p in parts:
        h = tx.mix(h * tx.U64(0x9E3779B97F4A7C15) + np.asarray(p).astype(tx.U64))
    return (h >> tx.U64(11)).astype(float) / 2**53


def pivot(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Round probabilities by pairing; (rounded, index of the one left fractional or -1).

    Sizes are positive. The sum of p * size is kept as long as a pair remains.
    """
    p = p.copy()
    open_ = -1
    for i in range(len(p)):
        if p[i] <= 0 or p[i] >= 1:
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b = open_, i
        wa, wb = size[a], size[b]
        up = min((1 - p[a]) * wa, p[b] * wb)  # words that can move from b to a
        down = min(p[a] * wa, (1 - p[b]) * wb)  # and from a to b
        if u[i] * (up + down) < down:
            to_a, full, empty = up, (1 - p[a]) * wa <= up, p[b] * wb <= up
        else:
            to_a, full, empty = -down, (1 - p[b]) * wb <= down, p[a] * wa <= down
        pa_, pb = p[a] + to_a / wa, p[b] - to_a / wb
        if to_a > 0:
            p[a], p[b] = 1.0 if full else pa_, 0.0 if empty else pb
        else:
            p[a], p[b] = 0.0 if empty else pa_, 1.0 if full else pb
        left = [k for k in (a, b) if 0 < p[k] < 1]
        open_ = left[0] if left else -1
    return p, open_


_TREE = "row long, source string, doc_id long, size long, n long, whole long, sure long, p double, source_size long, target double, block long, open boolean"


def _round_groups(level: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        """One block of one source: at most one row stays open, none on the last level."""
        table = table.take(pa.array(np.lexsort((table["size"].to_numpy(), table["row"].to_numpy()))))
        row, size, p = (table[c].to_numpy() for c in ("row", "size", "p"))
        p, left = pivot(p, size, _uniform(level, row, np.arange(len(p))))
        is_open = np.zeros(len(p), bool)
        if left >= 0 and last:
            p[left] = float(_uniform(level, row[left : left + 1], -1)[0] < p[left])
        elif left >= 0:
            is_open[left] = True
        for name, values in (("p", p), ("open", is_open)):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
        return table

    return run


def round_copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with p rounded to 0 or 1; they have the columns of the tree and ``blocks`` of their source."""
    width = rows.agg(F.max("blocks")).first()[0] or 0
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    names = [c.split()[0] for c in _TREE.split(", ")]
    current = rows.filter(fractional).withColumns(
        {"block": F.pmod(F.xxhash64("row", F.lit(SEED)), F.col("blocks")), "open": F.lit(True)}
    )
    done = rows.filter(~fractional).withColumns({"p": F.lit(0.0), "block": F.lit(0).cast("long"), "open": F.lit(False)}).select(names)
    level = 0
    while width:
        last = width <= 1
        rounded = current.select(names).groupBy("source", "block").applyInArrow(_round_groups(level, last), _TREE)
        rounded = scratch.store(rounded, f"round{level}")
        done = done.unionByName(rounded.filter(~F.col("open")))
        current = rounded.filter("open").withColumn("block", F.floor(F.col("block") / FAN_IN))
        width, level = 0 if last else -(-width // FAN_IN), level + 1
    return done


def plan_copies(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, source, size, place, source_size, target, copies: one row per row of ``documents``.

    Rows that agree in doc_id, source and size are numbered by ``place``, from 1.

    Defined cases: a null text has size 0; a text without words takes no part in
    the rounding; a null source is a source, after all others; null ids count as
    one id; a source without words has target 0 and no copies; repeated rows are
    rounded as one document that is that many times as likely, so a row repeated
    any number of times is one row here; an empty table gives no rows; other
    columns are ignored.
    """
    scratch = Scratch(documents.sparkSession)
    named = documents.select(
        documents[id_column].cast("long").alias("doc_id"), documents[source_column].alias("source"), documents[text_column].alias("text")
    )
    sizes = count_words(named, "text", ["doc_id", "source"])
    sizes = scratch.store(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    sources = source_targets(ranked_sources(sizes, scratch))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    # a source may hold a third of all rows: its row is copied, its documents are salted
    sources = scratch.store(sources.withColumn("each", each), "targets").withColumn("salt", salts)
    salted = sizes.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    expected = F.col("n") * (F.col("each") - F.floor("each"))
    rows = (
        salted.alias("d")
        .join(sources.alias("t"), F.expr("d.source <=> t.source AND d.salt = t.salt"))
        .select(
            F.xxhash64("doc_id", "size").alias("row"),
            "d.source",
            "doc_id",
            "size",
            "n",
            F.floor("each").alias("whole"),
            F.floor(expected).alias("sure"),
            (expected - F.floor(expected)).alias("p"),
            "source_size",
            "target",
            F.ceil(F.col("source_rows") / BLOCK_ROWS).cast("long").alias("blocks"),
        )
    )
    rounded = round_copies(scratch.store(rows, "rows"), scratch)
    extra = F.col("sure") + F.col("p").cast("long")
    return rounded.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        "doc_id",
        "source",
        "size",
        "place",
        "source_size",
        "target",
        (F.col("whole") + F.when(F.col("place") <= extra, 1).otherwise(0)).alias("copies"),
    )


def mixed(documents: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``documents`` (doc_id, text, source and more), each as
    often as planned; rows without words as often as their source's whole part says.

    Defined cases: as in plan_copies; rows that agree in doc_id, source and size are told apart by
    their texts, repeated rows are interchangeable; an empty table gives no rows; other columns
    keep their names and values, whatever they are called."""
    plan = plan_copies(documents).filter(F.col("copies") > 0)
    named = ("doc_id", "text", "source")
    others = [c for c in documents.columns if c not in named]
    given = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("given")] if others else []
    rows = documents.select(*named, *given)
    sized = count_words(rows, "text", rows.columns)
    same = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("text"))
    placed = sized.withColumn("place", F.row_number().over(same))
    on = " AND ".join(f"a.{c} <=> b.{c}" for c in ("doc_id", "source", "size", "place"))
    taken = placed.alias("a").join(plan.alias("b"), F.expr(on))
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
    return taken.select(*[F.col(f"a.{c}") if c in named else F.col("a.given").getField(c).alias(c) for c in documents.columns])
