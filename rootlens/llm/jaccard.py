"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

Two documents link when 100 * intersection >= 75 * union of their sets of
five-word shingles. Documents with equal sets are one class, joined as one.

Method. All sets share one order of shingles: rarer ones first. Two sets that
link share at least l shingles among the first n - c + l of either, where n is a
set's size and c the least overlap of a link. A larger l reads longer prefixes
but asks for more shared shingles before a pair is verified; every set takes
the l whose estimated cost, from the frequencies of its own shingles, is least,
and a pair must share the smaller of its two l. No link can be missed.

Plan.
1. One pass over the texts gives each document's size and digest, and a sketch
   of shingle counts. Shingles whose sketch cell holds more than a fixed multiple
   of the mean are common; their number is bounded, and their cell is their frequency.
2. A second pass deals the other shingles, packed by slice of rows, into ranges of
   hashes, where they are counted; those that stand alone cannot link anything and
   end there. The rest goes back to its slice, which builds the sets and prefixes.
3. A large group of near copies must not become all its pairs. So first, in rounds,
   each prefix shingle with a long list of documents links them to a few of them only;
   verified links unite components, and pairs inside one need no check. The rounds read
   the long lists alone. What is left between components is checked whole: documents of
   long lists in blocks against blocks, the others as pairs that are counted, filtered
   by l and verified.
4. Components are united by passing on least labels, with the tables written to the
   shared folder in between; neither links nor documents go to the driver.

Shingles are 64-bit hashes, compared by 48 bits when sets meet; of two texts
with ten thousand words each, that makes one shared shingle too many with
probability below one in a million.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootlens.llm import textops as tx
from rootlens.llm.frames import Scratch
from rootlens.llm.worker import release

# Shingles and the bar of a link.
WORDS = 5
SIMILAR_PERCENT = 75

SLICE_BYTES = 1 << 21
#: Rows of a slice; their numbers fit 16 bits.
SLICE_ROWS = 60_000
#: Cells of the sketch, and how many times the mean makes a cell common.
SKETCH_BITS = 20
COMMON_TIMES = 16
SKETCH_BLOCK = 1 << 14
#: Shingles in one range of hashes.
RANGE_SHINGLES = 3_000_000
#: Verifying a pair costs as much as reading this share of its shingles as candidates.
VERIFY_SHARE = 0.125
#: Lists of documents longer than this are not paired off one by one but in blocks of so many sets.
LONG_LIST = 64
#: Lists longer than this link to so many documents first, so that few of their pairs are left.
STAR_LIST = 8
LEADS = 3
BLOCK_SETS = 256
#: Links, or their ends, that one task writes, and the least number of such tasks.
ROWS_A_TASK = 100_000
LEAST_TASKS = 12
#: Rounds of linking to a few documents per shingle end when the long lists leave so few candidate
#: pairs for each posting of the table, or when a round leaves more than this share of them.
PAIRS_PER_POSTING = 3
HELPED = 0.7
#: Copies of a row that many documents look up.
SALTS = 16


# ---------------------------------------------------------------- packing


@functools.cache
def _zstd() -> tuple[zs.ZstdCompressor, zs.ZstdDecompressor]:
    return zs.ZstdCompressor(level=1), zs.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """The bytes of an array, ordered by significance and compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return _zstd()[0].compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(_zstd()[1].decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values[:0].dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# ---------------------------------------------------------------- sets


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, offsets by document); a document's are distinct and sorted."""
    low = tx.LOWER[data]
    starts, ends, woff = tx.words(low, off)
    hashes = tx.hash_words(low, starts, ends)
    n = np.diff(woff)
    sets = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    toff = np.concatenate(([0], np.cumsum(sets)))
    out = np.empty(int(toff[-1]), tx.U64)
    windows = tx.window_hashes(hashes, WORDS)
    long_ = n >= WORDS
    if long_.any():
        size = sets[long_]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        out[np.repeat(toff[:-1][long_], size) + place] = windows[np.repeat(woff[:-1][long_], size) + place]
    for k in range(1, WORDS):
        # fewer words: the whole sequence is the only shingle
        these = np.flatnonzero(n == k)
        if len(these):
            out[toff[:-1][these]] = tx.mix(tx.window_hashes(hashes, k)[woff[:-1][these]] + tx.U64(k))
    for a, b in zip(toff[:-1].tolist(), toff[1:].tolist(), strict=True):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[toff[:-1][sets > 0]] = True
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[toff]


def digests_of(shingles: np.ndarray, toff: np.ndarray) -> list[bytes | None]:
    return [xxhash.xxh3_128_digest(shingles[a:b].tobytes()) if b > a else None for a, b in zip(toff[:-1].tolist(), toff[1:].tolist(), strict=True)]


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part in tx.slices(whole, text, SLICE_BYTES):
            for at in range(0, part.num_rows, SLICE_ROWS):
                yield part.slice(at, SLICE_ROWS)


def _distinct(digests: list[bytes | None]) -> list[int]:
    """The first row of each set in a slice; empty sets left out."""
    seen: dict[bytes, int] = {}
    for i, d in enumerate(digests):
        if d is not None:
            seen.setdefault(d, i)
    return list(seen.values())


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles & tx.U64((1 << SKETCH_BITS) - 1)).astype(np.int64)


_SIZED = "doc_id long, n_shingles long, digest binary, block int, counts binary"


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; at the end of the task a row per filled block of its sketch."""
    release()
    names = [x.split()[0] for x in _SIZED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in _slices(batches, "text"):
        shingles, toff = shingle_sets(*tx.flat(batch.column("text")))
        digests = digests_of(shingles, toff)
        rows = _distinct(digests)
        if rows:
            held = np.concatenate([shingles[toff[i] : toff[i + 1]] for i in rows])
            sketch += np.bincount(_cells(held), minlength=len(sketch))
        none = pa.nulls(batch.num_rows)
        columns = [batch.column("doc_id"), pa.array(np.diff(toff)), pa.array(digests, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)
    blocks = sketch.reshape(-1, SKETCH_BLOCK)
    filled = np.flatnonzero(blocks.any(1))
    none = pa.nulls(len(filled))
    yield pa.RecordBatch.from_arrays(
        [none.cast(kinds[0]), none.cast(kinds[1]), none.cast(kinds[2]), pa.array(filled, pa.int32()), pa.array([pack(blocks[b]) for b in filled], pa.binary())],
        names=names,
    )


def _add_sketches(table: pa.Table) -> pa.Table:
    total = np.zeros(SKETCH_BLOCK, np.int64)
    for data in table["counts"]:
        total += unpack(data.as_py(), np.int64)
    return pa.table({"block": table["block"][:1], "salt": pa.array([0], pa.int32()), "counts": pa.array([pack(total)], pa.binary())})


def common_cells(sized: DataFrame) -> dict[int, int]:
    """The sketch cells above COMMON_TIMES the mean, at most 2**SKETCH_BITS / COMMON_TIMES of them."""
    shape = "block int, salt int, counts binary"
    parts = sized.filter(F.col("block").isNotNull()).select("block", F.pmod(F.xxhash64("counts"), F.lit(64)).cast("int").alias("salt"), "counts")
    summed = parts.groupBy("block", "salt").applyInArrow(_add_sketches, shape).groupBy("block").applyInArrow(_add_sketches, shape)
    cells = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in summed.collect():  # as many rows as the sketch has blocks
        cells[row["block"] * SKETCH_BLOCK : (row["block"] + 1) * SKETCH_BLOCK] = unpack(bytes(row["counts"]), np.int64)
    common = np.flatnonzero(cells > COMMON_TIMES * max(1.0, cells.mean()))
    return dict(zip(common.tolist(), cells[common].tolist(), strict=True))


# ---------------------------------------------------------------- shingles that can link

#: kind -1: the slice's sets (a: sizes, b: digests); -2: common shingles; from 0: a range of hashes.
_PIECES = "slice long, kind int, a binary, b binary, c binary"


def _pieces(common, ranges: int, heads: bool):
    """The pieces of kind below 0 if ``heads``, else the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        frequency = np.zeros(1 << SKETCH_BITS, np.int64)
        for cell, count in common.value.items():
            frequency[cell] = count
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in _PIECES.split(", ")]
        for batch in _slices(batches, "text"):
            shingles, toff = shingle_sets(*tx.flat(batch.column("text")))
            digests = digests_of(shingles, toff)
            rows = _distinct(digests)
            if not rows:
                continue
            size = np.array([toff[i + 1] - toff[i] for i in rows])
            held = np.concatenate([shingles[toff[i] : toff[i + 1]] for i in rows])
            which = np.repeat(np.arange(len(rows), dtype=np.uint16), size)
            listed = b"".join(digests[i] for i in rows)
            slice_id = xxhash.xxh3_64_intdigest(listed) >> 1
            known = frequency[_cells(held)]
            usual = known == 0
            short = held >> tx.U64(16)
            out = []
            if heads:
                out.append((slice_id, -1, pack(size.astype(np.int64)), listed, None))
                if not usual.all():
                    out.append((slice_id, -2, pack(which[~usual]), pack(short[~usual]), pack(known[~usual])))
            else:
                order = np.argsort(held[usual], kind="stable")
                which, short = which[usual][order], short[usual][order]
                kind = ((short >> tx.U64(24)) * tx.U64(ranges) >> tx.U64(24)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(kind, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(kind)][: len(cuts)], strict=True):
                    out.append((slice_id, int(kind[a]), pack(which[a:b]), pack_sorted(short[a:b]), None))
            if not out:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def _count_range(table: pa.Table) -> pa.Table:
    """Of one range of hashes, the shingles that stand in two sets or more, by slice."""
    pieces = [unpack_sorted(x.as_py()) for x in table["b"]]
    sizes = np.array([len(x) for x in pieces])
    shingles = np.concatenate(pieces)
    del pieces
    order = np.argsort(shingles, kind="stable")
    run = shingles[order]
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    count = np.diff(np.append(starts, len(run)))
    often = np.empty(len(run), np.int64)
    often[order] = np.repeat(count, count)
    out, at = [], 0
    for slice_id, a, n in zip(table["slice"].to_pylist(), table["a"], sizes.tolist(), strict=True):
        kept = np.flatnonzero(often[at : at + n] > 1)
        if len(kept):
            out.append((slice_id, -2, pack(unpack(a.as_py(), np.uint16)[kept]), pack(shingles[at : at + n][kept]), pack(often[at : at + n][kept])))
        at += n
    columns = zip(*out, strict=True) if out else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["slice", "kind", "a", "b", "c"])


def best_length(often: np.ndarray, n: int) -> tuple[int, int]:
    """(l, prefix length) of a set of n shingles, of which those in ``often`` (rising
    frequencies) stand in other sets too; (0, 0) if no other set can link with it."""
    need = -(-SIMILAR_PERCENT * n // 100)
    if len(often) < need:
        return 0, 0
    ells = np.arange(1, need + 1)
    read = np.cumsum(often - 1.0)[len(often) - need :][: len(ells)]
    cost = read + VERIFY_SHARE * n * read / ells
    ell = int(np.argmin(cost)) + 1
    return ell, len(often) - need + ell


_SETS = "node binary, n int, shingles binary, ell int, prefix binary"


def _build_sets(table: pa.Table) -> pa.Table:
    """The sets of one slice that can link at all, with their prefixes."""
    kind = table["kind"].to_numpy()
    head = int(np.flatnonzero(kind == -1)[0])
    sizes = unpack(table["a"][head].as_py(), np.int64)
    listed = table["b"][head].as_py()
    body = np.flatnonzero(kind == -2)
    out = []
    if len(body):
        which = np.concatenate([unpack(table["a"][int(i)].as_py(), np.uint16) for i in body])
        shingle = np.concatenate([unpack(table["b"][int(i)].as_py(), np.uint64) for i in body])
        often = np.concatenate([unpack(table["c"][int(i)].as_py(), np.int64) for i in body])
        order = np.lexsort((shingle, often, which))
        which, shingle, often = which[order], shingle[order], often[order]
        # equal slices come together as one; their shingles then stand here twice
        once = np.ones(len(which), bool)
        once[1:] = (which[1:] != which[:-1]) | (shingle[1:] != shingle[:-1])
        which, shingle, often = which[once], shingle[once], often[once]
        ends = np.searchsorted(which, np.arange(len(sizes) + 1))
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            ell, length = best_length(often[a:b], int(sizes[i]))
            if ell:
                out.append((listed[16 * i : 16 * i + 16], int(sizes[i]), pack_sorted(np.sort(shingle[a:b])), ell, pack(shingle[a : a + length])))
    columns = zip(*out, strict=True) if out else [[]] * 5
    kinds = [pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["node", "n", "shingles", "ell", "prefix"])


def linkable_sets(texts: DataFrame, sized: DataFrame, scratch: Scratch) -> DataFrame:
    """id, node (the digest of a set), n, shingles, ell, prefix of every set that may link with another.

    The ids are short numbers for the joins that follow; they are fixed by being written."""
    spark = texts.sparkSession
    common = spark.sparkContext.broadcast(common_cells(sized))
    total = sized.agg(F.sum("n_shingles")).first()[0] or 0
    ranges = max(1, -(-total // RANGE_SHINGLES))
    # reading the texts once more takes less than keeping all pieces on disk
    heads, pieces = (texts.select("text").mapInArrow(_pieces(common, ranges, h), _PIECES) for h in (True, False))
    counted = pieces.groupBy("kind").applyInArrow(_count_range, _PIECES)
    built = counted.unionByName(heads).groupBy("slice").applyInArrow(_build_sets, _SETS)
    # a set may stand in many slices; its rows are equal, and each task sends one
    first = [F.first(c).alias(c) for c in ("n", "shingles", "ell", "prefix")]
    return scratch.store(built.groupBy("node").agg(*first).withColumn("id", F.monotonically_increasing_id()), "sets")


# ---------------------------------------------------------------- links


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prefixes = [unpack(x.as_py(), np.uint64).astype(np.int64) for x in batch.column("prefix")]
        if not prefixes:
            continue
        at = pa.array(np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes]))
        columns = [pa.array(np.concatenate(prefixes)), *(batch.column(c).take(at) for c in ("id", "n", "ell"))]
        yield pa.RecordBatch.from_arrays(columns, names=["shingle", "node", "n", "ell"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, held, last = [], None, None
        columns = (batch.column("sa"), batch.column("sb"), batch.column("na").to_pylist(), batch.column("nb").to_pylist())
        for i, (a, b, n, m) in enumerate(zip(*columns, strict=True)):
            b = b.as_py()
            if b != last:
                held, last = unpack_sorted(b), b
            shared = len(np.intersect1d(unpack_sorted(a.as_py()), held, assume_unique=True))
            if 100 * shared >= SIMILAR_PERCENT * (n + m - shared):
                keep.append(i)
        kept = batch.select(["ca", "cb"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(kept.columns, names=["a", "b"])


def _incidence(row: np.ndarray, shingle: np.ndarray, rows: int, columns: np.ndarray) -> np.ndarray:
    at = np.searchsorted(columns, shingle)
    at[at == len(columns)] = 0
    held = columns[at] == shingle
    out = np.zeros((rows, len(columns)), np.float32)
    out[row[held], at[held]] = 1
    return out


def _cross_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between the components of two blocks of sets, as few as join all that link."""
    sides = []
    for table in (left, right):
        sets = [unpack_sorted(x.as_py()) for x in table["shingles"]]
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        sides.append((row, np.concatenate(sets) if sets else np.zeros(0, np.uint64), table["n"].to_numpy(), table["comp"].to_numpy()))
    (row_a, all_a, n_a, comp_a), (row_b, all_b, n_b, comp_b) = sides
    both = np.intersect1d(all_a, all_b)
    shared = np.zeros((len(n_a), len(n_b)), np.float32)
    for at in range(0, len(both), 4096):
        some = both[at : at + 4096]
        shared += _incidence(row_a, all_a, len(n_a), some) @ _incidence(row_b, all_b, len(n_b), some).T
    linked = 100 * shared >= SIMILAR_PERCENT * (n_a[:, None] + n_b[None, :] - shared)
    linked &= comp_a[:, None] != comp_b[None, :]
    pairs = np.argwhere(linked)
    found = np.unique(np.stack((comp_a[pairs[:, 0]], comp_b[pairs[:, 1]]), axis=1), axis=0) if len(pairs) else np.zeros((0, 2), np.int64)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b in found.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _sizes_fit(n, m):
    return 100 * F.least(n, m) >= SIMILAR_PERCENT * F.greatest(n, m)


def _tasks_for(rows: int) -> int:
    return max(LEAST_TASKS, -(-rows // ROWS_A_TASK))


def least_labels(edges: DataFrame, scratch: Scratch, name: str, many: int | None = None) -> DataFrame:
    """node, label: the least node of each component of the edges a, b, of which there are at
    most ``many``; None counts them.

    Every round passes the least label to the neighbours and then to a label's
    own label, so paths halve. A round has as many tasks as the edges ask for: the few
    edges of a small table would otherwise fill a file for each partition of a shuffle."""
    few = _tasks_for(2 * (edges.count() if many is None else many))
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.store(both.distinct().coalesce(few), f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label"))
    labels = scratch.store(labels.coalesce(few), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("via"))
        owners = labels.select(F.col("node").alias("via"), F.col("label").alias("top"))
        moved = moved.join(owners, "via").select("node", F.least("via", "top").alias("label"), (F.least("via", "top") != F.col("old")).alias("changed"))
        moved = scratch.store(moved.coalesce(few), f"{name}-{step}")
        labels = moved.select("node", "label")
        scratch.drop(f"{name}-{step - 1}")
        if moved.filter("changed").limit(1).count() == 0:
            scratch.drop(f"{name}-edges")
            return labels


class _Components:
    """Nodes and their component so far, on disk after each round."""

    def __init__(self, sets: DataFrame, scratch: Scratch):
        self.sets, self.scratch = sets, scratch
        postings = sets.select("id", "n", "ell", "prefix").mapInArrow(_explode, "shingle long, node long, n int, ell int")
        postings = scratch.store(postings, "postings")
        self.size = postings.count()
        several = postings.groupBy("shingle").agg(F.count("*").alias("held")).filter("held > 1")
        #: postings of shingles in several prefixes, with the length of their list
        self.open = scratch.store(postings.join(several, "shingle"), "open")
        scratch.drop("postings")
        #: those of the lists that link to a few documents first; the rounds read no others
        self.wide = self.open.filter(F.col("held") > STAR_LIST).withColumn("comp", F.col("node"))
        self.labels: DataFrame | None = None
        self.round = 0

    def pairs_left(self) -> int:
        """Pairs between components in the lists that the rounds read."""
        per = self.wide.groupBy("shingle", "comp").count().groupBy("shingle")
        per = per.agg(F.sum("count").alias("all"), F.sum(F.col("count") * F.col("count")).alias("own"))
        return per.agg(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()[0] or 0

    def unite(self, links: DataFrame) -> DataFrame | None:
        """Unite the components that verified links join; what became of them, None if there are no links."""
        self.round += 1
        links = self.scratch.store(links.coalesce(_tasks_for(self.size)), f"links{self.round}")
        if links.limit(1).count() == 0:
            return None
        new = least_labels(links, self.scratch, f"labels{self.round}")
        if self.labels is None:
            self.labels = new
        else:
            later = new.select(F.col("node").alias("label"), F.col("label").alias("next"))
            old = self.labels.join(later, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
            both = old.unionByName(new.join(self.labels.select("node"), "node", "left_anti"))
            self.labels = self.scratch.store(both, f"found{self.round}")
        return new

    def star_round(self) -> bool:
        """Link each document of a long list to a few of its shingle, others in each round."""
        new = self.unite(self.star_links())
        if new is None:
            return False
        moved = self.wide.join(new.select(F.col("node").alias("comp"), "label"), "comp", "left")
        self.wide = self.scratch.store(moved.withColumn("comp", F.coalesce("label", "comp")).drop("label"), f"wide{self.round}")
        self.scratch.drop(f"wide{self.round - 1}")
        return True

    def star_links(self) -> DataFrame:
        """Each document against LEADS of its shingle; ends are components."""
        first = self.round * LEADS
        found = [F.min(F.struct(F.xxhash64("node", F.lit(first + i)).alias("h"), "node", "comp", "n")) for i in range(LEADS)]
        leads = self.wide.groupBy("shingle").agg(F.array(*found).alias("leads"))
        pairs = (
            self.wide.join(leads, "shingle")
            .withColumn("lead", F.explode(F.array_distinct(F.transform("leads", lambda x: x.dropFields("h")))))
            .filter((F.col("comp") != F.col("lead.comp")) & _sizes_fit(F.col("n"), F.col("lead.n")))
            .select(F.col("node").alias("a"), F.col("lead.node").alias("b"), F.col("comp").alias("ca"), F.col("lead.comp").alias("cb"))
            .distinct()  # at most LEADS times as many as there are postings
        )
        return self._linked(pairs)

    def _placed(self) -> DataFrame:
        """The open postings, with the component of each."""
        if self.labels is None:
            return self.open.withColumn("comp", F.col("node"))
        return self.open.join(self.labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")

    def last_links(self) -> DataFrame:
        """Links between components, enough of them to join all that link."""
        placed = self._placed()
        links = self._linked(_pairs(placed.filter(F.col("held") <= LONG_LIST)))
        dense = placed.filter(F.col("held") > LONG_LIST)
        apart = dense.groupBy("shingle").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least <> most")
        dense = self.scratch.store(dense.join(apart, "shingle", "left_semi").coalesce(_tasks_for(self.size)), "dense")
        many = dense.count()
        return links.unionByName(self.dense_links(dense, many)).distinct() if many else links

    def dense_links(self, dense: DataFrame, many: int) -> DataFrame:
        """Every pair of different components that shares a shingle with a long list, of ``many`` postings.

        Documents that such shingles chain together are a cluster. Its documents are
        dealt into blocks, a large component into blocks of its own, and each two
        blocks of a cluster meet once, with their whole sets; what leaves a pair of
        blocks is at most one link for each component in it."""
        leads = dense.groupBy("shingle").agg(F.min("node").alias("b"))
        edges = dense.join(leads, "shingle").select(F.col("node").alias("a"), "b").distinct()
        clusters = least_labels(edges, self.scratch, "clusters", many)
        members = dense.select("node", "comp").distinct().join(clusters, "node")
        held = members.groupBy("label", "comp").agg(F.count("*").alias("held"))
        held = held.withColumn("own", F.when(F.col("held") >= BLOCK_SETS, F.col("comp")))
        size = held.groupBy("label", "own").agg(F.sum("held").alias("size"))
        of_comp = held.alias("h").join(size.alias("s"), F.expr("h.label = s.label AND h.own <=> s.own"))
        of_comp = of_comp.select("h.label", "comp", "h.own", F.ceil(F.col("size") / BLOCK_SETS).alias("blocks"))
        number = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))
        dealt = members.join(of_comp, ["label", "comp"]).select(
            "label", "node", "comp", "own", F.xxhash64("label", "own", number).alias("block")
        )
        dealt = self.scratch.store(dealt.coalesce(_tasks_for(many)), "dealt")
        blocks = dealt.select("label", "block", "own").distinct()
        other = blocks.select("label", F.col("block").alias("block_b"), F.col("own").alias("own_b"))
        meet = (
            blocks.withColumnsRenamed({"block": "block_a", "own": "own_a"})
            .join(other, "label")
            .filter((F.col("block_a") <= F.col("block_b")) & F.expr("coalesce(own_a <> own_b, true)"))
            .select("block_a", "block_b")
        )
        meet = self.scratch.store(meet, "meet")
        whole = dealt.join(self.sets.select(F.col("id").alias("node"), "n", "shingles"), "node")
        whole = self.scratch.store(whole.select("block", "comp", "n", "shingles"), "whole")
        meet_b, whole_b = self.scratch.again(meet, "meet"), self.scratch.again(whole, "whole")
        left = meet.join(whole.withColumnRenamed("block", "block_a"), "block_a").groupBy("block_a", "block_b")
        right = meet_b.join(whole_b.withColumnRenamed("block", "block_b"), "block_b").groupBy("block_a", "block_b")
        return left.cogroup(right).applyInArrow(_cross_blocks, "a long, b long")

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """The components ca, cb of the pairs that link, as a, b; of the pairs a, b the side
        with fewer distinct sets should be b."""
        left = self.sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
        right = self.sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
        both = pairs.join(left, "a").join(right, "b")
        return both.mapInArrow(_verify, "a long, b long").distinct()


def _pairs(open_: DataFrame) -> DataFrame:
    names = ("node", "comp", "n", "ell")
    left = open_.select("shingle", *[F.col(c).alias(f"{c}_a") for c in names])
    right = open_.select("shingle", *[F.col(c).alias(f"{c}_b") for c in names])
    return (
        left.join(right, "shingle")
        .filter((F.col("comp_a") < F.col("comp_b")) & _sizes_fit(F.col("n_a"), F.col("n_b")))
        .groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .agg(
            F.count("*").alias("shared"),
            F.first(F.least("ell_a", "ell_b")).alias("needed"),
            F.first("comp_a").alias("ca"),
            F.first("comp_b").alias("cb"),
        )
        .filter("shared >= needed")
        .select("a", "b", "ca", "cb")
    )


def component_labels(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label (digests) of every set that links with another."""
    parts = _Components(sets, scratch)
    enough = PAIRS_PER_POSTING * parts.size
    before = None
    # when a round has not helped, no further one is tried: all that is left is checked
    while (left := parts.pairs_left()) > enough and (before is None or left <= HELPED * before) and parts.star_round():
        before = left
    parts.unite(parts.last_links())
    found = parts.labels
    names = sets.select("id", "node")
    if found is None:
        return names.limit(0).select("node", F.col("node").alias("label"))
    digest = names.select(F.col("id").alias("label"), F.col("node").alias("top"))
    own = names.withColumnRenamed("node", "digest").withColumnRenamed("id", "node")
    found = found.join(digest, "label").join(own, "node").select(F.col("digest").alias("node"), F.col("top").alias("label"))
    return scratch.store(found, "labels")


# ---------------------------------------------------------------- the operator


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, digest, grp.

    component_id is the smallest doc_id that links reach, its own included; grp
    is the group's key and digest that of the document's own set.

    Defined cases: a null text or one without words has an empty set, links with
    nothing and has neither digest nor grp; with fewer than five words the whole sequence is the only
    shingle; a null id is never the smallest, so a group of null ids has a null
    component_id; rows that share an id are still separate documents; repeated
    rows are documents with equal sets; an empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession)
    return _near_duplicates(documents, scratch, id_column, text_column)


def _near_duplicates(documents: DataFrame, scratch: Scratch, id_column: str, text_column: str) -> DataFrame:
    texts = documents.select(documents[id_column].cast("long").alias("doc_id"), documents[text_column].alias("text"))
    passed = scratch.store(texts.mapInArrow(_sized, _SIZED), "sized")
    sized = passed.filter(F.col("block").isNull()).select("doc_id", "n_shingles", "digest")
    sets = linkable_sets(texts, passed, scratch)
    labels = component_labels(sets, scratch)
    classes = sized.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("held"))
    named = classes.join(labels.select(F.col("node").alias("digest"), "label"), "digest", "left").withColumn("grp", F.coalesce("label", "digest"))
    named = scratch.store(named.select("digest", "grp", "least", "held"), "classes")
    groups = named.groupBy("grp").agg(F.min("least").alias("component_id"), F.sum("held").alias("held"))
    # only groups of several documents are looked up; a large one by several copies of its row
    wanted = (
        named.select("digest", "grp")
        .join(groups.filter("held > 1").select("grp", "component_id"), "grp")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)).cast("int"))
    joined = salted.join(wanted, ["digest", "salt"], "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("grp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "digest",
        F.coalesce("grp", "digest").alias("grp"),
    )


def keep_one(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with all their columns, one of each group of near_duplicates: that with
    the smallest id, null ids last.

    Defined cases: documents without words all stay; of rows that share the smallest id and the
    set of shingles the one with the smallest text stays, of repeated rows one; an empty table
    gives no rows; other columns keep their names and values, whatever they are called."""
    scratch = Scratch(documents.sparkSession)
    found = scratch.store(_near_duplicates(documents, scratch, id_column, text_column), "found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("kept")
    kept = found.filter(F.col("grp").isNotNull()).groupBy("grp").agg(first)
    kept = kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.digest").alias("kept_digest"))

    def add_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in _slices(batches, "text"):
            digests = digests_of(*shingle_sets(*tx.flat(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=[*batch.schema.names, "digest"])

    # the caller's columns but the text travel as one
    given = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != text_column]).alias("given")
    rows = documents.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"), given)
    marked = rows.mapInArrow(add_digest, rows.select("*").schema.add("digest", "binary"))
    same = F.col("digest").eqNullSafe(F.col("kept_digest")) & F.col("id").eqNullSafe(F.col("kept_id"))
    order = F.struct("text", F.xxhash64(F.to_json("given")))
    one = marked.filter(F.col("digest").isNotNull()).join(kept, same, "left_semi")
    one = one.groupBy("id", "digest").agg(F.min_by(F.struct("text", "given"), order).alias("row")).select("row.*")
    both = one.unionByName(marked.filter(F.col("digest").isNull()).select("text", "given"))
    return both.select(*[F.col("text").alias(c) if c == text_column else F.col("given").getField(c).alias(c) for c in documents.columns])
