"""Near duplicates among embeddings by iterative quantisation and multi-index Hamming tables.

Two vectors of one label and length link when their cosine, in double precision, is at least
0.98. Equal vectors of a label are one node with a count.

Fitting, on a bounded sample: unit vectors are centred and rotated by their principal axes;
iterative quantisation then turns the axes until signs lose as little as possible,
which balances the bits. Several rotations, learned from different starts, give as many
bits as the tables need.

Tables. The code of a vector is cut into substrings, one a table; vectors that agree in a
whole substring, label and length meet in a bucket. Codes that differ in fewer bits than there
are tables always meet. The substrings grow with the logarithm of the table, so
that unlike vectors rarely meet, and there are as many tables as find the target
share of planted pairs whose cosine is exactly the threshold.

Reranking. Buckets are compared whole with the original vectors, in blocks of bounded size;
a pair that meets in several tables counts in the first. In a large
bucket the vectors within half the threshold's angle of a leader form a core: the
angles of two of them add up to the threshold's at most, so all link, are counted
without being compared, and never become all their pairs. What leaves a task is a count for each
vector and the links that join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootlens.llm.frames import Scratch, join_counted, tasks
from rootlens.llm.jaccard import least_labels
from rootlens.llm.textops import mix

# Fixed value: the bar of a link.
SIMILAR = 0.98

#: Vectors the rotations are learned on, and the most principal axes of a rotation.
SAMPLE_ROWS = 8192
AXES = 96
ITERATIONS = 40
#: Share of planted pairs at the bar that the tables must find, and the most tables.
TARGET_RECALL = 0.998
MOST_TABLES = 64
#: Narrowest and widest substring.
BITS = (4, 28)
#: Vectors of a block, and rows packed into one task's group of small buckets.
BLOCK = 256
PACK = 4096
#: Cores looked for in a large bucket; what they leave is compared one by one.
CORE_ROUNDS = 4
SEED = 13


# ---------------------------------------------------------------- learning


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; none is zero. Scaled first, so that no square leaves the range."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def learn_rotation(axes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The rotation of the columns of ``axes`` whose signs are nearest to the values."""
    turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(ITERATIONS):
        left, _, right = np.linalg.svd(axes.T @ np.where(axes @ turn >= 0, 1.0, -1.0))
        turn = left @ right
    return turn


@dataclass
class Codes:
    """How vectors of one length become substrings: ``width`` bits for each of ``tables``."""

    mean: np.ndarray
    planes: np.ndarray
    width: int
    tables: int

    def substrings(self, units: np.ndarray) -> np.ndarray:
        """A row for each vector, a column for each table."""
        bits = (units - self.mean) @ self.planes >= 0
        weights = (1 << np.arange(self.width)).astype(np.int64)
        return bits.reshape(len(units), self.tables, self.width) @ weights


def planted(units: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """For each vector another one, SIMILAR from it in cosine, towards a random direction
    or, for every other one, along the difference of two vectors of the sample."""
    aim = rng.standard_normal(units.shape)
    swap = rng.permutation(len(units))
    aim[::2] = (units[swap] - units[rng.permutation(swap)])[::2]
    aim -= units * (aim * units).sum(axis=1, keepdims=True)
    size = np.linalg.norm(aim, axis=1, keepdims=True)
    aim = np.divide(aim, size, out=np.zeros_like(aim), where=size > 1e-9)
    return SIMILAR * units + np.sqrt(1 - SIMILAR**2) * aim


def fit(sample: np.ndarray, rows: int) -> Codes:
    """Codes for a table of ``rows`` vectors, learned on unit vectors."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    width = int(np.clip(np.ceil(np.log2(max(rows, 1))), *BITS))
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    axes = axes[:AXES].T
    values = centred @ axes
    other = planted(sample, rng) - mean
    planes = np.zeros((sample.shape[1], 0))
    found = np.zeros(len(sample), bool)
    tables = 0
    while tables < MOST_TABLES and found.mean() < TARGET_RECALL:
        while planes.shape[1] < (tables + 1) * width:
            planes = np.hstack((planes, axes @ learn_rotation(values, rng)))
        own = planes[:, tables * width : (tables + 1) * width]
        found |= ((centred @ own >= 0) == (other @ own >= 0)).all(axis=1)
        tables += 1
    return Codes(mean, planes[:, : tables * width], width, tables)


# ---------------------------------------------------------------- nodes and buckets

_NODE = "vec_id long, label string, size int, digest binary, vector binary"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as the bytes of their doubles, with a digest; others without."""
    for batch in batches:
        sizes, digests, vectors = [], [], []
        for label, vector in zip(batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
            data = None
            if label is not None and vector.is_valid and not vector.values.null_count:
                value = np.asarray(vector.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
                if len(value) and np.isfinite(value).all() and value.any():
                    data = value.tobytes()
            vectors.append(data)
            sizes.append(len(data) // 8 if data else None)
            digests.append(xxhash.xxh3_128_digest(data) if data else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
            names=[x.split()[0] for x in _NODE.split(", ")],
        )


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors from the bytes of equally long vectors."""
    raw = column.to_pylist()
    return unit(np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1))


def _entries(models: dict[int, Codes]):
    """A row for each vector and table: bucket, place of the table, node, and all substrings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            for length in np.unique(size):
                rows = batch.take(pa.array(np.flatnonzero(size == length)))
                model = models[int(length)]
                keys = model.substrings(_matrix(rows.column("vector")))
                place = np.tile(np.arange(model.tables, dtype=np.int64), len(keys))
                salt = np.array([xxhash.xxh3_64_intdigest(f"{length} {x}".encode()) for x in rows.column("label").to_pylist()], np.uint64)
                bucket = mix(mix(salt.repeat(model.tables) + place.astype(np.uint64)) ^ keys.reshape(-1).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket.view(np.int64)),
                        pa.array(place.astype(np.int32)),
                        rows.column("node").take(pa.array(np.arange(len(keys)).repeat(model.tables))),
                    ],
                    names=["bucket", "place", "node"],
                )

    return run


def _code_column(models: dict[int, Codes]):
    """The nodes with their substrings as bytes, by which a pair's first table is told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[bytes | None] = [None] * batch.num_rows
            size = batch.column("size").to_numpy()
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                keys = models[int(length)].substrings(_matrix(batch.column("vector").take(pa.array(at)))).astype(np.uint32)
                for i, key in zip(at.tolist(), keys, strict=True):
                    codes[i] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], names=[*batch.schema.names, "code"])

    return run


# ---------------------------------------------------------------- cores


def _in_core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vector lies within half the threshold's angle of its leader's."""
    least = np.cos(np.arccos(SIMILAR) / 2 - 1e-7)
    for batch in batches:
        if batch.num_rows:
            own, lead = batch.column("vector").to_pylist(), batch.column("lead_vector").to_pylist()
            near = [len(a) == len(b) for a, b in zip(own, lead, strict=True)]
            for i in np.flatnonzero(near).tolist():
                a, b = (unit(np.frombuffer(x, np.float64)[None])[0] for x in (own[i], lead[i]))
                near[i] = bool(a @ b >= least)
            batch = batch.filter(pa.array(near, pa.bool_()))
        yield batch.select(["node", "lead"])


def _cores(large: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """node, core: at most one core for each node of the large buckets, named by its leader.

    A round finds one core in each large bucket; further rounds look at the rest
    of those that are still large."""
    members = scratch.store(large.select("bucket", "node").join(nodes.select("node", "vector"), "node"), "members0")
    cores = nodes.sparkSession.createDataFrame([], "node long, core long")
    for step in range(CORE_ROUNDS):
        total = members.count()
        if not total:
            break
        lead = F.min(F.struct(F.xxhash64("node"), "node")).getField("node")
        leads = members.groupBy("bucket").agg(lead.alias("lead"), F.count("*").alias("held")).filter(F.col("held") > BLOCK)
        vectors = nodes.select(F.col("node").alias("lead"), F.col("vector").alias("lead_vector"))
        leads = scratch.store(leads.join(vectors, "lead"), f"leads{step}")
        met = join_counted(members, leads, ["bucket"], "held", total)
        near = met.select("node", "lead", "vector", "lead_vector").mapInArrow(_in_core, "node long, lead long")
        # the leader of the lowest order, which is the same one for most nodes of a dense group
        best = F.min(F.struct(F.xxhash64("lead"), "lead")).getField("lead")
        new = scratch.store(near.groupBy("node").agg(best.alias("core")), f"cores{step}")
        cores = cores.unionByName(new)
        members = scratch.store(members.join(new.select("node"), "node", "left_anti"), f"members{step + 1}")
    return scratch.store(cores, "cores")


# ---------------------------------------------------------------- comparing


_FOUND = "a long, b long, links long"


@dataclass
class _Side:
    node: np.ndarray
    comp: np.ndarray
    held: np.ndarray
    units: np.ndarray
    codes: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> _Side:
        table = table.sort_by("node")
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint32).reshape(table.num_rows, -1)
        columns = (table[c].to_numpy() for c in ("node", "comp", "held"))
        return cls(*columns, _matrix(table["vector"]), codes, table["place"].to_numpy())


def _compare(a: _Side, b: _Side, same: bool, links: dict[int, int], edges: set[tuple[int, int]]) -> None:
    """Count the links between two blocks of a bucket, of which this is the pair's first table."""
    linked = a.units @ b.units.T >= SIMILAR
    linked &= a.comp[:, None] != b.comp[None, :]
    if same:
        linked &= a.node[:, None] < b.node[None, :]
    x, y = np.nonzero(linked)
    if not len(x):
        return
    first = (a.codes[x] == b.codes[y]).argmax(axis=1) == a.place[x]
    x, y = x[first], y[first]
    for rows, others, side, other in ((x, y, a, b), (y, x, b, a)):
        sums = np.bincount(rows, other.held[others].astype(np.float64), len(side.node))
        for i in np.flatnonzero(sums).tolist():
            node = int(side.node[i])
            links[node] = links.get(node, 0) + int(sums[i])
    pairs = np.unique(np.stack((a.comp[x], b.comp[y]), axis=1), axis=0)
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    for p, q in pairs.tolist():
        r, s = root(p), root(q)
        if r != s:
            parent[r] = s
            edges.add((min(p, q), max(p, q)))


def _found(links: dict[int, int], edges: set[tuple[int, int]]) -> pa.Table:
    a = [*links, *(p for p, _ in edges)]
    b = [None] * len(links) + [q for _, q in edges]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array([*links.values(), *[None] * len(edges)], pa.int64())})


def _small_buckets(table: pa.Table) -> pa.Table:
    links: dict[int, int] = {}
    edges: set[tuple[int, int]] = set()
    table = table.sort_by("bucket")
    bucket = table["bucket"].to_numpy()
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1)) if len(bucket) else []
    for at, to in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        side = _Side.of(table.slice(at, to - at))
        _compare(side, side, True, links, edges)
    return _found(links, edges)


def _blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    links: dict[int, int] = {}
    edges: set[tuple[int, int]] = set()
    if left.num_rows and right.num_rows:
        same = left["block_a"][0].as_py() == left["block_b"][0].as_py()
        _compare(_Side.of(left), _Side.of(right), same, links, edges)
    return _found(links, edges)


def _block(own: str, number: str) -> Column:
    return F.xxhash64("bucket", F.coalesce(own, F.lit(-1)), F.col(number).cast("long"))


def _meetings(large: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rows of large buckets dealt into blocks, and the pairs of blocks that meet.

    A core that fills blocks has blocks of its own, which don't meet one another."""
    held = large.groupBy("bucket", "comp").agg(F.count("*").alias("rows"))
    held = held.withColumn("own", F.when(F.col("rows") >= BLOCK, F.col("comp")))
    size = held.groupBy("bucket", "own").agg(F.sum("rows").alias("size"))
    size = size.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    size = scratch.store(size, "blocks")
    other = scratch.again(size, "blocks").select("bucket", F.col("own").alias("other"), F.col("blocks").alias("other_blocks"))
    both = size.select("bucket", "own", "blocks").join(other, "bucket")
    both = both.filter((F.coalesce("own", F.lit(-1)) < F.coalesce("other", F.lit(-1))) | F.expr("own IS NULL AND other IS NULL"))
    both = both.withColumn("number", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    start = F.when(F.col("other").isNull(), F.col("number")).otherwise(0)  # each two mixed blocks meet once
    both = both.withColumn("other_number", F.explode(F.sequence(start, F.col("other_blocks") - 1)))
    meet = both.select(_block("own", "number").alias("block_a"), _block("other", "other_number").alias("block_b"))
    # rows of large cores go to the core's blocks, the others to the mixed ones
    owned = size.filter("own IS NOT NULL").select("bucket", F.col("own").alias("comp"), F.col("blocks").alias("own_blocks"), "size")
    mixed = size.filter("own IS NULL").select("bucket", F.col("blocks").alias("mixed_blocks"), "size")
    total = large.count()
    to_own = join_counted(large, owned, ["bucket", "comp"], "size", total)
    to_own = to_own.withColumnsRenamed({"own_blocks": "blocks"}).withColumn("own", F.col("comp"))
    rest = large.join(owned.select("bucket", "comp"), ["bucket", "comp"], "left_anti")
    rest = scratch.store(rest, "rest")
    to_mixed = join_counted(rest, mixed, ["bucket"], "size", max(total, 1))
    to_mixed = to_mixed.withColumnsRenamed({"mixed_blocks": "blocks"}).withColumn("own", F.lit(None).cast("long"))
    dealt = to_own.unionByName(to_mixed).withColumn("number", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")))
    return dealt.select("bucket", "place", "node", "comp", _block("own", "number").alias("block")), meet


def _sample(nodes: DataFrame, length: int) -> np.ndarray:
    rows = nodes.filter(F.col("size") == length).orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE_ROWS)
    return unit(np.stack([np.frombuffer(r["vector"], np.float64) for r in rows.select("vector").collect()]))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding, label): vec_id, n_links (other
    rows linked directly), component_id (smallest vec_id that links reach, its own
    included), kept (vec_id = component_id).

    Defined cases: a null label, a null, empty or zero vector, or one holding null or
    non-finite components, links with nothing; vectors of different length don't link; rows that
    share an id are separate vectors, and linked if their vectors are, so all rows of a
    component's smallest id are kept; a null id is never the smallest, a component of null ids has
    a null component_id and keeps its rows; an empty table gives no rows; other columns are
    ignored. Rotations are learned for each length of vector; a table has few."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    given = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"),
        embeddings["label"].cast("string").alias("label"),
        embeddings["embedding"].alias("embedding"),
    )
    rows = scratch.store(given.mapInArrow(_digested, _NODE), "rows")
    firsts = [F.first(c).alias(c) for c in ("size", "vector")]
    classes = rows.filter("digest IS NOT NULL").groupBy("label", "digest")
    nodes = classes.agg(F.min("vec_id").alias("least"), F.count("*").alias("held"), *firsts)
    nodes = scratch.store(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    links, components = _linked(nodes, scratch)

    named = nodes.select("node", "label", "digest", "held", "least").join(links, "node", "left")
    named = named.join(components, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes"))
    named = scratch.store(named, "named")
    known = join_counted(named, smallest, ["comp"], "nodes", max(named.count(), 1))
    known = known.select("label", "digest", "held", "component_id", (F.coalesce("links", F.lit(0)) + F.col("held") - 1).alias("n_links"))
    known = scratch.store(known, "known")
    valid = scratch.store(rows.filter("digest IS NOT NULL").select("vec_id", "label", "digest"), "valid")
    found = join_counted(valid, known, ["label", "digest"], "held", valid.count()).select("vec_id", "n_links", "component_id")
    alone = rows.filter("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, links: other vectors linked directly but for equal ones), (node, comp) of the nodes that have any."""
    spark = nodes.sparkSession
    lengths = {r["size"]: r["count"] for r in nodes.groupBy("size").count().collect()}
    models = {size: fit(_sample(nodes, size), count) for size, count in lengths.items()}
    entries = nodes.select("node", "label", "size", "vector").mapInArrow(_entries(models), "bucket long, place int, node long")
    entries = scratch.store(entries, "entries")
    total = max(entries.count(), 1)
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("rows")).filter("rows > 1")
    buckets = scratch.store(buckets, "buckets")
    met = scratch.store(join_counted(entries, buckets, ["bucket"], "rows", total), "met")

    cores = _cores(met.filter(F.col("rows") > BLOCK), nodes, scratch)
    in_core = cores.join(nodes.select("node", "held"), "node")
    core_size = in_core.groupBy("core").agg(F.sum("held").alias("core_held"), F.count("*").alias("core_nodes"))
    in_core = scratch.store(in_core, "in-core")
    core_links = join_counted(in_core, core_size, ["core"], "core_nodes", max(in_core.count(), 1))
    core_links = core_links.select("node", (F.col("core_held") - F.col("held")).alias("links"))

    # buckets in which one component is alone need no comparison
    met = met.join(cores, "node", "left").withColumn("comp", F.coalesce("core", "node")).drop("core")
    met = scratch.store(met, "met-comp")
    open_ = met.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("size")).filter("x <> y")
    met = scratch.store(join_counted(met, open_.select("bucket", "size"), ["bucket"], "size", total), "open")

    whole = nodes.select("node", "size", "held", "vector").mapInArrow(
        _code_column(models), "node long, size int, held long, vector binary, code binary"
    )
    whole = whole.select("node", "held", "vector", "code")
    small = met.filter(F.col("rows") <= BLOCK).select("bucket", "place", "node", "comp").join(whole, "node")
    packs = max(tasks(spark), -(-met.count() // PACK))
    small = small.withColumn("pack", F.pmod(F.xxhash64("bucket"), F.lit(packs)))
    found = small.groupBy("pack").applyInArrow(_small_buckets, _FOUND)
    large = scratch.store(met.filter(F.col("rows") > BLOCK).select("bucket", "place", "node", "comp"), "large")
    if large.limit(1).count():
        dealt, meet = _meetings(large, scratch)
        meet = scratch.store(meet, "meet")
        dealt = scratch.store(dealt.join(whole, "node"), "dealt")
        left = meet.join(dealt.withColumnRenamed("block", "block_a"), "block_a")
        right = scratch.again(meet, "meet").join(scratch.again(dealt, "dealt").withColumnRenamed("block", "block_b"), "block_b")
        pairs = left.groupBy("block_a", "block_b").cogroup(right.groupBy("block_a", "block_b"))
        found = found.unionByName(pairs.applyInArrow(_blocks, _FOUND))
    found = scratch.store(found, "found")

    counted = found.filter("b IS NULL").select(F.col("a").alias("node"), "links").unionByName(core_links)
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    # edges join cores and single nodes; a core's members follow its label
    edges = found.filter("b IS NOT NULL").select("a", "b").distinct()
    labels = scratch.store(least_labels(edges, scratch, "components"), "labels")
    renamed = labels.select(F.col("node").alias("core"), "label")
    of_core = join_counted(in_core, core_size, ["core"], "core_nodes", max(in_core.count(), 1)).join(renamed, "core", "left")
    of_core = of_core.select("node", F.coalesce("label", "core").alias("comp"))
    single = labels.join(of_core.select("node"), "node", "left_anti").select("node", F.col("label").alias("comp"))
    return links, of_core.unionByName(single)
