"""Near duplicates, neighbours and mixing against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootlens.llm import jaccard, mixing, neighbours
from rootlens.llm import textops as tx
from rootlens.llm.frames import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, digest string, n int, comp string, source string"


def rows_of(pairs):
    return [(i, t, "d", 1, "c", "s") for i, t in pairs]


# ------------------------------------------------------------ near duplicates


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(pairs):
        r = root(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, len(s), least[root(k)] if s else i) for k, ((i, _), s) in enumerate(zip(pairs, sets, strict=True))), key=str)


def found_components(spark, pairs):
    got = jaccard.near_duplicates(spark.createDataFrame(rows_of(pairs), DOCS))
    return sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed, n, words=40, changes=3):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rnd.randrange(changes + 1)):
            text[rnd.randrange(words)] = f"v{rnd.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_components_match_brute_force(spark):
    rnd = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [None, "", " \n ", "a", "A", "a b c d", "A  b\tc\nD", "a b c d e", "a b c d e", "é É x", "É é x"]
    for g in range(14):
        texts += near_copies(g, rnd.randrange(1, 9), words=rnd.choice((8, 20, 60, 200)))
    texts += [f"{passage} " + " ".join(f"q{rnd.randrange(10**5)}" for _ in range(rnd.choice((3, 9, 40)))) for _ in range(25)]
    # a chain: neighbours link, the ends do not
    chain = [f"c{i}" for i in range(60)]
    texts += [" ".join(chain[3 * i : 3 * i + 40]) for i in range(6)]
    texts += ["same " * 50, "same " * 70, " ".join(["x y"] * 40)]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    pairs = [(i if i % 13 else None, t) for i, t in zip(ids, texts, strict=True)]
    pairs += [(5, "five words are not enough here"), (5, "other text with the very same id"), pairs[12], pairs[12]]
    assert found_components(spark, pairs) == brute_components(pairs)


@pytest.mark.parametrize(("rounds", "block"), [(0, 16), (10**6, 16), (10**6, 500)])
def test_one_large_group(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(jaccard, "PAIRS_PER_POSTING", rounds)
    monkeypatch.setattr(jaccard, "LONG_LIST", 6)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    pairs = list(enumerate(near_copies(1, 150, words=60, changes=4) + near_copies(2, 30) + ["lone text of its own words here"]))
    assert found_components(spark, pairs) == brute_components(pairs)


def test_rounds_read_long_lists_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_PER_POSTING", 0)
    postings, store = [], Scratch.store

    def counted(self, df, name):
        made = store(self, df, name)
        if "shingle" in df.columns:
            postings.append(made.count())
        return made

    monkeypatch.setattr(Scratch, "store", counted)
    texts = near_copies(1, 30, words=60, changes=4)
    for seed in range(2, 32):
        texts += near_copies(seed, 3, words=80)
    pairs = list(enumerate(texts))
    assert found_components(spark, pairs) == brute_components(pairs)
    assert sum(postings) < 2.5 * postings[0]  # the table, its shared part, and little in each round


def test_common_shingles_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_TIMES", 0.001)
    pairs = list(enumerate(near_copies(4, 12) + near_copies(5, 9) + ["a b", "a b", "z"]))
    assert found_components(spark, pairs) == brute_components(pairs)


def test_many_ranges_and_slices(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "RANGE_SHINGLES", 40)
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 700)
    pairs = list(enumerate(near_copies(6, 20) + near_copies(7, 5, words=6, changes=1)))
    assert found_components(spark, pairs) == brute_components(pairs)


def test_no_documents(spark):
    assert found_components(spark, []) == []
    assert found_components(spark, [(1, None)]) == [(1, 0, 1)]


def test_prefixes_lose_no_pair():
    rnd = random.Random(9)
    for _ in range(400):
        a = {rnd.randrange(60) for _ in range(rnd.randrange(1, 40))}
        b = {x for x in a if rnd.random() < 0.93} | {rnd.randrange(60) for _ in range(rnd.randrange(4))}
        often = {x: 2 + (x * 7919) % 13 + (50 if x % 5 == 0 else 0) for x in a | b}
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        prefixes, ells = [], []
        for s in (a, b):
            alone = [x for x in s if x not in a & b]  # a frequency of one comes first
            rest = sorted((often[x], x) for x in s if x in a & b)
            ell, length = jaccard.best_length(np.array([f for f, _ in rest]), len(alone) + len(rest))
            prefixes.append({x for _, x in rest[:length]})
            ells.append(ell)
        assert ells[0] and ells[1] and len(prefixes[0] & prefixes[1]) >= min(ells)


def test_packing():
    x = np.sort(np.random.default_rng(0).integers(0, 2**48, 1000, dtype=np.uint64))
    assert (jaccard.unpack_sorted(jaccard.pack_sorted(x)) == x).all()
    assert (jaccard.unpack(jaccard.pack(x), np.uint64) == x).all() and len(jaccard.unpack(jaccard.pack(x[:0]), np.uint64)) == 0


def test_labels_of_long_paths(spark):
    edges = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"z1", b"z2")]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node): bytes(r.label) for r in jaccard.least_labels(df, Scratch(spark), "t").collect()}
    assert got == {**{bytes([i]): b"\x00" for i in range(41)}, b"z1": b"z1", b"z2": b"z1"}


def test_one_of_each_group_stays(spark):
    texts = near_copies(8, 6) + ["unique text that stands for itself"] + [None, "", ""]
    pairs = list(zip([9, 4, 7, None, 8, 6, 1, 2, 3, 3], texts, strict=True)) + [(4, texts[1]), (None, "only without an id at all"), (None, "only without an id at all")]
    kept = jaccard.keep_one(spark.createDataFrame(rows_of(pairs), DOCS))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    groups = {}
    for place, _, key in brute_components([(k, t) for k, (_, t) in enumerate(pairs)]):
        groups.setdefault(key, []).append(pairs[place][0])
    least = [min(ids, key=lambda i: (i is None, i or 0)) for ids in groups.values()]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least)


# ------------------------------------------------------------ neighbours


VECTORS = "vec_id long, embedding array<float>, part int, rank int, score string"


def search(spark, rows, every=1, k=20):
    df = spark.createDataFrame([(i, v, 1, 1, "s") for i, v in rows], VECTORS)
    return neighbours.nearest_neighbours(df, every, k)


def brute(rows, query, k=20):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    x = np.array(dict(ok)[query], np.float32).astype(float)
    scored = sorted((-(np.array(v, np.float32).astype(float) * x).sum(), i) for i, v in ok if i != query and len(v) == len(x))
    return [(i, -s) for s, i in scored[:k]]


def test_neighbours_with_odd_rows(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.standard_normal(4).round(1).tolist()) for i in range(30)]
    rows += [(30 + i, [1.0, 0.0, 2.0, 0.0]) for i in range(30)]  # ties
    rows += [(100, None), (101, []), (102, [0.0] * 4), (103, [1.0, None, 1.0, 1.0]), (104, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(105, [float("inf"), 0.0, 0.0, 1.0]), (106, [1.0, 2.0]), (None, [1.0] * 4), rows[3], rows[40]]
    got = {}
    for r in search(spark, rows, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    usable = [i for i in range(60) if i % 5 == 0 and any(rows[i][1])]
    assert sorted(got) == usable
    for q in usable:
        want = brute(rows, q)
        assert [(v, s) for _, v, s in sorted(got[q])] == want
        assert [r for r, _, _ in sorted(got[q])] == list(range(1, 21))


def test_few_or_no_candidates(spark):
    assert search(spark, []).count() == 0
    assert search(spark, [(0, [1.0, 2.0])]).count() == 0
    got = search(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, -1.0])], 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, -2.0), (2, 1, 1, 0.0), (2, 2, 0, -2.0)]


def test_recall_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest_neighbours(table, 20).collect()
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    x = np.array([v for _, v in rows], float)
    place = {i: k for k, (i, _) in enumerate(rows)}
    hits = 0
    for q in [i for i, _ in rows if i % 20 == 0]:
        score = x @ x[place[q]]
        score[place[q]] = -np.inf
        mine = [r for r in got if r.query_id == q]
        assert sorted(r["rank"] for r in mine) == list(range(1, 21))
        hits += len({rows[i][0] for i in np.argsort(-score)[:20]} & {r.vec_id for r in mine})
    assert hits >= 0.9 * len(got)


def test_graph_is_cut_into_equal_parts():
    x = np.random.default_rng(2).standard_normal((400, 3))
    near = neighbours.nearest(x, x, 6, np.arange(400))
    a, b = np.repeat(np.arange(400), 6), near.ravel()
    both = (np.concatenate((a, b)), np.concatenate((b, a)))
    part = neighbours.cut_graph(both, 400, 8)
    assert np.bincount(part).tolist() == [50] * 8
    shuffled = np.random.default_rng(3).permutation(part)
    assert (part[a] != part[b]).mean() < 0.6 * (shuffled[a] != shuffled[b]).mean()


# ------------------------------------------------------------ mixing


def targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        left = {s: weight[s] for s in sizes if s not in capped}
        rest = total - sum(capped.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()} if left else {}
        above = [s for s, v in share.items() if v > 2 * sizes[s]]
        if not above:
            return {**capped, **share}
        capped.update({s: 2.0 * sizes[s] for s in above})


def mixture(spark, n, seed=0):
    rnd = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "", "big", "none"]
    rows = []
    for i in range(n):
        s = rnd.choice(sources[:-1]) if i % 3 else "big"
        size = 0 if i % 17 == 0 else rnd.randrange(1, 60)
        rows.append((i if i % 50 else None, " ".join(["w"] * size) if i % 34 else None, s))
    rows += [(9999, "", "none"), (7, "w w w", "a"), (7, "w w w", "a"), (7, "w w w", "a"), (7, "w", "a"), (7, "w w w", "b")]
    return spark.createDataFrame([(i, t, "x", 0, "y", s) for i, t, s in rows], DOCS), rows


@pytest.mark.parametrize(("block", "fan"), [(8192, 256), (16, 3)])
def test_mix_meets_targets(spark, monkeypatch, block, fan):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    monkeypatch.setattr(mixing, "FAN_IN", fan)
    df, rows = mixture(spark, 1500)
    got = mixing.plan_copies(df).collect()
    sizes, largest = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
        largest[s] = max(largest[s], len(WORD.findall(t or "")))
    want = targets(dict(sizes))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        each = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r.size == 0 or np.floor(each) <= r.copies <= np.ceil(each)
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_reruns_agree(spark):
    df, _ = mixture(spark, 400, 3)
    plans = [sorted(map(tuple, mixing.plan_copies(x).collect()), key=str) for x in (df, df.repartition(3, "text"))]
    assert plans[0] == plans[1]


def test_mix_repeats_rows(spark):
    df, _ = mixture(spark, 300, 5)
    mixed, plan = mixing.mixed(df), mixing.plan_copies(df)
    assert mixed.columns == df.columns
    planned = plan.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).filter("n > 0")
    got = mixing.count_words(mixed, "text", ["doc_id", "source"]).groupBy("doc_id", "source", "size").count()
    assert sorted(map(tuple, planned.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)


def test_mix_of_nothing(spark):
    df, _ = mixture(spark, 1)
    assert mixing.plan_copies(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, "", 0, "", "a"), (2, "", "", 0, "", None)], DOCS)
    assert [(r.target, r.copies) for r in mixing.plan_copies(empty).collect()] == [(0.0, 0), (0.0, 0)]


def test_pivot_keeps_expectations():
    rng = np.random.default_rng(0)
    p, size = np.array([0.3, 0.5, 0.9, 0.2, 0.1, 0.5]), np.array([3, 7, 1, 10, 4, 7])
    total = np.zeros(6)
    for _ in range(4000):
        q, left = mixing.pivot(p, size, rng.random(6))
        assert q @ size == pytest.approx(p @ size)
        assert sum(0 < x < 1 for x in q) == (left >= 0)
        if left >= 0:
            q[left] = rng.random() < q[left]
        total += q
    assert np.abs(total / 4000 - p).max() < 0.03


def test_uniform_numbers():
    u = mixing._uniform(1, np.arange(-5, 10000), np.arange(10005))
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02
    assert tx.mix(np.arange(3, dtype=np.uint64)).dtype == np.uint64
