"""Collocations, the filter audit and near-duplicate embeddings against plain Python."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rootlens.llm import audit, collocations, embedding_dedup
from rootlens.llm import textops as tx
from rootlens.llm.frames import Scratch, join_counted

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ collocations


def pieces_of(text):
    pieces = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [re.findall(r"[^\x20\x09]+", p) for p in pieces]


def brute_counts(docs):
    counts = defaultdict(Counter)
    for text, lang in docs:
        for words in pieces_of(text):
            for n in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts


def brute_report(docs, least=30, reported=2000):
    out = []
    for lang, f in brute_counts(docs).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in wanted.items():
            inside = (
                100 * b >= 80 * a
                for q, b in wanted.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            )
            if any(inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        for rank, (_, _, phrase, a, l, r, score) in enumerate(sorted(rows)[:reported], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, n, score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
TEXTS = "text string, lang string, doc_id long, phrase string, n int, chunk string"


def found_report(spark, docs):
    rows = spark.createDataFrame([(t, l, i, "p", 0, "c") for i, (t, l) in enumerate(docs)], TEXTS)
    return sorted(tuple(r) for r in collocations.collocations(rows).select(*COLUMNS).collect())


def random_text(rng, words):
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "日本", "x" * 40, "and"]
    out = []
    for _ in range(words):
        out.append(rng.choice(vocabulary))
        out.append(rng.choices([" ", "\t", "  ", ". ", ",", "\n", "\x0b", "!? ", " "], [60, 4, 4, 4, 2, 2, 1, 1, 2])[0])
    return "".join(out)


def test_collocations_equal_brute_force(spark):
    rng = random.Random(5)
    docs = [(random_text(rng, rng.choice([0, 1, 2, 3, 40, 300])), rng.choice(["en", "fr", None])) for _ in range(60)]
    passage = random_text(rng, 120)
    docs += [(passage, "en")] * 40 + [(None, "en"), ("", "fr"), (".,;", "de"), ("a b", "und")]
    docs += [("go go go " * 700, "en"), ("one two three four five. " * 40, "fr")]
    found = found_report(spark, docs)
    assert found == brute_report(docs) and len(found) > 60
    assert {r[0] for r in found} >= {"en", "fr", "und"}


def test_collocations_of_nothing(spark):
    assert found_report(spark, []) == []
    assert found_report(spark, [(None, None), ("", "en"), ("rare words here", "en")]) == []


def test_chunks_cover_every_phrase_once():
    rng = random.Random(8)
    texts = [random_text(rng, n) for n in (0, 1, 3, 4, 5, 50, 2000)] + ["same " * 3000, "", "  ..", "a.b.c"]
    data, off = tx.flat(pa.array(texts))
    buffer, starts, ends, leads, docs = collocations.parse(data, off)
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(["x"] * len(starts)),
            pa.array(leads),
            pa.array([buffer[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
            pa.array(np.ones(len(starts), np.int64)),
        ],
        names=["lang", "lead", "chunk", "times"],
    )
    here = collocations._Phrases(batch)
    raw = here.data.tobytes()
    found = Counter()
    for n in range(1, 5):
        at, _ = here.counted(n, None)
        found.update(tuple(raw[here.starts[i] : here.ends[i + n - 1]].decode().split(" ")) for i in at)
    assert found == brute_counts([(t, "x") for t in texts])["x"]
    assert (ends - starts).max() < 60 * collocations.LONGEST_CHUNK


def test_texts_are_summed_as_bytes(monkeypatch):
    words = "été of the to and 漢字 end".split()
    rnd = random.Random(5)
    want, rows = Counter(), []
    for lang in ("de", "und"):
        for _ in range(60):
            text = [rnd.choice(words) for _ in range(rnd.randrange(1, 9))]
            times = rnd.randrange(1, 5)
            rows.append((lang, True, " ".join(text).encode() + b".", times))
            for n in range(1, collocations.LONGEST + 1):
                for i in range(len(text) - n + 1):
                    want[lang, n, " ".join(text[i : i + n])] += times
    rows.append(("und", True, b"bad\xff byte.", 2))
    want.update({("und", 1, "bad\ufffd"): 2, ("und", 1, "byte"): 2, ("und", 2, "bad\ufffd byte"): 2})
    kinds = (pa.string(), pa.bool_(), pa.binary(), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["lang", "lead", "chunk", "times"])

    class Marks:
        value = np.full(1 << (collocations.MARK_BITS - 3), 255, np.uint8).tobytes()

    # cut and summed as arrays, not phrase by phrase
    arrays, cut = [], collocations._cut
    monkeypatch.setattr(collocations, "_cut", lambda *a: arrays.append(cut(*a)) or arrays[-1])
    found = [r for part in collocations._texts(Marks)(iter([batch])) for r in part.to_pylist()]
    assert {(r["lang"], r["size"], r["phrase"]): r["times"] for r in found} == want and len(found) == len(want)
    assert len(arrays) == collocations.LONGEST


def test_equal_passages_give_equal_chunks(spark):
    rng = random.Random(2)
    passage = " ".join(str(rng.randint(0, 500)) for _ in range(3000))
    docs = [(f"{' '.join(str(rng.randint(0, 500)) for _ in range(50))} {passage}", "en") for _ in range(8)]
    rows = spark.createDataFrame(docs, "text string, lang string")
    chunks = collocations.dictionary(rows).collect()
    assert max(r["times"] for r in chunks) == 8
    assert sum(len(r["chunk"]) for r in chunks) < 2.2 * len(passage)


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000
    counts = [("en", 1, "x", 2 * a + 1), ("en", 1, "y", 2 * a), ("en", 2, "x y", a)]
    rows = spark.createDataFrame(counts, "lang string, size int, phrase string, f long")
    totals = spark.createDataFrame([("en", 5 * a)], "lang string, n long")
    found = collocations.scored(rows, totals).collect()
    assert [(r["phrase"], r["score"]) for r in found] == [("x y", 2_000_000 * a // (4 * a + 1))]


# ------------------------------------------------------------ the filter audit

DOCS = "doc_id long, text string, source string, mask int, part string, n int"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute_mask(i, docs):
    doc_id, text, _ = docs[i]
    text = text or ""
    words = WORD.findall(text)
    earlier = any((t or "") == text and d is not None and doc_id is not None and d < doc_id for d, t, _ in docs)
    return (
        (len(words) < 50)
        + 2 * (100 * len(set(words)) < 65 * len(words))
        + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text))
        + 8 * any(c in "#$%&*|" for c in text)
        + 16 * earlier
    )


def brute_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [(s or "", brute_mask(i, docs), d in good, d in toxic) for i, (d, _, s) in enumerate(docs)]
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1] >> f & 1]
                failing = [r for r in own if r[1] >> f & 1]
                left = [r for r in left if not r[1] >> f & 1]
                shapley[f] += len(gone)
                name = "".join("ABCDE"[i] for i in order)
                alone = sum(r[1] == 1 << f for r in own)
                out[part, name, step] = [len(left), len(gone), len(failing) - len(gone), alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, name, step), row in out.items():
            if p == part:
                row.append(shapley["ABCDE".index(name[step - 1])])
    return {k: tuple(v) for k, v in out.items()}


def found_audit(spark, docs, labels):
    rows = spark.createDataFrame([(*d, 0, "p", 1) for d in docs], DOCS)
    marks = spark.createDataFrame([(*x, "p") for x in labels], LABELS)
    return {(r[0], r[1], r[2]): tuple(r)[3:] for r in audit.audit(rows, marks).collect()}


def test_audit_equals_brute_force(spark):
    rng = random.Random(4)
    docs = []
    for i in range(150):
        words = [rng.choice(["a", "B", "c#", "word", "Word", "é", "$"]) + str(rng.randint(0, rng.choice([2, 90]))) for _ in range(rng.choice([3, 49, 50, 80]))]
        docs.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words), rng.choice(["x", "y", None, ""])))
    docs += [(1000 + i, docs[0][1], rng.choice(["x", "y"])) for i in range(40)]
    docs += [(None, docs[0][1], "x"), (7, docs[7][1], "y"), (7, docs[7][1], "y"), (2000, None, "x"), (2001, "", "y"), (2002, "  \n", "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (2001, 1, 1)]
    found, wanted = found_audit(spark, docs, labels), brute_audit(docs, labels)
    assert found == wanted and len(found) == 600 * 4


def test_audit_of_an_empty_table(spark):
    assert found_audit(spark, [], []) == {}


def test_the_walk_equals_sums_over_kept_cells():
    rng = np.random.default_rng(1)
    masks = rng.integers(0, 32, 25)
    counts = rng.integers(0, 10, (25, 3))
    states = audit.walk(masks, counts)
    for subset in range(32):
        assert states[subset].tolist() == counts[masks & subset == 0].sum(axis=0).tolist()


# ------------------------------------------------------------ near-duplicate embeddings

VECTORS = "vec_id long, embedding array<float>, label int, node long, digest string, links long"


def brute_dedup(rows):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.float32(v).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.98:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[root(i)] = root(j)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), vec) if x is not None), default=None)
    return sorted(((r[0], links[i], least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows)), key=str)


def found_dedup(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], l, 0, "d", 0) for i, v, l in rows]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(data, VECTORS))
    return sorted((tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def near(rng, v, cosine):
    aim = rng.standard_normal(len(v))
    v = v / np.linalg.norm(v)
    aim -= v * (aim @ v)
    return cosine * v + np.sqrt(1 - cosine**2) * aim / np.linalg.norm(aim)


def test_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(32).tolist(), int(i % 3)) for i in range(300)]
    for k in range(40):  # pairs and chains on both sides of the bar
        rows.append((1000 + k, (3 * near(rng, np.array(rows[k][1]), [0.9999, 0.99, 0.985, 0.975][k % 4])).tolist(), rows[k][2]))
    rows += [(2000 + k, rows[0][1], 0) for k in range(30)]  # equal vectors
    rows += [(2100 + k, rows[0][1], 1) for k in range(3)]  # of another label
    rows += [(5, rows[5][1], 2), (None, rows[6][1], 0), (None, [9.0] * 32, 0)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 32, 0), (3003, [float("nan")] * 32, 0), (3004, [None] * 32, 0), (3005, rows[0][1], None)]
    rows += [(3100, [1.0, 2.0], 0), (3101, [2.0, 4.0], 0), (3102, [2.0, 1.0], 0), (3103, [1.0, 2.0], 0)]
    assert found_dedup(spark, rows) == brute_dedup(rows)


@pytest.mark.parametrize("spread", [0.999, 0.985])
def test_large_groups_of_near_copies(spark, monkeypatch, spread):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "PACK", 64)
    rng = np.random.default_rng(9)
    heart = rng.standard_normal(24)
    rows = [(i, near(rng, heart, spread).tolist(), 0) for i in range(150)]
    rows += [(500 + i, rng.standard_normal(24).tolist(), 0) for i in range(60)]
    rows += [(700 + i, near(rng, -heart, 0.9999).tolist(), 0) for i in range(40)]
    found, wanted = found_dedup(spark, rows), brute_dedup(rows)
    assert [r[0::2] for r in found] == [r[0::2] for r in wanted]
    # groups at the bar itself may lose a few of their pairs, none is made up
    true, got = sum(r[1] for r in wanted), sum(r[1] for r in found)
    assert 0.995 * true <= got <= true and all(a[1] <= b[1] for a, b in zip(found, wanted, strict=True))


def test_dedup_of_an_empty_table(spark):
    assert found_dedup(spark, []) == []


def test_learned_codes_are_balanced_and_find_planted_pairs():
    rng = np.random.default_rng(2)
    units = embedding_dedup.unit(rng.standard_normal((2000, 40)) * np.linspace(3, 0.2, 40))
    codes = embedding_dedup.fit(units, 2000)
    other = np.stack([near(rng, v, 0.98) for v in units])
    assert (codes.substrings(units) == codes.substrings(other)).any(axis=1).mean() > 0.98
    bits = (units - codes.mean) @ codes.planes >= 0
    assert abs(bits.mean(axis=0) - 0.5).max() < 0.12


def test_hot_keys_are_joined_like_others(spark):
    rows = spark.range(3000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), "id")
    scratch = Scratch(spark)
    rows = scratch.store(rows, "rows")
    lookup = rows.groupBy("k").agg(F.count("*").alias("held"), F.min("id").alias("least"))
    found = join_counted(rows, lookup, ["k"], "held", 100_000)  # hot above 100 rows
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.join(lookup, "k").collect()))
