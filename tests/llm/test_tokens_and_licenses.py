"""Byte-pair coding, license scans and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from oracle_check import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from rootlens.llm import bpe, jaccard, licenses, mixing
from rootlens.llm import textops as tx
from rootlens.session import scratch_dir

DOCS = "doc_id long, text string, ids string, license string, n_tokens int"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load()


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


TEXTS = [
    None, "", " ", "  a\n\n b  ", "x" * 700, "abab" * 200, "a\x00b \x00", "ß漢字かな" * 30, "it's 're 12345678 \t\n  end  ",
    " <|endoftext|> #$%", "\U0001f600 é́", "word " * 3000, "aaaaaaab" * 20,
]


def test_coding_matches_the_library(spark, vocabulary, reference):
    random.seed(4)
    texts = TEXTS + ["".join(chr(random.choice((32, 97, 98, 99, 228, 8364, 10, 49, 33))) for _ in range(90)) for _ in range(60)]
    df = spark.createDataFrame([(i % 20 if i % 9 else None, t, "x", "y", 1) for i, t in enumerate(texts * 2)], DOCS)
    coded = bpe.encode(df, vocabulary, keep=("doc_id", "text"))
    for r in bpe.decode(coded, vocabulary, keep=("doc_id", "text", "ids")).collect():
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.data) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), vocabulary).count() == 0


def test_unknown_and_null_ids(spark, vocabulary):
    rows = [(1, [65, 10**8]), (2, [None]), (3, None), (4, []), (5, vocabulary and [vocabulary.ranks[b"a"]])]
    got = {r.doc_id: r.data for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary).collect()}
    assert got[1] is None and got[2] is None and [bytes(got[i]) for i in (3, 4, 5)] == [b"", b"", b"a"]


def test_few_steps_and_forgetting(vocabulary, reference, monkeypatch):
    monkeypatch.setattr(bpe, "ENCODE", bpe.ENCODE.replace(f"= {bpe.QUERY_STEPS}", "= 3").replace(f"< {bpe.QUERY_STEPS}", "< 3"))
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "QUERY_BYTES", 20)
    coder = bpe.Coder(vocabulary)
    for texts in ([t or "" for t in TEXTS], ["unfathomableness of the thing", ""]):
        ids, off = coder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [reference.encode_ordinary(t) for t in texts]


def test_query_digests(spark, reference):
    got = {r.doc_id: r for r in entry.queries()["op2_bpe"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = reference.encode_ordinary(r.text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want


# ------------------------------------------------------------ licenses


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_alignment_is_a_common_subsequence():
    random.seed(0)
    for _ in range(400):
        text = [random.randrange(14) for _ in range(random.randrange(25))]
        template = [random.randrange(12) for _ in range(random.randrange(15))]
        pairs = licenses.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= longest_common(text, template)
    # with distinct words the alignment is the longest one
    for _ in range(100):
        text, template = random.sample(range(20), 12), random.sample(range(20), 12)
        assert len(licenses.align(text, template)) == longest_common(text, template)


def test_increasing():
    for _ in range(50):
        v = random.sample(range(30), 12)
        got = [v[i] for i in licenses.increasing(v)]
        assert got == sorted(got) and len(got) == longest_common(v, sorted(v))


def test_scan(spark):
    random.seed(1)
    mit = licenses.TEMPLATES["MIT"].split()
    noise = ["the", "of", "a", "software", "license", "and", "x"]

    def text(words):
        return " ".join([random.choice(noise) for _ in range(200)] + words + [random.choice(noise) for _ in range(77)])

    rows = [
        (1, text([w for i, w in enumerate(mit) if i % 12]), "MIT"),
        (2, text(mit).upper(), "MIT"),
        (3, "Licensed under CC-BY-NC 4.0.", "CC-BY-NC-4.0-line"),
        (4, text([]) * 3, None),
        (5, None, None),
        (6, "", None),
        (None, "x. Released under the MIT License.\nReleased under the MIT License.", "MIT-line"),
        (7, text(mit[: len(mit) // 2]), None),
        (8, "Licensed under the Apache License, Version 2.0. " + " ".join(licenses.TEMPLATES["ISC"].split()), "ISC"),
        (8, "Licensed under the Apache License, Version 2.0. " + " ".join(licenses.TEMPLATES["ISC"].split()), "ISC"),
    ]
    df = spark.createDataFrame([(i, t, "i", "l", 1) for i, t, _ in rows], DOCS)
    got = licenses.scan_licenses(df).collect()
    assert sorted((str(r.doc_id), r.license) for r in got if r.license) == sorted((str(i), w) for i, _, w in rows if w)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].coverage == 1.0 and (by_id[2].first_word, by_id[2].last_word) == (200, 200 + by_id[2].n_matched - 1)
    assert 0.85 < by_id[1].coverage < 1
    assert {x.license for x in by_id[8].licenses} == {"ISC", "Apache-2.0-line"}
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    assert licenses.scan_licenses(df, {}).filter("license is not null").count() == 0


def test_scan_finds_what_is_planted(spark):
    got = {r.doc_id: r.license for r in entry.queries()["op8_licenses"](spark, "/root/testdata/sf0.01").collect()}
    signs = {"Licensed under the Apache": "Apache-2.0-line", "Public License, version 3.": "GPL-3.0-line", "the MIT License.": "MIT-line", "CC BY-NC 4.0.": "CC-BY-NC-4.0-line"}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        held = {name for sign, name in signs.items() if sign in r.text}
        assert (got[r.doc_id] in held) if held else got[r.doc_id] is None


def scanned(scanner, words):
    return scanner.scan(*licenses.word_hashes(*tx.flat(pa.array([" ".join(words)]))))[0]


def test_added_words_count_alike_at_every_offset():
    random.seed(5)
    names = [f"t{i}" for i in range(100)]
    scanner = licenses.Scanner({"t": " ".join(names)}, 0.8)
    # 85 words with 55 others between them; marks and numbers in each line; a clause; a span of 2.3 templates
    spread = sorted(random.sample(range(140), 85))
    notices = [
        [f"t{spread.index(i)}" if i in spread else "n" for i in range(140)],
        [x for i, t in enumerate(names) for x in ([t] if i % 9 else ["dnl", str(i), t])],
        names[:50] + ["n"] * 95 + names[50:],
        names[:90] + ["n"] * 70 + names[90:95] + ["n"] * 60 + names[95:],
        ["n", "n", "t3"] + names[:2] + ["n"] * 60 + names[2:6] + ["n"] * 60 + names[6:],
    ]
    for notice in notices:
        at = [i for i, w in enumerate(notice) if w[0] == "t"]
        seen = set()
        for offset in range(220):
            (row,) = scanned(scanner, ["n"] * offset + notice + ["n"] * 250)
            seen.add((row[1], row[3] - offset, row[4] - offset))
        held = [w for w in notice if w[0] == "t"]
        if held.count("t3") == 1:
            assert seen == {(len(held), at[0], at[-1])}
        else:
            assert seen == {(100, at[1], at[-1])}


def test_windows_match_brute_force():
    random.seed(6)
    names = [f"t{i}" for i in range(12)] + ["t0", "t3"]
    scanner = licenses.Scanner({"t": " ".join(names)}, 0.7)
    template = scanner.templates[0].tolist()
    for _ in range(300):
        parts = [[w for t in names for w in ([t] * (random.random() < 0.85) + ["n"] * random.randrange(3))] for _ in range(2)]
        words = [random.choice(["n", "t0", "t3", "t5"]) for _ in range(random.randrange(40))] + parts[0] + ["n"] * random.randrange(9) + parts[1]
        at = [i for i, w in enumerate(words) if w != "n"]
        hashes, _ = licenses.word_hashes(*tx.flat(pa.array([" ".join(words)])))
        ids = [int(i) for i in scanner.vocabulary.searchsorted(hashes[at])]
        aligned = []
        for i, start in enumerate(at):
            window = [x for x, place in zip(ids[i:], at[i:], strict=True) if place < start + 2 * len(names)]
            pairs = licenses.align(window, template)
            shared = sum((collections.Counter(window) & collections.Counter(template)).values())
            assert len(pairs) <= longest_common(window, template) == licenses.common(window, scanner.places[0], len(template)) <= shared
            aligned.append(len(pairs))
        found = scanned(scanner, words)
        assert bool(found) == (max(aligned, default=0) >= 0.7 * len(names))
        assert not found or found[0][1] >= max(aligned)


def test_skipped_windows_cannot_reach_the_coverage():
    random.seed(3)
    template = " ".join(f"t{i}" for i in range(20))
    scanner = licenses.Scanner({"t": template}, 0.8)
    for _ in range(200):
        words = [f"t{i}" for i in range(20) if random.random() < 0.85]
        text = " ".join(["n"] * random.randrange(70) + words + ["n"] * random.randrange(30))
        found = scanner.scan(*licenses.word_hashes(*tx.flat(pa.array([text]))))[0]
        assert bool(found) == (len(words) >= 16)
        if found:
            assert found[0][1] == len(words)


# ------------------------------------------------------------ registered queries


@pytest.mark.parametrize("name", ["op5_url_rules", "op7_warc", "op9_jaccard"])
def test_queries_match_their_sql(spark, name):
    assert compare(spark, connect("/root/testdata/sf0.001"), name, "/root/testdata/sf0.001") is None


def test_pipeline_stages(spark, reference):
    sf = "/root/testdata/sf0.01"
    base = scratch_dir(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "mixing", "bpe"]
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        kept[name] = (docs, after)
        docs = after
    # filters keep whole rows; no clean document goes
    for name in ("language", "toxicity", "near_duplicates"):
        before, after = kept[name]
        assert after.columns == columns and after.exceptAll(before).count() == 0
    assert kept["language"][1].filter("text is null").count() == 0
    clean = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 0").select("doc_id")
    before, after = (x.join(clean, "doc_id").count() for x in kept["toxicity"])
    assert after >= 0.98 * before
    # near duplicates: one of each component is left, and it is one of the rows
    before, after = kept["near_duplicates"]
    assert after.count() == jaccard.near_duplicates(before).select("grp").distinct().count()
    again = jaccard.near_duplicates(after)
    assert again.filter("component_id <> doc_id").count() == 0
    # mixing: copies as planned
    before, after = kept["mixing"]
    plan = {(r.doc_id, r.place): r.copies for r in mixing.plan_copies(before).collect()}
    assert after.count() == sum(plan.values()) and after.columns == columns
    # tokens: as the library encodes, and back
    texts = {r.doc_id: r.text for r in after.collect()}
    for r in kept["bpe"][1].collect():
        assert r.ids == reference.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert kept["bpe"][1].count() == after.count()


def test_pipeline_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "123 ##", None, None, 3), (3, "some words here", "en", "a", 1), (3, "some words here", "en", "a", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    sf = "/root/testdata/sf0.001"
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, sf).collect()
    kept = corpus_pipeline.identify_language(spark, docs, sf).collect()
    assert [r.doc_id for r in kept] == [3, 3]


def test_registry_matches_its_sql_names():
    from rootlens.llm import registry

    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op")} == set(range(1, 11))
    assert np.all([callable(f) for f in registry.QUERIES.values()])
