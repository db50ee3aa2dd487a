"""Language, toxicity and quality: exact parts against plain Python, models on held-out rows."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rootlens.llm import labelled, language, quality, toxicity
from rootlens.llm import textops as tx

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, score int, kept string"
ODD = [None, "", " \n\t", "123 $$$", "é", "a", "\x00", "a" * 5000, "x y " * 4000, "…—…"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def flat(texts):
    return tx.flat(pa.array(texts, pa.string()))


def odd_rows(spark):
    rows = [(i if i % 4 else None, t, None, None, 1, "z") for i, t in enumerate(ODD * 2)]
    return spark.createDataFrame(rows, DOCS)


# ------------------------------------------------------------ words


def test_words_and_hashes():
    texts = ["a b", None, "", "c", " d\te\nf ", "g"]
    data, off = flat(texts)
    starts, ends, woff = tx.words(data, off)
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert found == ["a", "b", "c", "d", "e", "f", "g"]
    assert np.diff(woff).tolist() == [2, 0, 0, 1, 3, 1]
    long = ["ab" * 700_000, "ab" * 700_000, "ab" * 699_999 + "ba", "ab", "ab", "ba"]
    data, off = flat(long)
    hashes = tx.hash_words(data, off[:-1], off[1:])
    assert hashes[0] == hashes[1] != hashes[2] and hashes[3] == hashes[4] != hashes[5]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "", "c" * 50, "d", "e"]})
    parts = list(tx.slices(batch, "text", 3))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(len(p) for p in parts) < 6
    assert list(tx.slices(batch.slice(0, 0), "text", 3)) == []


def test_labelled_sample(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None), (None, "d"), (4, "e"), (5, "f")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1), (4, None), (5, 0), (9, 1)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    sample = labelled.labelled_sample(docs, labels, "toxic", 9, 9, F.lit(True))
    assert {k: sorted(v) for k, v in sample.items()} == {0: ["c", "f"], 1: ["a"]}
    assert sum(map(len, labelled.labelled_sample(docs, labels, "toxic", 1, 9, F.lit(True)).values())) == 2


def test_labelled_rows_are_read_whole(spark, monkeypatch):
    plain, late = "good day to all " * 3000, "good day to all " * 3000 + "vile rotten scum " * 5
    docs = spark.createDataFrame([(i, late if i % 2 else plain) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(80)], "doc_id long, toxic int, quality int")
    seen = {}
    monkeypatch.setattr(toxicity, "fit_counted", lambda sample, share: seen.update(toxic=sample))
    monkeypatch.setattr(quality, "fit", lambda sample, shares: seen.update(quality=sample))
    toxicity.train(docs, labels)
    quality.train(docs, labels)
    assert all(t == dict(collections.Counter(late.split())) for t in seen["toxic"][1]) and seen["toxic"][1]
    assert all(t == dict(collections.Counter(plain.split())) for t in seen["toxic"][0]) and seen["toxic"][0]
    assert set(seen["quality"][1]) == {late} and set(seen["quality"][0]) == {plain}
    monkeypatch.undo()
    model = toxicity.train(docs, labels)
    got = toxicity.judge(docs, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)


# ------------------------------------------------------------ language


def test_phrases_match_brute_force():
    random.seed(2)
    samples = {"x": ["".join(random.choice("abcd ") for _ in range(120))], "y": ["".join(random.choice("abxy ") for _ in range(120))]}
    parser = language.Parser(samples)
    refs = []
    for texts in (samples["x"], samples["y"]):
        points, off = language._code_points(*flat(texts))
        refs.append(parser.lookup[language.clean(points, off)[0]].tolist())

    def phrases(symbols, ref):
        count = 0
        for a in range(0, len(symbols), language.WINDOW):
            window, i = symbols[a : a + language.WINDOW], 0
            while i < len(window):
                j = i + 1
                while j <= len(window) and any(ref[q : q + j - i] == window[i:j] for q in range(len(ref))):
                    j += 1
                count, i = count + 1, max(i + 1, j - 1)
        return count

    texts = ["", None, "a", "zz", "abc dx"] + ["".join(random.choice("abcdxyz 1.") for _ in range(random.randrange(700))) for _ in range(12)]
    points, off = language._code_points(*flat(texts))
    low, off = language.clean(points, off)
    symbols = parser.lookup[low]
    got = parser.phrases(symbols, off)
    for i in range(len(texts)):
        own = symbols[off[i] : off[i + 1]].tolist()
        assert got[i].tolist() == [phrases(own, r) for r in refs]


def test_training_reads_any_place(spark):
    rows = [(i, "1 2 <3>\n" * 200 + "the cat and the dog " * 2, "en") for i in range(40)]
    rows += [(i, "der " * 400 + "hund " * 400, "de") for i in range(40, 80)]
    rows += [(i, "😀" * 900 + "o" + "😀" * 900, "xx") for i in range(80, 90)] + [(90, "1 2", "no")]
    samples = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(samples) == {"en", "de", "xx"} and len(samples["en"]) > 20
    assert all(re.match("[a-z]", t) and len(t) <= 600 for texts in samples.values() for t in texts)
    assert any("hund" in t for t in samples["de"]) and any("der" in t for t in samples["de"])


def test_every_sampled_row_is_learned():
    texts = ["ab " * 250 for _ in range(62)] + ["c", "xyz " * 200]
    parser = language.Parser({"x": texts})
    assert all(parser.lookup[ord(c)] > language._OTHER for c in "abcxyz")
    for sizes in ([5, 900, 3], [40] * 7, [1, 1], [], [0, 4]):
        low = language.shared([np.full(n, 7, np.uint32) for n in sizes], 100)
        assert len(low) <= 100 and (len(low) > 93 or len(low) == sum(sizes) + max(0, sum(map(bool, sizes)) - 1))


def test_languages_held_out(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(documents, language.train(documents)).collect()
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_odd_rows(spark):
    odd = odd_rows(spark)
    got = language.identify(odd, {"en": ["the and of"], "de": ["der die das"]}, keep=("lang", "text")).collect()
    assert len(got) == len(ODD) * 2
    assert all((r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text)) for r in got)
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.identify(odd.limit(0), {}).count() == 0 and language.train(odd) == {}
    one = language.identify(odd, {"en": ["the"]}).filter("lang_pred = 'en'").first()
    assert one.score == 1


# ------------------------------------------------------------ toxicity


@pytest.fixture(scope="module")
def toxic(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return documents, labels, toxicity.train(documents, labels)


def test_toxicity_held_out(toxic):
    documents, labels, model = toxic
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.judge(documents, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = [r.predicted == truth[r.doc_id] for r in held]
    assert sum(right) >= 0.97 * len(right)
    caught = [r.predicted for r in held if truth[r.doc_id] == 1]
    assert sum(caught) >= 0.85 * len(caught)
    clean = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert sum(clean) <= 0.02 * len(clean)


def test_toxicity_windows_that_come_again_are_not_compressed_again(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 40)
    distance, done = toxicity.Distance(b"good fine day", b"bad ugly"), []
    of = distance.of
    monkeypatch.setattr(distance, "of", lambda w: done.append(w) or of(w))

    def word(n):
        return "".join(chr(97 + int(c)) for c in str(1000 + n))

    for i in range(30):
        text = "good bad " + " ".join(word(5 * i + k) for k in range(5))
        assert distance.histogram(text).tolist() == np.bincount([of(w) for w in toxicity.windows(text)], minlength=toxicity.LARGEST + 1).tolist()
        assert len(distance.known) + len(distance.older) <= 40
    assert done.count("good") == done.count("bad") == 1 and len(done) == 152
    assert distance.histogram_of({"good": 2, "new": 1}).sum() == 3


def test_toxicity_odd_rows(spark, toxic):
    odd = odd_rows(spark)
    got = toxicity.judge(odd, toxic[2], keep=("text", "lang")).collect()
    assert len(got) == len(ODD) * 2 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judge(odd.limit(0), toxic[2]).count() == 0
    for sample, score in (({0: ["a b"], 1: []}, 0), ({0: [], 1: ["a"]}, 1), ({0: [], 1: []}, 0)):
        assert round(float(toxicity.fit(sample, 0.5).scores(np.zeros((1, toxicity.LARGEST + 1)))[0])) == score
    tiny = toxicity.fit({0: ["good day", "fine day"], 1: ["bad day", "bad bad"]}, 0.5)
    assert toxicity.judge(odd, tiny).count() == len(ODD) * 2


# ------------------------------------------------------------ quality


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(covered)


def test_quality_counts(spark):
    random.seed(1)
    texts = ODD + ["x\nx\n x\nx\n\n\nx", "é è\nü é è é è é", "# * $ %\n&|<>", "a\r\na\r\na"]
    texts += [" ".join(random.choice(["ab", "c", "\n", "d\n"]) for _ in range(random.randrange(80))) for _ in range(200)]
    rows = [(i, t, None, None, 1, "z") for i, t in enumerate(texts)]
    model = quality.fit({0: [], 1: []})
    got = quality.assess(spark.createDataFrame(rows, DOCS), model).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in quality.COUNTS) for r in got] == [counted(t) for t in texts]
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # nothing was learned


def test_quality_model_held_out(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    seen = labels.filter("doc_id % 4 <> 0")
    model = quality.train(documents, seen, 700)
    got = [r for r in quality.assess(documents, model).collect() if r.doc_id in truth and r.doc_id % 4 == 0]
    right = [(r.probability >= 0.5) == (truth[r.doc_id] == 1) for r in got]
    assert sum(right) >= 0.93 * len(right)
    kept = [r.probability >= 0.5 for r in got if truth[r.doc_id] == 1]
    assert sum(kept) >= 0.97 * len(kept)
    # calibrated: the mean probability is near the share of good rows
    assert abs(np.mean([r.probability for r in got]) - np.mean([truth[r.doc_id] for r in got])) < 0.06
    assert all(not (r.base_failed and r.kept) for r in got)


def test_quality_odd_rows(spark):
    odd = odd_rows(spark)
    model = quality.fit({0: ["bad ## ##"] * 9, 1: ["good text here"] * 9})
    got = quality.assess(odd, model).collect()
    assert len(got) == len(ODD) * 2 and all(0 <= r.probability <= 1 for r in got)
    assert quality.assess(odd.limit(0), model).count() == 0
