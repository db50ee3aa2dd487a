"""URL rules and archives against plain Python."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rootlens.llm import url_rules, warc

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/es/a", "allow"),
    ("b.example.org", "/", "block"),
    ("com", "/de", "block"),
    ("com", "/de", "allow"),
    (None, "/x", "block"),
    ("com", None, "block"),
]
PAGES = "page_id long, url string, verdict string, host int"


def judged(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), h + p, max(v for a, b, v in RULES if (a, b) == (h, p)))
        for h, p, _ in RULES
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_match_brute_force(spark):
    random.seed(5)
    hosts = ["org", "example.org", "EXAMPLE.org", "b.example.org", "a.b.example.org", "xexample.org", "a.com", "com", "", "org.", ".org", "é.org"]
    paths = ["", "/", "/es", "/es/", "/es/a", "/es/ab?x=/de", "/de#f", "/DE", "/de/\x00", "?q", "#f"]
    urls = [None, "", "nothing", "://", "a://", "http:/org/"] + [f"{random.choice(['http', 'a'])}://{h}{p}" for h in hosts for p in paths]
    rows = [(i % 40 if i % 9 else None, u, "z", 1) for i, u in enumerate(urls + urls[:30])]
    rows += [(7, "http://org/same", "z", 1)] * 5 + [(i, "http://org/hot", "z", 1) for i in range(60)]
    got = url_rules.judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(RULES, url_rules.RULES))
    found = sorted(map(str, (tuple(r) for r in got.collect())))
    assert found == sorted(str((i, *judged(u))) for i, u, _, _ in rows)


def test_urls_without_rows_or_rules(spark):
    pages, rules = spark.createDataFrame([(1, "http://a.org/", "", 0)], PAGES), spark.createDataFrame(RULES, url_rules.RULES)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    row = url_rules.judge_urls(pages, rules.limit(0), default="block").first()
    assert (row.rule, row.verdict) == (None, "block")


HTML = "page_id long, url string, html string, digest string, payload int"


def written(spark, base, rows, **options):
    df = spark.createDataFrame(rows, HTML)
    back = warc.archive_pages(df, f"{base}/warc", **options)
    return sorted((tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "fault").collect()), key=str)


def expected(rows, min_bytes=0):
    out = []
    for i, _, html, _, _ in rows:
        data = (html or "").encode()
        same = [j for j, _, h, _, _ in rows if (h or "") == (html or "") and j is not None]
        first = max(same, default=None)
        revisit = len(data) >= min_bytes and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None, None))
    return sorted(out, key=str)


LONG = "".join(f"line {i} é\r\n\r\nWARC/1.1\r\n" for i in range(9000))


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_archives_round_trip(spark, base, min_bytes):
    texts = [None, "", "a", "a", "é\x00", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", LONG, LONG, LONG + "x", "0\r\n\r\n", "abcde", "abcde"]
    rows = [(i, f"http://x/{i}\r\nWARC-Type: y", t, "d", 1) for i, t in enumerate(texts)]
    rows += [(None, None, "abcde", "d", 1), (None, None, "only", "d", 1), (10, "u", "abcde", "d", 1), (3, "u", "other", "d", 1), (11, "u", "abcde", "d", 1)]
    assert written(spark, base, rows, min_bytes=min_bytes) == expected(rows, min_bytes)


def test_archives_hold_the_payloads(spark, base):
    rows = [(1, "http://a/", LONG, "", 0), (2, "http://b/", "short", "", 0)]
    warc.write_warc(spark.createDataFrame(rows, HTML), f"{base}/w", segments_per_archive=2)
    got = {r.page_id: (bytes(r.payload).decode(), r.target_uri, r.fault) for r in warc.read_warc(spark, f"{base}/w").collect()}
    assert got == {1: (LONG, "http://a/", None), 2: ("short", "http://b/", None)}


def test_archives_without_rows(spark, base):
    assert warc.archive_pages(spark.createDataFrame([], HTML), f"{base}/none").count() == 0


def records(data):
    return list(warc.parse_archive(data))


def segment(n, block, total=None, origin="<urn:uuid:o>"):
    first = n == 1
    fields = [("WARC-Type", "response" if first else "continuation"), ("WARC-Record-ID", "<urn:uuid:o>" if first else f"<urn:uuid:o-{n}>")]
    fields += [] if first else [("WARC-Segment-Origin-ID", origin)]
    fields += [("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)]
    return warc._record(fields, block) + warc.END


BLOCK = warc.HTTP_HEAD + warc.chunked(b"hello world, " * 20, 7)


@pytest.mark.parametrize(
    ("parts", "fault"),
    [
        ([(3, BLOCK[100:], len(BLOCK)), (1, BLOCK[:50], None), (2, BLOCK[50:100], None)], None),
        ([(1, BLOCK[:50], None), (3, BLOCK[100:], len(BLOCK))], "segments are missing"),
        ([(1, BLOCK[:50], None), (2, BLOCK[50:100], len(BLOCK))], "the total length differs"),
        ([(2, BLOCK[50:], len(BLOCK))], "unexpected record type continuation"),
        ([(1, BLOCK[:100], None), (2, BLOCK[101:], len(BLOCK) - 1)], None),
    ],
)
def test_reassembly(spark, base, tmp_path, parts, fault):
    (tmp_path / "w").mkdir()
    for i, p in enumerate(parts):
        (tmp_path / "w" / f"part-{i}.warc.gz").write_bytes(gzip.compress(segment(*p)))
    row = warc.read_warc(spark, str(tmp_path / "w")).first()
    if len(parts) == 2 and fault is None:
        assert row.fault is not None  # a byte is missing inside a chunk
    else:
        assert row.fault == fault
        assert fault is not None or bytes(row.payload) == b"hello world, " * 20


def test_broken_archives():
    whole = segment(1, BLOCK, len(BLOCK))
    assert records(whole)[0]["fault"] is None
    assert records(whole[:-40])[0]["fault"] == "the archive ends inside a record"
    assert records(b"junk")[0]["fault"] == "no record at byte 0"
    for framed in (b"5\r\nabc", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(framed)
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"


def test_base32(spark):
    row = spark.range(1).select(warc.base32_sha1(F.lit("abc").cast("binary")).alias("d")).first()
    assert row.d == base64.b32encode(hashlib.sha1(b"abc").digest()).decode()


def test_payloads_reach_python_in_small_batches(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    pages = spark.createDataFrame([(1, "http://a.org/", "x")], "page_id long, url string, html string")
    try:
        for step in (lambda: warc.write_warc(pages, f"{tmp_path}/out"), lambda: warc.read_warc(spark, f"{tmp_path}/out").collect()):
            spark.conf.set(key, str(1 << 28))
            step()
            assert int(spark.conf.get(key)) <= 4 << 20
    finally:
        spark.conf.unset(key)
