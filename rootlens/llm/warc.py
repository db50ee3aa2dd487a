"""WARC archives: writing with segments and revisits, reading with reassembly.

Writing: the HTTP body of a record is framed in chunks; a block longer than a
segment is cut into one ``response`` segment and ``continuation`` records that
carry the origin's id, their number and, on the last one, the total length.
Segments of a payload may land in different archives.

Reading: continuations are grouped by origin id, ordered by segment number and
joined to the first segment; the number of segments, the total length, the
declared lengths and the digests are verified; the chunked framing is decoded.

Bounds: a task holds one payload, and when reading one archive; archives are
rotated at a number of segments. Only records in more than one segment are
shuffled whole, each its own group. Equal payloads meet as one row per digest
and task; lookups by digest or by response are salted, as one payload may hold
a third of the rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.llm.frames import Scratch, only, small_batches

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
SEGMENTS_PER_ARCHIVE = 2048
#: Copies of each row of a lookup's small side.
SALTS = 16

# The format's line ends, names and profile.
CRLF = b"\r\n"
END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"

READ = (
    "record_id string, record_type string, target_uri string, page_id long, payload_digest string, "
    "block_digest string, refers_to string, segment int, total_length long, block binary, fault string"
)


def base32_sha1(column: Column) -> Column:
    """SHA-1 of a binary column as 32 characters of base 32."""
    digits = F.sha1(column)
    parts = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (body[i : i + size] for i in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body of a chunked framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = framed.index(CRLF, at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            break
        if framed[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk does not end where it says")
        out.append(framed[at : at + size])
        at += size + 2
    while (line := framed.index(CRLF, at)) != at:  # trailers
        at = line + 2
    return b"".join(out)


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode()
    return VERSION + CRLF + head + b"Content-Length: %d\r\n\r\n" % len(block) + block


def _one_line(text: str | None) -> str | None:
    return None if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            name = f"urn:uuid:{row['record_id']}"
            fields = [
                ("WARC-Type", row["record_type"]),
                ("WARC-Record-ID", f"<{name}>"),
                ("WARC-Date", WARC_DATE),
                ("WARC-Target-URI", _one_line(row["url"])),
                ("WARC-Page-ID", row["page_id"]),
                ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                ("Content-Type", "application/http; msgtype=response"),
            ]
            if row["record_type"] == "revisit":
                fields += [("WARC-Refers-To", f"<urn:uuid:{row['refers_id']}>"), ("WARC-Profile", REVISIT_PROFILE)]
                out = [_record(fields, HTTP_HEAD)]
            else:
                block = HTTP_HEAD + chunked(row["payload"])
                fields.append(("WARC-Block-Digest", f"sha1:{_digest(block)}"))
                cuts = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
                out = [_record(fields + ([("WARC-Segment-Number", 1)] if len(cuts) > 1 else []), cuts[0])]
                for n, cut in enumerate(cuts[1:], 2):
                    out.append(
                        _record(
                            [
                                ("WARC-Type", "continuation"),
                                ("WARC-Record-ID", f"<{name}-{n}>"),
                                ("WARC-Date", WARC_DATE),
                                ("WARC-Segment-Origin-ID", f"<{name}>"),
                                ("WARC-Segment-Number", n),
                                ("WARC-Segment-Total-Length", len(block) if n == len(cuts) else None),
                            ],
                            cut,
                        )
                    )
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def plan_records(pages: DataFrame, id_column: str, url_column: str, payload_column: str, min_bytes: int) -> DataFrame:
    """page_id, url, payload, digest, record_id, record_type, refers_id: what is written for each row."""
    rows = (
        only(pages, page_id=id_column, url=url_column, payload=payload_column)
        .withColumn("payload", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")))
        .withColumn("digest", base32_sha1(F.col("payload")))
    )
    large = F.octet_length("payload") >= min_bytes
    # only payloads that several ids share are looked up
    shared = (
        rows.filter(large)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first_id"), F.min("page_id").alias("least_id"), F.count("page_id").alias("named"), F.count("*").alias("held"))
        .filter((F.col("first_id") != F.col("least_id")) | ((F.col("named") > 0) & (F.col("named") < F.col("held"))))
        .select("digest", "first_id")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    revisit = F.coalesce(
        F.col("first_id").isNotNull() & (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")),
        F.lit(False),
    )
    return (
        salted.join(shared, ["digest", "salt"], "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .select(
            "page_id",
            "url",
            "digest",
            "record_type",
            # rows that share an id and a payload are the same record, written again
            _record_id(F.col("page_id"), F.col("digest")).alias("record_id"),
            F.when(revisit, _record_id(F.col("first_id"), F.col("digest"))).alias("refers_id"),
            F.when(~revisit, F.col("payload")).alias("payload"),
        )
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *cut)


def write_warc(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
    segments_per_archive: int = SEGMENTS_PER_ARCHIVE,
) -> None:
    """Write a record for each row into gzip archives under ``path``, a folder all executors reach.

    Of rows whose payloads are equal and at least ``min_bytes`` long, those with the
    largest id are responses, the others revisit them.

    Defined cases: a null payload is empty; a null id is smaller than any other and
    kept as no id; a null url leaves its field out; repeated rows of one id and
    payload are all responses or all revisits; an empty table gives a folder
    without records; other columns are ignored.
    """
    small_batches(pages)
    records = plan_records(pages, id_column, url_column, payload_column, min_bytes)
    (
        records.mapInArrow(_segments, "record binary")
        # the bytes pass unchanged; the separator is what ends a record
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", segments_per_archive)
        .text(path)
    )


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(CRLF)[1:]:
        name, found, value = line.partition(b":")
        if found:
            out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _bare(uri: str | None) -> str | None:
    return None if uri is None else uri.strip("<>").removeprefix("urn:uuid:")


def _after_sha1(value: str | None) -> str | None:
    return None if value is None else value.partition(":")[2]


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive's bytes; what cannot be read ends it with a fault."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == CRLF:
            at += 2
            continue
        head_end = data.find(END, at)
        fields = _fields(data[at:head_end]) if head_end > 0 and data.startswith(b"WARC/", at) else {}
        length = fields.get("content-length", "")
        if not length.isdigit():
            yield {"fault": f"no record at byte {at}"}
            return
        block = data[head_end + 4 : head_end + 4 + int(length)]
        number = fields.get("warc-segment-number")
        total = fields.get("warc-segment-total-length")
        page = fields.get("warc-page-id")
        continued = fields.get("warc-type") == "continuation"
        yield {
            "record_id": _bare(fields.get("warc-segment-origin-id" if continued else "warc-record-id")),
            "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"),
            "page_id": int(page) if page else None,
            "payload_digest": _after_sha1(fields.get("warc-payload-digest")),
            "block_digest": _after_sha1(fields.get("warc-block-digest")),
            "refers_to": _bare(fields.get("warc-refers-to")),
            "segment": int(number) if number else None,
            "total_length": int(total) if total else None,
            "block": block,
            "fault": None if len(block) == int(length) else "the archive ends inside a record",
        }
        at = head_end + 4 + int(length)


def _inflate(data: bytes) -> bytes:
    import gzip

    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in READ.split(", "))]
    )
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for record in parse_archive(_inflate(content.as_py())):
                rows.append({name: record.get(name) for name in schema.names})
                held += len(record.get("block") or b"")
                if held > 1 << 22:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


WHOLE = "page_id long, record_id string, record_type string, target_uri string, refers_id string, payload binary, payload_digest string, fault string"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in WHOLE.split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for r in batch.to_pylist():
            fault, payload = r["fault"], None
            block = b"".join(r["blocks"]) if r["blocks"] is not None else b""
            if fault is None and r["record_type"] not in ("response", "revisit"):
                fault = f"unexpected record type {r['record_type']}"
            if fault is None and r["record_type"] == "response":
                if r["numbers"] != list(range(1, len(r["numbers"]) + 1)):
                    fault = "segments are missing"
                elif len(r["numbers"]) > 1 and r["total_length"] != len(block):
                    fault = "the total length differs"
                elif r["block_digest"] is not None and r["block_digest"] != _digest(block):
                    fault = "the block's digest differs"
                else:
                    head, _, body = block.partition(END)
                    try:
                        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    except ValueError as error:
                        fault = str(error)
                    if payload is not None and r["payload_digest"] not in (None, _digest(payload)):
                        fault = "the payload's digest differs"
            row = (r["page_id"], r["record_id"], r["record_type"], r["target_uri"], r["refers_to"], payload, r["payload_digest"], fault)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        kinds = [types[x.split()[1]] for x in WHOLE.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit under ``path``, segments put together, framing decoded.

    Columns: page_id, record_id, record_type, target_uri, refers_id, payload (of responses),
    payload_digest, fault. ``fault`` says what is wrong with a record: a missing segment, a
    total length or digest that differs, broken framing, an unreadable archive; it is null
    for a sound record. Records written twice under one id and payload come back twice.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    small_batches(archives)
    found = archives.mapInArrow(_read_archives, READ)
    single = F.col("segment").isNull() & (F.coalesce("record_type", F.lit("")) != "continuation")
    alone = found.filter(single).select(
        "*", F.array(F.lit(1)).alias("numbers"), F.array("block").alias("blocks")
    ).drop("segment", "block")
    first = F.col("record_type") != "continuation"
    # equal segments are equal rows: a record that was written n times has n of each
    joined = (
        found.filter(~single)
        .groupBy("record_id", "segment", "block")
        .agg(
            F.count("*").alias("times"),
            F.max("total_length").alias("total_length"),
            F.max("fault").alias("fault"),
            *[F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "target_uri", "page_id", "payload_digest", "block_digest", "refers_to")],
        )
        .groupBy("record_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
            F.max("times").alias("times"),
            *[F.max(c).alias(c) for c in ("record_type", "target_uri", "page_id", "payload_digest", "block_digest", "refers_to", "total_length", "fault")],
        )
        .withColumn("numbers", F.col("parts.segment"))
        .withColumn("blocks", F.col("parts.block"))
        .withColumn("record_type", F.coalesce("record_type", F.lit("continuation")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        .select(alone.columns)
    )
    return alone.unionByName(joined).mapInArrow(_payloads, WHOLE)


def archive_pages(
    pages: DataFrame,
    path: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """Write the pages and read them back: read_warc's rows, with payload_bytes and refers_to.

    ``refers_to`` is the page_id of the response a revisit names; payload_bytes is
    the length of the full payload, for revisits that of their response. A revisit
    whose response cannot be found gets a fault.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    path = path or f"{scratch.path}/warc"
    write_warc(pages, path, id_column, url_column, payload_column, min_bytes)
    records = read_warc(spark, path).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # payloads stay out of the lookup
    slim = scratch.store(records.drop("payload"), "records")
    revisits = slim.filter(F.col("record_type") == "revisit")
    wanted = revisits.select(F.col("refers_id").alias("record_id")).distinct()
    targets = (
        slim.filter(F.col("record_type") == "response")
        .join(wanted, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_id"))
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full_bytes"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    resolved = (
        revisits.withColumn("salt", F.pmod(F.xxhash64("page_id", "target_uri"), F.lit(SALTS)).cast("int"))
        .join(targets, ["refers_id", "salt"], "left")
        .withColumn("payload_bytes", F.col("full_bytes"))
        .withColumn("fault", F.coalesce("fault", F.when(F.col("full_bytes").isNull(), "the response is missing")))
    )
    whole = slim.filter(F.col("record_type") != "revisit").withColumn("refers_to", F.lit(None).cast("long"))
    return whole.unionByName(resolved.select(whole.columns))
