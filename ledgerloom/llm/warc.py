"""WARC archives of pages: written with an index, read back by the index.

Writing: a page's payload is its html in UTF-8. Digests come first, from one narrow scan: of payloads of LEAST bytes and
more that several pages share, the one with the smallest page_id is the response, the others revisit it. Tasks then write
archives of gzip members, one a record, into a folder that all executors share, and return one index row per record:
archive, offset, length, URL, digest. The index is a table that Spark commits, so what a lost or repeated task left behind
is named by no row. A revisit carries its headers only, as the format has it: the digest, the record it refers to, and
the HTTP header with the length of the payload that isn't repeated.

Reading: any rows of the index, dealt out by spans of an archive, sorted by offset, neighbours coalesced into one byte-range
read. All that is returned comes from the bytes that were read; a record that isn't what the index says fails.

Null html is an empty payload. A null URL gives a record without target, characters that can't stand in a header are
percent-encoded there. Rows that repeat the smallest page_id of a payload are responses, too; a null page_id is the response
only where all are null, and refers to nothing. An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, columns, prepare, remove, shuffle_partitions, small, table

#: Shorter payloads are always written whole; the profile of revisits; ends of lines.
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
#: Bytes after which a task begins another archive, of a span that one task reads, and of one read; gaps that a read bridges.
ARCHIVE, SPAN, READ, GAP = 1 << 30, 32 << 20, 8 << 20, 64 << 10
#: Rows of shared digests (about 120 bytes each) that are broadcast at most; more are joined by shuffle in salted parts.
BROADCAST_DIGESTS, ROWS_A_PART = 100_000, 100_000

INDEX = "page_id long, url string, archive string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
INDEX_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
ID = re.compile(r"<urn:page:(-?\d+|none):[0-9a-f]{64}>")


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_digest and first: the page_id that holds the payload for all that share it (null: nobody else has it)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("payload_digest"))
    shared = (
        p.where(F.octet_length("html") >= LEAST).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
    )
    shared = shared.checkpoint()
    most, n = shared.agg(F.max("n"), F.count("*")).first()
    if n <= BROADCAST_DIGESTS:
        return p.join(F.broadcast(shared.drop("n")), "payload_digest", "left")
    parts = max(1, min(1024, -(-most // ROWS_A_PART)))
    salted = shared.drop("n").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return p.withColumn("part", F.pmod(F.xxhash64("page_id"), F.lit(parts)).cast("int")).join(salted, ["payload_digest", "part"], "left").drop("part")


def _id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}>"


def _header(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as the format has it: WARC header, block (an HTTP response, or only its header), two ends of line."""
    http = f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: {len(payload)}{EOL}{EOL}".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id, digest)}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {_header(url)}"] if url is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}"]
    lines += [f"WARC-Refers-To: {_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}"] if revisit else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return (EOL.join(lines) + EOL + EOL).encode() + block + (EOL + EOL).encode()


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int, bytes]:
    """Of one record: WARC fields by their names in lower case, the record's block, the length of its payload as HTTP has it, the payload."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split(EOL)
    if not first.startswith("WARC/1."):
        raise ValueError("no record begins here")
    fields = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where its header says")
    http, payload = block.split(b"\r\n\r\n", 1)
    length = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, block, length, payload


def write(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 4, archive: int = ARCHIVE) -> DataFrame:
    """Write the archives and their index (folder/index, Parquet) and return the index."""
    spark = prepare(pages.sparkSession)

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/archives", recursive=True)
        name, out, at = "", None, 0

        def rows() -> Iterator[tuple]:
            nonlocal name, out, at
            for batch in small(it, "html", 4_000_000):
                for page_id, url, html, digest, first in zip(*columns(batch, "page_id", "url", "html", "payload_digest", "first"), strict=True):
                    if out is None or at >= archive:
                        if out is not None:
                            out.close()
                        name, at = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    payload = html.encode()
                    refers_to = first if first is not None and first != page_id else None
                    member = zlib.compress(record(page_id, url, payload, digest, refers_to, date), level, wbits=31)
                    out.write(member)
                    yield page_id, url, name, at, len(member), len(payload), digest, "revisit" if refers_to is not None else "response", refers_to
                    at += len(member)
            if out is not None:
                out.close()

        yield from batches(rows(), INDEX_SCHEMA)

    roles(pages).select("page_id", "url", "html", "payload_digest", "first").mapInArrow(each, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def ranges(rows: list[tuple[str, int, int]], most: int = READ) -> Iterator[tuple[int, int]]:
    """First and last row (left out) of each run of rows (archive, offset, length), sorted, that one read takes."""
    first = 0
    for i in range(1, len(rows) + 1):
        if i < len(rows):
            archive, offset, length = rows[i]
            before = rows[i - 1]
            if archive == before[0] and offset - before[1] - before[2] <= GAP and offset + length - rows[first][1] <= most:
                continue
        if first < i:
            yield first, i
        first = i


def read(index: DataFrame, folder: str, payload: bool = True, span: int = SPAN, most: int = READ) -> DataFrame:
    """The records that rows of the index name, with their payloads (null for revisits; see payloads()) or without."""
    spark = prepare(index.sparkSession)
    rows = index.select("page_id", "archive", "offset", "length", "payload_digest", F.floor(F.col("offset") / span).alias("span"))
    dealt = rows.repartition(shuffle_partitions(spark), "archive", "span").sortWithinPartitions("archive", "offset")

    def each(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(folder)
        name, source = None, None

        def records() -> Iterator[tuple]:
            nonlocal name, source
            for batch in it:
                page_ids, archives, offsets, lengths, digests = columns(batch, "page_id", "archive", "offset", "length", "payload_digest")
                for a, b in ranges(list(zip(archives, offsets, lengths, strict=True)), most):
                    if archives[a] != name:
                        if source is not None:
                            source.close()
                        name, source = archives[a], fs.open_input_file(f"{root}/{archives[a]}")
                    start = offsets[a]
                    held = source.read_at(max(o + n for o, n in zip(offsets[a:b], lengths[a:b], strict=True)) - start, start)
                    for i in range(a, b):
                        fields, _, length, body = parse(zlib.decompress(held[offsets[i] - start : offsets[i] - start + lengths[i]], wbits=31))
                        yield _checked(page_ids[i], digests[i], fields, length, body, payload)
            if source is not None:
                source.close()

        held, size = [], 0
        for r in records():
            held.append(r)
            size += len(r[-1] or b"") + 200
            if size > most:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    return dealt.mapInArrow(each, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), RECORD_SCHEMA, strict=True)], schema=RECORD_SCHEMA)


def _checked(page_id: int | None, digest: str, fields: dict[str, str], length: int, body: bytes, payload: bool) -> tuple:
    """The row of RECORD that the bytes give; they must be of the page and the payload that the index names."""
    kind, own = fields["warc-type"], ID.fullmatch(fields["warc-record-id"])[1]
    said = fields["warc-payload-digest"].removeprefix("sha256:")
    refers = ID.fullmatch(fields["warc-refers-to"])[1] if kind == "revisit" else None
    if own != ("none" if page_id is None else str(page_id)) or said != digest or (kind == "response" and (len(body) != length or hashlib.sha256(body).hexdigest() != said)):
        raise ValueError(f"the record of page {page_id} isn't what the index says")
    url = unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None
    return page_id, url, length, said, kind, int(refers) if refers is not None else None, body if payload and kind == "response" else None


def payloads(index: DataFrame, selected: DataFrame, folder: str) -> DataFrame:
    """page_id, url and payload of the selected rows of the index, with a revisit's payload read from the record that it
    refers to. Of responses that repeat a page_id and a payload any one serves. Each response is read once."""
    key = F.coalesce("refers_to", "page_id").alias("holder")
    wanted = selected.select("page_id", "url", "payload_digest", key)
    holders = wanted.select("payload_digest", F.col("holder").alias("page_id")).distinct()
    same = (index["payload_digest"] == holders["payload_digest"]) & index["page_id"].eqNullSafe(holders["page_id"])
    found = index.where("record_type = 'response'").join(holders, same, "left_semi").dropDuplicates(["page_id", "payload_digest"])
    got = read(found, folder).select("payload_digest", F.col("page_id").alias("of"), "payload")
    w = wanted.withColumnRenamed("payload_digest", "digest")
    return w.join(got, (w["digest"] == got["payload_digest"]) & w["holder"].eqNullSafe(got["of"])).select("page_id", "url", "payload")


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own beside the checkpoints, which all executors share."""
    return f"{prepare(spark).sparkContext.getCheckpointDir()}/{what}-{uuid.uuid4().hex}"


def query(spark, sf_dir: str) -> DataFrame:
    """Archives are written, all records are read back from them, and the archives go once the rows are stored."""
    folder = new_folder(spark, "warc")
    index = write(table(spark, sf_dir, "pages"), folder)
    found = read(index, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found.write.parquet(f"{folder}/found")
    remove(spark, f"{folder}/archives")
    remove(spark, f"{folder}/index")
    return spark.read.schema("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long").parquet(f"{folder}/found")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM f"""
