"""Operator 13: dictionary-compressed WARC archives, written and read back.

An archive is a ``.warc.zst`` stream: a leading skippable frame (0x184D2A5D) that holds a Zstandard dictionary, then
one frame per WARC/1.1 record, so that any record can be decompressed alone, given the dictionary.

* ``archive_records`` numbers the pages and decides the record types. Pages with equal payloads (html as UTF-8; null counts as empty) of at
  least ``min_revisit_bytes`` bytes share one response, the page with the greatest ``page_id``; the others become revisit
  records (profile identical-payload-digest), which carry the HTTP head but not the payload and refer to the response.
* ``train_dictionary`` builds the dictionary from the ``SAMPLE_RECORDS`` archived records whose row numbers have the least
  hashes (each cut to ``SAMPLE_BYTES`` for the training only): a documented, bounded sample, one task. Training needs some
  variety; where it fails (a handful of records, or all alike), archives are written without a dictionary frame.
* ``write_archives`` writes real archive files with Spark's own text writer (bytes pass unchanged), so any Hadoop file
  system serves and its commit protocol handles lost and repeated tasks. The writer's line separator is an empty
  skippable frame, which readers pass over. The files end in ``.txt``, the writer's own ending.
* ``read_archives`` reads the files with the ``binaryFile`` source (an archive is some ``archive_bytes`` of payload)
  and parses frames and records one by one. It checks every response's payload against the digest in its head.

Skew: pages are dealt to archives by their row number. Copies of one payload, however many, are first reduced to one row
per (digest, salt), the response is chosen from those and joined back on (digest, salt); only digests and ids take part.

Results for special cases: a null ``page_id`` counts as least and stays null; a null url leaves the record without a target; line ends and
blanks in a url are percent-encoded in the record. Of repeated rows with the same ``page_id`` and payload one is the
response (or, where a greater id has the payload, none) and the others revisit it, with ``refers_to`` their own id.
Empty payloads are payloads like others. An empty table gives no archive and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duotower.llm.common import columns, written
from duotower.session import new_run_id, scratch_path

SALTS = 256
ARCHIVE_BYTES = 32 << 20        # of payload in an archive, about
SAMPLE_RECORDS = 2048
SAMPLE_BYTES = 16 << 10
DICT_BYTES = 112 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"   # pages have no capture time; fixed, so that a repeated task writes the same bytes

# Fixed values of the formats.
DICT_FRAME = b"\x5d\x2a\x4d\x18"
SKIPPABLE = tuple(bytes([0x50 + k]) + b"\x2a\x4d\x18" for k in range(16))
EMPTY_FRAME = "P*M\x18\0\0\0\0"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_SCHEMA = "page_id {id}, payload_bytes long, payload_digest string, record_type string, refers_to {id}, url string, payload binary"


def archive_records(pages: DataFrame, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """The pages to archive (row, page_id, url, html, n_bytes, sha1), and the revisits among them
    (row, n_bytes, refers_to, refers_row); both are written tables."""
    src = columns(pages, page_id=id_col, url=url_col, html=html_col)
    html = F.coalesce("html", F.lit(""))
    # row numbers are taken once and written, so that all later readers agree on them
    rows = written(src.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", html.alias("html"),
                              F.octet_length(html).cast("long").alias("n_bytes"), F.sha1(html.cast("binary")).alias("sha1")), "warc_pages")
    ids = rows.select("row", "page_id", "n_bytes", "sha1").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    ids = ids.where(F.col("n_bytes") >= min_revisit_bytes)
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "row"))
    pairs = ids.groupBy("sha1", "salt").agg(best.alias("best"))
    first = pairs.groupBy("sha1").agg(F.max("best").alias("first"))
    known = pairs.select("sha1", "salt").join(first, "sha1")
    revisits = (ids.join(known, ["sha1", "salt"]).where(F.col("first.row") != F.col("row"))
                .select("row", "n_bytes", F.col("first.page_id").alias("refers_to"), F.col("first.row").alias("refers_row")))
    return rows, written(revisits, "warc_revisits")


def _head(lines: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"


def _urn(page_id, row) -> str:
    return f"<urn:x-page:{'' if page_id is None else quote(str(page_id), safe='')}:{row}>"


def _page_of(urn: str, as_number: bool):
    page = urn[len("<urn:x-page:"):].rsplit(":", 1)[0]
    return None if page == "" else int(page) if as_number else unquote(page)


def build_record(row: int, page_id, url: str | None, payload: bytes | None, n_bytes: int, digest: str, refers: str | None) -> bytes:
    """One WARC record; ``payload`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    lines = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _urn(page_id, row)), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)))
    if refers is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers)]
    block = http + (payload or b"")
    lines += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(lines) + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC head, HTTP head, payload) of a response or revisit record. Head names are in lower case."""
    head, block = record.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = block[:int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in pairs}


def records_of(batch: pa.RecordBatch):
    """The record of every row, one at a time."""
    for r in range(batch.num_rows):
        v = {name: batch.column(name)[r].as_py() for name in ("row", "page_id", "url", "n_bytes", "sha1", "refers_to", "refers_row")}
        refers = None if v["refers_row"] is None else _urn(v["refers_to"], v["refers_row"])
        payload = batch.column("html")[r].as_py().encode() if refers is None else None
        digest = base64.b32encode(bytes.fromhex(v["sha1"])).decode()
        yield build_record(v["row"], v["page_id"], v["url"], payload, v["n_bytes"], digest, refers)


def train_dictionary(rows: DataFrame, revisits: DataFrame) -> bytes | None:
    """A Zstandard dictionary from the bounded sample of records, or None where it cannot be trained."""
    chosen = rows.select("row").orderBy(F.xxhash64("row"), "row").limit(SAMPLE_RECORDS)
    chosen = F.broadcast(chosen.join(revisits.select("row", "refers_to", "refers_row"), "row", "left"))     # SAMPLE_RECORDS narrow rows
    sample = rows.withColumn("html", F.substring("html", 1, SAMPLE_BYTES)).join(chosen, "row")

    def fn(batches):
        samples = [record[:SAMPLE_BYTES] for batch in batches for record in records_of(batch)]
        size = min(DICT_BYTES, sum(map(len, samples)) // 8)
        try:
            data = zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
        except zstandard.ZstdError:     # too few or too similar samples
            data = None
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["dictionary"])

    return sample.repartition(1).sortWithinPartitions("row").mapInArrow(fn, "dictionary binary").first()["dictionary"]


def write_archives(rows: DataFrame, revisits: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> bool:
    """Archives under ``path``, about ``archive_bytes`` of payload in each. False if there are no rows to write."""
    total = rows.agg(F.sum("n_bytes")).first()[0]
    if total is None:
        return False
    total -= revisits.agg(F.sum("n_bytes")).first()[0] or 0
    dictionary = train_dictionary(rows, revisits)

    def fn(batches):
        trained = None if dictionary is None else zstandard.ZstdCompressionDict(dictionary)
        if trained is not None:
            trained.precompute_compress(LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                begun = True
                if dictionary is not None:
                    yield _frames([DICT_FRAME + len(dictionary).to_bytes(4, "little") + dictionary])
                yield _frames([pack.compress(_info_record())])
            out, size = [], 0
            for record in records_of(batch):
                out.append(pack.compress(record))
                size += len(out[-1])
                if size > 16 << 20:
                    yield _frames(out)
                    out, size = [], 0
            if out:
                yield _frames(out)

    n = max(1, -(-int(total) // archive_bytes))
    # dealt by row before the join, so that texts are shuffled once; only revisits' ids meet them there
    dealt = rows.repartition(n, "row").join(revisits.select("row", "refers_to", "refers_row").repartition(n, "row"), "row", "left")
    out = dealt.mapInArrow(fn, "value binary").select(F.col("value").cast("string").alias("value"))
    out.write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(path)
    return True


def _info_record() -> bytes:
    info = b"software: duotower\r\nformat: WARC File Format 1.1\r\n"
    return _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x-page:info>"), ("WARC-Date", DATE),
                  ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"


def _frames(frames: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["value"])


def read_frames(data: bytes):
    """The decompressed records of an archive, one at a time."""
    view, at, unpack = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic = bytes(view[at:at + 4])
        if magic in SKIPPABLE:
            size = int.from_bytes(view[at + 4:at + 8], "little")
            if magic == DICT_FRAME and at == 0:
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8:8 + size])))
            at += 8 + size
            continue
        one, out, step = unpack.decompressobj(), io.BytesIO(), 4 << 10
        while not one.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            out.write(one.decompress(view[at:at + step]))
            at, step = at + step, min(2 * step, 1 << 20)
        at = min(at, len(view)) - len(one.unused_data)
        yield out.getvalue()


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint", payloads: bool = True) -> DataFrame:
    """Every page's record under ``path``: ids, size and digest of the full payload, type, and the payload of responses."""
    schema = READ_SCHEMA.format(id=id_type)
    number = id_type in ("bigint", "int", "smallint", "tinyint")
    types = {"page_id": pa.int64() if number else pa.string(), "refers_to": pa.int64() if number else pa.string(),
             "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [part.split()[0] for part in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, types.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names)

    def fn(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in read_frames(content.as_py()):
                    if record.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo"):
                        continue
                    head, http, payload = parse_record(record)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and (len(payload) != int(http["content-length"])
                                        or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"damaged payload in {head['warc-record-id']}")
                    rows.append((_page_of(head["warc-record-id"], number), int(http["content-length"]), digest, head["warc-type"],
                                 _page_of(head["warc-refers-to"], number) if revisit else None, head.get("warc-target-uri"),
                                 payload if payloads and not revisit else None))
                    size += len(payload)
                    if size > 16 << 20 or len(rows) == 4096:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(fn, schema)


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, path: str | None = None,
                    payloads: bool = True) -> DataFrame:
    """``pages`` written as archives (under ``path`` or the scratch folder) and read back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "llm", "warc", new_run_id())
    id_type = pages.schema["page_id"].dataType.simpleString()
    if not write_archives(*archive_records(pages, min_revisit_bytes), path, archive_bytes):
        return spark.createDataFrame([], READ_SCHEMA.format(id=id_type))
    return read_archives(spark, path, id_type, payloads)
