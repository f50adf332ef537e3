"""WARC archives: a deduplicating writer and a splittable reader.

A record is a gzip member of its own. Tasks write one archive each and report
it in a manifest; files of lost attempts are in no manifest and never read.
The reader deals out byte ranges: a task looks for the gzip magic in its
range, takes a candidate as a member only if it inflates to a whole WARC
record, and owns the records that start inside the range, reading past its
end to finish the last one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, ids_of, materialize

MAGIC = b"\x1f\x8b\x08"
STEP = 1 << 16
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow reaches; Hadoop writes local ones as file:/."""
    return pafs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", uri))


def _page(page_id) -> bytes:
    return b"<urn:page:%s>" % (b"null" if page_id is None else b"%d" % page_id)


def record(page_id, url, payload: bytes, digest: str, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record; with ``refers_to`` a revisit, whose block is the HTTP
    header alone. Line ends in a url are escaped."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Record-ID: " + _page(page_id), b"WARC-Date: " + date.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode("utf-8", "surrogatepass"))
    head.append(b"WARC-Payload-Digest: sha1:" + digest.encode())
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + _page(refers_to)]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[bytes, bytes], bytes] | None:
    """Header fields (lower-case names) and block; None if it isn't a whole record."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or len(data) != end + 8 + int(length) or not data.endswith(b"\r\n\r\n"):
        return None
    return fields, data[end + 4:-4]


def members(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of the WARC members of the open file ``f`` that
    start in ``[start, end)``. Damaged or cut members are passed over."""
    f.seek(start)
    buf = bytearray(f.read(end + len(MAGIC) - 1 - start))
    at = buf.find(MAGIC)
    while 0 <= at and start + at < end:
        inflate, out, pos, ok = zlib.decompressobj(31), [], at, True
        while not inflate.eof:
            if pos == len(buf):
                f.seek(start + pos)
                buf += f.read(STEP)
            chunk = bytes(buf[pos:pos + STEP])
            try:
                out.append(inflate.decompress(chunk))
            except zlib.error:
                ok = False
            if not ok or not chunk or (len(out) == 1 and not out[0].startswith(b"WARC/1."[:len(out[0])])):
                ok = False
                break
            pos += len(chunk)
        data = b"".join(out)
        if ok and parse(data):
            yield start + at, data
            at = buf.find(MAGIC, pos - len(inflate.unused_data))
        else:
            at = buf.find(MAGIC, at + 1)


def _writer(folder: str, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, out, n = TaskContext.get(), None, 0
        for pdf in batches:
            for page, url, html, digest, refers in zip(ids_of(pdf["page_id"]), pdf["url"], pdf["payload"], pdf["digest"], ids_of(pdf["refers_to"])):
                if out is None:
                    store, at = _open(f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz")
                    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(at, compression=None)
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(z.compress(record(page, url if isinstance(url, str) else None, bytes(html), digest, refers)) + z.flush())
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{at.rsplit('/', 1)[1]}"], "bytes": [size], "records": [n]})
    return run


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, level: int = 6) -> DataFrame:
    """Write ``pages(page_id, url, html, ...)`` as WARC archives under
    ``folder``, which all executors share; returns the manifest ``(path,
    bytes, records)``.

    Of pages with equal payloads (the html in UTF-8) of at least
    ``least_bytes``, that with the largest page_id is written as response,
    others as revisits of it. Defined cases: a null html is an empty payload,
    a null url leaves out the field; repeated rows give a record each, and
    those with the largest page_id are all responses; a page without an id is
    always a response and never referred to; further columns are ignored; an
    empty table gives no archive."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b"").cast("binary"))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    read = read.withColumn("digest", F.sha1("payload"))
    same = materialize(
        read.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first"), "warc-same")
    told = read.join(same, "digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") < F.col("first"), F.col("first")))
    manifest = told.select(id_text("page_id"), "url", "payload", "digest", id_text("refers_to")).mapInPandas(
        _writer(folder, level), "path string, bytes long, records long")
    return materialize(manifest, "warc-manifest")


def _reader(with_payload: bool):
    def row(data: bytes) -> tuple:
        fields, block = parse(data)
        page, refers = (_PAGE.fullmatch(fields.get(k, b"")) for k in (b"warc-record-id", b"warc-refers-to"))
        kind = fields.get(b"warc-type", b"").decode("latin-1")
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length: *(\d+)", http)
        if kind == "response":
            digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
        else:
            digest, size = fields.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:"), int(told[1]) if told else None
        url = fields.get(b"warc-target-uri")
        return (int(page[1]) if page else None, None if url is None else url.decode("utf-8", "replace"), kind, size, digest,
                int(refers[1]) if refers else None, *([payload] if with_payload else []))

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = dict(zip(names, zip(*rows))) if rows else {c: [] for c in names}
        return pd.DataFrame(out | {c: pd.array(out[c], dtype="Int64") for c in ("page_id", "payload_bytes", "refers_to")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start, end in zip(pdf["path"], pdf["start"], pdf["end"]):
                store, at = _open(path)
                rows, held = [], 0
                with store.open_input_file(at) as f:
                    for _, data in members(f, int(start), int(end)):
                        rows.append(row(data))
                        held += len(data)
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)
    return run


def read_archives(files: DataFrame, split_bytes: int = 8 << 20, with_payload: bool = True) -> DataFrame:
    """Records of the archives ``files(path, bytes)``: ``page_id``, ``url``,
    ``record_type``, ``payload_bytes``, ``payload_digest`` (hex SHA-1, computed
    for responses, as told for revisits), ``refers_to`` and, if
    ``with_payload``, ``payload``. Members that are damaged or no WARC records
    are passed over; no file, no record."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    n = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    return ranges.repartition(min(int(n), 10_000)).mapInPandas(_reader(with_payload), schema + (", payload binary" if with_payload else ""))
