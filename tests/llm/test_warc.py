import gzip
import hashlib
import io
import random
import zlib

from playstream.llm.queries import QUERIES
from playstream.llm.warc import members, parse, read_archives, record, write_archives

SF001 = "/root/testdata/sf0.001"


def expected(pages, least=1000):
    best = {}
    data = [(p, ("" if h is None else h).encode()) for p, h in pages]
    for p, b in data:
        if len(b) >= least and p is not None:
            best[b] = max(p, best.get(b, p))
    out = []
    for p, b in data:
        first = best.get(b) if p is not None else None
        revisit = first is not None and first != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def told(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_query_round_trip(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    assert told(QUERIES["op5_warc_round_trip"](spark, SF001)) == expected(pages)


def test_duplicates_and_edge_cases(spark, tmp_dir):
    long, wide = "x" * 999 + "é", "é" * 499
    rows = [(1, "http://a/1", long), (5, None, long), (3, "u\r\nx", long), (5, "http://a/5", long), (2, "b", wide), (4, "b", wide),
            (6, "c", None), (7, "", ""), (None, "d", long), (8, "e", "".join(random.Random(1).choices("abc<>é", k=3_000_000))), (9, "f", "WARC/1.1\r\n\r\n" * 200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    files = write_archives(df, f"file://{tmp_dir}/a")
    want = expected([(p, h) for p, _, h in rows])
    for split in (97, 5000, 1 << 20):
        got = read_archives(files, split_bytes=split)
        assert told(got) == want
    text = {r.page_id: bytes(r.payload).decode() for r in got.collect() if r.record_type == "response" and r.page_id}
    assert text[8] == rows[9][2] and text[7] == "" and text[5] == long
    assert {r.page_id: r.url for r in got.collect()}[3] == "u%0D%0Ax"
    empty = write_archives(df.limit(0), f"file://{tmp_dir}/b")
    assert read_archives(empty).count() == 0


def test_archives_are_plain_gzip(spark, tmp_dir):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id long, url string, html string")
    files = write_archives(df, tmp_dir).collect()
    whole = b"".join(gzip.open(f.path).read() for f in files)
    assert whole.count(b"WARC/1.1\r\n") == 20 == sum(f.records for f in files)


def test_false_and_damaged_members():
    def pack(data, level=6):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        return z.compress(data) + z.flush()
    a, b = (record(i, "u", b"payload %d" % i * 50, "d") for i in (1, 2))
    other = pack(b"no warc record at all")
    inside = record(3, "u", b"\x1f\x8b\x08 and " + b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03" + other, "d")
    broken = bytearray(pack(a))
    broken[len(broken) // 2] ^= 0xFF
    parts = [pack(a), b"junk \x1f\x8b\x08 junk", bytes(broken), other, pack(inside, 0), pack(b), pack(a)[:-9]]
    blob = b"".join(parts)
    starts = [0, len(b"".join(parts[:4])), len(b"".join(parts[:5]))]
    for step in (1, 7, 64, 1000, len(blob)):
        got = [m for s in range(0, len(blob), step) for m in members(io.BytesIO(blob), s, min(s + step, len(blob)))]
        assert [x for x, _ in got] == starts and [d for _, d in got] == [a, inside, b]
    assert parse(a)[1].endswith(b"payload 1") and parse(a[:-1]) is None


def test_large_ids_beside_null_ones(spark, tmp_dir):
    pages = [(2**62 + 1, "u", "x" * 2000), (2**62 + 3, None, "x" * 2000), (None, "u", "y"), (-(2**62) - 7, "u", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    rows = read_archives(write_archives(df, f"{tmp_dir}/a")).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in rows} == {
        (2**62 + 1, "revisit", 2**62 + 3), (2**62 + 3, "response", None), (None, "response", None), (-(2**62) - 7, "response", None)}
