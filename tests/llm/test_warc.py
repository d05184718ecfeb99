"""WARC: round trip against hashlib, revisits, and the assembly of odd identifier chains."""

import gzip
import hashlib

from pyspark.sql import functions as F

from plume.llm import registry, warc

BIG = "x" * 150
PAGES = [(1, "http://a.example/p?q#f", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "no address", ""),
         (7, "http://a/1", BIG), (5, "http://a/2", BIG), (9, "http://a/3", BIG), (4, "http://a/4", "y" * 99),
         (6, "http://a/5", "y" * 99), (None, "http://a/\r\n6", BIG), (7, "http://a/1", BIG), (8, "u", "z" * 300000),
         (11, "http://h.example", "\r\n\r\n" * 40)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows],
                                 "page_id long, url string, html string, payload string, type int")


def expected(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        heads = [k for k, _, h in rows if k is not None and h == html and len(body) >= 100]
        again = i is not None and heads and min(heads) != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                    min(heads) if again else None))
    return sorted(out, key=str)


def read(spark, path):
    out = warc.resolve_revisits(warc.assemble(warc.read_records(spark, path)))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_round_trip(spark):
    path = warc.write_archive(frame(spark, PAGES))
    assert read(spark, path) == expected(PAGES)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read_records(spark, path).where("type = 'response'").collect()}
    assert payloads[1].decode() == PAGES[0][2] and len(payloads[8]) == 300000


def test_files_are_warc(spark):
    files = [r["content"] for r in spark.read.format("binaryFile").load(
        warc.write_archive(frame(spark, PAGES[:3]))).collect()]
    data = b"".join(gzip.decompress(f) if f[:2] == b"\x1f\x8b" else f for f in files)
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == 9 and data.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    assert read(spark, warc.write_archive(frame(spark, []))) == []


def test_stored_pages(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in
            spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    out = registry.op10_warc(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, out), key=str) == expected(rows)


def test_identifier_chains(spark):
    rows = [("response", "r1", None), ("request", "q1", "r1"), ("metadata", "m1", "q1"), ("metadata", "m2", "m1"),
            ("metadata", "m3", "m2"), ("metadata", "m4", "m3"), ("request", "lost", "nowhere"),
            ("metadata", "a", "b"), ("metadata", "b", "c"), ("metadata", "c", "a"), ("metadata", "tail", "a")]
    df = spark.createDataFrame([(t, i, c, None, None, None, None, None, None) for t, i, c in rows], warc.RECORDS)
    got = {r["capture"]: (r["response"]["type"], r["request"]["id"], r["metadata"]) for r in warc.assemble(df).collect()}
    assert got["r1"] == ("response", "q1", ["m1", "m2", "m3", "m4"])
    assert got["lost"] == (None, "lost", [])
    assert {k for k in got} == {"r1", "lost", "a", "b", "c", "tail"}


def test_many_copies_of_one_payload(spark):
    rows = [(k, f"http://a/{k}", BIG) for k in range(50_000)] + [(60_000, "http://b", "other")]
    df = spark.range(50_000).selectExpr("id AS page_id", "concat('http://a/', id) AS url", f"'{BIG}' AS html").unionByName(
        spark.createDataFrame(rows[-1:], "page_id long, url string, html string"))
    out = warc.resolve_revisits(warc.assemble(warc.read_records(spark, warc.write_archive(df), payloads=False)))
    got = {(r["record_type"], r["refers_to"]): r["n"] for r in out.groupBy("record_type", "refers_to").agg(F.count("*").alias("n")).collect()}
    assert got == {("response", None): 2, ("revisit", 0): 49_999}
    assert out.where("payload_bytes <> 150").count() == 1


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4 << 20)
    rows = [(k, f"http://a/{k}", chr(97 + k % 26) * (1 << 20) + str(k)) for k in range(30)] + [(100 + k, "http://b", f"small {k}") for k in range(400)]
    df = frame(spark, rows).coalesce(1)
    path = warc.write_archive(df)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").collect()
    sizes = [len(gzip.decompress(r["content"])) for r in files]
    assert max(sizes) <= (4 << 20) * 1.1 and len(sizes) >= 8
    assert read(spark, path) == expected(rows)


def test_pages_of_a_megabyte(spark):
    df = spark.range(200).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "concat(repeat('x', 1000000), id % 150) AS html")
    out = warc.resolve_revisits(warc.assemble(warc.read_records(spark, warc.write_archive(df), payloads=False))).collect()
    assert {r["page_id"]: r["refers_to"] for r in out} == {k: k - 150 if k >= 150 else None for k in range(200)}
