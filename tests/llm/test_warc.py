"""Archives: what is written comes back, whatever payloads hold and however files are cut."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
SCHEMA = "page_id bigint, url string, html string"


def awkward_pages():
    rng = random.Random(5)
    pages = [(k, f"http://h/{k}", "é<p>\r\n\r\n" * rng.randrange(60) + rng.choice(["", FAKE, "WARC/1.1\r\n", FAKE * 3])) for k in range(120)]
    pages += [(k, None, "a" * 1000 + FAKE) for k in range(200, 230)]  # copies, large enough to refer to
    pages += [(300, "u\r\nWARC-Type: x", None), (301, "", ""), (302, "u", "a" * 999), (303, "u", "a" * 999)]
    pages += [(None, "u", "b" * 1200), (None, "u", "b" * 1200), (400, "u", "c" * 2000), (400, "u", "c" * 2000)]
    pages += [(500, "u", "WARC/1.1\r\n" * 700)]
    return pages


def expected(pages):
    last = {}
    for page, _, html in pages:
        last[html or ""] = max(last.get(html or "", -1), -1 if page is None else page)
    rows = []
    for page, _, html in pages:
        raw = (html or "").encode()
        top = last[html or ""]
        revisit = len(raw) >= 1000 and top >= 0 and page != top
        rows.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(rows, key=str)


@pytest.mark.parametrize("part_bytes", ["700", "5000", "128m"])
def test_round_trip(spark, tmp_path, monkeypatch, part_bytes):
    pages = awkward_pages()
    folder = str(tmp_path / "in")
    frame = spark.createDataFrame(pages, SCHEMA).coalesce(2).withColumn("file", F.lit("clash")).withColumn("_digest", F.lit(1))
    frame.write.parquet(f"{folder}/pages.parquet")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        result = [tuple(row) for row in queries.op5_warc(spark, folder).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert sorted(result, key=str) == expected(pages)


def test_payloads_are_whole(spark, tmp_path):
    pages = [row for row in awkward_pages() if row[0] is not None and row[0] < 200]
    path = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(pages, SCHEMA), path, least_bytes=10**9)
    records = warc.read_archives(spark, path).select(warc.field(F.col("header"), "WARC-Target-URI"), "payload").collect()
    assert sorted((url, bytes(payload).decode()) for url, payload in records) == sorted((url, html) for _, url, html in pages)


def test_foreign_and_empty_files(spark, tmp_path):
    path = tmp_path / "archives"
    path.mkdir()
    (path / "a.warc").write_bytes(b"junk before\r\n\r\n" + FAKE.encode())
    (path / "b.warc").write_bytes((FAKE + FAKE + FAKE[:-9]).encode())
    (path / "c.warc").write_bytes(b"")
    records = warc.read_archives(spark, str(path)).select("file", "payload").collect()
    assert sorted((row.file[-6:], bytes(row.payload)) for row in records) == [("b.warc", b"")] + [("b.warc", b"hello")] * 2


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    assert queries.op5_warc(spark, str(tmp_path)).count() == 0
