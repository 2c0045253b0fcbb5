import hashlib

import zstandard

from fraudlane.llm import warc
from fraudlane.scratch import scratch_path

PAGES = "page_id long, url string, html string"


def pages_of(spark, write_prose):
    same, tiny = f"<p>{write_prose(1, 40)}</p>", "x" * 99
    rows = [(i, f"http://a/{i}", f"<p>{write_prose(10 + i, 60)}</p>") for i in range(40)]
    rows += [(50 + i, "http://b", same) for i in range(30)] + [(90, None, tiny), (91, "u", tiny), (92, "u", None), (93, "u", ""), (94, "ü\nü", "é" * 50), (95, "v", "é" * 50)]
    return spark.createDataFrame(rows, PAGES), rows


def test_round_trip(spark, write_prose):
    pages, rows = pages_of(spark, write_prose)
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, archive_bytes=4_000)
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    assert len(got) == len(rows)
    for i, url, html in rows:
        data, r = (html or "").encode(), got[i]
        revisit = len(data) >= 100 and first[html] != i
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[html]) if revisit else ("response", None))
        assert r.target_uri == " ".join((url or "").split()) and r.payload == (None if revisit else data)


def test_an_archive_is_plain_zstandard_with_its_dictionary_in_front(spark, write_prose):
    pages, _ = pages_of(spark, write_prose)
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, archive_bytes=4_000)
    archives = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    assert len(archives) > 1
    for archive in archives:
        assert archive[:4] == (0x184D2A5D).to_bytes(4, "little")
        dictionary, frames = warc.split_frames(archive)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        assert all(zstandard.ZstdDecompressor(dict_data=known).decompress(f).startswith(b"WARC/1.1\r\n") for f in frames)


def test_odd_rows(spark):
    long = "<p>" + "a b" * 100_000
    rows = [(None, None, None), (None, "u", long), (3, "u", long), (3, "u", long), (4, "v", long), (5, "w", "")]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages.selectExpr("*", "1 AS first", "2 AS id", "3 AS payload")).collect())
    n = len(long)
    want = [(-1, 0, "response", None), (-1, n, "revisit", 3), (3, n, "response", None), (3, n, "response", None), (4, n, "revisit", 3), (5, 0, "response", None)]
    assert got == sorted(want)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
