"""WARC archives: round trips, byte ranges and payloads that hold archives themselves."""

import gzip
import hashlib
import io
import random
import zlib

import pytest

import __spark_entry__ as entry
import check_oracle
from tidemark.llm import warc
from tidemark.llm.common import written

TYPES = "page_id long, url string, html string"


def page_rows():
    rng = random.Random(1)
    texts = ["", "short", "é" * 400, "<p>" + "long " * 300, "x" * 999, "x" * 1000, "漢" * 500]
    rows = [(i, f"http://a/{i}", rng.choice(texts)) for i in range(60)]
    rows += [(100 + i, f"http://b/{i}", "same " * 250) for i in range(80)]  # more than half of all
    rows += [(None, None, "same " * 250), (179, "http://again", "same " * 250), (300, " odd\r\nurl ", None), (301, "", "\x1f\x8b\x08")]
    return rows


def brute(rows):
    best = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000:
            best.setdefault(html, []).append(-1 if page is None else page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = max(best.get(html, [-1])) if html in best else page
        again = html in best and original != page
        digest = hashlib.sha1(data).hexdigest()
        out.append((page, len(data), digest, "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [97, 5_000, 1 << 26])
def test_round_trip(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(warc, "CHUNK", 64 if split < 1000 else 1 << 20)
    rows = page_rows()
    df = spark.createDataFrame(rows, TYPES).repartition(3).selectExpr("*", "1 AS key", "2 AS original", "'x' AS payload")
    files = warc.archive(df, str(tmp_path / "out"), file_bytes=4_000)
    assert files.count() > 3
    found = written(warc.records(files, split), "test")
    got = warc.outermost(found).collect()
    pages = [r for r in got if r.type != "warcinfo"]
    as_int = [(None if r.page is None else int(r.page), r.payload_bytes, r.payload_digest, r.type,
               None if r.refers_to is None else int(r.refers_to)) for r in pages]
    assert sorted(as_int, key=str) == brute(rows)
    assert len(got) == files.agg({"records": "sum"}).first()[0] and all(r.sound for r in got)
    html = {}
    for page, _, text in rows:
        html.setdefault(page, set()).add((text or "").encode())
    assert all(bytes(r.payload) in html[None if r.page is None else int(r.page)] for r in pages if r.type == "response")
    assert {r.url for r in pages if r.page == "300"} == {"%20odd%0D%0Aurl%20"} and {r.url for r in pages if r.page is None} == {None}
    # Any other tool reads the same files, and a listing of the folder gives them.
    assert {r.path.rpartition("/")[2] for r in warc.listed(spark, str(tmp_path / "out")).collect()} == {
        r.path.rpartition("/")[2] for r in files.collect()
    }
    for r in files.collect():
        assert gzip.open(r.path).read().count(b"WARC/1.1\r\n") == r.records


def nested(depth):
    """An archive whose payloads hold archives, stored without compression, so their magic shows."""
    inner = b"just text " * 20 if depth == 0 else b"".join(nested(depth - 1))
    return [
        warc.member("resource", [("WARC-Record-ID", f"<urn:page:{depth}-{i}>")], b"<" + inner + b">", warc.DATE, level=0)
        for i in range(3)
    ]


def test_archives_inside_payloads(spark, tmp_path):
    members = nested(2)
    junk = b"\x1f\x8b\x08junk" + zlib.compress(b"x")
    path = tmp_path / "a.warc.gz"
    path.write_bytes(junk + b"".join(members) + MAGIC_TAIL)
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    for split in (61, 700, 1 << 20):
        found = written(warc.records(files, split), "test")
        assert sorted(r.page for r in warc.outermost(found).collect()) == ["2-0", "2-1", "2-2"]
    assert written(warc.records(files, 61), "test").count() > 3  # without the last step they'd be found


MAGIC_TAIL = warc.MAGIC + b"\x00"


def test_damaged_members():
    good = warc.member("response", [("WARC-Record-ID", "<urn:page:1>")], b"body", warc.DATE)
    wrong = [
        good[:-5],  # cut off
        good[:40] + bytes([good[40] ^ 255]) + good[41:],
        gzip.compress(b"not a record"),
        gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"),
        gzip.compress(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nlonger\r\n\r\n"),
        gzip.compress(b"WARC/1.1\r\n" + b"a: b\r\n" * 20_000 + b"\r\n"),
        gzip.compress(b""),
    ]
    for bad in wrong:
        data = bad + good
        source = warc.Source(io.BytesIO(data), len(data))
        assert [(a, b, block) for a, b, _, block in warc.records_of(source, 0, len(data))] == [(len(bad), len(data), b"body")]
        assert list(warc.records_of(source, 0, len(bad))) == []


def test_no_pages(spark):
    files = warc.archive(spark.createDataFrame([], TYPES))
    assert files.collect() == [] and warc.outermost(written(warc.records(files), "test")).collect() == []


def test_query_on_odd_pages(spark, tmp_path):
    spark.createDataFrame(page_rows(), TYPES).write.parquet(str(tmp_path / "pages.parquet"))
    got = entry.queries()["op11_warc_archives"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(page_rows())


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert check_oracle.compare(spark, check_oracle.connect(folder), folder, "op11_warc_archives") == ""
