import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import rows_of

from candela.llm import warc
from candela.llm.queries import op10_warc


@pytest.fixture(scope="module")
def rows():
    big = "".join(f"<p>é {i * 7919 % 1000003}</p>" for i in range(60_000))
    same = "<html>" + "x" * 200 + "</html>"
    out = [(i, f"http://h/{i}", f"<html>{'y' * (i % 150)}{i // 2}</html>") for i in range(120)]
    return out + [(900, "http://a/\r\nWARC-Type: x", same), (901, None, same), (899, "é ü", same), (899, "twice", same), (None, "n", same), (None, "n", "z" * 300), (None, "n", "z" * 300),
                  (902, "u", None), (903, "u", ""), (904, "u", big), (905, "u", big), (906, "u", "\x1f\x8b\x08" * 50), (-7, "u", "WARC/1.1\r\n\r\n" * 20), (907, "u", "s" * 99), (908, "u", "s" * 99)]


def plain(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None and len(p) >= 100:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first.get(p) if len(p) >= 100 and first.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [97, 5000, 1 << 24])
def test_round_trip_at_any_range_size(spark, rows, size):
    pages = spark.createDataFrame([(a, b, c, 1) for a, b, c in rows], "page_id long, url string, html string, payload int").repartition(2)
    files = warc.write_warc(pages, file_bytes=20_000)
    if size < 1000:  # a long record costs a scan for every range it covers, so these ranges go without it
        pages = pages.where("coalesce(length(html), 0) < 100000")
        files = warc.write_warc(pages, file_bytes=3_000)
        rows = [r for r in rows if len(r[2] or "") < 100_000]
    got = warc.read_warc(files, range_bytes=size)
    assert rows_of(got.select(warc.page_of(F.col("record_id")), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")))) == plain(rows)
    for r in got.where("record_type = 'response'").select("payload", "payload_digest").collect():
        assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest


def test_files_are_plain_gzip_and_listed(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = warc.write_warc(pages, folder=f"file:{tmp_path}/w")
    listed = warc.list_archives(spark, f"file:{tmp_path}/w")
    assert listed.count() == files.count()
    assert rows_of(warc.read_warc(listed).select("record_id")) == rows_of(warc.read_warc(files).select("record_id"))
    for path in (tmp_path / "w").glob("*.warc.gz"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_rubbish_between_records_is_passed_over():
    one = warc.record_bytes("urn:page:1", "http://a", "d", 3, b"abc", None, "2024-01-01T00:00:00Z")
    data = b"\x1f\x8b\x08junk" + one + b"\0\0" + gzip.compress(b"no warc") + one[:-9] + one + one[:20]
    for cut in (1, 30, 10_000):
        found = [x for s in range(0, len(data), cut) for x in warc.records_in(io.BytesIO(data), s, min(len(data), s + cut))]
        assert [f["payload"] for _, _, f in found] == [b"abc"] * 2


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op10_warc(spark, str(tmp_path)).collect() == []
