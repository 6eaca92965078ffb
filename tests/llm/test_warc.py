import base64
import gzip
import hashlib
import io

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from panelcast.llm import warc

SCHEMA = "page_id long, url string, html string, key string, archive string"


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "k", "a") for r in rows], SCHEMA)
    return make


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = page is not None and page > first[html or ""]
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(pages):
    rows = [(i, f"http://h{i % 3}.example.com/{i % 5}?q={i}", f"<p>é{i % 7}</p>" * (1 + i % 4)) for i in range(200)]
    rows += [(500, None, None), (501, None, ""), (501, None, ""), (None, "x\r\ny", "z"), (502, "HTTP://WWW.Example.org:80#f", "\r\n\r\n"),
             (503, "http://u@e.org", "<a>" * 200_000), (-7, "http://e.org/ ", "<a>" * 200_000)]
    got = warc.archive_and_read(pages(rows).repartition(3)).collect()
    seen = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got]
    assert sorted(seen, key=repr) == expected(rows)
    assert {(r["page_id"], r["url"]) for r in got} == {(p, u) for p, u, _ in rows}
    assert warc.archive_and_read(pages([])).count() == 0


def test_small_payloads_can_be_responses(pages):
    rows = [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "x" * 50), (4, "d", "x" * 50)]
    got = {r["page_id"]: r["record_type"] for r in warc.archive_and_read(pages(rows), least_bytes=10).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_index_blocks_and_url_ranges(pages, spark):
    rows = [(i, f"http://h{i % 40}.example.com/p", f"t{i}") for i in range(2000)]
    captures = warc.write_archives(pages(rows).repartition(2))
    index = warc.build_index(captures, files=3)
    assert index.count() == 3 and index.agg(F.sum("n_lines")).first()[0] == 2000
    urls = spark.createDataFrame([("http://h7.example.com/p",), ("http://none.example.com/",), ("https://www.h39.example.com:443/p#z",)], "url string")
    found = warc.lookup(index, warc.captures_of(urls)).collect()
    assert sorted(r["page_id"] for r in found) == sorted(i for i in range(2000) if i % 40 in (7, 39))
    # members are gzip files of their own
    one = found[0]
    store, path = pafs.FileSystem.from_uri(one["archive"] if "://" in one["archive"] else f"file://{one['archive']}")
    raw = store.open_input_file(path).read()[one["offset"]:one["offset"] + one["length"]]
    assert gzip.GzipFile(fileobj=io.BytesIO(raw)).read().startswith(b"WARC/1.1\r\nWARC-Type: response")


def test_url_key(spark):
    urls = ["http://m.a.Example.com/X?y=1#z", "https://www.a.org", "http://u:p@b.org:443?q", None, "a b"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert got == ["com,example,a,m)/X?y=1", "org,a)/", "org,b)/?q", "", "a%20b)/"]


def test_damage_is_noticed():
    raw = warc.record_bytes("http://a", 1, b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), 7, None)
    assert warc.parse_record(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload\r", b"paYload\r"))
