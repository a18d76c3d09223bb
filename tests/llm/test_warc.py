import gzip
import glob
import hashlib

from holdfast.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first string, file string"
BIG = "<p>" + "long enough to be shared " * 10 + "</p>"
PAGES = [
    (5, "https://www.b.example/x?q=1", BIG),
    (3, "https://b.example/y", BIG),
    (9, None, BIG),
    (4, "http://a.example:8080/", "tiny"),
    (6, "http://a.example:8080/", "tiny"),
    (7, "not a url\r\nat all", None),
    (8, "http://[bad", ""),
    (None, "http://n.example/", BIG),
    (10, "http://é.example/ü", "WARC/1.1\r\n\r\n\r\n" + "héllo\r\n\r\n" * 20),
    (10, "http://é.example/ü", "WARC/1.1\r\n\r\n\r\n" + "héllo\r\n\r\n" * 20),
    (11, "http://c.example/", "x" * 500_000),
]


def frame(spark, pages=PAGES):
    return spark.createDataFrame([(*p, "x", "x", "x") for p in pages], SCHEMA)


def expected(pages):
    firsts = {}
    for i, _, h in pages:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            firsts[data] = min(i, firsts.get(data, i))
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        first = firsts.get(data)
        revisit = first is not None and i is not None and first != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark, tmp_path):
    got = warc.archive(frame(spark), str(tmp_path / "w"))
    told = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, told), key=str) == expected(PAGES)
    # the files are plain gzip, and unpack to records that follow each other
    for path in glob.glob(str(tmp_path / "w/records/part-*")):
        with gzip.open(path) as f:
            assert f.read(9) == b"WARC/1.1\r"
    payloads = warc.read_archives(spark, str(tmp_path / "w/records"), payloads=True).collect()
    assert sorted((r["page_id"] or 0, bytes(r["payload"]).decode()) for r in payloads if r["record_type"] == "response") == sorted(
        (i or 0, h or "") for (i, _, h), e in ((p, next(x for x in expected(PAGES) if x[0] == p[0])) for p in PAGES) if e[3] == "response"
    )


def test_lookup_reads_ranges(spark, tmp_path):
    pages = [(n, f"http://h{n % 13}.example/{n}", f"page {n}") for n in range(300)] + [(1000 + n, "http://same.example/", f"v{n}") for n in range(50)]
    folder = str(tmp_path / "w")
    warc.write_archives(frame(spark, pages), f"{folder}/records")
    warc.write_index(warc.read_archives(spark, f"{folder}/records"), f"{folder}/index", block=16)
    assert spark.read.parquet(f"{folder}/index/directory").count() >= 350 // 16
    for n in (0, 17, 299):
        found = warc.lookup(spark, f"{folder}/records", f"{folder}/index", f"http://h{n % 13}.example/{n}")
        assert [(r["page_id"], r["payload"]) for r in found] == [(n, f"page {n}".encode())]
    assert len(warc.lookup(spark, f"{folder}/records", f"{folder}/index", "http://same.example/")) == 50
    assert warc.lookup(spark, f"{folder}/records", f"{folder}/index", "http://none.example/") == []
    assert warc.read_index(spark, f"{folder}/index").count() == 350


def test_keys():
    assert warc.url_key("https://www.B.example.org:443/a?b#c") == "org,example,b:443)/a?b"
    assert warc.url_key("http://x.example") == "example,x)/"
    assert warc.url_key(None) == "" and warc.url_key("plain") == "plain"


def test_empty_table(spark, tmp_path):
    assert warc.archive(frame(spark, []), str(tmp_path / "w")).count() == 0
