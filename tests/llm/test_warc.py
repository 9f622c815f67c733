import hashlib
from collections import defaultdict

import pytest
from corpusloom.llm import warc


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string, key string, digest string")

    return make


ROWS = [
    (1, "http://a.example/x y", "<p>é\r\n\r\nWARC/1.0\r\n", None, "d"),
    (2, None, "<p>é\r\n\r\nWARC/1.0\r\n", "k", "d"),
    (3, "u", None, "k", None),
    (4, "u", "", "k", "d"),
    (4, "u", "", "k", "d"),
    (None, "u", "only\nhere", "k", "d"),
    (None, "u", "", "k", "d"),
    (5, "u", "filedesc://x 0 0 text/plain 9\n", "k", "d"),
    (6, "u", "long " * 100_000, "k", "d"),
]


def convert(spark, frame, version, least=0):
    folder = warc.archive_folder(spark)
    warc.write_arc(frame, "page_id", "url", "html", f"{folder}/arc", version)
    warc.convert(spark, f"{folder}/arc", f"{folder}/warc", least_bytes=least)
    return warc.read_warc(spark, f"{folder}/warc").where("record_type <> 'warcinfo'")


@pytest.mark.parametrize("version, size", [(1, 1000), (2, 2)])
def test_round_trip(spark, pages, monkeypatch, version, size):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", size)
    rows = convert(spark, pages(ROWS), version).collect()
    same = defaultdict(list)
    for i, _, html, _, _ in ROWS:
        same[html or ""].append(i)
    expected = []
    for i, _, html, _, _ in ROWS:
        raw = (html or "").encode()
        top = max(same[html or ""], key=lambda x: -1 if x is None else x)
        kind = ("response", None) if i == top else ("revisit", str(top))
        expected.append((str(i), len(raw), warc.digest(raw), *kind))
    got = [(str(r.key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(r.block_digest_ok for r in rows)
    assert {r.url for r in rows} == {"http://a.example/x%20y", "unknown:", "u"}
    assert {r.date for r in rows} == {"2020-01-01T00:00:00Z"}


def test_small_payloads_stay_responses(spark, pages):
    rows = convert(spark, pages(ROWS), 1, least=5).collect()
    assert {r.record_type for r in rows if r.payload_bytes < 5} == {"response"}
    assert [r.key for r in rows if r.record_type == "revisit"] == ["1"]


def test_header_fields_follow_the_version():
    body = "2 0 x\n" + warc._FIELDS[2] + "\n"
    block = b"HTTP/1.1 200 OK\r\n\r\nhi"
    data = f"filedesc://x 0.0.0.0 20200101000000 text/plain 200 - - 0 - {len(body)}\n{body}\n".encode()
    data += f"http://u 1.2.3.4 20210203040506 text/html 200 - - 0 f {len(block)}\n".encode() + block + b"\n"
    version, record = warc.arc_records(data)
    assert version[0] == "filedesc://x" and version[3].decode() == body
    assert record == ("http://u", "20210203040506", "text/html", block)


def test_archives_of_others(spark, tmp_path):
    """Payloads of any bytes, DNS answers, LF headers, spaced types, missing line ends, no gzip."""
    body = "1 0 Crawler\n" + warc._FIELDS[1] + "\n"
    blocks = [
        ("http://a", "text/html; charset=iso-8859-1", b"HTTP/1.0 200 OK\nServer: x\nX-Record-Key: 1\n\ncaf\xe9\n\n\x00"),
        ("dns:a", "text/dns", b"20210203040506\na. 5 IN A 1.2.3.4\n"),
        ("http://b", "image/gif", b"HTTP/1.1 200 OK\r\nX-Record-Key: 2\r\n\r\nGIF\xff\xfe"),
        ("http://c", "no-type", b"HTTP/1.1 204 No Content\r\nX-Record-Key: 3"),
        ("http://d", "image/gif", b"HTTP/1.1 200 OK\nX-Record-Key: 4\n\nGIF\xff\xfe"),
    ]
    data = f"filedesc://x.arc 0.0.0.0 20210203040506 text/plain {len(body)}\n{body}\n".encode()
    for url, kind, block in blocks:
        data += f"{url} 1.2.3.4 20210203040506 {kind} {len(block)}\n".encode() + block + b"\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.arc").write_bytes(data)
    warc.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = {r.url: r for r in warc.read_warc(spark, str(tmp_path / "out")).collect()}
    assert all(r.block_digest_ok for r in rows.values()) and len(rows) == 6
    kinds = {u: (r.record_type, r.payload_bytes, r.refers_to) for u, r in rows.items()}
    assert kinds == {
        None: ("warcinfo", len(f"format: WARC File Format 1.0\r\ndescription: ARC {body.strip()}\r\n"), None),
        "http://a": ("response", 7, None), "dns:a": ("resource", len(blocks[1][2]), None),
        "http://b": ("revisit", 5, "4"), "http://c": ("response", 0, None), "http://d": ("response", 5, None),
    }
    assert rows["http://a"].payload_digest == warc.digest(b"caf\xe9\n\n\x00")
    assert rows["dns:a"].payload_digest == warc.digest(blocks[1][2])
    assert {r.date for r in rows.values()} == {"2021-02-03T04:05:06Z"}


def test_digest_is_bare_base32():
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(hashlib.sha1(b"").digest()) == 20


def test_empty_table(spark, pages):
    assert convert(spark, pages([]), 1).collect() == []
