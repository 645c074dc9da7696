"""Archives round-trip, dedup and verify."""

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from churnlens.llm import warc

SF = "/root/testdata/sf0.001"


def packed(*records):
    return b"".join(m + b"\0" for m in map(warc.member, records))


def page(i, payload, refers_to=None, url="http://x/"):
    return warc.record(i, url, payload, hashlib.sha1(payload).hexdigest(), refers_to,
                       "http://first/" if refers_to is not None else None, "2026-01-01T00:00:00Z")


def expected(rows):
    last = {}
    for i, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            last[h] = max(last.get(h, i), i)
    out = []
    for i, h in rows:
        p = (h or "").encode()
        refer = last.get(h) if len(p) >= 1000 and last.get(h) != i else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if refer is not None else "response", refer))
    return sorted(out, key=str)


def test_whole_table(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = warc.op9_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_nulls_ties_empty_and_extra_columns(spark, scratch):
    big, other = "é" * 700, "x" * 1000
    rows = [(1, big), (5, big), (5, big), (None, big), (2, None), (3, ""), (4, "s"), (6, "s"), (7, other), (None, None),
            (8, "\r\n\r\n" + other)]
    data = [(i, None if i == 4 else f"http://h/{i}\r\nX: y", h, "extra") for i, h in rows]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, digest string")
    warc.write_archives(pages.coalesce(1), f"{scratch}/a", file_bytes=1500)
    assert len(list(Path(f"{scratch}/a").glob("part-*"))) >= 4  # a few records each, by the bytes they hold
    got = [tuple(r) for r in warc.read_archives(spark, f"{scratch}/a").drop("url").collect()]
    assert sorted(got, key=str) == expected(rows)
    warc.write_archives(pages.limit(0), f"{scratch}/b")
    assert warc.read_archives(spark, f"{scratch}/b").collect() == []


def test_each_record_is_a_gzip_member_of_any_size():
    rng = random.Random(1)
    payloads = [rng.randbytes(n) for n in (0, 1, 70_000, 17 << 20)]
    raw = packed(*(page(i, p) for i, p in enumerate(payloads)))
    assert gzip.decompress(raw) == b"".join(page(i, p) for i, p in enumerate(payloads))
    for size in (1, 7919, len(raw)):
        if size == 1:
            part = packed(page(0, b"abc"), page(1, b""))
            got = list(warc.read_archive((part[i:i + 1] for i in range(len(part))), keep_payload=True))
            assert [r.payload for r in got] == [b"abc", b""]
            continue
        got = list(warc.read_archive((raw[i:i + size] for i in range(0, len(raw), size)), keep_payload=True))
        assert [r.payload for r in got] == payloads


def test_damage_is_found():
    good = page(1, b"hello world" * 50)
    with pytest.raises(ValueError, match="digest|payload"):
        list(warc.read_archive([packed(good.replace(b"hello", b"hallo", 1))]))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_archive([packed(good)[:-20]]))
    with pytest.raises(ValueError, match="content length"):
        list(warc.read_archive([packed(good + b"more")]))
    with pytest.raises(ValueError, match="header"):
        list(warc.read_archive([packed(b"nothing like it\r\n\r\n")]))


def test_revisits_name_their_record(spark, scratch):
    big = "b" * 1500
    pages = spark.createDataFrame([(1, "http://h/1", big), (9, "http://h/9", big), (9, "http://h/8", big), (3, None, big)],
                                  "page_id long, url string, html string")
    warc.write_archives(pages, f"{scratch}/a")
    found = [r for p in Path(f"{scratch}/a").glob("part-*") for r in warc.read_archive([p.read_bytes()])]
    ids = {r.headers["warc-record-id"]: r.headers for r in found if r.headers["warc-type"] == "response"}
    revisits = [r.headers for r in found if r.headers["warc-type"] == "revisit"]
    assert len(ids) == 2 and len(revisits) == 2
    for h in revisits:
        assert ids[h["warc-refers-to"]]["warc-target-uri"] == "http://h/9" == h["warc-refers-to-target-uri"]


def test_foreign_records_are_passed_over(spark, scratch):
    def foreign(kind, block, *extra):
        head = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", f"Content-Length: {len(block)}", *extra]
        return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    request = foreign("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", "Content-Type: application/http; msgtype=request")
    plain = foreign("response", http, "Content-Type: application/http; msgtype=response", "WARC-Target-URI: http://o/",
                    "WARC-Payload-Digest: md5:abc")
    raw = packed(foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), request,
                 page(4, b"mine"), foreign("metadata", b""), plain)
    Path(f"{scratch}/w").mkdir()
    Path(f"{scratch}/w/part-0.warc.gz").write_bytes(raw)
    rows = sorted(map(tuple, warc.read_archives(spark, f"{scratch}/w").collect()), key=str)
    sha = lambda b: hashlib.sha1(b).hexdigest()
    assert rows == sorted([(4, "http://x/", 4, sha(b"mine"), "response", None),
                           (None, "http://o/", 4, sha(b"body"), "response", None)], key=str)
    with pytest.raises(ValueError, match="block digest"):
        list(warc.read_archive([packed(foreign("warcinfo", b"a", "WARC-Block-Digest: sha1:" + "A" * 32))]))
