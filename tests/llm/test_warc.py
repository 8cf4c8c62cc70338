import base64
import hashlib
import io

import pytest
import zstandard

from renewlens.llm import warc

ROWS = [(1, "http://a/1", "<p>one"), (2, "http://a/2", "same"), (5, "http://a/5", "same"), (3, None, None), (4, "http://a/4", ""), (6, "http://a\r\nX: y", "é\r\n\r\nWARC/1.1"),
        (None, "http://a/n", "same"), (None, "http://b/n", "lone"), (8, "u", "twice"), (8, "u", "twice"), (9, "long", "x" * 3_000_000)] + [(100 + i, f"http://h/{i}", f"<html>{i} " + "text " * (i % 50)) for i in range(300)]


def want(rows, least=0):
    last = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None:
            last[h] = max(last.get(h, p), p)
    out = []
    for p, _, h in rows:
        h = (h or "").encode()
        twin = sum((x or "").encode() == h for *_, x in rows) > 1
        revisit = twin and len(h) >= least and p != last.get(h)
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if revisit else "response", last.get(h) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,archive", [(0, warc.ARCHIVE_BYTES), (3, 4000)])
def test_round_trip(spark, tmp_path, least, archive):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, sha string").repartition(3)
    written = warc.write_archives(pages, f"file://{tmp_path}/w", least, archive)
    assert written.agg({"records": "sum"}).first()[0] == len(ROWS)
    got = warc.read_archives(written, payloads=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(ROWS, least)
    assert {bytes(r.payload) for r in got if r.record_type == "response"} >= {(h or "").encode() for *_, h in ROWS if len((h or "").encode()) >= 3}
    if archive < 10_000:
        assert written.count() > 3


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def archive(raws, dictionary=b""):
    packer = zstandard.ZstdCompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
    return (warc.leading_frame(dictionary) if dictionary else b"") + b"".join(packer.compress(r) for r in raws)


def test_reader_takes_plain_and_packed_dictionaries_and_skippable_frames():
    raws = [warc.record(i, "u", b"payload %d" % i, warc.digest32(hashlib.sha1(b"payload %d" % i).hexdigest()), 9, None, False) for i in range(4)]
    words = b"WARC/1.1 payload application/http response" * 3
    assert list(warc.records(io.BytesIO(archive(raws)), chunk=7)) == raws
    assert list(warc.records(io.BytesIO(archive(raws, words)), chunk=11)) == raws
    packed = warc.leading_frame(zstandard.ZstdCompressor().compress(words)) + archive(raws, words)[8 + len(words) :]
    assert list(warc.records(io.BytesIO(packed))) == raws
    skip = (0x184D2A50).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"-----"
    assert list(warc.records(io.BytesIO(archive(raws[:1]) + skip + archive(raws[1:])), chunk=5)) == raws
    assert [warc.checked(*warc.parse(r))["page_id"] for r in raws] == [0, 1, 2, 3]


@pytest.mark.parametrize("broken", ["cut", "length", "digest", "header", "magic", "type"])
def test_broken_archives_are_refused(broken):
    raw = warc.record(1, "u", b"payload", warc.digest32(hashlib.sha1(b"payload").hexdigest()), 7, None, False)
    change = {"length": (b"Content-Length: ", b"Content-Length: 1"), "digest": (b"payload\r\n\r\n", b"Payload\r\n\r\n"), "header": (b"WARC/1.1", b"HTTP/1.1"), "type": (b"WARC-Type: response", b"WARC-Type: request")}
    bad = archive([raw.replace(*change[broken])]) if broken in change else archive([raw])[:-5] if broken == "cut" else archive([raw]) + b"not a frame"
    with pytest.raises(warc.WarcError):
        for r in warc.records(io.BytesIO(bad)):
            warc.checked(*warc.parse(r))
