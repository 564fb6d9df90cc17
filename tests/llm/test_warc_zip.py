from __future__ import annotations

import base64
import hashlib
import io
import random
import struct
import zipfile

import pytest

from cartlens.llm import warc_zip as W


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _want(rows):
    """Brute force of the contract: (page_id, bytes, digest, type, refers_to)."""
    best = {}
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        if page is not None:
            best[payload] = max(best.get(payload, page), page)
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        winner = best.get(payload)
        first = winner is None or page == winner
        out.append((page, len(payload), _digest(payload), "response" if first else "revisit", None if first else winner))
    return sorted(out, key=str)


def _pages(rng, n=300):
    pool = [None, "", "<p>same</p>", "<b>é\U00010348</b>\r\n\r\nx", "y" * 70_000]
    rows = [(i, f"http://h{i % 5}/p?q={i} ü\r\nX: 1", rng.choice(pool) if rng.random() < .5 else f"<i>{i}</i>" * rng.randrange(9), "x")
            for i in range(n)]
    return rows + [(None, None, "<p>same</p>", "x"), (None, None, "alone", "x"), (7, "u", "twice", "x"), (7, "u", "twice", "x"),
                   (5, None, "twice", "x"), (9, "u", "<p>other text</p>", "x")]


def test_query_equals_brute_force(spark):
    rows = _pages(random.Random(2))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string").repartition(3)
    got = W.query(pages)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _want(rows)
    assert W.query(pages.limit(0)).count() == 0
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_texts_come_back_and_packages_roll_over(spark, tmp_path):
    rows = _pages(random.Random(4), 80)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, extra string").repartition(2)
    manifest = W.write_packages(pages, str(tmp_path / "out"), package_bytes=4000).collect()
    assert len(manifest) > 4 and sum(m.n_records for m in manifest) == len(rows)
    found = W.packages(spark, str(tmp_path / "out"))
    assert found.count() == len(manifest)
    records = W.read_records(found, range_bytes=2000).collect()
    responses = [r for r in records if r.record_type == "response"]
    assert all(r.digest_ok and _digest(r.payload) == r.payload_digest for r in responses)
    assert len([r for r in records if r.record_type == "warcinfo"]) == len(manifest)
    by_id = {r.record_id: r for r in responses}
    for r in records:
        if r.record_type == "revisit":
            assert r.payload is None and by_id[r.refers_to_id].payload_digest == r.payload_digest
            assert len(by_id[r.refers_to_id].payload) == r.payload_bytes
    texts = {(r.page_id, r.payload.decode()) for r in responses}
    assert texts <= {(p, h or "") for p, _, h, _ in rows} and all("\r" not in (r.target_uri or "") for r in records)
    assert {m.name for m in W.list_members(found).collect()} == {W.ARCHIVE, W.INDEX}
    with zipfile.ZipFile(manifest[0].path) as z:          # an ordinary reader agrees with ours
        assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())


def test_small_payloads_stay_responses(spark):
    rows = [(1, None, ""), (2, None, ""), (3, None, "long enough"), (4, None, "long enough")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in W.with_references(pages, min_revisit_bytes=5).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


class _File(io.BytesIO):
    def read_at(self, n, at):
        return self.getvalue()[at:at + n]

    def size(self):
        return len(self.getvalue())


def _zip(members, method=zipfile.ZIP_STORED, comment=b""):
    out = _File()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members:
            z.writestr(name, data)
        z.comment = comment
    return out


def test_central_directory_forms():
    members = [("a.warc", b"x" * 10), ("é/b", b""), ("c", b"PK\x05\x06" * 9)]
    for prefix in (b"", b"#!/bin/sh\n"):
        for comment in (b"", b"note PK\x05\x06 with a signature and more than twenty-two bytes"):
            file = _File(prefix + _zip(members, comment=comment).getvalue())
            found = W.zip_members(file, file.size())
            assert [(n, file.read_at(size, at)) for n, _, _, at, size in found] == members
    many = _zip([(str(k), b"") for k in range(66_000)])    # more than 65,535 members: ZIP64 end record
    assert len(W.zip_members(many, many.size())) == 66_000
    with pytest.raises(ValueError, match="whole ZIP"):
        W.zip_members(_File(b"PK\x03\x04 no end"), 12)


def test_zip64_sizes_and_offset():
    data, name = b"WARC bytes", b"archive/data.warc"
    local = W.LOCAL + struct.pack("<5HIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHH", 0x9999, 2, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = W.CENTRAL + struct.pack("<6HIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra),
                                      0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = W.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = W.LOCATOR64 + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = W.END + struct.pack("<4HIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    for prefix in (b"", b"stub"):
        file = _File(prefix + local + central + end64 + locator + end)
        [(got, method, _, at, size)] = W.zip_members(file, file.size())
        assert (got, method, file.read_at(size, at)) == (name.decode(), 0, data)


def _records(n, gz):
    out = []
    for k in range(n):
        record = W.warc_record("response", W.record_id(k, b"p"), b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc", "2026-01-01T00:00:00Z",
                               Content_Type="application/http; msgtype=response", X_Page_Id=str(k), WARC_Payload_Digest=f"sha1:{_digest(b'abc')}")
        out.append(record if gz else __import__("zlib").decompress(record, 31))
    return out


@pytest.mark.parametrize("gz", [True, False])
def test_missing_and_partial_indexes_lose_no_record(spark, tmp_path, gz):
    records, name = _records(9, gz), "data.warc.gz" if gz else "data.warc"
    starts = [sum(map(len, records[:k])) for k in range(9)]
    line = "u 2026 {\"filename\": \"%s\", \"offset\": \"%d\", \"length\": \"%d\"}\n"
    index = "".join(line % (name, starts[k], len(records[k])) for k in (1, 4, 5))
    body = b"".join(records)
    for k, members in enumerate(([("archive/" + name, body)], [("archive/" + name, body), ("indexes/index.cdxj", index)])):
        (tmp_path / f"{k}.zip").write_bytes(_zip(members).getvalue())
    got = W.read_records(W.packages(spark, str(tmp_path))).collect()
    assert sorted((r.path[-5], r.page_id, r.payload) for r in got) == sorted((c, k, b"abc") for c in "01" for k in range(9))
    assert all(r.digest_ok for r in got)


def test_compressed_and_cut_archives_raise(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(_zip([("archive/data.warc", b"WARC/1.1" * 50)], zipfile.ZIP_DEFLATED).getvalue())
    with pytest.raises(Exception, match="cannot be read by ranges"):
        W.read_records(W.packages(spark, str(tmp_path))).collect()
    whole = b"".join(_records(2, True))
    with pytest.raises(ValueError, match="cut off"):
        list(W.walk_records(_File(whole[:-20]), 0, len(whole) - 20))
