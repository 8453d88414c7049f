import base64
import hashlib
import io
import random
import zipfile
import zlib

import pytest

from codeloom.llm import warc


def opened(data):
    return warc.ZipArchive(lambda at, n: data[at:at + n], len(data))


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path / "archives")


ROWS = [(1, "http://a/x", "<p>é</p>"), (2, "http://a/y", "<p>é</p>"), (3, None, None), (4, "u\r\nWARC-Type: revisit ü", ""), (5, "http://b", "x" * 300_000), (6, "http://b", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (None, "http://n", "<p>é</p>"), (None, "http://n", "only null"), (None, "http://n", "only null"), (2, "http://a/y", "<p>é</p>"), (7, "http://c", "own")]


def test_round_trip(spark, folder):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, payload string").repartition(2)
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder).collect()
    keep = {}
    for i, _, h in ROWS:
        if i is not None:
            keep[h or ""] = max(i, keep.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        b = (h or "").encode()
        k = keep.get(h or "")
        revisit = k is not None and k != i
        want.append((i, len(b), digest(b), "revisit" if revisit else "response", k if revisit else None, None if revisit else b))
    assert sorted(map(repr, ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got))) == sorted(map(repr, want))


def capture(i, body, kind="response", head="HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"):
    block = head.encode() + body
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:0000-{i}>", f"WARC-Target-URI: <http://x/{i}>", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def foreign(folder, gz_index):
    """An archive as other writers make it: several members, plain and compressed records, CDXJ lines with key and timestamp."""
    import gzip
    import json
    import os
    os.makedirs(folder, exist_ok=True)
    want = {}
    with zipfile.ZipFile(f"{folder}/a b.wacz", "w") as z:
        lines = [b'!meta {"format": "cdxj"}\n']
        for name, pack in (("one.warc.gz", gzip.compress), ("two.warc", bytes), ("sub/three.warc.gz", gzip.compress)):
            data, at = b"", 0
            for i in range(5):
                body = f"<p>{name} {i} é</p>".encode() * (i + 1)
                raw = pack(capture(f"{name}/{i}", body))
                lines.append(f"x)/{i} 20200101000000 ".encode() + json.dumps({"url": f"http://x/{i}", "offset": str(at), "length": str(len(raw)), "filename": name}).encode() + b"\n")
                want[f"http://x/{name}/{i}"] = body
                data, at = data + raw, at + len(raw)
            z.writestr(f"archive/{name}", data)
        z.writestr("datapackage.json", "{}")
        z.writestr("indexes/index.cdx.gz" if gz_index else "indexes/index.cdxj", gzip.compress(b"".join(lines[:4])) + gzip.compress(b"".join(lines[4:])) if gz_index else b"".join(lines))
        z.writestr("pages/pages.jsonl", "{}")
    return want


@pytest.mark.parametrize("seek", [False, True])
@pytest.mark.parametrize("gz_index", [False, True])
def test_archives_of_another_writer(spark, folder, seek, gz_index):
    want = foreign(folder, gz_index)
    got = warc.read_archives(spark, folder, seek=seek).collect()
    assert {r["url"]: bytes(r["payload"]) for r in got} == want and len(got) == len(want)
    assert all(r["page_id"] is None and r["payload_digest"] == digest(want[r["url"]]) and r["record_type"] == "response" for r in got)


def test_seeking_reads_the_same_records(spark, folder):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, folder)
    plain, sought = (sorted(map(str, warc.read_archives(spark, folder, seek=s).collect())) for s in (False, True))
    assert plain == sought and len(plain) == len(ROWS)
    assert "content" not in warc.read_archives(spark, folder, seek=True)._jdf.queryExecution().executedPlan().toString().split("binaryFile")[1].split("PushedFilters")[0]


def test_indexes_are_needed_and_checked():
    def made(members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n, b in members.items():
                z.writestr(n, b)
        return opened(out.getvalue())
    assert list(warc.entries(made({"other.txt": b"x"}))) == []
    for members in ({"archive/a.warc.gz": b"x"}, {"archive/a.warc.gz": b"x", "archive/b.warc.gz": b"y", "indexes/i.cdxj": b'k 1 {"offset": 0, "length": 1}'},
                    {"archive/a.warc.gz": b"x", "indexes/i.cdxj": b'k 1 {"offset": 1, "length": 1}'}, {"archive/a.warc.gz": b"x", "indexes/i.cdxj": b'k 1 {"offset": 0, "length": 1, "filename": "z.warc.gz"}'}):
        with pytest.raises(warc.ArchiveError):
            list(warc.entries(made(members)))
    assert list(warc.entries(made({"archive/a.warc": b"xyz", "indexes/i.cdx": b'k 1 {"offset": "1", "length": 2}\n'})))[0][1] == 2


def test_least_bytes_and_empty_table(spark, folder):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_archives(pages, folder, least_bytes=100)
    assert {r["record_type"] for r in warc.read_archives(spark, folder, payloads=False).collect()} == {"response"}
    warc.write_archives(pages.where("page_id < 0"), folder + "2")
    assert warc.read_archives(spark, folder + "2").count() == 0


def test_other_tools_read_the_archives(monkeypatch):
    data = zlib.compress(b"x")
    made = warc.archive([("u", data), ("v", b"abc")]) + warc.COMMENT
    with zipfile.ZipFile(io.BytesIO(made)) as z:
        assert z.testzip() is None and z.comment == warc.COMMENT
        assert z.read(warc.DATA) == data + b"abc"
        assert [i.compress_type for i in z.infolist()] == [zipfile.ZIP_STORED] * 2
    assert opened(made).range(warc.DATA, len(data), 3) == b"abc"


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_of_other_tools(zip64):
    rng, out = random.Random(1), io.BytesIO()
    files = {f"d/{i}é.bin": rng.randbytes(rng.randint(0, 5000)) for i in range(40)}
    with zipfile.ZipFile(out, "w") as z:
        for n, b in files.items():
            with z.open(zipfile.ZipInfo(n), "w", force_zip64=zip64) as f:
                f.write(b)
        z.comment = b"PK\x05\x06 a comment with a signature"
    z = opened(out.getvalue())
    assert sorted(z.members) == sorted(files)
    for n, b in files.items():
        assert z.place(n)[1] == len(b) and z.range(n, 0, len(b)) == b
        assert z.range(n, len(b) // 2, len(b) - len(b) // 2) == b[len(b) // 2:]


def test_more_members_than_16_bits():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(66_000):
            z.writestr(str(i), b"")
    assert len(opened(out.getvalue()).members) == 66_000


def test_broken_archives_are_refused():
    good = warc.archive([("u", zlib.compress(warc.record(1, "u", b"x", digest(b"x"), None)))]) + warc.COMMENT
    for bad in (b"", b"PK", good[:-30], good[5:], b"x" * 100):
        with pytest.raises(warc.ArchiveError):
            z = opened(bad)
            z.range(warc.DATA, 0, 1)
            list(warc.records(z))
    with pytest.raises(warc.ArchiveError):
        opened(good).range(warc.DATA, 0, 10**6)
    with pytest.raises(warc.ArchiveError):
        warc.parsed(warc.record(1, "u", b"x", digest(b"y"), None))
    deflated = io.BytesIO()
    with zipfile.ZipFile(deflated, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"a" * 100)
    with pytest.raises(warc.ArchiveError):
        opened(deflated.getvalue()).place("a")
