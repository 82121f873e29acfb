"""Archives against hashlib and base64, read back by the operator and by a plain parser."""

import base64
import glob
import gzip
import hashlib
import random

import pytest

from starkit.llm import warc
from starkit.sources.export import run_folder

SCHEMA = "page_id long, url string, html string, id string, length long, key string"
DATE = "2026-01-01T00:00:00Z"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    bodies = [None, "", "x", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>", "\r\n\r\n", "tail\r\n", "long " * 300_000] + [f"page {i}" for i in range(8)]
    out = [(i, r.choice([None, f"http://h/{i % 7}", "http://h/a b\r\nWARC-Type: x"]), r.choice(bodies), "a", 1, "k") for i in r.sample(range(500), 120)]
    out += [(1000 + i, "http://copy/", "one of many", None, None, None) for i in range(60)]
    return out + [out[0]] * 15 + [(None, None, "no id", None, None, None), (None, None, "page 1", None, None, None)]


def brute(rows, least=0):
    out, groups = [], {}
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r[0])
    for body, ids in groups.items():
        ids.sort(key=lambda x: (x is None, x or 0))
        for k, i in enumerate(ids):
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            again = k > 0 and len(body) >= least
            out.append((i, len(body), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def result(df):
    number = lambda x: None if x is None else int(x)
    return sorted(((number(r.id), r.length, r.digest, r.record_type, number(r.refers_to_id)) for r in df.collect()), key=str)


@pytest.mark.parametrize("least,hot", [(0, 100_000), (0, 10), (6, 100_000), (10**9, 5)])
def test_archives(spark, rows, monkeypatch, least, hot):
    monkeypatch.setattr(warc, "HOT", hot)
    monkeypatch.setattr(warc, "COPIES", 4)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(warc.archived(pages, "page_id", "url", "html", DATE, least)) == brute(rows, least)


def test_files_are_archives(spark, rows):
    """Read without the operator: every record, each payload once, names that lead to responses."""
    path = run_folder(spark, "warc-test")
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    warc.write_archives(pages.selectExpr("page_id AS id", "url", "html AS payload"), path, DATE)
    records, files = [], glob.glob(f"{path}/*/*.gz")
    for f in files:
        data = gzip.open(f).read()
        while data:
            head, data = data.split(b"\r\n\r\n", 1)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and data[n:n + 4] == b"\r\n\r\n"
            records.append((fields, data[:n].split(b"\r\n\r\n", 1)[1]))
            data = data[n + 4:]
    assert len(records) == len(rows) and len({f["WARC-Record-ID"] for f, _ in records}) == len(rows)
    responses = {f["WARC-Record-ID"]: (f, body) for f, body in records if f["WARC-Type"] == "response"}
    assert sorted(body for _, body in responses.values()) == sorted({(r[2] or "").encode() for r in rows})
    for f, body in records:
        if f["WARC-Type"] == "revisit":
            first = responses[f["WARC-Refers-To"]][0]
            assert not body and f["WARC-Payload-Digest"] == first["WARC-Payload-Digest"] and f["WARC-Profile"] == warc.IDENTICAL
            assert f.get("WARC-Refers-To-Target-URI") == first.get("WARC-Target-URI")
    read = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, path, payloads=True).filter("record_type = 'response'").collect()}
    assert read == {k: body for k, (_, body) in responses.items()}


def test_small_files(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 17)
    path = run_folder(spark, "warc-test")
    pages = spark.createDataFrame([r for r in rows if len(r[2] or "") < 100] * 40, SCHEMA).coalesce(1)
    warc.write_archives(pages.selectExpr("cast(null as long) AS id", "concat(url, uuid()) AS url", "concat(html, page_id) AS payload"), path, DATE)
    assert warc.read_archives(spark, path).count() == 40 * sum(len(r[2] or "") < 100 for r in rows)


def test_damage_is_seen(spark, tmp_path):
    text = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    for k, (n, message) in enumerate(((22, "does not have its digest"), (20, "does not end where"), (99, "bytes early"))):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "a.gz").write_bytes(gzip.compress(text.format(n).encode()))
        with pytest.raises(Exception, match=message):
            warc.read_archives(spark, str(tmp_path / str(k))).count()


def test_members_and_empty_table(spark, tmp_path):
    record = lambda i: f"WARC/1.0\r\nWARC-Type: revisit\r\nwarc-record-id: <{i}>\r\nWARC-Payload-Digest: sha1:A\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    (tmp_path / "a.gz").write_bytes(b"".join(gzip.compress(record(i).encode()) for i in range(3000)))
    assert {r.record_id for r in warc.read_archives(spark, str(tmp_path)).collect()} == {f"<{i}>" for i in range(3000)}
    assert warc.archived(spark.createDataFrame([], SCHEMA), "page_id", "url", "html", DATE).count() == 0
