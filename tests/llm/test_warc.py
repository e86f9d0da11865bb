import gzip
import hashlib
import random

import pytest

from smelter.llm import warc
from smelter.session import scratch_dir

SCHEMA = "page_id long, url string, html string, record int, chunk string, digest long, page string, last int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, "p", 3) for r in rows], SCHEMA)


def plain(rows):
    """(page_id, bytes, digest, type, refers_to) by definition."""
    data = [(i, (t or "").encode()) for i, _, t in rows]
    out = []
    for i, d in data:
        ids = sorted((x is None, x or 0) for x, e in data if e == d)
        least = None if ids[0][0] else ids[0][1]
        first = len(d) < 100 or i == least
        out.append((i, len(d), hashlib.sha256(d).hexdigest(), "response" if first else "revisit", None if first else least))
    return out


def result(spark, pages, size=warc.CHUNK_BYTES):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(pages, path, size=size)
    found = warc.read_records(spark, path, size=size).collect()
    assert all(r.intact for r in found)
    return sorted((tuple(r)[:5] for r in found), key=str), path


def rows():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("ab é漢🙂<>\n\r") for _ in range(n))
    body = text(300)
    trap = "x" * 90 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    out = [(1, "http://a/1", body), (2, "http://a/2", body), (3, None, body), (4, "http://a b\r\n/", None), (5, "u", ""),
           (6, "u", "y" * 99), (7, "u", "y" * 99), (8, "u", "z" * 100), (9, "u", "z" * 100), (10, "u", trap), (11, "u", trap * 40),
           (12, "u", text(5000)), (0, "u", trap), (None, "u", "w" * 200), (20, "u", "w" * 200), (None, None, None),
           (21, "u", "\r\n\r\n"), (22, "u", "\n" * 150), (23, "u", "\r" * 128), (24, "u", "é" * 64)]
    return out + [(100 + i, "u", text(rng.randrange(0, 700))) for i in range(60)]


@pytest.mark.parametrize("size", [64, warc.CHUNK_BYTES])
def test_pages_come_back(spark, size):
    got, _ = result(spark, frame(spark, rows()).repartition(3), size)
    assert got == sorted(plain(rows()), key=str)


def test_repeated_rows(spark):
    pages = frame(spark, [(7, "u", "q" * 150)] * 500 + [(9, "u", "q" * 150)] * 3 + [(7, "u", "short")] * 2)
    got, _ = result(spark, pages.repartition(4))
    digest = hashlib.sha256(b"q" * 150).hexdigest()
    assert got.count((7, 150, digest, "response", None)) == 1
    assert got.count((7, 150, digest, "revisit", 7)) == 499 and got.count((9, 150, digest, "revisit", 7)) == 3
    assert sum(r[3] == "response" and r[1] == 5 for r in got) == 2 and len(got) == 505


def test_no_pages(spark):
    assert result(spark, frame(spark, []))[0] == []


def test_chunks_are_small_and_carry_running_digests(spark):
    text = "0123456789" * 1000
    table = warc.chunk_table(frame(spark, [(1, "u", text), (2, "u", "")]), size=700).orderBy("page", "chunk").collect()
    mine = [r for r in table if r.page == 1]
    assert len(mine) == 15 and max(len(r.body) for r in table) == 700 and [r.last for r in mine] == [False] * 14 + [True]
    for r in mine:
        assert r.digest == hashlib.sha256(text.encode()[:r.end]).hexdigest()
    assert [(r.end, r.last, bytes(r.body)) for r in table if r.page == 2] == [(0, True, b"")]


def test_archives_are_valid_and_revisits_hold_no_payload(spark):
    pages = frame(spark, [(i, f"http://h/{i}", "same " * 100) for i in range(5)] + [(9, "u", "k" * 3000)])
    _, path = result(spark, pages, size=1000)
    spark_files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    types, numbers = [], []
    for name in spark_files:
        data = gzip.open(name.removeprefix("file:"), "rb").read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n:n + 4] == b"\r\n\r\n" and fields[b"WARC-Record-ID"]
            if fields[b"WARC-Type"] == b"revisit":
                assert n == len(warc.HTTP_HEAD)
            types.append(fields[b"WARC-Type"].decode())
            numbers.append(int(fields.get(b"WARC-Segment-Number", 0)))
            data = rest[n + 4:]
    assert sorted(types) == ["continuation"] * 2 + ["response"] * 2 + ["revisit"] * 4 and sorted(numbers)[-3:] == [1, 2, 3]


def write_plain(spark, texts):
    path = scratch_dir(spark, "warc-other")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    return path


def test_other_archives(spark):
    """Plain files, other record types, a large record in one segment, and a
    segmented one whose parts stand out of order in two files."""
    rec = lambda kind, rid, body, *more: "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in (
        ("WARC-Type", kind), ("warc-record-id", rid), ("Content-Type", "application/http; msgtype=response"), *more, ("Content-Length", len(body.encode())))) + "\r\n" + body
    head, big = "HTTP/1.1 200 OK\r\nA: b\r\n\r\n", "line\né" * 50000
    parts = [head + "p" * 100, "q" * 100, "r" * 10]
    one = write_plain(spark, [rec("warcinfo", "<i>", "software: x\r\n"), rec("response", "<big>", head + big, ("X-Page-Id", 1)),
                              rec("continuation", "<s3>", parts[2], ("WARC-Segment-Origin-ID", "<s>"), ("WARC-Segment-Number", 3), ("WARC-Segment-Total-Length", 1)),
                              rec("response", "<s>", parts[0], ("WARC-Segment-Number", 1), ("X-Page-Id", 2))])
    two = write_plain(spark, [rec("continuation", "<s2>", parts[1], ("WARC-Segment-Origin-ID", "<s>"), ("WARC-Segment-Number", 2))])
    got = sorted(tuple(r) for r in warc.read_records(spark, [one, two], size=1000).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [(1, len(big.encode()), sha(big), "response", None, True),
                   (2, 210, sha("p" * 100 + "q" * 100 + "r" * 10), "response", None, True)]
    chunks = warc.read_chunks(spark, one, size=1000).where("origin = '<big>'").orderBy("number", "part").collect()
    assert max(len(r.body) for r in chunks) <= 1000 and b"".join(bytes(r.body) for r in chunks) == big.encode()


def test_damage_is_noticed(spark):
    bad = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: 3\r\n\r\nabc"
    assert [r.intact for r in warc.read_records(spark, write_plain(spark, [bad])).collect()] == [False]
    with pytest.raises(Exception, match="within a record|not closed"):
        warc.read_records(spark, write_plain(spark, [bad.replace("Length: 3", "Length: 300")])).collect()
