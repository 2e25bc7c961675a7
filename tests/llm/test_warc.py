import hashlib

import pytest

from guichet.llm import warc
from guichet.session import shared_folder

SAME = "<p>" + "équal " * 300 + "</p>\r\n"
QUOTED = "an archive:\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" * 3
ROWS = [
    (1, "http://a.example/", SAME),
    (2, "http://a.example/\r\nX: y", SAME),
    (5, None, SAME),
    (5, "http://b.example/é", SAME),
    (3, "", ""),
    (4, "u", None),
    (6, "u", "small"),
    (7, "u", "small"),
    (8, "u", QUOTED),
    (9, "u", "WARC/1.1\r\n" + "long 漢字\r\n" * 3000),
    (10, "u", "WARC/1.1\r\n" + "long 漢字\r\n" * 3000),
    (None, "u", SAME),
    (None, None, "\r\n\r\n"),
    (11, "u", "\x00\x01\r\n\r"),
]


def archived(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, value string, record string") if len(rows and rows[0]) == 5 else spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_folder(spark)
    warc.write_archives(df.repartition(3), path, key="page_id", url="url", payload="html", **options)
    return path


def expected(rows):
    payloads, out, once = {}, [], set()
    for key, _, html in rows:
        payloads.setdefault((html or "").encode(), []).append(-1 if key is None else key)
    for key, _, html in sorted(rows, key=repr):
        data = (html or "").encode()
        latest = max(payloads[data])
        number = -1 if key is None else key
        revisit = len(data) >= 1000 and (number < latest or data in once)
        if number == latest:
            once.add(data)
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", latest if revisit else None))
    return sorted(out, key=repr)


def rows_of(df):
    got = df.selectExpr("cast(key as long) key", "payload_bytes", "payload_digest", "record_type", "cast(refers_to as long) r").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("chunk_chars", [7, 100, 1 << 16])
def test_round_trip(spark, chunk_chars):
    path = archived(spark, ROWS, chunk_chars=chunk_chars)
    assert rows_of(warc.read_pages(spark, path)) == expected(ROWS)
    data = {}
    for r in warc.read_records(spark, path).filter("type != 'revisit'").orderBy("origin", "chunk").collect():
        data[r["origin"]] = data.get(r["origin"], b"") + bytes(r["data"])
    assert sorted(data.values()) == sorted([h.encode() for h in {SAME, ROWS[9][2], QUOTED, "\r\n\r\n", "\x00\x01\r\n\r"}] + [b"", b"", b"small", b"small"])


def test_archives_are_in_the_format(spark, tmp_path):
    import gzip
    import re

    path = archived(spark, ROWS, chunk_chars=1000)
    for file in sorted(__import__("pathlib").Path(path).glob("*.gz")):
        rest = gzip.decompress(file.read_bytes())
        while rest:
            assert rest.startswith(b"WARC/1.1\r\nWARC-Type: ")
            head, _, rest = rest.partition(b"\r\n\r\n")
            n = int(re.search(rb"Content-Length: (\d+)$", head).group(1))
            assert rest[n : n + 4] == b"\r\n\r\n"
            rest = rest[n + 4 :]


def test_splits_of_an_uncompressed_archive(spark, tmp_path):
    file = tmp_path / "one.warc"
    records = []
    for i in range(300):
        payload = (f"record {i}\r\n" * (i % 50)).encode()
        block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        sha1 = hashlib.sha1(payload).hexdigest().encode()
        head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nX-Record-Key: %d\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Type: application/http\r\nContent-Length: %d" % (i, i, sha1, len(block))
        records.append(head + b"\r\n\r\n" + block + b"\r\n\r\n")
    file.write_bytes(b"".join(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert warc.read_pages(spark, str(file)).select("key").distinct().count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damage_is_noticed(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" % hashlib.sha1(b"abc").hexdigest().encode()
    for i, bad in enumerate((good.replace(b"abc\r", b"abd\r"), good.replace(b"Length: 3", b"Length: 30"), good.replace(b"Length: 3", b"Length: 2"), good.replace(b"response", b"revisit"))):
        (tmp_path / f"{i}.warc").write_bytes(bad)
        with pytest.raises(Exception, match="differ|whole record|no such"):
            warc.read_pages(spark, str(tmp_path / f"{i}.warc")).collect()
    (tmp_path / "good.warc").write_bytes(good)
    assert warc.read_pages(spark, str(tmp_path / "good.warc")).count() == 1


def test_no_rows_and_other_columns(spark):
    assert warc.read_pages(spark, archived(spark, [(1, "u", "x", "clash", "clash")])).count() == 1
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = shared_folder(spark)
    warc.write_archives(df, path, key="page_id", url="url", payload="html")
    assert warc.read_pages(spark, path).count() == 0
