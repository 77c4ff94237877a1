import gzip
import hashlib
import io
import random

import pyarrow.fs as pafs
import pytest

from storelake.llm import warc
from storelake.llm.shared import ship_package

PAGES = "page_id long, url string, html string"


def expected(rows, least=1000):
    out = []
    for page, html in rows:
        body = (html or "").encode()
        same = [p for p, h in rows if (h or "").encode() == body and p is not None]
        revisit = len(body) >= least and page is not None and page < max(same)
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    max(same) if revisit else None))
    return sorted(out, key=str)


def test_pages_come_back(spark):
    ship_package(spark)
    big = "<p>WARC/1.1\r\n\r\né</p>" * 200
    rows = [(1, big), (2, big), (9, big), (9, big), (3, "tiny"), (4, "tiny"), (5, None), (6, ""), (None, big), (None, "x"),
            (7, "long " * 400_000), (8, "a" * 1000), (10, "a" * 1000), (11, "a" * 999), (12, "a" * 999)]
    pages = spark.createDataFrame([(p, f"http://a.b/{p}\r\nx", h) for p, h in rows], PAGES).repartition(3)
    wide = pages.selectExpr("*", "'x' AS digest", "1 AS payload", "2 AS refers_to", "3 AS bytes")
    assert sorted(map(tuple, warc.archived_pages(wide).collect()), key=str) == expected(rows)
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).collect() == []
    assert len(warc.archived_pages(pages.drop("url")).collect()) == len(rows)


def archive(n, packed=True):
    out = []
    for i in range(n):
        body = (f"page {i} " * (i + 1)).encode()
        record = warc.format_record(i, f"u{i}", body, hashlib.sha1(body).hexdigest(), None, False)
        out.append(gzip.compress(record) if packed else record)
    return out


def salvaged(data):
    found = list(warc.salvage(io.BytesIO(data)))
    at = 0
    for _, start, end, _ in found:  # Every byte is accounted for, once.
        assert start == at < end
        at = end
    assert at == len(data)
    ids = [int(w["fields"]["warc-record-id"][10:-1]) for k, _, _, w in found if k == "record"]
    return ids, [(s, e) for k, s, e, _ in found if k == "gap"]


def test_salvage_members_and_version_lines():
    for packed in (True, False):
        parts = archive(9, packed)
        starts = [sum(map(len, parts[:i])) for i in range(10)]
        whole = b"".join(parts)
        assert salvaged(whole) == (list(range(9)), [])
        broken = bytearray(whole)
        broken[starts[4] + len(parts[4]) // 2] ^= 0xFF
        assert salvaged(bytes(broken)) == ([0, 1, 2, 3, 5, 6, 7, 8], [(starts[4], starts[5])])
        assert salvaged(whole[:starts[8] + 5]) == (list(range(8)), [(starts[8], starts[8] + 5)])
        assert salvaged(whole[:starts[3]] + whole[starts[3] + 9:])[0] == [0, 1, 2, 4, 5, 6, 7, 8]
        junk = b"\x1f\x8b\x08 junk WARC/1.1\r\nContent-Length: 99999999999999\r\n\r\n"
        assert salvaged(whole[:starts[2]] + junk + whole[starts[2]:]) == (list(range(9)), [(starts[2], starts[2] + len(junk))])
    mixed = archive(3)[0] + archive(3, False)[1] + b"??" + archive(3)[2]
    assert salvaged(mixed)[0] == [0, 1, 2]
    assert salvaged(b"") == ([], []) and salvaged(b"no archive")[1] == [(0, 10)]


def test_random_damage_loses_only_damaged_records():
    pick = random.Random(8)
    parts = archive(30)
    starts = [sum(map(len, parts[:i])) for i in range(31)]
    for _ in range(60):
        data = bytearray(b"".join(parts))
        hit = set()
        for _ in range(pick.randrange(1, 5)):
            at = pick.randrange(len(data))
            data[at] ^= 1 << pick.randrange(8)
            hit.add(max(i for i in range(30) if starts[i] <= at))
        ids = salvaged(bytes(data))[0]
        assert set(range(30)) - hit <= set(ids)


def test_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 16)
    data = b"".join(archive(8)) + b"x" * 50 + b"".join(archive(4, False))
    assert salvaged(data)[0] == [*range(8), *range(4)]


def test_damage_is_searched_without_holding_the_file(monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 64)
    most = [0]
    read = warc.Source.get
    def watched(self, at, size):
        out = read(self, at, size)
        most[0] = max(most[0], len(self.held))
        return out
    monkeypatch.setattr(warc.Source, "get", watched)
    parts = archive(40, False)
    data = bytearray(b"".join(parts))
    data[len(parts[0]) - 8] ^= 0xFF
    data[len(parts[0]):len(parts[0])] = b"WARC/1.1\r\nContent-Length: 999999\r\n\r\n" * 20
    assert salvaged(bytes(data))[0] == list(range(1, 40)) and most[0] <= 4096


def test_odd_numbers_in_headers_end_no_reader():
    for number in ("\u00b2", "9" * 5000, "-1", ""):
        assert warc._number(number) is None
        record = warc.format_record(1, "u", b"", "0" * 40, 2, True).replace(b"X-Payload-Length: 0", f"X-Payload-Length: {number}".encode())
        assert salvaged(record)[0] == [1]
        broken = archive(1, False)[0].replace(b"Content-Length:", f"Content-Length: {number}x".encode())
        assert salvaged(broken + archive(2)[1])[0] == [1]


def test_long_members_come_back(monkeypatch):
    body = bytes(5_000_000)
    record = gzip.compress(warc.format_record(3, "u", body, hashlib.sha1(body).hexdigest(), None, False))
    (found,) = warc.salvage(io.BytesIO(record), keep=False)
    assert found[3]["bytes"] == len(body) and found[3]["payload"] is None and found[3]["digest"] == hashlib.sha1(body).hexdigest()
    monkeypatch.setattr(warc, "PAYLOAD_LIMIT", 1000)
    (found,) = warc.salvage(io.BytesIO(record))
    assert found[0] == "record" and found[3]["payload"] is None and found[3]["bytes"] == len(body)


def test_a_lost_record_is_an_error(spark, tmp_path):
    ship_package(spark)
    folder = f"file://{tmp_path}/strict"
    listed = warc.write_archives(spark.createDataFrame([(i, "u", f"{i} " * 300) for i in range(9)], PAGES).coalesce(1), folder)
    assert warc.read_archives(listed, folder, whole=True)[0].count() == 9
    with pytest.raises(Exception, match="9 records, 8 were written"):
        warc.read_archives(listed.selectExpr("path", "8 AS records"), folder, whole=True)[0].collect()
    (path,) = [r.path for r in listed.collect()]
    with open(f"{tmp_path}/strict/{path}", "r+b") as out:
        out.seek(60)
        out.write(b"????")
    with pytest.raises(Exception, match="damage from"):
        warc.read_archives(listed, folder, whole=True)[0].collect()
    assert warc.read_archives(listed, folder)[0].count() == 8


def test_gaps_are_logged_from_damaged_files(spark, tmp_path):
    ship_package(spark)
    folder = f"file://{tmp_path}/archives"
    pages = spark.createDataFrame([(i, None, f"page {i} " * 300) for i in range(40)], PAGES).coalesce(1)
    listed = warc.write_archives(pages, folder)
    (path,) = [r.path for r in listed.collect()]
    files = pafs.LocalFileSystem()
    with files.open_input_stream(f"{tmp_path}/archives/{path}", compression=None) as stream:
        data = bytearray(stream.read())
    start, end = [(s, e) for _, s, e, _ in warc.salvage(io.BytesIO(bytes(data)))][20]
    data[(start + end) // 2] ^= 0xFF
    with files.open_output_stream(f"{tmp_path}/archives/{path}", compression=None) as out:
        out.write(bytes(data))
    records, gaps = warc.read_archives(listed, folder)
    assert records.count() == 39
    (gap,) = gaps.collect()
    assert (gap.path, gap.start, gap.end) == (path, start, end)


def test_files_are_closed_at_their_size(spark, tmp_path):
    ship_package(spark)
    pages = spark.createDataFrame([(i, "u", f"{i} " * 500) for i in range(50)], PAGES).coalesce(1)
    listed = warc.write_archives(pages, f"file://{tmp_path}/small", file_bytes=1000)
    rows = listed.collect()
    assert len(rows) > 3 and sum(r.records for r in rows) == 50
