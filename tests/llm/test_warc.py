import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from listwell.llm.queries import op8_warc_transactions
from listwell.llm.warc import archived_pages, assemble, parse_warc, read_warc, write_captures

SF = "/root/testdata/sf0.01"


def brute(rows, min_bytes=0):
    by = defaultdict(list)
    for i, html in rows:
        by[(html or "").encode()].append(i)
    out = set()
    for raw, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for i in ids:
            revisit = len(raw) >= min_bytes and i != max(ids)
            out.add((i, len(raw), digest, "revisit" if revisit else "response", max(ids) if revisit else None))
    return out


def test_query_round_trip(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = op8_warc_transactions(spark, SF).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == brute(rows) and len(got) == len(rows)


ROWS = [(1, "http://a/x", "p\r\n\r\nWARC/1.1\r\nq"), (2, "http://b", "same"), (7, "http://c?q", "same"), (5, None, None), (6, "", ""), (8, "u\r\nWARC-Type: x", "é" * 70_000), (-3, "x", "\r\n\r\n")]


@pytest.mark.parametrize("min_bytes,compression", [(0, "none"), (3, "gzip")])
def test_edges(spark, tmp_path, min_bytes, compression):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as digest")
    got = archived_pages(df, min_bytes=min_bytes, path=str(tmp_path / "w")).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == brute([(i, h) for i, _, h in ROWS], min_bytes)
    assert all(r.digest_ok and r.n_records == 3 and r.request_uri is not None for r in got)
    write_captures(df, str(tmp_path / "p"), compression=compression)
    captures = {int(r.capture.split(":")[3]): r for r in assemble(read_warc(spark, str(tmp_path / "p"))).collect()}
    assert bytes(captures[1].mains[0].payload) == ROWS[0][2].encode() and [len(captures[1][k]) for k in ("mains", "requests", "metadata", "others")] == [1, 1, 1, 0]
    assert captures[8].requests[0].target_uri == "uWARC-Type: x"
    assert archived_pages(df.limit(0)).count() == 0
    nulls = archived_pages(df.selectExpr("cast(null as long) as page_id", "url", "html")).collect()
    assert len(nulls) == len(ROWS) and all(r.page_id is None and r.record_type == "response" and r.digest_ok for r in nulls)


def test_repeated_ids_and_small_archives(spark, tmp_path):
    """An id may stand for several payloads, a row may repeat; archives are cut at a size."""
    rows = [(1, "u", "one"), (1, "u", "two"), (2, "u", "one"), (3, "v", "three"), (3, "v", "three"), (None, "w", "one")] + [(100 + i, "x", str(i) * 3000) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = archived_pages(df, path=str(tmp_path / "w"), archive_bytes=100_000).collect()
    key = lambda r: (r.page_id, r.record_type, r.refers_to, r.payload_bytes)
    assert {key(r) for r in got if (r.page_id or 0) < 100} == {(1, "revisit", 2, 3), (1, "response", None, 3), (2, "response", None, 3), (3, "response", None, 5), (None, "revisit", 2, 3)}
    assert len(got) == len(rows) and all(r.digest_ok for r in got) and sum(r.page_id == 3 for r in got) == 2
    assert len(list((tmp_path / "w").glob("part-*"))) > 5


def test_parser():
    one = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r["payload"] for r in parse_warc(gzip.compress(one) + gzip.compress(one))] == [b"abc", b"abc"]
    assert list(parse_warc(b"")) == []
    for bad in (one[:-6], b"junk\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse_warc(bad))


def test_records_are_joined_in_either_direction(spark):
    """Named by the response, naming it, or reached through a record that does; the rest stand alone."""
    rows = [
        ("response", "m", ["q"]), ("request", "q", None), ("metadata", "d", ["m", "q"]), ("metadata", "d2", ["q"]), ("warcinfo", "i", ["m"]),
        ("request", "lost", ["none"]), ("resource", "r", None), ("request", None, None), ("request", None, ["m"]), (None, "odd", None),
    ]
    df = spark.createDataFrame(rows, "warc_type string, record_id string, concurrent_to array<string>")
    ids = lambda r: tuple(sorted(str(x.record_id) for x in r))
    got = sorted((str(r.capture), ids(r.mains), ids(r.requests), ids(r.metadata), ids(r.others)) for r in assemble(df).collect())
    assert got == sorted([("m", ("m",), ("q",), ("d", "d2"), ("i",)), ("lost", (), ("lost",), (), ()), ("r", ("r",), (), (), ()), ("None", (), ("None",), (), ()), ("None", (), ("None",), (), ()), ("odd", (), (), (), ("odd",))])
    assert assemble(df.limit(0)).count() == 0


def test_repeated_concurrent_fields_are_all_kept():
    raw = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    assert [r["concurrent_to"] for r in parse_warc(raw)] == [["<a>", "<b>"]]
