from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import pytest

import compare
from conftest import MEDIUM
from riskflow.llm import warc
from riskflow.llm.queries import queries
from riskflow.llm.sql import oracle_sql
from riskflow.llm.warc import Members, archived_pages, read_archives, read_record, record, write_archives


def read_all(data, chunk=7, with_payload=True):
    members, found = Members(io.BytesIO(data), chunk), []
    while members.open_next():
        found.append(read_record(members, with_payload))
    return found


def member(*args, **kwargs):
    return zlib.compress(record(*args, **kwargs), 4, wbits=31)


def test_query_equals_sql(spark):
    connection = compare.oracle(MEDIUM)
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{MEDIUM}/pages.parquet'")
    result = queries()["op9_warc"](spark, MEDIUM).toArrow()
    assert compare.differences(result, connection.sql(oracle_sql()["op9_warc"]).to_arrow_table()) == []


@pytest.mark.parametrize("chunk", [1, 7, 65536])
def test_records_come_back(chunk):
    payloads = [b"", b"\r\n\r\n", b"WARC/1.1\r\n" * 50, bytes(range(256)) * 300]
    data = b"".join(member(i, "http://x/ y\n", p) for i, p in enumerate(payloads))
    found = read_all(data, chunk)
    assert [r.payload for r in found] == payloads
    assert [r.page("warc-record-id") for r in found] == ["0", "1", "2", "3"]
    assert all(not r.faults and r.payload_digest == hashlib.sha1(p).hexdigest() for r, p in zip(found, payloads))
    assert found[0].fields["warc-target-uri"] == "http://x/ y"


def test_members_are_ordinary_gzip():
    assert gzip.decompress(member(1, "u", b"a") + member(2, "v", b"b")) == record(1, "u", b"a") + record(2, "v", b"b")


def test_revisit_names_its_response():
    (found,) = read_all(member(3, "u", b"same" * 500, 9, True))
    assert found.page("warc-refers-to") == "9" and found.payload == b"" and not found.faults
    assert found.payload_digest == hashlib.sha1(b"same" * 500).hexdigest()


def test_damage_is_seen():
    plain = record(1, "u", b"payload")
    changed = zlib.compress(plain.replace(b"payload", b"pAyload"), wbits=31)
    assert read_all(changed)[0].faults == ["block digest", "payload digest"]
    assert read_all(zlib.compress(plain + b"x", wbits=31))[0].faults == ["end"]
    with pytest.raises(ValueError, match="within a member"):
        read_all(member(1, "u", b"payload" * 99)[:-20])
    with pytest.raises(ValueError, match="shorter"):
        read_all(zlib.compress(plain[:-12], wbits=31))
    with pytest.raises(ValueError, match="not a WARC"):
        read_all(zlib.compress(b"HTTP/1.1\r\n\r\n", wbits=31))
    with pytest.raises(ValueError, match="no end"):
        read_all(zlib.compress(b"WARC/1.1", wbits=31))


PAGES = [
    (1, "u1", "A" * 1000), (2, "u2", "A" * 1000), (7, None, "A" * 1000), (3, "u", "A" * 999), (4, "u", "A" * 999),
    (5, "u", None), (6, "u", ""), (8, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "é" * 499), (11, "u", "z" * 400_000),
    (None, "u", "A" * 1000), (9, "u", "é" * 500),
]


def test_edge_cases(spark):
    pages = spark.createDataFrame([(*p, 0, "z") for p in PAGES], "page_id long, url string, html string, digest int, payload string")
    rows = archived_pages(pages).collect()
    assert len(rows) == len(PAGES) and all(r.verified for r in rows)
    refers = {r.page_id: r.refers_to for r in rows}
    assert refers == {1: 7, 2: 7, 7: None, 3: None, 4: None, 5: None, 6: None, 8: 9, 9: None, 10: None, 11: None, None: 7}
    sizes = {p[0]: len((p[2] or "").encode()) for p in PAGES}
    assert all(r.payload_bytes == sizes[r.page_id] for r in rows)
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in rows)
    assert archived_pages(pages.limit(0)).count() == 0


def test_archives_roll_over_and_hold_whole_payloads(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    manifest = write_archives(pages, str(tmp_path / "archives"), archive_bytes=500)
    assert manifest.count() > 2
    got = {(r.page_id, bytes(r.payload)) for r in read_archives(manifest).filter("record_type = 'response'").collect()}
    assert got == {(str(i), (h or "").encode()) for i, _, h in PAGES if i not in (1, 2, 8, None)}


def test_missing_record_stops_the_job(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:1], "page_id long, url string, html string")
    manifest = write_archives(pages, str(tmp_path / "archives")).selectExpr("path", "records + 1 AS records")
    with pytest.raises(Exception, match="records instead of"):
        read_archives(manifest).collect()
    assert warc.REVISIT_BYTES == 1000
