import hashlib

import pytest
import zstandard

from assocframe.llm import warc as W
from assocframe.llm.common import new_folder
from assocframe.llm.queries import ORACLES
from assocframe.plans.materialize import materialize

LONG = "<p>" + "long page " * 200


def pages(spark):
    rows = [
        (1, "http://a/1", LONG), (7, "http://a/7", LONG), (7, "http://a/7", LONG), (3, None, LONG), (None, "x", LONG),
        (4, "http://a/4", "short"), (5, "http://a/5", "short"), (6, "u\r\nWARC-Type: bad", None), (8, "", ""),
        (9, "http://é/", "é" * 600), (10, "http://é/", "é" * 600), (11, "v", "z" * 3_000_000), (None, "n", "only null " * 200),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_round_trip_and_revisits(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 4_000)
    given = pages(spark)
    folder, written = W.write_archives(given)
    assert sum(r["records"] for r in written.collect()) == given.count()
    rows = W.read_archives(spark, folder, payload=True).collect()
    assert len(rows) == given.count()
    html = {(r["page_id"], (r["html"] or "")) for r in given.collect()}
    by_id = {}
    for r in rows:
        by_id.setdefault(r["page_id"], []).append(r)
        if r["record_type"] == "response":
            text = bytes(r["payload"]).decode()
            assert (r["page_id"], text) in html and r["refers_to"] is None
            assert r["payload_digest"] == hashlib.sha1(text.encode()).hexdigest()
        assert r["payload_bytes"] in {len(t.encode()) for p, t in html if p == r["page_id"]}
    kinds = lambda k: sorted((r["record_type"], r["refers_to"]) for r in by_id[k])
    assert kinds(7) == [("response", None)] * 2
    assert kinds(1) == kinds(3) == [("revisit", 7)] and kinds(9) == [("revisit", 10)]
    assert kinds(4) == kinds(5) == kinds(6) == kinds(8) == kinds(10) == [("response", None)]
    assert sorted(r["record_type"] for r in by_id[None]) == ["response", "revisit"]


def test_oracle_on_copies(spark):
    """The check SQL on a table that has copies."""
    import duckdb

    given = pages(spark).filter("page_id is not null").dropDuplicates(["page_id"])
    folder, written = W.write_archives(given)
    written.count()
    got = sorted(tuple(r) for r in W.read_archives(spark, folder).collect())
    pages_table = given.toArrow()  # noqa: F841
    con = duckdb.connect()
    con.register("pages", pages_table)
    assert got == sorted(con.sql(ORACLES["op9_warc_zstd"]).fetchall())
    assert any(r[3] == "revisit" for r in got)


def archive(dictionary=b""):
    writer = W.ArchiveWriter(dictionary)
    for i, p in enumerate((b"", b"\r\n\r\n", b"x" * 5000)):
        writer.add(W.make_record(i, "http://x", p, hashlib.sha1(p).hexdigest(), None))
    return writer.close()


@pytest.mark.parametrize("size", [0, 30_000])
def test_frames(size):
    samples = [f"record {i} with words {i * i} ".encode() * 20 for i in range(500)]
    dictionary = W.train_dictionary(samples) if size else b""
    assert bool(dictionary) == bool(size)
    data = archive(dictionary)
    assert [len(r["payload"]) for r in W.read_archive(data)] == [0, 4, 5000]
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    for broken in (b"", data[:-1], data[4:], data[: len(data) - 30], data[:-9] + b"123456789"):
        with pytest.raises((W.BadArchive, zstandard.ZstdError)):
            list(W.read_archive(broken))


def test_bad_records_are_refused():
    good = W.make_record(1, "http://x", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert W.parse_record(good)["payload"] == b"abc"
    for old, new in (
        (b"WARC/1.1", b"WARC/9"), (b"Content-Length: 3", b"Content-Length: 4"), (b"abc", b"abd"),
        (b"response", b"unheard"), (b"Content-Type", b"WARC-Type"), (b"urn:page:1", b"urn:uuid:1"), (b"X-Payload", b"Y-Payload"),
    ):
        with pytest.raises(W.BadArchive):
            W.parse_record(good.replace(old, new, 1) if old != b"abc" else good.replace(old, new))


def test_empty_table(spark):
    folder, written = W.write_archives(pages(spark).limit(0))
    assert written.count() == 0
    assert W.read_archives(spark, folder).isEmpty()


def test_files_of_lost_attempts_are_not_read(spark, monkeypatch):
    """Two runs into one folder, with other orders of rows: each manifest gives each record once."""
    monkeypatch.setattr(W, "FILE_BYTES", 4_000)
    given, folder = pages(spark), new_folder(spark, "warc-test")
    runs = [materialize(W.write_archives(df, folder)[1]) for df in (given, given.orderBy("url").repartition(3))]
    rows = [sorted(map(tuple, W.read_archives(spark, folder, manifest=m).collect()), key=repr) for m in runs]
    assert rows[0] == rows[1] and len(rows[0]) == given.count()
    assert W.read_archives(spark, folder).count() == 2 * given.count()
