from __future__ import annotations

import base64
import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tierfold.llm import archive as archive_module
from tierfold.llm import queries
from tierfold.llm.archive import archived_pages, read_warc, records_of, store_warc, write_warc
from tierfold.llm.quotes import latest_before, reply_ordered

PAGE = "page_id long, url string, html string, payload string, file string"


@pytest.fixture(scope="module")
def pages(spark):
    data = [
        (1, "http://a/", "<p>é</p>", "x", "y"), (2, "http://b/", "<p>é</p>", "x", "y"),
        (3, "http://c/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\nb", "x", "y"), (4, None, None, "x", "y"),
        (5, "http://d/", "", "x", "y"), (None, "http://e/", "<p>é</p>", "x", "y"),
        (2, "http://b/", "<p>é</p>", "x", "y"), (6, "http://f/", "z" * 3_000_000, "x", "y"),
    ]
    return spark.createDataFrame(data, PAGE).repartition(3)


def test_archive_round_trip(pages):
    archive = archived_pages(pages)
    found = archive.reconstructed().collect()
    assert archive.payloads.count() == 4  # each payload once
    texts = {(r["page_id"], r["url"]): r["html"] or "" for r in pages.collect()}
    assert len(found) == 8
    for r in found:
        payload = bytes(r["payload"])
        url = r["url"].replace("%0D%0A", "\r\n") if r["url"] else None
        assert payload == texts[r["page_id"], url].encode()
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        [(header, again)] = records_of(bytes(r["record"]))
        assert (header, again) == (bytes(r["header"]), payload)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found)
    assert kinds == [
        (0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "revisit", 2),
        (3, "response", None), (4, "revisit", 5), (5, "response", None), (6, "response", None),
    ]


def test_empty_table_and_damage(spark, pages, tmp_path):
    assert archived_pages(pages.limit(0)).reconstructed().count() == 0
    write_warc(pages.filter("page_id = 1"), str(tmp_path / "warc"))
    for file in (tmp_path / "warc").glob("part-*"):
        text = gzip.decompress(file.read_bytes())
        if text:
            file.write_bytes(gzip.compress(text.replace("é".encode(), "è".encode())))
            (tmp_path / "warc" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="payload digest"):
        read_warc(spark, str(tmp_path / "warc")).collect()
    with pytest.raises(ValueError, match="Content-Length"):
        list(records_of(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nab\r\n\r\n"))


def test_stored_payload_is_verified(spark, pages, tmp_path):
    write_warc(pages.filter("page_id = 1"), str(tmp_path / "warc"))
    archive = store_warc(spark, str(tmp_path / "warc"))
    changed = archive.payloads.withColumn("payload", F.lit(b"other"))
    with pytest.raises(Exception, match="does not match its digest"):
        type(archive)(archive.headers, changed).reconstructed().collect()


def test_records_of_a_hot_payload_are_rebuilt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(archive_module, "PART_RECORDS", 10)
    data = [(i, f"u{i}", "same" * 50) for i in range(95)] + [(i, f"u{i}", f"p{i}") for i in range(95, 130)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    archive = archived_pages(pages)
    assert archive.payloads.count() == 36 and archive.payloads.agg(F.max("parts")).first()[0] == 10
    assert archive.headers.select("sha256", "part").distinct().count() > 40
    found = {r["page_id"]: r for r in archive.reconstructed().collect()}
    assert len(found) == 130
    for page, url, html in data:
        r = found[page]
        assert (r["url"], bytes(r["payload"])) == (url, html.encode())
        assert r["refers_to"] == (94 if page < 94 else None)
        assert bytes(r["record"]).endswith(html.encode() + b"\r\n\r\n")


@pytest.mark.parametrize("slots", [0, 255])
def test_any_bitmap_gives_the_same_archive(spark, pages, monkeypatch, slots):
    """Payloads told single by an empty bitmap would be wrong; a full one only costs a shuffle."""
    real = archive_module.bitmap

    def other(hashes, column):
        bits = real(hashes, column)
        return bits if slots == 0 else bits | slots

    monkeypatch.setattr(archive_module, "bitmap", other)
    archive = archived_pages(pages)
    assert archive.payloads.count() == 4
    assert archive.reconstructed(contents=False).count() == 8


def test_the_query_rebuilds_records_and_notices_damage(spark, sf_dir, monkeypatch):
    found = sorted(map(tuple, queries.op3_content_archive(spark, sf_dir).collect()))
    rows = duckdb.sql(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall()
    last = {}
    for page, html in rows:
        last[html or ""] = max(page, last.get(html or "", page))
    truth = []
    for page, html in rows:
        payload, owner = (html or "").encode(), last[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "response" if owner == page else "revisit"
        truth.append((page, len(payload), digest, kind, None if owner == page else owner))
    assert found == sorted(truth)

    real = queries.archived_pages

    def damaged(pages):
        archive = real(pages)
        cut = F.expr("if(xxhash64(sha256) % 50 = 0, substring(payload, 1, 40), payload)")
        return type(archive)(archive.headers, archive.payloads.withColumn("payload", cut))

    monkeypatch.setattr(queries, "archived_pages", damaged)
    with pytest.raises(Exception, match="does not match its digest"):
        queries.op3_content_archive(spark, sf_dir).collect()


CHAT = "conv_id long, turn long, role string, text string, body string, row string"


def test_reply_order(spark):
    data = [
        (1, 0, "user", "Hello there.\nHow are   you?\n\nSecond para\nwraps here."),
        (1, 1, "assistant", "Other message"),
        (1, 2, "user", "On Monday, Bob wrote:\n> hello there.\n> How are you?\n\nFine!"),
        (1, 3, "assistant", "> On Monday, Bob wrote:\n> > Hello there.\n> > How are you?\n>\n> Fine!\nGood."),
        (1, 4, "user", ">> second para wraps here.\n> Other message\nok"),
        (1, 5, "user", ">Second para wraps   here.\n"),
        (2, None, "user", "x"), (2, 3, None, "> x\ny"),
        (None, 1, "user", None), (None, 1, "user", ""),
        (3, 0, "user", "> nothing known\nz"), (3, 0, "user", "> nothing known\nz"),
    ]
    df = spark.createDataFrame([(*r, "b", "r") for r in data], CHAT)
    found = sorted(map(tuple, reply_ordered(df).collect()), key=lambda r: (r[0] or 0, r[9]))
    short = [(r[0], r[1], r[3], r[4], r[5], r[7], r[8], r[9]) for r in found]
    assert short == [
        (None, 1, "", 0, 0, None, 1, 0), (None, 1, "", 0, 0, None, 1, 1),
        (1, 0, data[0][3], 0, 0, None, 0, 0), (1, 2, "Fine!", 1, 2, 0, 0, 1),
        (1, 3, "Good.", 2, 5, 2, 0, 2), (1, 5, "", 1, 1, 0, 0, 3),
        (1, 1, "Other message", 0, 0, None, 1, 4), (1, 4, "ok", 2, 2, 1, 1, 5),
        (2, None, "x", 0, 0, None, None, 0), (2, 3, "y", 1, 1, None, None, 1),
        (3, 0, "z", 1, 1, None, 0, 0), (3, 0, "z", 1, 1, None, 0, 1),
    ]
    assert reply_ordered(df.limit(0)).count() == 0


def test_long_reply_chain_and_many_marks(spark):
    data = [(1, 0, "user", "line 0")]
    data += [(1, i, "user", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    data += [(2, 0, "user", ">" * 20_000 + " deep\nx")]
    found = {
        (r["conv_id"], r["turn"]): r
        for r in reply_ordered(spark.createDataFrame(data, CHAT[: CHAT.index(", body")])).collect()
    }
    assert all(found[1, i]["thread"] == 0 and found[1, i]["reply_to"] == i - 1 for i in range(1, 40))
    assert found[2, 0]["quote_level"] == 20_000 and found[2, 0]["body"] == "x"


def test_latest_before_over_blocks(spark):
    own = [(1, 9, t) for t in (0, 5, 5000, 9000)] + [(2, 9, 7)]
    asked = [(1, 9, t) for t in (0, 3, 5, 6, 4999, 5001, 20_000)] + [(2, 9, 6), (1, 8, 50)]
    columns = "conv long, hash long, turn long"
    found = latest_before(spark.createDataFrame(own, columns), spark.createDataFrame(asked, columns))
    assert {(r["conv"], r["turn"]): r["found"] for r in found.collect()} == {
        (1, 3): 0, (1, 5): 0, (1, 6): 5, (1, 4999): 5, (1, 5001): 5000, (1, 20_000): 9000,
    }
