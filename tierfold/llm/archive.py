"""WARC records, and an archive that stores each payload once under its digest."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.llm.common import bitmap, in_bitmap
from tierfold.staging import delete_tree, shared_folder

END = "\r\n\r\n"  # ends the header, and ends the record after its payload
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PARSED = (
    "file string, place long, header binary, page_id long, url string, payload_bytes long,"
    " payload_digest string, sha256 binary"
)
PACKED = "file string, place long, sha256 binary, payload binary"
REBUILT = (
    "header binary, page_id long, url string, payload_bytes long, payload_digest string,"
    " sha256 binary, record_type string, refers_to long"
)
FILE_RECORDS = 2000  # in one WARC file, which one task holds while it reads it
PART_RECORDS = 1000  # of equal payload that are rebuilt together
_LENGTH = re.compile(rb"^Content-Length: *(\d+)", re.M | re.I)
_DIGEST = re.compile(rb"^WARC-Payload-Digest: *sha1:(\w+)", re.M | re.I)
_PAGE = re.compile(rb"^WARC-Record-ID: *<urn:page:(-?\d+)>", re.M | re.I)
_URI = re.compile(rb"^WARC-Target-URI: *([^\r\n]*)", re.M | re.I)
_FLUSH_BYTES = 4 << 20


def base32_of_hex(sha1_hex: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hex, five hex digits at a time."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One WARC record for each row of ``pages`` (page_id, url, html), in gzipped WARC files.

    The payload is the HTML in UTF-8. Records are written as they are read, without shuffle.
    A null page_id gives an empty record id, a null url no target line, null HTML an empty
    payload; line ends inside a url are percent-encoded. A file has ``FILE_RECORDS`` at most.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: response"),
        F.concat(
            F.lit("WARC-Record-ID: <urn:page:"),
            F.coalesce(F.col("page_id").cast("string"), F.lit("")),
            F.lit(">"),
        ),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.sha1(payload))),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    )
    record = F.concat(header, F.lit(END), payload.cast("string")).alias("value")
    pages.select(record).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def records_of(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header (without its closing blank line) and payload of each record of a WARC file.

    The file is expanded as it is read, one record at a time.
    """
    packed = content[:2] == b"\x1f\x8b"
    data = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if packed else io.BytesIO(content)
    end = END.encode()
    number = 0
    while line := data.readline():
        lines = [line]
        while not (lines[-1] == b"\r\n" and len(lines) > 1 and lines[-2].endswith(b"\r\n")):
            lines.append(data.readline())
            if not lines[-1]:
                raise ValueError(f"the header of record {number} does not end")
        header = b"".join(lines)[: -len(end)]
        length = _LENGTH.search(header)
        if length is None:
            raise ValueError(f"record {number} has no Content-Length")
        payload = data.read(int(length[1]))
        if data.read(len(end)) != end:
            raise ValueError(f"record {number} does not end after its Content-Length")
        yield header, payload
        number += 1


def parsed_record(header: bytes, payload: bytes) -> dict:
    """Fields of one record; raises where the payload is not the one the header names."""
    digest = base64.b32encode(hashlib.sha1(payload).digest())
    claimed = _DIGEST.search(header)
    if claimed and claimed[1].upper() != digest:
        raise ValueError(f"payload digest {digest!r} differs from the header's {claimed[1]!r}")
    page, uri = _PAGE.search(header), _URI.search(header)
    return {
        "header": header,
        "page_id": int(page[1]) if page else None,
        "url": uri[1].decode("utf-8", "replace") if uri else None,
        "payload_bytes": len(payload),
        "payload_digest": digest.decode(),
        "sha256": hashlib.sha256(payload).digest(),
    }


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[kind]) for n, kind in (x.split() for x in schema.split(", "))])


def _in_portions(rows: Iterator[dict], schema: str) -> Iterator[pa.RecordBatch]:
    """``rows`` as Arrow batches of a few megabytes."""
    arrow, held, size = _arrow(schema), [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row.values() if isinstance(x, bytes | str))
        if size >= _FLUSH_BYTES:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def _from_files(
    spark: SparkSession, path: str, schema: str, row: Callable[[bytes, bytes], dict | None]
) -> DataFrame:
    """file, place and what ``row`` makes of every record below ``path`` (None: left out)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                for place, found in enumerate(records_of(content.as_py())):
                    if (fields := row(*found)) is not None:
                        yield {"file": file.as_py(), "place": place, **fields}

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(lambda batches: _in_portions(rows(batches), schema), schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the WARC files below ``path``, its digest checked against its payload."""
    return _from_files(spark, path, PARSED, parsed_record)


def _packed_payloads(spark: SparkSession, path: str, shared: np.ndarray, among: bool) -> DataFrame:
    """Payloads, compressed, whose digest has (``among``) or has not its slot in ``shared``."""

    def packed(header: bytes, payload: bytes) -> dict | None:
        digest = hashlib.sha256(payload).digest()
        slot = np.array([int.from_bytes(digest[:8], "big")], np.uint64)
        if in_bitmap(shared, slot)[0] != among:
            return None
        return {"sha256": digest, "payload": zstandard.ZstdCompressor(6).compress(payload)}

    return _from_files(spark, path, PACKED, packed)


def rebuilt(header: bytes, stored: bytes, sha256: bytes) -> tuple[bytes, dict]:
    """A record put together from its header and stored payload, read again and checked.

    Raises where the stored payload is not the one of its digest, or where the record does not
    hold the payload that its header names (Content-Length and digest).
    """
    try:
        payload = zstandard.ZstdDecompressor().decompressobj().decompress(stored)
    except zstandard.ZstdError as error:
        raise ValueError("stored payload does not match its digest") from error
    if hashlib.sha256(payload).digest() != sha256:
        raise ValueError("stored payload does not match its digest")
    record = b"".join((header, END.encode(), payload, END.encode()))
    [(again, content)] = records_of(record)
    return record, {**parsed_record(again, content), "payload": content}


@dataclass(frozen=True)
class Archive:
    """``headers``: one row for each record; ``payloads``: one row for each distinct payload.

    A payload is stored compressed (zstd). ``parts`` is the number of groups its records are
    rebuilt in, ``part`` the group of a record.
    """

    headers: DataFrame
    payloads: DataFrame

    def reconstructed(self, contents: bool = True) -> DataFrame:
        """Every original record: header, payload found by digest, and the bytes of both.

        Headers meet their payload in a join. Payloads move compressed, once for each
        ``PART_RECORDS`` records of theirs, so that the records of a payload that fills the
        archive are rebuilt by many tasks. Every record is expanded, put together, read again
        and checked where they meet; without ``contents`` the bytes then stay there. Fields
        are those of the rebuilt record.
        """
        schema = REBUILT + (", payload binary, record binary" if contents else "")
        names = [x.split()[0] for x in schema.split(", ")]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for one in range(batch.num_rows):
                    given = {n: batch.column(n)[one].as_py() for n in batch.schema.names}
                    record, fields = rebuilt(given["header"], given["payload"], given["sha256"])
                    found = {**given, **fields, "record": record}
                    yield {n: found[n] for n in names}

        part = F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
        payloads = self.payloads.select("sha256", part, "payload").hint("merge")
        joined = self.headers.select(
            "sha256", "part", "header", "record_type", "refers_to"
        ).join(payloads, ["sha256", "part"])
        return joined.drop("part").mapInArrow(
            lambda batches: _in_portions(rows(batches), schema), schema
        )


def store_warc(spark: SparkSession, path: str) -> Archive:
    """Store the WARC files below ``path`` by content in the shared folder.

    Payload bytes are kept once for each SHA-256, exact record headers apart from them. Among
    records of equal payload (two digests and the length agree), that of the largest page_id
    is the ``response``, ties going to the later file and place; the others are ``revisit``
    records of its page (``refers_to``). Only narrow header rows are grouped. A bitmap of
    fixed size tells payloads that surely stand in one record, which are stored where they are
    read; the others move once to learn whether their record is the response.
    """
    folder = shared_folder(spark, "archive")
    read_warc(spark, path).write.parquet(f"{folder}/read")
    headers = spark.read.parquet(f"{folder}/read")
    place = F.struct("page_id", "file", "place")
    owners = headers.groupBy("sha256").agg(
        F.max(place).alias("owner"),
        F.expr(f"cast(1 + (count(1) - 1) div {PART_RECORDS} as int)").alias("parts"),
        (F.count(F.lit(1)) > 1).alias("shared"),
    )
    first = (F.col("file") == F.col("owner.file")) & (F.col("place") == F.col("owner.place"))
    named = headers.join(owners, "sha256").select(
        "file", "place", "header", "page_id", "url", "payload_bytes", "payload_digest", "sha256",
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(~first, F.col("owner.page_id")).alias("refers_to"),
        F.expr("cast(pmod(xxhash64(file, place), parts) as int)").alias("part"),
        "parts", "shared", first.alias("first"),
    )
    named.write.parquet(f"{folder}/headers")
    stored = spark.read.parquet(f"{folder}/headers")
    repeated = stored.filter("shared and first")
    slot = F.conv(F.substring(F.hex("sha256"), 9, 8), 16, 10).cast("long").alias("slot")
    shared = bitmap(repeated.select(slot), "slot")
    single = _packed_payloads(spark, path, shared, among=False).withColumn("parts", F.lit(1))
    kept = stored.filter("first").select("file", "place", "parts")
    others = _packed_payloads(spark, path, shared, among=True).join(kept, ["file", "place"])
    columns = ["sha256", "parts", "payload"]
    single.select(columns).union(others.select(columns)).write.option(
        "compression", "uncompressed"
    ).parquet(f"{folder}/payloads")
    delete_tree(spark, f"{folder}/read")
    return Archive(
        stored.drop("parts", "shared", "first"), spark.read.parquet(f"{folder}/payloads")
    )


def archived_pages(pages: DataFrame) -> Archive:
    """Write ``pages`` as WARC files into the shared folder and store what is read back.

    The files go once they are stored: the archive gives every record of them.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_warc(pages, path)
    archive = store_warc(spark, path)
    delete_tree(spark, path)
    return archive
