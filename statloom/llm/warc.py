"""WARC archives whose records are compressed one by one with a dictionary in front of the file.

A file begins with a skippable Zstandard frame that holds the dictionary, itself compressed; then each
record is a frame of its own. Records of equal payloads are written once, as a response; the others
are revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import by_path, map_pieces, open_folder, sample_of, shared_folder, write_file, written

#: Records the dictionary is built from, its size, and the level of compression.
SAMPLE_RECORDS, DICTIONARY, LEVEL = 2_000, 64 * 1024, 3
#: Bytes of records in one archive; a file may be larger by its last record.
FILE_BYTES = 64 * 1024 * 1024
_SKIPPABLE = 0x184D2A5D
_ZSTD = b"\x28\xb5\x2f\xfd"
_DATE = "2000-01-01T00:00:00Z"  # the tables hold no time; one date keeps files equal from run to run


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, label: str) -> bytes:
    """The bytes of a response, or of a revisit of ``original``. ``label`` is the payload's digest."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    body = http if original is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
        *([f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda c: f'%{ord(c[0]):02X}', url)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{label}", f"WARC-Block-Digest: sha1:{digest(body)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if original is not None:
        lines += [f"WARC-Refers-To: <urn:page:{original}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}"]).encode()
    return head + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """What a record says: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    body = rest[:size]
    if len(body) != size or rest[size:] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(body)}":
        raise ValueError("a broken WARC record")
    http, _, payload = body.partition(b"\r\n\r\n")
    named = lambda key: int(v) if (v := fields.get(key, "<urn:page:>")[10:-1]) else None
    return {
        "page_id": named("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": fields["WARC-Payload-Digest"][5:], "record_type": fields["WARC-Type"],
        "refers_to": named("WARC-Refers-To"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def build_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary trained on a bounded sample of the records; empty where there are too few."""
    import zstandard

    some = sample_of(pages.where(F.length(html_col) > 0), F.xxhash64(html_col), SAMPLE_RECORDS)
    # A third of all rows may be copies of one page: each text once, and not more than fits a sample.
    texts = some.select(html_col).distinct().orderBy(F.xxhash64(html_col)).limit(SAMPLE_RECORDS)

    def cut(columns: dict[str, list]) -> dict:
        return {"part": [record(0, None, t.encode(), None, digest(t.encode()))[:16384] for t in columns["html"]]}

    parts = [bytes(r["part"]) for r in map_pieces(texts.select(F.col(html_col).alias("html")), "part binary", cut).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def originals(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """The page each payload of at least ``least`` bytes is a response in, if it stands in several."""
    keys = pages.select(F.col(id_col).alias("id"), F.sha1(html_col).alias("sha"),
                        F.octet_length(html_col).alias("size")).where(F.col("size") >= least)
    return (keys.groupBy("sha", "size").agg(F.min("id").alias("original"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").drop("n"))


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Write an archive per partition (more, where a partition is large); gives path and records of each.

    Null html counts as empty. Of rows with equal payloads those with the smallest id are responses (all
    of them, should an id repeat; null ids are never the smallest, unless all are null), the others are
    revisits. Payloads are hashed in place and only hashes are grouped; a payload that a third of all
    rows share is joined to one row, which Spark can split. Long pages are one record each; a null url
    is left out; an empty table gives no archive; other columns are left out.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(html_col, F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    first = originals(rows, "id", "html", least)
    joined = rows.join(first, ["sha", "size"], "left").select("id", "url", "html", "sha", "original")
    folder = shared_folder(spark, "warc")
    book = spark.sparkContext.broadcast(build_dictionary(rows, "html"))

    def save(batches):
        import zstandard

        trained = zstandard.ZstdCompressionDict(book.value) if book.value else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True, write_checksum=True)
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        front = zstandard.ZstdCompressor(level=9).compress(book.value) if book.value else b""
        waiting, made = next(rows, None), []
        while waiting is not None:
            n = 0

            def parts():
                nonlocal waiting, n
                if front:
                    yield struct.pack("<II", _SKIPPABLE, len(front)) + front
                size = 0
                while waiting is not None and size < FILE_BYTES:
                    page, url, html, sha, original = waiting
                    label = base64.b32encode(bytes.fromhex(sha)).decode()
                    again = original if original is not None and original != page else None
                    data = record(page, url, html.encode(), again, label)
                    packed = packer.compress(data)
                    size, n, waiting = size + len(packed), n + 1, next(rows, None)
                    yield packed

            path = write_file(folder, "part", parts())
            made.append({"path": path, "records": n})
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("path", "string"), ("records", "int64")]))

    return written(joined.mapInArrow(save, "path string, records long"), "warc-list")


def frames(stream):
    """The records of an open archive, one at a time."""
    import zstandard

    data, book = stream.read(1 << 20), None
    while data:
        while len(data) < 8 and (got := stream.read(1 << 20)):
            data += got
        if struct.unpack("<I", data[:4])[0] == _SKIPPABLE:
            size = struct.unpack("<I", data[4:8])[0]
            while len(data) < 8 + size and (got := stream.read(1 << 20)):
                data += got
            raw = data[8:8 + size]
            book = zstandard.ZstdCompressionDict(
                zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == _ZSTD else raw)
            data = data[8 + size:] or stream.read(1 << 20)
            continue
        reader = zstandard.ZstdDecompressor(dict_data=book).decompressobj()
        made = [reader.decompress(data)]
        while not reader.eof:
            data = stream.read(1 << 20)
            if not data:
                raise ValueError("the archive ends early")
            made.append(reader.decompress(data))
        data = reader.unused_data or stream.read(1 << 20)
        yield b"".join(made)


def read(archives: DataFrame) -> DataFrame:
    """The records of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload."""
    def run(batches):
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        schema = pa.schema(list(zip(names, kinds)))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = open_folder(path)
                held, size = [], 0
                with system.open_input_stream(base) as stream:
                    for data in frames(stream):
                        held.append(parsed(data))
                        size += len(data)
                        if size >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, payload binary")
    return by_path(archives.select("path")).mapInArrow(run, schema)
