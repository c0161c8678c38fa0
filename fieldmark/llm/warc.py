"""WARC archives: written with an index, read back through it.

Writing gives one row per record: file, offset, length, URL, digest, kind.  Reading
starts from any selection of that index: rows are dealt by file and stretch of file,
sorted by offset, and ranges that nearly touch are fetched with one read.  Records are
gzip members of their own, so a range opens without what lies before it.

Files go to a folder that every machine shares, under names of their own per attempt; a
lost task's files stay unnamed by the index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle

#: Bytes after which a writer starts another file.
FILE_BYTES = 256 << 20
#: Bytes of a file that one group of reads covers, the gap that one read passes over, and its size at most but for a larger record.
STRETCH, GAP, READ = 4 << 20, 64 << 10, 8 << 20
#: Bytes of records that a task of the reader fetches, about.
TASK = 8 << 20
LEVEL = 4

_INDEX = "file string, offset bigint, length bigint, url string, payload_digest string, record_type string, page_id bigint, refers_to bigint"
_RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """A record's bytes and its payload digest; one that refers to another leaves its payload out."""
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(4, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """Headers and payload of one record; digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    told = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(told["content-length"])]
    if told["warc-block-digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"damaged record {told['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)[1])
    digest = told["warc-payload-digest"].removeprefix("sha1:")
    if told["warc-type"] == "response" and (size != len(payload) or digest != _digest(payload)):
        raise ValueError(f"damaged payload {told['warc-record-id']}")
    return {
        "page_id": _number(told["warc-record-id"]),
        "url": told.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": told["warc-type"],
        "refers_to": _number(told.get("warc-refers-to")),
        "payload": payload if told["warc-type"] == "response" else None,
    }


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _written_rows(folder: str, date: str) -> Callable:
    names = [part.split(" ")[0] for part in _INDEX.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, offset = None, "", 0
        try:
            for batch in batches:
                made: list[tuple] = []
                for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    if out is None or offset > FILE_BYTES:
                        if out is not None:
                            out.close()
                        file, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        system, path = _open(file)
                        system.create_dir(path.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(path, compression=None)
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    raw, digest = record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), date)
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    kind = "response" if not refers_to.is_valid else "revisit"
                    made.append((file, offset, len(member), url.as_py(), digest, kind, page_id.as_py(), refers_to.as_py()))
                    offset += len(member)
                if made:
                    columns = zip(*made, strict=True)
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    return rows


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record per page to files in ``folder`` (a URI all machines reach) and returns the index, stored.

    Of pages with equal payloads the one with the largest id is a response, the others
    revisit it.

    Defined cases.  A null payload is empty.  Rows that repeat the largest id are all
    responses.  A null id is smaller than any; if all are null, all are responses.  A null
    URL is left out.  No pages give an empty index and no file.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # two digests of different kinds tell payloads apart
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = rows.withColumns({"d1": F.unhex(F.sha1(payload)), "d2": F.xxhash64(payload)})
    # only payloads that occur more than once: stored, so that their size on disk tells Spark how to join them
    groups = settle(keyed.groupBy("d1", "d2").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1").drop("n"))
    typed = keyed.join(groups, ["d1", "d2"], "left")
    is_top = F.col("top").isNull() | F.coalesce(F.col("page_id") == F.col("top"), F.lit(False))
    typed = typed.select("page_id", "url", "html", F.when(~is_top, F.col("top")).alias("refers_to"))
    return settle(typed.mapInArrow(_written_rows(folder.rstrip("/"), date), _INDEX))


def _read_rows(with_payload: bool) -> Callable:
    names = [part.split(" ")[0] for part in _RECORDS.split(", ")] + (["payload"] if with_payload else [])
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Records that one read fetches together."""
        file, held = "", []
        for batch in batches:
            for f, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                far = held and (offset - (held[-1][0] + held[-1][1]) > GAP or offset + length - held[0][0] > READ)
                if held and (f != file or far):
                    yield file, held
                    held = []
                file = f
                held.append((offset, length))
        if held:
            yield file, held

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = "", None
        for file, records in ranges(batches):
            if file != name:
                if source is not None:
                    source.close()
                system, path = _open(file)
                name, source = file, system.open_input_file(path)
            begin = records[0][0]
            raw = source.read_at(records[-1][0] + records[-1][1] - begin, begin)
            parsed = [parse(zlib.decompress(raw[o - begin : o - begin + n], 31)) for o, n in records]
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in parsed], k) for c, k in zip(names, kinds, strict=True)], names)
        if source is not None:
            source.close()

    return rows


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that rows of an index name: ids, sizes, digests and kinds as the archives hold them.

    ``with_payload`` adds the payload, null for revisits, whose sizes and digests are the
    full payload's.  Damage raises an error.
    """
    schema = _RECORDS + (", payload binary" if with_payload else "")
    picked = index.select("file", F.floor(F.col("offset") / STRETCH).alias("stretch"), "offset", "length")
    # tasks follow the bytes to fetch: rows of the index are too small to tell
    n_tasks = max(1, -(-int(index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]) // TASK))
    return picked.repartition(n_tasks, "file", "stretch").sortWithinPartitions("file", "offset").mapInArrow(_read_rows(with_payload), schema)
