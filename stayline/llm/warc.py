"""WARC archives: written with an index, read back by coalesced byte ranges.

Each record is a gzip member of its own, so any record can be read alone. While
an archive is written, one index row is kept per record: archive, offset,
length, url, digest. Reading starts from index rows: they are sorted by place,
neighbours become one range read, and only selected records are unpacked.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.sources.staging import checkpoint_root, stage

#: RFC 4648 alphabet (a fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Packed bytes that a reading task takes.
READ_BYTES = 8 << 20

INDEX = (
    "archive string, offset long, length long, page_id long, url string, digest string, "
    "record_type string"
)
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, digest string, "
    "refers_to long, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """SHA-1 of a binary column as 32 bare base32 letters."""
    code = F.sha1(data)
    letters = []
    for group in range(8):
        five = F.conv(F.substring(code, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(five, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substr(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def deduplicated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, refers_to of each page.

    Of pages with equal payloads of at least ``min_bytes`` bytes the smallest
    page_id is the original (refers_to null), the others refer to it. A null
    html is an empty payload. Rows that repeat the smallest page_id are all
    originals; a null page_id refers to any other id, and is an original where
    the group has no other.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    base = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))}
    )
    first = (
        base.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest", "payload_bytes")
        .agg(F.min("page_id").alias("first_id"))
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return base.join(first, ["digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "digest", refers.alias("refers_to")
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _header_text(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _record(row: dict, date: str) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header and no payload."""
    revisit = row["refers_to"] is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(row['page_id'])}",
        f"WARC-Date: {date}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_header_text(row['url'])}")
    head.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if revisit:
        head.append(f"WARC-Refers-To: {_name(row['refers_to'])}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + row["payload"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def _parse(member: bytes) -> dict:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda name: int(name[10:-1]) if name and name[10:-1] else None
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": None if revisit else payload,
    }


_INDEX_ARROW = pa.schema(
    [("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
     ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())]
)
_RECORD_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def write_archives(
    records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", roll_bytes: int = 1 << 30
) -> DataFrame:
    """Write the records of ``deduplicated`` below ``folder``; return the staged index.

    Each task writes archives under a name of its own and starts a new one after
    ``roll_bytes``. A task that is run again writes new files; the index, which
    Spark commits, names only those of the run that counted.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            index = {k: [] for k in _INDEX_ARROW.names}
            for row in batch.to_pylist():
                if out is None or at >= roll_bytes:
                    if out is not None:
                        out.close()
                    store.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = _record(row, date)
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                for k, v in zip(
                    _INDEX_ARROW.names,
                    (f"{folder}/{name}", at, len(member), row["page_id"], row["url"], row["digest"], kind),
                    strict=True,
                ):
                    index[k].append(v)
                at += len(member)
            yield pa.RecordBatch.from_pydict(index, _INDEX_ARROW)
        if out is not None:
            out.close()

    return stage(records.mapInArrow(write, INDEX), "warc_index")


def read_records(
    index: DataFrame, max_gap: int = 1 << 16, max_range: int = 1 << 23
) -> DataFrame:
    """The records that rows of an index name, in the columns of RECORD.

    Rows are dealt out and sorted by (archive, offset). Records at most
    ``max_gap`` bytes apart are read together, up to ``max_range`` bytes a read;
    a longer record is read alone.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        name, group = None, []
        for batch in batches:
            for archive, offset, length in zip(
                *(batch.column(i).to_pylist() for i in range(3)), strict=True
            ):
                if group and (
                    archive != name
                    or offset - sum(group[-1]) > max_gap
                    or offset + length - group[0][0] > max_range
                ):
                    yield name, group
                    group = []
                name = archive
                group.append((offset, length))
        if group:
            yield name, group

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for archive, group in ranges(batches):
            if archive != name:
                if source is not None:
                    source.close()
                store, path = fs.FileSystem.from_uri(archive)
                name, source = archive, store.open_input_file(path)
            start = group[0][0]
            raw = source.read_at(sum(group[-1]) - start, start)
            found = [_parse(raw[o - start : o - start + n]) for o, n in group]
            yield pa.RecordBatch.from_pylist(found, _RECORD_ARROW)
        if source is not None:
            source.close()

    placed = index.select("archive", "offset", "length")
    # The index is small beside the archives: the tasks follow the bytes to read.
    total = placed.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // READ_BYTES))
    dealt = placed.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages as archives on the shared storage; return the index."""
    root = checkpoint_root(pages.sparkSession).rstrip("/")
    return write_archives(deduplicated(pages, min_bytes), f"{root}/warc-{uuid.uuid4().hex[:12]}")
