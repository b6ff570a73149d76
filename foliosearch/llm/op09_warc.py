"""WARC archives of web pages: indexed as they are written, read by byte ranges.

Writing: each task writes its pages as gzip members of one archive after
another below a folder that all executors reach, and returns an index row for
each record: file, offset, length, URL and digest.  The index is a Parquet
table; an archive counts through its index rows only, so what a lost task
wrote is never read.  Pages with equal payloads are written once: the record
with the largest page_id is a response, the others are revisits that refer to
it.

Reading: the index rows are filtered first, then sorted by file and offset
and dealt in ranges.  A task joins neighbouring byte ranges into one
read as long as the gap and the read stay small, and parses the records out of
it.  No archive is read as a whole unless all of it is asked for.

Archives are reached through Arrow's file systems, so the folder may be a
path or a URI that they know.

Defined cases: null html is an empty payload; a payload of fewer bytes than
``least_bytes`` is always a response; of equal payloads whose page_ids are all
null each is a response, as is every row that repeats the largest page_id;
null page_id and URL are left out of the record; characters of a URL that a
header can't hold are percent-encoded there, while the index has the URL
itself; an empty table writes no archive and gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosearch.llm.batches import text_bytes

LEAST_BYTES = 0
ARCHIVE_BYTES = 256 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
TASK_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"  # fixed, so that equal pages give equal archives

INDEX = (
    "page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long, "
    "file string, offset long, length long"
)
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def open_folder(place: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(place if re.match(r"\w[\w+.-]*:", place) else f"file://{place}")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: {_id(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>'}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,-./:;=?@[]_~"))
    head += ["Content-Type: text/html", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
        head.append(f"X-Payload-Length: {len(payload)}")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"
    return press.compress(whole) + press.flush()


def parse(member: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes]:
    """The fields of ``RECORDS`` from one gzip member; a response's digest is computed anew."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])]
    page = re.fullmatch(r"<urn:page:(-?\d+)>", fields["WARC-Record-ID"])
    refers = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get("WARC-Refers-To", ""))
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload)
    if kind == "revisit":
        size = int(fields["X-Payload-Length"])
    elif (found := payload_digest(payload)) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} has digest {found}, not {digest}")
    return (
        int(page[1]) if page else None,
        fields.get("WARC-Target-URI"),
        size,
        digest,
        kind,
        int(refers[1]) if refers else None,
        payload,
    )


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    where = out = None
    for batch in batches:
        pages, urls, firsts = (batch.column(k).to_pylist() for k in (0, 1, 3))
        data, offsets = text_bytes(batch.column(2))
        raw, rows = data.tobytes(), []
        for k, page in enumerate(pages):
            payload = raw[offsets[k] : offsets[k + 1]]
            revisit = firsts[k] is not None and firsts[k] != page
            digest = payload_digest(payload)
            if out is None or out.tell() >= archive_bytes:
                if out is not None:
                    out.close()
                else:
                    system, path = open_folder(folder)
                    system.create_dir(path, recursive=True)
                where = f"{uuid.uuid4().hex}.warc.gz"
                out = system.open_output_stream(f"{path}/{where}", compression=None)
            member = record(page, urls[k], payload, digest, firsts[k], revisit)
            kind = "revisit" if revisit else "response"
            rows.append((page, urls[k], digest, len(payload), kind, firsts[k] if revisit else None, where, out.tell(), len(member)))
            out.write(member)
        if rows:
            yield _batch(rows, INDEX)
    if out is not None:
        out.close()


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in ddl.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], names=list(names))


def write_archives(
    pages: DataFrame,
    folder: str,
    page: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ``pages`` as archives in ``folder`` and return their index.

    The index is stored in ``{folder}/index``.  Which of equal payloads is the
    response is told by a join on their digest, met by a shuffle on both sides
    so that a payload of very many pages is split at run time.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("digest", F.sha1(payload))
    shared = (
        rows.where(F.octet_length(payload) >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("same"), "first")
    )
    shared.write.parquet(f"{folder}/shared")
    shared = spark.read.parquet(f"{folder}/shared")
    told = rows.join(shared, F.col("digest") == F.col("same"), "left").select("page_id", "url", "html", "first")
    told.mapInArrow(lambda b: _write(b, f"{folder}/archives", archive_bytes), INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _ranges(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) rows as reads: file, start, end and the records within."""
    at, start, end, inside = None, 0, 0, []
    for file, offset, length in rows:
        if inside and file == at and offset - end <= gap and offset + length - start <= most:
            end = max(end, offset + length)
            inside.append((offset, length))
            continue
        if inside:
            yield at, start, end, inside
        at, start, end, inside = file, offset, offset + length, [(offset, length)]
    if inside:
        yield at, start, end, inside


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool, gap: int, most: int) -> Iterator[pa.RecordBatch]:
    system, path = open_folder(folder)
    open_file, name = None, None
    for batch in batches:
        wanted = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
        for file, start, end, inside in _ranges(wanted, gap, most):
            if file != name:
                if open_file is not None:
                    open_file.close()
                open_file, name = system.open_input_file(f"{path}/{file}"), file
            data = open_file.read_at(end - start, start)
            found = [parse(data[o - start : o - start + n]) for o, n in inside]
            yield _batch([x if with_payload else (*x[:-1], None) for x in found], RECORDS)
    if open_file is not None:
        open_file.close()


def read_records(
    selected: DataFrame, folder: str, with_payload: bool = True, gap: int = GAP_BYTES, most: int = READ_BYTES
) -> DataFrame:
    """The records of the selected index rows, read by joined byte ranges.

    A revisit has the payload length and digest of the payload it stands for
    and no payload of its own.
    """
    ranges = selected.select("file", "offset", "length")
    tasks = 1 + (ranges.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES
    dealt = ranges.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(lambda b: _read(b, f"{folder}/archives", with_payload, gap, most), RECORDS)
