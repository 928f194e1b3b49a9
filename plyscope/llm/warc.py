"""WARC archives, index first (operator 13).

Writing. Payload digests are taken first, from narrow rows. Of the records of a payload the one with
the largest page_id (then the largest row id) becomes a ``response`` with an HTTP block; the others
become ``revisit`` records without a payload, which refer to it. Each task appends its records to
archives of about ``ARCHIVE_BYTES`` in the shared folder, each record a gzip member of its own, and
returns one index row per record: archive, offset, length, URL, digest. The index is the commit: a
task that is run again writes archives under new names, and those of the lost attempt are in no index
row. Texts are not shuffled unless very many rows are revisits (see ``if_small``).

Reading. Index rows are selected first, dealt by archive and sorted by offset. Neighbouring ranges with
small gaps are read as one range, the members cut out of it, unpacked and parsed, and each payload's
digest is checked against its record. Only selected ranges are read, through Arrow's file systems, so
the shared folder may be in any store that these know.

Results: a null html is the empty payload (a response or revisit like others); a null url leaves out
the target field; line breaks in a url are percent-encoded. A null page_id is the smallest; a revisit
of a record without page_id refers to null. Repeated rows are records of their own: the last in
file order is the response. An empty table gives an empty archive set, index and result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyscope.llm.common import RID, checkpoint_dir, if_small, numbered, prepare, written

ARCHIVE_BYTES = 64 << 20
#: neighbouring ranges with at most this gap are read at once, up to so many bytes
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
DATE = "2001-11-04T00:00:00Z"
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("archive string, offset long, length long, url string, digest string, page_id long, record_type string, "
         "refers_to long")
_FIELDS = [f.split()[0] for f in INDEX.split(", ")]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, rid: int) -> str:
    """The record's URI names the page and the row."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{rid}>"


def _page_of(uri: str):
    page = uri.strip("<>").split(":")[2]
    return int(page) if page else None


def _url_field(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def build_record(page_id, rid: int, url, payload: bytes, digest: str, target=None) -> bytes:
    """One WARC record; ``target`` is the (page_id, rid) a revisit refers to."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http.encode() + (payload if target is None else b"")
    fields = [("WARC-Type", RESPONSE if target is None else REVISIT), ("WARC-Record-ID", record_id(page_id, rid)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _url_field(url)))
    if target is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*target))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


def parse_record(data: bytes) -> dict:
    """Fields of one unpacked record; raises where its lengths or its payload's digest do not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[:int(fields["content-length"])]
    if not head.startswith(b"WARC/1.1") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    size = int(_headers(http)["content-length"])
    if kind == RESPONSE and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": _page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "payload": payload if kind == RESPONSE else None,
            "refers_to": _page_of(fields["warc-refers-to"]) if kind == REVISIT else None}


def pack(record: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)  # a gzip member
    return z.compress(record) + z.flush()


def unpack(member: bytes) -> bytes:
    return zlib.decompress(member, 31)


def file_system(uri: str):
    """(file system, path) of a folder named by a URI or a local path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:/") else (fs.LocalFileSystem(), uri)


def _decided(pages: DataFrame) -> DataFrame:
    """(rid, target_page, target_rid) of the rows that become revisits."""
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    narrow = written(pages.select(RID, "page_id", F.unhex(digest).alias("digest")))
    last = narrow.groupBy("digest").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-1 << 63)).alias("order"), RID, "page_id")).alias("last"),
        F.count("*").alias("copies")).filter("copies > 1").select("digest", "last")
    return narrow.join(last, "digest").filter(F.col(RID) != F.col(f"last.{RID}")).select(
        F.col(RID).alias("__of"), F.col("last.page_id").alias("target_page"), F.col(f"last.{RID}").alias("target_rid"))


def _write(folder: str, archive_bytes: int):
    def run(batches):
        fs, root = file_system(folder)
        out = name = None
        at = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(i, 256).to_pylist():
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (r["html"] or "").encode()
                    digest = payload_digest(payload)
                    target = (r["target_page"], r["target_rid"]) if r["target_rid"] is not None else None
                    member = pack(build_record(r["page_id"], r[RID], r["url"], payload, digest, target))
                    out.write(member)
                    rows.append((name, at, len(member), r["url"], digest, r["page_id"], RESPONSE if target is None else REVISIT,
                                 target and target[0]))
                    at += len(member)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist([dict(zip(_FIELDS, x)) for x in rows], schema=pa.schema(
                    [(n, pa.string() if n in ("archive", "url", "digest", "record_type") else pa.int64()) for n in _FIELDS]))
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """Write the archives; returns their folder and the written index, one row per record."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    # the file scan itself keeps the row numbers; fixed names keep other columns out
    rows = numbered(pages).select(RID, F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                                  F.col(html_col).alias("html"))
    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    revisits = if_small(written(_decided(rows)))
    decided = rows.join(revisits, rows[RID] == revisits["__of"], "left").drop("__of")
    return folder, written(decided.mapInArrow(_write(folder, archive_bytes), INDEX))


RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "payload binary")


def _read(folder: str, payloads: bool):
    names = [f.split()[0] for f in RECORD.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n in ("page_id", "payload_bytes", "refers_to")
                         else pa.string()) for n in names])

    def run(batches):
        fs, root = file_system(folder)
        name = source = None
        for batch in batches:
            archive, offset, length = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            i = 0
            while i < len(archive):
                # as many rows as one range covers
                j, end = i + 1, offset[i] + length[i]
                while (j < len(archive) and archive[j] == archive[i] and offset[j] - end <= GAP_BYTES
                       and offset[j] + length[j] - offset[i] <= RANGE_BYTES):
                    end, j = max(end, offset[j] + length[j]), j + 1
                if archive[i] != name:
                    if source is not None:
                        source.close()
                    name, source = archive[i], fs.open_input_file(f"{root}/{archive[i]}")
                data = memoryview(source.read_at(end - offset[i], offset[i]))
                rows = [parse_record(unpack(data[offset[k] - offset[i]:offset[k] - offset[i] + length[k]])) for k in range(i, j)]
                yield pa.RecordBatch.from_pylist([r if payloads else {**r, "payload": None} for r in rows], schema=schema)
                i = j
        if source is not None:
            source.close()
    return run


def read_records(folder: str, selected: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows, parsed and checked; payloads on request."""
    spark = selected.sparkSession
    prepare(spark)
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-total // (2 * ARCHIVE_BYTES)))
    dealt = (selected.select("archive", "offset", "length").repartition(parts, "archive")
             .sortWithinPartitions("archive", "offset"))
    return dealt.mapInArrow(_read(folder, payloads), RECORD)


def warc_digest(pages: DataFrame, **options) -> DataFrame:
    """Every page's record, as read back from the archives."""
    folder, index = write_archives(pages, **options)
    return read_records(folder, index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
