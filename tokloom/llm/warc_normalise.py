"""WARC archives: writing, normalising monolithic gzip, and reading through an offset index.

Many archives in the wild are one gzip stream from front to back, so that no record can be
read without inflating all before it. ``normalise`` inflates such a file once, as a stream, writes every
record as a gzip member of its own, and writes a sidecar index with a line per record: offset and size
of its member, and what a reader wants to know before it opens it. Memory is bounded by the chunk size, for
archives, records and payloads of any size; an archive is one task's work, and ``write_archives`` starts a
new one at ``archive_bytes``, so archives stay bounded whatever the partitions are.

``write_archives`` stores equal payloads once: of rows with equal payloads of at least ``REVISIT_BYTES``
the one with the largest id is the response and the others are revisit records that refer to it.

Edge cases: a null html is an empty payload; a null url leaves the target header out. Rows without an
id are never referred to unless the whole group has none (then all are responses); rows that repeat
the largest id of their group are all responses. A truncated archive raises an error. An empty table
gives no archive. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokloom.llm import bytetext as B
from tokloom.llm.common import named_rows, shared_folder, stored
from tokloom.llm.files import Folder

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """One uncompressed WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def with_responses(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, refers_to) of every page.

    Only the digests that occur twice or more form a table, joined by its measured size; html moves
    only when that table is too large to broadcast, and then a hot digest's rows are split by AQE.
    """
    rows = named_rows(pages, page_id="long", url="string", html="string").withColumn(
        "payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    rows = rows.select("page_id", "url", "html", F.sha1("payload").alias("payload_digest"),
                       (F.octet_length("payload") >= REVISIT_BYTES).alias("large"))
    responses = stored(
        rows.filter("large").groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .filter("n > 1 and response is not null").select("digest", "response"), "responses")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return (rows.join(responses, F.col("large") & (F.col("payload_digest") == F.col("digest")), "left")
            .select("page_id", "url", "html", "payload_digest", refers.alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page into monolithic archives (one gzip stream each); (name) of each archive."""
    Folder(folder).make()

    def run(batches):
        task, target = TaskContext.get(), Folder(folder)
        names, out, deflate, size = [], None, None, 0
        for batch in batches:
            for part in B.slices(batch, "html"):
                for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    if out is None:
                        names.append(f"pages-{task.partitionId():06d}-{len(names):04d}.warc.gz")
                        out = target.write(names[-1], task.taskAttemptId())
                        deflate, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
                    data = record(page_id, url, (html or "").encode(), digest, refers_to)
                    out.put(deflate.compress(data))
                    size += len(data)
                    if size >= archive_bytes:
                        out.put(deflate.flush())
                        out.done()
                        out = None
        if out is not None:
            out.put(deflate.flush())
            out.done()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    return stored(with_responses(pages).mapInArrow(run, "name string"), "archives")


class Records:
    """The records of a gzip file of any number of members, as a stream."""

    def __init__(self, f):
        # what is inflated already, and how much of it is read: a record copies its own bytes only
        self.chunks, self.ahead, self.at = self._inflated(f), b"", 0

    @staticmethod
    def _inflated(f):
        inflate, data = zlib.decompressobj(31), b""
        while data or (data := f.read(CHUNK)):
            yield inflate.decompress(data, CHUNK)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data = inflate.unused_data or f.read(CHUNK)
                if not data:
                    return
                inflate = zlib.decompressobj(31)
            elif not data:
                while more := inflate.decompress(b"", CHUNK):
                    yield more
        if not inflate.eof:
            raise ValueError("the archive ends inside a gzip member")

    def _more(self) -> bool:
        for data in self.chunks:
            if data:
                self.ahead, self.at = self.ahead[self.at:] + data, 0
                return True
        return False

    def head(self) -> bytes | None:
        """Version line and headers of the next record, with the empty line; None at the end."""
        seen = 0
        while (end := self.ahead.find(b"\r\n\r\n", self.at + seen)) < 0:
            seen = max(0, len(self.ahead) - self.at - 3)
            if not self._more():
                if self.ahead[self.at:].strip():
                    raise ValueError("the archive ends inside a record's head")
                return None
        out, self.at = self.ahead[self.at:end + 4], end + 4
        return out

    def body(self, n: int):
        """The next ``n`` bytes, in chunks."""
        while n:
            if self.at == len(self.ahead) and not self._more():
                raise ValueError("the archive ends inside a record")
            out = self.ahead[self.at:self.at + n]
            self.at += len(out)
            n -= len(out)
            yield out


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if v}


INDEX = {"type": "warc-type", "id": "warc-record-id", "uri": "warc-target-uri",
         "digest": "warc-payload-digest", "refers_to": "warc-refers-to"}


def normalise(names: DataFrame, folder: str, to: str) -> DataFrame:
    """Rewrite the archives ``names`` of ``folder`` into ``to``; (name, records) of each.

    ``<name>`` in ``to`` has a gzip member per record, ``<name>.index`` a JSON line per record.
    """
    Folder(to).make()

    def run(batches):
        source, target, task = Folder(folder), Folder(to), TaskContext.get()
        for batch in batches:
            for name in batch.column("name").to_pylist():
                out = target.write(name, task.taskAttemptId())
                index = target.write(f"{name}.index", task.taskAttemptId())
                n = 0
                with source.read(name) as f:
                    records = Records(f)
                    while (head := records.head()) is not None:
                        said = fields(head)
                        length, start = int(said["content-length"]), out.offset
                        deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                        out.put(deflate.compress(head))
                        for data in records.body(length + 4):
                            out.put(deflate.compress(data))
                        out.put(deflate.flush())
                        line = {"offset": start, "size": out.offset - start,
                                "length": len(head) + length + 4}
                        line |= {k: said[h] for k, h in INDEX.items() if h in said}
                        index.put(json.dumps(line).encode() + b"\n")
                        n += 1
                out.done()
                index.done()
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())],
                                                 ["name", "records"])

    return stored(_one_a_task(names).mapInArrow(run, "name string, records long"), "normalised")


def _one_a_task(names: DataFrame) -> DataFrame:
    """Archives are few large units of work: deal them out evenly (by hash of the name)."""
    n = names.count()
    return names.select("name").repartition(max(1, n), "name") if n > 1 else names.select("name")


def read_records(names: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record of
    normalised archives, found through their indexes; responses are checked against their digest."""
    def run(batches):
        source = Folder(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with source.read(f"{name}.index") as f:
                    index = f.read().splitlines()
                with source.read(name) as f:
                    rows = []
                    for line in map(json.loads, index):
                        rows.append(_row(f, line))
                        if len(rows) == 1000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    return _one_a_task(names).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, url string")


def _row(f, line: dict) -> tuple:
    f.seek(line["offset"])
    data = zlib.decompress(f.read(line["size"]), 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    said = fields(head)
    body = rest[:int(said["content-length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    digest, size = said["warc-payload-digest"].removeprefix("sha1:"), int(said["x-payload-length"])
    if said["warc-type"] == "response":
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record {said['warc-record-id']} does not match its digest")
    page, refers = said.get("x-page-id"), said.get("x-refers-to-page")
    return (None if page is None else int(page), size, digest, said["warc-type"],
            None if refers is None else int(refers), said.get("warc-target-uri"))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])


def page_archives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write, normalise and read back; the contract's columns."""
    folder, to = shared_folder(spark, "warc-mono"), shared_folder(spark, "warc-records")
    names = write_archives(pages, folder)
    return read_records(normalise(names, folder, to), to).drop("url")
