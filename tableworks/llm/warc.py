"""WARC archives: write, normalise monolithic gzip to one member per record, index, read back."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import reading, remove, writing
from .kernel import slices
from .scratch import Scratch, finish

CHUNK = 1 << 20
# Fixed text of the WARC 1.1 and HTTP formats.
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def page_of(value: str | None) -> int | None:
    found = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found not in ("", "null") else None


def record(page, url: str | None, payload: bytes, original, first: bool, date: str) -> bytes:
    """One WARC record. A revisit holds the response's header lines but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if first else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if first else 'revisit'}", f"WARC-Record-ID: {urn(page)}",
        "WARC-Target-URI: " + "".join((url or "").split()), f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if not first:
        lines[3:3] = [f"WARC-Refers-To: {urn(original)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + END + block + END


def headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file, one member or several, a chunk at a time."""
    engine = zlib.decompressobj(31)
    data = source.read(CHUNK)
    while data:
        out = engine.decompress(data, CHUNK)
        if out:
            yield out
        if engine.eof:
            data = engine.unused_data or source.read(CHUNK)
            engine = zlib.decompressobj(31)
        else:
            data = engine.unconsumed_tail or source.read(CHUNK)
    rest = engine.flush()
    if rest:
        yield rest


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record; holds one record and one chunk at a time."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        at, searched = held.find(END), 0
        while at < 0:
            searched = max(0, len(held) - len(END))
            if not fill(len(held) + 1):
                if held.strip():
                    raise ValueError("archive ends inside a record")
                return
            at = held.find(END, searched)
        head = bytes(held[:at])
        size = int(headers(head)["content-length"])
        start = at + len(END)
        if not fill(start + size + len(END)):
            raise ValueError("archive ends inside a record")
        block = bytes(held[start:start + size])
        del held[:start + size + len(END)]
        yield head, block


def normalise(source_uri: str, target_uri: str, level: int = 6) -> int:
    """Rewrite an archive so that every record is a gzip member of its own, with a sidecar index.

    The source, one gzip stream over the whole file, is inflated once from
    start to end. ``target_uri + '.idx'`` has a line per record: offset,
    length, type, record id, payload digest. Returns the number of records.
    """
    count = offset = 0
    with reading(source_uri) as source, writing(target_uri) as out, writing(target_uri + ".idx") as index:
        for head, block in split_records(inflated(source)):
            engine = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = engine.compress(head + END + block + END) + engine.flush()
            out.write(member)
            h = headers(head)
            index.write("\t".join([str(offset), str(len(member)), h["warc-type"], h["warc-record-id"], h.get("warc-payload-digest", "-")]).encode() + b"\n")
            offset += len(member)
            count += 1
    return count


def read_indexed(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC header, block) of every record, each found by its index line and inflated alone."""
    with reading(uri + ".idx") as index, reading(uri) as archive:
        for line in index.read().decode().splitlines():
            offset, length, kind, name, digest = line.split("\t")
            archive.seek(int(offset))
            whole = zlib.decompress(archive.read(int(length)), 31)
            head, _, block = whole.partition(END)
            found = headers(head)
            if (found["warc-type"], found["warc-record-id"], found.get("warc-payload-digest", "-")) != (kind, name, digest):
                raise ValueError(f"index of {uri} does not fit its archive at {offset}")
            yield found, block[:int(found["content-length"])]


def payload_key(payload: Column) -> Column:
    return F.sha1(payload.cast("binary"))


def archive_pages(
    pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6, keep: bool = False,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Write pages as WARC archives, normalise them, read them back.

    Returns a row per record as read: page_id, payload_bytes, payload_digest,
    record_type, refers_to, archive. Of pages with equal payloads of at least
    ``least_bytes`` the one with the largest id is the response and the others
    are revisits of it; smaller payloads are all responses.

    1. Payload digests with several pages and their largest page are a table of
       their own, joined to the pages by digest (Spark sends it to the tasks
       only while it is small), so pages without copies are not moved.
    2. Every task streams its pages into one archive, a single gzip stream.
    3. Every archive is normalised by one task (see ``normalise``), and
    4. read back record by record through its index. Digests of responses are
       taken from the payload read; a mismatch with the header is an error. A
       revisit's length is in its HTTP header.

    Null html is an empty payload. A null id is smaller than any other; pages
    that repeat the largest id with the same payload are all responses. An empty
    table gives no rows and no archive. Files appear under their name when
    complete, so tasks can be repeated. With ``keep`` the archives and indexes
    stay in the shared folder under ``archive``.
    """
    scratch = Scratch(pages.sparkSession)
    base = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    narrow = base.filter(F.octet_length("html") >= least_bytes).select("page_id", payload_key(F.col("html")).alias("digest"))
    copies = narrow.groupBy("digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = scratch.write(copies.select(F.col("digest").alias("c_digest"), "original"), "copies")
    joined = base.join(copies, (payload_key(F.col("html")) == F.col("c_digest")) & (F.octet_length("html") >= least_bytes), "left")
    first = F.col("c_digest").isNull() | F.col("page_id").eqNullSafe(F.col("original"))
    rows = joined.select("page_id", "url", "html", "original", first.alias("first"))
    folder = scratch.path("warc") if not keep else Scratch(pages.sparkSession).path("warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uri = f"{folder}/{TaskContext.get().partitionId():06d}.warc.gz"
        parts = slices(batches, "html")
        batch = next(parts, None)
        if batch is None:
            return
        count = 0
        with writing(uri) as out:
            engine = zlib.compressobj(level, zlib.DEFLATED, 31)
            while batch is not None:
                for page, link, text, original, is_first in zip(*(c.to_pylist() for c in batch.columns)):
                    out.write(engine.compress(record(page, link, text.encode("utf-8", "surrogatepass"), original, is_first, date)))
                    count += 1
                batch = next(parts, None)
            out.write(engine.flush())
        yield pa.RecordBatch.from_pydict({"uri": [uri], "records": [count]})

    written = scratch.write(rows.mapInArrow(write, "uri string, records long"), "written")
    archives = max(1, written.count())

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, records in zip(batch["uri"].to_pylist(), batch["records"].to_pylist()):
                target = uri.removesuffix(".warc.gz") + ".records.warc.gz"
                if normalise(uri, target, level) != records:
                    raise ValueError(f"{uri} does not hold {records} records")
                yield pa.RecordBatch.from_pydict({"uri": [target]})

    done = scratch.write(written.repartition(archives).mapInArrow(rewrite, "uri string"), "normalised")

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["uri"].to_pylist():
                remove(uri)
        yield pa.RecordBatch.from_pydict({"n": pa.array([0], pa.int64())})

    # the normalised archives are all there: the monolithic ones can go
    written.mapInArrow(tidy, "n long").count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["uri"].to_pylist():
                out: list[tuple] = []
                for head, block in read_indexed(uri):
                    top, _, payload = block.partition(END)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    is_first = head["warc-type"] == "response"
                    if is_first and base32_sha1(payload) != digest:
                        raise ValueError(f"payload of {head['warc-record-id']} in {uri} is damaged")
                    size = len(payload) if is_first else int(headers(top)["content-length"])
                    out.append((page_of(head["warc-record-id"]), size, digest, head["warc-type"], page_of(head.get("warc-refers-to")), uri))
                    if len(out) == 2000:
                        yield _rows(out)
                        out = []
                if out:
                    yield _rows(out)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string"
    return finish(scratch, done.repartition(archives).mapInArrow(read, schema), "warc-records")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
