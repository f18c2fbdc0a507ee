"""WARC archives: a writer with revisit records and a reader that salvages what damaged archives still hold."""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import attach, scratch, written

#: Payloads from this many bytes on are stored once.
LEAST_SHARED = 100
#: An archive file ends with the record that takes it past this many bytes.
FILE_BYTES = 32 << 20
#: Tasks that read archives, at most: a file each, or several.
READ_TASKS = 20_000
#: Bytes read at a time.
CHUNK = 1 << 20
#: Compressed bytes inflated at a time.
PIECE = 1 << 14

VERSION, MAGIC, END = b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = "path string, offset long, length long, record_id string"
RECORDS = ("path string, kind string, offset long, length long, inner long, reason string, record_type string, record_id string, "
           "uri string, refers_to string, payload_digest string, payload_length long, payload binary")


# -- records as bytes ------------------------------------------------------------------------------------------------

def record_bytes(record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None, length: int) -> bytes:
    """A response with its payload or, if it refers to another record, a revisit without."""
    block = b"" if refers_to else HTTP % length + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((uri or 'urn:none').split())}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {length}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to:
        lines[6:6] = [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + END + block + END


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Bad(Exception):
    """There is no valid record at this place."""


class Source:
    """A seekable stream, of which only a window is kept; the stream itself is read forwards as long as callers go forwards."""

    def __init__(self, stream, size: int | None = None) -> None:
        self.stream, self.base, self.held = stream, 0, b""
        self.size = stream.seek(0, 2) if size is None else size
        stream.seek(0)

    def at(self, start: int, n: int) -> bytes:
        """Bytes start to start + n, or as far as there are."""
        n = max(0, min(n, self.size - start))
        have = self.base + len(self.held)
        if not self.base <= start <= start + n <= have:
            kept = self.held[start - self.base:] if self.base <= start <= have else b""
            if not kept and start != have:
                self.stream.seek(start)
            self.base, self.held = start, kept + self.stream.read(min(max(n - len(kept), CHUNK), self.size - start - len(kept)))
        return self.held[start - self.base:start - self.base + n]

    def find(self, start: int, what: tuple[bytes, ...]) -> int:
        """The first place from start on where one of them begins, or the end."""
        longest = max(map(len, what))
        while start < self.size:
            piece = self.at(start, CHUNK)
            found = [i for i in (piece.find(w) for w in what) if i >= 0]
            if found:
                return start + min(found)
            if start + len(piece) >= self.size:
                break
            start += len(piece) - longest + 1
        return self.size


def plain_record(src: Source, start: int, strict: bool = False) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record at start; Bad if a check fails, or if strict and there is no payload digest to check."""
    if not src.at(start, len(VERSION)) == VERSION:
        raise Bad("no version line")
    n = 4096
    while (stop := (head := src.at(start, n)).find(END)) < 0:
        if len(head) < n or n > CHUNK:
            raise Bad("headers without end")
        n *= 4
    headers = {}
    for line in head[:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header without colon")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdecimal() or not headers.get("warc-type"):
        raise Bad("no length or type")
    body, length = stop + 4, int(headers["content-length"])
    if start + body + length + 4 > src.size:
        raise Bad("record is cut off")
    whole = src.at(start, body + length + 4)
    if whole[-4:] != END:
        raise Bad("no end of record where its length puts it")
    block = whole[body:-4]
    said = headers.get("warc-payload-digest", "")
    known = said.startswith("sha256:") and headers["warc-type"] == "response"
    if known and hashlib.sha256(payload_of(headers, block)).hexdigest() != said[7:]:
        raise Bad("payload digest differs")
    if strict and not known:
        raise Bad("no payload digest to check")
    return headers, block, start + len(whole)


def payload_of(headers: dict, block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(END)[2]
    return block


class Member:
    """What the gzip member at `start` of a source inflates to, as a stream; it ends where the first error is.

    Once measured(), `size` says how much it holds, `error` what is wrong with it (None: nothing), and `end_of` where it
    ends in the source.
    """

    def __init__(self, src: Source, start: int) -> None:
        self.src, self.start = src, start
        self.rewind()

    def rewind(self) -> None:
        self.unpack, self.end, self.wrong, self.place, self.spare, self.done = zlib.decompressobj(31), self.start, None, 0, b"", False

    def more(self) -> None:
        """Inflates a piece; where it is damaged, byte by byte up to the damage."""
        piece = self.src.at(self.end, PIECE)
        if not piece:
            self.wrong, self.done = "gzip member is cut off", True
            return
        before = self.unpack.copy()
        try:
            self.spare += self.unpack.decompress(piece)
            self.end += len(piece) - len(self.unpack.unused_data)
            self.done = self.unpack.eof
        except zlib.error as e:
            try:
                for i in range(len(piece)):
                    self.spare += before.decompress(piece[i:i + 1])
                    self.end += 1
            except zlib.error:
                pass
            self.wrong, self.done = f"gzip: {e}", True

    def read(self, n: int) -> bytes:
        while len(self.spare) < n and not self.done:
            self.more()
        out, self.spare = self.spare[:n], self.spare[n:]
        self.place += len(out)
        return out

    def seek(self, to: int) -> None:
        if to < self.place:
            self.rewind()
        while self.place < to and self.read(min(CHUNK, to - self.place)):
            pass

    def measured(self) -> Member:
        """Reads it once, to know its size, its error and its end."""
        while self.read(CHUNK):
            pass
        self.size, self.error, self.end_of = self.place, self.wrong, self.end
        return self


def within(m: Member) -> Iterator[tuple]:
    """salvage() of what a measured member holds; of a damaged one, only records whose payload digest is right."""
    m.rewind()
    return salvaged(Source(m, m.size), m.error is not None)


def starts_here(src: Source, at: int) -> bool:
    """Whether a record or a member with one begins here."""
    try:
        if src.at(at, 3) != MAGIC:
            return bool(plain_record(src, at))
        m = Member(src, at).measured()
        return any(x[0] == "record" for x in within(m))
    except Bad:
        return False


def next_start(src: Source, at: int) -> int:
    """The next place from `at` on where a record or a member with one begins, or the end."""
    while (at := src.find(at, (MAGIC, VERSION))) < src.size and not starts_here(src, at):
        at += 1
    return at


def member_entries(src: Source, at: int) -> Iterator[tuple]:
    """What salvage() gives for the member at `at`, then ("end", where it ends); Bad if it holds no record."""
    m = Member(src, at).measured()
    wrong, end, lost, early = m.error, m.end_of, m.size, []
    if wrong is not None:
        records = gaps = last = 0
        for kind, inner, *_ in within(m):
            records, gaps, last = records + (kind == "record"), gaps + (kind == "gap"), inner
        if not records or not gaps and ("incorrect" in wrong or records == 1):
            raise Bad(wrong)  # nothing is right, or CRC or length differ and no record says where
        if not gaps:
            lost = last  # nothing vouches for the record at the damage
        end = next_start(src, at + 1)
    for kind, inner, length, _, *rest in within(m):
        if wrong is not None and (inner == lost or kind == "gap" and inner + length == m.size):
            lost = inner  # what the damage leaves is part of the last gap
            break
        entry = (kind, at, end - at, inner, *rest)
        if kind == "gap" and early is not None:
            early.append(entry)
            continue
        yield from early or ()
        early = None
        yield entry
    if early is not None:
        raise Bad("gzip member without a record")
    if wrong is not None:
        yield "gap", at, end - at, lost, wrong
    yield "end", end


def salvaged(src: Source, strict: bool = False) -> Iterator[tuple]:
    at, bad, why = 0, None, ""
    while at < src.size:
        try:
            if src.at(at, 3) == MAGIC:
                entries = member_entries(src, at)
                first = next(entries)
            else:
                headers, block, end = plain_record(src, at, strict)
                entries, first = iter([("end", end)]), ("record", at, end - at, None, headers, block)
        except Bad as e:
            if bad is None:
                bad, why = at, str(e)
            at = next_start(src, at + 1)
            continue
        if bad is not None:
            yield "gap", bad, at - bad, None, why
            bad = None
        yield first
        for entry in entries:
            if entry[0] == "end":
                at = entry[1]
            else:
                yield entry
    if bad is not None:
        yield "gap", bad, src.size - bad, None, why


def salvage(stream) -> Iterator[tuple]:
    """("record", offset, length, inner offset, headers, block) and ("gap", offset, length, inner offset, reason), in order.

    The stream may hold plain records, gzip members of one or more records, or both.  Where a check fails (gzip CRC,
    version line, headers, length, end of record, payload digest) the search goes on at the next byte for a member's
    magic or a version line from which all checks hold; the bytes between are one gap.  Of a damaged member the records
    that hold a right payload digest are given, unless nothing tells where the damage is; its length then reaches to the
    next valid start, and one gap says from which inflated byte on it is lost.  Gaps and records cover the stream without overlap.  Inside
    a member, offsets count in its inflated bytes (inner), else inner is null.  Members are inflated piece by piece, so
    memory holds one record at most.
    """
    yield from salvaged(Source(stream))


# -- files -----------------------------------------------------------------------------------------------------------

def filesystem(path: str):
    """pyarrow's filesystem of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes records to archive files, a gzip member each, and returns the manifest, a written table.

    records: record_id, uri, payload (string), digest, refers_to, payload_length.  A task writes files with names of
    its own; only what its successful attempt lists in the manifest counts, so that lost executors do no harm.
    """
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        out, size, name, rows = None, 0, "", []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                payload = b"" if r.refers_to or r.payload is None else r.payload.encode("utf-8", "surrogatepass")
                data = member(record_bytes(r.record_id, r.uri, payload, r.digest, r.refers_to, int(r.payload_length)))
                out.write(data)
                rows.append((f"{folder}/{name}", size, len(data), r.record_id))
                size += len(data)
                if size >= file_bytes:
                    out.close()
                    out = None
            if rows:
                yield pd.DataFrame(rows, columns=["path", "offset", "length", "record_id"])
                rows = []
        if out is not None:
            out.close()

    return written(records.mapInPandas(put, MANIFEST), "manifest")


def read_archives(paths: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps (column kind) of the archives named in paths.path, one task a file or several.

    payload_digest and payload_length are those of the payload as read, or as a revisit states them.  Empty files give
    no rows.
    """
    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                files, inside = filesystem(path)
                rows, held = [], 0
                with files.open_input_file(inside) as f:
                    for kind, offset, length, inner, *rest in salvage(f):
                        if kind == "gap":
                            rows.append((path, kind, offset, length, inner, rest[0], *[None] * 7))
                            continue
                        h, block = rest
                        digest, n, payload = h.get("warc-payload-digest", "").removeprefix("sha256:") or None, h.get("x-payload-length"), None
                        if h["warc-type"] != "revisit":
                            payload = payload_of(h, block)
                            digest, n = hashlib.sha256(payload).hexdigest(), len(payload)
                            held += len(payload)
                        strip = lambda x: x.strip("<>") if x else None
                        rows.append((path, kind, offset, length, inner, None, h["warc-type"], strip(h.get("warc-record-id")), h.get("warc-target-uri"),
                                     strip(h.get("warc-refers-to")), digest, None if n is None else int(n), payload if payloads else None))
                        if len(rows) >= 1000 or held >= 8 * CHUNK:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return paths.select("path").mapInPandas(get, RECORDS)


def archive(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """pages (page_id, url, html) as archives; returns their manifest.

    Of records with equal payloads of at least least_shared bytes that with the least page_id is the response and the
    others revisit it; a null page_id comes after all others, and rows that repeat page_id and payload of a response
    are responses too.  A null html is an empty payload, and a null url is written as urn:none.  No rows give an empty
    manifest; a very long payload is one record, which the task that writes or reads it holds whole; other columns are
    not read.
    """
    total = pages.count()
    p = pages.select("page_id", F.col("url").alias("uri"), F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumns({"digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    shared = p.filter(F.col("payload_length") >= least_shared).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    p = attach(p, shared, "digest", F.concat_ws(":", "page_id", "uri"), total)
    urn = lambda c: F.concat(F.lit("urn:page:"), c.cast("string"))
    p = p.withColumn("refers_to", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), urn(F.col("first"))))
    p = p.withColumn("record_id", F.coalesce(urn(F.col("page_id")), F.lit("urn:page:null")))
    return write_archives(p.select("record_id", "uri", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
                                   "digest", "refers_to", "payload_length"), scratch(pages.sparkSession, "warc"))


def read_back(manifest: DataFrame, payloads: bool = True, tasks: int = READ_TASKS) -> DataFrame:
    """read_archives() of all files of a manifest, a task to each file as long as there are no more than `tasks`."""
    paths = manifest.select("path").distinct()
    return read_archives(paths.repartition(max(1, min(tasks, paths.count()))), payloads)
