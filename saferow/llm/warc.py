"""WARC archives of web pages: written by Spark tasks, read back record by record.

Every record is a gzip member of its own, so a reader can start at any record.
Equal payloads are stored once: of the rows that share one (of ``min_bytes`` bytes
or more) the row with the smallest page id becomes a ``response`` record, the others
``revisit`` records that name it and hold only the HTTP head.  A revisit needs no
payload, so payloads move once, one per distinct content (partial aggregates keep
the copies of a frequent page inside their tasks); the revisits are a join of
narrow rows.

:class:`RecordReader` is sequential and holds no record whole: it inflates a member
piece by piece, frames the block by ``Content-Length``, hashes it on the way and
checks the block digest, the payload digest, the HTTP length, the closing line ends and
gzip's own checksum.  Anything that does not agree raises ``ValueError`` with the
offset of the record.

Each writing task opens files under names of its own attempt and starts another when
one exceeds ``file_bytes``; the manifest (a Parquet table of the tasks that succeeded)
names the files that count, so retried or lost tasks leave no wrong data.

Defined results: null html is the empty payload; a null page id counts as larger than
any other; of rows that agree in page id and payload the one with the smallest url
(null last) is the response, and of rows repeated as a whole one; control characters
and spaces of a url are percent-encoded in the archive; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import filesystem, qualified, stored

# Fixed values of the published format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
#: Bytes that a head (of the record, of HTTP) may have, and of one inflated piece.
MAX_HEAD, PIECE = 1 << 20, 1 << 18
#: Compressed bytes after which a task starts another file.
FILE_BYTES = 1 << 30
#: Rows and payload bytes of one batch a reading task hands on.
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 23


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(seed: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(seed.encode()).digest(), version=3)}>"


# ------------------------------------------------------------------- writing
def http_head(length: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()


def record(kind: str, fields: dict[str, object], block: bytes, level: int = 6) -> bytes:
    """One record as one gzip member; fields of value None are left out."""
    head = {"WARC-Type": kind, **fields, "WARC-Block-Digest": "sha1:" + base32_sha1(block),
            "Content-Length": len(block)}
    lines = [VERSION, *(f"{k}: {v}" for k, v in head.items() if v is not None)]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join((pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n"), pack.compress(block),
                     pack.compress(b"\r\n\r\n"), pack.flush()))


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def page_record(page_id, url, payload: bytes | None, length: int, sha1: str, own: str, first: str, first_page,
                date: str) -> bytes:
    """The record of one row; ``payload`` None makes it a revisit of ``first``."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    fields = {"WARC-Record-ID": own, "WARC-Date": date, "WARC-Target-URI": _uri(url), "Content-Type": HTTP,
              "WARC-Payload-Digest": f"sha1:{digest}", "Page-ID": page_id}
    if payload is None:
        fields |= {"WARC-Refers-To": first, "WARC-Profile": SAME_PAYLOAD, "Refers-To-Page-ID": first_page}
        return record("revisit", fields, http_head(length))
    return record("response", fields, http_head(length) + payload)


def records_of(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per page row: what its record holds (payload null: a revisit)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("body"))
    rows = rows.select("*", F.sha1("body").alias("sha1"), F.md5("body").alias("md5"), F.length("body").alias("size"))
    place = [F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"]
    big = rows.where(F.col("size") >= min_bytes)
    # the rows without their payloads, repeated ones counted
    units = stored(big.groupBy("page_id", "url", "sha1", "md5", "size").agg(F.count(F.lit(1)).alias("n")), "warc-units")
    groups = stored(units.groupBy("sha1", "md5").agg(F.min(F.struct(*place)).alias("first"), F.sum("n").alias("all"))
                    .where("all > 1"), "warc-groups")
    one = big.groupBy("sha1", "md5").agg(F.min(F.struct(*place, "body", "size")).alias("r"))
    responses = one.select("r.page_id", "r.url", "r.body", "r.size", "sha1", "md5", F.lit(0).alias("copy"),
                           F.lit(None).cast("long").alias("first_page"))
    rest = units.join(groups, ["sha1", "md5"])
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    left = (F.col("n") - F.when(is_first, 1).otherwise(0)).cast("int")
    revisits = (rest.withColumn("left", left).where("left > 0")
                .select("page_id", "url", F.lit(None).cast("binary").alias("body"), "size", "sha1", "md5",
                        F.explode(F.sequence(F.lit(1), "left")).alias("copy"), F.col("first.page_id").alias("first_page")))
    out = responses.unionByName(revisits)
    if min_bytes > 0:  # these are never compared
        small = rows.where(F.col("size") < min_bytes).withColumn("copy", -1 - F.monotonically_increasing_id())
        out = out.unionByName(small.withColumn("first_page", F.lit(None).cast("long")), allowMissingColumns=True)
    return out


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives below ``folder``; gives the stored manifest
    (file_no, uri, n_records, n_bytes).  The pages carry no time, so ``date`` is a parameter."""
    folder = qualified(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]):
        part, serial, out, done = TaskContext.get().partitionId(), 0, None, []
        uri, n_records, n_bytes = "", 0, 0

        def finish():
            out.close()
            done.append((part * (1 << 20) + serial, uri, n_records, n_bytes))

        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    uri = f"{folder}/pages-{part:06d}-{serial:04d}-{uuid.uuid4().hex}.warc.gz"
                    system, at = filesystem(uri)
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(at, compression=None)
                    info = record("warcinfo", {"WARC-Record-ID": _urn(uri), "WARC-Date": date,
                                               "Content-Type": "application/warc-fields"}, b"format: WARC/1.1\r\n")
                    out.write(info)
                    n_records, n_bytes = 0, len(info)
                shared = _urn(r["md5"] + r["sha1"])
                own = shared if r["copy"] == 0 else _urn(f"{r['page_id']} {r['url']} {r['md5']} {r['copy']}")
                raw = page_record(r["page_id"], r["url"], r["body"], r["size"], r["sha1"], own, shared,
                                  r["first_page"], date)
                out.write(raw)
                n_records, n_bytes = n_records + 1, n_bytes + len(raw)
                if n_bytes >= file_bytes:
                    finish()
                    out, serial = None, serial + 1
        if out is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("file_no", "uri", "n_records", "n_bytes"), x)) for x in done])

    schema = "file_no long, uri string, n_records long, n_bytes long"
    return stored(records_of(pages, min_bytes).mapInArrow(run, schema), "warc-files")


# ------------------------------------------------------------------- reading
@dataclass
class Record:
    """One record that passed every check; ``payload`` only if it was asked for."""

    offset: int
    fields: dict[str, str]
    payload_bytes: int
    payload_digest: str | None
    payload: bytes | None

    @property
    def kind(self) -> str:
        return self.fields.get("warc-type", "")

    def number(self, name: str) -> int | None:
        return int(self.fields[name]) if name in self.fields else None


def fields_of(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; continued lines are joined."""
    out, last = {}, None
    for line in head.decode("utf-8").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif line:
            name, colon, value = line.partition(":")
            if not colon:
                raise ValueError(f"no field: {line[:80]!r}")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class RecordReader:
    """Iterates over the records of one archive, an open binary stream."""

    def __init__(self, stream, keep_payload: bool = False, piece: int = PIECE):
        self.stream, self.keep, self.piece = stream, keep_payload, piece
        self.raw, self.at = b"", 0  # compressed bytes read but not yet used; offset of the first of them

    def __iter__(self) -> Iterator[Record]:
        while self.raw or self._more():
            offset = self.at
            try:
                yield self._record(offset)
            except (ValueError, zlib.error, UnicodeDecodeError) as e:
                raise ValueError(f"record at byte {offset}: {e}") from e

    def _more(self) -> bool:
        self.raw = self.stream.read(self.piece)
        return bool(self.raw)

    def _member(self) -> Iterator[bytes]:
        """The inflated pieces of the next gzip member."""
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            ended = not self.raw and not self._more()
            got = inflate.decompress(self.raw, self.piece)  # may still hold output after the last input
            if ended and not got and not inflate.eof:
                raise ValueError("the archive ends inside a gzip member")
            rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
            self.at += len(self.raw) - len(rest)
            self.raw = rest
            if got:
                yield got

    def _head(self, pieces: Iterator[bytes], buffer: bytes, limit: int) -> tuple[bytes, bytes]:
        """(bytes before the first empty line, bytes after it)."""
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            got = next(pieces, b"")
            if not got or len(buffer) > limit:
                raise ValueError("a head without an end")
            buffer += got
        return buffer[:end], buffer[end + 4:]

    def _record(self, offset: int) -> Record:
        pieces = self._member()
        head, buffer = self._head(pieces, b"", MAX_HEAD)
        version, _, lines = head.partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no version line: {version[:40]!r}")
        fields = fields_of(lines)
        length = int(fields.get("content-length", -1))
        if length < 0:
            raise ValueError("no Content-Length")
        http = fields.get("content-type", "").startswith("application/http")
        block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
        n, left, http_fields, start = 0, length, None, b""
        while True:
            now, buffer = buffer[:left], buffer[left:]
            left -= len(now)
            block.update(now)
            if http and http_fields is None:  # still in the HTTP head
                start += now
                if (end := start.find(b"\r\n\r\n")) >= 0:
                    http_fields = fields_of(start[:end].partition(b"\r\n")[2])
                    now = start[end + 4:]
                elif len(start) > MAX_HEAD or not left:
                    raise ValueError("an HTTP head without an end")
                else:
                    now = b""
            payload.update(now)
            n += len(now)
            if self.keep:
                kept.append(now)
            if not left:
                break
            buffer = next(pieces, b"")
            if not buffer:
                raise ValueError(f"the block ends {left} bytes early")
        tail = buffer + b"".join(pieces)
        if tail != b"\r\n\r\n":
            raise ValueError("no two line ends after the block")
        digest = "sha1:" + base64.b32encode(block.digest()).decode()
        if fields.get("warc-block-digest", digest) != digest:
            raise ValueError("the block digest does not match")
        said = fields.get("warc-payload-digest")
        if fields.get("warc-type") == "revisit":  # the payload is elsewhere: its length is the one HTTP states
            n = int((http_fields or {}).get("content-length", 0))
        else:
            got = "sha1:" + base64.b32encode(payload.digest()).decode()
            if said is not None and said != got:
                raise ValueError("the payload digest does not match")
            if http_fields is not None and int(http_fields.get("content-length", n)) != n:
                raise ValueError("HTTP states another length")
            said = got
        return Record(offset, fields, n, said.removeprefix("sha1:") if said else None,
                      b"".join(kept) if self.keep else None)


ROW = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
       "record_id string, refers_to_id string, uri string, offset long")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per page record of the files, in order of no kind; with ``payloads``
    also their bytes (null for revisits).  A file with more or fewer records than the
    manifest says is an error."""
    kinds = dict(part.rsplit(" ", 1) for part in ROW.split(", ")) | ({"payload": "binary"} if payloads else {})
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c, types[t]) for c, t in kinds.items()])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for uri, want in zip(b.column("uri").to_pylist(), b.column("n_records").to_pylist()):
                system, at = filesystem(uri)
                rows, held, n = [], 0, 0
                with system.open_input_stream(at, compression=None) as stream:
                    for r in RecordReader(stream, keep_payload=payloads):
                        if r.kind not in ("response", "revisit"):
                            continue
                        revisit, n = r.kind == "revisit", n + 1
                        rows.append((r.number("page-id"), r.payload_bytes, r.payload_digest, r.kind,
                                     r.number("refers-to-page-id") if revisit else None,
                                     r.fields.get("warc-record-id"), r.fields.get("warc-refers-to"), uri, r.offset)
                                    + ((None if revisit else r.payload,) if payloads else ()))
                        held += r.payload_bytes if payloads and not revisit else 0
                        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                             schema=schema)
                            rows, held = [], 0
                if n != want:
                    raise ValueError(f"{uri} has {n} page records, the manifest says {want}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                                     schema=schema)

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (manifest.select("uri", "n_records", "file_no").repartition(n, "file_no").drop("file_no")
            .mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kinds.items())))


def dangling(rows: DataFrame) -> DataFrame:
    """The (refers_to_id, payload_digest) of revisits whose response is not in the
    archives with that digest; empty if all is well."""
    wanted = rows.where("record_type = 'revisit'").select("refers_to_id", "payload_digest").distinct()
    there = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), "payload_digest")
    return wanted.join(there, ["refers_to_id", "payload_digest"], "left_anti")


def read_pages(manifest: DataFrame) -> DataFrame:
    """(page_id, html) of every record, revisits filled from the record they name."""
    rows = stored(read_archives(manifest, payloads=True).select("page_id", "record_id", "refers_to_id", "payload"),
                  "warc-rows")
    own = rows.where("refers_to_id is null").select("page_id", F.col("payload").cast("string").alias("html"))
    source = rows.where("refers_to_id is null").select(F.col("record_id").alias("refers_to_id"),
                                                       F.col("payload").cast("string").alias("html"))
    again = rows.where("refers_to_id is not null").select("page_id", "refers_to_id").join(source, "refers_to_id")
    return own.unionByName(again.select("page_id", "html"))
