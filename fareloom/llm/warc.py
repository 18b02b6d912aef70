"""WARC archives: one gzip member per record, written by tasks and read back by byte ranges.

Writing: each task writes its rows to files of its own in a shared folder, first under a name of the
attempt, then renamed, so a repeated task replaces its files with the same content. Reading: a task
gets a byte range of a file, looks for the gzip magic, decodes what follows as a WARC header to tell
members from look-alikes, and owns the records that start in its range, also where they end beyond.
Bodies are hashed as they stream by; a record need not fit in memory.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.sources.staging import scratch_path, stage

SPLIT_BYTES = 32 << 20
FILE_BYTES = 1 << 30
BLOCK_BYTES = 1 << 20
LEVEL = 3
MAGIC = b"\x1f\x8b\x08"

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

RECORD_SCHEMA = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)


def _storage(uri: str):
    """File system and path of a folder, from any task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _field(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One record as a gzip member. With `refers_to` it is a revisit, without the payload itself."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    urn = f"{PAGE_URN}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    head = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{urn}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    body = http.encode() + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join((z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"), z.flush()))


def with_first(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to: the smallest page_id with an equal payload, null for that
    row itself and for payloads under `least_bytes` (or where no row with it has an id)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_sha", F.sha1("payload"))
    # Only payloads that occur more than once; the others have nothing to refer to.
    again = (
        rows.groupBy("_sha")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.max(F.length("payload")).alias("_len"))
        .filter((F.col("_n") > 1) & (F.col("_len") >= least_bytes))
        .select("_sha", "_first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.join(again, "_sha", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_warc(rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write page_id, url, payload, refers_to as archives under `folder`; path, bytes, records per file."""

    def run(batches):
        storage, base = _storage(folder)
        task = TaskContext.get()
        storage.create_dir(base, recursive=True)
        out, done = None, []

        def close():
            nonlocal out
            if out is not None:
                stream, draft, final, size, records = out
                stream.close()
                storage.move(draft, final)
                done.append((posixpath.basename(final), size, records))
                out = None

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for page_id, url, payload, refers_to in zip(*columns):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{len(done):04d}.warc.gz"
                    draft = posixpath.join(base, f"_draft-{task.taskAttemptId()}-{name}")
                    out = [storage.open_output_stream(draft, compression=None), draft, posixpath.join(base, name), 0, 0]
                member = record_bytes(page_id, url, payload, refers_to, date)
                out[0].write(member)
                out[3] += len(member)
                out[4] += 1
                if out[3] >= FILE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "bytes": b, "records": r} for f, b, r in done],
            schema=pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]),
        )

    return rows.select("page_id", "url", "payload", "refers_to").mapInArrow(
        run, "file string, bytes bigint, records bigint"
    )


class Member:
    """Decoded gzip member from `start` on; `end` is known once it is read to its end."""

    def __init__(self, stream, start: int, size: int):
        self.stream, self.at, self.size = stream, start, size
        self.z = zlib.decompressobj(31)
        self.pending = b""

    def more(self) -> bytes:
        """Up to BLOCK_BYTES of decoded bytes; empty at the member's end or the file's."""
        while not self.z.eof:
            if not self.pending:
                if self.at >= self.size:
                    return b""
                self.stream.seek(self.at)
                self.pending = self.stream.read(min(BLOCK_BYTES, self.size - self.at))
                self.at += len(self.pending)
            out = self.z.decompress(self.pending, BLOCK_BYTES)
            self.pending = self.z.unconsumed_tail
            if out:
                return out
        return b""

    @property
    def end(self) -> int:
        return self.at - len(self.z.unused_data)


def _until_blank_line(member: Member, got: bytes) -> tuple[bytes, bytes] | None:
    """What comes before the first blank line, however long, and what was read beyond it."""
    parts, last = [], b""
    while got:
        # The blank line may begin in the part before.
        seam = last + got
        cut = seam.find(b"\r\n\r\n")
        if cut >= 0:
            parts.append(seam[:cut])
            return b"".join(parts), seam[cut + 4 :]
        parts.append(seam[:-3])
        last = seam[-3:]
        got = member.more()
    return None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page_of(urn: str | None) -> int | None:
    m = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def read_member(stream, start: int, size: int, with_payload: bool):
    """(row, end) of the record whose member starts at `start`; None if none does.

    A member that begins like a record but is cut off or does not match its digest is an error.
    """
    member = Member(stream, start, size)
    try:
        begin = member.more()
    except zlib.error:
        return None
    if not begin.startswith(b"WARC/1."):
        return None
    try:
        split = _until_blank_line(member, begin)
    except zlib.error as e:
        raise ValueError(f"record at byte {start}: header cannot be decoded") from e
    if split is None:
        raise ValueError(f"record at byte {start}: no end of its header")
    fields, rest = _fields(split[0]), split[1]
    left = int(fields["content-length"])
    split = _until_blank_line(member, rest) if fields.get("content-type", "").startswith("application/http") else (b"", rest)
    if split is None:
        raise ValueError(f"record at byte {start}: no end of its HTTP header")
    http, rest = split
    left -= len(http) + 4 if http else 0
    sha, length, kept = hashlib.sha1(), 0, []
    while True:
        part = rest[:left]
        sha.update(part)
        length += len(part)
        left -= len(part)
        if with_payload:
            kept.append(part)
        rest = member.more()
        if not rest:
            break
    if left or not member.z.eof:
        raise ValueError(f"record at byte {start} is cut off")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        own = base64.b32encode(sha.digest()).decode()
        if digest and own != digest:
            raise ValueError(f"record at byte {start} does not match its digest")
        digest = own
    else:
        length = int(_fields(http).get("content-length", 0))
    row = {
        "page_id": _page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_of(fields.get("warc-refers-to")),
        "payload": b"".join(kept) if with_payload and kind == "response" else None,
    }
    return row, member.end


def records_in(stream, size: int, first: int, last: int, with_payload: bool = False):
    """Records whose members start in bytes [first, last)."""
    at = first
    while at < last:
        stream.seek(at)
        block = stream.read(min(BLOCK_BYTES, last - at) + len(MAGIC) - 1)
        hit = block.find(MAGIC)
        if hit < 0:
            at += max(1, len(block) - len(MAGIC) + 1)
            continue
        if at + hit >= last:
            return
        found = read_member(stream, at + hit, size, with_payload)
        if found is None:
            at += hit + 1
            continue
        yield found[0]
        at = found[1]


def read_warc(files: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """Records (RECORD_SCHEMA) of `files` (file, bytes) under `folder`, by ranges of `split_bytes`.

    `payload` is null for revisits and unless `with_payload` is set.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint")))
    ranges = files.filter("bytes > 0").select("file", "bytes", starts.alias("first"))
    ranges = stage(ranges.withColumn("last", F.least(F.col("first") + split_bytes, F.col("bytes"))), "ranges")
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def run(batches):
        storage, base = _storage(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with storage.open_input_file(posixpath.join(base, r["file"])) as stream:
                    rows, held = [], 0
                    for row in records_in(stream, r["bytes"], r["first"], r["last"], with_payload):
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 * BLOCK_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.repartition(max(1, ranges.count())).mapInArrow(run, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) and read the archives back.

    A null html is an empty payload; a null url leaves out the target; rows without a page_id come
    back without one. Of rows repeated with their page_id, all that have the smallest are responses.
    An empty table writes no archive and gives an empty result. Urls and texts may be of any length.
    Fewer or more records read than were written are an error.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    files = stage(write_warc(with_first(pages, least_bytes), folder), "archives")
    records = stage(read_warc(files, folder, split_bytes), "records")
    written, read = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], records.count()
    if written != read:
        raise ValueError(f"{written} records written, {read} read")
    return records
