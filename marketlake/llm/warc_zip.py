"""WARC records in ZIP archives, and a reader that takes records by range.

Tasks stream their rows into archive volumes of bounded size: ZIP files in the shared
folder, which must be mounted, with stored (uncompressed) members:
``archive/data.warc.gz``, one gzip member a record, and ``indexes/index.cdxj``, a sorted
line a record with its address, time, offset, length and file. The reader needs only
``fetch(offset, length)``: it parses the end record, the ZIP64 locator and
directory where they are present, and the central directory, finds the stored
members, and reads each record by its range in the file; nothing is extracted. Indexes
may be CDXJ, CDX with a line of field letters, or plain lines of key, offset, length and
member, packed or not; they are read piece by piece. A task that runs again writes files
of its own, and only files that a finished task names are read.

A record's id is a UUID of its volume and place, so ids are unique in all jobs. A
revisit names its response by address and time, as WARC 1.1 has it, and by the page's key
in a field of its own. When archives are read, a revisit's length comes from the response
that has this key and the revisit's digest; a revisit without one has no length.

Defined results: a null payload is empty, a null or empty address becomes the record's
own id; repeated keys are records of their own; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from itertools import islice
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mounted, shared_dir, stored

WARC, CDX = "archive/data.warc.gz", "indexes/index.cdxj"
PIECE = 1 << 20
Fetch = Callable[[int, int], bytes]

# Signatures and fixed parts of the ZIP format (fixed values).
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def directory(fetch: Fetch, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Members by name: (local header's offset, stored size, plain size, method).

    Raises ValueError where the end record or an entry's signature is missing.
    """
    tail = fetch(max(0, size - 22 - FULL16), min(size, 22 + FULL16))
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end of a central directory")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end_at = size - len(tail) + at
    if FULL16 == count or FULL32 in (length, offset):
        locator = fetch(end_at - 20, 20)
        if locator[:4] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        (at64,) = struct.unpack_from("<Q", locator, 8)
        end64 = fetch(at64, 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of a central directory")
        count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    listed, members, p = fetch(offset, length), {}, 0
    for _ in range(count):
        if listed[p : p + 4] != ENTRY:
            raise ValueError("no entry of a central directory")
        method, stored, plain = struct.unpack_from("<H8xII", listed, p + 10)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", listed, p + 28)
        (header,) = struct.unpack_from("<I", listed, p + 42)
        name = listed[p + 46 : p + 46 + n_name].decode()
        extra, q = listed[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # ZIP64: only the fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                plain = next(wide) if plain == FULL32 else plain
                stored = next(wide) if stored == FULL32 else stored
                header = next(wide) if header == FULL32 else header
            q += 4 + n
        members[name] = (header, stored, plain, method)
        p += 46 + n_name + n_extra + n_comment
    return members


def member_range(fetch: Fetch, entry: tuple[int, int, int, int]) -> tuple[int, int]:
    """Offset and length of a stored member's bytes; ValueError if it is compressed."""
    header, stored, _, method = entry
    if method:
        raise ValueError("the member isn't stored: its records can't be read by range")
    local = fetch(header, 30)
    if local[:4] != LOCAL:
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return header + 30 + n_name + n_extra, stored


def index_lines(fetch: Fetch, at: int, size: int, packed: bool) -> Iterator[str]:
    """Lines of an index, read in pieces; packed: gzip members, one or several."""
    rest, unpack = b"", zlib.decompressobj(31)
    for start in range(at, at + size, PIECE):
        piece = fetch(start, min(PIECE, at + size - start))
        while packed and piece:
            rest += unpack.decompress(piece)
            piece = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)
            elif not piece:
                break
        *lines, rest = (rest if packed else rest + piece).split(b"\n")
        yield from (x.decode().rstrip("\r") for x in lines)
    if rest:
        yield rest.decode().rstrip("\r")


def places(lines: Iterator[str]) -> Iterator[tuple[int, int, str]]:
    """Offset, length and file of every record that an index lists; ValueError for a line of another form."""
    letters: list[str] = []
    for line in lines:
        if not line.strip() or line.startswith("!meta"):
            continue
        if line.startswith(" CDX "):
            letters = line.split()[1:]  # S, V, g: length, offset, file
        elif line.endswith("}") and "{" in line:
            block = json.loads(line[line.index("{") :])
            yield int(block["offset"]), int(block["length"]), block["filename"]
        elif letters:
            fields = line.split()
            yield int(fields[letters.index("V")]), int(fields[letters.index("S")]), fields[letters.index("g")]
        else:
            _, offset, length, name = line.rsplit(" ", 3)
            yield int(offset), int(length), name


def records(fetch: Fetch, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record that the archive's index lists.

    A file is named by its member or, as is common, without the folder ``archive/``; ValueError if there is no such member.
    """
    members = directory(fetch, size)
    starts: dict[str, int] = {}
    for index in sorted(m for m in members if re.fullmatch(r"indexes/.+\.cdxj?(\.gz)?", m)):
        for offset, length, name in places(index_lines(fetch, *member_range(fetch, members[index]), index.endswith(".gz"))):
            if name not in starts:
                member = next((m for m in (name, f"archive/{name}") if m in members), None)
                if member is None:
                    raise ValueError(f"the index names {name}, which the package lacks")
                starts[name] = member_range(fetch, members[member])[0]
            raw = zlib.decompress(fetch(starts[name] + offset, length), 31)
            head, _, block = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            fields = {k.lower(): v for k, v in fields.items()}
            yield fields, block[: int(fields["content-length"])]


def url_key(url: str) -> str:
    """An address as indexes sort it: the host's labels from the last one on, then the rest, without blanks."""
    rest = url.partition("://")[2] or url
    host = re.match(r"[^/?#]*", rest)[0]
    return f"{','.join(reversed(host.lower().split('.')))}){rest[len(host) :]}".replace(" ", "%20")


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC 1.1 record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    raw = b"WARC/1.1\r\n" + f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packed = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packed.compress(raw) + packed.flush()


class Volume:
    """A ZIP file in the making. zip64: with ZIP64 fields, whatever the size."""

    def __init__(self, out: BinaryIO, zip64: bool = True):
        self.zip, self.zip64, self.lines, self.size = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED), zip64, [], 0
        self.name = uuid.uuid4()
        self.member = self.zip.open(zipfile.ZipInfo(WARC), "w", force_zip64=zip64)

    def next_id(self) -> str:
        """The id of the record that is appended next."""
        return f"urn:uuid:{uuid.uuid5(self.name, str(self.size))}"

    def add(self, key: str, raw: bytes, **more: str) -> None:
        """Appends a record, one gzip member, with its line of the index; the key is an address as indexes sort it, and a time."""
        block = more | {"filename": WARC.rpartition("/")[2], "offset": str(self.size), "length": str(len(raw))}
        self.lines.append(f"{key} {json.dumps(block)}\n")
        self.size += len(raw)
        self.member.write(raw)

    def close(self, ordered: bool = False) -> None:
        """Writes the index, in the records' order or that of their keys, and the directory."""
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(CDX), "w", force_zip64=self.zip64) as index:
            index.write("".join(sorted(self.lines) if ordered else self.lines).encode())
        self.zip.close()


def web_record(key: int | None, url: str | None, payload: str, digest: str, refers: int | None, date: str, own: str | None = None, refers_url: str | None = None) -> bytes:
    """A response with the payload in an HTTP message, or a revisit with the message's head alone.

    own: the record's id; the page's key stands in fields of its own then. Without it the id is the key.
    """
    page = f"urn:page:{'' if key is None else key}"
    plain = lambda x, name: quote(x, safe="!#$%&'()*+,/:;=?@[]~") if x else name
    raw = payload.encode()
    fields = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<{own or page}>",
        "WARC-Date": date,
        "WARC-Target-URI": plain(url, page),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if own:
        fields["Page-Key"] = f"<{page}>"
    if refers is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        first = f"urn:page:{refers}"
        fields |= {"WARC-Refers-To-Target-URI": plain(refers_url, first), "WARC-Refers-To-Date": date, "Page-Refers-To": f"<{first}>"} if own else {"WARC-Refers-To": f"<{first}>"}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}\r\n\r\n".encode()
    return record(fields, head + (raw if refers is None else b""))


def mark_revisits(pages: DataFrame, key: str, payload: str, url: str, least: int = 100) -> DataFrame:
    """Of ``pages``: ``_key``, ``_url``, ``_payload`` (null: empty), ``_bytes``, ``_digest``, ``_refers`` (null: a response) and ``_refers_url``.

    Of equal payloads of ``least`` bytes or more, the one with the smallest key is the
    response. The smallest key of each repeated digest is found with partial sums
    before the shuffle; only digests that occur twice are joined back, and smaller
    payloads, which many pages may share, take no part in that join.
    """
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"), F.coalesce(F.col(payload), F.lit("")).alias("_payload")).withColumns(
        {"_bytes": F.octet_length("_payload").cast("long"), "_digest": F.sha2(F.encode("_payload", "UTF-8"), 256)}
    )
    large = rows.where(F.col("_bytes") >= least)
    first = large.groupBy("_digest").agg(F.min("_key").alias("_first"), F.min_by("_url", F.struct("_key", "_url")).alias("_first_url"), F.count("*").alias("_n")).where("_n > 1 AND _first IS NOT NULL")
    out = large.join(first.drop("_n"), "_digest", "left").select(*rows.columns, "_first", "_first_url")
    again = F.col("_first").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_first"))
    out = out.withColumns({"_refers": F.when(again, F.col("_first")), "_refers_url": F.when(again, F.col("_first_url"))}).drop("_first", "_first_url")
    return out.unionByName(rows.where(F.col("_bytes") < least), allowMissingColumns=True)


def write_archives(marked: DataFrame, volume_bytes: int = 16 << 20, zip64: bool = True) -> DataFrame:
    """Rows of ``mark_revisits`` written to volumes of about ``volume_bytes``: one row a volume, its ``path`` and ``size``."""
    folder = mounted(shared_dir(marked.sparkSession, "warc"))
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")  # one for all, however often a task runs
    stamp = re.sub("[^0-9]", "", date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, volume = None, None

        def done() -> pa.RecordBatch:
            volume.close(ordered=True)
            out.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([out.name]), "size": pa.array([os.path.getsize(out.name)], pa.int64())})

        for batch in batches:
            for key, url, payload, digest, refers, refers_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if volume is None:
                    out = open(f"{folder}/{uuid.uuid4().hex}.zip", "wb")  # noqa: SIM115
                    volume = Volume(out, zip64)
                raw = web_record(key, url, payload, digest, refers, date, volume.next_id(), refers_url)
                volume.add(f"{url_key(url or '')} {stamp}", raw, url=url or "", digest=f"sha256:{digest}", status="200", mime="text/html")
                if volume.size >= volume_bytes:
                    yield done()
                    volume = None
        if volume is not None:
            yield done()

    written = marked.select("_key", "_url", "_payload", "_digest", "_refers", "_refers_url").mapInArrow(write, "path string, size long")
    return stored(written, "volumes")


def read_archives(volumes: DataFrame, volumes_a_task: int = 4, payloads: bool = True) -> DataFrame:
    """Records of the volumes (path, size): key, url, record_type, refers_to, payload (null for revisits, or if not asked for), payload_bytes and payload_digest.

    A response's length and digest are taken from its payload as read; one that
    disagrees with its header raises ValueError. A revisit's length is that of the
    response it refers to, if that one has the revisit's digest, else null. Records
    are read once without their payloads for that, and once more if these are wanted.
    """
    tasks = max(1, -(-volumes.count() // volumes_a_task))
    heads = stored(_read(volumes, tasks, False), "records")
    first = heads.where("record_type = 'response'").groupBy(F.col("key").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = heads.where("record_type = 'revisit'").drop("payload_bytes").join(first, ["refers_to", "payload_digest"], "left").select(*heads.columns)
    own = _read(volumes, tasks, True) if payloads else heads
    return own.where("record_type = 'response'").unionByName(revisits)


def _read(volumes: DataFrame, tasks: int, payloads: bool) -> DataFrame:
    schema = pa.schema([
        ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ])

    def number(*found: str | None) -> int | None:
        digits = next((x for x in found if x), "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def one(fields: dict[str, str], block: bytes) -> tuple:
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        whole = fields["warc-type"] == "response"
        if whole and (len(payload), hashlib.sha256(payload).hexdigest()) != (int(head.rpartition(b": ")[2]), digest):
            raise ValueError(f"record {fields['warc-record-id']} is damaged")
        refers = None if whole else number(fields.get("page-refers-to"), fields.get("warc-refers-to"))
        key = number(fields.get("page-key"), fields["warc-record-id"])
        return key, fields["warc-target-uri"], fields["warc-type"], refers, payload.decode() if whole and payloads else None, len(payload) if whole else None, digest

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open(path, "rb") as f:

                    def fetch(at: int, n: int, f: BinaryIO = f) -> bytes:
                        f.seek(at)
                        return f.read(n)

                    found = (one(*r) for r in records(fetch, size))
                    while rows := list(islice(found, 500)):
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    kinds = "key long, url string, record_type string, refers_to long, payload string, payload_bytes long, payload_digest string"
    return volumes.select("path", "size").repartition(tasks).mapInArrow(read, kinds)
