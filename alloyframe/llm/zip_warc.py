"""WARC records in ZIP packages: a writer, and a reader that takes single records by range.

A package is a ZIP file whose members are stored, not deflated: archive/data.warc.gz with one gzip member per
record, indexes/index.cdxj with a line per record, and datapackage.json. The reader parses the end record, the
ZIP64 locator and end record where they are needed, and the central directory; it finds where a member's bytes start
from the local header, reads the index, and then reads only the byte ranges of the records it is asked for.
Nothing is extracted, and files are opened through pyarrow's file systems, so that the folder may be remote.

Packages of other writers are read too: any number of WARC members under archive/, with or without gzip, indexes whose
lines name the member, packed indexes, and members that no index speaks of, which are then walked through record by
record. Record ids may be of any form and record types any.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.llm.common import maybe_broadcast, scratch, slices, stage, text_key

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Bytes of compressed records after which a writer starts another package.
PACKAGE_BYTES = 256 << 20
#: Bytes that one range read covers at most, unless a single record is longer.
RANGE_BYTES = 4 << 20
#: Ranges that one task reads, about, once there are enough of them for all cores.
TASK_RANGES = 16


# --- ZIP -------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored: int
    crc: int
    header: int


class ZipReader:
    """The directory of a ZIP file that is read by seek and read only."""

    END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}

    def at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        out = self.file.read(length)
        if len(out) != length:
            raise ValueError(f"the package ends within bytes {start} to {start + length}")
        return out

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 65_557)  # the end record and the longest comment
        tail = self.at(tail_at, self.size - tail_at)
        end = tail.rfind(self.END)
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(self.END, 0, end)
        if end < 0:
            raise ValueError("no end record: not a ZIP package")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if count == 0xFFFF or 0xFFFFFFFF in (length, start):
            where = tail_at + end - 20
            sign, _, end64, _ = struct.unpack("<4sIQI", self.at(where, 20))
            if sign != self.LOCATOR:
                raise ValueError("the ZIP64 locator is missing")
            head = self.at(end64, 56)
            if head[:4] != self.END64:
                raise ValueError("the ZIP64 end record is missing")
            count, length, start = struct.unpack_from("<QQQ", head, 32)
        data, at = self.at(start, length), 0
        for _ in range(count):
            if data[at : at + 4] != self.ENTRY:
                raise ValueError("the central directory is damaged")
            flags, method, _, _, crc, stored, size, n_name, n_extra, n_comment, _, _, _, header = struct.unpack_from("<HHHHIIIHHHHHII", data, at + 8)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            size, stored, header = self._wide(extra, size, stored, header)
            yield Member(name, method, size, stored, crc, header)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Values whose 32-bit fields are full stand in the ZIP64 extra field, in this order."""
        out, at = list(values), 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                place = at + 4
                for i, v in enumerate(out):
                    if v == 0xFFFFFFFF:
                        (out[i],) = struct.unpack_from("<Q", extra, place)
                        place += 8
            at += 4 + n
        return out

    def data_start(self, name: str) -> int:
        """Where a stored member's bytes begin; its local header may have other extra fields than the directory."""
        member = self.members[name]
        if member.method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self.at(member.header, 30)
        if head[:4] != self.LOCAL:
            raise ValueError(f"{name} has no local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return member.header + 30 + n_name + n_extra

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        member = self.members[name]
        return self.at(self.data_start(name) + start, member.stored - start if length is None else length)

    def whole(self, name: str) -> bytes:
        """All bytes of a small member, which may be deflated, or a file of gzip."""
        member = self.members[name]
        if member.method == 8:
            stored = ZipReader.__new__(ZipReader)
            stored.file, stored.members = self.file, {name: replace(member, method=0)}
            data = zlib.decompress(stored.read(name), -15)
        else:
            data = self.read(name)
        return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


# --- WARC ------------------------------------------------------------------------------------------------------
def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


PAGE = "urn:page:"


def record_id(page_id: int | None, payload: bytes = b"") -> str:
    """The record's id; a page without an id gets one of its payload."""
    return f"<{PAGE}{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, base32_sha1(payload))}>"


def page_of(identifier: str | None) -> int | None:
    """The page that a record id of ours names; of others none."""
    own = (identifier or "").strip().removeprefix("<").removesuffix(">")
    number = own.removeprefix(PAGE)
    return int(number) if own.startswith(PAGE) and number.lstrip("-").isdigit() else None


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that names the response and has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, payload),
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": record_id(refers_to), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head.items()), "\r\n"]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space goes on with the one before it."""
    out, name = {}, ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            out[name := name.strip().lower()] = value.strip()
    return out


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0 and (n := int(body[at:end].split(b";")[0], 16)):
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
    return b"".join(out)


def parse_record(data: bytes) -> dict:
    """What one record says: ids, url, type, payload with its length and digest, and which record it refers to.

    The payload of a record that holds an HTTP response is the response's body, of others the block. A revisit has
    none, and the length that its response's header states, if it does. A stated SHA-1 digest is checked.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block, kind = rest[: int(fields["content-length"])], fields["warc-type"]
    payload, length = block, None
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = _fields(http)
        if said.get("transfer-encoding", "").lower() == "chunked":
            payload = _unchunked(payload)
        length = int(said["content-length"]) if said.get("content-length", "").isdigit() else None
    digest = fields.get("warc-payload-digest", "")
    algorithm, _, value = digest.rpartition(":")
    if kind != "revisit":
        length, own = len(payload), base32_sha1(payload)
        if algorithm.lower() == "sha1" and value.upper() != own and value.lower() != hashlib.sha1(payload).hexdigest():
            raise ValueError(f"the payload of {fields.get('warc-record-id')} does not match its digest")
        value = own
    return {
        "page_id": page_of(fields.get("warc-record-id")), "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"), "payload": None if kind == "revisit" else payload, "payload_bytes": length,
        "payload_digest": value or None, "record_type": kind, "refers_to": page_of(fields.get("warc-refers-to")), "refers_to_id": fields.get("warc-refers-to"),
    }


def unpacked(data: bytes) -> bytes:
    """A record's bytes, which may be a gzip member."""
    return zlib.decompress(data, wbits=31) if data[:2] == b"\x1f\x8b" else data


def surt(url: str | None) -> str:
    """A URL as index lines are sorted by: the host from its end, then the path; no spaces."""
    rest = (url or "").split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    key = ",".join(reversed(host.lower().split(":")[0].removeprefix("www.").split("."))) + ")" + (slash + path).lower()
    return "".join("%20" if c.isspace() else c for c in key)


class PackageWriter:
    """One package, written front to back."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str, wide: bool = False):
        self.out = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.wide, self.member, self.at, self.index = wide, self.zip.open(WARC_MEMBER, "w", force_zip64=True), 0, io.BytesIO()

    def add(self, url: str | None, record: bytes) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.member.write(packed)
        entry = {"filename": WARC_MEMBER.rsplit("/", 1)[1], "offset": str(self.at), "length": str(len(packed))}
        self.index.write(f"{surt(url)} 19700101000000 {json.dumps(entry)}\n".encode())
        self.at += len(packed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX_MEMBER, "w", force_zip64=self.wide) as f:
            f.write(self.index.getvalue())
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "resources": [{"path": WARC_MEMBER}, {"path": INDEX_MEMBER}]}))
        self.zip.close()
        self.out.close()


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pyarrow.fs.LocalFileSystem(), uri)


# --- Spark -----------------------------------------------------------------------------------------------------
def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write rows (page_id, url, html, refers_to) as WARC records into packages under a shared folder.

    Returns the packages of the tasks that succeeded: (path, size, n_records). A task that is tried again writes
    under another name, and a package that no returned row names is never read.
    """

    def run(batches):
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        writer, name, n, done = None, "", 0, []
        for part in slices(batches):
            for page_id, url, html, refers_to in zip(*(part.column(k).to_pylist() for k in ("page_id", "url", "html", "refers_to")), strict=True):
                if writer is None:
                    name, n = f"{uuid.uuid4().hex}.wacz", 0
                    writer = PackageWriter(fs, f"{root}/{name}")
                writer.add(url, warc_record(page_id, url, (html or "").encode("utf-8", "replace"), refers_to))
                n += 1
                if writer.at >= package_bytes:
                    writer.close()
                    done.append((name, n))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((name, n))
        sizes = [fs.get_file_info(f"{root}/{x}").size for x, _ in done]
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x}" for x, _ in done], pa.string()), pa.array(sizes, pa.int64()), pa.array([k for _, k in done], pa.int64())], names=["path", "size", "n_records"])

    return stage(records.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, size long, n_records long"), "packages")


def _walk(archive: ZipReader, name: str, block: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a member that no index speaks of, reading it block by block."""
    size, at = archive.members[name].stored, 0
    while at < size:
        begin, data = at, archive.read(name, at, min(block, size - at))
        if data[:2] == b"\x1f\x8b":
            unpack = zlib.decompressobj(wbits=31)
            while not unpack.eof:
                if not data:
                    raise ValueError(f"{name} ends within a record")
                unpack.decompress(data)
                at += len(data) - len(unpack.unused_data)
                data = b"" if unpack.eof or at >= size else archive.read(name, at, min(block, size - at))
        else:
            while (end := data.find(b"\r\n\r\n")) < 0 and begin + len(data) < size:
                data += archive.read(name, begin + len(data), min(block, size - begin - len(data)))
            if end < 0:
                raise ValueError(f"{name} ends within a record")
            at = begin + end + 4 + int(_fields(data[:end])["content-length"]) + 4
        yield begin, at - begin


def _entries(archive: ZipReader) -> dict[str, list[tuple[int, int]]]:
    """Offset and length of the records of each WARC member, in order, by the indexes, else by walking."""
    members = [n for n in archive.members if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))]
    found: dict[str, set[tuple[int, int]]] = {}
    for name in archive.members:
        if name.startswith("indexes/") and name.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")):
            for line in archive.whole(name).splitlines():
                at = line.find(b"{")
                if at < 0:
                    continue
                entry = json.loads(line[at:])
                if "offset" in entry and "length" in entry:
                    of = "archive/" + entry["filename"].removeprefix("archive/") if "filename" in entry else members[0]
                    found.setdefault(of, set()).add((int(entry["offset"]), int(entry["length"])))
    return {m: sorted(found[m]) if m in found else list(_walk(archive, m)) for m in members}


def list_ranges(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of whole neighbouring records in packages (path, size): (path, start, lengths).

    Of a package with an index only the directories and the index are read.
    """

    def run(batches):
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                fs, name = _open(path)
                out: list[tuple[str, int, list[int]]] = []
                with fs.open_input_file(name) as file:
                    archive = ZipReader(file, size)
                    for member, entries in _entries(archive).items():
                        base, total, end = archive.data_start(member), 0, None
                        for offset, length in entries:
                            if offset != end or total + length > range_bytes:
                                out.append((path, base + offset, []))
                                total = 0
                            out[-1][2].append(length)
                            total, end = total + length, offset + length
                cols = list(zip(*out, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return packages.mapInArrow(run, "path string, start long, lengths array<long>")


#: What a read record gives, as Arrow and as Spark have it.
RECORD = {
    "page_id": (pa.int64(), "long"), "record_id": (pa.string(), "string"), "url": (pa.string(), "string"), "payload_bytes": (pa.int64(), "long"), "payload_digest": (pa.string(), "string"),
    "record_type": (pa.string(), "string"), "refers_to": (pa.int64(), "long"), "refers_to_id": (pa.string(), "string"), "payload": (pa.binary(), "binary"),
}


def read_ranges(ranges: DataFrame, payload: bool = False) -> DataFrame:
    """Parse the records of the ranges; payloads are returned only if asked for, but checked against their digests."""
    kinds = {k: v for k, v in RECORD.items() if payload or k != "payload"}

    def run(batches):
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(k).to_pylist() for k in ("path", "start", "lengths")), strict=True):
                fs, name = _open(path)
                with fs.open_input_file(name) as file:
                    file.seek(start)
                    data = file.read(sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    rows.append(parse_record(unpacked(data[at : at + n])))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (t, _) in kinds.items()], names=list(kinds))

    return ranges.mapInArrow(run, ", ".join(f"{k} {t}" for k, (_, t) in kinds.items()))


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages with refers_to: the largest page_id of equal payloads of at least so many bytes, null for that page itself.

    Rows that repeat a page_id and its payload are all responses if the page_id is the largest. A row without a
    page_id comes before all others: it refers to the largest, and is a response if there is none. A null html is an
    empty payload.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html", F.when(F.octet_length(body) >= least_bytes, text_key(body)).alias("same"))
    groups = keyed.where("same is not null").groupBy("same").agg(F.max("page_id").alias("largest"), F.min("page_id").alias("least"), F.count_if(F.col("page_id").isNull()).alias("none"))
    groups = stage(groups.where("largest != least or (none > 0 and largest is not null)").select("same", "largest"), "revisits")
    refers_to = F.when(~F.col("largest").eqNullSafe(F.col("page_id")), F.col("largest"))
    return keyed.join(maybe_broadcast(groups, 100_000), "same", "left").select("page_id", "url", "html", refers_to.alias("refers_to"))


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write every page to packages in the shared folder, and read all records back from them by range.

    Every row gives a record and a row, without a page_id too; url and html may be null, html may be empty or very
    long; other columns are not read; an empty table writes nothing and gives an empty result.
    """
    folder = scratch(pages.sparkSession, "packages")
    packages = write_packages(with_revisits(pages, least_bytes), folder)
    ranges = stage(list_ranges(packages), "ranges")
    n = ranges.count()
    return read_ranges(ranges.repartition(max(1, min(n, max(pages.sparkSession.sparkContext.defaultParallelism, n // TASK_RANGES)))))
