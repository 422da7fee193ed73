"""WARC in ZIP packages (4): directories are parsed here, members are located, records are read by byte range.

A package is a ZIP file with stored members only: ``archive/records.warc.gz``, a gzip member per record, and ``indexes/records.jsonl``, a line per
record with its offset and length in the archive member.  The reader looks at the end of the file, follows the ZIP64
locator where there is one, reads the central directory and the local header of a member, and then asks for single
ranges: nothing is extracted.

Packages of other writers may hold any archive members below ``archive/`` and indexes below ``indexes/``, paired by
the name without folder and suffixes (a single one of each is a pair under any names); what can't be read by ranges is named in an error, not passed over.
"""

from __future__ import annotations

import gzip
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm._common import map_arrow, open_folder, pick, sent, shared_folder, slices, staged

ARCHIVE, INDEX = "archive/records.warc.gz", "indexes/records.jsonl"
#: a package is closed at the first record beyond so many bytes
PACKAGE_BYTES = 64_000_000
LEAST_REVISIT = 1000
#: Fixed values of the ZIP format: signatures, the marks of fields that ZIP64 holds, and the id of its extra field.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL32, FULL16, ZIP64_EXTRA = 0xFFFFFFFF, 0xFFFF, 1
#: Fixed value: the date written for every member, 1980-01-01.
DAY = 0x21


class PackageWriter:
    """Writes stored members one after another to a stream; directories are always written with ZIP64 records too."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, parts: list[bytes]) -> None:
        crc = size = 0
        for part in parts:
            crc, size = zlib.crc32(part, crc), size + len(part)
        begin, raw = self.at, name.encode()
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, size, size)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, DAY, crc, FULL32, FULL32, len(raw), len(extra)) + raw + extra)
        for part in parts:
            self._put(part)
        self.members.append((raw, crc, size, begin))

    def close(self) -> None:
        begin = self.at
        for raw, crc, size, offset in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, size, size, offset)
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, DAY, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32) + raw + extra)
        size, end64, n = self.at - begin, self.at, len(self.members)
        self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, begin))
        self._put(LOCATOR + struct.pack("<IQI", 0, end64, 1))
        self._put(END + struct.pack("<HHHHIIH", FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))


def stem(member: str) -> str:
    """What an index and its archive member have in common: the path below the first folder, without suffixes."""
    return re.sub(r"(\.(warc|gz|jsonl|json|cdxj|cdx|idx))+$", "", member.partition("/")[2])


class Package:
    """A ZIP file read by ranges: ``members`` maps names to (offset of the data, size).

    ``unread`` names members that are compressed or encrypted and so have no ranges; ``twice`` names that occur again.
    """

    def __init__(self, source):
        self.source = source
        size = source.size() if callable(source.size) else source.size
        tail_at = max(0, size - 22 - FULL16)
        tail = self.read(tail_at, size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        disk, _, _, count, length, begin, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
        if FULL16 in (disk, count) or FULL32 in (length, begin):
            mark = self.read(tail_at + at - 20, 20)
            if mark[:4] == LOCATOR:
                record = self.read(struct.unpack_from("<Q", mark, 8)[0], 56)
                if record[:4] != END64:
                    raise ValueError("no ZIP64 end record")
                count, length, begin = struct.unpack_from("<QQQ", record, 32)
        self.members, self.unread, self.twice = {}, [], []
        for name, place in self._directory(self.read(begin, length), count):
            if name in self.members or name in self.unread:
                self.twice.append(name)
            if place is None:
                self.unread.append(name)
            else:
                self.members[name] = place

    def pairs(self) -> list[tuple[str, str]]:
        """Indexes with their archive members; an error names all that is missing, compressed, double or without its other half."""
        inside = lambda names, folder: sorted(n for n in names if n.startswith(folder) and not n.endswith("/"))
        archives, indexes = inside(self.members, "archive/"), inside(self.members, "indexes/")
        wrong = [f"{n} is compressed or encrypted" for f in ("archive/", "indexes/") for n in inside(self.unread, f)]
        wrong += [f"{n} occurs again" for f in ("archive/", "indexes/") for n in inside(self.twice, f)]
        if not wrong and len(archives) == len(indexes) == 1:
            return [(indexes[0], archives[0])]
        unread = {f: {stem(n) for n in inside(self.unread, f)} for f in ("archive/", "indexes/")}
        by_stem: dict[str, list[str]] = {}
        for n in archives:
            by_stem.setdefault(stem(n), []).append(n)
        found, used = [], set()
        for n in indexes:
            mine = by_stem.get(stem(n), [])
            if len(mine) == 1 and mine[0] not in used:
                found.append((n, mine[0]))
                used.add(mine[0])
            elif stem(n) not in unread["archive/"]:
                wrong.append(f"{n} has no archive member of its own")
        wrong += [f"{n} has no index" for n in archives if n not in used and stem(n) not in unread["indexes/"]]
        if wrong or not found:
            raise ValueError("; ".join(wrong) or "no archive members and indexes")
        return found

    def read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("file is cut short")
        return data

    def _directory(self, raw: bytes, count: int) -> Iterator[tuple[str, tuple[int, int] | None]]:
        at = 0
        for _ in range(count):
            if raw[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, size, n_name, n_extra, n_note, _, _, _, offset = struct.unpack_from("<IIHHHHHII", raw, at + 20)
            name, at = raw[at + 46 : at + 46 + n_name], at + 46 + n_name
            packed, size, offset = self._wide(raw[at : at + n_extra], packed, size, offset)
            at += n_extra + n_note
            place = None
            if method == 0 and not flags & 1:  # stored and plain: only such members have ranges to read
                n_name, n_extra = struct.unpack_from("<HH", self.read(offset, 30), 26)
                place = offset + 30 + n_name + n_extra, size
            yield name.decode("utf-8" if flags & 0x800 else "cp437"), place

    @staticmethod
    def _wide(extra: bytes, packed: int, size: int, offset: int) -> tuple[int, int, int]:
        """Fields from the ZIP64 extra field, which holds those that are full in the entry, in this order."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            at += 4
            if kind == ZIP64_EXTRA:
                place = at
                values = []
                for value in (size, packed, offset):
                    if value == FULL32:
                        value = struct.unpack_from("<Q", extra, place)[0]
                        place += 8
                    values.append(value)
                size, packed, offset = values
            at += n
        return packed, size, offset

    def range(self, member: str, at: int, size: int) -> bytes:
        begin, length = self.members[member]
        if not 0 <= at <= at + size <= length:
            raise ValueError("range outside the member")
        return self.read(begin + at, size)


def record(kind: str, name: str, payload: bytes, headers: dict[str, str]) -> bytes:
    """A WARC record with an HTTP response block (its header only for a revisit)."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:x-page:{name}>", "WARC-Date": "1970-01-01T00:00:00Z", "Content-Type": "application/http; msgtype=response"} | headers
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``(page_id, url, payload, size, digest, target)``; ``target`` is the largest id of an equal payload, if another.

    Payloads are compared by digest and size, pre-aggregated by task; only ids and digests move for that.
    """
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    brief = rows.where(F.col("size") >= least).select("page_id", "size", "digest")
    groups = brief.groupBy("digest", "size").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = brief.join(groups, ["digest", "size"]).where("page_id <> target").select("page_id", "digest", "target").distinct()
    return rows.join(later, ["page_id", "digest"], "left")


def write_packages(pages: DataFrame, folder: str | None = None, package_bytes: int = PACKAGE_BYTES, least: int = LEAST_REVISIT, **named: str) -> tuple[str, DataFrame]:
    """Write a record per page into packages; returns the folder and the written files ``(file, records)``.

    Of pages with equal payloads of ``least`` bytes or more, that with the largest id is a response and the others are
    revisits that refer to it.  A null text is an empty payload and a null url is left out; a null id is written as
    such and never revisits; rows that share an id and a payload are written alike.  Files have names of their own:
    a task that runs twice leaves an unnamed file and no double record.  An empty table writes no file.
    """
    folder = folder or shared_folder(pages.sparkSession, "packages")
    schema = StructType.fromDDL("file string, records long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target_folder = open_folder(folder)
        part, held, lines, size = TaskContext.get().partitionId(), [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal held, lines, size
            file = f"{part:06d}-{uuid.uuid4().hex}.zip"
            with target_folder.create(file) as out:
                package = PackageWriter(out)
                package.add(ARCHIVE, held)
                package.add(INDEX, lines)
                package.close()
            row = pa.RecordBatch.from_arrays([pa.array([file]), pa.array([len(held)], pa.int64())], schema=arrow)
            held, lines, size = [], [], 0
            return row

        for batch in (cut for whole in batches for cut in slices(whole, "payload")):
            for page, url, payload, n, digest, target in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "size", "digest", "target"))):
                kind = "response" if target is None else "revisit"
                headers = {"WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": str(n)}
                if url is not None:
                    headers["WARC-Target-URI"] = " ".join(url.split())
                if target is not None:
                    headers |= {"WARC-Refers-To": f"<urn:x-page:{target}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
                raw = gzip.compress(record(kind, "" if page is None else str(page), payload if target is None else b"", headers), 1, mtime=0)
                lines.append(json.dumps({"offset": size, "length": len(raw)}).encode() + b"\n")
                held.append(raw)
                size += len(raw)
                if size >= package_bytes:
                    yield close()
        if held:
            yield close()

    return folder, staged(sent(with_revisits(pages, least=least, **named)).mapInArrow(run, schema))


def locate(folder: str, files: DataFrame) -> DataFrame:
    """Records of packages from their directories and all their indexes: ``(file, member, offset, length)``.

    A package whose members can't all be read stops the job; the error names the file and the members.
    """

    def make():
        source = open_folder(folder)

        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"file": [], "member": [], "offset": [], "length": []}
            for file in batch.column("file").to_pylist():
                with source.open(file) as raw:
                    package = Package(raw)
                    try:
                        pairs = package.pairs()
                    except ValueError as why:
                        raise ValueError(f"{file}: {why}") from None
                    for index, member in pairs:
                        for line in package.range(index, 0, package.members[index][1]).splitlines():
                            entry = json.loads(line)
                            out["file"].append(file)
                            out["member"].append(member)
                            out["offset"].append(entry["offset"])
                            out["length"].append(entry["length"])
            return out

        return work

    # a task per package: the list's own size says nothing of the work
    return map_arrow(files.select("file").repartition(max(1, files.count()), "file"), make, "file string, member string, offset long, length long")


def read_records(folder: str, places: DataFrame) -> DataFrame:
    """Records by range: ``(record_id, kind, payload, size, digest, refers_to, url)`` as their headers state them."""
    columns = ("record_id", "kind", "payload", "size", "digest", "refers_to", "url")

    def make():
        source, held = open_folder(folder), [None, None, None]

        def one(file: str, member: str, offset: int, length: int) -> tuple:
            if held[0] != file:
                if held[1] is not None:
                    held[1].close()
                held[1] = source.open(file)
                held[0], held[2] = file, Package(held[1])
            fields, payload = parse_record(gzip.decompress(held[2].range(member, offset, length)))
            name = lambda key: fields[key].removeprefix("<urn:x-page:").removesuffix(">") or None if key in fields else None
            return name("warc-record-id"), fields["warc-type"], payload, int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:"), name("warc-refers-to"), fields.get("warc-target-uri")

        def work(batch: pa.RecordBatch) -> dict:
            rows = [one(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("file", "member", "offset", "length")))]
            return dict(zip(columns, zip(*rows)))

        return work

    return _map_ranges(places, make, "record_id string, kind string, payload binary, size long, digest string, refers_to string, url string")


def _map_ranges(places: DataFrame, make, schema: str, most: int = 8_000_000) -> DataFrame:
    """Like ``map_arrow``; batches are cut by the bytes that their ranges will read."""
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            begin = held = 0
            sizes = batch.column("length").to_pylist()
            for at, size in enumerate([*sizes, most + 1]):
                if at > begin and held + size > most:
                    columns = work(batch.slice(begin, at - begin))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
                    begin, held = at, 0
                held += size

    return sent(places).mapInArrow(run, out)
