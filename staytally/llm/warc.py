"""Operator 12: pages as WARC records inside ZIP packages, and a reader that never unpacks them.

Writing. Pages are landed once with a row number and the digest of their payload. Among rows with
equal payloads of at least ``MIN_BYTES`` the smallest id is the response (of its rows, the first)
and the others revisit it; the leaders are found by one pre-aggregated grouping of narrow rows. A
payload that more than a thousandth of all rows share meets its rows by a broadcast, which can
hold a thousand leaders at most; the others meet in a join. A task then writes packages of some
``PACKAGE_BYTES``: ZIP archives whose members are stored, one of gzip records one after another,
one index line per record with its offset and length, and a description with checksums. A repeated
task writes the same bytes under the same names; the landed list of packages names what counts.

Reading. A package's end is searched for the end-of-directory record, the ZIP64 one is followed
where there is a locator, and the central directory tells each member's place, by its ZIP64 field
where the plain ones are full. Only stored members are used. The index is read, and then the byte
ranges of its records, neighbours in one read; each response's payload is hashed again and must
agree with its record.

Nulls: a null page counts as an empty payload. Rows without an id come after all ids, so they lead
only among themselves, and a revisit of such a row refers to null. Rows without an address get one
made of their record id. Repeated rows are records of their own. Empty tables give no package and
no rows. Columns beside the three are not read.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote
from uuid import UUID

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm.scratch import Scratch

MIN_BYTES = 100
#: A package is closed when it holds so many bytes of records, or so many records.
PACKAGE_BYTES, PACKAGE_RECORDS = 32 << 20, 1 << 14
RESPONSE, REVISIT = "response", "revisit"
ARCHIVE, INDEX, DESCRIPTION = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"

# Signatures and layouts of the ZIP format, and its mark of a 64-bit field.
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR = b"PK\x06\x06", b"PK\x06\x07"
_LOCAL_FIELDS = struct.Struct("<4s5H3I2H")
_CENTRAL_FIELDS = struct.Struct("<4s6H3I5H2I")
_END_FIELDS = struct.Struct("<4s4H2IH")
_END64_FIELDS = struct.Struct("<4sQ2H2I4Q")
_LOCATOR_FIELDS = struct.Struct("<4sIQI")
_FULL16, _FULL32, _ZIP64_FIELD = 0xFFFF, 0xFFFFFFFF, 1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HOT_SHARE = 1000
_READ_BYTES = 4 << 20
_SLICE = 2 << 20


def _store(folder: str):
    return pafs.FileSystem.from_uri(folder if "://" in folder else re.sub("^file:", "", folder))


# --- packages ----------------------------------------------------------------------------


class Package:
    """Members of one ZIP archive, stored one after another. ``wide`` writes every size and place
    in 64 bits, which is otherwise done where 32 do not hold them."""

    def __init__(self, sink, wide: bool = False) -> None:
        self.sink, self.wide, self.at, self.members = sink, wide, 0, []

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, name: str, pieces: list[bytes]) -> None:
        size, crc = 0, 0
        for piece in pieces:
            size, crc = size + len(piece), zlib.crc32(piece, crc)
        wide = self.wide or size >= _FULL32 or self.at >= _FULL32
        member = (name.encode(), size, crc, self.at, wide)
        self.members.append(member)
        extra = struct.pack("<2H2Q", _ZIP64_FIELD, 16, size, size) if wide else b""
        shown = _FULL32 if wide else size
        self._write(
            _LOCAL_FIELDS.pack(
                _LOCAL, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, shown, shown, len(member[0]), len(extra)
            )
        )
        self._write(member[0] + extra)
        for piece in pieces:
            self._write(piece)

    def close(self) -> None:
        first = self.at
        for name, size, crc, at, wide in self.members:
            extra = struct.pack("<2H3Q", _ZIP64_FIELD, 24, size, size, at) if wide else b""
            version, shown, place = (45, _FULL32, _FULL32) if wide else (20, size, at)
            self._write(
                _CENTRAL_FIELDS.pack(
                    _CENTRAL, version, version, 0x800, 0, 0, 0x21, crc, shown, shown,
                    len(name), len(extra), 0, 0, 0, 0, place,
                )
            )
            self._write(name + extra)
        size, n = self.at - first, len(self.members)
        if self.wide or self.at >= _FULL32 or n >= _FULL16:
            end = self.at
            self._write(_END64_FIELDS.pack(_END64, 44, 45, 45, 0, 0, n, n, size, first))
            self._write(_LOCATOR_FIELDS.pack(_LOCATOR, 0, end, 1))
            n, size, first = _FULL16, _FULL32, _FULL32
        self._write(_END_FIELDS.pack(_END, 0, 0, n, n, size, first, 0))
        self.sink.close()


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Name to (first byte, size) of every stored member, read from the end of the archive."""
    tail_size = min(size, _END_FIELDS.size + _FULL16 + _LOCATOR_FIELDS.size)
    file.seek(size - tail_size)
    tail = file.read(tail_size)
    at = tail.rfind(_END)
    # The signature may stand inside a comment: the record's comment ends the file.
    while at >= 0 and (
        at + _END_FIELDS.size > len(tail)
        or at + _END_FIELDS.size + _END_FIELDS.unpack_from(tail, at)[-1] != len(tail)
    ):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    *_, count, length, first, _ = _END_FIELDS.unpack_from(tail, at)
    locator = at - _LOCATOR_FIELDS.size
    if locator >= 0 and tail.startswith(_LOCATOR, locator):
        file.seek(_LOCATOR_FIELDS.unpack_from(tail, locator)[2])
        end = _END64_FIELDS.unpack(file.read(_END64_FIELDS.size))
        if end[0] != _END64:
            raise ValueError("no ZIP64 end where the locator points")
        *_, count, length, first = end
    file.seek(first)
    directory = file.read(length)
    found, at = {}, 0
    for _ in range(count):
        head = _CENTRAL_FIELDS.unpack_from(directory, at)
        if head[0] != _CENTRAL:
            raise ValueError("broken ZIP directory")
        method, packed, plain = head[4], head[8], head[9]
        name_size, extra_size, comment_size, place = head[10], head[11], head[12], head[16]
        at += _CENTRAL_FIELDS.size
        name = directory[at : at + name_size].decode()
        extra = directory[at + name_size : at + name_size + extra_size]
        at += name_size + extra_size + comment_size
        plain, packed, place = _wide_fields(extra, plain, packed, place)
        if method:
            continue
        file.seek(place)
        local = _LOCAL_FIELDS.unpack(file.read(_LOCAL_FIELDS.size))
        if local[0] != _LOCAL:
            raise ValueError(f"no member where the directory points: {name}")
        found[name] = (place + _LOCAL_FIELDS.size + local[9] + local[10], packed)
    return found


def _wide_fields(extra: bytes, *fields: int) -> list[int]:
    """Those of the fields that are full, in order, from the 64-bit extra field."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == _ZIP64_FIELD:
            wide = extra[at + 4 : at + 4 + size]
        at += 4 + size
    values = iter(struct.unpack(f"<{len(wide) // 8}Q", wide[: len(wide) // 8 * 8]))
    return [next(values) if field == _FULL32 else field for field in fields]


# --- records -----------------------------------------------------------------------------


def _record_id(row: int) -> str:
    return f"<urn:uuid:{UUID(bytes=hashlib.sha256(b'page row %d' % row).digest()[:16], version=4)}>"


def record(kind: str, fields: dict[str, str], http: dict[str, str], payload: bytes) -> bytes:
    block = ["HTTP/1.1 200 OK", *(f"{k}: {v}" for k, v in http.items()), "", ""]
    block = "\r\n".join(block).encode() + payload
    fields = {
        "WARC-Type": kind,
        **fields,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    _, *lines = head.decode().split("\r\n")
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's fields, its HTTP fields and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a record is cut short")
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(head), payload


def _address(url: str | None, row: int) -> str:
    """An address without what would end a header line."""
    return _record_id(row)[1:-1] if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def _page_record(page: dict, stamp: str) -> tuple[bytes, dict]:
    """A page's record and what its index line tells beside offset and length."""
    kind = RESPONSE if page["lead"] is None else REVISIT
    address, row = _address(page["url"], page["row"]), page["row"]
    fields = {
        "WARC-Record-ID": _record_id(row),
        "WARC-Date": stamp,
        "WARC-Target-URI": address,
        "WARC-Payload-Digest": f"sha256:{page['digest']}",
    }
    if page["page_id"] is not None:
        fields["X-Page-ID"] = quote(page["page_id"])
    if kind == REVISIT:
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _record_id(page["lead"])}
        if page["lead_id"] is not None:
            fields["X-Refers-To-Page-ID"] = quote(page["lead_id"])
    http = {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(page["bytes"])}
    payload = (page["html"] or "").encode() if kind == RESPONSE else b""
    line = {"url": address, "mime": "text/html", "status": "200", "digest": f"sha256:{page['digest']}"}
    return record(kind, fields, http, payload), line


def _packed(data: bytes) -> bytes:
    # No time in the header, so that a repeated task writes the same bytes.
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _written(folder: str, stamp: str, package_bytes: int, wide: bool):
    """Rows of a task in the order of their row numbers, as one package after another."""
    moment = re.sub("[^0-9]", "", stamp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        part, attempt, number = context.partitionId(), context.taskAttemptId(), 0
        records, lines, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal records, lines, held, number
            name = f"pages-{part:06d}-{number:05d}.wacz"
            index = "".join(lines).encode()
            resources = [
                {"name": path.rsplit("/", 1)[1], "path": path, "bytes": sum(map(len, pieces)),
                 "hash": f"sha256:{_sha256(pieces)}"}
                for path, pieces in ((ARCHIVE, records), (INDEX, [index]))
            ]
            about = {"profile": "data-package", "wacz_version": "1.1.1", "created": stamp, "resources": resources}
            package = Package(store.open_output_stream(f"{root}/_{name}.{attempt}"), wide)
            package.add(ARCHIVE, records)
            package.add(INDEX, [index])
            package.add(DESCRIPTION, [json.dumps(about, indent=1).encode()])
            package.close()
            store.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")
            out = pa.RecordBatch.from_pydict(
                {"package": [f"{folder}/{name}"], "records": pa.array([len(records)], pa.int64()),
                 "bytes": pa.array([package.at], pa.int64())}
            )
            records, lines, held, number = [], [], 0, number + 1
            return out

        for batch in batches:
            # A row at a time: a long page is in memory once as text and once as bytes.
            for i in range(batch.num_rows):
                page = batch.slice(i, 1).to_pylist()[0]
                raw, line = _page_record(page, stamp)
                data = _packed(raw)
                line |= {"offset": str(held), "length": str(len(data)), "filename": ARCHIVE}
                lines.append(f"{line['url']} {moment} {json.dumps(line)}\n")
                records.append(data)
                held += len(data)
                if held >= package_bytes or len(records) == PACKAGE_RECORDS:
                    yield close()
        if records:
            yield close()

    return run


def _sha256(pieces: list[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def _revisits(rows: DataFrame, scratch: Scratch, min_bytes: int) -> DataFrame:
    """``row, lead, lead_id`` of the rows that revisit another."""
    total = rows.count()
    last = F.col("page_id").isNull()
    first = F.min(F.struct(last.alias("_last"), F.col("page_id"), F.col("row").alias("lead")))
    leaders = (
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "copies", "first.lead", F.col("first.page_id").alias("lead_id"))
    )
    leaders = scratch.land(leaders, "leaders")
    hot = F.col("copies") * _HOT_SHARE > total
    few, many = leaders.where(hot).drop("copies"), leaders.where(~hot).drop("copies")
    narrow = rows.select("row", "digest")
    # Under a thousand leaders can each have over a thousandth of the rows.
    met = narrow.join(F.broadcast(few), "digest")
    left = narrow.join(F.broadcast(few.select("digest")), "digest", "left_anti")
    return met.unionByName(left.join(many, "digest")).where("row <> lead").drop("digest")


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = MIN_BYTES,
    package_bytes: int = PACKAGE_BYTES,
    wide: bool = False,
) -> DataFrame:
    """The packages written to ``folder``: package, records, bytes. Without one they go to a folder
    of their own in the shared one, which is deleted when the driver's Python ends."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = folder or f"{scratch.path}/packages"
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("html"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.sha2(body, 256).alias("digest"),
    )
    rows = scratch.land(rows, "rows", "zstd")
    revisits = scratch.land(_revisits(rows, scratch, min_bytes), "revisits")
    joined = rows.join(revisits, "row", "left").sortWithinPartitions("row")
    kept = joined.select(
        "row",
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        F.when(F.col("lead").isNull(), F.col("html")).alias("html"),
        "bytes",
        "digest",
        "lead",
        F.col("lead_id").cast("string").alias("lead_id"),
    )
    stamp = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    written = kept.mapInArrow(
        _written(folder, stamp, package_bytes, wide), "package string, records long, bytes long"
    )
    packages = scratch.land(written, "list")
    scratch.drop(rows)
    return packages


# --- reading -----------------------------------------------------------------------------


def _ranges(lines: list[dict]) -> Iterator[list[dict]]:
    """Index lines of neighbours, as many as one read may hold; a long record alone."""
    group, end = [], 0
    for line in lines:
        line["offset"], line["length"] = int(line["offset"]), int(line["length"])
        start = group[0]["offset"] if group else line["offset"]
        apart = group and (line["offset"] != end or line["filename"] != group[0]["filename"])
        if apart or line["offset"] + line["length"] - start > _READ_BYTES and group:
            yield group
            group = []
        group.append(line)
        end = line["offset"] + line["length"]
    if group:
        yield group


def records_of(file, size: int) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """All records of a package, found through its indexes."""
    found = members(file, size)
    for name in sorted(name for name in found if name.startswith("indexes/")):
        file.seek(found[name][0])
        index = file.read(found[name][1])
        if name.endswith(".gz"):
            index = zlib.decompress(index, 31)
        lines = [json.loads(line.split(" ", 2)[2]) for line in io.StringIO(index.decode())]
        lines.sort(key=lambda line: (line["filename"], int(line["offset"])))
        for group in _ranges(lines):
            first, base = group[0]["offset"], found[group[0]["filename"]][0]
            file.seek(base + first)
            raw = file.read(group[-1]["offset"] + group[-1]["length"] - first)
            for line in group:
                at = line["offset"] - first
                yield parse(zlib.decompress(raw[at : at + line["length"]], 31))


def _named(fields: dict[str, str], name: str) -> str | None:
    return unquote(fields[name]) if name in fields else None


def _read(payloads: bool):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5]
    if payloads:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("package").to_pylist():
                store, file_path = _store(path)
                with store.open_input_file(file_path) as file:
                    rows, held = [], 0
                    for fields, http, payload in records_of(file, file.size()):
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        size = int(http["content-length"])
                        if fields["warc-type"] == RESPONSE and (
                            size != len(payload) or digest != hashlib.sha256(payload).hexdigest()
                        ):
                            raise ValueError(f"a payload differs from its record in {path}")
                        row = [
                            _named(fields, "x-page-id"), size, digest, fields["warc-type"],
                            _named(fields, "x-refers-to-page-id"), fields["warc-target-uri"],
                            fields["warc-record-id"],
                        ]
                        rows.append([*row, payload] if payloads else row)
                        held += len(payload) if payloads else 400
                        if held >= _SLICE:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, kinds)

    return run


def _batch(rows: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_archives(packages: DataFrame, *, id_type: str = "string", payloads: bool = False) -> DataFrame:
    """One row per record of the listed packages, whose paths are in ``package``: page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, record_id and, if asked for, the
    payload (null for a revisit)."""
    spark = packages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    fields = StructType.fromDDL(
        "page_id string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to string, url string, record_id string"
    )
    if payloads:
        fields = fields.add(StructField("payload", StructType.fromDDL("b binary")["b"].dataType))
    found = packages.select("package").repartition(tasks).mapInArrow(_read(payloads), fields)
    found = found.withColumn("page_id", F.col("page_id").cast(id_type))
    found = found.withColumn("refers_to", F.col("refers_to").cast(id_type))
    if payloads:
        found = found.withColumn("payload", F.when(F.col("record_type") == RESPONSE, F.col("payload")))
    return found


def packages_in(spark: SparkSession, folder: str) -> DataFrame:
    """Packages of a folder, by its listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_]*.wacz").load(folder)
    return files.select(F.col("path").alias("package"))
