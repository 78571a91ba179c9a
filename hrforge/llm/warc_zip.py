"""WARC archives inside ZIP files: writing them from pages, and reading records by range.

An archive is a ZIP file with a stored (uncompressed) member ``archive/data.warc.gz``, in
which each record is a gzip member of its own, and a stored ``indexes/index.cdxj`` with one
line (record id, date, JSON with offset, length, type and digest) per record.

Writing. Payloads are compared by their SHA-256 and length before a text moves: pairs of
(page, payload) are made distinct, a payload's largest page_id is found with partial
aggregates, and a hot payload's pairs are split by the skew-join rule. Then each page moves
once, by page and payload, so copies of one payload spread over all tasks; each task streams
its records into archives of at most about ``archive_bytes``. Of equal payloads of
``least`` bytes or more the record with the largest page_id is a response and the others are
revisits, which keep the HTTP header and no payload. Tasks write to names of their own
attempt, and only archives named in the manifest (a table written by the tasks that ended
well) are read, so lost executors and second attempts leave no trace in a result.

Reading. For each archive the end record, the ZIP64 locator and end record where present,
and the central directory with its ZIP64 fields are read by range; they give the
places of the stored members. The index gives the place of every record in them. Places are
dealt out anew, in runs of neighbouring records, and each run is fetched with one range
read. No member is extracted, and no task holds more than a run or one record. A payload
that differs from its digest, a compressed member or a missing index raises an error.

The folder can be any that pyarrow.fs reads; by default it is in the shared checkpoint folder.
Odd cases: a null html is an empty payload; a null url leaves out the target URI; a null
page_id counts as smallest. Of rows equal in page_id and payload one at most is a response.
Empty table: no archives, empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrforge.llm.common import arrow_batches, table
from hrforge.session import checkpoint_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVE_BYTES = 256 << 20
#: Bytes of a run of neighbouring records that one range read fetches.
RUN_BYTES = 1 << 20
#: Bytes of archives that one reading task is meant to fetch, and the most tasks.
TASK_BYTES, MOST_TASKS = 16 << 20, 100_000
GZIP_LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, bytes long, records long"
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType())])


def file_of(uri: str) -> tuple[pafs.FileSystem, str]:
    if not re.match(r"\w+:", uri):
        uri = "file://" + uri
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------------ records


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:x-page:{'-' if page_id is None else page_id}:{digest}:{copy}>"


def page_of(rid: str) -> int | None:
    page = rid.strip("<>").split(":")[2]
    return None if page == "-" else int(page)


def http_block(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def warc_record(rid: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; ``refers_to`` (a record id) makes it a revisit."""
    block = http_block(len(payload)) + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {rid}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (names in lower case), HTTP header and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[:int(fields["content-length"])]
    http, gap, payload = block.partition(b"\r\n\r\n")
    return fields, http + gap, payload


def described(data: bytes) -> tuple[tuple, bytes | None]:
    """The columns of ``RECORD`` and the payload (None for a revisit)."""
    fields, http, payload = parse_record(data)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    same = (page_of(fields["warc-record-id"]), fields.get("warc-target-uri"))
    if fields["warc-type"] == "revisit":
        size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
        return (*same, size, digest, "revisit", page_of(fields["warc-refers-to"])), None
    if base32_sha1(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return (*same, len(payload), digest, fields["warc-type"], None), payload


# ------------------------------------------------------------------ writing


class Archive:
    """A ZIP file under way: records are streamed into its data member."""

    def __init__(self, folder: str, name: str):
        fs, path = file_of(folder)
        fs.create_dir(path, recursive=True)
        self.uri, self.out = f"{folder}/{name}", fs.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, rid: str, record: bytes, kind: str, digest: str) -> None:
        packed = gzip.compress(record, GZIP_LEVEL, mtime=0)
        self.data.write(packed)
        place = {"offset": self.at, "length": len(packed), "type": kind, "digest": f"sha1:{digest}"}
        self.lines.append(f"{rid} {re.sub('[^0-9]', '', DATE)} {json.dumps(place)}")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(x + "\n" for x in self.lines))
        self.zip.close()
        self.out.close()
        return self.uri, self.at, len(self.lines)


def record_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, nth (of rows equal in page and payload), revisits (boolean) and
    refers_to. Only digests move until each page is sent to its task."""
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload)
    sha = F.when(size >= least, F.concat(F.sha2(payload, 256), F.lit(":"), size.cast("string")))
    own = F.concat_ws(":", F.sha2(payload, 256), F.coalesce(F.col("page_id").cast("string"), F.lit("-")))
    rows = pages.select("page_id", "url", payload.alias("payload"), sha.alias("sha"), own.alias("own"))
    pairs = table(rows.select("page_id", "sha", "own").groupBy("page_id", "sha", "own").agg(F.count(F.lit(1)).alias("rows")), "payloads")
    shared = table(pairs.filter("sha IS NOT NULL").groupBy("sha").agg(F.sum("rows").alias("rows"), F.max("page_id").alias("refers_to"))
                   .filter("rows > 1").select("sha", "refers_to", F.lit(True).alias("shared")), "shared-payloads")
    of = pairs.join(shared, "sha", "left").select(F.col("own").alias("pair"), "refers_to", "shared")
    nth = F.row_number().over(Window.partitionBy("own").orderBy("own"))
    first = F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("nth") == 1)
    return (rows.join(of, rows["own"] == of["pair"]).withColumn("nth", nth)
            .select("page_id", "url", "payload", "nth", (F.coalesce("shared", F.lit(False)) & ~first).alias("revisits"), "refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); the manifest of the archives."""
    spark = pages.sparkSession
    arrow_batches(spark)
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_archive, done = None, []
        attempt = uuid.uuid4().hex
        for b in batches:
            cols = [b.column(i) for i in range(b.num_columns)]
            for i in range(b.num_rows):
                page, url, text, nth, revisits, other = (c[i].as_py() for c in cols)
                data = text.encode()
                digest = base32_sha1(data)
                rid = record_id(page, digest, nth)
                record = warc_record(rid, url, data, digest, record_id(other, digest, 1) if revisits else None)
                if open_archive is None:
                    open_archive = Archive(folder, f"pages-{attempt}-{len(done)}.wacz")
                open_archive.add(rid, record, "revisit" if revisits else "response", digest)
                if open_archive.at >= archive_bytes:
                    done.append(open_archive.close())
                    open_archive = None
        if open_archive is not None:
            done.append(open_archive.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*done) if done else ([], [], []), (pa.string(), pa.int64(), pa.int64()))], ["archive", "bytes", "records"])

    return table(record_types(pages, least).mapInArrow(write, MANIFEST), "archives")


# ------------------------------------------------------------------ reading


class Member(NamedTuple):
    name: str
    method: int
    size: int  # as stored
    header: int  # place of the local header


_END, _END64, _LOCATOR = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL")
_ENTRY, _LOCAL = struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def members(f, size: int) -> dict[str, Member]:
    """The central directory of a ZIP file of ``size`` bytes, ZIP64 or not, by range reads.
    ``f`` has ``read_at(nbytes, offset)``. Bytes before the first member are allowed."""
    span = min(size, _END.size + _FULL16)
    tail = f.read_at(span, size - span)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and (len(tail) - at < _END.size or at + _END.size + _END.unpack_from(tail, at)[-1] != len(tail)):
        at = tail.rfind(b"PK\5\6", 0, at)  # the signature can also stand in the comment
    if at < 0:
        raise ValueError("no end of a central directory")
    n, length, start = _END.unpack_from(tail, at)[4:7]
    end = size - span + at
    locator = f.read_at(_LOCATOR.size, end - _LOCATOR.size) if end >= _LOCATOR.size else b""
    if locator[:4] == b"PK\6\7":
        place = _LOCATOR.unpack(locator)[2]
        # with bytes before the first member, the record of the usual size stands before its locator
        for end in (place, end - _LOCATOR.size - _END64.size):
            record = f.read_at(_END64.size, end)
            if record[:4] == b"PK\6\6":
                break
        else:
            raise ValueError("no ZIP64 end of the central directory where its locator points")
        n, length, start = _END64.unpack(record)[7:10]
    elif n == _FULL16 or _FULL32 in (length, start):
        raise ValueError("a ZIP64 archive without locator")
    shift = end - length - start
    if shift < 0:
        raise ValueError("the central directory does not fit into the file")
    found, directory, at = {}, f.read_at(length, start + shift), 0
    for _ in range(n):
        sig, _, _, _, method, _, _, _, packed, plain, names, extras, comments, _, _, _, header = _ENTRY.unpack_from(directory, at)
        if sig != b"PK\1\2":
            raise ValueError("broken central directory")
        at += _ENTRY.size
        name, extra = directory[at:at + names].decode(), directory[at + names:at + names + extras]
        at += names + extras + comments
        wide = _zip64_field(extra)
        # 64-bit values stand in this order, each only where the 32-bit one is full
        plain, packed, header = (wide.pop(0) if v == _FULL32 else v for v in (plain, packed, header))
        found[name] = Member(name, method, packed, header + shift)
    return found


def _zip64_field(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{min(length, 24) // 8}Q", extra, at + 4))
        at += 4 + length
    return []


def data_start(f, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed, so it cannot be read by range")
    sig, *_, names, extras = _LOCAL.unpack(f.read_at(_LOCAL.size, member.header))
    if sig != b"PK\3\4":
        raise ValueError(f"no local header of {member.name}")
    return member.header + _LOCAL.size + names + extras


def record_places(f, size: int) -> list[tuple[int, int]]:
    """Place and length in the file of every record that the archive's indexes name."""
    found = members(f, size)
    data = [m for m in found.values() if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc"))]
    indexes = [m for m in found.values() if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
    if len(data) != 1 or not indexes:
        raise ValueError("an archive has one archive/*.warc.gz member and an index")
    start, out = data_start(f, data[0]), []
    for index in indexes:
        for line in f.read_at(index.size, data_start(f, index)).splitlines():
            place = json.loads(line.split(b" ", 2)[2])
            if place["offset"] + place["length"] > data[0].size:
                raise ValueError(f"{index.name} names a record outside {data[0].name}")
            out.append((start + place["offset"], place["length"]))
    return sorted(out)


def runs(places: list[tuple[int, int]], most: int = RUN_BYTES) -> Iterator[tuple[int, list[int]]]:
    """Neighbouring records as (place of the first, lengths), of at most about ``most`` bytes."""
    start, end, sizes = 0, 0, []
    for at, n in places:
        if sizes and (at != end or end - start + n > most):
            yield start, sizes
            sizes = []
        if not sizes:
            start = at
        sizes.append(n)
        end = at + n
    if sizes:
        yield start, sizes


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the archives that ``manifest.archive`` names; ``payloads`` adds
    the payload (binary, null for revisits)."""
    schema = T.StructType(RECORD.fields + ([T.StructField("payload", T.BinaryType())] if payloads else []))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = file_of(uri)
                with fs.open_input_file(path) as f:
                    found = list(runs(record_places(f, f.size())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(found)), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.int32()))],
                    ["archive", "start", "sizes"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for b in batches:
            for uri, start, sizes in zip(*(c.to_pylist() for c in b.columns)):
                if uri != name:
                    fs, path = file_of(uri)
                    name, f = uri, fs.open_input_file(path)
                data, at, rows = memoryview(f.read_at(sum(sizes), start)), 0, []
                for n in sizes:
                    fields, payload = described(gzip.decompress(data[at:at + n]))
                    rows.append((*fields, payload))
                    at += n
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[i], kinds[i]) for i in range(len(schema))], schema.names)

    # rows of places are small, so their number of tasks follows the bytes they name
    count, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(-(-size // TASK_BYTES), MOST_TASKS))
    placed = manifest.select("archive").repartition(max(1, min(count, MOST_TASKS)), "archive").mapInArrow(
        locate, "archive string, start long, sizes array<int>")
    return placed.repartition(tasks, "archive", "start").sortWithinPartitions("archive", "start").mapInArrow(fetch, schema)


def archived(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Records of ``pages`` after a way through archives in the shared folder."""
    return read_archives(write_archives(pages, least=least))
