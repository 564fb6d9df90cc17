"""WARC records in ZIP packages: written by Spark tasks, read back in place by byte ranges.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, one gzip
member a record, and ``indexes/index.cdxj``, one line a record with its offset and length.

Reading extracts nothing.  A task reads the end of a package, follows the end record (and the
ZIP64 locator and end record where sizes, offsets or counts pass the 32- or 16-bit fields) to the
central directory and learns where each stored member's bytes lie.  Index lines give the byte range
of each record; parts of an archive member that no line covers (no index, a lost line, the record
about the file itself) are walked from record to record.  The ranges, not the packages, are then
dealt to tasks, which read them from the shared store, ranges that touch in one read.

Of records with equal payloads of ``min_revisit_bytes`` or more the one with the largest page id is
a ``response``; the others are ``revisit`` records that keep the HTTP head and name that response.
Payloads are equal if their SHA-256 is.

Defined results: a null html is an empty payload; rows without a page id are responses where no
row with an id has their payload, else revisits; rows equal in id and payload are one record that
is written as often as it comes (of the largest id all of them are responses); a null url has no
target; an empty table writes no package and gives an empty table; other columns are ignored.  A
compressed or encrypted archive member raises an error: it cannot be read by ranges.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.common import staged
from cartlens.session import checkpoint_dir, target_partitions

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MEMBERS = "path string, name string, method int, flags int, offset long, size long"
RANGES = "path string, member string, offset long, length long"
RECORDS = ("path string, member string, offset long, record_type string, record_id string, refers_to_id string, "
           "target_uri string, page_id long, payload_digest string, digest_ok boolean, payload_bytes long, payload binary")
# The profile URI of revisit records with an identical payload digest (WARC 1.1).
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Signatures of the ZIP format's structures.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it ("file:/x", "hdfs://host/x") or of a path."""
    if ":/" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(quote(uri, safe=":/%=?&@,+~"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- writing ----------------------------------------------------------------------

def warc_record(kind: str, record_id: str, block: bytes, date: str, **fields: str | None) -> bytes:
    """One gzip member; named fields with no value are left out."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date,
            **{k.replace("_", "-"): v for k, v in fields.items() if v is not None}, "Content-Length": str(len(block))}
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def record_id(page_id: int | None, payload: bytes) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {hashlib.sha256(payload).hexdigest()}')}"


class _Sink:
    """What ``zipfile`` may do with a stream of an object store: append."""

    def __init__(self, stream):
        self.write, self.flush = stream.write, stream.flush


class Package:
    """A ZIP package that is written front to back: the archive member, then its index."""

    def __init__(self, store: fs.FileSystem, path: str, date: str):
        self.path, self.date = path, date
        self.stream = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED)
        self.member = self._member(ARCHIVE)
        self.size, self.lines = 0, []
        self._put(warc_record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC File Format 1.1\r\n", date,
                              Content_Type="application/warc-fields"))

    def _member(self, name: str):
        return self.zip.open(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True)

    def _put(self, record: bytes) -> int:
        at = self.size
        self.member.write(record)
        self.size += len(record)
        return at

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> None:
        uri = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
        digest = payload_digest(payload)
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
        kind = "response" if refers_to is None else "revisit"
        record = warc_record(
            kind, record_id(page_id, payload), http + (payload if refers_to is None else b""), self.date,
            WARC_Target_URI=uri, WARC_Payload_Digest=f"sha1:{digest}", X_Page_Id=None if page_id is None else str(page_id),
            WARC_Profile=None if refers_to is None else IDENTICAL,
            WARC_Refers_To=None if refers_to is None else f"<{record_id(refers_to, payload)}>",
            Content_Type="application/http; msgtype=response")
        at = self._put(record)
        entry = {"url": uri, "digest": f"sha1:{digest}", "mime": "text/html" if refers_to is None else "warc/revisit",
                 "filename": ARCHIVE.rpartition("/")[2], "offset": str(at), "length": str(len(record))}
        stamp = "".join(c for c in self.date if c.isdigit())
        self.lines.append(f"{uri or '-'} {stamp} {json.dumps(entry)}\n")

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self._member(INDEX) as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines), self.size


def _write(batches: Iterator[pa.RecordBatch], out: str, date: str, package_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each attempt of a task writes files of its own; only a finished attempt's are in the manifest."""
    store, root = open_store(out)
    store.create_dir(root, recursive=True)
    done, package = [], None

    def finish(p: Package) -> tuple[str, int, int]:
        path, records, size = p.close()
        return f"{out}/{path.rpartition('/')[2]}", records, size

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
        for k in range(batch.num_rows):
            package = package or Package(store, f"{root}/{uuid.uuid4().hex}.zip", date)
            package.add(*(c[k].as_py() for c in columns))
            if package.size >= package_bytes:
                done.append(finish(package))
                package = None
    if package:
        done.append(finish(package))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "n_records", "archive_bytes"])


def with_references(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and ``refers_to``: the page whose response a revisit names, else null.

    Only groups of equal payloads come back to the rows, from a written table, so that a payload
    that a third of the pages have is a plain join key that Spark can split.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("same", F.sha2("payload", 256))
    groups = staged(keyed.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("same")
                    .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
                    .where("n > 1 AND winner IS NOT NULL").select("same", "winner"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    return keyed.join(groups, "same", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_packages(pages: DataFrame, out: str | None = None, min_revisit_bytes: int = 0,
                   package_bytes: int = 64 << 20, date: str | None = None) -> DataFrame:
    """Write one record a page; the manifest (path, n_records, archive_bytes) of the packages.

    ``out`` is a folder of a store that all executors reach (default: one below the checkpoint folder).
    """
    out = out or f"{checkpoint_dir(pages.sparkSession)}/cartlens-warc-{uuid.uuid4().hex}"
    date = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    rows = with_references(pages, min_revisit_bytes)
    return staged(rows.mapInArrow(lambda it: _write(it, out, date, package_bytes),
                                  "path string, n_records long, archive_bytes long"))


# -- reading ----------------------------------------------------------------------

def zip_members(file, size: int) -> list[tuple[str, int, int, int, int]]:
    """(name, method, flags, data offset, stored size) of every member, from the central directory."""
    tail_at = max(0, size - (22 + 0xFFFF))
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory: not a whole ZIP file")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= 20 and (head := file.read_at(20, end - 20))[:4] == LOCATOR64:
        end64 = struct.unpack_from("<Q", head, 8)[0]
        wide = file.read_at(56, end64)
        if wide[:4] != END64:                           # bytes stand before the archive: the record ends at the locator
            wide, end64 = file.read_at(56, end - 76), end - 76
        if wide[:4] != END64:
            raise ValueError("the ZIP64 locator names no end record")
        count, length, offset = struct.unpack_from("<QQQ", wide, 32)
        end = end64
    shift = end - length - offset                       # bytes before the archive
    directory, out, at = file.read_at(length, offset + shift), [], 0
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, full, n_name, n_extra, n_comment, disk = struct.unpack_from("<IIHHHH", directory, at + 20)
        where = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:                                # ZIP64: those fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                where = next(wide) if where == 0xFFFFFFFF else where
            k += 4 + n
        local = file.read_at(30, where + shift)
        if local[:4] != LOCAL:
            raise ValueError(f"no member at the place that the directory names for {name}")
        data = where + shift + 30 + sum(struct.unpack_from("<HH", local, 26))
        out.append((name, method, flags, data, stored))
        at += 46 + n_name + n_extra + n_comment
    return out


def walk_records(file, at: int, end: int, chunk: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members, or plain records, between two places."""
    while at < end:
        begin, head = at, file.read_at(min(4096, end - at), at)
        if head[:2] == b"\x1f\x8b":
            gz = zlib.decompressobj(31)
            while not gz.eof:
                if at >= end:
                    raise ValueError("a record is cut off")
                data = file.read_at(min(chunk, end - at), at)
                gz.decompress(data)
                at += len(data) - len(gz.unused_data)
        elif head[:5] == b"WARC/":
            while (cut := head.find(b"\r\n\r\n")) < 0:
                if begin + len(head) >= end:
                    raise ValueError("a record is cut off")
                head = file.read_at(min(2 * len(head), end - begin), begin)
            at = begin + cut + 4 + int(dict(_fields(head[:cut]))["content-length"]) + 4
        else:
            raise ValueError(f"no record at {at}")
        yield begin, at - begin


def _fields(head: bytes) -> Iterator[tuple[str, str]]:
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        yield name.strip().lower(), value.strip()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower case) and the block of one record."""
    raw = zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record in this range")
    fields = dict(_fields(head))
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a record is cut off")
    return fields, block


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in ddl.split(", ")])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, where = open_store(path)
            with store.open_input_file(where) as file:
                found = zip_members(file, file.size())
            for k in range(0, len(found), 10_000):
                yield _rows([(path, *m) for m in found[k:k + 10_000]], _schema(MEMBERS))


def _uncovered(spans: list[tuple[int, int]], begin: int, end: int) -> Iterator[tuple[int, int]]:
    for at, length in sorted(spans):
        if at > begin:
            yield begin, at
        begin = max(begin, at + length)
    if begin < end:
        yield begin, end


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, where = open_store(path)
            with store.open_input_file(where) as file:
                members = zip_members(file, file.size())
                known: dict[str, set[tuple[int, int]]] = {}
                for name, method, flags, at, size in members:
                    if not name.startswith("indexes/") or not name.endswith((".cdx", ".cdxj")):
                        continue
                    if method or flags & 1:
                        continue                        # a compressed index is not needed: the archive is walked
                    for line in file.read_at(size, at).decode("utf-8", "replace").splitlines():
                        entry = json.loads(line[line.index("{"):])
                        known.setdefault(entry["filename"], set()).add((int(entry["offset"]), int(entry["length"])))
                for name, method, flags, at, size in members:
                    if not name.endswith((".warc", ".warc.gz")):
                        continue
                    if method or flags & 1:
                        raise ValueError(f"{path}: {name} is compressed or encrypted, so it cannot be read by ranges")
                    spans = [(o, n) for o, n in known.get(name.rpartition("/")[2], ()) if o + n <= size]
                    rows = [(path, name, at + o, n) for o, n in spans]
                    for begin, end in _uncovered(spans, 0, size):
                        rows += [(path, name, o, n) for o, n in walk_records(file, at + begin, at + end)]
                    for k in range(0, len(rows), 10_000):
                        yield _rows(rows[k:k + 10_000], _schema(RANGES))


def _joined(ranges: list[tuple[str, str, int, int]], most: int = 4 << 20) -> Iterator[list[tuple[str, str, int, int]]]:
    """Ranges that touch, up to ``most`` bytes together."""
    group: list = []
    for r in ranges:
        if group and (r[0] != group[0][0] or r[2] != group[-1][2] + group[-1][3] or r[2] + r[3] - group[0][2] > most):
            yield group
            group = []
        group.append(r)
    if group:
        yield group


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    schema, opened, file = _schema(RECORDS), None, None
    for batch in batches:
        rows, held = [], 0
        for group in _joined(list(zip(*(batch.column(c).to_pylist() for c in ("path", "member", "offset", "length"))))):
            if group[0][0] != opened:
                if file:
                    file.close()
                opened = group[0][0]
                store, where = open_store(opened)
                file = store.open_input_file(where)
            base = group[0][2]
            data = file.read_at(group[-1][2] + group[-1][3] - base, base)
            for path, member, at, n in group:
                fields, block = parse_record(data[at - base:at - base + n])
                rows.append((path, member, at, *_record(fields, block, with_payload)))
                held += len(block) if with_payload else 0
            if held > 16 << 20 or len(rows) >= 10_000:
                yield _rows(rows, schema)
                rows, held = [], 0
        if rows:
            yield _rows(rows, schema)
    if file:
        file.close()


def _record(f: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, page = f["warc-type"], f.get("x-page-id")
    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload, size, ok = None, None, None
    if f.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        said = dict(_fields(head)).get("content-length")
        size = len(payload)
        if kind == "response":
            ok = digest == payload_digest(payload)
        else:
            size, payload = int(said) if said else None, None
    refers = f.get("warc-refers-to")
    return (kind, f["warc-record-id"].strip("<>"), refers.strip("<>") if refers else None, f.get("warc-target-uri"),
            int(page) if page else None, digest, ok, size, payload if with_payload else None)


def packages(spark: SparkSession, folder: str) -> DataFrame:
    """The packages (path) below a folder; their content is not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.{zip,wacz}").option("recursiveFileLookup", "true")
            .load(folder).select("path"))


def list_members(paths: DataFrame) -> DataFrame:
    """Every member of the packages with its method, flags, data offset and stored size."""
    return paths.select("path").mapInArrow(_members, MEMBERS)


def read_records(paths: DataFrame, with_payload: bool = True, range_bytes: int = 32 << 20) -> DataFrame:
    """One row per WARC record of the packages in ``paths``; revisits have no payload of their own.

    Rows of ranges are small beside the bytes they name, so tasks are counted by those bytes.
    """
    least = target_partitions(paths.sparkSession)
    ranges = staged(paths.select("path").repartition(least, "path").mapInArrow(_ranges, RANGES))
    total = ranges.agg(F.sum("length")).first()[0] or 0
    piece = (F.col("offset") / (range_bytes // 8)).cast("long")
    tasks = min(max(total // range_bytes, least), 100_000)
    dealt = ranges.repartition(tasks, "path", piece).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(lambda it: _read(it, with_payload), RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Pages of ``records``: revisits with the page id, size and digest of the response they name."""
    records = staged(records.where("record_type IN ('response', 'revisit')").drop("payload"))
    named = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("named_id")).agg(
        F.max("page_id").alias("named_page"), F.max("payload_bytes").alias("named_bytes"),
        F.max("payload_digest").alias("named_digest"), F.min("digest_ok").alias("named_ok"))
    revisits = records.where("record_type = 'revisit'").select("page_id", "refers_to_id", "payload_digest")
    wanted = staged(named.join(revisits.select(F.col("refers_to_id").alias("named_id")).distinct(), "named_id", "left_semi"))
    found = revisits.join(wanted, F.col("refers_to_id") == F.col("named_id"), "left")
    same = F.col("named_ok") & (F.col("payload_digest") == F.col("named_digest"))
    return (records.where("record_type = 'response'")
            .select("page_id", "payload_bytes", F.when(F.col("digest_ok"), F.col("payload_digest")).alias("payload_digest"),
                    "record_type", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(found.select("page_id", F.col("named_bytes").alias("payload_bytes"),
                                      F.when(same, F.col("named_digest")).alias("payload_digest"),
                                      F.lit("revisit").alias("record_type"), F.col("named_page").alias("refers_to"))))


def query(pages: DataFrame) -> DataFrame:
    """All pages written as records, then read back from the packages."""
    written = write_packages(pages)
    return resolve_revisits(read_records(written, with_payload=False))


#: The rows of the contract straight from the table: base32 by five hex digits (20 bits) at a time.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     d AS (SELECT page_id, payload, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS winner FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM d
"""
