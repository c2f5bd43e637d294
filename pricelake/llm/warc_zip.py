"""Web archives in ZIP packages: a writer, and a reader by byte ranges.

A package is a ZIP file whose members are stored, not deflated:
``archive/data.warc.gz`` (one gzip member a record) and ``indexes/index.cdxj``
(a line a record with its offset and length). The reader parses the end
record, its ZIP64 form and the central directory from a few ranges at the end
of the file, finds where a stored member's bytes begin, reads the index member,
and then each record by its own range of the package; nothing is extracted.

Writing tasks put packages of about ``PACKAGE_BYTES`` into a folder that all
executors see, by URI, under names of their own attempt; only the names that a
finished task returned are in the (staged) manifest, so a lost or repeated
attempt leaves at most an unlisted file. Reading is dealt by ranges of
packages, not by packages.

Records: the first (smallest id) page of those with an equal payload of
``REVISIT_BYTES`` or more is a response, the others are revisits of it without
payload; shorter payloads are always responses. Defined cases: null html is an
empty payload, a null url an empty target; a null ``page_id`` is written and
read back as null, and refers to the smallest id if there is one; rows
repeating one id and payload are each a record, all responses if the id is the
smallest; very long pages are records of their own range, whole; only the named
columns are read, so further columns with any names do no harm; an empty table writes
no package and reads back empty.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import join_staged, released, stage
from pricelake.session import scratch_path

PACKAGE_BYTES = 16 << 20
REVISIT_BYTES = 100
RANGE_BYTES = 1 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    if ":" not in uri.split("/", 1)[0]:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# ---- ZIP directories ----

def _extra64(extra: bytes, sizes: list[int]) -> list[int]:
    """Sizes and offset of an entry, with those of its ZIP64 field where they are all ones."""
    pos = 0
    while pos + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, pos)
        if tag == 1:
            at = pos + 4
            for k, v in enumerate(sizes):
                if v == 0xFFFFFFFF:
                    sizes[k] = struct.unpack_from("<Q", extra, at)[0]
                    at += 8
        pos += 4 + n
    return sizes


def directory(f) -> dict[str, dict]:
    """Members of a ZIP file (an open random-access file): name -> method, size
    and the offset of the local header. Reads the end of the file only."""
    total = f.size()
    tail_at = max(0, total - 65557)
    f.seek(tail_at)
    tail = f.read(total - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF:
        at = end - 20
        if at < 0 or tail[at:at + 4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        f.seek(struct.unpack_from("<Q", tail, at + 8)[0])
        record = f.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    f.seek(start)
    data, pos, out = f.read(size), 0, {}
    for _ in range(count):
        if data[pos:pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, pos + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, pos + 20)
        header = struct.unpack_from("<I", data, pos + 42)[0]
        name = data[pos + 46:pos + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[pos + 46 + n_name:pos + 46 + n_name + n_extra]
        plain, packed, header = _extra64(extra, [plain, packed, header])
        out[name] = {"method": method, "size": packed, "header": header}
        pos += 46 + n_name + n_extra + n_comment
    return out


def stored_start(f, member: dict) -> int:
    """Where a stored member's bytes begin."""
    if member["method"] != 0:
        raise ValueError("the member is not stored")
    f.seek(member["header"])
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member["header"] + 30 + n_name + n_extra


# ---- records ----

def _name(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id(name: str | None):
    value = name[len("<urn:page:"):-1] if name else "null"
    return None if value == "null" else int(value)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
            "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (b"" if revisit else payload)
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers of a record (names in lower case) and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    body = rest[:int(out["content-length"])]
    out["payload"] = body.partition(b"\r\n\r\n")[2]
    return out


# ---- Spark ----

def _writer(folder: str):
    def run(batches):
        from pyspark import TaskContext
        t = TaskContext.get()
        stem = f"{folder}/part-{t.partitionId():05d}-{t.taskAttemptId()}-{uuid.uuid4().hex}"
        files, at = open_fs(stem)
        data, index, made = io.BytesIO(), [], 0

        def close():
            nonlocal data, index, made
            path = f"{at}-{made}.wacz"
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                z.writestr(DATA, data.getbuffer())
                z.writestr(INDEX, "".join(index))
            files.create_dir(path.rpartition("/")[0], recursive=True)
            with files.open_output_stream(path) as f:
                f.write(out.getbuffer())
            row = pa.RecordBatch.from_pydict({"package": [f"{stem}-{made}.wacz"], "bytes": [out.tell()], "records": [len(index)]})
            data, index, made = io.BytesIO(), [], made + 1
            return row

        for b in batches:
            for page_id, url, html, digest, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record(page_id, url, (html or "").encode(), digest, refers_to, revisit)
                raw = packer.compress(raw) + packer.flush()
                index.append(f"{json.dumps(url or '')} {DATE} " + json.dumps(
                    {"offset": data.tell(), "length": len(raw), "filename": DATA}) + "\n")
                data.write(raw)
                if data.tell() >= PACKAGE_BYTES:
                    yield close()
        if index:
            yield close()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write the pages as packages under ``folder`` (shared by all executors);
    the manifest (package, bytes, records), staged."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).alias("n"))
    first = stage(rows.filter(F.col("n") >= REVISIT_BYTES).groupBy("digest")
                  .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
                  .select("digest", "first", F.lit(True).alias("shared")), "payloads")
    revisit = F.coalesce("shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    tagged = join_staged(rows, first, "digest", "left", row_bytes=120).select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    return stage(tagged.mapInArrow(released(_writer(folder)), "package string, bytes long, records long"), "manifest")


def _locate(batches):
    """A row a record: the package and the absolute range of the record's bytes."""
    for b in batches:
        for package in b.column(0).to_pylist():
            files, path = open_fs(package)
            with files.open_input_file(path) as f:
                members = directory(f)
                base = stored_start(f, members[DATA])
                f.seek(stored_start(f, members[INDEX]))
                lines = f.read(members[INDEX]["size"]).decode().splitlines()
            places = [json.loads(x[x.rindex(" {") + 1:]) for x in lines]
            for k in range(0, len(places), 50_000):
                part = places[k:k + 50_000]
                yield pa.RecordBatch.from_pydict({
                    "package": pa.array([package] * len(part)), "offset": pa.array([base + p["offset"] for p in part], pa.int64()),
                    "length": pa.array([p["length"] for p in part], pa.int64())})


_RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _read(batches):
    name = f = None
    for b in batches:
        out, held = {k.split()[0]: [] for k in _RECORD.split(", ")}, 0
        for package, offset, length in zip(*(c.to_pylist() for c in b.columns[:3]), strict=True):
            if package != name:
                files, path = open_fs(package)
                name, f = package, files.open_input_file(path)
            f.seek(offset)
            r = parse(zlib.decompress(f.read(length), 31))
            revisit = r["warc-type"] == "revisit"
            row = (_id(r["warc-record-id"]), r["warc-target-uri"], r["warc-type"], _id(r.get("warc-refers-to")),
                   r["warc-payload-digest"].removeprefix("sha256:"), int(r["warc-payload-length"]),
                   None if revisit else r["payload"])
            for c, v in zip(out.values(), row, strict=True):
                c.append(v)
            held += len(r["payload"])
            if held >= PACKAGE_BYTES:
                yield _batch(out)
                out, held = {k: [] for k in out}, 0
        yield _batch(out)


def _batch(out):
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the packages, dealt by ranges of the packages to
    tasks of about ``PACKAGE_BYTES`` of records each (the index rows alone are
    too small for Spark to size the tasks by)."""
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-total // PACKAGE_BYTES))
    places = manifest.select("package").mapInArrow(released(_locate), "package string, offset long, length long")
    deal = F.floor(F.col("offset") / RANGE_BYTES)
    return places.repartition(tasks, "package", deal).sortWithinPartitions("package", "offset").mapInArrow(released(_read), _RECORD)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, f"llm-archives-{uuid.uuid4().hex}")
