"""WARC archives packaged in ZIP files: writer, and a reader that extracts nothing.

A package holds one stored member ``archive/data.warc.gz`` (one gzip member per record) and one
stored member ``indexes/index.cdxj`` (a line per record with its place). Packages go to the shared
folder; names are unique per attempt, and only packages in the written manifest are read, so a
task that runs twice leaves no second copy of a record.

The reader parses the end record, its ZIP64 form and the central directory by ranged reads, finds
the data of stored members, streams the index, deals out the record places, and reads just
those byte ranges.
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
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, shared_path, shared_table

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20    # compressed records of a package
READ_AHEAD = 4 << 20        # neighbouring records fetched by one ranged read
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, url string, record_type string, refers_to string, payload_bytes long, "
          "payload_digest string, payload binary")


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_uri(page_id) -> str:
    return "<urn:x-page:" + ("" if page_id is None else quote(str(page_id), safe="")) + ">"


def page_of(uri: str | None) -> str | None:
    return (unquote(uri[len("<urn:x-page:"):-1]) or None) if uri else None


def warc_record(page_id, url: str | None, payload: bytes, first) -> tuple[bytes, str, str]:
    """(record, payload digest, target); a revisit of ``first`` unless that is ``page_id``."""
    digest, uri = base32_sha1(payload), record_uri(page_id)
    target = quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else uri[1:-1]
    revisit = first is not None and first != page_id
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", uri),
            ("WARC-Date", DATE), ("WARC-Target-URI", target),
            ("Content-Type", "application/http;msgtype=response"),
            ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(first))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", len(body))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n", digest, target


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def parse_record(raw: bytes) -> dict:
    """Fields of one WARC record; the digest of a response is taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = parse_headers(head)
    body = rest[:int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and base32_sha1(payload) != named:
        raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
    return {"record_id": page_of(fields["warc-record-id"]), "url": fields["warc-target-uri"],
            "record_type": fields["warc-type"], "refers_to": page_of(fields.get("warc-refers-to")),
            "payload_bytes": int(parse_headers(http)["content-length"]) if revisit else len(payload),
            "payload_digest": named, "payload": None if revisit else payload}


def _open_fs(uri: str):
    return arrow_fs.FileSystem.from_uri(uri)


class _Package:
    """A package being written to the shared folder."""

    def __init__(self, root: str):
        self.path = f"{root}/{uuid.uuid4().hex}.wacz"
        fs, path = _open_fs(self.path)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index = io.BytesIO()
        self.size = self.records = 0

    def add(self, page_id, url, payload: bytes, first) -> None:
        record, digest, target = warc_record(page_id, url, payload, first)
        body = gzip.compress(record, 5, mtime=0)
        self.data.write(body)
        place = {"url": target, "digest": f"sha1:{digest}", "mime": "text/html", "status": "200",
                 "filename": ARCHIVE.rsplit("/", 1)[1], "offset": self.size, "length": len(body)}
        self.index.write(f"{target} {DATE} {json.dumps(place)}\n".encode())
        self.size += len(body)
        self.records += 1

    def close(self) -> dict:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write(self.index.getbuffer())
        self.zip.close()
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.size}


def _write(root: str, most: int):
    def run(frames):
        package = None
        for frame in frames:
            for page_id, url, payload, first in zip(frame["page_id"], frame["url"],
                                                    frame["payload"], frame["first"]):
                package = package or _Package(root)
                package.add(page_id, url, payload, first)
                if package.size >= most:
                    yield pd.DataFrame([package.close()])
                    package = None
        if package:
            yield pd.DataFrame([package.close()])
    return run


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   body_col: str = "html", least_bytes: int = 0,
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record per row and return the manifest: path, records, bytes of each package.

    Of rows with equal bodies of at least ``least_bytes`` bytes the one with the largest id becomes
    a response and the others revisits of it; rows that tie at the largest id, and groups without
    any id, are responses. A null body is empty; a null url is replaced by a name made of
    the id. Other columns are ignored. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(id_col).alias("id"),
                        F.col(url_col).alias("url"), body.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    narrow = shared_table(rows.filter(F.length("payload") >= least_bytes).select("id", "sha"), "digests")
    same = (narrow.groupBy("sha").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 and top is not null").select("sha", "top"))
    # only rows that revisit another one; ids and digests, no bodies
    again = (narrow.join(same, "sha").filter(~F.col("id").eqNullSafe(F.col("top"))).distinct()
             .select(F.col("id").alias("id_"), F.col("sha").alias("sha_"),
                     F.col("top").cast("string").alias("first")))
    joined = rows.join(again, rows["id"].eqNullSafe(again["id_"]) & (rows["sha"] == again["sha_"]), "left")
    root = shared_path(spark, "packages")
    manifest = joined.select("page_id", "url", "payload", "first").mapInPandas(
        _write(root, package_bytes), "path string, records long, bytes long")
    return shared_table(manifest, "manifest")


# ---- reading -------------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int           # bytes stored
    header_at: int


def read_at(f, at: int, n: int) -> bytes:
    f.seek(at)
    got = f.read(n)
    if len(got) != n:
        raise ValueError("package ends too early")
    return got


def _directory_place(f, size: int) -> tuple[int, int, int]:
    """(entries, offset, bytes) of the central directory, from the end record or its ZIP64 form."""
    tail_at = max(0, size - 22 - 65535)
    tail = read_at(f, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06", 0, len(tail) - 18)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at + 3)
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    entries, length, offset = struct.unpack_from("<HLL", tail, at + 10)
    end_at = tail_at + at
    if end_at >= 20 and (locator := read_at(f, end_at - 20, 20))[:4] == b"PK\x06\x07":
        big = read_at(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if big[:4] != b"PK\x06\x06":
            raise ValueError("bad ZIP64 end record")
        entries, length, offset = struct.unpack_from("<QQQ", big, 32)
    return entries, offset, length


def central_directory(f, size: int) -> list[Member]:
    """Members of a ZIP file, by ranged reads of its directory only."""
    entries, offset, length = _directory_place(f, size)
    raw, at, out = read_at(f, offset, length), 0, []
    for _ in range(entries):
        if raw[at:at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        stored, full = struct.unpack_from("<LL", raw, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
        header_at = struct.unpack_from("<L", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
        e = 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # 64-bit values, only of the fields that overflow, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                if full == 0xFFFFFFFF:
                    full = wide.pop(0)
                if stored == 0xFFFFFFFF:
                    stored = wide.pop(0)
                if header_at == 0xFFFFFFFF:
                    header_at = wide.pop(0)
            e += 4 + n
        out.append(Member(name, method, stored, header_at))
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(f, member: Member) -> int:
    """Place of a stored member's first byte."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read in place")
    head = read_at(f, member.header_at, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("bad local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header_at + 30 + n_name + n_extra


def _lines(f, start: int, size: int, step: int = 1 << 20):
    rest = b""
    for at in range(start, start + size, step):
        parts = (rest + read_at(f, at, min(step, start + size - at))).split(b"\n")
        rest = parts.pop()
        yield from parts
    if rest:
        yield rest


def _open(uri: str):
    fs, path = _open_fs(uri)
    return fs.open_input_file(path)


def _places(frames):
    """Places of all records, from the indexes of the packages."""
    for frame in frames:
        for path in frame["path"]:
            with _open(path) as f:
                members = central_directory(f, f.size())
                start = {m.name.rsplit("/", 1)[1]: data_start(f, m)
                         for m in members if m.name.startswith("archive/")}
                rows: list[tuple[str, int, int]] = []
                for m in members:
                    if m.name.startswith("indexes/"):
                        for line in _lines(f, data_start(f, m), m.size):
                            place = json.loads(line[line.index(b"{"):])
                            rows.append((path, start[place["filename"]] + int(place["offset"]),
                                         int(place["length"])))
                            if len(rows) == 10_000:
                                yield pd.DataFrame(rows, columns=["path", "at", "length"])
                                rows = []
                yield pd.DataFrame(rows, columns=["path", "at", "length"])


def _fetch(with_payload: bool):
    def run(frames):
        path, f, base, held = None, None, 0, b""
        try:
            for frame in frames:
                at, length = frame["at"].tolist(), frame["length"].tolist()
                paths, out = frame["path"].tolist(), []
                for i, p in enumerate(paths):
                    if p != path:
                        if f:
                            f.close()
                        path, f, base, held = p, _open(p), 0, b""
                    if not base <= at[i] <= at[i] + length[i] <= base + len(held):
                        j, end = i, at[i] + length[i]  # one read for neighbours in the file
                        while (j + 1 < len(paths) and paths[j + 1] == p and at[j + 1] == end
                               and end + length[j + 1] - at[i] <= READ_AHEAD):
                            j += 1
                            end += length[j]
                        base, held = at[i], read_at(f, at[i], end - at[i])
                    raw = held[at[i] - base:at[i] - base + length[i]]
                    out.append(parse_record(zlib.decompress(raw, wbits=31)))
                got = pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])
                if not with_payload:
                    got["payload"] = None
                yield got
        finally:
            if f:
                f.close()
    return run


def read_packages(manifest: DataFrame, with_payload: bool = True, per_task: int = 16 << 20) -> DataFrame:
    """One row per record of the packages in ``manifest`` (path, bytes): record_id, url,
    record_type, refers_to, payload_bytes, payload_digest, payload (null for revisits).

    Records are dealt to tasks by stretches of ``per_task`` bytes of a package, so large packages are
    read by many tasks. A damaged package is an error.
    """
    places = manifest.select("path").mapInPandas(_places, "path string, at long, length long")
    stretch = F.floor(F.col("at") / per_task)
    # places are small rows for much data: the number of tasks follows the bytes to read
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n = 2 * partitions_for(total, per_task, 1)
    return (places.withColumn("stretch", stretch).repartition(n, "path", "stretch")
            .sortWithinPartitions("path", "at").select("path", "at", "length")
            .mapInPandas(_fetch(with_payload), RECORD))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       body_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the packages and read them back: id, payload_bytes, payload_digest, record_type,
    refers_to for every row of ``pages``."""
    kind = dict(pages.dtypes)[id_col]
    back = read_packages(write_packages(pages, id_col, url_col, body_col, least_bytes), False)
    return back.select(F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
