"""Legacy web archives (ARC 1 and 2) to WARC, with revisit records for equal payloads.

An ARC container starts with a ``filedesc`` record whose body names its version
and the fields of its header lines.  Records are one header line and exactly the
declared number of bytes; the line's fields are read by the names that the
container gives, so both versions (and other field orders) parse alike.
Containers may be plain or gzip members.

Each record becomes a WARC record: the 14-digit date becomes a WARC timestamp,
the HTTP block is split at its empty line, its body gets the SHA-1 payload
digest, and the record identifier is a version-8 UUID that carries the record's
number, so that a revisit can name the record it refers to.  Of records with
equal payloads the one with the largest number is the response; the others are
written as revisits, without payload.

Digests are grouped apart from payloads: only numbers and digests are shuffled,
and only records that become revisits meet their target in a join.  Writers roll
files by size, name them by attempt, and return a manifest, which alone is read
back: files of lost attempts are never seen.

Defined results: null html is the empty payload; a null page_id gives a response
that nothing refers to; rows that repeat the response's page_id are responses
too; a null or blank url becomes ``about:blank``, white space in urls is
percent-encoded; an empty table gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from manifestqc.llm.common import checkpoint, exact_ids, id_array, id_list, split_by_ids
from manifestqc.sources.files import file_system

DATE = "20080430204825"
# Field names of the two ARC versions, as their version blocks state them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NUMBER_HEADER = "X-Page-Id"
CONTAINER_BYTES = 4 << 20
FILE_BYTES = 64 << 20
RECORDS = "page_id long, url string, ip string, date string, mime string, http binary, payload_bytes long, payload_digest string"
BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, warc_date string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ARC


def arc_line(version: int, url: str, ip: str, date: str, mime: str, length: int, name: str, status: str = "200", offset: int = 0) -> bytes:
    values = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": mime, "Archive-length": str(length),
              "Result-code": status, "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name}
    return (" ".join(values[f] for f in ARC_FIELDS[version].split()) + "\n").encode()


def arc_head(version: int, name: str, date: str = DATE) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name) + body


def safe_url(url) -> str:
    url = url if isinstance(url, str) and url.strip() else "about:blank"
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def arc_containers(pages: DataFrame, container_bytes: int = CONTAINER_BYTES) -> DataFrame:
    """ARC containers (one binary ``content`` each) of the pages, versions 1 and 2 in turn."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        version, parts, size = 1, [], 0
        for pdf in frames:
            for page, url, html in zip(id_list(pdf["page_id"]), pdf["url"], pdf["html"]):
                name = f"pages-v{version}.arc"
                if not parts:
                    parts, size = [arc_head(version, name)], 0
                number = "" if page is None else f"{NUMBER_HEADER}: {page}\r\n"
                payload = html.encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}\r\n".encode() + payload
                parts += [arc_line(version, safe_url(url), "192.0.2.1", DATE, "text/html", len(http), name, offset=size), http, b"\n"]
                size += len(http)
                if size >= container_bytes:
                    yield pd.DataFrame({"content": [b"".join(parts)]})
                    version, parts = 3 - version, []
        if parts:
            yield pd.DataFrame({"content": [b"".join(parts)]})

    return exact_ids(pages.select("page_id", "url", "html"), "page_id").mapInPandas(run, "content binary")


def gunzip_members(data: bytes, step: int = 1 << 15) -> Iterator[bytes]:
    """Each gzip member, fed in small steps (what is left over is copied, so it must not be the rest of the file)."""
    at = 0
    while at < len(data):
        one, parts = zlib.decompressobj(31), []
        while not one.eof:
            piece = data[at:at + step]
            if not piece:
                raise ValueError("the last gzip member is not complete")
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of every record after the version block."""
    if data[:2] == b"\x1f\x8b":
        data = b"".join(gunzip_members(data))
    at, fields = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace").split(" ")
        if fields is None:
            length = int(line[-1])  # the declared length is last in every version
            version = data[end + 1:end + 1 + length].split(b"\n")
            if not line[0].startswith("filedesc://") or version[0].split(b" ")[0] not in (b"1", b"2"):
                raise ValueError("not an ARC container of version 1 or 2")
            fields = version[1].rstrip(b"\r").decode().split(" ")
        else:
            if len(line) > len(fields):  # blanks in the URL, which comes first
                line = [" ".join(line[:len(line) - len(fields) + 1]), *line[len(line) - len(fields) + 1:]]
            if len(line) != len(fields):
                raise ValueError(f"ARC header line with {len(line)} of {len(fields)} fields at byte {at}")
            header = dict(zip(fields, line))
            length = int(header["Archive-length"])
            if end + 1 + length > len(data):
                raise ValueError(f"ARC record at byte {at} is shorter than declared")
            yield header, data[end + 1:end + 1 + length]
        at = end + 1 + length
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its empty line, and body."""
    m = re.search(rb"\r?\n\r?\n", block)
    return (block[:m.end()], block[m.end():]) if m else (block, b"")


def arc_records(containers: DataFrame, with_http: bool = True) -> DataFrame:
    """RECORDS of binary ``content`` rows (such as Spark's binaryFile source gives)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for pdf in frames:
            for content in pdf["content"]:
                rows = []
                for h, block in parse_arc(content):
                    head, payload = split_http(block)
                    m = re.search(NUMBER_HEADER.encode() + rb": (-?[0-9]+)", head)
                    rows.append((int(m[1]) if m else None, h["URL"], h["IP-address"], h["Archive-date"], h["Content-type"],
                                 block if with_http else None, len(payload), sha1_base32(payload)))
                yield pd.DataFrame(rows, columns=names).assign(page_id=id_array([r[0] for r in rows]))

    return containers.select("content").mapInPandas(run, RECORDS)


# WARC


def record_uuid(number: int | None) -> str:
    """Version-8 UUID that holds a 64-bit number; without one a random UUID."""
    if number is None:
        return f"<urn:uuid:{uuid.uuid4()}>"
    n = number & (1 << 64) - 1
    value = (n >> 32) << 96 | 0x5741 << 80 | 0x8 << 76 | 0x2 << 62 | n & 0xFFFFFFFF
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def uuid_number(urn: str | None) -> int | None:
    if not urn:
        return None
    value = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 76 & 0xF != 8:
        return None
    n = (value >> 96) << 32 | value & 0xFFFFFFFF
    return n - (1 << 64) if n >> 63 else n


def warc_date(arc_date: str) -> str:
    d = (arc_date + "00000000000000")[:14] if arc_date.isdigit() else DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    gz = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def convert(page_id: int | None, url: str, ip: str, date: str, block: bytes, n_bytes: int, digest: str, refers_to: int | None) -> bytes:
    head, _ = split_http(block)
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_uuid(page_id)),
               ("WARC-Date", warc_date(date)), ("WARC-Target-URI", url), ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        return warc_record([*headers, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")], block)
    return warc_record([*headers, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uuid(refers_to)), ("X-Payload-Length", str(n_bytes))], head)


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, refers_to) of the records that repeat the payload of a record with a larger number."""
    small = checkpoint(records.where(f"page_id is not null and payload_bytes >= {min_bytes}").select("page_id", "payload_digest", "payload_bytes"))
    last = checkpoint(small.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    return checkpoint(small.join(last, ["payload_digest", "payload_bytes"]).where("page_id <> refers_to").select(F.col("page_id").alias("doc_id"), "refers_to").distinct())


def write_warc(records: DataFrame, base: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes RECORDS with ``refers_to`` as gzip WARC files under ``base``; checkpointed manifest (path, n, bytes)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = file_system(base)
        where.create_dir(root, recursive=True)
        sink, rows = None, []

        def close() -> None:
            nonlocal sink
            if sink is not None:
                sink.close()
                sink = None

        for pdf in frames:
            for r in pdf.itertuples(index=False):
                if sink is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    sink = where.open_output_stream(path, compression=None)
                    info = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uuid(None)), ("WARC-Date", warc_date(DATE)),
                                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    sink.write(info)
                    rows.append([path, 0, len(info)])
                page, refers_to = id_list(pd.Series([r.page_id, r.refers_to], dtype=object))
                data = convert(page, r.url, r.ip, r.date, r.http, int(r.payload_bytes), r.payload_digest, refers_to)
                sink.write(data)
                rows[-1][1] += 1
                rows[-1][2] += len(data)
                if rows[-1][2] >= file_bytes:
                    close()
        close()
        yield pd.DataFrame(rows, columns=["path", "n", "bytes"])

    return checkpoint(exact_ids(records, "page_id", "refers_to").mapInPandas(run, "path string, n long, bytes long"))


def parse_warc(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


def read_warc(manifest: DataFrame, base: str) -> DataFrame:
    """BACK of every response and revisit in the manifest's files; payload digests are computed, and must agree."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, _ = file_system(base)
        names = [c.split()[0] for c in BACK.split(", ")]
        for pdf in frames:
            for path, n in zip(pdf["path"], pdf["n"]):
                rows = []
                with where.open_input_stream(path, compression=None) as f:
                    data = f.read()
                for member in gunzip_members(data):
                    h, block = parse_warc(member)
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response":
                        payload = split_http(block)[1]
                        size, digest = len(payload), sha1_base32(payload)
                        if digest != stated:
                            raise ValueError(f"payload digest of {h['WARC-Record-ID']} in {path} does not hold")
                    else:
                        size, digest = int(h["X-Payload-Length"]), stated
                    rows.append((uuid_number(h["WARC-Record-ID"]), size, digest, h["WARC-Type"], uuid_number(h.get("WARC-Refers-To")),
                                 h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Date"]))
                if len(rows) != n:
                    raise ValueError(f"{path} holds {len(rows)} records, the manifest says {n}")
                yield pd.DataFrame(rows, columns=names).assign(page_id=id_array([r[0] for r in rows]), refers_to=id_array([r[4] for r in rows]))

    parts = max(1, manifest.count())
    return manifest.select("path", "n").repartition(min(parts, 100_000), "path").mapInPandas(run, BACK)


def converted(containers: DataFrame, base: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """ARC containers to WARC files under ``base``; returns the manifest."""
    again = revisits(arc_records(containers, with_http=False), min_bytes)
    records = arc_records(containers).withColumn("doc_id", F.col("page_id"))
    same, some = split_by_ids(records, again)
    marked = same.withColumn("refers_to", F.lit(None).cast("long")).unionByName(some.join(again, "doc_id", "left"))
    return write_warc(marked.drop("doc_id"), base, file_bytes)
