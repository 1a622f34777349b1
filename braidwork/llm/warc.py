"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends with the seek table of the
seekable format (a skippable frame, so any Zstandard tool reads the file), and an
index maps each record to its frame and its place inside.  One frame is all that a
look-up decompresses and all that a task holds, as a writer or as a reader.

Equal payloads are found by digest before anything is written: the narrow digest
table is shuffled, the payloads once only, on their way into the bundles.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import NewFile, fresh_path, open_folder, stage

#: Payloads of fewer bytes are always responses.
LEAST_SHARED = 1000
FRAME, BUNDLE = 1 << 20, 256 << 20
#: A reader's task gets about so many bytes of records, in runs of so many frames.
READ, RUN = 32 << 20, 16
DATE = "1970-01-01T00:00:00Z"
#: The seekable format's fixed numbers.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def urn(page_id, sha1: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{sha1}>"


def record(page_id, url: str | None, payload: bytes, sha1: str, refers_to) -> bytes:
    """One record; a revisit keeps the HTTP header, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {urn(page_id, sha1)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}"]
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn(refers_to, sha1)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes, at: int = 0):
    """(headers, block, end) of the record at ``at``."""
    stop = frame.index(b"\r\n\r\n", at)
    first, *lines = frame[at:stop].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record starts here")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)}
    begin = stop + 4
    end = begin + int(headers["content-length"])
    return headers, frame[begin:end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer for frames of (compressed, raw) sizes."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame, from the end of the file."""
    file.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * frames)
    out, at = [], 0
    for packed, _ in struct.iter_unpack("<II", file.read(8 * frames)):
        out.append((at, packed))
        at += packed
    return out


INDEX = "record_id string, page_id long, file string, frame int, at long, length long"


def plan_revisits(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, sha1, refers_to) of pages whose payload a larger page id also has."""
    payload = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    seen = pages.select(F.col(id_col).alias("page_id"), F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("n")).where(F.col("n") >= least)
    seen = stage(seen.drop("n"), "digests")
    largest = seen.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    return seen.join(largest, "sha1").where(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "sha1", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """Write a record per row; returns the index (record_id, page_id, file, frame, at, length).

    Of rows with equal payloads of at least ``least`` bytes the one with the largest
    id is a response, and rows that repeat that id are responses too; the others,
    null ids included, revisit it.  Rows with null ids only are all responses.  A
    null body is an empty payload.  A bundle's name is new for each attempt of a
    task, and the index names those of the attempts that counted.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"), F.sha1(body).alias("sha1"))
    named = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    to = stage(plan_revisits(pages, id_col, body_col, least), "revisits").select(named.alias("_key"), F.col("sha1").alias("_sha1"), "refers_to")
    joined = rows.withColumn("key", named).join(to, (F.col("key") == F.col("_key")) & (F.col("sha1") == F.col("_sha1")), "left")

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        packer = zstandard.ZstdCompressor(level=3)
        file, sizes, held, rows, size, total = None, [], [], [], 0, 0

        def close_frame():
            nonlocal file, held, size
            if held:
                file = file or NewFile(folder, f"pages-{part:06d}-{number:04d}-{uuid.uuid4().hex[:12]}.warc.zst")
                packed = packer.compress(b"".join(held))
                file.out.write(packed)
                sizes.append((len(packed), size))
                held, size = [], 0

        def close_bundle():
            nonlocal file, sizes, rows, total, number
            close_frame()
            file.out.write(seek_table(sizes))
            file.finish()
            name = file.path.rsplit("/", 1)[1]
            out = pa.record_batch(
                [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()), pa.array([name] * len(rows)), *[pa.array([r[k] for r in rows], t) for k, t in ((2, pa.int32()), (3, pa.int64()), (4, pa.int64()))]],
                ["record_id", "page_id", "file", "frame", "at", "length"],
            )
            file, sizes, rows, total, number = None, [], [], 0, number + 1
            return out

        for b in batches:
            cols = b.to_pydict()
            for page, url, payload, sha1, refers in zip(cols["page_id"], cols["url"], cols["payload"], cols["sha1"], cols["refers_to"]):
                raw = record(page, url, payload, sha1, refers)
                rows.append((urn(page, sha1), page, len(sizes), size, len(raw)))
                held.append(raw)
                size += len(raw)
                total += len(raw)
                if size >= FRAME:
                    close_frame()
                if total >= BUNDLE:
                    yield close_bundle()
        if rows:
            yield close_bundle()

    return stage(joined.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of the indexed records.

    ``index`` may be any part of the index: only frames that hold its records are
    read, and in them only its records.  Digests are bare lower-case hex; a
    response's is checked against its payload."""

    def run(batches):
        store, path = open_folder(folder)
        for b in batches:
            cols = b.to_pydict()
            for name, places in zip(cols["file"], cols["places"]):
                with store.open_input_file(f"{path}/{name}") as file:
                    table, by = read_seek_table(file, file.size()), {}
                    for p in places:
                        by.setdefault(p["frame"], []).append(p["at"])
                    for frame in sorted(by):
                        offset, packed = table[frame]
                        file.seek(offset)
                        yield records(zstandard.ZstdDecompressor().decompress(file.read(packed)), sorted(by[frame]))

    def records(data, places):
        out = []
        for at in places:
            head, block, _ = parse(data, at)
            http, _, payload = block.partition(b"\r\n\r\n")
            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
            n = int(re.search(rb"Content-Length: (\d+)", http)[1])
            whole = head["warc-type"] == "response"
            if whole and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                raise ValueError(f"{head['warc-record-id']} is damaged")
            page, refers = (re.search(r"<urn:page:(-?\d*):", head.get(k, "<urn:page::>"))[1] for k in ("warc-record-id", "warc-refers-to"))
            out.append((int(page) if page else None, head["warc-target-uri"], head["warc-type"], n, digest, int(refers) if refers else None, payload if whole else None))
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    # The index is small beside what it points to: its own size must not set the tasks.
    total = index.agg(F.sum("length")).first()[0] or 0
    runs = index.withColumn("run", F.expr(f"frame div {RUN}")).repartition(max(1, -(-total // READ)), "file", "run")
    frames = runs.groupBy("file", "run").agg(F.collect_list(F.struct("frame", "at")).alias("places")).drop("run")
    return frames.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write the archives into a fresh shared folder, then read them all back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **how), folder)
