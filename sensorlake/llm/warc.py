"""WARC archives: records written beside an index of places, read back by sorted, joined byte ranges.

Each task writes files of its own name, so a task that runs again leaves the files of a lost one unread: only files named by the
committed index count. Reading starts from the index: its entries, sorted by file and offset, become few long reads.

Defined results: a null payload is empty; of equal payloads of at least ``min_bytes`` the record of the largest id is the response
and the others revisit it; rows that repeat that id are all responses; a null url is written as ``urn:none``, a null id as -1; an empty
table writes no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import kept, table
from sensorlake.session import scratch_dir

FILE_BYTES = 256 << 20
READ_GAP = 64 << 10
READ_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"

INDEX_SCHEMA = "page_id bigint, url string, file string, offset bigint, length bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit has no payload; it names the response and the length and digest of the whole one."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = payload if refers_to is None else b""
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n", compresslevel=5, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _open(path: str):
    """File system and path of a shared folder, as tasks see it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to. Only ids and digests are shuffled to find equal payloads."""
    rows = pages.select(F.coalesce(F.col("page_id").cast("bigint"), F.lit(-1)).alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    keys = rows.select("page_id", F.sha1(F.col("payload").cast("binary")).alias("sha"), F.octet_length("payload").alias("size")).filter(F.col("size") >= min_bytes)
    firsts = keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("refers_to <> least").drop("least")
    return rows.withColumn("sha", F.sha1(F.col("payload").cast("binary"))).join(firsts, "sha", "left").select(
        "page_id", "url", "payload", F.when((F.col("refers_to") != F.col("page_id")) & (F.octet_length("payload") >= min_bytes), F.col("refers_to")).alias("refers_to")
    )


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` (page_id, url, payload, refers_to) and return the stored index."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for page_id, url, text, ref in zip(batch["page_id"], batch["url"], batch["payload"], batch["refers_to"]):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", 0
                        files, path = _open(name)
                        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        out = files.open_output_stream(path, compression=None)
                    payload = text.encode("utf-8", "surrogatepass")
                    ref = None if pd.isna(ref) else int(ref)
                    data = record(page_id, url, payload, ref)
                    out.write(data)
                    kind = "response" if ref is None else "revisit"
                    index.append((page_id, url, name, at, len(data), len(payload), digest(payload), kind, ref))
                    at += len(data)
                frame = pd.DataFrame(index, columns=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])
                yield frame.astype({"refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    return kept(rows.mapInPandas(write, INDEX_SCHEMA), "warc-index")


def ranges(entries: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, number of entries) of reads that join neighbours; ``entries`` are (offset, length) in order."""
    out: list[list[int]] = []
    for offset, length in entries:
        if out and offset - out[-1][1] <= READ_GAP and offset + length - out[-1][0] <= READ_BYTES:
            out[-1][1], out[-1][2] = max(out[-1][1], offset + length), out[-1][2] + 1
        else:
            out.append([offset, offset + length, 1])
    return [tuple(x) for x in out]


def read_records(index: DataFrame, carry_payload: bool = False) -> DataFrame:
    """What the archives say of the selected index entries; a response's digest is computed again from its bytes."""
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" + (", payload binary" if carry_payload else "")
    # A file goes to as many tasks as it has stretches of 64 MB; within a task, entries are in order of place.
    placed = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / (64 << 20)))
    placed = placed.repartition("file", "stretch").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("file", sort=False):
                files, path = _open(name)
                entries = list(zip(part["offset"], part["length"]))
                with files.open_input_file(path) as source:
                    done = 0
                    for start, end, n in ranges(entries):
                        data, out = source.read_at(int(end - start), int(start)), []
                        for offset, length in entries[done : done + n]:
                            fields, block = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                            ref = fields.get("WARC-Refers-To")
                            row = [
                                int(fields["WARC-Record-ID"][10:-1]), fields["WARC-Target-URI"],
                                len(block) if ref is None else int(fields["X-Payload-Length"]),
                                digest(block) if ref is None else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                fields["WARC-Type"], None if ref is None else int(ref[10:-1]),
                            ]
                            out.append(row + [block] if carry_payload else row)
                        done += n
                        yield pd.DataFrame(out, columns=[c.strip().split()[0] for c in schema.split(",")]).astype({"refers_to": "Int64"})

    return placed.mapInPandas(read, schema)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(with_references(table(spark, sf_dir, "pages")), scratch_dir(spark, "warc"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
