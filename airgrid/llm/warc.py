"""WARC archives of records that are compressed one by one with a shared Zstandard dictionary.

A dictionary is trained on a bounded sample of records. Each archive starts with a skippable frame that holds it,
so that an archive can be read alone; every record is a frame of its own. Of records with equal payloads of
min_bytes or more, the one with the largest page id is a response and the others are revisits that name it.

Tasks write their archives into the shared folder, under a temporary name first, so a task that runs again puts the
same file in its place. The folder may be any that pyarrow's file systems open.

Edge cases: null html is an empty payload; a null url leaves out the target; a null page id is written as `null`,
counts as the smallest and reads back as null; rows that repeat page id and payload are equal, so each is a response
if that page id is the largest; without a page there is no archive; other columns are left out, whatever their names; a payload that was changed in
an archive is an error when it is read; if the sample is too small to train on, its
records are the dictionary as they are.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import bounded_sample, cut, shared_dir

#: Records of the sample and bytes of the dictionary at most.
SAMPLE, DICTIONARY_BYTES, LEVEL = 600, 1 << 16, 6
#: Bytes of records that a task hands on at a time.
BATCH_BYTES = 1 << 24
#: Fixed value: the magic number of the skippable frame that holds the dictionary.
MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    name = "null" if page_id is None else page_id
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    head.append(("WARC-Payload-Digest", "sha1:" + digest(payload)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + END + block + END + END


def fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if ": " in line)


def parse(data: bytes) -> dict:
    """What a record says, with the payload of a response, which must have the digest and the length that it says."""
    head, rest = data.split(b"\r\n\r\n", 1)
    h = fields(head)
    block = rest[: int(h["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    name = h["WARC-Record-ID"][len("<urn:page:") : -1]
    target = h.get("WARC-Refers-To")
    said, size, response = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields(http)["Content-Length"]), h["WARC-Type"] == "response"
    if response and (len(payload) != size or digest(payload) != said):
        raise ValueError(f"the payload of {h['WARC-Record-ID']} is not the one that was written")
    return {
        "page_id": None if name == "null" else int(name),
        "url": h.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": said,
        "record_type": h["WARC-Type"],
        "refers_to": int(target[len("<urn:page:") : -1]) if target else None,
        "payload": payload if response else None,
    }


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def opened(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1))


def read_records(stream) -> Iterator[bytes]:
    """The records of one archive, frame by frame; no more than a frame and a buffer is held."""
    head = stream.read(8)
    if not head:
        return
    magic, size = struct.unpack("<II", head)
    assert magic == MAGIC, "no dictionary frame"
    d = stream.read(size)
    tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d)) if d else zstandard.ZstdDecompressor()
    rest = stream.read(1 << 16)
    while rest:
        frame, out = tool.decompressobj(), []
        while not frame.eof:
            if not rest and not (rest := stream.read(1 << 16)):
                raise EOFError("an archive ends inside a record")
            out.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(out)
        rest = rest or stream.read(1 << 16)


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """(path, records) of each archive written."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("h", F.sha2("html", 256))
    last = rows.groupBy("h").agg(F.max("page_id").alias("last"), F.max(F.octet_length("html")).alias("n"))
    ready = rows.join(last, "h")
    refers = F.when((F.col("n") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    ready = ready.select("page_id", "url", "html", refers.alias("refers_to"))
    sample = bounded_sample(rows.withColumn("one", F.lit(1)), "one", SAMPLE, 10, "page_id", ("url", "html")).orderBy("page_id")
    d = dictionary([record(r["page_id"], r["url"], r["html"].encode("utf-8", "replace"), None) for r in sample.collect()])
    shared = spark.sparkContext.broadcast(d)  # DICTIONARY_BYTES at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, base = opened(folder)
        where.create_dir(base, recursive=True)
        task = TaskContext.get()
        path = f"{base}/part-{task.partitionId():06d}.warc.zst"
        trial = f"{path}.{task.taskAttemptId()}.tmp"
        tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value)) if shared.value else zstandard.ZstdCompressor(level=LEVEL)
        n = 0
        with where.open_output_stream(trial, compression=None) as out:
            out.write(struct.pack("<II", MAGIC, len(shared.value)) + shared.value)
            for b in batches:
                for page_id, url, html, refers_to in zip(b["page_id"], b["url"], b["html"], b["refers_to"], strict=True):
                    whole = lambda x: None if pd.isna(x) else int(x)
                    out.write(tool.compress(record(whole(page_id), url, html.encode("utf-8", "replace"), whole(refers_to))))
                    n += 1
        where.move(trial, path)
        yield pd.DataFrame({"path": [f"{folder}/{os.path.basename(path)}"], "records": [n]})

    # Page ids above 2^53 don't fit the doubles that pandas takes for integers with nulls: they travel as text.
    ready = ready.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return cut(ready.mapInPandas(run, "path string, records long"))


def read(archives: DataFrame) -> DataFrame:
    """A row for each record of the archives at `path`: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload."""

    n = max(1, archives.count())
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "url": pa.string(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                where, path = opened(p)
                with where.open_input_stream(path, compression=None) as stream:
                    held, size = [], 0
                    for data in read_records(stream):
                        held.append(parse(data))
                        size += len(data)
                        if len(held) >= 500 or size >= BATCH_BYTES:
                            yield batch(held)
                            held, size = [], 0
                    yield batch(held)

    def batch(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kind) for k, kind in kinds.items()], names=list(kinds))

    return archives.select("path").repartition(n).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")
