"""WARC archives in Zstandard with a leading dictionary frame (operator 4).

An archive file starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; then each record is one Zstandard frame.  The reader loads the dictionary
from that frame, decodes one frame at a time and validates each record's headers and
lengths.  Archives are written by the tasks that hold the rows to the shared folder, under
a name per attempt, and take their final name at the end, so a task that runs again
leaves one whole file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocast.llm.shared import keep
from velocast.session import scratch_path

MAGIC = 0x184D2A5D  # fixed value: the skippable frame of a dictionary
FRAME = 0xFD2FB528  # fixed value: a Zstandard frame
SMALL = 100
SAMPLE_PAGES, SAMPLE_BYTES, DICT_BYTES = 500, 16 << 10, 64 << 10  # the dictionary is fitted on a bounded sample of rows


def record(kind: str, record_id: str, uri: str, digest: str, payload: bytes, refers: str = "") -> bytes:
    """One WARC 1.1 record; a revisit has no payload block but names what it repeats."""
    block = b"" if kind == "revisit" else payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload))),
            *([("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if refers else []),
            ("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict, bytes]:
    """Headers and block of one record; ValueError where a header or length is not right."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not lines[0].startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    found = {}
    for x in lines[1:]:
        k, colon, v = x.decode().partition(":")
        if not colon:
            raise ValueError(f"bad header {x!r}")
        found[k.strip().lower()] = v.strip()
    for k in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if k not in found:
            raise ValueError(f"no {k}")
    n = int(found["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("the block's length is not Content-Length")
    if found["warc-type"] == "response":
        if int(found["x-payload-length"]) != n or found["warc-payload-digest"] != f"sha256:{hashlib.sha256(rest[:n]).hexdigest()}":
            raise ValueError("the payload is not what its headers say")
    elif found["warc-type"] != "revisit" or "warc-refers-to" not in found:
        raise ValueError("not a response or revisit")
    return found, rest[:n]


def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", MAGIC, len(data)) + data


def read_archive(f) -> Iterator[tuple[dict, bytes]]:
    """Records of an open archive, decoded frame by frame in bounded memory."""
    buf, over = b"", False
    head = f.read(8)
    magic, n = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    data = f.read(n)
    if len(data) != n:
        raise ValueError("the dictionary frame is cut off")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data)) if n else zstandard.ZstdDecompressor()
    while True:
        if not buf and not over:
            buf = f.read(1 << 20)
            over = not buf
        if not buf:
            return
        if len(buf) < 4 and not over:
            buf += f.read(1 << 20)
        if struct.unpack("<I", buf[:4])[0] != FRAME:
            raise ValueError("not a Zstandard frame")
        one, parts = d.decompressobj(), []
        while not one.eof:
            parts.append(one.decompress(buf))
            buf = one.unused_data if one.eof else f.read(1 << 20)
            if not one.eof and not buf:
                raise ValueError("the last frame is cut off")
        yield parse(b"".join(parts))


def write(pages: DataFrame, root: str, dictionary: bytes, level: int = 3) -> DataFrame:
    """One archive per task under ``root`` from (page_id, url, html, digest, refers_to); returns (path, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        part = f"{base}/part-{TaskContext.get().partitionId():05d}.warc.zst"
        trial, n = f"{part}.{uuid.uuid4().hex}", 0
        c = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=level)
        with store.open_output_stream(trial, compression=None) as f:
            f.write(dictionary_frame(dictionary))
            for b in batches:
                for p, u, h, d, r in zip(*[b.column(i) for i in range(5)]):
                    refers = r.as_py()
                    f.write(c.compress(record("response" if refers is None else "revisit", p.as_py() or "null", u.as_py() or "",
                                              d.as_py(), (h.as_py() or "").encode(), refers or "")))
                    n += 1
        store.move(trial, part)
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n])], ["path", "records"])

    return pages.select(F.col("page_id").cast("string").alias("p"), "url", "html", "digest",
                        F.col("refers_to").cast("string").alias("r")).mapInArrow(run, "path string, records long")


def read(archives: DataFrame, root: str) -> DataFrame:
    """The records of the archives named in ``path``: one file is one task's work, in a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(root)
        for b in batches:
            for path, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out, got = [[], [], [], [], [], []], 0
                with store.open_input_stream(path, compression=None) as f:
                    for h, _ in read_archive(f):
                        got += 1
                        one = (h["warc-record-id"][10:-1], h.get("warc-target-uri"), h["warc-type"], int(h["x-payload-length"]),
                               h["warc-payload-digest"][7:], h.get("warc-refers-to", "")[10:-1] or None)
                        for c, v in zip(out, one):
                            c.append(v)
                        if got % 5000 == 0:
                            yield pa.RecordBatch.from_arrays([*map(pa.array, out[:3]), pa.array(out[3], pa.int64()), pa.array(out[4]), pa.array(out[5], pa.string())], NAMES)
                            out = [[], [], [], [], [], []]
                if got != n:
                    raise ValueError(f"{path} has {got} records, not {n}")
                if out[0]:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, out[:3]), pa.array(out[3], pa.int64()), pa.array(out[4]), pa.array(out[5], pa.string())], NAMES)

    n = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return archives.repartition(max(n, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path").mapInArrow(
        run, "page string, url string, record_type string, payload_bytes long, payload_digest string, refers string")


NAMES = ["page", "url", "record_type", "payload_bytes", "payload_digest", "refers"]


def archive(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Writes every row as a record and reads the archives back: (id, payload_bytes, payload_digest, record_type, refers_to).

    A null html is an empty payload.  Of equal payloads of at least 100 bytes the least id is the response; with repeated
    ids each of its rows is one, and null ids revisit the least id that is there, or are responses.  Extra columns are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # only payloads that repeat meet the join
    least = rows.where(F.octet_length("html") >= SMALL).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # cut where the rows are: the driver gets SAMPLE_PAGES times SAMPLE_BYTES at most
    head = F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES)
    sample = [bytes(r["head"]) for r in rows.select(head.alias("head")).limit(SAMPLE_PAGES).collect()]
    try:
        dictionary = zstandard.train_dictionary(DICT_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too few rows to fit one
        dictionary = b""
    full = rows.join(least, "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    root = scratch_path(spark, "warc")
    root = root if ":" in root else f"file://{root}"
    written = keep(write(full, root, dictionary))
    kind = pages.schema[id_col].dataType
    return read(written, root).select(F.when(F.col("page") != "null", F.col("page")).cast(kind).alias(id_col), "payload_bytes", "payload_digest",
                                      "record_type", F.col("refers").cast(kind).alias("refers_to"))
