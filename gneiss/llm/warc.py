"""A deterministic, sharded WARC writer and its reader.

Records are dealt to shards by ranges of page_id whose bytes balance, sorted
in each shard and written as one gzip member each; a file ends when its
compressed size reaches `roll_bytes`. Nothing in a file depends on the run: the date
is a parameter, record ids and digests come from the content, gzip headers
carry no time. A task writes under a temporary name of its attempt and renames
when the file is whole; the manifest, written last and by Spark, lists the
files that count, so what a lost executor leaves behind is never read.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.lineage import cut, shared_dir, small

#: Payloads of fewer bytes are always stored whole.
LEAST_REVISIT = 100
#: Equal-width ranges of page_id whose bytes are summed to balance the shards, and the bits that a crowded one is split by.
CELLS, BITS = 4096, 12

_MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the folder's path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; with refers_to a revisit, which has the HTTP header but no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": "".join(c for c in url or "" if c.isprintable() and c != " "),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "Page-Id": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _record_id(refers_to, digest), "Refers-To-Page-Id": str(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Roller:
    """Files of one shard, one after the other."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.store, self.path = file_system(uri)
        self.shard, self.roll, self.n, self.out = shard, roll_bytes, 0, None
        self.attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0

    def add(self, data: bytes) -> tuple | None:
        """Writes a record; the manifest row of the file that this ends, if any."""
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.n:06d}.warc.gz"
            self.temp = f"{self.path}/_tmp-{self.name}-{self.attempt}"
            self.out, self.size, self.records, self.sha = self.store.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1
        return self.end() if self.size >= self.roll else None

    def end(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.store.move(self.temp, f"{self.path}/{self.name}")
        self.out, self.n = None, self.n + 1
        return self.shard, self.name, self.records, self.size, self.sha.hexdigest()


def _write(uri: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, done = None, []
        for batch in batches:
            for shard, page_id, url, html, digest, refers_to in zip(*(batch.column(c) for c in ("shard", "page_id", "url", "html", "payload_digest", "refers_to"))):
                if roller is None or roller.shard != shard.as_py():
                    done.append(roller.end() if roller else None)
                    roller = _Roller(uri, shard.as_py(), roll_bytes)
                payload = (html.as_py() or "").encode()
                done.append(roller.add(_gzip(record(page_id.as_py(), url.as_py(), payload, digest.as_py(), refers_to.as_py(), date))))
        done.append(roller.end() if roller else None)
        rows = [x for x in done if x]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))], ["shard", "file", "records", "bytes", "sha256"])

    return run


def read_records(stream: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record in a file of gzip members, one at a time."""
    z, held = zlib.decompressobj(31), b""
    data = bytearray()
    while held or (held := stream.read(1 << 20)):
        data += z.decompress(held)
        held = z.unused_data
        if z.eof:
            head, _, rest = bytes(data).partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield fields, rest[: int(fields["Content-Length"])]
            z, data = zlib.decompressobj(31), bytearray()
    if data:
        raise ValueError("a WARC file ends within a record")


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(uri)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for head, block in read_records(stream):
                        if head["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise ValueError(f"{name}: a block doesn't match its digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length, digest = int(http.rpartition(b": ")[2]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                        whole = head["WARC-Type"] == "response"
                        if whole and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: a payload doesn't match its digest")
                        rows.append((int(head["Page-Id"]) if head["Page-Id"] else None, length, digest, head["WARC-Type"], int(head["Refers-To-Page-Id"]) if not whole else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def shards(rows: DataFrame, shard_bytes: int) -> DataFrame:
    """rows(page_id, payload_bytes) with `shard`: ranges of page_id of about `shard_bytes` each.

    The bytes of equal-width ranges are summed; a range with more than a
    shard's bytes is split into narrower ones, down to single ids, so that
    outlying ids don't crowd the others into one shard. The ranges are then cut
    by prefix sums of their bytes. A null page_id is in the first range. The
    result doesn't depend on the order of the rows.
    """
    light = cut(rows.select("page_id", (F.col("payload_bytes") + 512).alias("bytes")))
    low, high = light.agg(F.min("page_id"), F.max("page_id")).head()
    low, high = low or 0, high or 0
    shift = 0
    while (high >> shift) - (low >> shift) >= CELLS:
        shift += 1
    cell = lambda k: F.shiftright("page_id", k)
    levels, part = [], light.where("page_id is not null")
    while True:
        sums = cut(part.groupBy(cell(shift).alias("cell")).agg(F.sum("bytes").alias("bytes")))
        crowded = F.col("bytes") > (shard_bytes if shift else 1 << 62)
        levels.append((shift, sums.where(~crowded)))
        over = sums.where(crowded).select("cell")
        if not shift or not over.limit(1).count():
            break
        part = part.withColumn("cell", cell(shift)).join(small(over, 64), "cell", "left_semi").drop("cell")
        shift = max(shift - BITS, 0)
    ranges = reduce(DataFrame.unionByName, [x.select(F.lit(k).alias("level"), "cell", F.shiftleft("cell", k).alias("start"), "bytes") for k, x in levels])
    ranges = cut(ranges.selectExpr("level", "cell", f"cast(coalesce(sum(bytes) over (order by start rows between unbounded preceding and 1 preceding), 0) div {shard_bytes} as int) as shard"))
    out, names = rows, []
    for k, _ in levels:
        of_level = ranges.where(F.col("level") == k).select(F.col("cell").alias(f"_c{k}"), F.col("shard").alias(f"_s{k}"))
        out = out.join(small(of_level, 64), cell(k) == F.col(f"_c{k}"), "left")
        names += [f"_c{k}", f"_s{k}"]
    return out.withColumn("shard", F.coalesce(*[F.col(x) for x in names[1::2]], F.lit(0))).drop(*names)


def write_warc(pages: DataFrame, uri: str, roll_bytes: int = 16 << 20, shard_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes pages(page_id, url, html) as WARC files into the folder `uri`; the manifest, read again.

    A null html is an empty payload. Of rows with equal payloads of at least
    LEAST_REVISIT bytes that with the smallest page_id is a response (rows that
    repeat it too; null page_ids sort last), others revisit it. An empty table
    gives an empty manifest; other columns are ignored. Equal rows in any order
    give the same files, byte for byte, while no two different rows share a
    page_id and digest.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"))
    firsts = rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first")
    rows = rows.join(small(cut(firsts), 80), "payload_digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    placed = shards(rows.withColumn("refers_to", refers).drop("first"), shard_bytes)
    store, path = file_system(uri)
    store.create_dir(path, recursive=True)
    placed = placed.repartition("shard").sortWithinPartitions("shard", "page_id", "payload_digest", "url")
    written = placed.mapInArrow(_write(uri, roll_bytes, date), _MANIFEST)
    written.write.mode("overwrite").parquet(f"{uri}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{uri}/manifest")


def read_warc(spark: SparkSession, uri: str) -> DataFrame:
    """The records of the files that the folder's manifest lists, digests verified; a revisit's size and digest are its header's."""
    files = spark.read.schema(_MANIFEST).parquet(f"{uri}/manifest")
    # with a number, adaptive execution doesn't put all the small manifest rows into one task
    return files.select("file").repartition(max(files.count(), 1), "file").mapInArrow(_read(uri), _RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """write_warc into a new folder of the cluster's shared one, then read_warc of it."""
    spark = pages.sparkSession
    uri = f"{shared_dir(spark)}/warc-{uuid.uuid4()}"
    write_warc(pages, uri)
    return read_warc(spark, uri)
