"""WARC archives written by a deterministic sharded writer, and read back.

Paths are those of a folder that all executors reach (``pyarrow.fs`` opens file, hdfs, s3 and gs
addresses). A file exists for readers only once the manifest names it.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import discard

SHARD_BYTES = 64 << 20  # payload of one shard, about; shards are ranges of the sort order
FILE_BYTES = 8 << 20  # compressed size at which a file is closed and the next one begun
FILES_PER_TASK = 2  # that one task reads
MIN_REVISIT_BYTES = 0
KEYS_PER_SHARD = 64  # sampled keys per shard boundary
DATE = "1970-01-01T00:00:00Z"  # pages carry no crawl time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = (
    "shard int, part int, file string, temporary string, records long, bytes long, sha256 string"
)
_RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, record_id string, payload binary, file string"
)


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, payload_key: str, copy: int) -> str:
    seed = hashlib.sha256(f"{page_id}|{payload_key}|{copy}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=seed, version=5)}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member; the same input gives the same bytes."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _page_member(page_id, url, payload: bytes, key: str, refers_to, copy: int) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, key, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url if url else f"urn:page:{page_id}", safe=":/?#[]@!$&'()*+,;=%")),
        ("WARC-Payload-Digest", f"sha1:{_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if url is None:
        headers.append(("WARC-Page-URL", "none"))
    if revisit:
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, key, 0)),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    return _member(headers, block)


class _Roll:
    """The files of one shard: opened under a temporary name, closed when large enough."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.root = _open(root)
        self.shard, self.limit, self.part = shard, limit, 0
        self.stream = None

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.stream is None:
            self.file = f"part-{self.shard:06d}-{self.part:06d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{uuid.uuid4().hex}-{self.file}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.stream = self.fs.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
            info = f"software: orderlake\r\nformat: WARC File Format 1.1\r\nname: {self.file}\r\n"
            headers = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", _record_id(None, self.file, 0)),
                ("WARC-Date", DATE),
                ("WARC-Filename", self.file),
                ("WARC-Block-Digest", f"sha1:{_sha1(info.encode())}"),
                ("Content-Type", "application/warc-fields"),
            ]
            self._write(_member(headers, info.encode()))
        self._write(member)
        self.records += 1
        if self.bytes >= self.limit:
            yield from self.close()

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.bytes += len(data)

    def close(self) -> Iterator[tuple]:
        if self.stream is None:
            return
        self.stream.close()
        self.stream = None
        name = self.temporary.rsplit("/", 1)[1]
        yield self.shard, self.part, self.file, name, self.records, self.bytes, self.digest.hexdigest()
        self.part += 1


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string())]
    + [("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]
    + [("sha256", pa.string())]
)


def _write_shards(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, seen, copy, refers = None, None, 0, None
        for batch in batches:
            done = []
            payloads = batch.column("payload")
            narrow = batch.select(["shard", "id", "url", "key", "refers_to", "kind"]).to_pylist()
            for at, row in enumerate(narrow):
                if roll is None or roll.shard != row["shard"]:
                    if roll:
                        done.extend(roll.close())
                    roll = _Roll(root, row["shard"], file_bytes)
                here = (row["id"], row["key"])
                if here != seen:
                    seen, copy, refers = here, 0, None
                if row["kind"] == 0:
                    refers = row["refers_to"]
                    continue
                member = _page_member(
                    row["id"], row["url"], payloads[at].as_py(), row["key"], refers, copy
                )
                done.extend(roll.add(member))
                copy += 1
            if done:
                yield _table(done, _MANIFEST_ARROW)
        if roll:
            yield _table(list(roll.close()), _MANIFEST_ARROW)

    return run


def _move(root: str):
    """Give the files of successful attempts their names; repeating it changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(root)
        for batch in batches:
            for row in batch.to_pylist():
                source, target = f"{base}/_temporary/{row['temporary']}", f"{base}/{row['file']}"
                there = fs.get_file_info(source).type != arrow_fs.FileType.NotFound
                if there:
                    fs.move(source, target)
                elif fs.get_file_info(target).size != row["bytes"]:
                    raise RuntimeError(f"neither {source} nor a whole {target} exists")
            yield batch

    return run


def _partition_keys(spark: SparkSession, shards: int) -> list[int]:
    """For each shard a key that Spark's hash puts into a partition of its own among ``shards``."""
    ids = spark.range(32 * shards)
    own = F.pmod(F.hash("id"), F.lit(shards)).alias("shard")
    found = {r["shard"]: r["key"] for r in ids.groupBy(own).agg(F.min("id").alias("key")).collect()}
    return [found.get(shard, shard) for shard in range(shards)]


def write_archive(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record per row under ``root`` (a new folder); returns the manifest.

    Payloads are the texts in UTF-8, null is empty. Among equal payloads of at least
    ``min_revisit_bytes`` bytes the row with the largest id is the response, the others are
    revisits of it; exact copies of that row (same id) are responses too, rows without id are
    revisits unless nobody has one. Records are sorted by (id, payload hash), nulls first.

    The sort order is cut into shards at keys of a sample that is chosen by hash, so the same rows
    give the same shards, files and bytes however they were partitioned. One task writes a shard
    as a stream and holds one record. Files are written under names of the attempt; the manifest
    of successful attempts is stored, its files get their names, and the manifest below ``root``
    is written last: an attempt lost on the way leaves nothing that readers see. An empty table
    gives an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    keys = rows.select("id", "key", F.octet_length("payload").alias("size"))
    first = (
        keys.where(F.col("size") >= min_revisit_bytes)
        .groupBy("key")
        .agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 and refers_to is not null")
    )
    revisits = (
        keys.join(first, "key")
        .where(~F.col("id").eqNullSafe(F.col("refers_to")))
        .select("id", "key", "refers_to")
        .distinct()
    )
    total = keys.agg(F.sum("size")).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    sample = (
        keys.select("id", "key")
        .distinct()
        .orderBy(F.xxhash64("id", "key"), "id", "key")
        .limit(shards * KEYS_PER_SHARD if shards > 1 else 0)
        .collect()
    )
    order = sorted((r["id"] is not None, r["id"] or 0, r["key"]) for r in sample)
    cuts = [order[k * len(order) // shards] for k in range(1, shards)] if order else []

    @F.pandas_udf("int")
    def shard_of(present: pd.Series, ids: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series(
            [bisect.bisect_right(cuts, k) for k in zip(present, ids, keys, strict=True)]
        )

    keys_of = _partition_keys(spark, shards)

    @F.pandas_udf("long")
    def partition_key(shard: pd.Series) -> pd.Series:
        return pd.Series([keys_of[k] for k in shard], dtype="int64")

    both = rows.select(
        "id", "url", "payload", "key", F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind")
    ).unionByName(
        revisits.select(
            "id", "key", "refers_to", F.lit(0).alias("kind"),
            F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        )
    )
    place = shard_of(F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), F.col("key"))
    ordered = (
        both.withColumn("shard", place)
        .repartition(shards, partition_key("shard"))
        .sortWithinPartitions("shard", F.asc_nulls_first("id"), "key", "kind", "url")
    )
    written = ordered.mapInArrow(_write_shards(root, file_bytes), _MANIFEST)
    attempt = f"{root}/_temporary/manifest"
    written.write.parquet(attempt)
    found = spark.read.schema(_MANIFEST).parquet(attempt)
    found.mapInArrow(_move(root), _MANIFEST).write.parquet(f"{root}/manifest")
    discard(spark, f"{root}/_temporary")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            if parts:
                raise ValueError("the archive ends inside a record")
            return
        parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block; checks the length and the block digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if len(rest) != len(block) + 4 or headers["warc-block-digest"] != f"sha1:{_sha1(block)}":
        raise ValueError(f"damaged record {headers.get('warc-record-id')}")
    return headers, block


def _read_files(root: str, with_payload: bool):
    def record(headers: dict[str, str], block: bytes, file: str) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        length = next(
            int(line.split(b":")[1])
            for line in http.split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        )
        if kind == "response" and (len(payload) != length or _sha1(payload) != digest):
            raise ValueError(f"the payload of {headers['warc-record-id']} is not what was stored")
        number = lambda name: int(headers[name]) if name in headers else None
        return (
            number("warc-page-id"),
            None if "warc-page-url" in headers else headers["warc-target-uri"],
            kind,
            length,
            digest,
            number("warc-refers-to-page-id"),
            headers["warc-record-id"],
            payload if with_payload and kind == "response" else None,
            file,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(root)
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string())]
            + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
            + [("refers_to", pa.int64()), ("record_id", pa.string()), ("payload", pa.binary())]
            + [("file", pa.string())]
        )
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    for member in _members(stream):
                        headers, block = parse_record(member)
                        if headers["warc-type"] in ("response", "revisit"):
                            rows.append(record(headers, block, file))
                        if len(rows) >= (64 if with_payload else 4096):
                            yield _table(rows, schema)
                            rows = []
                if rows:
                    yield _table(rows, schema)

    return run


def read_archive(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Every page record of the files the manifest names, digests verified.

    payload_bytes and payload_digest are those of the full payload, also for revisits (from the
    kept HTTP header). A task reads whole files, one record in memory at a time.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    tasks = max(1, math.ceil(manifest.count() / FILES_PER_TASK))
    files = manifest.select("file").repartitionByRange(tasks, "file")
    return files.mapInArrow(_read_files(root, with_payload), _RECORD)



