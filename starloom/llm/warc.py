"""Deterministic sharded WARC writer, and its reader.

Records are ordered by page id. Prefix sums of the payload sizes cut that
order into shards of about ``shard_bytes``; the cuts are page ids, so the same
table gives the same shards on any cluster. A task sorts a shard, makes each record
anew (headers, lengths, SHA-1 digests, a record id derived from the page) as a
gzip member of its own, and rolls to the next file before one would pass
``file_bytes`` compressed. Of records with equal payloads that of the least page id
is a response, the others are revisits of it.

Files are written under temporary names. Spark's commit of the list of files
picks one attempt of each task; the listed files are then renamed (a rename
that was done before is left alone) and the manifest is written last. Readers read
what the manifest names, so an unfinished or repeated attempt is never seen.

The target folder is any that every executor reaches through pyarrow.fs (shared
file system, HDFS, object store). Page ids are integers. Cases: null html is an empty payload; empty
payloads are equal to each other. Null ids come last. Rows that repeat an id are records of their own,
in the order of their digests; exact repeats revisit the first of them, which is how ties of page ids are decided.
A very long payload is a record, and if it passes ``file_bytes`` a file, of its own. An empty table gives an
empty manifest. Extra columns are ignored. Urls are kept as they are; a null url is left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm.common import written
from starloom.llm.sharding import byte_shards

#: Tasks that rename or read files, at most; beyond that a task takes several files.
MOST_TASKS = 20_000
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "starloom:warc-record")
MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, position long"
NULL_LAST = np.iinfo(np.int64).max  # stands for a null id where ids are ordered


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, f'{page_id}/{digest}/{nth}')}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time stamp."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, nth: int, date: str,
           response_of: tuple[int | None] | None) -> bytes:
    """A response, or a revisit of the response of page ``response_of[0]``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if response_of else http + payload
    headers = [
        ("WARC-Type", "revisit" if response_of else "response"), ("WARC-Record-ID", record_id(page_id, digest, nth)), ("WARC-Date", date),
        *([("WARC-Target-URI", _one_line(url))] if url is not None else []),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_digest(hashlib.sha1(block).digest())}"),
        ("Starloom-Page-Id", "" if page_id is None else str(page_id)), ("Starloom-Payload-Length", str(len(payload)))]
    if response_of:
        first = response_of[0]
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first, digest, 0)),
                    ("Starloom-Refers-To-Page", "" if first is None else str(first))]
    return member(headers, block)


class _Roller:
    """Files of one shard, under temporary names."""

    def __init__(self, target: str, shard: int, file_bytes: int, date: str):
        self.files, self.root = fs.FileSystem.from_uri(target)
        self.shard, self.limit, self.date, self.number, self.out = shard, file_bytes, date, 0, None

    def add(self, data: bytes) -> Iterator[dict]:
        if self.out and self.size + len(data) > self.limit and self.records:
            yield self.close()
        if not self.out:
            self.name = f"part-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.files.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out = self.files.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.size = self.records = 0
            self.hash = hashlib.sha256()
            self.number += 1
            self._put(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, self.name)}>"),
                              ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")],
                             b"format: WARC File Format 1.1\r\n"))
        self._put(data)
        self.records += 1

    def _put(self, data: bytes):
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        self.out = None
        return {"name": self.name, "temporary": self.temporary, "records": self.records, "bytes": self.size, "sha256": self.hash.hexdigest()}


def _write_shards(target: str, file_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, page, firsts, nth = None, object(), {}, {}
        done: list[dict] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "page_id", "is_page", "sha1", "first", "url", "html"))):
                shard, page_id, is_page, sha1, first, url, html = row
                if roller is None or roller.shard != shard:
                    if roller and roller.out:
                        done.append(roller.close())
                    roller, page = _Roller(target, shard, file_bytes, date), object()
                if page_id != page:
                    page, firsts, nth = page_id, {}, {}
                if not is_page:  # stands before the pages of its id
                    firsts[sha1] = first
                    continue
                n = nth[sha1] = nth.get(sha1, -1) + 1
                revisit = (firsts[sha1],) if sha1 in firsts and (n or firsts[sha1] != page_id) else None
                data = record(page_id, url, (html or "").encode(), base32_digest(sha1), n, date, revisit)
                done += roller.add(data)
        if roller and roller.out:
            done.append(roller.close())
        if done:
            yield pa.RecordBatch.from_pylist(done)
    return run


def _rename(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                if files.get_file_info(f"{root}/{row['temporary']}").type != fs.FileType.NotFound:
                    files.move(f"{root}/{row['temporary']}", f"{root}/{row['name']}")
                found = files.get_file_info(f"{root}/{row['name']}")
                if found.type != fs.FileType.File or found.size != row["bytes"]:
                    raise OSError(f"{row['name']}: not committed ({found})")
            yield batch
    return run


def write_archives(pages: DataFrame, target: str, shard_bytes: int = 256 << 20, file_bytes: int = 64 << 20,
                   least_payload: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``target``; returns the manifest (name, records, bytes, sha256)."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    sha1 = F.unhex(F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))

    # Equal payloads: a row for each digest that occurs more than once, joined to the ids it occurs at.
    digests = written(rows.select("page_id", sha1.alias("sha1"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("size")), "digests")
    shared = (digests.filter(F.col("size") >= least_payload).groupBy(F.col("sha1").alias("shared_sha1"))
              .agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1"))
    firsts = digests.join(shared, F.col("sha1") == F.col("shared_sha1")).select("page_id", "sha1", "first").distinct()

    # Page ids where shards begin: as many as shards, by the total of the sizes.
    total = digests.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    ordered = rows.withColumn("order_id", F.coalesce("page_id", F.lit(int(NULL_LAST))))
    cuts = np.array([r[0] for r in byte_shards(ordered, shards, ("order_id",), "html")
                     .groupBy("shard").agg(F.min("order_id").alias("cut")).filter("shard > 0").select("cut").collect()], dtype=np.int64)
    cuts.sort()

    @F.pandas_udf("int")
    def shard(order_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, order_id.to_numpy(), side="right").astype(np.int32))

    both = (
        rows.select("page_id", F.lit(True).alias("is_page"), sha1.alias("sha1"), F.lit(None).cast("long").alias("first"), "url", "html")
        .unionByName(firsts.select("page_id", F.lit(False).alias("is_page"), "sha1", "first",
                                   F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html")))
        .withColumn("shard", shard(F.coalesce("page_id", F.lit(int(NULL_LAST))))))
    listed = written(
        both.repartition(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_last("page_id"), "is_page", "sha1", "url")
        .select("shard", "page_id", "is_page", "sha1", "first", "url", "html").mapInArrow(_write_shards(target, file_bytes, date), MANIFEST), "warc-files")
    manifest = _by_file(listed).mapInArrow(_rename(target), MANIFEST).drop("temporary")
    manifest.write.json(f"{target}/_manifest")
    return spark.read.schema("name string, records long, bytes long, sha256 string").json(f"{target}/_manifest")


def _by_file(manifest: DataFrame) -> DataFrame:
    """The files' rows over as many tasks as there are files (MOST_TASKS at most; a given number is not merged)."""
    return manifest.repartition(max(1, min(manifest.count(), MOST_TASKS)), "name")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    unpack, out, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        out.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(out)
            data, unpack, out = unpack.unused_data or stream.read(1 << 20), zlib.decompressobj(31), []
        else:
            data = stream.read(1 << 20)
    if out:
        raise ValueError("truncated gzip member")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block; lengths and digests are checked."""
    head, block = data.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = block[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or data != head + b"\r\n\r\n" + block + b"\r\n\r\n":
        raise ValueError(f"malformed record {headers.get('WARC-Record-ID')}")
    for name, got in (("WARC-Block-Digest", block), ("WARC-Payload-Digest", block.split(b"\r\n\r\n", 1)[-1])):
        if name == "WARC-Payload-Digest" and headers["WARC-Type"] != "response":
            continue
        if name in headers and headers[name] != f"sha1:{base32_digest(hashlib.sha1(got).digest())}":
            raise ValueError(f"wrong {name} in {headers.get('WARC-Record-ID')}")
    return headers, block


def _read_files(target: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                found: list[dict] = []
                position, held = 0, 0
                with files.open_input_stream(f"{root}/{row['name']}", compression=None) as stream:
                    for data in _members(stream):
                        h, block = parse_record(data)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        number = lambda key: int(h[key]) if h.get(key) else None
                        rec = {"page_id": number("Starloom-Page-Id"), "url": h.get("WARC-Target-URI"), "payload_bytes": number("Starloom-Payload-Length"),
                               "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": h["WARC-Type"],
                               "refers_to": number("Starloom-Refers-To-Page"), "file": row["name"], "position": position}
                        if with_payload:
                            rec["payload"] = block.split(b"\r\n\r\n", 1)[1] if h["WARC-Type"] == "response" else None
                            held += len(block)
                        found.append(rec)
                        position += 1
                        if len(found) >= 5000 or held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema=_schema(with_payload))
                            found, held = [], 0
                if position != row["records"]:
                    raise ValueError(f"{row['name']}: {position} records, the manifest has {row['records']}")
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=_schema(with_payload))
    return run


def _schema(with_payload: bool) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in RECORDS.split(", "))]
    return pa.schema([*fields, *([("payload", pa.binary())] if with_payload else [])])


def read_archives(spark: SparkSession, target: str, with_payload: bool = False) -> DataFrame:
    """The records of the files that the manifest names; payloads of responses if asked for."""
    manifest = spark.read.schema("name string, records long, bytes long, sha256 string").json(f"{target}/_manifest")
    return _by_file(manifest).mapInArrow(_read_files(target, with_payload), RECORDS + (", payload binary" if with_payload else ""))
