"""Deterministic sharded WARC writer and reader.

Records are dealt into shards by ranges of page_id that follow from exact running sums of the payload bytes, sorted
within their shard, and rolled into files by compressed size. Headers and digests are made anew. Files are written
under temporary names; a manifest, which Spark commits together with the successful tasks, says which of them count,
and only those get their final names. The same pages give the same files, byte for byte, on any cluster.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import spread, stored
from tallybook.session import fresh_folder

#: Payload bytes of a shard (one task writes one shard) and compressed bytes at which a file is closed.
SHARD_BYTES, FILE_BYTES = 32 << 20, 16 << 20
#: There are at most so many shards (they grow beyond); their bounds, 8 bytes each, go to every task.
MOST_SHARDS = 20_000
LEAST_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path there."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


@dataclass
class Archive:
    """folder: of the files; manifest: name, records, bytes, sha256 of each."""

    folder: str
    manifest: DataFrame


def described(pages: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, refers_to (null for a response) of every row; no payloads.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the one with the smallest page_id is the response, a row
    without page_id only if none has one; of rows that share it, all are responses.
    """
    html = F.coalesce("html", F.lit(""))
    slim = pages.select(
        "page_id", F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html.cast("binary"), 256).alias("payload_digest")
    )
    slim = stored(slim, "warc-digests")
    first = slim.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    joined = slim.join(first, "payload_digest", "left")
    return joined.select(
        "page_id", "payload_bytes", "payload_digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def shard_bounds(slim: DataFrame, shard_bytes: int = SHARD_BYTES, most: int = MOST_SHARDS) -> list[int]:
    """The first page_id of every shard but the first: where the running sum of payload bytes passes a multiple of
    ``shard_bytes``, or of more if that made over ``most`` shards. Rows without page_id are in the first shard."""
    ids = slim.where(F.col("page_id").isNotNull())
    size = F.col("payload_bytes") + 512
    whole = ids.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    if not whole.n:
        return []
    each = max(shard_bytes, whole.bytes // most)
    dealt = ids.select("page_id", size.alias("size")).repartitionByRange(spread(whole.n, 100_000), "page_id")
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), "warc-order")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    sums = dealt.groupBy("part").agg(F.sum("size").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    running = F.sum("size").over(W.partitionBy("part").orderBy("page_id"))
    shard = F.floor((F.col("earlier") + F.col("running") - 1) / each)
    firsts = dealt.withColumn("running", running).join(sums, "part").groupBy(shard.alias("shard")).agg(F.min("page_id").alias("first"))
    return sorted(r.first for r in firsts.where("shard > 0").select("first").collect())


def record(kind: str, ident: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member holding one WARC record."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ident}>"), ("WARC-Date", DATE), *headers]
    head.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    head.append(("Content-Length", str(len(block))))
    data = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def identity(page_id: int | None, nth: int = 0) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}" + (f":{nth}" if nth else "")


def page_record(page_id: int | None, nth: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = "".join(c for c in (url or "") if c > " " and c != "\x7f")
    headers = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        return record("response", identity(page_id, nth), headers, http + payload)
    headers += [("WARC-Refers-To", f"<{identity(refers_to)}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record("revisit", identity(page_id, nth), headers, http)


class Roller:
    """Writes records of one shard to files under temporary names and rolls them by compressed size."""

    def __init__(self, folder: str, shard: int, most: int):
        self.store, self.root = opened(folder)
        self.shard, self.most, self.number = shard, most, 0
        self.stream = None

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.stream is not None and self.size + len(data) > self.most:
            yield self.close()
        if self.stream is None:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f".{self.name}.{uuid.uuid4().hex}"
            self.stream = self.store.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.size, self.records, self.digest = 0, 0, hashlib.sha256()
            self._write(record("warcinfo", f"urn:file:{self.name}", [("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._write(data)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> tuple:
        self.stream.close()
        self.stream = None
        self.number += 1
        return self.name, self.temporary, self.records, self.size, self.digest.hexdigest()


def write(pages: DataFrame, folder: str, *, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> Archive:
    """Write ``pages`` (page_id, url, html; null html is empty) as WARC files to ``folder``.

    Payloads are shuffled once: they and their descriptions are dealt by shard and sorted so that each description
    comes just before its payload. Rows that share a page_id are numbered in the order of their digests. An empty
    table gives no file. Columns other than the three are ignored.
    """
    slim = stored(described(pages), "warc-records")
    bounds = np.array(shard_bounds(slim, shard_bytes), np.int64)

    @F.pandas_udf("long")
    def shard_of(page_id):
        return page_id.where(page_id.isna(), np.searchsorted(bounds, page_id.fillna(0).to_numpy(np.int64), side="right")).fillna(0).astype("int64")

    html = F.coalesce("html", F.lit(""))
    null = lambda kind: F.lit(None).cast(kind)
    told = slim.select("page_id", F.lit(0).alias("kind"), "payload_digest", "refers_to", null("string").alias("url"), null("binary").alias("payload"))
    given = pages.select("page_id", F.lit(1).alias("kind"), F.sha2(html.cast("binary"), 256).alias("payload_digest"), null("long").alias("refers_to"), "url", html.cast("binary").alias("payload"))
    dealt = told.union(given).withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-(2**63)))))
    # one shard for each task: by hash of its number some tasks would get several and others none
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "payload_digest", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, last, nth, refers = None, (), 0, {}
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "page_id", "kind", "payload_digest", "refers_to", "url", "payload")]
            for shard, page_id, kind, digest, refers_to, url, payload in zip(*columns):
                if not kind:
                    refers = {(page_id, digest): refers_to}
                    continue
                if roller is None or roller.shard != shard:
                    if roller:
                        done.append(roller.close())
                    roller = Roller(folder, shard, file_bytes)
                nth = nth + 1 if last == (page_id,) else 0
                last = (page_id,)
                done.extend(roller.add(page_record(page_id, nth, url, payload, digest, refers[page_id, digest])))
        if roller:
            done.append(roller.close())
        names = ["name", "temporary", "records", "bytes", "sha256"]
        yield pa.record_batch([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names)

    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    manifest = stored(dealt.mapInArrow(run, "name string, temporary string, records long, bytes long, sha256 string"), "warc-manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Move what the manifest names; what was moved by an earlier attempt stays."""
        store, root = opened(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist()):
                if store.get_file_info(f"{root}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
            yield batch.select(["name", "records", "bytes", "sha256"])

    final = manifest.mapInArrow(commit, "name string, records long, bytes long, sha256 string")
    final.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/manifest")
    return Archive(folder, pages.sparkSession.read.parquet(f"{folder.rstrip('/')}/manifest"))


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one after the other."""
    rest, packer, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            if parts:
                raise ValueError("the archive ends within a record")
            return
        parts.append(packer.decompress(data))
        if packer.eof:
            yield b"".join(parts)
            rest, packer, parts = packer.unused_data, zlib.decompressobj(31), []


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers of a record and its block, held against its length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"a damaged record: {head[:200]!r}")
    return headers, block


def _page(ident: str) -> int | None:
    value = ident.strip("<>").split(":")[2]
    return None if value == "none" else int(value)


def read(archive: Archive) -> DataFrame:
    """The records of an archive: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest and length are taken from its payload, a revisit's from its headers. The files of one shard are
    one unit of work, each read as a stream. An archive without files gives no row.
    """
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows: list[tuple] = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in members(stream):
                        headers, block = parsed(member)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if headers["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"a damaged payload in {name}")
                        refers = headers.get("WARC-Refers-To")
                        rows.append((_page(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], _page(refers) if refers else None))
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    files = archive.manifest.select("name", F.split_part("name", F.lit("-"), F.lit(2)).cast("int").alias("shard"))
    last = files.agg(F.max("shard")).first()[0]
    return files.repartitionById(1 if last is None else last + 1, "shard").select("name").mapInArrow(run, COLUMNS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh folder of the shared place and read the archive back."""
    return read(write(pages, fresh_folder(pages.sparkSession, "warc")))
