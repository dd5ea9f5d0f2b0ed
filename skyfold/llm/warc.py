"""Deterministic sharded WARC files: written by Spark tasks, read back and verified.

Records go into files in ``page_id`` order. A page's shard follows from the payload bytes of all pages before it, so
shards have even sizes and the same pages always give the same files, on any cluster:

1. one pass over the payloads takes digest and size of each, and the smallest id of each digest;
2. the narrow rows get the bytes before them as running totals over range partitions; the first page of each shard is a
   bound, and the bounds place the pages. There are about ``SHARDS`` shards, more if they would exceed ``LARGEST_SHARD``
   bytes of payload and fewer if they would fall below ``LEAST_SHARD``;
3. pages are shuffled to their shards together with the rows that tell which of them are revisits, sorted, and
   written: headers and digests are made anew, each record is its own gzip member, and a file is closed once its
   compressed size reaches ``roll_bytes``;
4. files get their final name when whole; the manifest lists them with sizes and digests, and readers use only those.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyfold.llm.common import running_totals
from skyfold.llm.files import file_sum, read_listed, write_file
from skyfold.session import materialize

SUFFIX = ".warc.gz"
REVISIT_BYTES = 100
SHARDS, LEAST_SHARD, LARGEST_SHARD = 256, 1 << 20, 1 << 30
ROLL_BYTES = 16 << 20
INFLATED_AT_ONCE = 1 << 16
RECORD_BYTES = 1024
DATE = datetime(2020, 1, 1, tzinfo=UTC)
LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MANIFEST = pa.schema([("shard", pa.int64()), ("seq", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string()), ("file_sum", pa.int64())])
MANIFEST = "shard long, seq int, name string, records long, n_bytes long, sha256 string, file_sum long"
_RECORDS = pa.schema([
    ("name", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()), ("file_sum", pa.int64()),
])
RECORDS = "name string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, file_sum long"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    value = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: datetime = DATE) -> bytes:
    """One WARC/1.1 record as a gzip member: a response, or a revisit of ``refers_to`` without the payload."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head = "\r\n".join(line.replace("\r", "%0D").replace("\n", "%0A") for line in lines)
    return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def members(content: bytes) -> Iterator[bytes]:
    """The inflated gzip members of an archive; each byte is read once."""
    at, tail = 0, b""
    while at < len(content) or tail:
        inflate, parts = zlib.decompressobj(wbits=31), []
        while not inflate.eof:
            if not tail:
                tail, at = content[at : at + INFLATED_AT_ONCE], at + INFLATED_AT_ONCE
                if not tail:
                    raise ValueError("archive ends within a record")
            parts.append(inflate.decompress(tail))
            tail = inflate.unused_data
        yield b"".join(parts)


def parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, whose lengths and block digests must hold."""
    for data in members(content):
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        block = rest[:size]
        if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n" or hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        yield headers, block


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def _page_rows(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit("")) if "url" in pages.columns else F.lit("")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), _payload(F.col("html")).alias("payload"))


def plan_records(pages: DataFrame) -> DataFrame:
    """Written ``(page_id, digest, size, refers_to)`` of every row; ``refers_to`` is null for responses.

    Of payloads of ``REVISIT_BYTES`` or more, those whose ``page_id`` is not the smallest with that digest are revisits.
    Rows that repeat both id and payload are alike; a null id never is the smallest and revisits any other.
    """
    narrow = materialize(_page_rows(pages).select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size")), "payloads")
    first = narrow.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = narrow.join(first, "digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    return materialize(joined.select("page_id", "digest", "size", F.when(other, F.col("first_id")).alias("refers_to")), "plan")


def shard_bounds(plan: DataFrame, shard_bytes: int | None = None) -> np.ndarray:
    """First ``page_id`` of every shard but the first, in order; shards follow from the bytes of the pages before."""
    sized = plan.where("page_id IS NOT NULL").groupBy("page_id").agg(F.sum(F.col("size") + RECORD_BYTES).alias("size"))
    placed = running_totals(sized, ["page_id"], {"before": "size"}, "sizes")
    if shard_bytes is None:
        whole = sized.agg(F.sum("size")).first()[0] or 0
        shard_bytes = min(max(whole // SHARDS, LEAST_SHARD), LARGEST_SHARD)
    first = placed.groupBy(F.floor(F.col("before") / shard_bytes).alias("shard")).agg(F.min("page_id").alias("page_id"))
    return np.sort(first.where("shard > 0").toPandas()["page_id"].to_numpy(np.int64))


def write_archives(pages: DataFrame, folder: str, shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES, date: datetime = DATE) -> DataFrame:
    """Writes a record for every row of ``pages(page_id, url, html)`` and returns the stored manifest.

    A null ``html`` or ``url`` counts as empty. Rows without an id come last, dealt by their digests over as many shards
    as the others have. Rows that repeat an id are written side
    by side, in the order of their payload digests. A payload over ``roll_bytes`` makes its own file. Other columns are
    ignored; no rows write no file.
    """
    plan = plan_records(pages)
    bounds = shard_bounds(plan, shard_bytes)

    @F.pandas_udf("long")
    def placed_by(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(0).astype("int64"), side="right"))

    nameless = F.lit(len(bounds) + 1) + F.pmod(F.xxhash64("digest"), F.lit(len(bounds) + 1))
    shard = F.when(F.col("page_id").isNull(), nameless).otherwise(placed_by("page_id")).alias("shard")
    revisits = plan.where("refers_to IS NOT NULL").select("page_id", "digest", "refers_to").distinct()
    notes = revisits.select(shard, "page_id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    content = _page_rows(pages).withColumn("digest", F.sha2("payload", 256)).select(shard, "page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        held: list[bytes] = []
        note: tuple = ()

        def closed() -> pa.RecordBatch:
            name = f"shard-{now[0]:08d}-{now[1]:05d}{SUFFIX}"
            whole = hashlib.sha256()
            for r in held:
                whole.update(r)
            size, mark = write_file(folder, name, held)
            return pa.RecordBatch.from_pylist([{"shard": now[0], "seq": now[1], "name": name, "records": len(held), "n_bytes": size, "sha256": whole.hexdigest(), "file_sum": mark}], _MANIFEST)

        size = 0
        for batch in batches:
            shards, ids, digests, kinds, refers, urls = (batch.column(c).to_pylist() for c in ("shard", "page_id", "digest", "kind", "refers_to", "url"))
            payloads = batch.column("payload")
            for k, number in enumerate(shards):
                if kinds[k] == 0:
                    note = (ids[k], digests[k], refers[k])
                    continue
                if now is not None and (number != now[0] or size >= roll_bytes):
                    yield closed()
                    now, held, size = (number, now[1] + 1 if number == now[0] else 0), [], 0
                now = now or (number, 0)
                refers_to = note[2] if note[:2] == (ids[k], digests[k]) else None
                held.append(record(ids[k], urls[k], payloads[k].as_py(), refers_to, date))
                size += len(held[-1])
        if held:
            yield closed()

    placed = notes.unionByName(content).repartition("shard").sortWithinPartitions("shard", "page_id", "digest", "kind")
    return materialize(placed.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the files in the manifest, every length and digest verified.

    A listed file that is missing or differs from what was written raises. ``name, page_id, url, payload_bytes, payload_digest, record_type, refers_to`` and ``payload`` (null for revisits,
    and everywhere unless ``with_payload``).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                rows, whole = [], content.as_py()
                mark = file_sum(whole)
                for headers, block in parsed(whole):
                    revisit = headers["WARC-Type"] == "revisit"
                    digest, payload = headers["WARC-Payload-Digest"].removeprefix("sha256:"), block.partition(b"\r\n\r\n")[2]
                    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged payload in {name}")
                    rows.append({
                        "name": name, "file_sum": mark, "page_id": page_of(headers["WARC-Record-ID"]), "url": headers["WARC-Target-URI"], "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": digest,
                        "record_type": headers["WARC-Type"], "refers_to": page_of(headers["WARC-Refers-To"]) if revisit else None, "payload": payload if with_payload and not revisit else None,
                    })
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORDS)

    return read_listed(spark, folder, SUFFIX, manifest, read, RECORDS)
