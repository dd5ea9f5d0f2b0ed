"""Token ids of documents in Simple-8b files, in ascending ``doc_id`` order over all files.

File: ``MAGIC``; blocks of ``BLOCK`` ids (Simple-8b words, then escapes); block index (byte offset, words, escapes,
ids for each block); document index (``doc_id``, whether it is null, first id within the file, number of ids for each
document); footer (number of blocks, number of documents, ``MAGIC``). All integers are 64-bit and little-endian.

The texts are range-partitioned by ``doc_id``, so they are shuffled once; each task tokenizes its range, writes its
files and rolls them by number of ids. The manifest has one row per file; the ids before a file come from running
totals over the manifest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfold.llm import simple8b
from skyfold.llm.common import running_totals, texts
from skyfold.llm.files import file_sum, read_listed, write_file
from skyfold.llm.pieces import coder
from skyfold.session import materialize

MAGIC = b"S8BIDS01"
SUFFIX = ".s8b"
BLOCK = 1 << 16
FILE_IDS = 1 << 22
END_ID = 1
MANIFEST = "part int, seq int, name string, n_docs long, n_ids long, n_bytes long, file_sum long"
_MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64()), ("file_sum", pa.int64())])


def file_chunks(docs: list[tuple[int | None, bytes]]) -> list[bytes]:
    """Bytes of one file from ``(doc_id, little-endian 32-bit ids)`` in order."""
    ids = np.frombuffer(b"".join(coded for _, coded in docs), "<u4")
    counts = np.array([len(coded) // 4 for _, coded in docs], np.int64)
    blocks, index = simple8b.pack(ids, BLOCK)
    listed = np.array([[d or 0 for d, _ in docs], [d is None for d, _ in docs], np.cumsum(counts) - counts, counts], "<i8").T
    return [MAGIC, *blocks, index.tobytes(), np.ascontiguousarray(listed).tobytes(), np.array([len(index), len(docs)], "<u8").tobytes(), MAGIC]


def read_chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, document index)`` of one file."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a whole token file")
    n_blocks, n_docs = np.frombuffer(data, "<u8", 2, len(data) - 24).astype(int).tolist()
    at = len(data) - 24 - 32 * n_docs
    listed = np.frombuffer(data, "<i8", 4 * n_docs, at).reshape(-1, 4)
    index = np.frombuffer(data, "<u8", 4 * n_blocks, at - 32 * n_blocks).reshape(-1, 4)
    return simple8b.unpack(memoryview(data)[8:], index), listed


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of every row's whole text, each followed by ``end_id``, and returns the stored manifest.

    A null text counts as empty: its ids are the end id alone. A null ``doc_id`` sorts first. Rows that repeat a
    ``doc_id`` follow each other in the order of their texts. Columns besides ``doc_id`` and ``text`` are ignored.
    Without rows no file is written and the manifest is empty. A file takes whole documents, so a very long one may
    exceed ``file_ids``.
    """
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, n_ids = TaskContext.get().partitionId(), 0, [], 0

        def rolled() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:06d}{SUFFIX}"
            size, mark = write_file(folder, name, file_chunks(held))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "name": name, "n_docs": len(held), "n_ids": n_ids, "n_bytes": size, "file_sum": mark}], _MANIFEST)

        code = coder(tokenizer)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                held.append((doc_id, code.ids(text) + end))
                n_ids += len(held[-1][1]) // 4
                if n_ids >= file_ids:
                    yield rolled()
                    seq, held, n_ids = seq + 1, [], 0
        if held:
            yield rolled()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(placed.mapInArrow(write, MANIFEST), "token-manifest")


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per written document: ``doc_id, start, n_tokens, ids_crc32``, and ``ids`` if asked for.

    ``start`` counts the ids of all documents before it, over all files. Files that the manifest lacks are left out;
    a listed file that is missing or differs from what was written raises.
    """
    fields = [("name", pa.string()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("file_sum", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                whole = content.as_py()
                ids, listed = read_chunks(whole)
                narrow = ids.astype("<u4")
                spans = [(a, a + n) for a, n in listed[:, 2:].tolist()]
                columns = [
                    pa.array([name] * len(listed)), pa.array(listed[:, 0], mask=listed[:, 1] == 1), pa.array(listed[:, 2]), pa.array(listed[:, 3]),
                    pa.array([zlib.crc32(narrow[a:b].tobytes()) for a, b in spans], pa.int64()), pa.array([file_sum(whole)] * len(listed), pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([narrow[a:b].astype(np.int32) for a, b in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kind = "name string, doc_id long, local long, n_tokens long, ids_crc32 long, file_sum long" + ", ids array<int>" * with_ids
    found = read_listed(spark, folder, SUFFIX, manifest, read, kind)
    before = running_totals(manifest.select("part", "seq", "name", "n_ids"), ["part", "seq"], {"before": "n_ids"}, "token-files").select("name", "before")
    placed = found.join(before, "name")
    return placed.select("doc_id", (F.col("local") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
